"""Spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the
other: then their common prefix and common suffix together reach the longer length minus
one. Words are laid out as rows of padded code-point matrices, once from the left and once
from the right, and blocks of rows are compared pair by pair. Only words that could be near
share a block: the place of the edit lies in one of a few windows, and outside that window
both words agree, so blocks are the words with equal beginnings and endings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import table
from orcaspark.session import stage

#: Code points of words, the divisor that marks a run for deletion.
LETTERS, MARK = "[A-Za-zÀ-ÿ]", 31
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Least code points and occurrences of a word; how many times more frequent a form is.
LEAST_LENGTH, LEAST_COUNT, DOMINANCE = 7, 2, 10
#: Windows that the place of an edit is looked for in; words of a block section.
WINDOWS, SECTION = 4, 2048
#: Rows of a task, and code points compared at a time.
SHELF, CELLS = 50_000, 4_000_000


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """Words of all texts with their occurrences: ``word``, ``n``, ``size``.

    Runs of letters shorter than ``least_length`` can't become words, as runs only lose code points.
    """
    runs = F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("run")).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.translate("run", UPPER, LOWER).alias("run")
    )
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    place = (h % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", 1, place), F.substring("run", place + 2, F.length("run")))
    word = F.when(h % MARK == 0, shorter).otherwise(F.col("run"))
    counts = found.select(word.alias("word")).filter(F.length("word") >= least_length)
    counts = counts.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)
    return counts.withColumn("size", F.length("word"))


def window_bounds(base: Column, window: Column) -> tuple[Column, Column]:
    """First place of a window and the place after its last one, for words of ``base`` code points."""
    return (
        F.floor(base * window / WINDOWS).cast("int"),
        F.floor(base * (window + 1) / WINDOWS).cast("int"),
    )


def anchored(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``words`` once for each window they may be edited in: ``base``, ``window``, ``low``, ``high``, ``anchor``.

    ``base`` is the length of the shorter word of a pair: a word's own, or one less where it is the
    longer one. ``anchor`` hashes what comes before and after the window, which both words of a
    pair share. The last window also holds the place behind the last code point.
    """
    base = F.explode(F.array("size", F.col("size") - 1)).alias("base")
    spread = words.select("word", "n", "size", base).filter(F.col("base") >= least_length)
    spread = spread.withColumn("window", F.explode(F.sequence(F.lit(0), F.lit(WINDOWS - 1))))
    low, high = window_bounds(F.col("base"), F.col("window"))
    spread = spread.withColumn("low", low).withColumn("high", high).filter(F.col("low") < F.col("high"))
    ending = F.substring("word", F.col("size") - (F.col("base") - F.col("high")) + 1, F.col("size"))
    return spread.withColumn("anchor", F.xxhash64("base", "window", F.substring("word", 1, F.col("low")), ending))


def in_blocks(rows: DataFrame, count: int) -> DataFrame:
    """Anchored rows that share a block with others, dealt to shelves of about ``SHELF`` rows.

    Large blocks are dealt to sections, and each pair of sections is a part, as is each section
    with itself; so no task holds a block of any size, and every two words meet in one part.
    """
    block = ["base", "window", "anchor"]
    sizes = rows.groupBy(*block).agg(
        F.count("*").alias("members"), F.count_if(F.col("size") == F.col("base")).alias("shorter")
    )
    sizes = sizes.filter((F.col("members") > 1) & (F.col("shorter") > 0))
    rows = rows.join(sizes.select(*block, F.ceil(F.col("members") / SECTION).cast("int").alias("sections")), block)
    rows = rows.withColumn("section", F.pmod(F.xxhash64("word"), F.col("sections")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sections") - 1)))
    rows = rows.withColumn("part", F.least("section", "other") * F.col("sections") + F.greatest("section", "other"))
    shelves = max(1, -(-2 * WINDOWS * count // SHELF))
    shelf = F.pmod(F.xxhash64(*block, "part"), F.lit(shelves))
    crosses = F.pmod("part", "sections") != F.floor(F.col("part") / F.col("sections"))
    return rows.select("word", "n", "size", *block, "low", "high", "part", "section", crosses.alias("crosses"), shelf.alias("shelf"))


def code_points(words: list[str], width: int) -> np.ndarray:
    """Words as rows of code points, filled up with zeros."""
    return np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal code points at the beginning of each two rows, which differ somewhere."""
    return (a != b).argmax(axis=1)


def block_pairs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of the same block, from each row's place and the end of its block."""
    partners = ends - starts - 1
    first = np.repeat(starts, partners)
    step = np.arange(len(first)) - np.repeat(np.cumsum(partners) - partners, partners)
    return first, first + 1 + step


def near_in_shelf(shelf: pa.Table) -> pa.Table:
    """Near words of a shelf's blocks in both directions: ``word``, ``near``, ``near_n``.

    A pair counts in the one window that holds the end of its common prefix.
    """
    block = ("base", "window", "anchor", "part")
    shelf = shelf.sort_by([(name, "ascending") for name in block])
    words = shelf["word"].to_pylist()
    columns = {name: shelf[name].to_numpy() for name in ("n", "size", "low", "high", "section", "crosses", *block)}
    changes = np.zeros(len(words), dtype=bool)
    for name in block:
        changes[1:] |= columns[name][1:] != columns[name][:-1]
    heads = np.concatenate([[0], np.flatnonzero(changes), [len(words)]])
    ends = np.repeat(heads[1:], np.diff(heads))
    base, size, last = columns["base"], columns["size"], columns["window"] == WINDOWS - 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    begin = 0
    while begin < len(words):
        # Whole blocks at a time; rows are sorted by base, so the last one is the widest.
        stop = ends[begin]
        while stop < len(words) and (ends[stop] - begin) * (base[ends[stop] - 1] + 1) <= CELLS:
            stop = ends[stop]
        width = int(size[begin:stop].max())
        left = code_points(words[begin:stop], width)
        right = code_points([w[::-1] for w in words[begin:stop]], width)
        rows = np.arange(begin, stop)
        for some in tiles(rows, ends, width):
            i, j = block_pairs(some, ends[some])
            asked = (size[i] == base[i]) | (size[j] == base[j])
            asked &= ~columns["crosses"][i] | (columns["section"][i] != columns["section"][j])
            i, j = i[asked], j[asked]
            prefix = shared(left[i - begin], left[j - begin])
            suffix = shared(right[i - begin], right[j - begin])
            near = prefix + suffix >= np.maximum(size[i], size[j]) - 1
            near &= (columns["low"][i] <= prefix) & (last[i] | (prefix < columns["high"][i]))
            found.append((i[near], j[near]))
        begin = stop
    i = np.concatenate([np.zeros(0, np.int64), *[a for a, _ in found]])
    j = np.concatenate([np.zeros(0, np.int64), *[b for _, b in found]])
    of, at = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
    return pa.table({"word": shelf["word"].take(of), "near": shelf["word"].take(at), "near_n": shelf["n"].take(at)})


def tiles(rows: np.ndarray, ends: np.ndarray, width: int) -> list[np.ndarray]:
    """Runs of rows with at most about ``CELLS`` code points in their pairs."""
    cells = np.cumsum((ends[rows] - rows - 1) * width)
    return [t for t in np.split(rows, np.flatnonzero(np.diff(cells // CELLS)) + 1) if len(t)]


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """Pairs of near words in both directions, each once: ``word``, ``near``, ``near_n``.

    ``words`` has unique ``word`` with ``n`` and ``size`` and is read several times.
    """
    blocks = in_blocks(anchored(words, least_length), words.count())
    schema = "word string, near string, near_n bigint"
    return blocks.groupBy("shelf").applyInArrow(lambda shelf: near_in_shelf(shelf.drop_columns("shelf")), schema)


def roots(forms: DataFrame) -> DataFrame:
    """Last word reached from each word by following ``form``: ``word``, ``root``.

    Each round replaces a word's target by that target's own, so a chain takes a logarithm of
    its length in rounds; a form is ``DOMINANCE`` times as frequent as its word, so chains are
    short and never close.
    """
    chains = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = chains.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        longer = stage(chains.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"),
                                                                  F.col("onward").isNotNull().alias("moved")), "roots")
        if longer.filter("moved").isEmpty():
            return longer.select("word", "root")
        chains = longer.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """Words of ``documents`` with the form they are a variant of.

    Returns ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: a word's form is its most frequent
    near word (ties: smallest in code-point order) if that is at least ``DOMINANCE`` times as frequent,
    else null; ``root`` follows forms to the last. Takes ``doc_id`` and ``text``; other columns, whatever
    their names, are not read. A null or empty text has no words; a null doc_id counts as an empty
    one where runs are marked. Repeated rows count each time. A text of any length is read whole, and a
    word may be of any length. Without words the result is empty.
    """
    words = stage(word_counts(docs), "words")
    best = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near"))).alias("best")
    )
    dominates = -F.col("best.rank") >= DOMINANCE * F.col("n")
    facts = stage(
        words.join(best, "word", "left").select(
            "word",
            F.when(dominates, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(dominates, -F.col("best.rank")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(facts.filter(F.col("form").isNotNull()))
    found = facts.join(last, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(table(spark, sf_dir, "documents"))


#: The same in SQL: edits are found by equal rests after one deletion.
ORACLE_SQL = r"""
WITH RECURSIVE
steps AS (SELECT i, i AS crc, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(crc ORDER BY i) AS entries FROM steps WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run FROM documents)),
grouped AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
bytes AS (
  SELECT id, run, n, list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(id || run, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))) AS bytes
  FROM grouped),
hashed AS (
  SELECT run, n, xor(list_reduce(bytes, lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc_table),
kept AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
  FROM hashed),
words AS (
  SELECT word, sum(n)::BIGINT AS n, length(word) AS size FROM kept WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
shorter AS (
  SELECT word, n, size, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, size, unnest(range(1, size + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
ranked AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
  row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM near),
facts AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
    CASE WHEN r.near_n >= 10 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 10 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
chains AS (
  SELECT word, word AS root, 0 AS step FROM facts
  UNION ALL
  SELECT c.word, f.form, c.step + 1 FROM chains c JOIN facts f ON f.word = c.root WHERE f.form IS NOT NULL),
lasts AS (SELECT word, arg_max(root, step) AS root FROM chains GROUP BY word)
SELECT f.word, f.form, l.root, f.n, f.n_near, f.form_n FROM facts f JOIN lasts l USING (word)
"""
