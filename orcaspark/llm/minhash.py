"""Near-duplicate texts by Order MinHash.

A text's shingles of two words are labelled with their occurrence. Each of many hash
functions picks the two least labelled shingles, and they are kept in their order in the
text: two texts agree in such a pair if they share the shingles and their order, so
agreement follows edit similarity and not only the sets. Short texts get pairs of single
words besides. Texts that agree in a pair are candidates; a banded alignment of their words
verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, plain_names, releasing, short_batches, table, texts
from orcaspark.llm.graph import components
from orcaspark.operators.rows import lookup_join
from orcaspark.session import stage, tune, unstage

#: Words of a shingle, hash functions, and least edit similarity. One word in five changed leaves
#: a third to a half of the two-word shingles, and an agreement of nearly 1 over all functions.
SHINGLE, FUNCTIONS, SIMILARITY = 2, 48, 0.8
#: Texts of so many words at most also have pairs of single words.
SHORT = 40
#: Bins of a bag of words (powers of two; about a quarter of the words), and nodes of a section of a bucket if their
#: bags are the widest fine ones; sections of narrower bags hold more, so that every two sections are about the same work.
LEAST_BINS, MOST_BINS, SECTION = 32, 1024, 512
#: Bins of a fine bag for each of a coarse one: twice as many as words.
FINER = 8
#: Hash values computed at a time for one text; word hashes a worker keeps.
VALUES, KEPT = 2_000_000, 200_000
#: Cells of an alignment row computed at a time, the band tried first, and rows after which pairs are looked through.
CELLS, FIRST_BAND, LOOK = 100_000, 12, 16
#: Rounds in which each node meets one centre, before all centres of other classes are met.
ROUNDS = 1
#: Pairs of texts that are words in memory at a time.
PAIRS = 128

_rng = np.random.default_rng(10)
_ODD = _rng.integers(1 << 62, 1 << 63, (2, FUNCTIONS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(0, 1 << 63, (2, FUNCTIONS), dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def scrambled(values: np.ndarray) -> np.ndarray:
    """Bijective mix of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX1
    values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word; starts anew when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT:
            self.clear()
        found = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return found

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def words_of(text: str) -> list[str]:
    """Lower-cased words between white space: texts with the same words are copies."""
    return text.lower().split()


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Order MinHash values of a text given its words' hashes; none without words."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    return order_pairs(hashes, min(SHINGLE, len(hashes)), _ODD[0], _SALT[0])


def values_of(hashes: np.ndarray) -> np.ndarray:
    """Values of a text by which it meets candidates: its sketch, and a short text's pairs of single words."""
    found = sketch(hashes)
    if 0 < len(hashes) <= SHORT:
        found = np.concatenate([found, order_pairs(hashes, 1, _ODD[1], _SALT[1])])
    return found


def order_pairs(hashes: np.ndarray, width: int, odd: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The two least shingles of ``width`` words by each function, in the order of the text, as one value."""
    count = len(hashes) - width + 1
    shingles = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        shingles = shingles * _STEP + hashes[i : i + count]
    shingles = scrambled(shingles)
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    if not new.all():  # the occurrence of a shingle within the text is part of it
        place = np.arange(count)
        occurrence = np.empty(count, dtype=np.uint64)
        occurrence[order] = place - np.maximum.accumulate(np.where(new, place, 0))
        shingles = np.where(occurrence > 0, scrambled(shingles + occurrence * _STEP), shingles)
    found = np.empty(FUNCTIONS, dtype=np.uint64)
    at_once = max(1, VALUES // count)
    for begin in range(0, FUNCTIONS, at_once):
        part = slice(begin, min(begin + at_once, FUNCTIONS))
        values = (shingles[None, :] ^ salt[part, None]) * odd[part, None]
        rows = np.arange(len(values))
        first = values.argmin(axis=1)
        if count > 1:
            values[rows, first] = np.iinfo(np.uint64).max
            second = values.argmin(axis=1)
            early, late = np.minimum(first, second), np.maximum(first, second)
            pair = scrambled(shingles[early] + _STEP) * _STEP + shingles[late]
        else:
            pair = shingles[first]
        found[part] = scrambled(pair + salt[part])
    return found.view(np.int64)


def bag_of(hashes: np.ndarray, finer: int = 1) -> bytes:
    """How many words fall into each bin; halving the bins adds bin ``i`` and ``i + size / 2``.

    The first byte is the width of the counts, which are as wide as the greatest needs.
    """
    size = finer * min(MOST_BINS, max(LEAST_BINS, 1 << (len(hashes) // 4).bit_length()))
    counts = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size)
    width = next(w for w in (1, 2, 4, 8) if counts.max() < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def bins_of(bag: bytes) -> np.ndarray:
    return np.frombuffer(bag, dtype=f"<u{bag[0]}", offset=1).astype(np.int64)


def fewest_edits(a: np.ndarray, b: np.ndarray) -> int:
    """Least edits between texts with these bins: words that one has more often than the other."""
    size = min(len(a), len(b))
    more = a.reshape(-1, size).sum(axis=0) - b.reshape(-1, size).sum(axis=0)
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` (hash of the words), ``n_words``, ``values`` and ``bag`` of every row; key null without words."""
    hashes = WordHashes()

    def convert(batch: pa.RecordBatch) -> dict:
        keys, counts, values, bags = [], [], [], []
        for text in texts(batch["text"]):
            words = words_of(text)
            own = hashes.of(words)
            keys.append(key_of(own))
            counts.append(len(words))
            values.append(values_of(own))
            bags.append(bag_of(own))
        return {
            "doc_id": batch["doc_id"],
            "key": pa.array(keys, pa.binary()),
            "n_words": pa.array(counts, pa.int64()),
            "values": pa.array(values, pa.list_(pa.int64())),
            "bag": pa.array(bags, pa.binary()),
        }

    schema = "doc_id bigint, key binary, n_words bigint, values array<bigint>, bag binary"
    return per_batch(docs.select("doc_id", "text"), convert, schema)


# -- Alignment ---------------------------------------------------------------------------


def numbered(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Words as numbers, and a lower bound of the edits: words that one text has more often than the other."""
    numbers: dict[str, int] = {}
    x, y = (np.array([numbers.setdefault(w, len(numbers)) for w in t], dtype=np.int32) for t in (a, b))
    more = np.bincount(x, minlength=len(numbers)) - np.bincount(y, minlength=len(numbers))
    return x, y, int(max(more[more > 0].sum(), -more[more < 0].sum()))


def banded(first: list[np.ndarray], second: list[np.ndarray], band: int) -> np.ndarray:
    """Edit distances of pairs, aligned together; a value of more than ``band`` only says that it is more.

    Row ``i`` holds the columns from ``i - band`` to ``i + band`` of all pairs.
    """
    sizes = np.array([len(x) for x in first])
    others = np.array([len(x) for x in second])
    rows, width = int(sizes.max(initial=0)), 2 * band + 1
    a = np.full((len(first), rows), -1, dtype=np.int32)
    b = np.full((len(second), rows + width), -2, dtype=np.int32)
    for i, (x, y) in enumerate(zip(first, second, strict=True)):
        a[i, : len(x)] = x
        y = y[: rows + width - band]
        b[i, band : band + len(y)] = y
    far = np.int32(1 << 29)
    steps = np.arange(width, dtype=np.int32)
    row = np.where(steps >= band, steps - band, far)[None, :].repeat(len(first), axis=0)
    result = np.full(len(first), far, dtype=np.int32)
    place = np.arange(len(first))

    def settle(i: int) -> None:
        done = np.flatnonzero((sizes == i) & (np.abs(others - sizes) <= band))
        result[place[done]] = row[done, others[done] - sizes[done] + band]

    settle(0)
    for i in range(1, rows + 1):
        if i % LOOK == 0:  # edits never fall from row to row: pairs beyond the band stay there
            alive = (sizes >= i) & (row.min(axis=1) <= band)
            if not alive.any():
                break
            if alive.mean() < 0.8:
                place, sizes, others, a, b, row = (x[alive] for x in (place, sizes, others, a, b, row))
        diagonal = row + (a[:, i - 1 : i] != b[:, i - 1 : i - 1 + width])
        diagonal[:, :-1] = np.minimum(diagonal[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(diagonal - steps, axis=1) + steps
        settle(i)
    return result


def similar(pairs: list[tuple[list[str], list[str]]], least: float = SIMILARITY) -> list[bool]:
    """Whether the edit similarity, 1 - distance / longer length, of each pair of word lists is ``least`` or more.

    A narrow band decides most pairs; the rest get one twice as wide, up to the allowed edits.
    """
    found = [False] * len(pairs)
    open_pairs = []
    for i, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        allowed = int((1 - least) * longer + 1e-9)
        if a == b:
            found[i] = True
        elif abs(len(a) - len(b)) <= allowed:
            x, y, fewest = numbered(a, b)
            if fewest > allowed:
                continue
            shorter = min(len(x), len(y))
            differ = np.flatnonzero(x[:shorter] != y[:shorter])
            start = differ[0] if len(differ) else shorter
            differ = np.flatnonzero(x[::-1][: shorter - start] != y[::-1][: shorter - start])
            tail = differ[0] if len(differ) else shorter - start
            open_pairs.append((len(x) - tail - start, i, allowed, x[start : len(x) - tail], y[start : len(y) - tail]))
    open_pairs.sort(key=lambda p: p[0])
    limit = FIRST_BAND
    while open_pairs:
        left, group, band = [], [], 0
        for pair in [*open_pairs, None]:
            own = 0 if pair is None else min(pair[2], limit)
            wider = max(band, own)
            if group and (pair is None or (len(group) + 1) * (2 * wider + 1) > CELLS):
                distances = banded([p[3] for p in group], [p[4] for p in group], band)
                for p, distance in zip(group, distances.tolist(), strict=True):
                    if distance <= min(p[2], band):
                        found[p[1]] = True
                    elif band < p[2]:
                        left.append(p)
                group, wider = [], own
            if pair is not None:
                group.append(pair)
                band = wider
        open_pairs, limit = left, 2 * limit
    return found


@dataclass
class Source:
    """Where the facts on nodes come from: the documents, their sketches and the table of nodes."""

    docs: DataFrame
    rows: DataFrame
    nodes: DataFrame

    def sketches(self, of: DataFrame, *columns: str) -> DataFrame:
        """``node`` and sketch columns of the nodes ``of``, from the rows a node is named after (repeated rows repeat)."""
        wanted = of.select("node", F.col("key").alias("that_key"), F.col("doc_id").alias("that_id"))
        return self.rows.join(wanted, matching(self.rows)).select("node", *columns)

    def of_ids(self, pairs: DataFrame) -> DataFrame:
        """Nodes that stand in a pair."""
        ids = pairs.select("a").distinct().union(pairs.select("b").distinct()).toDF("node").distinct()
        return stage(self.nodes.join(ids, "node", "left_semi"), "wanted")

    def texts(self, of: DataFrame) -> DataFrame:
        """``node`` and ``text`` of the nodes ``of``; only rows with their ids are hashed."""
        wanted = of.select("node", F.col("key").alias("that_key"), F.col("doc_id").alias("that_id"))
        docs = self.docs.select("doc_id", "text")
        asked = docs.join(wanted.select("that_id").distinct(), docs["doc_id"].eqNullSafe(F.col("that_id")), "left_semi")
        sources = keyed(asked)
        return sources.join(wanted, matching(sources)).select("node", "text").dropDuplicates(["node"])


def within_bags(pairs: DataFrame, bags: DataFrame, least: float) -> DataFrame:
    """Pairs ``a``, ``b`` whose bags of words allow the similarity; ``longer`` is the longer text's words."""
    both = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("a_bag")), "a")
    both = both.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("b_bag")), "b")

    def convert(batch: pa.RecordBatch) -> dict:
        bounds = zip(batch["a_bag"].to_pylist(), batch["b_bag"].to_pylist(), batch["longer"].to_pylist(), strict=True)
        kept = pa.array([fewest_edits(bins_of(x), bins_of(y)) <= (1 - least) * n + 1e-6 for x, y, n in bounds], pa.bool_())
        return {"a": batch["a"].filter(kept), "b": batch["b"].filter(kept)}

    return per_batch(both.select("a", "b", "longer", "a_bag", "b_bag"), convert, "a bigint, b bigint").distinct()


def verified(pairs: DataFrame, source: Source, least: float = SIMILARITY) -> DataFrame:
    """Staged pairs ``a``, ``b`` of nodes whose texts are similar.

    Bags rule pairs with ``longer`` out before any text is read; those without it have passed finer ones. The second text is fetched first, so the join on the
    first, a centre of many pairs, is the one with hot keys, and it is a plain join that can be split.
    """
    over, possible = [], pairs
    if "longer" in pairs.columns:
        pairs = stage(pairs, "pairs")
        asked = source.of_ids(pairs)
        bags = source.sketches(asked, "bag").dropDuplicates(["node"])
        possible = stage(within_bags(pairs, bags, least), "possible")
        over = [pairs, asked, possible]
    wanted = source.of_ids(possible)
    wording = stage(source.texts(wanted), "wording")
    b = possible.join(wording.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
    both = b.join(wording.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")

    def convert(batch: pa.RecordBatch) -> dict:
        linked = []
        for begin in range(0, len(batch), PAIRS):
            few = batch.slice(begin, PAIRS)
            texts_of_few = zip(few["a_text"].to_pylist(), few["b_text"].to_pylist(), strict=True)
            linked += similar([(words_of(x), words_of(y)) for x, y in texts_of_few], least)
        linked = pa.array(linked, pa.bool_())
        return {"a": batch["a"].filter(linked), "b": batch["b"].filter(linked)}

    links = stage(per_batch(both.select("a", "b", "a_text", "b_text"), convert, "a bigint, b bigint").distinct(), "links")
    unstage(*over, wanted, wording)
    return links


# -- Classes -----------------------------------------------------------------------------


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Near-duplicate class of every row of ``docs``: ``doc_id``, ``class_id``, ``kept``, ``n_words``, ``key``.

    ``class_id`` is the smallest doc_id of the class, ``kept`` is true for the rows of that
    id with the text of its first row (the smallest key). Texts with the same words, case and spacing aside,
    are one node. Nodes with an equal value are a bucket, whose centres are its least and its
    greatest node. Each node is first compared with the centre that it shares most buckets with, which
    joins large groups at the cost of their size; then with every centre that is still of another class.
    Where the other members of a bucket are still of several classes, every two of
    different classes are compared (``remaining_pairs``): so any two similar members of a
    bucket end in one class.
    Null and empty texts have no words and are classes of their own (class_id = doc_id).
    Null ids take part; a class with null ids only has a null class_id.
    """
    with short_batches(tune(docs.sparkSession)):
        return classes_of(docs, least)


def classes_of(docs: DataFrame, least: float) -> DataFrame:
    """``classes``; all its jobs that read texts run here."""
    source = described(docs)
    members = stage(bucketed(source), "members")
    spokes = stage(centre_pairs(members, source.nodes, least), "spokes")
    if spokes.isEmpty():
        labels = None
    else:
        labels, open_pairs, tried = None, spokes, []
        for _ in range(ROUNDS):
            best = F.struct("shared", -F.col("a"))
            nearest = open_pairs.groupBy("b").agg(F.max_by(F.struct("a", "longer"), best).alias("best"))
            tried.append(stage(nearest.select("best.a", "b", "best.longer"), "nearest"))
            labels = united(labels, verified(tried[-1], source, least))
            seen = reduce(DataFrame.union, tried).select("a", "b")
            open_pairs = stage(across(spokes, labels).join(seen, ["a", "b"], "left_anti"), "open")
        labels = united(labels, verified(open_pairs.drop("shared"), source, least))
        left = stage(remaining_pairs(labelled(members, labels), source, least), "left")
        if not left.isEmpty():
            labels = united(labels, verified(left.drop("longer"), source, least))
        unstage(*tried, open_pairs, left)
    found = assigned(source.rows, source.nodes, labels)
    unstage(members, spokes)
    return found


def described(docs: DataFrame) -> Source:
    """Sketches of all rows, and the numbered nodes: one for each key, named after its smallest doc_id."""
    rows = stage(sketched(docs), "sketches")
    nodes = rows.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"))
    return Source(docs, rows, stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes"))


def bucketed(source: Source) -> DataFrame:
    """Members of buckets with several nodes: ``bucket``, ``node``, ``first``, ``last`` (its centres)."""
    members = source.sketches(source.nodes, F.explode("values").alias("bucket"))
    centres = members.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last"))
    return lookup_join(members, centres.filter("first <> last"), ["bucket"], "inner")


def centre_pairs(members: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Each centre ``a`` with each other member ``b`` of its buckets and their number, ``shared``, if lengths allow the similarity."""
    pairs = members.select(F.col("first").alias("a"), F.col("node").alias("b")).union(
        members.filter("node <> first").select(F.col("last").alias("a"), F.col("node").alias("b"))
    )
    pairs = pairs.filter("a <> b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    sizes = nodes.select("node", "n_words")
    for end in ("a", "b"):
        pairs = lookup_join(pairs, sizes.toDF(end, f"{end}_words"), [end], "inner")
    longer = F.greatest("a_words", "b_words")
    fitting = F.abs(F.col("a_words") - F.col("b_words")) <= (1 - least) * longer + 1e-6
    return pairs.filter(fitting).select("a", "b", "shared", longer.alias("longer"))


def across(pairs: DataFrame, labels: DataFrame, ends: bool = False) -> DataFrame:
    """Pairs of nodes that are still of different classes, or their classes (``ends``); a node without links is a class."""
    found = pairs
    for end in ("a", "b"):
        found = lookup_join(found, labels.toDF(end, f"{end}_label"), [end])
        found = found.withColumn(f"{end}_label", F.coalesce(f"{end}_label", end))
    found = found.filter("a_label <> b_label")
    return found.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")) if ends else found.select(*pairs.columns)


def united(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Classes so far (``node``, ``label``) after more links, which count as edges between classes."""
    if labels is None:
        return components(links)
    merged = components(across(links, labels, ends=True))
    new = merged.join(labels, "node", "left_anti").select("node", "label")
    moved = lookup_join(labels, merged.select(F.col("node").alias("label"), F.col("label").alias("further")), ["label"])
    return stage(moved.select("node", F.coalesce("further", "label").alias("label")).union(new), "labels")


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with the class so far as ``label``; a node without links is a class."""
    found = lookup_join(members, labels, ["node"])
    return stage(found.withColumn("label", F.coalesce("label", "node")), "members")


def remaining_pairs(members: DataFrame, source: Source, least: float) -> DataFrame:
    """Pairs ``a``, ``b``, ``longer`` of different classes in a bucket that no centre settled and that may be similar.

    The centres, the least and the greatest node, have met every member. A large bucket is
    dealt to sections, and each pair of sections is a part of bounded size. Lengths and the
    difference of the bags of words bound the edits from below, so only pairs are left out
    whose alignment would fail. The sketches' bags find the members with a possible partner; only
    these are compared once more, by fine bags made from their texts, and make pairs.
    """
    others = members.filter("node <> first and node <> last")
    mixed = others.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    others = others.join(stage(mixed.filter("low <> high").select("bucket"), "mixed"), "bucket", "left_semi")
    others = stage(others.select("bucket", "node", "label"), "others")
    asked = source.nodes.join(others.select("node").distinct(), "node", "left_semi")
    bags = stage(source.sketches(asked, "n_words", "bag").dropDuplicates(["node"]), "bags")

    def partnered(run: pa.Table) -> dict:
        a, b, _ = possible_pairs(run, least)
        found = np.union1d(a, b)
        return {"bucket": pa.array(np.full(len(found), run["bucket"][0].as_py())), "node": pa.array(found)}

    def paired(run: pa.Table) -> dict:
        a, b, longer = possible_pairs(run, least)
        return {"a": pa.array(a), "b": pa.array(b), "longer": pa.array(longer)}

    close = stage(by_part(others, bags, partnered, "bucket bigint, node bigint").distinct(), "close")
    asked = stage(source.nodes.join(close.select("node").distinct(), "node", "left_semi"), "wanted")
    fine = stage(fine_bags(source.texts(asked)), "fine")
    nearer = others.join(close, ["bucket", "node"], "left_semi")
    found = stage(by_part(nearer, fine, paired, "a bigint, b bigint, longer bigint").distinct(), "nearer")
    unstage(bags, close, asked, fine)
    return found


def fine_bags(texts_of_nodes: DataFrame) -> DataFrame:
    """``node``, ``n_words`` and a fine ``bag`` of texts of nodes."""
    hashes = WordHashes()

    def convert(batch: pa.RecordBatch) -> dict:
        own = [hashes.of(words_of(text)) for text in texts(batch["text"])]
        return {
            "node": batch["node"],
            "n_words": pa.array([len(x) for x in own], pa.int64()),
            "bag": pa.array([bag_of(x, FINER) for x in own], pa.binary()),
        }

    return per_batch(texts_of_nodes, convert, "node bigint, n_words bigint, bag binary")


def by_part(others: DataFrame, bags: DataFrame, convert: Callable[[pa.Table], dict], schema: str) -> DataFrame:
    """``convert`` of the members of each part of a bucket, with their ``n_words`` and ``bag``.

    Comparing a bag with another takes as many steps as the narrower has bins, so every two of ``n`` bags take ``n`` times
    all their bins at most. A pair of sections gets no more of it than two of ``SECTION`` of the widest fine bags.
    """
    widths = bags.select("node", (F.octet_length("bag") - 1).alias("bins"))
    steps = F.count("*") * F.sum("bins") / (FINER * MOST_BINS)
    sizes = others.join(widths, "node").groupBy("bucket").agg(F.ceil(F.sqrt(steps) / SECTION).cast("int").alias("sections"))
    rows = others.join(stage(sizes, "sizes"), "bucket")
    rows = rows.withColumn("section", F.pmod(F.xxhash64("node"), F.col("sections")).cast("int"))
    rows = rows.join(bags, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sections") - 1)))
    part = F.least("section", "other") * F.col("sections").cast("bigint") + F.greatest("section", "other")
    rows = rows.select("bucket", part.alias("part"), "section", "node", "label", "n_words", "bag")
    rows = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in runs(batches):
            yield pa.RecordBatch.from_pydict(convert(members))

    return rows.mapInArrow(releasing(run), schema)


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows with the same bucket and part; runs may span batches."""
    held, name = [], None
    for batch in batches:
        if not len(batch):
            continue
        buckets, parts = batch["bucket"].to_numpy(), batch["part"].to_numpy()
        cuts = np.flatnonzero((buckets[1:] != buckets[:-1]) | (parts[1:] != parts[:-1])) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
            if held and name != (buckets[begin], parts[begin]):
                yield pa.Table.from_batches(held)
                held = []
            name = buckets[begin], parts[begin]
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held)


def possible_pairs(run: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a part's nodes of different classes whose lengths and bags allow the similarity, and the longer length.

    Where the part holds two sections, only pairs across them.
    """
    run = run.take(pa.array(np.argsort(run["n_words"].to_numpy(), kind="stable")))
    nodes, labels, n_words, sections = (run[c].to_numpy() for c in ("node", "label", "n_words", "section"))
    two = sections.min() != sections.max()
    bags = [bins_of(x).astype(np.int32) for x in run["bag"].to_pylist()]
    # Longer texts have no fewer bins, so those from i on fold to the bins of i.
    stops = np.searchsorted(n_words * least, n_words + 1e-6, side="right")
    first, second, folded, size, begin = [], [], None, 0, 0
    for i, bag in enumerate(bags):
        if len(bag) != size:
            size, begin = len(bag), i
            folded = np.array([x.reshape(-1, size).sum(axis=0, dtype=np.int32) for x in bags[i:]])
        near = np.arange(i + 1, stops[i])
        near = near[labels[near] != labels[i]]
        if two:
            near = near[sections[near] != sections[i]]
        if len(near):
            more = folded[near - begin] - folded[i - begin]
            fewest = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
            near = near[fewest <= (1 - least) * n_words[near] + 1e-6]
            first.append(np.full(len(near), i))
            second.append(near)
    i = np.concatenate([np.zeros(0, np.int64), *first])
    j = np.concatenate([np.zeros(0, np.int64), *second])
    return np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j]), n_words[j]


def key_of(hashes: np.ndarray) -> bytes | None:
    """Name of a text by its words; None without words."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``key``, the name of its text's words (a column of that name is replaced)."""
    kept = [f for f in docs.schema.fields if f.name != "key"]
    hashes = WordHashes()

    def convert(batch: pa.RecordBatch) -> dict:
        keys = [key_of(hashes.of(words_of(text))) for text in texts(batch["text"])]
        return {f.name: batch[f.name] for f in kept} | {"key": pa.array(keys, pa.binary())}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return per_batch(docs.select(*[f"`{f.name}`" for f in kept]), convert, f"{schema}, key binary")


def assigned(rows: DataFrame, nodes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Class of each row from its node's label; rows without words need no join."""
    if labels is None:
        heads = nodes.select("key", F.col("doc_id").alias("class_id"), F.col("key").alias("head"))
    else:
        named = nodes.select("node", "key", "doc_id").join(labels, "node", "left")
        named = stage(named.withColumn("label", F.coalesce("label", "node")), "labelled")
        least = named.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("least"))
        least = least.select("label", F.col("least.doc_id").alias("class_id"), F.col("least.key").alias("head"))
        heads = lookup_join(named, stage(least, "least"), ["label"], "inner").select("key", "class_id", "head")
    heads = stage(heads, "heads")
    worded = lookup_join(rows.filter("key is not null").select("doc_id", "n_words", "key"), heads, ["key"])
    alone = rows.filter("key is null").select("doc_id", "n_words", "key")
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("key") == F.col("head"))
    return worded.select("doc_id", "class_id", kept.alias("kept"), "n_words", "key").union(
        alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("kept"), "n_words", "key")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: that with the class id, and one of rows that repeat it.

    Rows whose text has no words all stay. Columns and their order are those of ``docs``.
    """
    docs, back = plain_names(docs, ("doc_id", "text"))
    found = stage(classes(docs), "classes")
    same = ["doc_id", "key"]
    dropped = stage(found.filter(~F.col("kept")).select(*same).distinct(), "dropped")
    named = keyed(docs)
    left = named.join(renamed(dropped), matching(named), "left_anti")
    repeated = found.filter("kept and key is not null").groupBy(*same).count().filter("count > 1").select(*same)
    repeated = stage(repeated, "repeated")
    if not repeated.isEmpty():
        again = renamed(repeated)
        once = left.join(again, matching(left), "left_anti")
        left = once.union(left.join(again, matching(left), "left_semi").dropDuplicates(same))
    return back(left)


def renamed(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("doc_id").alias("that_id"), F.col("key").alias("that_key"))


def matching(rows: DataFrame):
    return rows["doc_id"].eqNullSafe(F.col("that_id")) & (rows["key"] == F.col("that_key"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return classes(table(spark, sf_dir, "documents")).drop("key")
