"""Language-model scores by a log-bilinear model trained with noise-contrastive estimation.

The model predicts the class of a token from the two tokens before it: the prediction is
the sum of the context's embeddings, each weighted by its position, and a class's score is
the prediction's product with the class's embedding plus a bias. Frequent words are classes of
their own. All other words are classed by their last two code points, and such a class
shares its probability among its words, and one unknown word, by their counts in the corpus.

Counts cover all training texts and stay a table. Texts are encoded once, as the classes of their
tokens. Training reads all training texts as well:
every task improves a copy of the parameters on its partition by contrasting each token
with noise classes, and the copies are averaged by tokens, in rounds. Scores are normalised: matrix
products give the sums over all classes for every context of two classes, once and for all.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import gathered, per_batch, raw_texts, table
from orcaspark.session import stage

#: The end of a text, counted as a token; no word is empty.
END = b""
#: Words whose counts every task holds, at most; classes of single words and of endings, at most.
HEAD, WORDS, ENDINGS = 1 << 17, 640, 127
#: Counts are put in so many levels per factor of two to find the head.
LEVELS = 64
#: Words of context; dimensions; noise classes of a step; tokens of a step; rate of Adagrad.
CONTEXT, DIMENSIONS, NOISE, STEP, RATE = 2, 24, 32, 1024, 0.15
#: Share of the training texts that each round learns from.
ROUNDS = (0.125, 1.0)
#: Bytes of a text read at a time, tokens scored at a time.
PIECE, BLOCK = 1 << 20, 1 << 17

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def tokens_of(raw: bytes) -> Iterator[list[bytes]]:
    """Tokens of a text in lists of bounded size: words, A-Z lower-cased, then ``END``."""
    begin = 0
    while begin < len(raw):
        cut = _BLANK.search(raw, begin + PIECE) if len(raw) - begin > PIECE else None
        stop = cut.start() if cut else len(raw)
        yield raw[begin:stop].lower().split()
        begin = stop
    yield [END]


def in_training(doc_id: Column) -> Column:
    """Whether a document is learnt from; a null id counts as an empty one, which is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != 1


def word_counts(docs: DataFrame) -> DataFrame:
    """Tokens of all texts with their counts: ``word``, ``n``; the end is the empty word."""

    def convert(batch: pa.RecordBatch) -> dict:
        counts: Counter[bytes] = Counter()
        for raw in raw_texts(batch["text"]):
            for piece in tokens_of(raw):
                counts.update(piece)
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return {"word": words, "n": pa.array(list(counts.values()), pa.int64())}

    return per_batch(docs.select("text"), convert, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def ending(word: bytes) -> str:
    """Last two code points of a word."""
    return word[-8:].decode(errors="ignore")[-2:]


@dataclass
class Vocabulary:
    """The corpus counts as every task needs them.

    ``index`` numbers the head's words; by number, ``logs`` is log10(count + 0.5), ``classes`` the class,
    and ``within`` log10 of the share of its class. ``endings`` gives the class of other words, the last
    class if there is none; ``masses`` are the log10 of what a class's shares are taken of, 0 for
    classes of one word. ``counts`` are the tokens of each class.
    """

    index: dict[bytes, int]
    logs: np.ndarray
    classes: np.ndarray
    within: np.ndarray
    endings: dict[str, int]
    masses: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def end(self) -> int:
        """Class of the end of a text."""
        return int(self.classed([END])[1][0])

    def class_of(self, word: bytes) -> int:
        return self.endings.get(ending(word), len(self.masses) - 1)

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def classed(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers, -1 outside of the head, and classes of the words."""
        numbers = self.numbers(words)
        classes = self.classes[numbers] if len(self.classes) else np.zeros(len(words), dtype=np.int64)
        for place in np.flatnonzero(numbers < 0):
            classes[place] = self.class_of(words[place])
        return numbers, classes


def least_head_count(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach, from the numbers of words by level of their counts."""
    level = F.floor(F.log2("n") * LEVELS)
    found = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, words = 1 << 62, 0
    for row in sorted(found, key=lambda r: -r["level"]):
        words += row["words"]
        if words > most:
            break
        least = row["least"]
    return least


def vocabulary(counts: DataFrame, head: int = HEAD, words: int = WORDS, endings: int = ENDINGS) -> tuple[Vocabulary, int]:
    """Vocabulary of a count table and the least count of its head; collects ``head`` rows at most."""
    spark = counts.sparkSession
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = least_head_count(counts, head)
    top = sorted(((r["n"], r["word"].encode()) for r in counts.filter(F.col("n") >= least).collect()), key=lambda r: (-r[0], r[1]))
    single = top[:words]
    known = spark.createDataFrame([(w.decode(),) for _, w in single], "word string")
    rare = counts.join(F.broadcast(known), "word", "left_anti")
    by_ending = rare.groupBy(F.right("word", F.lit(2)).alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    by_ending = stage(by_ending, "endings")
    common = by_ending.orderBy(F.col("n").desc(), "ending").limit(endings).collect()
    whole = by_ending.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words")).first()
    groups = [(r["n"], r["words"]) for r in common]
    groups.append((whole["n"] - sum(n for n, _ in groups), whole["words"] - sum(w for _, w in groups)))
    masses = np.array([0.0] * len(single) + [np.log10(n + 0.5 * (w + 1)) for n, w in groups])
    classes = {r["ending"]: len(single) + i for i, r in enumerate(common)}
    logs = np.log10(np.array([n for n, _ in top], dtype=np.float64) + 0.5)
    own = [i if i < len(single) else classes.get(ending(w), len(masses) - 1) for i, (_, w) in enumerate(top)]
    own = np.array(own, dtype=np.int64)
    return Vocabulary(
        index={w: i for i, (_, w) in enumerate(top)},
        logs=logs,
        classes=own,
        within=np.where(own < len(single), 0.0, logs - masses[own]),
        endings=classes,
        masses=masses,
        counts=np.array([n for n, _ in single] + [n for n, _ in groups], dtype=np.float64),
        tokens=tokens,
        distinct=distinct,
    ), least


def token_blocks(column: pa.Array, end: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, histories and classes of the tokens of a column of class lists, ``BLOCK`` tokens at a time.

    A history is the class before the token and the one before that; before a text stand ends of texts.
    """
    lengths = pc.list_value_length(column).to_numpy()
    flat = column.flatten().to_numpy()
    begins = (np.cumsum(lengths) - lengths)[lengths > 0]
    nearest, further = np.roll(flat, 1), np.roll(flat, 2)
    nearest[begins] = further[begins] = end
    seconds = begins[lengths[lengths > 0] > 1] + 1
    further[seconds] = end
    rows = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    for begin in range(0, len(flat), BLOCK):
        some = slice(begin, begin + BLOCK)
        history = np.stack([nearest[some], further[some]], axis=1).astype(np.int64)
        yield rows[some], history, flat[some].astype(np.int64)


def summed(values: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sums of the ``values`` of equal ``rows``, as a matrix of ``count`` rows."""
    columns = [np.bincount(rows, column, count) for column in np.ascontiguousarray(values.T)]
    return np.stack(columns, axis=1).astype(values.dtype)


def logistic(values: np.ndarray) -> np.ndarray:
    out = np.tanh(values * 0.5)
    out += 1
    out *= 0.5
    return out


@dataclass
class Model:
    """Parameters: embeddings of context and predicted classes, weights by position, biases."""

    context: np.ndarray
    target: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def untrained(cls, counts: np.ndarray, seed: int = 11) -> Model:
        """Predicts every class by its share of the tokens, whatever the context."""
        rng = np.random.default_rng(seed)
        context = rng.normal(0, 0.3, (len(counts), DIMENSIONS)).astype(np.float32)
        weights = np.ones((CONTEXT, DIMENSIONS), dtype=np.float32)
        return cls(context, np.zeros_like(context), weights, np.log(noise(counts)).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.weights, self.bias]

    def predictions(self, history: np.ndarray) -> np.ndarray:
        out = self.context[history[:, 0]] * self.weights[0]
        for i in range(1, CONTEXT):
            out += self.context[history[:, i]] * self.weights[i]
        return out

    def gradients(self, history: np.ndarray, token: np.ndarray, drawn: np.ndarray, odds: np.ndarray) -> list[np.ndarray]:
        """Mean gradients of the contrast between each token and all drawn noise classes.

        ``odds`` is the logarithm of the expected draws of each class. The logistic loss tells a token
        from noise by its score less these odds.
        """
        size = len(token)
        prediction = self.predictions(history)
        target = self.target[token]
        real = np.einsum("ij,ij->i", prediction, target) + self.bias[token] - odds[token]
        false = prediction @ self.target[drawn].T + (self.bias[drawn] - odds[drawn])
        real = (logistic(real) - 1) / size
        false = logistic(false) / size
        back = real[:, None] * target + false @ self.target[drawn]
        classes = len(self.bias)
        to_target = summed(np.concatenate([real[:, None] * prediction, false.T @ prediction]), np.concatenate([token, drawn]), classes)
        to_bias = np.bincount(token, real, classes) + np.bincount(drawn, false.sum(axis=0), classes)
        to_context = summed(np.concatenate([back * w for w in self.weights]), history.T.ravel(), classes)
        to_weights = np.stack([(back * self.context[history[:, i]]).sum(axis=0) for i in range(CONTEXT)])
        return [to_context, to_target, to_weights, to_bias.astype(np.float32)]

    def totals(self, nearest: int) -> np.ndarray:
        """Logarithms of the sums over all classes, after ``nearest`` and each class before it."""
        classes = len(self.bias)
        history = np.stack([np.full(classes, nearest), np.arange(classes)], axis=1)
        scores = self.predictions(history) @ self.target.T
        scores += self.bias
        top = scores.max(axis=1)
        scores -= top[:, None]
        return top + np.log(np.exp(scores, out=scores).sum(axis=1))

    def log10_probabilities(self, history: np.ndarray, token: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """log10 of the normalised probability of each token's class after its history."""
        own = np.einsum("ij,ij->i", self.predictions(history), self.target[token]) + self.bias[token]
        return (own - totals[history[:, 0], history[:, 1]]) / np.log(10)


def all_totals(spark: SparkSession, model: Model) -> np.ndarray:
    """``Model.totals`` of every history, a matrix of all classes by all: a matrix product for each nearest class."""
    sent = spark.sparkContext.broadcast(model)
    classes = len(model.bias)

    def convert(batch: pa.RecordBatch) -> dict:
        rows = [sent.value.totals(nearest) for nearest in batch["id"].to_pylist()]
        return {"id": batch["id"], "totals": pa.array(rows, pa.list_(pa.float32()))}

    rows = per_batch(spark.range(0, classes, 1, min(classes, 24)), convert, "id bigint, totals array<float>").collect()
    return np.array([r["totals"] for r in sorted(rows, key=lambda r: r["id"])], dtype=np.float32)


def noise(counts: np.ndarray) -> np.ndarray:
    """Shares of the classes that noise is drawn by; half a token is added to each."""
    return (counts + 0.5) / (counts.sum() + 0.5 * len(counts))


def trained_round(texts: DataFrame, words: Vocabulary, start: Model, rate: float) -> Model:
    """``start`` improved on every partition by one pass over its encoded texts, averaged by their tokens."""
    counts, end = words.counts, words.end
    sent = texts.sparkSession.sparkContext.broadcast(start)

    def fold(batches: Iterator[pa.RecordBatch]) -> tuple[int, list[np.ndarray]] | None:
        start = sent.value
        model = Model(*[p.copy() for p in start.parts()])
        past = [np.full_like(p, 1e-6) for p in start.parts()]
        rng = np.random.default_rng(13)
        shares = noise(counts)
        border = np.cumsum(shares)
        odds = (np.log(shares) + np.log(NOISE)).astype(np.float32)
        seen = 0
        for history, token in steps(batches, end):
            drawn = np.minimum(np.searchsorted(border, rng.random(NOISE)), len(border) - 1)
            for part, old, gradient in zip(model.parts(), past, model.gradients(history, token, drawn, odds), strict=True):
                old += gradient**2
                part -= rate * gradient / np.sqrt(old)
            seen += len(token)
        return (seen, [p.astype(np.float64) * seen for p in model.parts()]) if seen else None

    def merge(a: tuple, b: tuple) -> tuple:
        return a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)]

    found = gathered(texts.select("classes"), fold, merge)
    return Model(*[(p / found[0]).astype(np.float32) for p in found[1]]) if found else start


def steps(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Histories and classes of all tokens, ``STEP`` at a time, mixed within blocks of texts."""
    rng = np.random.default_rng(17)
    for batch in batches:
        for _, history, token in token_blocks(batch["classes"], end):
            order = rng.permutation(len(token))
            for begin in range(0, len(order), STEP):
                some = order[begin : begin + STEP]
                yield history[some], token[some]


def train(texts: DataFrame, words: Vocabulary) -> Model:
    """Model of the classes, from all encoded ``texts``."""
    model = Model.untrained(words.counts)
    for number, share in enumerate(ROUNDS):
        chosen = F.pmod(F.xxhash64("row", F.lit(number)), F.lit(1 << 20)) < int(share * (1 << 20))
        model = trained_round(texts.filter(chosen) if share < 1 else texts, words, model, RATE / (number + 1))
    return model


ENCODED = (
    "doc_id {id}, held_out boolean, classes array<smallint>, n_known bigint, base double, share double,"
    " tail array<struct<word: string, tf: bigint>>"
)


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """Texts as the classes of their tokens, with what the head's counts add to their scores.

    ``base`` and ``share`` are sums over the words of the head, and for ``share`` over all masses;
    the counts of words outside of the head are missing in both and left in ``tail``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def convert(batch: pa.RecordBatch) -> dict:
        words = sent.value
        ids, known, base, share, tails = [], [], [], [], []
        for raw in raw_texts(batch["text"]):
            parts, rest, of_head, sums, shares = [], Counter(), 0, 0.0, 0.0
            for piece in tokens_of(raw):
                number, classes = words.classed(piece)
                parts.append(classes.astype(np.int16))
                outside = np.flatnonzero(number < 0)
                if len(outside):
                    rest.update([piece[i] for i in outside])
                    shares -= words.masses[classes[outside]].sum()
                    number = number[number >= 0]
                of_head += len(number)
                sums += words.logs[number].sum()
                shares += words.within[number].sum()
            ids.append(np.concatenate(parts))
            known.append(of_head)
            base.append(sums)
            share.append(shares)
            tails.append([{"word": w.decode(), "tf": n} for w, n in rest.items()])
        kind = pa.list_(pa.struct([("word", pa.string()), ("tf", pa.int64())]))
        return {
            "doc_id": batch["doc_id"],
            "held_out": batch["held_out"],
            "classes": pa.array(ids, pa.list_(pa.int16())),
            "n_known": pa.array(known, pa.int64()),
            "base": pa.array(base, pa.float64()),
            "share": pa.array(share, pa.float64()),
            "tail": pa.array(tails, kind),
        }

    rows = docs.select("doc_id", "text", (~in_training(F.col("doc_id"))).alias("held_out"))
    return per_batch(rows, convert, ENCODED.format(id=rows.schema["doc_id"].dataType.simpleString()))


def class_scores(texts: DataFrame, words: Vocabulary, model: Model) -> DataFrame:
    """Encoded texts with ``n_tokens`` and ``logs``, the sum of log10 of their classes' probabilities."""
    end = words.end
    sent = texts.sparkSession.sparkContext.broadcast((model, all_totals(texts.sparkSession, model)))
    kept = [f for f in texts.schema.fields if f.name not in ("classes", "tail")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, totals = sent.value
        for batch in batches:
            logs = np.zeros(len(batch))
            for row, history, token in token_blocks(batch["classes"], end):
                logs += np.bincount(row, model.log10_probabilities(history, token, totals), len(batch))
            columns = {f.name: batch[f.name] for f in kept}
            lengths = pc.list_value_length(batch["classes"]).cast(pa.int64())
            yield pa.RecordBatch.from_pydict(columns | {"n_tokens": lengths, "logs": pa.array(logs)})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return texts.drop("tail").mapInArrow(run, f"{schema}, n_tokens bigint, logs double")


def score_texts(docs: DataFrame) -> DataFrame:
    """Scores of all texts by counts and by the model, learnt from the documents that aren't held out.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, one row
    a document. Takes ``doc_id`` and ``text``; other columns, whatever their names, are not read. A null text is
    empty, and an empty text is one token, the end. A null doc_id counts as an empty one and is learnt
    from. Repeated rows count, and come out, each time. A text of any length is read whole, in pieces. Without
    documents to learn from every word is unknown and scores are finite.

    The probabilities of all words of a class, and of one unknown word a class, add up to one over all classes.
    """
    docs = docs.select("doc_id", "text")
    learnt = docs.filter(in_training(F.col("doc_id")))
    counts = stage(word_counts(learnt), "counts")
    words, least = vocabulary(counts)
    texts = stage(encoded(docs, words).withColumn("row", F.monotonically_increasing_id()), "texts")
    scored = class_scores(texts, words, train(texts.filter(~F.col("held_out")), words))
    tail = texts.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.tf")
    rare = counts.filter(F.col("n") < least)
    logs = F.col("tf") * F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(0.5))
    sums = tail.join(rare, "word", "left").groupBy("row").agg(
        F.sum(logs).alias("rest"), F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("known")
    )
    rest = F.coalesce("rest", F.lit(0.0))
    whole = float(np.log10(words.tokens + 0.5 * (words.distinct + 1)))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + rest - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (F.col("logs") + F.col("share") + rest).alias("score"),
    )


def op11_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    return score_texts(table(spark, sf_dir, "documents"))
