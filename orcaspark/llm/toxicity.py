"""Toxicity by a convolutional text classifier trained in numpy.

A word is the mean of hashed embeddings: its own and those of its beginnings. Filters of
several widths run over the words of a text, each keeps its greatest response, and a
logistic layer turns these into a score. Every labelled row is learnt from: the rows are dealt
over shards of bounded size, the shards train at the same time, and what they learn is averaged
after each round. Thresholds are calibrated by language on labelled rows that the training did
not see; the language never enters a score.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orcaspark.llm.common import per_batch, raw_texts, releasing, table
from orcaspark.llm.licenses import words_of
from orcaspark.session import stage, unstage

#: Labelled rows of a shard, about; up to so many are trained on at once, without rounds.
SHARD_ROWS = 6000
#: Passes over all rows, or more over few, if there are several shards; their networks are averaged after each.
ROUNDS = 3
#: One in so many labelled rows calibrates the thresholds instead of training.
CALIBRATION = 6
BUCKETS, DIMENSIONS = 1 << 17, 12
#: Lengths of word beginnings with an embedding of their own.
BEGINNINGS = (4, 5, 6, 7)
WIDTHS, FILTERS = (1, 2, 3), 12
#: Embeddings are trained for buckets seen in so many training texts; others stay zero.
SEEN_IN = 2
#: Least passes over the training rows and least steps; texts of a step; Adam's rate; words left out; decay.
EPOCHS, STEPS, BATCH, RATE, WORD_DROPOUT, DECAY = 8, 600, 32, 0.02, 0.3, 1e-3
#: Words convolved at a time, and words whose vectors a worker keeps.
CHUNK, KEPT = 50_000, 150_000


def buckets_of(word: bytes) -> list[int]:
    """Buckets of a word and of its beginnings."""
    parts = [b"=" + word] + [b"<" + word[:n] for n in BEGINNINGS if len(word) >= n]
    return [zlib.crc32(p) % BUCKETS for p in parts]


@dataclass
class Network:
    embeddings: np.ndarray  # buckets x dimensions
    filters: dict[int, np.ndarray]  # width -> (width * dimensions) x filters
    offsets: dict[int, np.ndarray]  # width -> filters
    weights: np.ndarray  # of all filters
    bias: float

    def responses(self, vectors: np.ndarray, starts: np.ndarray, barred: np.ndarray | None = None) -> tuple[np.ndarray, dict[int, tuple]]:
        """Greatest response of each filter per text, and by width all responses and the greatest.

        ``vectors`` holds the words of all texts, each text preceded and followed by zero
        rows so that no filter sees two texts; ``starts`` are the texts' first rows. No
        filter begins at the ``barred`` rows.
        """
        pooled, places = [], {}
        for width, matrix in self.filters.items():
            size = len(vectors)
            out = np.broadcast_to(self.offsets[width], (size, matrix.shape[1])).copy()
            for i in range(width):
                part = vectors[i:] @ matrix[i * DIMENSIONS : (i + 1) * DIMENSIONS]
                out[: size - i] += part
            if barred is not None:
                out[barred] = -np.inf
            best = np.maximum.reduceat(out, starts, axis=0)
            pooled.append(np.maximum(best, 0))
            places[width] = (out, best)
        return np.concatenate(pooled, axis=1), places

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.weights + self.bias


PAD = max(WIDTHS) - 1


class Vectors:
    """Rows for words: a growing table of word vectors, built anew when full."""

    def __init__(self, network: Network):
        self.network = network
        self.clear()

    def clear(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.table = np.zeros((1024, DIMENSIONS), dtype=np.float32)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        rows = self.rows
        new = [w for w in dict.fromkeys(words) if w not in rows]
        if len(rows) + len(new) > KEPT and rows:
            self.clear()
            rows, new = self.rows, list(dict.fromkeys(words))
        if new:
            first = len(rows) + 1  # row 0 is the zero vector
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            flat = [buckets_of(w) for w in new]
            sizes = np.array([len(f) for f in flat])
            sums = np.add.reduceat(self.network.embeddings[np.concatenate(flat)], np.cumsum(sizes) - sizes, axis=0)
            self.table[first : first + len(new)] = sums / sizes[:, None]
            rows.update(zip(new, range(first, first + len(new)), strict=True))
        return self.table[np.fromiter(map(rows.__getitem__, words), dtype=np.int64, count=len(words))]


class Scorer:
    def __init__(self, network: Network):
        self.network = network
        self.vectors = Vectors(network)

    def scores(self, documents: list[bytes]) -> np.ndarray:
        """Score of every text; texts are convolved in chunks, the maxima of a long one are joined."""
        network = self.network
        count = sum(m.shape[1] for m in network.filters.values())
        pooled = np.zeros((len(documents), count), dtype=np.float32)
        pending: list[tuple[int, list[bytes], bool, bool]] = []
        size = 0

        def flush() -> None:
            nonlocal pending, size
            if pending:
                found = self._pool([p[1:] for p in pending])
                np.maximum.at(pooled, [p[0] for p in pending], found)
            pending, size = [], 0

        for i, document in enumerate(documents):
            words = words_of(document)
            for begin in range(0, len(words), CHUNK):
                part = words[begin : begin + CHUNK + PAD]  # overlaps, so that no window is lost
                if size + len(part) > 2 * CHUNK:
                    flush()
                pending.append((i, part, begin > 0, begin + CHUNK < len(words)))
                size += len(part)
        flush()
        # A text without words has no response.
        return 1 / (1 + np.exp(-np.clip(network.logits(pooled), -30, 30)))

    def _pool(self, parts: list[tuple[list[bytes], bool, bool]]) -> np.ndarray:
        """Greatest responses in parts of texts; whether text stands before and behind each is told."""
        texts = [words for words, _, _ in parts]
        joined = [w for words in texts for w in words]
        looked_up = self.vectors.lookup(joined)
        sizes = np.array([len(w) for w in texts])
        starts, rows = layout(sizes)
        vectors = np.zeros((int(sizes.sum() + 2 * PAD * len(texts)), DIMENSIONS), dtype=np.float32)
        vectors[rows] = looked_up
        barred = [np.arange(s, s + PAD) for s, (_, before, _) in zip(starts, parts, strict=True) if before]
        barred += [
            np.arange(s + PAD + CHUNK, s + 2 * PAD + len(words))
            for s, (words, _, behind) in zip(starts, parts, strict=True)
            if behind
        ]
        return self.network.responses(vectors, starts, np.concatenate(barred) if barred else None)[0]


def layout(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows of texts laid out with zero rows around each, and the rows of their words."""
    padded = sizes + 2 * PAD
    starts = np.cumsum(padded) - padded
    return starts, np.arange(int(sizes.sum())) + np.repeat(starts + PAD - (np.cumsum(sizes) - sizes), sizes)


class Lexicon:
    """Texts as numbers of words, and the buckets of each word."""

    def __init__(self, documents: list[bytes]):
        numbers: dict[bytes, int] = {}
        self.texts = [
            np.array([numbers.setdefault(w, len(numbers)) for w in words_of(d)], dtype=np.int32) for d in documents
        ]
        lists = [buckets_of(w) for w in numbers]
        self.sizes = np.array([len(x) for x in lists], dtype=np.int32)
        self.begins = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        self.buckets = np.fromiter((b for x in lists for b in x), dtype=np.int32, count=int(self.sizes.sum()))

    def parts(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the words in turn, and the place of each bucket's word in ``numbers``."""
        sizes = self.sizes[numbers]
        of = np.repeat(np.arange(len(numbers)), sizes)
        within = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.buckets[self.begins[numbers][of] + within], of


def parted(count: int, seed: int) -> tuple[np.random.Generator, np.ndarray, np.ndarray]:
    """The seeded generator, the rows trained on and those kept for calibration, by position."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(count)
    return rng, np.setdiff1d(order, order[::CALIBRATION]), order[::CALIBRATION]


def texts_with(words: Lexicon, rows: np.ndarray) -> np.ndarray:
    """In how many of the texts each bucket occurs."""
    seen = np.zeros(BUCKETS, dtype=np.int64)
    for i in rows:
        seen[np.unique(words.parts(np.unique(words.texts[i]))[0])] += 1
    return seen


def untrained(rng: np.random.Generator, seen: np.ndarray, share: float | None, both: bool) -> Network:
    """A network to begin with; ``share`` of the texts are toxic. Without both labels it stays as it is."""
    network = Network(
        np.where((seen >= SEEN_IN)[:, None], rng.normal(0, 0.3, (BUCKETS, DIMENSIONS)), 0).astype(np.float32),
        {w: rng.normal(0, 1 / np.sqrt(w * DIMENSIONS), (w * DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS},
        {w: np.zeros(FILTERS, dtype=np.float32) for w in WIDTHS},
        rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32),
        float(np.log((share + 1e-3) / (1 - share + 1e-3))) if share is not None else 0.0,
    )
    if not both:
        network.weights[:] = 0
    return network


def train(documents: list[bytes] | Lexicon, labels: np.ndarray, seed: int = 3, start: Network | None = None, turn: int = 0) -> tuple[Network, np.ndarray]:
    """Fit a network; returns it and the positions of the rows kept for calibration.

    Adam on the texts' greatest responses, so only the words at them get gradients. With
    ``start`` only a round's share of the steps is made from that network, in place, one pass at
    least; ``turn`` is the number of the round.
    """
    words = documents if isinstance(documents, Lexicon) else Lexicon(documents)
    rng, fitted, held = parted(len(words.texts), seed)
    network, rate, least = start, RATE / (1 + turn), STEPS * BATCH // max(1, len(fitted))
    epochs = max(1, least // ROUNDS)
    if network is None:
        share = float(labels[fitted].mean()) if len(fitted) else None
        both = len(set(labels[fitted].tolist())) == 2
        network = untrained(rng, texts_with(words, fitted), share, both)
        if not both:
            return network, held
        epochs = max(EPOCHS, least)
    else:
        rng = np.random.default_rng([seed, turn])
    trained = network.embeddings.any(axis=1)
    state: dict = {}
    step = 0

    def adam(name, value, gradient):
        m, v = state.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        m *= 0.9
        m += 0.1 * gradient
        v *= 0.999
        v += 0.001 * gradient**2
        value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8) + DECAY * value

    first = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    second = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    bias = np.array([network.bias], dtype=np.float32)
    for _ in range(epochs):
        rng.shuffle(fitted)
        for begin in range(0, len(fitted), BATCH):
            chosen = [i for i in fitted[begin : begin + BATCH] if len(words.texts[i])]
            if not chosen:
                continue
            step += 1
            sizes = np.array([len(words.texts[i]) for i in chosen])
            starts, rows = layout(sizes)
            used, word = np.unique(np.concatenate([words.texts[i] for i in chosen]), return_inverse=True)
            buckets, of = words.parts(used)
            parts = np.bincount(of, minlength=len(used))[:, None]
            table = np.add.reduceat(network.embeddings[buckets], np.cumsum(parts) - parts[:, 0], axis=0) / parts
            keep = rng.random(len(word)) >= WORD_DROPOUT
            vectors = np.zeros((int(sizes.sum() + 2 * PAD * len(sizes)), DIMENSIONS), dtype=np.float32)
            vectors[rows] = table[word] * keep[:, None]
            network.bias = float(bias[0])
            pooled, places = network.responses(vectors, starts)
            p = 1 / (1 + np.exp(-network.logits(pooled)))
            error = ((p - labels[chosen]) / len(chosen)).astype(np.float32)
            back = error[:, None] * network.weights[None, :]
            adam("weights", network.weights, pooled.T @ error)
            adam("bias", bias, np.array([error.sum()], dtype=np.float32))
            gradient = np.zeros_like(vectors)
            for n, (width, (out, top)) in enumerate(places.items()):
                delta = back[:, n * FILTERS : (n + 1) * FILTERS] * (top > 0)
                first_best = np.where(out >= np.repeat(top, sizes + 2 * PAD, axis=0), np.arange(len(out))[:, None], len(out))
                at = np.minimum.reduceat(first_best, starts, axis=0)
                matrix = network.filters[width]
                matrix_gradient = np.zeros_like(matrix)
                for i in range(width):
                    inside = at + i < len(vectors)
                    rows_at, d = np.where(inside, at + i, 0), delta * inside
                    block = slice(i * DIMENSIONS, (i + 1) * DIMENSIONS)
                    matrix_gradient[block] = np.einsum("tfd,tf->df", vectors[rows_at], d)
                    np.add.at(gradient, rows_at.ravel(), (d[:, :, None] * matrix[block].T).reshape(-1, DIMENSIONS))
                adam(("filter", width), matrix, matrix_gradient)
                adam(("offset", width), network.offsets[width], delta.sum(axis=0))
            by_word = np.zeros_like(table)
            moved = np.flatnonzero(gradient[rows].any(axis=1) & keep)
            np.add.at(by_word, word[moved], gradient[rows[moved]])
            share = (by_word / parts)[of]
            touched = trained[buckets] & share.any(axis=1)
            unique, inverse = np.unique(buckets[touched], return_inverse=True)
            total = np.zeros((len(unique), DIMENSIONS), dtype=np.float32)
            np.add.at(total, inverse, share[touched])
            first[unique] = 0.9 * first[unique] + 0.1 * total
            second[unique] = 0.99 * second[unique] + 0.01 * total**2
            network.embeddings[unique] -= rate * first[unique] / (np.sqrt(second[unique]) + 1e-6)
    network.bias = float(bias[0])
    return network, held


def threshold(bins: np.ndarray) -> float:
    """The score from which predicting 1 has the best F1; 0.5 without both labels. Halfway to the next score below.

    ``bins`` has a row ``rows, toxic, least, greatest`` for each range of scores, highest first.
    """
    rows, hits, least, greatest = bins.T
    if not 0 < hits.sum() < rows.sum():
        return 0.5
    f1 = 2 * np.cumsum(hits) / (np.cumsum(rows) + hits.sum())
    at = int(np.argmax(f1))
    below = greatest[at + 1] if at + 1 < len(bins) else 0.0
    return float((least[at] + below) / 2)


@dataclass
class Model:
    network: Network
    thresholds: dict[str, float]
    default: float


#: Calibration rows of a language, of either label, from which it gets a threshold of its own.
LEAST_ROWS = 15


#: Ranges of equal width in the logit that the calibration counts scores by.
BINS = 1 << 14
#: What a network's numbers are multiplied by to be summed as integers, which any order of the shards sums alike.
UNIT = float(1 << 44)
NUMBERS = [f"c{i}" for i in range(DIMENSIONS)]


def flat(network: Network) -> np.ndarray:
    """All numbers but the embeddings, in rows as long as an embedding."""
    parts = [*network.filters.values(), *network.offsets.values(), network.weights, np.array([network.bias])]
    numbers = np.concatenate([p.ravel() for p in parts]).astype(np.float64)
    return np.pad(numbers, (0, -len(numbers) % DIMENSIONS)).reshape(-1, DIMENSIONS)


def shaped(embeddings: np.ndarray, rows: np.ndarray) -> Network:
    """The network of these embeddings and of the rows that ``flat`` gave."""
    numbers, at = rows.ravel(), 0

    def take(*shape: int) -> np.ndarray:
        nonlocal at
        at += int(np.prod(shape))
        return numbers[at - int(np.prod(shape)) : at].reshape(shape).astype(np.float32)

    filters = {w: take(w * DIMENSIONS, FILTERS) for w in WIDTHS}
    offsets = {w: take(FILTERS) for w in WIDTHS}
    return Network(embeddings.astype(np.float32), filters, offsets, take(len(WIDTHS) * FILTERS), float(numbers[at]))


def ordered(group: pa.Table) -> tuple[list[bytes], np.ndarray, list[str]]:
    """Texts, labels and languages of a shard, in the order of the ids' hashes."""
    found = zip(*(group[c].to_pylist() for c in ("doc_id", "text", "lang", "toxic")), strict=True)
    rows = sorted(
        ((i, (t or "").encode(), lang or "", float(y)) for i, t, lang, y in found),
        key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[1], r[3]),
    )
    return [r[1] for r in rows], np.array([r[3] for r in rows]), [r[2] for r in rows]


@dataclass
class Shard:
    """The rows of a shard as they are trained on, and those kept from the training with their texts."""

    words: Lexicon
    labels: np.ndarray
    held: np.ndarray
    documents: list[bytes]
    languages: list[str]

    def to_bytes(self) -> bytes:
        """Compressed, as the executors hold a payload several times while they write or read it."""
        return zlib.compress(pickle.dumps(self, protocol=5), 1)

    @classmethod
    def from_bytes(cls, payload: pa.Buffer) -> Shard:
        return pickle.loads(zlib.decompress(payload))


def packed(labelled: DataFrame, shards: int, seed: int = 3) -> DataFrame:
    """A row ``payload`` a shard: its texts are split into words and dealt once, not in every round."""

    def pack(group: pa.Table) -> pa.Table:
        documents, labels, languages = ordered(group)
        held = parted(len(documents), seed)[2]
        kept, own = [documents[i] for i in held], [languages[i] for i in held]
        for i in held:
            documents[i] = b""
        return pa.table({"payload": [Shard(Lexicon(documents), labels, held, kept, own).to_bytes()]})

    dealt = labelled.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(pack, "payload binary")


def by_shard(packs: DataFrame, convert: Callable[[Shard], dict], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch["payload"]:
                yield pa.RecordBatch.from_pydict(convert(Shard.from_bytes(payload.as_buffer())))

    return packs.mapInArrow(releasing(run), schema)


def averaged(packs: DataFrame, start: Network | None, turn: int = 0, seed: int = 3) -> Network:
    """The mean of the networks that the shards fit from ``start``; an embedding's is over those that moved it."""
    sent = packs.sparkSession.sparkContext.broadcast(start)

    def learn(shard: Shard) -> dict:
        own = None
        if sent.value is not None:
            own = shaped(sent.value.embeddings.copy(), flat(sent.value))
        network, _ = train(shard.words, shard.labels, seed, own, turn)
        before = 0 if sent.value is None else sent.value.embeddings
        moved = np.flatnonzero((network.embeddings != before).any(axis=1))
        dense = flat(network)
        keys = np.concatenate([moved, BUCKETS + np.arange(len(dense))])
        numbers = np.rint(np.concatenate([network.embeddings[moved].astype(np.float64), dense]) * UNIT).astype(np.int64)
        return {"key": pa.array(keys, pa.int32())} | {c: pa.array(numbers[:, i]) for i, c in enumerate(NUMBERS)}

    parts = by_shard(packs, learn, "key int, " + ", ".join(f"{c} bigint" for c in NUMBERS))
    sums = parts.groupBy("key").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in NUMBERS]).toArrow()
    sent.destroy()
    keys = sums["key"].to_numpy()
    means = np.stack([sums[c].to_numpy() for c in NUMBERS], axis=1) / UNIT / sums["n"].to_numpy()[:, None]
    embeddings = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32) if start is None else start.embeddings.copy()
    embeddings[keys[keys < BUCKETS]] = means[keys < BUCKETS]
    dense = np.zeros((int(keys.max()) + 1 - BUCKETS, DIMENSIONS))
    dense[keys[keys >= BUCKETS] - BUCKETS] = means[keys >= BUCKETS]
    return shaped(embeddings, dense)


def begun(packs: DataFrame, seed: int = 3) -> tuple[Network, bool]:
    """A network for the buckets seen in enough texts of all shards, and whether there are both labels."""

    def count(shard: Shard) -> dict:
        fitted = parted(len(shard.labels), seed)[1]
        seen = np.append(texts_with(shard.words, fitted), [len(fitted), int(shard.labels[fitted].sum())])
        keys = np.flatnonzero(seen)
        return {"key": pa.array(keys, pa.int32()), "n": pa.array(seen[keys])}

    sums = by_shard(packs, count, "key int, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(BUCKETS + 2, dtype=np.int64)
    seen[sums["key"].to_numpy()] = sums["n"].to_numpy()
    seen, texts, toxic = seen[:BUCKETS], int(seen[BUCKETS]), int(seen[BUCKETS + 1])
    both = 0 < toxic < texts
    return untrained(np.random.default_rng(seed), seen, toxic / texts if texts else None, both), both


def calibrated(packs: DataFrame, network: Network) -> tuple[dict[str, float], float]:
    """Thresholds by language and of all, from the rows of every shard that were kept from the training."""
    sent = packs.sparkSession.sparkContext.broadcast(network)

    def tally(shard: Shard) -> dict:
        scores = Scorer(sent.value).scores(shard.documents).astype(np.float64)
        with np.errstate(divide="ignore"):
            places = np.floor((np.log(scores / (1 - scores)) + 30) / 60 * BINS)
        return {
            "lang": pa.array(shard.languages, pa.string()),
            "place": pa.array(np.clip(places, 0, BINS - 1).astype(np.int32)),
            "score": pa.array(scores),
            "toxic": pa.array(shard.labels[shard.held].astype(np.int64)),
        }

    held = by_shard(packs, tally, "lang string, place int, score double, toxic bigint")
    found = held.groupBy("lang", "place").agg(
        F.count("*").alias("n"), F.sum("toxic").alias("hits"), F.min("score").alias("low"), F.max("score").alias("high")
    ).collect()
    sent.destroy()

    def bins(language: str | None) -> np.ndarray:
        joined: dict[int, list] = {}
        for r in found:
            if language in (None, r["lang"]):
                n, hits, low, high = joined.get(r["place"], (0, 0, 1.0, 0.0))
                joined[r["place"]] = [n + r["n"], hits + r["hits"], min(low, r["low"]), max(high, r["high"])]
        return np.array([joined[p] for p in sorted(joined, reverse=True)], dtype=np.float64).reshape(-1, 4)

    thresholds = {}
    for language in sorted({r["lang"] for r in found}):
        own = bins(language)
        toxic = own[:, 1].sum()
        if min(toxic, own[:, 0].sum() - toxic) >= LEAST_ROWS:
            thresholds[language] = threshold(own)
    return thresholds, threshold(bins(None))


def fit(labelled: DataFrame, rows: int = SHARD_ROWS) -> Model:
    """Model from all rows of ``doc_id``, ``text``, ``lang``, ``toxic``, in shards of about ``rows`` rows.

    One shard trains by itself. Several begin with one network and train a pass each at the same
    time, and the next round begins with the mean of theirs. What reaches the driver is a network
    or counts, of the same size however many rows there are. Runs jobs.
    """
    shards = -(-labelled.select("doc_id").count() // rows)
    if not shards:
        return Model(untrained(np.random.default_rng(3), np.zeros(BUCKETS), None, False), {}, 0.5)
    packs = stage(packed(labelled.select("doc_id", "text", "lang", "toxic"), shards), "rotulos")
    if shards == 1:
        network = averaged(packs, None)
    else:
        network, both = begun(packs)
        for turn in range(ROUNDS if both else 0):
            network = averaged(packs, network, turn)
    thresholds, default = calibrated(packs, network)
    unstage(packs)
    return Model(network, thresholds, default)


def crc_part() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5


#: Labelled ids that are broadcast at most, some 50 MB; more are joined by a shuffle.
BROADCAST = 1_000_000


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All labelled rows to learn from, none with crc32(doc_id) divisible by 5.

    One label per id (the greatest, if they differ) and one text (the least, if rows share an
    id); rows without id or label are left out. Up to ``BROADCAST`` ids are broadcast, so that
    only texts with a label are shuffled. Runs a job.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (crc_part() != 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    if chosen.count() <= BROADCAST:
        chosen = F.broadcast(chosen)
    found = docs.select("doc_id", F.struct("text", "lang").alias("row")).join(chosen, "doc_id")
    found = found.groupBy("doc_id").agg(F.min("row").alias("row"), F.max("toxic").alias("toxic"))
    return found.select("doc_id", "row.text", "row.lang", "toxic")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``flagged`` (score reaches its language's threshold).

    Every row is scored by its text alone; a null or empty text has the score of a text
    without responses. Columns of the same names are replaced. No shuffle.
    """
    kept = [f for f in docs.schema.fields if f.name not in ("score", "flagged")]
    sent = docs.sparkSession.sparkContext.broadcast(model.network)
    scorer: list[Scorer] = []

    def convert(batch: pa.RecordBatch) -> dict:
        if not scorer:
            scorer.append(Scorer(sent.value))
        found = scorer[0].scores(raw_texts(batch["text"]))
        return {f.name: batch[f.name] for f in kept} | {"score": pa.array(found.astype(np.float64))}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    scored = per_batch(docs.select(*[f"`{f.name}`" for f in kept]), convert, f"{schema}, score double")
    limit = F.lit(model.default)
    for language, value in model.thresholds.items():
        limit = F.when(F.col("lang") == language, value).otherwise(limit)
    return scored.withColumn("flagged", F.col("score") >= limit)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = fit(labelled_rows(docs, table(spark, sf_dir, "labels")))
    return score(docs.select("doc_id", "lang", "text"), model).select(
        "doc_id",
        F.coalesce(crc_part() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "flagged",
    )
