"""Language-model scores: counts against brute force, probabilities that add up to one, held-out gain."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from pyspark.sql import functions as F

from orcaspark.llm import lm, registry
from tests.llm.conftest import CLASHES, hard_rows


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\\x20\\x09-\\x0D]+", text) + [None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def base(rows):
    """Token and known counts and base scores by brute force."""
    counts = Counter(t for doc_id, text in rows if not held_out(doc_id) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for doc_id, text in rows:
        found_tokens = tokens(text)
        score = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in found_tokens)
        found.append((doc_id, held_out(doc_id), len(found_tokens), sum(counts[t] > 0 for t in found_tokens), total, score))
    return found


def compare(got, rows):
    want = base(rows)
    order = lambda r: tuple(str(v) for v in r[:5])
    fields = "doc_id held_out n_tokens n_known train_tokens base_score".split()
    got = sorted((tuple(r[f] for f in fields) for r in got), key=order)
    for a, b in zip(got, sorted(want, key=order), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)


def test_whole_table(session):
    got = registry.queries()["op11_lm"](session, SF).collect()
    rows = session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    compare(got, [tuple(r) for r in rows])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_words_outside_of_the_head_are_joined(docs, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 20)
    generator = random.Random(1)
    rows = [" ".join(generator.choices([f"w{i}" for i in range(300)], k=50)) for _ in range(40)]
    default = lm.vocabulary.__defaults__
    monkeypatch.setattr(lm.vocabulary, "__defaults__", (20, 8, 4))
    compare(lm.score_texts(docs(rows)).collect(), list(enumerate(rows)))
    monkeypatch.setattr(lm.vocabulary, "__defaults__", default)


def test_context_beats_the_counts_on_held_out_texts(docs):
    """Two languages: a text's words tell which words follow."""
    generator = random.Random(2)
    words = [[f"{a}{i}" for i in range(60)] for a in "xy"]
    rows = [" ".join(generator.choices(words[i % 2], k=120)) for i in range(300)]
    got = [r for r in lm.score_texts(docs(rows).coalesce(1)).collect() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in got) / sum(r["n_tokens"] for r in got)
    assert gain > 0.1  # of at most log10(2)


def test_reruns_agree(docs):
    rows = [f"alpha beta gamma {i % 3} delta" for i in range(30)]
    first, second = [{r["doc_id"]: r["score"] for r in lm.score_texts(docs(rows)).collect()} for _ in range(2)]
    assert first == second


def test_hard_rows(docs):
    rows = hard_rows() + [(30, "A\x0bb\x0cc\x1cd e f\x00", "en", "a"), (31, "y" * 3_000_000 + " z", "en", "a")]
    compare(lm.score_texts(docs(rows, CLASHES)).collect(), [(r[0], r[1]) for r in rows])


def test_nothing_to_learn_from(docs):
    ids = [i for i in range(60) if held_out(i)][:3]
    rows = [(i, t, "en", "a") for i, t in zip(ids, ("a b", "", None), strict=True)]
    got = lm.score_texts(docs(rows)).collect()
    compare(got, [(r[0], r[1]) for r in rows])
    assert all(math.isfinite(r["score"]) for r in got)
    assert lm.score_texts(docs([])).collect() == []


def test_probabilities_of_all_words_add_up_to_one(session, docs):
    """Over every known word and one unknown word of each class, after any history."""
    generator = random.Random(3)
    vocabulary = [f"{a}{b}{i}" for a in "pq" for b in "rst" for i in range(12)]
    frame = docs([" ".join(generator.choices(vocabulary, weights=range(1, 73), k=60)) for _ in range(50)])
    counts = lm.word_counts(frame)
    words, _ = lm.vocabulary(counts, 1000, 10, 5)
    texts = lm.encoded(frame, words).withColumn("row", F.lit(1))
    model = lm.train(texts, words)
    known = [(r["word"].encode(), r["n"]) for r in counts.collect()]
    classes, totals = len(words.masses), lm.all_totals(session, model)
    for history in ([0, 0], [3, 1], [classes - 1, 2]):
        every = np.repeat([history], classes, axis=0)
        shares = 10 ** model.log10_probabilities(every, np.arange(classes), totals)
        assert shares.sum() == pytest.approx(1, abs=1e-4)
        alone = classes - 1 - len(words.endings)
        single = {w: words.index[w] for w, _ in known if words.index[w] < alone}
        rare = [(w, n) for w, n in known if w not in single]
        total = sum(shares[i] for i in single.values())
        total += sum(shares[words.class_of(w)] * (n + 0.5) / 10 ** words.masses[words.class_of(w)] for w, n in rare)
        total += sum(shares[c] * 0.5 / 10 ** words.masses[c] for c in range(len(single), classes))
        assert total == pytest.approx(1, abs=1e-4)


def test_gradients_are_those_of_the_contrast():
    rng = np.random.default_rng(5)
    counts = np.array([5.0, 3.0, 2.0, 7.0, 1.0])
    model = lm.Model.untrained(counts)
    for part in model.parts():
        part += rng.normal(0, 0.1, part.shape).astype(np.float32)
    double = lm.Model(*[p.astype(np.float64) for p in model.parts()])
    history, token = rng.integers(0, 5, (6, lm.CONTEXT)), rng.integers(0, 5, 6)
    drawn, odds = np.array([0, 3, 3, 4]), np.log(lm.noise(counts) * 4)

    def loss():
        prediction = double.predictions(history)
        real = (prediction * double.target[token]).sum(axis=1) + double.bias[token] - odds[token]
        false = prediction @ double.target[drawn].T + double.bias[drawn] - odds[drawn]
        return (np.log1p(np.exp(-real)).sum() + np.log1p(np.exp(false)).sum()) / len(token)

    for part, gradient in zip(double.parts(), double.gradients(history, token, drawn, odds), strict=True):
        for place in list(np.ndindex(part.shape))[:: max(1, part.size // 15)]:
            part[place] += 1e-5
            high = loss()
            part[place] -= 2e-5
            low = loss()
            part[place] += 1e-5
            assert gradient[place] == pytest.approx((high - low) / 2e-5, abs=1e-6)


def test_pieces_of_long_texts():
    rng = random.Random(6)
    raw = b"".join(rng.choice([b"A", b"b", b" ", b"\n"]) for _ in range(5000))
    size, lm.PIECE = lm.PIECE, 64
    try:
        pieces = list(lm.tokens_of(raw))
    finally:
        lm.PIECE = size
    assert len(pieces) > 50
    assert [t for p in pieces for t in p] == raw.lower().split() + [lm.END]


def test_histories_stay_inside_their_text():
    column = pa.array([[1, 2, 3], [], [4], [5, 6]], pa.list_(pa.int16()))
    old, lm.BLOCK = lm.BLOCK, 4
    try:
        blocks = list(lm.token_blocks(column, 9))
    finally:
        lm.BLOCK = old
    rows, history, token = (np.concatenate([b[i] for b in blocks]) for i in range(3))
    assert rows.tolist() == [0, 0, 0, 2, 3, 3] and token.tolist() == [1, 2, 3, 4, 5, 6]
    assert history.tolist() == [[9, 9], [1, 9], [2, 1], [9, 9], [9, 9], [5, 9]]
