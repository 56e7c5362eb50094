"""Mixing against the definition of its targets and of Sainte-Laguë."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from orcaspark.llm import mixing, registry
from tests.llm.conftest import CLASHES, hard_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(sizes: dict) -> dict:
    """Targets by sharing again and again until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, free, found = float(sum(sizes.values())), set(order), {}
    while free:
        total = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / total > 3 * sizes[s]]
        if not over:
            return found | {s: left * weights[s] / total for s in free}
        for s in over:
            found[s] = 3.0 * sizes[s]
            free.remove(s)
        left = sum(sizes.values()) - sum(found.values())
    return found


def check(rows, texts):
    sizes = {}
    for r, (text, source) in zip(rows, texts, strict=True):
        assert r["size"] == len(WORD.findall(text or ""))
        sizes[source] = sizes.get(source, 0) + r["size"]
    want = by_hand(sizes)
    got = {}
    for r, (_, source) in zip(rows, texts, strict=True):
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        got[source] = got.get(source, 0) + r["taken"]
    return got, want


def test_mix_of_whole_table(session):
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in session.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = registry.queries()["op6_mixing"](session, SF).collect()
    got, want = check(rows, [docs[r["doc_id"]] for r in rows])
    assert all(abs(got[s] - want[s]) <= mixing.BLOCK for s in want)
    again = registry.queries()["op6_mixing"](session, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_small_sources_reach_three_times(docs):
    texts = [(i, "w " * n, "en", s) for i, (n, s) in enumerate([(2000, "a"), (10, "b"), (12, None), (900, "é"), (0, "z")] * 4)]
    rows = mixing.taken(docs(texts)).orderBy("doc_id").collect()
    got, want = check(rows, [(t, s) for _, t, _, s in texts])
    assert want["b"] == 120 and all(abs(got[s] - want[s]) <= 2 * mixing.BLOCK for s in want)


def test_mix_returns_what_is_taken(docs):
    rng = random.Random(8)
    texts = [(i, " ".join(f"d{i}w{j}" for j in range(rng.randint(0, 80))), "en", rng.choice("abc")) for i in range(300)]
    frame = docs(texts, CLASHES)
    taken = {r["doc_id"]: r["taken"] for r in mixing.taken(frame).collect()}
    out: dict = {}
    for r in mixing.mix(frame).collect():
        words = WORD.findall(r["text"])
        assert set(words) <= set(WORD.findall(texts[r["doc_id"]][1])) and r["n_chars"] == len(r["text"])
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + len(words)
    assert out == {i: n for i, n in taken.items() if n}
    assert mixing.mix(frame).columns == frame.columns


def test_hot_source_has_many_shards(session, docs, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_DOCS", 16)
    monkeypatch.setattr(mixing, "GROUP", 4)
    texts = [(i, "w " * (i % 50), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    rows = mixing.taken(docs(texts)).orderBy("doc_id").collect()
    got, want = check(rows, [(t, s) for _, t, _, s in texts])
    for s in want:
        assert abs(got[s] - want[s]) <= 0.02 * want[s] + mixing.BLOCK


def test_sainte_lague_by_highest_quotients():
    rng = random.Random(1)
    for _ in range(400):
        votes = [rng.randint(0, 60) * rng.choice([1, 1, 100]) for _ in range(rng.randint(1, 10))]
        seats = rng.randint(0, 50)
        want = [0] * len(votes)
        for _ in range(seats if sum(votes) else 0):
            best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * want[i] + 1), -i))
            want[best] += 1
        assert mixing.sainte_lague(np.array(votes), seats).tolist() == want


def test_word_counts(monkeypatch):
    monkeypatch.setattr(mixing, "_SLICE", 50)
    rng = random.Random(2)
    texts = [
        None if rng.random() < 0.1 else "".join(rng.choice(["a", "é", " ", "\n", "\x0b", "\x1c", "　"]) for _ in range(rng.randint(0, 15)))
        for _ in range(500)
    ]
    column = pa.array(texts, pa.string())
    want = [len(WORD.findall(t or "")) for t in texts]
    assert mixing.word_counts(column).tolist() == want and mixing.word_counts(column[7:90]).tolist() == want[7:90]


def test_mixing_edges(docs):
    rows = hard_rows()
    got = mixing.taken(docs(rows, CLASHES)).collect()
    assert len(got) == len(rows) and all(r["taken"] <= 3 * r["size"] for r in got)
    assert mixing.taken(docs([]).limit(0)).count() == 0 and mixing.mix(docs([]).limit(0)).count() == 0
    nothing = mixing.taken(docs([None, "", "  "])).collect()
    assert [(r["size"], r["source_size"], r["target"], r["taken"]) for r in nothing] == [(0, 0, 0.0, 0)] * 3
