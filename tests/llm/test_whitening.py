"""Whitening against eigenvectors of the exact covariance."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from conftest import SF

from orcaspark.llm import registry, whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def exact(rows):
    """n, sums, deviations and covariance of the x-vectors, in integers."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in row] for row in rows]
    n, size = len(x), len(x[0])
    sums = [sum(row[j] for row in x) for j in range(size)]
    apart = [[n * row[j] - sums[j] for j in range(size)] for row in x]
    cov = [[float(Fraction(sum(r[i] * r[j] for r in apart), n**3)) for j in range(size)] for i in range(size)]
    return n, [sum(v * v for v in row) for row in apart], np.array(cov), np.array(apart) / n


def check(got, ids, rows, most=32):
    n, deviation, cov, centred = exact(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(most, int((values > 1e-12 * values[0]).sum()))
    assert len(got) == k * len(ids)
    assert [r["component"] for r in got[:k]] == list(range(1, k + 1))
    whitened = np.array([r["whitened"] for r in got]).reshape(-1, k)
    want = centred @ vectors[:, :k] / np.sqrt(values[:k])
    sign = np.sign((whitened * want).sum(axis=0))
    assert np.abs(whitened * sign - want).max() < 1e-6
    assert [r["vec_id"] for r in got[::k]] == ids
    assert [r["deviation"] for r in got[::k]] == deviation
    assert {r["n"] for r in got} == {n}
    shares = [r["explained"] for r in got[:k]]
    assert np.allclose(shares, values[:k] / np.trace(cov), rtol=1e-8)
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-9


def ordered(df):
    return df.orderBy("vec_id", "component").collect()


def test_whole_table(session):
    got = ordered(registry.queries()["op13_whitening"](session, SF))
    rows = session.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    check(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_ill_conditioned_and_constant_directions(session):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 1000, (300, 5))
    rows = np.concatenate([base, base[:, :1] + rng.normal(0, 0.5, (300, 1)), np.full((300, 1), 7.25)], axis=1)
    rows[:, 1] *= 10
    rows = rows.astype(np.float32)
    df = session.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(rows)], SCHEMA).repartition(5)
    check(ordered(whitening.whiten(df)), list(range(300)), rows.tolist())
    check(ordered(whitening.whiten(df, most=3)), list(range(300)), rows.tolist(), most=3)


def test_rows_that_take_no_part(session):
    rng = np.random.default_rng(4)
    sound = [(i, [float(c) for c in rng.normal(0, 1, 3).astype(np.float32)], "x", 1) for i in range(40)]
    sound += [(7, sound[7][1], "x", 1), (None, [0.0, 0.0, 0.0], "x", 1)]
    broken = [
        (90, None, "x", 1), (91, [], "x", 1), (92, [1.0, None, 2.0], "x", 1), (93, [1.0, float("nan"), 0.0], "x", 1),
        (94, [float("inf"), 0.0, 0.0], "x", 1), (95, [1.0, 2.0], "x", 1), (96, [1e30, 0.0, 0.0], "x", 1),
    ]
    schema = f"{SCHEMA}, whitened string, n int"
    got = whitening.whiten(session.createDataFrame(sound + broken, schema)).collect()
    by_id = sorted(got, key=lambda r: (r["vec_id"] is not None, r["vec_id"], r["component"]))
    assert sum(r["vec_id"] == 7 for r in got) == 6 and sum(r["vec_id"] is None for r in got) == 3
    once = [r for r in by_id if r["vec_id"] != 7]
    n, deviation, _, _ = exact([s[1] for s in sound])
    assert {r["n"] for r in got} == {n}
    want = {s[0]: d for s, d in zip(sound, deviation, strict=True)}
    assert all(r["deviation"] == want[r["vec_id"]] for r in once)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_no_direction_varies(session, rows):
    found = whitening.whiten(session.createDataFrame(rows, SCHEMA))
    assert found.columns == "vec_id component n deviation whitened explained identity_error".split()
    assert found.collect() == []


def test_sums_and_deviations_beyond_a_long():
    whole = np.full((3, 2), 1 << 51)
    whole[0] = -whole[0]
    model = whitening.Whitening(3, [int(s) for s in whole.astype(object).sum(axis=0)], np.eye(2), np.ones(2), 2.0)
    assert whitening.deviations(whole, model) == [None] * 3
    small = np.array([[1, 2], [3, 5], [5, 2]])
    model = whitening.Whitening(3, [9, 9], np.eye(2), np.ones(2), 2.0)
    assert whitening.deviations(small, model) == [36 + 9, 36, 36 + 9]
