"""The pipeline's stages and the whole run against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from orcaspark.llm import bpe, common, minhash, secrets
from orcaspark.session import stage
from tests.llm.conftest import CLASHES, hard_rows

COLUMNS = list(pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(session):
    """Documents before and after each stage."""
    found = [session.read.parquet(f"{SF}/documents.parquet")]
    for name, function in pipeline.STAGES:
        found.append(stage(function(session, found[-1], SF), name))
    return found


def test_columns(stages):
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "minhash", "secrets", "mixing", "bpe"]
    assert all(df.columns == COLUMNS for df in stages[1:-1])


def test_toxic_documents_go(stages):
    before, after = ({r["doc_id"] for r in df.collect()} for df in stages[:2])
    assert after < before


def test_one_of_each_class_stays(stages):
    before, after = (dict(df.select("doc_id", "text").collect()) for df in stages[1:3])
    words = {i: minhash.words_of(t) for i, t in after.items()}
    kept = [i for i in words if words[i]]
    shingles = {i: {tuple(words[i][j : j + 5]) for j in range(max(1, len(words[i]) - 4))} for i in kept}
    close = [(a, b) for a in kept for b in kept if a < b and len(shingles[a] & shingles[b]) >= 0.5 * len(shingles[a] | shingles[b])]
    assert not any(minhash.similar([(words[a], words[b]) for a, b in close]))
    gone = set(before) - set(after)
    for i in gone:  # for every document that went, a similar one stays or links it to one
        own = minhash.words_of(before[i])
        assert any(minhash.similar([(own, minhash.words_of(before[j])) for j in before if j != i]))


def test_secrets_are_masked(stages):
    before, after = (dict(df.select("doc_id", "text").collect()) for df in stages[2:4])
    assert before.keys() == after.keys()
    plan = secrets.plan_of(secrets.RULES)
    for i, text in before.items():
        spans = plan.spans([text.encode()])[0]
        assert after[i] == secrets.masked(text, spans, pipeline.MASK)
        assert not plan.spans([after[i].encode()])[0]
    assert stages[3].filter(F.length("text") != F.col("n_chars")).isEmpty()


def test_whole_run_equals_its_stages(session, stages):
    codec = bpe.Codec.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = sorted((r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest(), codec.encode(r["text"])) for r in stages[4].collect())
    got = contract.queries()["pipeline"](session, SF).collect()
    assert sorted((r["doc_id"], r["decoded_sha256"], r["ids"]) for r in got) == texts


def test_stages_with_hard_rows(session, docs):
    rows = docs(hard_rows(random.Random(5)), [c for c in CLASHES if c != "values"])
    for name, function in pipeline.STAGES:
        rows = stage(function(session, rows, SF), name)
    assert {r["doc_id"] for r in rows.collect()} <= {None, 4, 5, 7, 8}
    empty = docs([]).limit(0)
    for name, function in pipeline.STAGES:
        empty = stage(function(session, empty, SF), name)
    assert empty.count() == 0


def test_nothing_else_imports_the_subpackage():
    import pathlib

    root = pathlib.Path(pipeline.__file__).parent
    others = [p for p in (root / "orcaspark").rglob("*.py") if "llm" not in p.parts]
    assert not any(re.search(r"orcaspark\.llm|from orcaspark import llm", p.read_text()) for p in others)


def test_batches_stay_short_after_a_stage(session):
    """A stage's result is written after its function has returned."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = session.conf.get(name)
    try:
        session.conf.set(name, "10000")
        pipeline.mask_secrets(session, session.read.parquet(f"{SF}/documents.parquet"), SF)
        assert 0 < int(session.conf.get(name)) <= 1024
    finally:
        session.conf.set(name, before)


def test_workers_give_back_what_a_task_freed(session, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release", lambda: calls.append("release"))
    assert list(common.releasing(lambda batches: (b + 1 for b in batches))(iter([1, 2]))) == [2, 3]
    assert calls == ["release", "release"]
    monkeypatch.undo()
    common.release()
