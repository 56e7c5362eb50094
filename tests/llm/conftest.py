from __future__ import annotations

import random

import pytest

from orcaspark.llm.common import ship

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def session(spark):
    return ship(spark)


@pytest.fixture
def docs(session):
    """Documents from texts, or from tuples of doc_id, text, lang, source."""

    def build(rows, extra=()):
        full = [(i, r, "en", "a") if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        data = [(*r, None if r[1] is None else len(r[1]), *["x"] * len(extra)) for r in full]
        return session.createDataFrame(data, DOCS + "".join(f", `{name}` string" for name in extra))

    return build


#: Names that operators use for columns of their own.
CLASHES = (
    "key label spans score flagged size shard src quota place bucket values values_ unit vector part class_id kept count"
    " toxic n_words shards target taken"
).split()


def hard_rows(rng=None):
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = rng or random.Random(5)
    words = [f"w{i}" for i in range(400)]
    long_text = " ".join(rng.choice(words) for _ in range(60_000))
    plain = " ".join(rng.choice(words) for _ in range(120))
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", "en", None),
        (4, long_text, "en", "b"),
        (5, plain, None, "b"),
        (5, plain, None, "b"),
        (None, plain, "de", "b"),
        (None, None, None, None),
        (6, plain.upper(), "de", "c"),
        (7, 'token = "abcdef0123456789abcdef0123"\nReleased under the MIT License.', "fr", "c"),
        (8, "é ñ 中文 🙂 ﬁ", "es", "d"),
    ]
    return rows
