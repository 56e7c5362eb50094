"""Operators on single texts against brute force."""

from __future__ import annotations

import base64
import hashlib
import random
import re

import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from orcaspark.llm import bpe, licenses, registry, secrets
from tests.llm.conftest import CLASHES, hard_rows

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
BASE = [
    ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# -- secrets -------------------------------------------------------------------------------


def base_spans(text: str) -> list[str]:
    found = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            if len(m.group(group)) >= least:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_base_secrets_of_whole_table(session):
    got = registry.queries()["op1_secrets"](session, SF).collect()
    rows = {r["doc_id"]: r for r in got}
    texts = session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for doc_id, text in texts:
        want = base_spans(text or "")
        row = rows[doc_id]
        assert row["base_sha256"] == sha(",".join(want))
        assert [row[f"n_{k}"] for k, *_ in BASE] == [sum(s.startswith(k + ":") for s in want) for k, *_ in BASE]
        assert set(want) <= set(row["spans"].split(",")) or not want


PIECES = (
    "password passwd SECRET Token api_key apikey : = \" ' abc deadbeef 0123456789abcdef01234567 AKIA ABCD1234EFGH5678 é"
    " ſecret Key ghp_ xoxb- eyJ http://u:p@h -----BEGIN PRIVATE KEY----- x"
).split() + [" ", "\n", "a" * 40]


def test_index_finds_what_a_full_scan_finds():
    rng = random.Random(1)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    plan = secrets.plan_of(secrets.RULES)
    got = [s for part in secrets.segments([t.encode() for t in texts]) for s in plan.spans(part)]
    for text, spans in zip(texts, got, strict=True):
        want = sorted(
            (m.start(), order, m.end(), rule.kind)
            for order, rule in enumerate(secrets.RULES)
            for m in re.finditer(rule.pattern, text)
            if len(m.group(rule.group)) >= rule.least
        )
        assert spans == [(a, b, k) for a, _, b, k in want]


@pytest.mark.parametrize(
    ("pattern", "text"),
    [("ab?cde", "acde"), ("(?i)STRASSE|kilo", "Kilo"), ("x(abc|bcd){2,3}y", "xabcbcdy"), ("[ab]cd+e", "bcdde"), ("é{2}bc", "éébc")],
)
def test_queries_hold_for_matches(pattern, text):
    assert re.search(pattern, text)
    query, lowered = secrets.trigram_query(pattern), bytes(text.encode()).lower()

    def holds(q):
        if q is secrets.ALL:
            return True
        return q in lowered if isinstance(q, bytes) else (all if q[0] == "and" else any)(map(holds, q[1]))

    assert holds(query)


def test_rules_without_trigrams_scan_everything():
    assert secrets.trigram_query("[0-9a-f]{24,}") is secrets.ALL
    assert secrets.trigrams(secrets.trigram_query("AKIA[A-Z0-9]+")) == {b"aki", b"kia"}


def test_masking(docs):
    rows = secrets.scan(docs(["a token=abcdef12 b", None, "plain"], CLASHES), mask="#").orderBy("doc_id").collect()
    assert [r["text"] for r in rows] == ["a # b", None, "plain"]
    assert [len(r["spans"]) for r in rows] == [1, 0, 0]


# -- byte-pair encoding --------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec.from_file(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ALPHABET = ["a", "b", "'", "s", "ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "中", "²", "1", "23", "🙂", "the", "!", "==", "_", "<|endoftext|>"]
TEXTS = st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join) | st.text(max_size=40).filter(
    lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)
)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encoding_equals_the_library(codec, library, text):
    want = library.encode_ordinary(text)
    corpus = bpe.corpus_encoder(PATH, public_tokenizers.PATTERN)
    assert codec.encode(text) == want
    assert corpus.encode(text) == " ".join(map(str, want))
    assert corpus.decode(corpus.encode(text)) == text.encode()


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 5), TEXTS), max_size=4))
def test_edits_equal_a_new_encoding(codec, text, edits):
    kept = bpe.EncodedText(codec, text)
    for start, length, new in edits:
        start = min(start, len(kept.text))
        kept.replace(start, min(start + length, len(kept.text)), new)
        assert kept.tokens() == codec.encode(kept.text)
    kept.append("'ll see")
    assert kept.tokens() == codec.encode(kept.text)


def test_prefix_table_edit_stops_early(codec):
    data = b"abcdefgh" * 400
    table = bpe.PrefixTable(codec, data)
    assert table.replace(10, 11, b"XY") < 600
    assert table.last == bpe.PrefixTable(codec, table.data).last


def test_tokenize_edges(docs, library):
    rows = hard_rows()
    got = sorted(map(str, bpe.tokenize(docs(rows, CLASHES), PATH, public_tokenizers.PATTERN, with_ids=True).collect()))
    assert len(got) == len(rows)
    for r in bpe.tokenize(docs(rows), PATH, public_tokenizers.PATTERN, with_ids=True).collect():
        texts = [t or "" for i, t, *_ in rows if i == r["doc_id"]]
        assert r["ids"] in [library.encode_ordinary(t) for t in texts] and r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == sha(" ".join(map(str, r["ids"]))) and r["decoded_sha256"] in map(sha, texts)


def test_bpe_of_whole_table(session, library):
    got = {r["doc_id"]: r for r in registry.queries()["op2_bpe"](session, SF).collect()}
    for doc_id, text in session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        assert got[doc_id]["ids_sha256"] == sha(" ".join(map(str, ids))) and got[doc_id]["n_tokens"] == len(ids)
        assert got[doc_id]["decoded_sha256"] == sha(text or "")


# -- licences ------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def license_row(text, notices=licenses.NOTICES, threshold=licenses.THRESHOLD):
    words = WORD.findall(text.translate(LOWER))
    places = [
        (i, label)
        for phrase, label in licenses.PHRASES
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    matched = []
    for line in re.split(r"[\r\n]+", text):
        block = set(WORD.findall(line.translate(LOWER)))
        for label, notice in notices:
            template = set(WORD.findall(notice.translate(LOWER)))
            share = len(template & block) / len(template)
            if share >= threshold - 1e-9:
                matched.append((label, share))
    starts = [i for i, _ in places]
    return (
        len(words),
        len(places),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted({label for _, label in places})),
        ",".join(sorted({label for _, label in places} | {label for label, _ in matched})),
        1.0 if places else max((s for _, s in matched), default=0.0),
    )


def test_licenses_of_whole_table(session):
    got = {r["doc_id"]: tuple(r)[1:] for r in registry.queries()["op9_licenses"](session, SF).collect()}
    for doc_id, text in session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        assert got[doc_id] == license_row(text or "")


def test_join_is_exact_at_lower_thresholds(docs):
    rng = random.Random(4)
    vocabulary = "a b c d e f g h i j k l m n".split()
    notices = tuple((f"n{i}", " ".join(rng.sample(vocabulary, rng.randint(2, 8)))) for i in range(12))
    texts = ["\n".join(" ".join(rng.choices(vocabulary, k=rng.randint(0, 9))) for _ in range(4)) for _ in range(120)]
    for threshold in (0.3, 0.6, 0.85, 1.0):
        for r in licenses.scan(docs(texts), notices, threshold=threshold).collect():
            assert tuple(r)[1:] == license_row(texts[r["doc_id"]], notices, threshold)


def test_wrapped_notices(docs):
    import textwrap

    texts, labels = [], []
    for label, notice in licenses.NOTICES:
        for sign in ("", "# ", " * ", "// "):
            lines = textwrap.wrap(f"Copyright of some people and others. {notice}. All of this text goes on behind it.", 40)
            texts.append("\n".join(["words before"] + [sign.strip()] + [sign + line for line in lines]))
            labels.append(label)
    texts += ["\n".join(w for w in notice.split() for _ in range(9)) for _, notice in licenses.NOTICES if len(notice.split()) > 12]
    texts += ["\n\n".join(textwrap.wrap(licenses.NOTICES[1][1], 40))]
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(docs(texts), phrases=(), wrapped=True).collect()}
    assert all(label in got[i] for i, label in enumerate(labels))
    assert all(got[i] == [""] for i in range(len(labels), len(texts)))


def test_license_edges(docs):
    rows = hard_rows()
    got = licenses.scan(docs(rows, CLASHES)).collect()
    assert sorted((str(r["doc_id"]), tuple(r)[1:]) for r in got) == sorted((str(i), license_row(t or "")) for i, t, *_ in rows)
    assert licenses.scan(docs([]).limit(0)).count() == 0
    assert secrets.scan(docs([]).limit(0)).count() == 0


def test_secret_edges(docs):
    rows = hard_rows()
    got = secrets.scan(docs(rows, CLASHES)).collect()
    assert sum(len(r["spans"]) for r in got) == 2 and len(got) == len(rows)


def test_words_with_signs_are_encoded_by_their_letters(codec, library):
    words = bpe._Words(codec)
    seen = []
    by_pattern = words.ids
    words.ids = lambda text: seen.append(text) or by_pattern(text)
    texts = ["ththou###", "sinan###", "ththou", "ofère,%%%", "ththou's", "won't.", "9th!!"]
    found = [words[t] for t in texts]
    assert found == [" ".join(map(str, library.encode_ordinary(" " + t))) for t in texts]
    assert seen == ["###", ",%%%", " ththou's", " won't.", " 9th!!"]
