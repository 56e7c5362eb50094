"""Spelling variants against brute force and the SQL twin."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from oracle.compare import connect, normal
from orcaspark.llm import registry, spelling
from tests.llm.conftest import CLASHES, hard_rows


def lowered(run):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def is_near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and is_near(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    found = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        found.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return found


def rows_of(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_whole_table_equals_brute_force_and_sql(session):
    found = registry.queries()["op12_spelling"](session, SF)
    texts = session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = rows_of(found)
    assert got == brute(texts) and found.count() == len(got)
    with connect(SF) as duck:
        want = duck.sql(registry.oracle_sql()["op12_spelling"]).df()
    assert normal(found.toPandas()).equals(normal(want))


def variant_texts(generator, words=60, most=60):
    """Words in very different numbers, with misspellings, and chains of forms."""
    letters = "abcdeéß÷ÿ"
    found = []
    for _ in range(words):
        word = "".join(generator.choices(letters, k=generator.randint(7, 16)))
        found += [word] * generator.randint(1, most)
        for _ in range(3):
            place, letter = generator.randrange(len(word) + 1), generator.choice(letters)
            new = generator.choice([word[:place] + letter + word[place:], word[:place] + letter + word[place + 1 :],
                                    word[:place] + word[place + 1 :]])
            found += [new] * generator.choice([1, 2, 2, 3, 6])
    chain = "zyxwvutsrq"
    for number, times in enumerate((400, 30, 2)):
        found += ["m" * number + chain] * times
    generator.shuffle(found)
    return [" ".join(found[i : i + 40]).title() for i in range(0, len(found), 40)]


@pytest.mark.parametrize("section", [2048, 3])
def test_variants_equal_brute_force(docs, monkeypatch, section):
    monkeypatch.setattr(spelling, "SECTION", section)
    monkeypatch.setattr(spelling, "SHELF", 500)
    monkeypatch.setattr(spelling, "CELLS", 3000)
    texts = variant_texts(random.Random(2))
    want = brute(list(enumerate(texts)))
    assert rows_of(spelling.variants(docs(texts))) == want
    assert any(form and root != form for _, form, root, *_ in want)


def test_hard_rows(docs):
    rows = hard_rows() + [(20, "x" * 300_000 + " " + "X" * 300_000, "en", "a"), (21, "Straßenbahn strassenbahn", "de", "a")] * 2
    found = spelling.variants(docs(rows, CLASHES))
    assert rows_of(found) == brute([(r[0], r[1]) for r in rows])


def test_no_words(docs):
    for rows in ([], [None], ["", "short words only", None]):
        found = spelling.variants(docs(rows))
        assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"] and found.collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=7, max_size=9), min_size=2, max_size=30, unique=True))
def test_shelf_finds_each_near_pair_once(words):
    """All words in one shelf, each window's rows built as the join builds them."""
    import pyarrow as pa

    rows = []
    for word in words:
        for base in (len(word), len(word) - 1):
            for window in range(spelling.WINDOWS):
                low, high = base * window // spelling.WINDOWS, base * (window + 1) // spelling.WINDOWS
                if base >= 7 and low < high:
                    anchor = hash((word[:low], word[len(word) - (base - high) :]))
                    rows.append((word, len(word), len(word), base, window, anchor, low, high, 0, 0, False))
    names = "word n size base window anchor low high part section crosses".split()
    shelf = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
    found = spelling.near_in_shelf(shelf).to_pylist()
    pairs = [(r["word"], r["near"]) for r in found]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a != b and is_near(a, b)}
