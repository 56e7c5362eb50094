"""Near-duplicates, neighbours and toxicity against brute force and held-out rows."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F

from orcaspark.llm import ann, graph, minhash, registry, toxicity, vecdedup
from orcaspark.llm.vectors import FlatGraph, balanced_centroids, squared
from tests.llm.conftest import CLASHES, hard_rows


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def joined(nodes, links):
    """Smallest node reachable from each."""
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            n = label[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {n: root(n) for n in nodes}


# -- Order MinHash -------------------------------------------------------------------------


def edited(rng, words, share):
    words = list(words)
    for _ in range(int(share * len(words))):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.5:
            words[at] = f"new{rng.randint(0, 999)}"
        elif kind < 0.75:
            words.insert(at, f"new{rng.randint(0, 999)}")
        elif len(words) > 1:
            del words[at]
    return words


def test_alignment_decides_as_the_full_distance():
    rng = random.Random(2)
    pairs = []
    for _ in range(500):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 70))]
        pairs.append((a, edited(rng, a, rng.random() * 0.4) if a else []))
    want = [distance(a, b) <= 0.2 * max(len(a), len(b)) + 1e-9 for a, b in pairs]
    assert minhash.similar(pairs) == want and 100 < sum(want) < 480


def test_sketches_follow_order_and_occurrence():
    hashes = minhash.WordHashes()
    rng = random.Random(3)
    words = [f"w{rng.randint(0, 500)}" for _ in range(300)]
    same = minhash.sketch(hashes.of(words))
    assert (same == minhash.sketch(hashes.of(list(words)))).all()
    near = minhash.sketch(hashes.of(edited(rng, words, 0.03)))
    swapped = minhash.sketch(hashes.of(words[150:] + words[:150]))
    far = minhash.sketch(hashes.of(words[:20] + [f"x{i}" for i in range(280)]))
    assert (same == near).mean() > 0.3 and (same == far).mean() < 0.1
    assert (same == near).mean() > (same == swapped).mean()  # order counts: half of the pairs are turned
    repeated = ["a", "b", "c", "d", "e"] * 40
    assert (minhash.sketch(hashes.of(repeated)) != minhash.sketch(hashes.of(repeated[:5]))).any()


@pytest.mark.parametrize("size", [5, 6, 10, 20, 40, 41, 250, 1000])
def test_sketches_of_pairs_at_the_threshold_agree(size):
    rng, hits = random.Random(size), []
    for turn in range(200):
        a = [rng.getrandbits(62) for _ in range(size)]
        b, changed = list(a), size // 5
        places = rng.sample(range(size), changed) if turn % 2 else [5 * i + 2 for i in range(changed)]
        for place in places:
            b[place] = rng.getrandbits(62)
        values = [minhash.values_of(np.array(t, dtype=np.uint64)) for t in (a, b)]
        hits.append(len(np.intersect1d(*values)) > 0)
    assert np.mean(hits) >= 0.99


def test_scattered_changes_down_to_the_threshold(docs):
    rng, texts = random.Random(12), []
    for i in range(80):
        base = [f"g{i}w{j}" for j in range(rng.choice([6, 12, 25, 60, 120, 300]))]
        places = rng.sample(range(len(base)), len(base) // 5)
        texts += [" ".join(base), " ".join("new" if j in places else w for j, w in enumerate(base))]
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs(texts)).collect()}
    assert sum(c == i - i % 2 for i, c in got.items()) >= 0.99 * len(texts)


def test_classes_of_whole_table(session):
    texts = dict(session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r["class_id"] for r in registry.queries()["op10_minhash"](session, SF).collect()}
    words = {i: minhash.words_of(t or "") for i, t in texts.items()}
    shingles = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, w in words.items()}
    pairs = [
        (a, b) for a in texts for b in texts
        if a < b and words[a] and words[b] and (words[a] == words[b] or len(shingles[a] & shingles[b]) >= 0.25 * len(shingles[a] | shingles[b]))
    ]
    linked = [p for p, ok in zip(pairs, minhash.similar([(words[a], words[b]) for a, b in pairs]), strict=True) if ok]
    want = joined(texts, linked)
    assert sum(got[i] == want[i] for i in texts) >= 0.99 * len(texts)
    for a, b in linked:
        if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
            assert got[a] == got[b]
    classes = joined(texts, linked)
    assert all(classes[i] == classes[c] for i, c in got.items())  # nothing is linked that isn't similar


def test_large_groups_and_shared_passages(docs):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = rng.choices(vocabulary, k=150)
    passage = rng.choices(vocabulary, k=60)
    near = [" ".join(edited(rng, base, 0.04)) for _ in range(150)]
    copies = [" ".join(base)] * 60
    clean = [" ".join([*rng.choices(vocabulary, k=140), *passage]) for _ in range(60)]
    got = {r["doc_id"]: r for r in minhash.classes(docs(near + copies + clean)).collect()}
    assert {got[i]["class_id"] for i in range(210)} == {0}
    assert [got[i]["class_id"] for i in range(210, 270)] == list(range(210, 270))
    assert sum(r["kept"] for r in got.values()) == 61


def test_subgroups_of_a_template(docs):
    template = [f"t{i}" for i in range(78)]
    texts = []
    for group in range(50):  # 78 % alike to all others; its variants share no shingle but the template's
        for v in range(3):
            texts.append(" ".join(template + [f"g{group}w{i}" if i % 4 else f"g{group}v{v}w{i}" for i in range(22)]))
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs(texts)).collect()}
    assert got == {i: i - i % 3 for i in range(150)}


def test_remaining_pairs_are_all_of_other_classes(docs, monkeypatch):
    monkeypatch.setattr(minhash, "SECTION", 7)  # the bucket has several sections
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    texts = [edited(rng, base, rng.choice([0.1, 0.3])) + ["end"] * rng.randint(0, 20) for _ in range(40)]
    source = minhash.described(docs([" ".join(t) for t in texts]))
    place = {r["node"]: r["doc_id"] for r in source.nodes.collect()}
    assert len(place) == 40
    frame = source.nodes.selectExpr(
        "1 as bucket", "node", f"{min(place)}L as first", f"{max(place)}L as last", "doc_id % 30 as label"
    )
    found = minhash.remaining_pairs(frame, source, 0.8).collect()
    got = {(r["a"], r["b"]) for r in found}
    assert len(got) == len(found) and all(r["longer"] == max(len(texts[place[r[x]]]) for x in "ab") for r in found)
    inner = sorted(place)[1:-1]
    pairs = [(a, b) for a in inner for b in inner if a < b and place[a] % 30 != place[b] % 30]
    alike = minhash.similar([(texts[place[a]], texts[place[b]]) for a, b in pairs])
    assert {p for p, ok in zip(pairs, alike, strict=True) if ok} <= got
    assert got <= set(pairs) and len(got) < len(pairs) and any(alike)


def rows_dealt(session, members, words, finer):
    """Rows that ``by_part`` deals out, and the pairs that meet, for a bucket of members with texts of ``words`` words."""
    hashes = minhash.WordHashes()
    bags = [(i, words, bytearray(minhash.bag_of(hashes.of([f"w{j}" for j in range(words)]), finer))) for i in range(members)]
    others = session.range(members).selectExpr("1L as bucket", "id as node", "id as label")

    def met(run):
        nodes, sections = run["node"].to_pylist(), run["section"].to_pylist()
        two = len(set(sections)) > 1
        pairs = [(a, b) for a, p in zip(nodes, sections) for b, q in zip(nodes, sections) if a < b and (p != q or not two)]
        return {"a": [a for a, _ in pairs] + [-1] * len(nodes), "b": [b for _, b in pairs] + [-1] * len(nodes)}

    frame = session.createDataFrame(bags, "node bigint, n_words bigint, bag binary")
    found = minhash.by_part(others, frame, met, "a bigint, b bigint").collect()
    return sum(r["a"] < 0 for r in found), {(r["a"], r["b"]) for r in found if r["a"] >= 0}


def test_narrow_bags_are_dealt_to_fewer_sections(session, monkeypatch):
    monkeypatch.setattr(minhash, "SECTION", 10)
    every = {(a, b) for a in range(60) for b in range(a + 1, 60)}
    # Sections of ten of the widest; 512 bins are a sixteenth of their work, so a quarter of the sections; then 64 bins.
    for words, finer, sections in ((4 * minhash.MOST_BINS, minhash.FINER, 6), (150, minhash.FINER, 2), (150, 1, 1)):
        dealt, pairs = rows_dealt(session, 60, words, finer)
        assert dealt == 60 * sections and every <= pairs


def test_remaining_pairs_of_several_sections(docs, monkeypatch):
    class Smaller:
        setattr = staticmethod(lambda owner, name, value: monkeypatch.setattr(owner, name, 1))

    test_remaining_pairs_are_all_of_other_classes(docs, Smaller)


def test_bags_bound_the_edits_of_frequent_words_too(docs):
    """Words repeated hundreds of times, in texts of different numbers of bins."""
    words = ["the"] * 310 + ["of"] * 310 + [f"w{i}" for i in range(400)]
    random.Random(1).shuffle(words)
    longer = words + [f"x{i}" for i in range(6)]
    hashes = minhash.WordHashes()
    a, b = (minhash.bins_of(minhash.bag_of(hashes.of(t))) for t in (words, longer))
    assert len(a) != len(b) and minhash.fewest_edits(a, b) <= 6
    many = ["the"] * 70_000 + ["of"]
    assert minhash.bins_of(minhash.bag_of(hashes.of(many))).sum() == 70_001
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs([" ".join(words), " ".join(longer)])).collect()}
    assert got == {0: 0, 1: 0}


def test_bags_never_exceed_the_distance():
    rng, hashes = random.Random(8), minhash.WordHashes()
    for _ in range(300):
        a = [rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(1, 300))]
        b = edited(rng, a, rng.random() * 0.4) or ["z"]
        bags = [minhash.bins_of(minhash.bag_of(hashes.of(t))) for t in (a, b)]
        assert minhash.fewest_edits(*bags) <= distance(a, b)


def test_a_large_group_is_compared_about_once_a_node(docs, monkeypatch):
    rng, asked = random.Random(3), []
    base = [f"v{rng.randint(0, 3000)}" for _ in range(150)]
    verified = minhash.verified

    def counted(pairs, source, least):
        asked.append(pairs.count())
        return verified(pairs, source, least)

    monkeypatch.setattr(minhash, "verified", counted)
    for size in (100, 300):
        asked.clear()
        texts = [" ".join(edited(rng, base, 0.04)) for _ in range(size)]
        got = minhash.classes(docs(texts)).select("class_id").distinct().collect()
        assert [r["class_id"] for r in got] == [0] and sum(asked) <= 2 * size, asked


def test_texts_around_a_common_passage_make_no_pairs(docs, monkeypatch):
    """The passage is 0.73 of each text: coarse bags can't tell it from 0.8."""
    asked, verified = [], minhash.verified

    def counted(pairs, source, least):
        asked.append(pairs.count())
        return verified(pairs, source, least)

    monkeypatch.setattr(minhash, "verified", counted)
    passage = [f"p{i}" for i in range(180)]
    texts = [" ".join(passage[:90] + [f"t{t}w{i}" for i in range(68)] + passage[90:]) for t in range(60)]
    changed = texts[30].split()
    changed[100:110] = [f"new{i}" for i in range(10)]
    got = {r["doc_id"]: r["class_id"] for r in minhash.classes(docs([*texts, " ".join(changed)])).collect()}
    assert got == {i: min(i, 30) if i == 60 else i for i in range(61)}
    assert sum(asked[2:]) <= len(texts), asked


def test_pairs_of_texts_travel_in_short_batches(docs, monkeypatch):
    """Two whole texts a row: a batch of Spark's default size would hold 20,000 of them."""
    name, seen, described = "spark.sql.execution.arrow.maxRecordsPerBatch", [], minhash.described

    def looked(frame):
        seen.append(int(frame.sparkSession.conf.get(name)))
        return described(frame)

    monkeypatch.setattr(minhash, "described", looked)
    frame = docs(["a b c d e", "a b c d e"])
    before = frame.sparkSession.conf.get(name)
    assert minhash.classes(frame).count() == 2
    assert seen and 0 < seen[0] <= 1024 and frame.sparkSession.conf.get(name) == before


def test_united_classes_equal_those_of_all_links(session):
    rng = random.Random(2)
    edges = [[(rng.randint(0, 90), rng.randint(0, 90)) for _ in range(n)] for n in (40, 25, 15, 0)]
    labels, so_far = None, []
    for some in edges:
        frame = session.createDataFrame(some, "a bigint, b bigint")
        labels, so_far = minhash.united(labels, frame), so_far + some
        want = joined({n for e in so_far for n in e}, so_far)
        rows = [tuple(r) for r in labels.select("node", "label").collect()]
        assert len(rows) == len(dict(rows))
        assert dict(rows) == {n: want[n] for n in {n for e in so_far for n in e if e[0] != e[1]}}


def test_minhash_edges(docs):
    rows = hard_rows()
    got = minhash.classes(docs(rows, CLASHES)).collect()
    assert len(got) == len(rows)
    assert {r["class_id"] for r in got if r["doc_id"] in (5, 6)} == {5}
    assert all(r["class_id"] == r["doc_id"] and r["kept"] for r in got if r["doc_id"] in (1, 2, 3, 4))
    left = minhash.deduplicated(docs(rows, CLASHES))
    assert left.columns == docs(rows, CLASHES).columns
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "7", "8", "None"])
    assert minhash.classes(docs([]).limit(0)).count() == 0 and minhash.deduplicated(docs([]).limit(0)).count() == 0


def test_components(session):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    edges += [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(150)]
    got = dict(graph.components(session.createDataFrame(edges, "a bigint, b bigint")).collect())
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    want = joined({n for e in edges for n in e}, edges)
    assert got == {n: want[n] for n in nodes}


# -- vectors -------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def matrix(session):
    rows = session.read.parquet(f"{SF}/embeddings.parquet").collect()
    return [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], dtype=np.float64)


def link_truth(ids, points):
    units = points / np.linalg.norm(points, axis=1)[:, None]
    near = units @ units.T >= 0.95
    np.fill_diagonal(near, False)
    links = [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near), strict=True)]
    return dict(zip(ids, near.sum(axis=1).tolist(), strict=True)), joined(ids, links)


def check_links(rows, ids, points):
    degrees, labels = link_truth(ids, points)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows}
    assert got == {i: (degrees[i], labels[i], labels[i] == i) for i in ids}


def test_links_of_whole_table(session):
    check_links(registry.queries()["op7_vectors"](session, SF).collect(), *matrix(session))


def planted(rng, count=1500, width=16):
    points = rng.normal(size=(count, width))
    points[:300] = points[0] + rng.normal(scale=0.03, size=(300, width))
    points[300:340] = points[300]
    points[340:360] = points[340] * rng.uniform(0.5, 4, size=(20, 1))
    return points.astype(np.float32)


def test_links_of_groups_and_copies(session, monkeypatch):
    monkeypatch.setattr(vecdedup, "SHARD", 200)
    monkeypatch.setattr(vecdedup, "PART", 120)  # the dense group's shards are dealt to pairs of sections
    points = planted(np.random.default_rng(3))
    frame = session.createDataFrame([(i, p.tolist(), 0) for i, p in enumerate(points)], VECTORS)
    check_links(vecdedup.near_duplicates(frame).collect(), list(range(len(points))), points.astype(np.float64))


def test_audit_goes_on_until_links_are_seen(session):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(3000, 32))
    points[1500:1515] = points[:15] + rng.normal(scale=0.02, size=(15, 32))  # 1 % of the vectors have a link
    rows = [(i, f"{i:08d}".encode(), (p / np.linalg.norm(p)).tolist()) for i, p in enumerate(points)]
    nodes = session.createDataFrame(rows, "vec_id bigint, key binary, unit array<double>").cache()
    found = {(bytes(r["a"]), bytes(r["b"])) for r in vecdedup.true_links(nodes, 0.95, 3000).collect()}
    assert found == {(f"{i:08d}".encode(), f"{i + 1500:08d}".encode()) for i in range(15)}


def odd_vectors(session):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0])]
    rows += [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [1.0, 0.01]), (22, [2.0, 0.0]), (40, [0.0, 1.0]), (None, [0.0, -1.0])]
    return session.createDataFrame([(*r, 0, "x") for r in rows], VECTORS + ", key string")


def test_vector_edges(session):
    got = sorted(((r["vec_id"] or 0), r["n_links"], r["component_id"], r["kept"]) for r in vecdedup.near_duplicates(odd_vectors(session)).collect())
    alone = [(i, 0, i, True) for i in range(1, 7)]
    assert got == [(0, 0, None, True), *alone, (20, 2, 20, True), (20, 2, 20, True), (21, 2, 20, False), (22, 2, 20, False), (40, 0, 40, True)]
    assert vecdedup.near_duplicates(odd_vectors(session).limit(0)).count() == 0


def neighbour_truth(ids, points, every=20, count=20):
    ids, found = np.array(ids), {}
    for i in np.flatnonzero(ids % every == 0):
        scores = (points * points[i]).sum(axis=1)
        others = np.flatnonzero(ids != ids[i])
        order = others[np.lexsort((ids[others], -scores[others]))][:count]
        found[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return found


def recall_of(rows, want):
    got: dict = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert set(got) == {q for q, n in want.items() if n}
    hits = 0
    for q, found in got.items():
        assert [r for *_, r in found] == list(range(1, len(found) + 1)) and len(found) == len(want[q])
        assert [(-s, i) for i, s, _ in found] == sorted((-s, i) for i, s, _ in found)
        truth = dict(want[q])
        for i, score, _ in found:
            if i in truth:
                hits += 1
                assert score == pytest.approx(truth[i], rel=1e-12)
    return hits / sum(len(n) for n in want.values())


def test_neighbours_of_whole_table(session):
    want = neighbour_truth(*matrix(session))
    assert recall_of(registry.queries()["op4_neighbours"](session, SF).collect(), want) >= 0.9


def test_neighbours_of_uneven_lengths_and_copies(session, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 40)
    monkeypatch.setattr(ann, "SHELF", 100)  # the copies' list has several sections
    monkeypatch.setattr(ann, "QUERIES", 20)
    rng = np.random.default_rng(5)
    points = planted(rng) * rng.uniform(0.5, 2, size=(1500, 1)).astype(np.float32)
    points[400:800] = points[400]
    frame = session.createDataFrame([(i, p.tolist(), 0) for i, p in enumerate(points)], VECTORS)
    want = neighbour_truth(list(range(1500)), points.astype(np.float64))
    rows = ann.search(frame).collect()
    assert recall_of(rows, want) >= 0.9
    of_copy = [r["vec_id"] for r in sorted((r for r in rows if r["query_id"] == 420), key=lambda r: r["rank"])]
    assert of_copy == [i for i, _ in want[420]]  # ties go to the smaller ids


def test_repeated_rows_take_no_place_of_others(session):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(60, 8))
    rows = [(i, p.tolist(), 0) for i, p in enumerate(points)]
    rows += [(1, (points[1] * (1 + k / 1000)).tolist(), 0) for k in range(100)] * 2
    rows += [(2, (points[0] * 9).tolist(), 0)] * 150
    got = ann.search(session.createDataFrame(rows, VECTORS), recall=1.0).collect()
    for q in (0, 20, 40):
        best = {}
        for i, vector, _ in rows:
            if i != q:
                best[i] = max(best.get(i, -np.inf), float(np.float32(vector).astype(float) @ np.float32(points[q]).astype(float)))
        want = sorted(best, key=lambda i: -best[i])[:20]
        assert [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == want


def test_neighbour_edges(session):
    got = {(r["query_id"], r["rank"], r["vec_id"]) for r in ann.search(odd_vectors(session)).collect()}
    assert got == {(20, 1, 22), (20, 2, 21), (20, 3, 40), (40, 1, 21), (40, 2, 20), (40, 3, 22)}
    assert ann.search(odd_vectors(session).limit(0)).count() == 0


def test_graph_search_and_centroids():
    points = planted(np.random.default_rng(7), 600).astype(np.float64)
    built = FlatGraph(points)
    seen, ids = built.search(points[:100], 32)
    true = squared(points[:100], points).argsort(axis=1)[:, :10]
    found = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids[:, :32], true, strict=True)])
    assert found > 0.9
    everything, _ = built.search(points[:3], 1, np.inf)
    assert np.isfinite(everything).all()  # every point can be reached
    centroids = balanced_centroids(points, 16)
    sizes = np.bincount(squared(points, centroids).argmin(axis=1), minlength=len(centroids))
    assert len(centroids) == 16 and sizes.max() < 6 * sizes.mean()


# -- toxicity ------------------------------------------------------------------------------


def toxic_rows(rng, count):
    rows, labels = [], []
    for i in range(count):
        language = rng.choice(["en", "fr"])
        words = [f"{language}{rng.randint(0, 300)}" for _ in range(rng.randint(5, 120))]
        toxic = rng.random() < 0.3
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "scum"]) if language == "en" else "abject" + rng.choice("abcdef"))
        rows.append((i, " ".join(words), language, rng.choice("ab")))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy(session, docs):
    rows, labels = toxic_rows(random.Random(4), 1500)
    frame, marks = docs(rows, [c for c in CLASHES if c not in ("toxic",)]), session.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(toxicity.labelled_rows(frame, marks))
    truth = {i: t for i, _, t in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    got = {r["doc_id"]: r for r in toxicity.score(frame, model).collect()}
    assert sum((got[i]["score"] >= 0.5) == truth[i] for i in held) >= 0.95 * len(held)
    assert sum(got[i]["flagged"] == truth[i] for i in held) >= 0.95 * len(held)
    assert set(model.thresholds) == {"en", "fr"}


def test_labels_of_held_out_rows_and_other_columns_have_no_influence(session, docs):
    rows, labels = toxic_rows(random.Random(9), 300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    schema = "doc_id bigint, quality int, toxic int"
    scores = []
    for marks in (labels, turned):
        model = toxicity.fit(toxicity.labelled_rows(docs(rows), session.createDataFrame(marks, schema)))
        scores.append(sorted((r["doc_id"], r["score"]) for r in toxicity.score(docs(rows), model).collect()))
    assert scores[0] == scores[1]
    other = docs([(i + 5000, t, "xx", None) for i, t, *_ in rows])
    assert sorted((r["doc_id"] - 5000, r["score"]) for r in toxicity.score(other, model).collect()) == scores[1]


def test_toxicity_edges(session, docs):
    marks = session.createDataFrame([(1, None, None), (None, 1, 1), (5, 0, 1), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    frame = docs(hard_rows(), CLASHES)
    model = toxicity.fit(toxicity.labelled_rows(frame, marks))
    got = toxicity.score(frame, model).collect()
    assert len(got) == len(hard_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score(frame.limit(0), model).count() == 0
    assert toxicity.fit(toxicity.labelled_rows(frame.limit(0), marks)).thresholds == {}


def test_long_texts_are_scored_whole(monkeypatch):
    rows, labels = toxic_rows(random.Random(2), 300)
    network, _ = toxicity.train([t.encode() for _, t, *_ in rows], np.array([float(t) for *_, t in labels]))
    texts = [" ".join(t for _, t, *_ in rows[i : i + 40]).encode() for i in range(60)]
    whole = toxicity.Scorer(network).scores(texts)
    monkeypatch.setattr(toxicity, "CHUNK", 7)  # the same text in many chunks
    assert toxicity.Scorer(network).scores(texts) == pytest.approx(whole, abs=1e-5)


def test_toxicity_of_whole_table(session):
    rows = registry.queries()["op3_toxicity"](session, SF).collect()
    assert len(rows) == session.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1


def test_toxicity_is_learnt_from_every_labelled_row(session, docs):
    count = 8200  # more than one shard holds
    frame = docs([f"t{i}" for i in range(count)])
    marks = session.range(count).selectExpr("id AS doc_id", "1 AS quality", "int(id % 2) AS toxic")
    wanted = {i for i in range(count) if zlib.crc32(str(i).encode()) % 5}
    assert len(wanted) > 6000 and {r["doc_id"] for r in toxicity.labelled_rows(frame, marks).collect()} == wanted


def test_toxicity_of_several_shards(session, docs):
    rows, labels = toxic_rows(random.Random(4), 1800)
    frame, marks = docs(rows), session.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    models = [toxicity.fit(toxicity.labelled_rows(frame.repartition(n), marks), rows=750) for n in (1, 5)]
    truth = {i: t for i, _, t in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    got = {r["doc_id"]: r for r in toxicity.score(frame, models[0]).collect()}
    assert sum((got[i]["score"] >= 0.5) == truth[i] for i in held) >= 0.95 * len(held)
    assert sum(got[i]["flagged"] == truth[i] for i in held) >= 0.95 * len(held)
    assert np.array_equal(models[0].network.embeddings, models[1].network.embeddings)
    assert models[0].thresholds == models[1].thresholds and models[0].default == models[1].default


def test_packed_shards_are_smaller_than_their_texts(session, docs):
    words = [f"word{i}" for i in range(3000)]
    rng = random.Random(8)
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(200)]
    rows = docs(texts).select("doc_id", "text", "lang", F.lit(1).alias("toxic"))
    payload = toxicity.packed(rows, 1).collect()[0]["payload"]
    assert len(payload) < sum(map(len, texts)) / 2
    shard = toxicity.Shard.from_bytes(pa.py_buffer(bytes(payload)))
    assert sum(len(t) > 0 for t in shard.words.texts) + len(shard.documents) == len(texts)
