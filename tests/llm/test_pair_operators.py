"""Near duplicates, vectors, search and components against brute force."""

import numpy as np
import pytest

from sheafline.llm import near_dups, vector_dups, vector_search
from sheafline.llm.components import connected_components

DOCS = "doc_id long, text string, node long, n string"


def components(ids, pairs):
    root = {i: i for i in ids}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("kind", ["random", "path", "star", "none"])
def test_connected_components(spark, kind):
    rng = np.random.default_rng(1)
    pairs = {
        "random": [tuple(map(int, p)) for p in rng.integers(0, 120, (90, 2))],
        "path": [(i, i + 1) for i in range(40)] + [(7, 7)],
        "star": [(50, i) for i in range(30)] * 2,
        "none": [],
    }[kind]
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    want = components({v for p in pairs for v in p}, pairs)
    found = {r["node"]: r["component"] for r in got.collect()}
    assert found == {i: c for i, c in want.items() if any(i in p and p[0] != p[1] for p in pairs)}


def shingles(text, k):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for space in "\t\n\v\f\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def brute_groups(rows, k, percent):
    sets = {i: shingles(t, k) for i, t in rows if i is not None}
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, components(sets, pairs)


def check_groups(docs, rows, k, percent):
    got = near_dups.group_near_duplicates(docs, k, percent).collect()
    sizes, want = brute_groups(rows, k, percent)
    assert len(got) == len(rows)
    for r in got:
        if r["id"] is None:
            assert r["component"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component"], r["kept"]) == (sizes[r["id"]], want[r["id"]], want[r["id"]] == r["id"])


def test_near_duplicates_of_the_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check_groups(docs, rows, 3, 85)


def test_near_duplicates_in_a_hot_group(spark, monkeypatch):
    """Chains of edits: many pairs of a table fail, components hang on few links."""
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(500)]
    base = list(rng.choice(vocabulary, 90))
    rows = []
    for i in range(160):
        words = list(base)
        for at in rng.integers(0, 90, rng.integers(0, 5)):
            words[at] = str(rng.choice(vocabulary))
        rows.append((i, " ".join(words)))
    rows += [(300 + i, rows[i][1].upper() + "\n") for i in range(40)]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "One\x0btwo"), (404, "one TWO"), (405, "é É"), (None, rows[0][1])]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)
    check_groups(docs, rows, 3, 85)
    check_groups(docs, rows, near_dups.SHINGLE, near_dups.PERCENT)
    left = near_dups.drop_near_duplicates(docs)
    want = {i for i, c in brute_groups(rows, 5, 80)[1].items() if i == c} | {None}
    assert {r["doc_id"] for r in left.collect()} == want and left.columns == docs.columns


def test_near_duplicates_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert near_dups.group_near_duplicates(empty).count() == 0
    twice = spark.createDataFrame([(5, "a b c d", 0, "")] * 2 + [(9, "A b  c d", 0, "")], DOCS)
    assert {(r["id"], r["component"]) for r in near_dups.group_near_duplicates(twice).collect()} == {(5, 5), (9, 5)}


def test_tables_rarely_miss():
    for percent in (80, 85, 95):
        m = near_dups.collections_for(percent)
        assert near_dups.missed(percent / 100, m) <= near_dups.MISSED < near_dups.missed(percent / 100, m - 1)


def test_similar_pairs_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 40, 20).astype(np.uint64)) for _ in range(30)] + [np.zeros(0, np.uint64)]
    got = near_dups.similar_pairs(sets, sets, 50)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (100 * both >= 50 * (len(a) + len(b) - both))


VECTORS = "vec_id long, embedding array<float>, label int, node string"


def brute_links(rows, cosine):
    usable = {}
    for n, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[n] = (i, np.array(v, np.float32).astype(np.float64), label)
    links, pairs = {n: 0 for n in range(len(rows))}, []
    for a in usable:
        for b in usable:
            (i, x, p), (j, y, q) = usable[a], usable[b]
            if a != b and p == q and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[a] += 1
                pairs.append((i, j))
    return links, components({r[0] for r in rows if r[0] is not None}, pairs)


@pytest.mark.parametrize("cell, size", [(4096, 2048), (24, 16)])
def test_close_vectors(spark, monkeypatch, cell, size):
    monkeypatch.setattr(vector_dups, "CELL", cell)
    monkeypatch.setattr(vector_dups, "SLICE", size)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(220):
        spread = [0.02, 0.1, 0.2, 1.0][i % 4]
        rows.append((i, [float(v) for v in centres[i % 6] + rng.normal(size=8) * spread], i % 2))
    rows += [(500 + i, rows[8][1], 0) for i in range(40)] + [(600, [v * 3 for v in rows[8][1]], 0)]
    bad = [None, [], [0.0] * 8, [None] + [1.0] * 7, [float("nan")] * 8, [float("inf")] + [1.0] * 7, rows[8][1][:7]]
    rows += [(700 + i, v, 0) for i, v in enumerate(bad)] + [(720, rows[8][1], None), (None, rows[8][1], 0), (721, [1e-30] * 8, 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    got = vector_dups.group_close_vectors(frame).collect()
    links, want = brute_links(rows, 0.98)
    assert len(got) == len(rows)
    by_id = {rows[n][0]: v for n, v in links.items()}
    for r in got:
        if r["id"] is None:
            assert (r["n_links"], r["component"], r["kept"]) == (0, None, True)
        else:
            assert (r["id"], r["n_links"], r["component"]) == (r["id"], by_id[r["id"]], want[r["id"]])
    assert vector_dups.group_close_vectors(frame.limit(0)).count() == 0


def test_cover_tree_levels():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    todo, leaves = [vector_dups.cover_tree(x)], []
    while todo:
        node = todo.pop()
        assert np.linalg.norm(x[node.members] - x[node.centre], axis=1).max() <= node.radius + 1e-7
        if node.children:
            assert sorted(np.concatenate([c.members for c in node.children])) == sorted(node.members)
            assert node.children[0].centre == node.centre
            assert max(c.radius for c in node.children) <= node.radius
            todo += node.children
        else:
            leaves.append(node.members)
    assert sorted(np.concatenate(leaves)) == list(range(300))


def brute_top(rows, k):
    usable = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for n, (i, x) in enumerate(usable):
        if i % 50 == 0:
            cut = lambda v: max(-(2**63), min(2**63 - 1, v))
            scores = [(cut(sum(a * b for a, b in zip(x, y))), j) for j, y in usable if j != i and len(x) == len(y)]
            top = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
            out |= {(i, rank + 1, j, s) for rank, (s, j) in enumerate(top)}
    return out


@pytest.mark.parametrize("shard", [8192, 60])
def test_top_products(spark, monkeypatch, shard):
    monkeypatch.setattr(vector_search, "SHARD_ROWS", shard)
    monkeypatch.setattr(vector_search, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(vector_search, "SAMPLE", 40)
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.integers(-3, 4, 6) / 4]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(2000, None), (2050, [1.0, None]), (2100, [float("nan")]), (2150, [0.0] * 6)]
    rows += [(2200, [1.0, 2.0]), (2201, [2.0, 1.0]), (2250, []), (None, rows[0][1]), (3000, [2.0**120] * 6), (-50, [-1.0] * 6)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, score int, rank string")
    got = vector_search.top_products(frame)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 5)
    assert vector_search.top_products(frame.limit(0)).count() == 0


def test_ball_search_prunes():
    """Far groups are never scored once near ones fill the best list."""
    rng = np.random.default_rng(9)
    x = np.floor(rng.normal(size=(4000, 4)) * 5 + rng.choice([-1000, 1000], (4000, 1)))
    seen = []
    original = vector_search.products
    vector_search.products = lambda a, b: seen.append(len(b)) or original(a, b)
    try:
        vector_search.search(np.array([[900.0] * 4]), np.array([-1]), np.array([-(2**63)]), x, np.arange(4000), 5)
    finally:
        vector_search.products = original
    assert sum(seen) < 2500


def test_no_python_ids_leave_longs(spark):
    """Ids beyond 2**53 come back unchanged."""
    big = 2**60 + 1
    docs = spark.createDataFrame([(big, "a b c d e f", 0, ""), (big + 1, "a b c d e f", 0, "")], DOCS)
    assert {r["component"] for r in near_dups.group_near_duplicates(docs).collect()} == {big}
    frame = spark.createDataFrame([(big, [1.0], 1, ""), (big + 1, [2.0], 1, "")], VECTORS)
    assert {r["component"] for r in vector_dups.group_close_vectors(frame).collect()} == {big}
