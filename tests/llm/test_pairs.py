"""Cover tree and SimHash against comparing all pairs, on small hand-made tables."""

import numpy as np
import pytest
import xxhash

from saldoflow.llm import covertree, simhash
from saldoflow.llm.components import components, local_roots

VECTORS = "vec_id long, embedding array<float>, label int"


def smallest_reachable(ids, linked):
    """ids by index, linked(i, j): component id by index."""
    group = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if i != j and linked(i, j) and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    return [min((ids[j] for j in range(len(ids)) if group[j] == group[i] and ids[j] is not None), default=None)
            for i in range(len(ids))]


def test_components_of_chain_star_and_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200, 202: 200}


def test_local_roots():
    root = local_roots(6, np.array([0, 4, 3]), np.array([3, 5, 4]))
    assert root.tolist() == [0, 1, 2, 0, 0, 0]


def vectors():
    draw = np.random.default_rng(3)
    rows = []
    for c in range(6):
        centre = draw.normal(size=8)
        for k in range(9):
            rows.append((len(rows), (centre + draw.normal(size=8) * 0.12).tolist(), c % 2))
    rows += [(100, rows[0][1], 0), (101, rows[0][1], 1), (102, [2 * x for x in rows[1][1]], 0), (103, None, 0),
             (104, [], 0), (105, [0.0] * 8, 0), (106, [float("nan")] + [1.0] * 7, 0), (107, [None] + [1.0] * 7, 0),
             (108, [float("inf")] + [1.0] * 7, 0), (109, rows[0][1], None), (110, rows[0][1][:5], 0),
             (5, rows[5][1], 1), (None, rows[2][1], 0), (111, [1e-30] * 8, 1), (112, [2e-30] * 8, 1)]
    return rows


def brute_vectors(rows, cosine):
    def usable(r):
        return r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    v = [np.array(r[1], np.float32).astype(float) if usable(r) else None for r in rows]

    def linked(i, j):
        if v[i] is None or v[j] is None or rows[i][2] != rows[j][2] or len(v[i]) != len(v[j]):
            return False
        return v[i] @ v[j] / (np.linalg.norm(v[i]) * np.linalg.norm(v[j])) >= cosine
    part = smallest_reachable([r[0] for r in rows], linked)
    return sorted(((r[0], sum(linked(i, j) for j in range(len(rows)) if j != i), part[i])
                   for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("leaf,levels", [(1024, 12), (4, 12), (3, 0)])
def test_cover_tree_is_all_pairs(spark, monkeypatch, leaf, levels):
    monkeypatch.setattr(covertree, "LEVELS", levels)
    rows = vectors()
    frame = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS item", "'x' AS node", "2 AS space")
    got = covertree.near_duplicates(frame, 0.9, leaf).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute_vectors(rows, 0.9)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_cover_tree_of_an_empty_table(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def test_traversal_of_two_trees():
    draw = np.random.default_rng(5)
    a, b = draw.normal(size=(300, 3)), draw.normal(size=(200, 3))
    unit = lambda z: z / np.linalg.norm(z, axis=1, keepdims=True)
    i, j = covertree.dual(covertree.Tree(unit(a)), covertree.Tree(unit(b)), a, b, 0.98, False)
    want = np.argwhere(unit(a) @ unit(b).T >= 0.98)
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(map(tuple, want.tolist()))


def test_leaves_grow_with_their_space(spark, monkeypatch):
    """A vector is sent to a bounded number of leaves, and as given, whatever its space holds."""
    sent = []
    keep = covertree.settle
    monkeypatch.setattr(covertree, "settle", lambda df, name="stage": sent.append((name, keep(df, name))) or sent[-1][1])
    for n in (400, 1600):
        draw = np.random.default_rng(n)
        rows = [(k, draw.normal(size=24).tolist(), 0) for k in range(n)]
        rows += [(n + k, [1.0001 * x + 0.001 for x in rows[k][1]], 0) for k in range(0, n, 9)]
        got = covertree.near_duplicates(spark.createDataFrame(rows, VECTORS), 0.98, 16).collect()
        v = np.array([r[1] for r in rows], np.float32).astype(float)
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        linked = (v @ v.T >= 0.98).sum(axis=1) - 1
        assert {r.vec_id: r.n_links for r in got} == {r[0]: int(c) for r, c in zip(rows, linked)}
    leaves = [df.filter("leaf").count() for name, df in sent if name == "nodes"]
    assert leaves[1] < 2 * leaves[0], leaves


def test_trees_of_many_unlike_vectors_compare_by_products():
    draw = np.random.default_rng(8)
    unit = lambda z: z / np.linalg.norm(z, axis=1, keepdims=True)
    a = draw.normal(size=(3000, 32))
    a[1000:1100] = a[:100] * 2 + draw.normal(size=(100, 32)) * 0.01
    a[2000:2010] = a[5]
    x = unit(a)
    tree = covertree.Tree(x)
    assert sorted(tree.order.tolist()) == list(range(3000))
    for k in range(len(tree.centre)):
        below = x[tree.order[tree.first[k]:tree.last[k]]]
        assert np.linalg.norm(below - x[tree.centre[k]], axis=1).max() <= tree.radius[k] + 1e-12
    i, j = covertree.dual(tree, tree, a, a, 0.98, True)
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(map(tuple, np.argwhere(np.triu(x @ x.T >= 0.98, 1)).tolist()))


def plain_fingerprint(text, k):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
             .replace("\n", " ").split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def texts():
    draw = np.random.default_rng(1)
    word = lambda: "".join(draw.choice(list("abcdeÉß"), 4))
    out = []
    for _ in range(6):
        base = [word() for _ in range(120)]
        for k in range(4):
            copy = list(base)
            copy[5 * k] = word()
            out.append(" ".join(copy))
    return out + [out[0], out[0].upper().replace("É", "É"), None, "", " \n\t", "one two", "One\ttwo", "x " * 20000]


def test_simhash_is_all_pairs(spark):
    rows = [(i, t, "a") for i, t in enumerate(texts())] + [(3, "one two", "b"), (None, "one two", "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicates(frame, shingle=4, radius=6).collect()
    prints = [plain_fingerprint(t, 4) for _, t, _ in rows]
    part = smallest_reachable([r[0] for r in rows], lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 6)
    want = sorted(((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, part)), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert simhash.near_duplicates(frame.limit(0)).collect() == []


def test_masks_cover_every_difference():
    draw = np.random.default_rng(2)
    for radius, positions in ((4, list(range(64))), (2, list(range(0, 64, 3)))):
        covers = simhash.masks(positions, radius)
        for _ in range(2000):
            flips = sum(1 << int(p) for p in draw.choice(positions, radius, replace=False))
            assert any(flips & m == 0 for m in covers)


@pytest.mark.parametrize("bucket", [4096, 5])
def test_crowded_buckets_lose_no_link(spark, bucket):
    draw = np.random.default_rng(4)
    centre = int(draw.integers(1 << 62))
    prints = sorted({centre ^ sum(1 << int(p) for p in draw.choice(64, int(draw.integers(0, 9)), replace=False))
                     for _ in range(300)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4, bucket)
    got = {r.node: r.component for r in components(links).collect()}
    part = smallest_reachable(signed, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert {s: c for s, c in zip(signed, part) if part.count(c) > 1} == got


def test_flips_find_all_close_pairs():
    draw = np.random.default_rng(6)
    values = np.unique(draw.integers(0, 1 << 14, 3000)).astype(np.uint64)
    i, j = simhash._by_flips(values, 4)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    assert sorted(zip(i.tolist(), j.tolist())) == sorted(map(tuple, np.argwhere(np.triu(near, 1)).tolist()))


def test_simhash_of_bytes_that_are_no_utf8(spark, tmp_path):
    spark.sql("SELECT 1L AS doc_id, CAST(unhex('61FF20622063') AS STRING) AS text UNION ALL SELECT 2L, 'One'").write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(spark.read.parquet(str(tmp_path / "d"))).collect()}
    assert got == {1: f"{xxhash.xxh64_intdigest(bytes.fromhex('61FF20622063'), 42):016x}", 2: f"{xxhash.xxh64_intdigest(b'one', 42):016x}"}
