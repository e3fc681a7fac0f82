"""Threshold-algorithm hard negatives against scoring every pair."""

import math

import numpy as np

from saldoflow.llm import negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor_every=50, npos=5, nneg=3):
    use = []
    for vid, emb, lab in rows:
        if lab is None or emb is None or any(x is None or not math.isfinite(x) for x in emb):
            continue
        if vid % 7 == 0:
            lab = (lab + 1) % 10
        use.append((vid, lab, [math.floor(256 * float(x)) for x in emb]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out, done = [], set()
    for aid, alab, av in use:
        if aid % anchor_every or aid in done:
            continue
        done.add(aid)
        same = sorted(((-dot(av, v), vid) for vid, lab, v in use if lab == alab and vid != aid))[:npos]
        for nps, pid in same:
            ps = -nps
            band = sorted((-dot(av, v), vid) for vid, lab, v in use
                          if lab != alab and 50 * ps <= 100 * dot(av, v) <= 95 * ps)[:nneg]
            out += [(aid, pid, k + 1, vid, ps, -s) for k, (s, vid) in enumerate(band)]
    return sorted(out)


def table(n, seed, dim=8):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = draw.normal(size=dim).astype(np.float32)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], int(draw.integers(0, 3))))
    return rows


def got(spark, rows):
    return sorted(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, VECTORS)).collect())


def test_against_all_pairs_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS_PER_BLOCK", 64)
    monkeypatch.setattr(negatives, "ANCHORS_PER_BLOCK", 2)
    rows = table(400, 1)
    rows[3] = (3, None, 1)
    rows[5] = (5, [float("nan")] + rows[5][1][1:], 1)
    rows[9] = (9, rows[9][1], None)
    rows[11] = (11, [None] + rows[11][1][1:], 2)
    rows += [rows[100], rows[150]]  # repeated rows, one of them an anchor
    assert got(spark, rows) == brute(rows)


def test_ties_zero_vectors_and_lengths(spark):
    rows = [(0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, [1.0, 0.5], 0), (3, [0.5, 0.25], 1), (4, [0.5, 0.25], 1),
            (6, [0.6, 0.3, 0.0], 1), (8, [0.0, 0.0], 2), (50, [0.0, 0.0], 0), (10, [], 1)]
    assert got(spark, rows) == brute(rows)


def test_empty_and_no_anchor(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []


def test_lists_are_read_until_every_row_is_seen():
    import pandas as pd
    draw = np.random.default_rng(5)
    m = np.floor(256 * draw.normal(size=(4096, 64)) / 8).astype(np.int64)
    frame = pd.DataFrame({"vec_id": np.arange(4096), "label": 0, "vec": list(m)})
    lists = negatives._block(frame.iloc[:1], frame)[1]
    rounds = list(lists.walk(m[0]))
    assert sorted(np.concatenate([got for got, _ in rounds]).tolist()) == list(range(4096))
    assert rounds[-1][1] == -math.inf and sum(negatives.STEP << i for i in range(len(rounds))) < 2048
    seen = set()
    for got, threshold in rounds:  # no unseen row scores above the threshold
        seen.update(got.tolist())
        rest = [i for i in range(4096) if i not in seen]
        assert not rest or (m[rest] @ m[0]).max() <= threshold
        assert (lists.scores(got, m[0]) == m[got] @ m[0]).all()


def test_scores_beyond_what_floats_hold(spark):
    rows = [(0, [3e6, 1.0], 0), (1, [3e6, 2.0], 0), (2, [3e6, 3.0], 0), (3, [2e6, 0.25], 1), (4, [2e6, 0.5], 1),
            (6, [2e6, 0.75], 1), (8, [-2e6, 1.0], 2)]
    assert got(spark, rows) == brute(rows)
    assert negatives._exact_type(np.full((1, 2), 1 << 40), np.full((1, 2), 1 << 20)) is np.int64
