"""Hard negatives by Fagin's threshold algorithm over integer vectors.

The anchors (a stated query set) meet all rows in blocks: a pair of an anchor block
and a row block is one task. Inside a task every dimension of the row block is
sorted once; an anchor reads these lists from the end its sign favours (sorted
access), scores each newly seen row exactly in integers (random access) and stops
once the threshold - the best score an unseen row could still have - is strictly
below the k-th score of every window it fills. Block results are merged by score.

Two passes: the first finds each anchor's positives (same label), the second the
negatives of every anchor and positive (other label, score in a band below the
positive's).

Defined cases: rows with a null label, a null vector or any null, NaN or infinite
component take no part; vectors of different lengths are compared as if padded
with zeros; an empty table or no anchor gives no rows. Repeated rows each take part
as a row of their own (ties by vec_id may then show equal rows twice), except that of
rows repeating an anchor's vec_id only the first written is the anchor; no row with
the anchor's vec_id is its positive. Ties in score go to the smaller vec_id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from saldoflow.session import settle

#: Rows of one block, scored in one task; anchors of one block.
ROWS_PER_BLOCK = 16_384
ANCHORS_PER_BLOCK = 1_024
#: Depth of sorted access between two threshold tests.
STEP = 16

WINDOW = "vec_id long, label int, vec array<long>, _row long"
PAIR_ROWS = "anchor_id long, positive_id long, positive_score long"
NEG_ROWS = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _valid(vec: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vec.isNotNull() & F.forall(vec, finite)


def prepared(embeddings: DataFrame, relabel_every: int = 7, scale: int = 256) -> DataFrame:
    """(vec_id, label, vec, _row): usable rows, relabelled, components floor(scale * x) as integers.

    Written once, so block numbers stay the same when a lost task is run again.
    """
    vec = F.col("embedding").cast("array<double>")
    label = F.when(F.col("vec_id") % relabel_every == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = (embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), vec.alias("_v"))
            .filter(F.col("label").isNotNull() & _valid(F.col("_v")))
            .select("vec_id", label.alias("label"),
                    F.transform("_v", lambda x: F.floor(x * scale).cast("long")).alias("vec"),
                    F.monotonically_increasing_id().alias("_row")))
    return settle(rows, "negatives-rows")


def _matrix(vecs, dim: int) -> np.ndarray:
    out = np.zeros((len(vecs), dim), dtype=np.int64)
    for i, v in enumerate(vecs):
        out[i, :len(v)] = v
    return out


def _exact_type(rows: np.ndarray, anchors: np.ndarray):
    """The fastest type that holds every score, and every partial sum of one, exactly."""
    largest = [max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0 for x in (rows, anchors)]
    bound = rows.shape[1] * largest[0] * largest[1]
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64


class _Lists:
    """Per-dimension sorted access over one block of rows, random access for its anchors."""

    def __init__(self, rows: pd.DataFrame, anchors: np.ndarray):
        self.ids = rows["vec_id"].to_numpy(dtype=np.int64)
        self.labels = rows["label"].to_numpy(dtype=np.int64)
        m = _matrix(rows["vec"], anchors.shape[1])
        # Line d: rows by component d, largest first.
        self.desc = np.argsort(-np.ascontiguousarray(m.T), axis=1, kind="stable").astype(np.int32)
        self.type = _exact_type(m, anchors)
        self.m = m.astype(self.type)

    def scores(self, rows: np.ndarray, a: np.ndarray) -> np.ndarray:
        return (self.m[rows] @ a.astype(self.type)).astype(np.int64)

    def walk(self, a: np.ndarray):
        """Yield (new row indexes, threshold) round by round; the threshold bounds all unseen rows.

        Each round reads twice as deep as the one before, so an anchor takes few rounds;
        testing the threshold less often never stops too early. A row is met by the list
        that shows it first, so all rows are seen long before the lists end; nothing is
        unseen from there on and no list is read further.
        """
        n = len(self.ids)
        up, down = np.flatnonzero(a > 0), np.flatnonzero(a < 0)
        if n == 0:
            return
        if up.size + down.size == 0:  # every score is 0: all rows at once, nothing unseen
            yield np.arange(n), -math.inf
            return
        unseen, left = np.ones(n, dtype=bool), n
        start, step = 0, STEP
        while start < n:
            end = min(start + step, n)
            met = np.zeros(n, dtype=bool)
            met[self.desc[up, start:end]] = True
            met[self.desc[down, n - end:n - start]] = True
            met &= unseen
            got = np.flatnonzero(met)
            unseen[got] = False
            left -= len(got)
            if left == 0:
                yield got, -math.inf
                return
            last = sum(int(np.dot(self.m[self.desc[side, at], side].astype(np.int64), a[side]))
                       for side, at in ((up, end - 1), (down, n - end)))
            yield got, last
            start, step = end, step * 2


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the first k by score descending, then id ascending."""
    if len(scores) <= k:
        return np.lexsort((ids, -scores))
    # Only those that reach the k-th score are sorted.
    some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def _block(anchors: pd.DataFrame, rows: pd.DataFrame) -> tuple[np.ndarray, _Lists]:
    dim = max(max(map(len, anchors["vec"]), default=0), max(map(len, rows["vec"]), default=0))
    av = _matrix(anchors["vec"], dim)
    return av, _Lists(rows, av)


def _positives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    if len(anchors) and len(rows):
        av, lists = _block(anchors, rows)
        for a_id, a_label, a in zip(anchors["vec_id"], anchors["label"], av):
            s_all, i_all = np.empty(0, np.int64), np.empty(0, np.int64)
            for got, threshold in lists.walk(a):
                keep = got[(lists.labels[got] == a_label) & (lists.ids[got] != a_id)]
                s_all = np.concatenate([s_all, lists.scores(keep, a)])
                i_all = np.concatenate([i_all, keep])
                best = _top(s_all, lists.ids[i_all], k)
                s_all, i_all = s_all[best], i_all[best]
                if len(s_all) == k and threshold < s_all[-1]:
                    break
            out += [(int(a_id), int(lists.ids[i]), int(s)) for i, s in zip(i_all, s_all)]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])


def _negatives(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """Windows: low * ps <= 100 * ns <= high * ps, other label than the anchor."""
    out = []
    if len(anchors) and len(rows):
        av, lists = _block(anchors, rows)
        for a_id, a_label, a, pos in zip(anchors["vec_id"], anchors["label"], av, anchors["positives"]):
            wins = [(int(p["positive_id"]), int(p["positive_score"])) for p in pos]
            wins = [(pid, ps) for pid, ps in wins if low * ps <= high * ps]  # others are empty
            if not wins:
                continue
            floor, top = min(low * ps for _, ps in wins), max(high * ps for _, ps in wins)
            sc, ix = np.empty(0, np.int64), np.empty(0, np.int64)
            found = [slice(0, 0)] * len(wins)
            for got, threshold in lists.walk(a):
                other = got[lists.labels[got] != a_label]
                s = lists.scores(other, a)
                inside = (100 * s >= floor) & (100 * s <= top)
                sc, ix = np.concatenate([sc, s[inside]]), np.concatenate([ix, other[inside]])
                order = np.lexsort((lists.ids[ix], -sc))
                sc, ix = sc[order], ix[order]
                down, done = -100 * sc, True
                keep = np.zeros(len(sc), dtype=bool)
                for w, (pid, ps) in enumerate(wins):
                    # A window is a stretch of the sorted scores; its first k are kept.
                    first, last = np.searchsorted(down, -high * ps), np.searchsorted(down, -low * ps, "right")
                    last = min(last, first + k)
                    found[w] = slice(first, last)
                    keep[first:last] = True
                    if last - first == k:
                        done &= bool(threshold < sc[last - 1])
                    else:
                        done &= bool(100 * threshold < low * ps)
                if done:
                    break
                place = np.cumsum(keep) - keep
                found = [slice(place[f.start], place[f.start] + f.stop - f.start) if f.stop > f.start else slice(0, 0)
                         for f in found]
                sc, ix = sc[keep], ix[keep]
            for (pid, ps), f in zip(wins, found):
                out += [(int(a_id), pid, ps, int(lists.ids[i]), int(s)) for i, s in zip(ix[f], sc[f])]
    return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def _paired(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int):
    """Every anchor block meets every row block: the pair number is the key of both sides."""
    a_blocks = max(1, math.ceil(n_anchors / ANCHORS_PER_BLOCK))
    r_blocks = max(1, math.ceil(n_rows / ROWS_PER_BLOCK))
    a = anchors.withColumn("_rb", F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1)))).withColumn(
        "_pair", (F.col("_row") % a_blocks) * r_blocks + F.col("_rb"))
    r = rows.withColumn("_ab", F.explode(F.sequence(F.lit(0), F.lit(a_blocks - 1)))).withColumn(
        "_pair", F.col("_ab") * r_blocks + F.col("_row") % r_blocks)
    return a, r


def _fresh(df: DataFrame, *names: str) -> DataFrame:
    """The named columns as new attributes: both sides of a cogroup come from one table."""
    return df.select(*[F.col(n).alias(n) for n in names])


def _paired_by_label(anchors: DataFrame, rows: DataFrame):
    """Positives share the anchor's label: anchor blocks meet only row blocks of their label.

    Blocks are counted per label, so a label with a third of all rows has as many blocks as
    its size asks for, and no label gathers in one task.
    """
    counts = (rows.groupBy("label").agg(F.count("*").alias("_nr"))
              .join(anchors.groupBy("label").agg(F.count("*").alias("_na")), "label")
              .select("label", F.ceil(F.col("_nr") / ROWS_PER_BLOCK).cast("long").alias("_rb_n"),
                      F.ceil(F.col("_na") / ANCHORS_PER_BLOCK).cast("long").alias("_ab_n")))
    pair = lambda ab, rb: F.concat_ws(":", F.col("label").cast("string"), ab.cast("string"), rb.cast("string"))
    a = (anchors.join(counts, "label")
         .withColumn("_rb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rb_n") - 1)))
         .withColumn("_pair", pair(F.col("_row") % F.col("_ab_n"), F.col("_rb"))))
    r = (rows.join(counts, "label")
         .withColumn("_ab", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_ab_n") - 1)))
         .withColumn("_pair", pair(F.col("_ab"), F.col("_row") % F.col("_rb_n"))))
    return a, r


def _first(df: DataFrame, keys: list[str], score: str, tie: str, k: int, rank: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(tie).asc())
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def mine(embeddings: DataFrame, anchor_every: int = 50, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor.

    Anchors are rows whose vec_id is divisible by ``anchor_every``; positives the first
    ``positives`` other same-label rows by score (ties: smaller vec_id); negatives the first
    ``negatives`` other-label rows with low * ps <= 100 * ns <= high * ps.
    """
    rows = prepared(embeddings)
    candidates = rows.filter(F.col("vec_id") % anchor_every == 0)
    # Of rows repeating an anchor's vec_id, the first written is the anchor.
    first = candidates.groupBy("vec_id").agg(F.min("_row").alias("_row"))
    anchors = candidates.join(first, ["vec_id", "_row"])
    n_rows, n_anchors = rows.count(), anchors.count()
    if n_rows == 0 or n_anchors == 0:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                     "positive_score long, negative_score long")
    a, r = _paired_by_label(anchors, rows)
    side = ["vec_id", "label", "vec"]
    found = (_fresh(a, "_pair", *side).groupBy("_pair")
             .cogroup(_fresh(r, "_pair", *side).groupBy("_pair"))
             .applyInPandas(lambda x, y: _positives(x, y, positives), PAIR_ROWS))
    pos = settle(_first(found, ["anchor_id"], "positive_score", "positive_id", positives, "_k").drop("_k"),
                 "negatives-positives")
    with_pos = anchors.join(
        pos.groupBy(F.col("anchor_id").alias("vec_id"))
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")), "vec_id")
    a2, r2 = _paired(with_pos, rows, n_anchors, n_rows)
    neg = (_fresh(a2, "_pair", *side, "positives").groupBy("_pair")
           .cogroup(_fresh(r2, "_pair", *side).groupBy("_pair"))
           .applyInPandas(lambda x, y: _negatives(x, y, negatives, low, high), NEG_ROWS))
    # An anchor row that is repeated meets each row once per copy: keep one copy of each result.
    neg = neg.dropDuplicates(["anchor_id", "positive_id", "negative_id", "negative_score"])
    top = _first(neg, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank")
    return top.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id",
                      "positive_score", "negative_score")
