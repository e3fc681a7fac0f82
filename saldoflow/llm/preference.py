"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a weighted sum of measures of its text. From labelled documents
pairs are drawn in which one is preferred, and the weights minimise the logistic loss of
the pairs' differences in measures. Strengths have no zero of their own, so the threshold
is a quantile of the strengths of the labelled documents: the level that agrees best with
their labels, in the middle of the widest gap if several do.

Only the fit uses a sample, at most ``PER_LABEL`` labelled documents of each label chosen
by a hash of their id; every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from saldoflow.llm.common import crc_mod, fresh, plain_names

#: Labelled documents of each label that the fit takes at most.
PER_LABEL = 4000
#: Pairs that each sampled document is in, at least.
PAIRS = 8
_DROP = {"symbols": b"#*$%&<>~^=_\\{}[]@", "shouts": b"!", "bars": b"|", "stops": b".", "commas": b",;:",
         "upper": string.ascii_uppercase.encode(), "digits": string.digits.encode()}
#: Length of :func:`measure`.
WIDTH = 30


def measure(text: str | None) -> list[float]:
    """Measures of a whole text; those of an empty or null text are defined as zero."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * WIDTH
    raw = text.encode("utf-8")
    count = {k: len(raw) - len(raw.translate(None, v)) for k, v in _DROP.items()}
    letters = max(1, len(raw) - count["symbols"] - count["bars"])
    lines = [x for x in text.split("\n") if x]
    windows = max(1, n - 2)
    shares = [
        count["symbols"] / n, count["shouts"] / n, count["bars"] / n, count["upper"] / letters,
        count["digits"] / letters, max(0.0, 0.05 - count["stops"] / n) * 20, count["commas"] / n,
        1 - len(set(words)) / n, sum(map(eq, words, words[1:])) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / windows if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        max(0.0, 0.15 - sum(map((3).__ge__, map(len, words))) / n) * 6,
        abs(len(text) / n - 6) / 6, len(lines) / n, max(map(len, words)) / 100]
    return [min(x, 3.0) for x in shares] + [x / (x + 0.1) for x in shares]


def sample(labels: DataFrame, label: str, per_label: int = PER_LABEL) -> DataFrame:
    """(doc_id, label) of labelled rows, at most so many of each label by a hash of the id.

    An id that is labelled twice with the same label counts once, with both labels it is
    in both samples; null labels are left out.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    # Each is a bounded head of a sort.
    one = lambda v: rows.filter(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
    return one(0).unionByName(one(1))


def measured(docs: DataFrame, chosen: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Measures and labels of the sampled documents, on the driver; the sample bounds them.

    Rows that repeat an id with other texts count as one, by their mean.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label")] + [
                pa.array([f[k] for f in found], pa.float64()) for k in range(WIDTH)],
                names=["doc_id", "label", *[f"m{k}" for k in range(WIDTH)]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    names = [f"m{k}" for k in range(WIDTH)]
    rows = texts.mapInArrow(run, f"doc_id {kind}, label int, " + ", ".join(f"{n} double" for n in names))
    rows = rows.groupBy("doc_id", "label").agg(*[F.avg(n).alias(n) for n in names]).orderBy("doc_id", "label").collect()
    return (np.array([[r[n] for n in names] for r in rows], float).reshape(-1, WIDTH),
            np.array([r["label"] for r in rows], int))


def fit(x: np.ndarray, y: np.ndarray, share_good: float, seed: int = 7) -> dict:
    """Weights and threshold from measures and labels; ``share_good`` weighs the labels.

    With one label only there is nothing to rank: all weights are zero and every document
    gets that label.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return {"mean": np.zeros(WIDTH), "weights": np.zeros(WIDTH), "cut": 0.0 if len(good) else 1.0}
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / spread
    draw = np.random.default_rng(seed)
    n = PAIRS * max(len(good), len(bad))
    first = np.concatenate([np.repeat(good, PAIRS), draw.choice(good, PAIRS * len(bad))])
    second = np.concatenate([draw.choice(bad, PAIRS * len(good)), np.repeat(bad, PAIRS)])
    diff = z[first] - z[second]
    w = np.zeros(WIDTH)
    for _ in range(30):  # Newton steps on the logistic loss with a little shrinkage
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -40, 40)))
        gradient = diff.T @ (p - 1) + 1e-3 * n * w
        curve = (diff * (p * (1 - p))[:, None]).T @ diff + 1e-3 * n * np.eye(WIDTH)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    weight = np.where(y == 1, share_good / len(good), (1 - share_good) / len(bad))
    order = np.argsort(s, kind="stable")
    s, y, weight = s[order], y[order], weight[order]
    # Right below a cut after k documents: bad ones; above: good ones.
    right = np.concatenate([[0], np.cumsum(weight * (y == 0))]) + np.concatenate(
        [[0], np.cumsum((weight * (y == 1))[::-1])])[::-1]
    gap = np.concatenate([[1.0], np.diff(s), [1.0]])
    right[gap <= 0] = -1  # no cut between equal strengths
    best = np.flatnonzero(right >= right.max() - 1e-12)
    k = best[np.argmax(gap[best])]
    cut = s[0] - 0.5 if k == 0 else s[-1] + 0.5 if k == len(s) else (s[k - 1] + s[k]) / 2
    return {"mean": mean, "weights": w / spread, "cut": float(cut)}


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL) -> dict:
    """Fit on the given labels (leave held-out rows away before)."""
    x, y = measured(docs, sample(labels, label, per_label))
    counts = {r["label"]: r["n"] for r in labels.groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count("*").alias("n")).filter(F.col("label").isin(0, 1)).collect()}
    return fit(x, y, counts.get(1, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, model: dict, to: str = "score") -> DataFrame:
    """``docs`` with the probability-like score in (0, 1) of every whole text; 0.5 is the
    threshold. Null and empty texts are scored as empty. All other columns stay, whatever
    their names; one with the score's name is replaced. Rows are scored one by one:
    repeated rows get equal scores, an empty table gives an empty one."""
    kept = [f for f in docs.schema.fields if f.name != to]
    given = [f.name for f in kept]
    names = plain_names(given)
    inner = fresh("_score", names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([measure(t) for t in batch.column("text").to_pylist()]).reshape(-1, WIDTH)
            s = (x - model["mean"]) @ model["weights"] - model["cut"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(1 / (1 + np.exp(-np.clip(s, -500, 500))))],
                names=[*names, inner])

    schema = T.StructType([*[T.StructField(n, f.dataType, f.nullable) for n, f in zip(names, kept)],
                           T.StructField(inner, T.DoubleType())])
    out = docs.select(*[F.col(f"`{g}`").alias(n) for g, n in zip(given, names)]).mapInArrow(run, schema)
    return out.select(*[F.col(f"`{n}`").alias(g) for g, n in zip(given, names)], F.col(inner).alias(to))


def training(labels: DataFrame) -> DataFrame:
    """Labelled rows that are not held out."""
    return labels.filter(crc_mod(F.col("doc_id"), 3) != 1)
