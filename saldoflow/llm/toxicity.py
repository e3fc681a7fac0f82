"""Toxicity by non-negative positive-unlabelled learning.

Known are confirmed toxic texts and unlabelled ones, among which toxic ones occur at a
class prior. A linear classifier over the presence of words and word beginnings (once, twice,
three times) minimises the loss of the positives as positives, weighed with the prior,
plus the loss of the unlabelled as negatives less what the toxic share of them
contributes. That second part estimates the risk of the true negatives and cannot be below zero; when it is, the step
goes the other way, which keeps a flexible classifier from calling all positives' kin
negative.

The fit takes a sample, at most ``POSITIVES`` and ``UNLABELLED`` documents by a hash of
their id, and at most ``FEATURES`` features; every document is scored on its whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from saldoflow.llm.common import crc_mod, worker_cache
from saldoflow.llm.components import cut

POSITIVES, UNLABELLED, FEATURES = 3000, 9000, 4096
#: A feature is in this many positives at least, this many times as common there as in
#: negatives, and so many standard deviations more often than these would have it.
LEAST, LIFT, DEVIATIONS = 4, 2.5, 6.0
_CACHE_WORDS = 500_000
_MARKS = ("", " 2", " 3")
_STRIP = ".,;:!?\"'()[]{}<>*-"


def features(word: str) -> tuple[str, ...]:
    """A lower-case word without marks at its ends, and its beginnings."""
    word = word.strip(_STRIP)
    return (word, *(f"{word[:k]}*" for k in (4, 5, 6) if len(word) > k)) if len(word) > 2 else ()


def present_features(text: str | None) -> set[str]:
    """Each feature of a text, and again with a mark for two and three occurrences or more."""
    counts = Counter()
    for word, n in Counter((text or "").lower().split()).items():
        for f in features(word):
            counts[f] += n
    return {f + mark for f, n in counts.items() for k, mark in enumerate(_MARKS, 1) if n >= k}


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", positives: int = POSITIVES,
           unlabelled: int = UNLABELLED) -> DataFrame:
    """(doc_id, kind, features): kind 1 for confirmed positives, 0 for unlabelled ones.

    The unlabelled sample is drawn from all given documents, so it holds positives too.
    Rows that repeat an id count once; null ids are left out.
    """
    head = lambda rows, salt, n: rows.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy(
        F.xxhash64(F.lit(salt), "doc_id"), "doc_id").limit(n)
    chosen = head(labels.filter(F.col(label) == 1), 1, positives).withColumn("kind", F.lit(1)).unionByName(
        head(docs, 2, unlabelled).withColumn("kind", F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(present_features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("kind"), pa.array(found, pa.list_(pa.string()))],
                names=["doc_id", "kind", "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    # The sample's size bounds the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.mapInArrow(run, f"doc_id {kind}, kind int, features array<string>").dropDuplicates(["doc_id", "kind"])


def select(found: DataFrame, limit: int = FEATURES, prior: float = 0.0) -> list[str]:
    """Features much more common in positives than in negatives, the commonest first.

    A feature's rate in negatives is that in the unlabelled less what the share ``prior`` of
    positives among them contributes.
    """
    totals = {r["kind"]: r["n"] for r in found.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    positives, unlabelled = totals.get(1, 0), totals.get(0, 0)
    if not positives or not unlabelled:
        return []
    counts = found.select("kind", F.explode("features").alias("f")).groupBy("f").agg(
        F.sum("kind").alias("p"), F.sum(1 - F.col("kind")).alias("u"))
    negatives = unlabelled * (1 - prior)
    # Two standard deviations of the count are left to the negatives, as the difference of two samples is not exact.
    others = F.greatest(F.col("u") - prior * unlabelled * F.col("p") / positives, F.lit(0.0)) + 2 * F.sqrt(F.col("u"))
    rate = F.least((F.col("u") + 1) / unlabelled, (others + 1) / negatives)
    lift = (F.col("p") / positives) / rate
    expected = positives * rate
    surplus = (F.col("p") - expected) / F.sqrt(expected)
    rows = counts.filter((F.col("p") >= LEAST) & (lift >= LIFT) & (surplus >= DEVIATIONS)).orderBy(
        F.desc("p"), "f").limit(limit).collect()
    return [r["f"] for r in rows]


def fit(rows: list[list[int]], kinds: np.ndarray, width: int, prior: float, steps: int = 400,
        rate: float = 0.05, shrink: float = 1e-4) -> np.ndarray:
    """Weights of the features and, last, the constant, by Adam on the non-negative risk.

    rows: the features present in each sampled text. Without positives or unlabelled
    texts the classifier answers the prior.
    """
    positive, other = kinds == 1, kinds == 0
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    if not positive.any() or not other.any() or not width:
        return w
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    index = np.concatenate([np.array(r, int) for r in rows]) if len(owner) else np.zeros(0, int)
    share = np.where(positive, prior / positive.sum(), 1 / max(1, other.sum()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        f = np.bincount(owner, w[index], len(rows)) + w[-1]
        p = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        as_negative = np.logaddexp(0, f)
        negatives = (share * as_negative)[other].sum() - (share * as_negative)[positive].sum()
        if negatives >= 0:
            # loss of positives as positives minus as negatives has the slope -1 for the logistic loss
            slope = share * np.where(positive, -1.0, p)
        else:
            slope = share * np.where(positive, p, -p)
        g = np.concatenate([np.bincount(index, slope[owner], width), [slope.sum()]])
        g[:-1] += shrink * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> dict[str, float]:
    """Weight of each feature; the constant is under the empty text.

    The class prior is the share of positives among the labelled rows. Leave held-out rows
    out of both tables before.
    """
    found = cut(sample(docs, labels, label))
    n, toxic = labels.agg(F.count(label), F.sum(F.col(label).cast("long"))).first()
    prior = min(max((toxic or 0) / max(1, n), 1e-4), 0.9)
    names = select(found, prior=prior)
    place = {n: k for k, n in enumerate(names)}
    inside = F.filter("features", lambda f: f.isin(names)) if len(names) < 50 else F.array_intersect(
        "features", F.array(*[F.lit(n) for n in names]))
    rows = found.orderBy("kind", "doc_id").select("kind", inside.alias("features")).collect()
    w = fit([[place[f] for f in r["features"]] for r in rows], np.array([r["kind"] for r in rows]), len(names), prior)
    return {**dict(zip(names, w.tolist())), "": float(w[-1])}


def score(docs: DataFrame, model: dict[str, float], to: str = "score") -> DataFrame:
    """``docs`` with the probability of toxicity of every whole text; null counts as empty.
    All other columns stay; one with the score's name is replaced. Rows are scored one by
    one: repeated rows get equal scores, ties need nothing, an empty table gives an empty one."""
    kept = [f for f in docs.schema.fields if f.name != to]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES bounds it
    key = str(hash(tuple(sorted(model.items()))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        known = worker_cache("toxicity " + key)
        base, stems = weights[""], {f.partition(" ")[0] for f in weights if f}
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                words = (text or "").lower().split()
                counts = Counter()
                for word, has in zip(words, map(known.get, words)):
                    if has is None:
                        has = known.get(word)
                        if has is None:
                            if len(known) >= _CACHE_WORDS:
                                known.clear()
                            has = known[word] = tuple(f for f in features(word) if f in stems)
                    if has:
                        counts.update(has)
                present = [f + mark for f, n in counts.items() for k, mark in enumerate(_MARKS, 1)
                           if n >= k and f + mark in weights]
                out.append(base + sum(sorted(weights[f] for f in present)))
            f = np.clip(np.array(out, float), -500, 500)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(1 / (1 + np.exp(-f)))], names=[*names, to])

    return docs.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(
        run, T.StructType([*kept, T.StructField(to, T.DoubleType())]))


def training(rows: DataFrame) -> DataFrame:
    """Rows of documents or labels that are not held out."""
    return rows.filter(crc_mod(F.col("doc_id"), 4) != 2)
