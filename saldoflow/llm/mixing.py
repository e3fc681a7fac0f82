"""Mixing sources to target weights by Pareto order sampling.

A source's target is its share of all words by weight, at most ``limit`` times its own
words; what a limit cuts off is shared again by weight among the others. A target is
met by a number of whole copies of every document, certain for all, and a sample for
the rest. For the sample each document has an inclusion probability that grows with
the square root of its size, and documents are ranked by random odds over inclusion
odds. The sample is the head of that order, up to the document with which its words
come nearest the rest of the target, so its size is fixed by the target; last, one
more document of the remaining order is added or one of the head left out if that
brings the words nearer still.

The random number of a document is a hash of seed and id, so reruns and other
partitionings agree. No source is sorted in one task: the order is first cut into
cells, whose words are summed with a combine before the shuffle; only the cell in which
the target is reached is ranked document by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from saldoflow.llm.common import fresh, n_words
from saldoflow.session import settle

#: Cells of a source's order.
CELLS = 4096
#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (5, 2, 1)


def draw(doc_id: Column, seed: str) -> Column:
    """Uniform number in (0, 1) from an MD5 of seed and id; a null id is the empty text."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, weights=WEIGHTS, limit: int = 3) -> DataFrame:
    """(source, source_size, target) for rows of (source, size). One row per source.

    Sources at their limit are those with the least limit per weight: with sources in
    that order, one is at its limit if the words left for it and those after it, shared
    by weight, are more than the limit. So one pass replaces the repeated sharing.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    ordered = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(every) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    capped = F.col("left") * F.col("weight") >= limit * F.col("source_size") * F.col("weight_left")
    shared = (per.withColumn("weight", weight)
              .withColumn("left", left).withColumn("weight_left", weight_left)
              .withColumn("capped", capped))
    # All sources that are not at their limit share what the first of them has left.
    free = Window.orderBy(F.col("capped").asc(), F.col("source_size") / F.col("weight"),
                          F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    unit = F.first(F.col("left") / F.col("weight_left")).over(free)
    target = F.when(F.col("capped"), (limit * F.col("source_size")).cast("double")).otherwise(unit * F.col("weight"))
    return shared.withColumn("target", target).select("source", "source_size", "target")


def allocate(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, limit: int = 3) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row of ``docs``.

    ``copies`` is how often the mix takes the document, ``taken`` the words of all its
    copies. A null text has size 0; documents without words are in the whole copies and
    never in the sample. A null source is a source of its own. Rows that repeat a doc_id,
    source and size share their random number and are taken or left together. Further
    columns are not read.
    """
    narrow = settle(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")), "sizes")
    spread = narrow.groupBy("source").agg(F.sum((F.sqrt("size") * F.col("size")).cast("long")).alias("spread"))
    goals = targets(narrow, weights, limit)
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(limit)).cast("long")
    goals = goals.join(spread, goals.source.eqNullSafe(spread.source)).drop(spread.source)
    goals = settle(goals.withColumn("whole", F.when(F.col("source_size") > 0, whole).otherwise(F.lit(limit).cast("long")))
                   .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "goals")
    same = narrow.source.eqNullSafe(goals.source)
    keyed = narrow.join(goals, same).drop(goals.source)
    # Inclusion odds: probability min(c * sqrt(size), 1), with c such that the expected words are the rest.
    p = F.least(F.col("rest") / F.col("spread") * F.sqrt("size"), F.lit(0.999999))
    u = draw(F.col("doc_id"), seed)
    odds = (u / (1 - u)) / (p / (1 - p))
    place = F.when((F.col("size") > 0) & (F.col("rest") > 0), odds / (1 + odds))
    keyed = settle(keyed.withColumn("place", place).withColumn(
        "cell", F.floor(F.col("place") * CELLS).cast("int")), "order")
    chosen = _head(keyed)
    copies = F.col("whole") + F.when(F.col("place") <= F.col("last_place"), 1).otherwise(0)
    step = F.when((F.col("place") == F.col("extra_place")) & (F.col("doc_id").eqNullSafe(F.col("extra_id"))),
                  F.col("extra")).otherwise(0)
    joined = keyed.join(chosen, keyed.source.eqNullSafe(chosen.source), "left").drop(chosen.source)
    copies = (copies + F.coalesce(step, F.lit(0))).cast("long")
    return joined.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def _head(keyed: DataFrame) -> DataFrame:
    """(source, last_place, extra_place, extra_id, extra): the end of each source's sample.

    One row per source. ``extra`` is 1 for a document after the end that is added, -1
    for one before it that is left out, or null.
    """
    ordered = keyed.filter(F.col("place").isNotNull())
    cells = ordered.groupBy("source", "cell").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    # At most CELLS rows per source.
    upto = Window.partitionBy("source").orderBy("cell")
    cells = cells.withColumn("after", F.sum("words").over(upto))
    edge = settle(cells.filter((F.col("after") >= F.col("rest")) & (F.col("after") - F.col("words") < F.col("rest")))
                  .select("source", "cell", (F.col("after") - F.col("words")).alias("before")), "edges")
    inside = ordered.join(edge, ordered.source.eqNullSafe(edge.source) & (ordered.cell == edge.cell)).select(
        ordered.source, "doc_id", "place", "size", "rest", "before")
    # The documents of one cell of each source.
    rank = Window.partitionBy("source").orderBy("place")
    inside = inside.withColumn("after", F.col("before") + F.sum("size").over(rank))
    miss = F.abs(F.col("after") - F.col("rest"))
    start = F.struct(F.abs(F.col("before") - F.col("rest")).alias("miss"), F.lit(-1.0).alias("place"),
                     (F.col("before") - F.col("rest")).alias("over"))
    ends = inside.groupBy("source").agg(
        F.min(F.struct(miss.alias("miss"), "place", (F.col("after") - F.col("rest")).alias("over"))).alias("inner"),
        F.min(start).alias("start"), F.min("place").alias("first"))
    # Without any document of the cell, the sample ends just before the cell's first.
    take_none = F.col("start.miss") < F.col("inner.miss")
    below = ordered.join(edge, ordered.source.eqNullSafe(edge.source) & (ordered.cell < edge.cell)).groupBy(
        ordered.source.alias("source")).agg(F.max("place").alias("below"))
    ends = ends.join(below, ends.source.eqNullSafe(below.source), "left").drop(below.source)
    ends = settle(ends.select(
        "source", F.when(take_none, F.coalesce("below", F.lit(-1.0))).otherwise(F.col("inner.place")).alias("last_place"),
        F.when(take_none, F.col("start.over")).otherwise(F.col("inner.over")).alias("over")), "ends")
    # over > 0: too many words; one document less may fit. over < 0: one more may.
    near = ordered.join(ends, ordered.source.eqNullSafe(ends.source)).drop(ends.source)
    taken = F.col("place") <= F.col("last_place")
    sign = F.when(taken, -1).otherwise(1)
    better = F.abs(F.col("over") + sign * F.col("size"))
    fit = near.filter(better < F.abs("over")).groupBy("source").agg(F.min(F.struct(
        better.alias("miss"), "place", "doc_id", sign.alias("sign"))).alias("fit"))
    # Rows that share a random number would change together, which the fit does not expect.
    return settle(ends.join(fit, ends.source.eqNullSafe(fit.source), "left").drop(fit.source).select(
        "source", "last_place", F.col("fit.place").alias("extra_place"), F.col("fit.doc_id").alias("extra_id"),
        F.col("fit.sign").alias("extra")), "heads")


def mix(docs: DataFrame, seed: str = "mix", weights=WEIGHTS, limit: int = 3) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; the columns stay as they are.

    The copies of a document are found by its id, so rows that repeat a doc_id are one
    document only if source and text agree as well. Helper columns take names that the
    given columns do not have, so extra columns of any name pass through.
    """
    i, src, size, n, k = (fresh(b, docs.columns) for b in ("_id", "_source", "_size", "_n", "_copies"))
    copies = allocate(docs, seed, weights, limit).filter("copies > 0").select(
        F.col("doc_id").alias(i), F.col("source").alias(src), F.col("size").alias(size),
        F.col("copies").alias(k)).distinct()
    sized = docs.withColumn(n, n_words(F.col("text")))
    joined = sized.join(copies, sized.doc_id.eqNullSafe(F.col(i)) & sized.source.eqNullSafe(F.col(src))
                        & (F.col(n) == F.col(size)))
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns], F.explode(
        F.sequence(F.lit(1).cast("long"), F.col(k))).alias(fresh("_copy", docs.columns))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
