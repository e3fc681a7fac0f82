"""Positions and order statistics over a total order, without one big task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from saldoflow.session import settle

_LOW_BITS = (1 << 33) - 1


def global_position(df: DataFrame, order: list, name: str) -> DataFrame:
    """Add the 0-based position of every row in the given total order.

    Rows are range partitioned and sorted; the id Spark gives a row holds its
    partition and its place there, so only one count per partition has to be
    summed up. The sorted rows are written once: a second sort could cut the
    ranges elsewhere.
    """
    numbered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    kept = settle(numbered, "ordered")
    part = F.shiftright("_mid", 33)
    sizes = kept.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition of the sort.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))
    return (kept.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_offset") + place).alias(name)))


def exact_quantiles(values: DataFrame, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Interpolated quantiles of ``value`` per ``field``: (field, q, quantile).

    Equal values are counted first, which combines before the shuffle, so a value that
    fills a column is one row. The distinct values are range partitioned and sorted; each
    covers a stretch of positions, from running counts within its partition and one sum
    per partition and field before it.
    """
    given = values.filter(F.col("value").isNotNull())
    counted = given.groupBy("field", "value").agg(F.count("*").alias("n"))
    kept = settle(counted.orderBy("field", "value").withColumn(
        "_part", F.shiftright(F.monotonically_increasing_id(), 33)), "distinct")
    # One row per field and partition of the sort.
    sizes = kept.groupBy("field", "_part").agg(F.sum("n").alias("_n"))
    before = Window.partitionBy("field").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(sizes.select(
        "field", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy("field")).alias("total")), "offsets")
    within = F.sum("n").over(Window.partitionBy("_part", "field").orderBy("value"))
    placed = kept.withColumn("_upto", within).join(offsets, ["field", "_part"]).withColumn(
        "last", F.col("_offset") + F.col("_upto"))
    ranks = F.inline(F.array(*[F.struct(
        F.lit(q).alias("q"), F.floor((F.col("total") - 1) * q).alias("low"),
        ((F.col("total") - 1) * q - F.floor((F.col("total") - 1) * q)).alias("part"),
        F.ceil((F.col("total") - 1) * q).alias("high")) for q in quantiles]))
    holds = lambda at: (F.col(at) < F.col("last")) & (F.col(at) >= F.col("last") - F.col("n"))
    hits = placed.select("field", "value", "n", "last", ranks).filter(holds("low") | holds("high"))
    low, high = F.max(F.when(holds("low"), F.col("value"))), F.max(F.when(holds("high"), F.col("value")))
    return hits.groupBy("field", "q").agg((low + (high - low) * F.max("part")).alias("quantile"))


#: Rank error of the sketch is a 1/ACCURACY share of a bracket's rows; GRID cut points a round.
ACCURACY, GRID = 10_000, 1_000
#: A bracket of at most so many rows is finished exactly by a window over its distinct values.
EXACT_ROWS = 1_000_000


def bracketed_quantiles(values: DataFrame, quantiles=(0.25, 0.5, 0.75), accuracy: int = ACCURACY,
                        grid: int = GRID, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """The same result as :func:`exact_quantiles`, without sorting every distinct value.

    Each (field, quantile) starts with the bracket [min, max]. A round scans the values
    once and sketches, per bracket, the rows inside it (``percentile_approx``, mergeable
    across tasks) at ``grid`` cut points; the new bracket is the stretch between the cut
    points around the ranks wanted, widened by the sketch's error. A second scan counts
    exactly the rows below and inside every new bracket; one that would not hold the
    ranks wanted is dropped and the old one is finished as it is. Rounds go on while a
    bracket holds more than ``exact_rows`` rows. Last, the distinct values of each bracket
    are counted and placed by a window. The driver sees a few numbers per field and
    quantile. Null values are left out; a field without values has no rows.
    """
    spark = values.sparkSession
    given = values.filter(F.col("value").isNotNull()).select("field", "value")
    field_type = values.schema["field"].dataType.simpleString()
    kind = values.schema["value"].dataType.simpleString()
    stats = given.groupBy("field").agg(F.count("*").alias("total"), F.min("value").alias("lo"),
                                       F.max("value").alias("hi")).collect()
    # (field, q) -> dict(lo, hi, below, inside, low, high, part, open)
    brackets = {}
    for s in stats:
        for q in quantiles:
            h = (s.total - 1) * q
            brackets[(s.field, q)] = dict(lo=s.lo, hi=s.hi, below=0, inside=s.total, low=math.floor(h),
                                          high=math.ceil(h), part=h - math.floor(h), open=True)

    def table(pairs):
        return F.broadcast(spark.createDataFrame(
            [(f, q, b["lo"], b["hi"]) for (f, q), b in pairs], f"field {field_type}, q double, lo {kind}, hi {kind}"))

    margin, cuts = 2.0 / accuracy, [i / grid for i in range(grid + 1)]
    inside = F.col("value").between(F.col("lo"), F.col("hi"))
    while True:
        wide = [(k, b) for k, b in brackets.items() if b["open"] and b["inside"] > exact_rows]
        if not wide:
            break
        sketches = given.join(table(wide), "field").filter(inside).groupBy("field", "q").agg(
            F.percentile_approx("value", cuts, accuracy).alias("cut")).collect()
        tried = {}
        for r in sketches:
            b = brackets[(r.field, r.q)]
            first = (b["low"] - b["below"]) / b["inside"] - margin
            last = (b["high"] - b["below"]) / b["inside"] + margin
            tried[(r.field, r.q)] = dict(b, lo=r.cut[max(math.floor(first * grid) - 1, 0)],
                                         hi=r.cut[min(math.ceil(last * grid) + 1, grid)])
        counts = given.join(table(tried.items()), "field").groupBy("field", "q").agg(
            F.count_if(F.col("value") < F.col("lo")).alias("below"), F.count_if(inside).alias("inside")).collect()
        for r in counts:
            b, new = brackets[(r.field, r.q)], tried[(r.field, r.q)]
            if r.below <= b["low"] and b["high"] < r.below + r.inside and r.inside < b["inside"]:
                brackets[(r.field, r.q)] = dict(new, below=r.below, inside=r.inside)
            else:
                b["open"] = False
        for k, b in wide:
            if k not in tried:
                brackets[k]["open"] = False
    ranks = spark.createDataFrame(
        [(f, q, b["below"], b["low"], b["high"], float(b["part"])) for (f, q), b in brackets.items()],
        f"field {field_type}, q double, below long, low long, high long, part double")
    counted = (given.join(table(brackets.items()), "field").filter(inside)
               .groupBy("field", "q", "value").agg(F.count("*").alias("n")))
    upto = F.sum("n").over(Window.partitionBy("field", "q").orderBy("value"))
    placed = counted.join(F.broadcast(ranks), ["field", "q"]).withColumn("last", F.col("below") + upto)
    holds = lambda at: (F.col(at) < F.col("last")) & (F.col(at) >= F.col("last") - F.col("n"))
    low, high = F.max(F.when(holds("low"), F.col("value"))), F.max(F.when(holds("high"), F.col("value")))
    return (placed.filter(holds("low") | holds("high")).groupBy("field", "q")
            .agg((low + (high - low) * F.max("part")).alias("quantile")))
