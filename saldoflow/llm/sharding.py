"""Two-pass external shuffle into shards of equal row counts.

First pass: a seeded hash scatters the records uniformly into buckets of a size that a
task can hold. Second pass: each bucket becomes an array, is shuffled by Fisher-Yates
and written in that order. The written buckets, one after the other, are a random order
of all records; shards are equal cuts of it, so their row counts differ by one at most.

The number of buckets follows the data, not the cluster, and a bucket's place in the
second pass depends on its number only, so a rerun or a recomputed task shuffles alike.
Records that a hash cannot tell apart, such as many equal rows, can overfill a bucket;
such a bucket is scattered again over all buckets, by its rows' places in the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from saldoflow.session import settle

#: Bytes of records in a bucket.
BUCKET_BYTES = 8 << 20
#: Buckets whose counts are summed by one task.
GROUP = 4096
#: Second-pass partitions at most; with more buckets each has several.
PARTITIONS = 20_000


def record_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus 8."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def external_shuffle(df: DataFrame, size: Column, keys: list[str], seed: int = 7,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` with (bucket, place): where each record stands after both passes.

    ``keys`` are the columns whose hash scatters; their values may be null or repeated.
    The result is read back from what the second pass has written.
    """
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    scatter = F.pmod(F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("long")
    placed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                       scatter.alias("bucket"), size.alias("bytes"))
    over = (placed.groupBy("bucket").agg(F.sum("bytes").alias("held"), F.count("*").alias("n"))
            .filter((F.col("held") > 4 * bucket_bytes) & (F.col("n") > 1)).select("bucket"))
    if not over.isEmpty():
        again = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(buckets)).cast("long")
        placed = placed.join(settle(over.withColumn("full", F.lit(True)), "over"), "bucket", "left").select(
            "row", F.when(F.col("full"), again).otherwise(F.col("bucket")).alias("bucket"))
    order = F.xxhash64(F.lit(seed + 1), *[F.col(f"row.`{k}`") for k in keys])
    arrays = (placed.select("bucket", F.struct(order.alias("order"), "row").alias("r"))
              .repartition(int(min(buckets, PARTITIONS)), "bucket")
              .groupBy("bucket").agg(F.sort_array(F.collect_list("r")).alias("rows"))
              .sortWithinPartitions("bucket"))
    shuffled = arrays.select("bucket", F.shuffle("rows", seed).alias("rows"))
    return settle(shuffled.select("bucket", F.posexplode("rows").alias("place", "r"))
                  .select("r.row.*", "bucket", "place"), "shuffled")


def into_shards(df: DataFrame, size: Column, keys: list[str], shards: int = 24, seed: int = 7,
                bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` with (shard, slot): slots run from 0 without a gap, shards differ by one row
    at most. Fewer rows than shards leave the last shards empty; an empty table has none.
    Columns of ``df`` named shard, slot, bucket or place are replaced.
    """
    df = df.drop("shard", "slot", "bucket", "place")
    written = external_shuffle(df, size, keys, seed, bucket_bytes)
    counts = written.groupBy("bucket").agg(F.count("*").alias("n")).withColumn(
        "group", F.floor(F.col("bucket") / GROUP))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    groups = counts.groupBy("group").agg(F.sum("n").alias("in_group"))
    # One row per GROUP buckets.
    groups = groups.select("group", F.coalesce(F.sum("in_group").over(before(Window.orderBy("group"))), F.lit(0))
                           .alias("offset"), F.sum("in_group").over(Window.partitionBy(F.lit(1))).alias("total"))
    inner = F.coalesce(F.sum("n").over(before(Window.partitionBy("group").orderBy("bucket"))), F.lit(0))
    starts = settle(counts.withColumn("inner", inner).join(groups, "group").select(
        "bucket", (F.col("offset") + F.col("inner")).alias("start"), "total"), "starts")
    position = F.col("start") + F.col("place")
    least, more = F.floor(F.col("total") / shards), F.col("total") % shards
    long_rows = more * (least + 1)   # rows in the shards that have one more
    short = position - long_rows
    shard = F.when(position < long_rows, F.floor(position / (least + 1))).otherwise(
        more + F.floor(short / F.greatest(least, F.lit(1))))
    slot = F.when(position < long_rows, position % (least + 1)).otherwise(short % F.greatest(least, F.lit(1)))
    return written.join(starts, "bucket").select(
        *[F.col(f"`{c}`") for c in df.columns], shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder per shard, its rows in slot order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)


def digest(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """What identifies each document's place: (doc_id, size, text_crc32, law, shard, slot, grown_shard)."""
    size = record_size(F.col("text"))
    placed = into_shards(docs.select("doc_id", "text"), size, ["doc_id", "text"], shards, seed)
    return placed.select("doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
                         F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
