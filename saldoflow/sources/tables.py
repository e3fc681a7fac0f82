"""Stored tables: append, replace, upsert, partition replacement.

Parquet has no row updates, so a change is computed as a new table, or as the
new content of the partitions it touches.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from saldoflow.session import fresh_path

BUCKET = "doc_bucket"
#: Files of partitions that a task keeps open at once; only beyond them are its rows sorted.
OPEN_FILES, _OPEN_FILES = 64, "spark.sql.maxConcurrentOutputFileWriters"


def table_append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def table_replace(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def keyed_upsert(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace target rows with the same key; others are added."""
    kept = target.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(new.select(*target.columns))


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite exactly the partitions that occur in ``df``.

    The rebalance keeps each partition's files near the advisory size and splits
    a partition that is much larger than the others over several tasks. A task so has the
    rows of one large partition or of some small ones, and a file open for each: sorting
    the rows by partition first, as Spark else does, would spill the whole table.
    """
    with _files_open(df.sparkSession):
        (df.hint("rebalance", *by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


@contextmanager
def _files_open(spark: SparkSession):
    """A task writes to up to ``OPEN_FILES`` partitions at once without sorting its rows."""
    given = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, OPEN_FILES)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES, given)


def settle_by(df: DataFrame, by: str, name: str) -> DataFrame:
    """:func:`saldoflow.session.settle` in one folder per value of a text column with few values,
    so that who wants the rows of one value reads no others."""
    path = fresh_path(df.sparkSession, name)
    with _files_open(df.sparkSession):
        df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def bucketed(df: DataFrame, buckets: int, key: str = "source_id") -> DataFrame:
    """Add the storage bucket of a document."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def touched(spark: SparkSession, path: str, schema, values: list, by: str = BUCKET) -> DataFrame:
    """Stored rows of the partitions about to be replaced; others are not read."""
    table = spark.read.schema(schema).parquet(path)
    return table.filter(F.col(by).isin(*values)) if values else table.filter(F.lit(False))


def create_buckets(spark: SparkSession, path: str, schema) -> None:
    """An empty table by document bucket, unless there is one at the path."""
    empty = spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0))
    empty.write.mode("ignore").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of a table by document bucket."""
    typed = spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0)).schema
    return spark.read.schema(typed).parquet(path).drop(BUCKET)


def merge_buckets(spark: SparkSession, path: str, new: DataFrame, merge: Callable[[DataFrame], DataFrame],
                  buckets: int, key: str, schema) -> None:
    """Replace the stored rows of the buckets that hold keys of ``new`` by ``merge`` of them.

    Only these buckets are read and rewritten, so a small batch does not rewrite a large
    table. The merged rows are stored first, as a plan cannot overwrite what it reads, and
    deleted once they are in the table. A bucket that is empty afterwards is emptied.
    ``buckets`` bounds what the driver sees.
    """
    hit = [r[0] for r in bucketed(new, buckets, key).select(BUCKET).distinct().collect()]
    if not hit:
        return
    typed = spark.createDataFrame([], schema).withColumn(BUCKET, F.lit(0)).schema
    columns = [c for c in typed.names if c != BUCKET]
    stored = touched(spark, path, typed, hit).drop(BUCKET)
    kept = fresh_path(spark, "buckets")
    merged = bucketed(merge(stored).select(*columns), buckets, key)
    merged.write.parquet(kept)
    after = spark.read.schema(merged.schema).parquet(kept)
    replace_partitions(after, path, [BUCKET])
    left = {r[0] for r in after.select(BUCKET).distinct().collect()}
    for bucket in sorted(set(hit) - left):
        after.filter(F.lit(False)).drop(BUCKET).write.mode("overwrite").parquet(f"{path}/{BUCKET}={bucket}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(kept)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def upsert_buckets(spark: SparkSession, path: str, new: DataFrame, keys: list[str],
                   buckets: int, key: str = "source_id") -> None:
    """Upsert into a table partitioned by document bucket."""
    merge_buckets(spark, path, new, lambda stored: keyed_upsert(stored, new, keys), buckets, key, new.schema)


def replace_period(stored: DataFrame, new: DataFrame, period: str) -> DataFrame:
    """Table with the rows of one period (its first day) replaced."""
    other = stored.filter(~F.col("period").eqNullSafe(F.lit(period).cast("date")))
    rows = new.withColumn("period", F.lit(period).cast("date"))
    return other.unionByName(rows.select(*stored.columns))


def replace_seen_periods(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Table with exactly the periods of ``new`` replaced.

    A batch without any dated row replaces the undated rows instead.
    """
    # An array of months, so its size is that of the calendar.
    months = new.agg(F.collect_set("period").alias("m"))
    touched = months.select(F.explode(F.when(F.size("m") > 0, F.col("m")).otherwise(
        F.array(F.lit(None).cast("date")))).alias("_touched"))
    kept = stored.join(F.broadcast(touched), F.col("period").eqNullSafe(F.col("_touched")),
                       "left_anti")
    return kept.select(*stored.columns).unionByName(new.select(*stored.columns))
