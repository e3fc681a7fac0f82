"""Department codes read back out of the callbacks for rows that lack them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from saldoflow.functions import scalars as S
from saldoflow.session import settle
from saldoflow.sources import tables as TB


def code_backfill_lookup(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by line, by document) department codes; the last callback wins.

    ``documents`` has ``callback_id`` and the deep-parsed ``document``. A line
    without its own code takes the document's. The documents are parsed once, for what
    is read here, and both lookups are written: a backfill reads them several times.
    """
    d = F.col("document")
    named = settle(documents.filter(S.nonblank(d.id).isNotNull()).select(
        "callback_id", d.id.alias("source_id"), S.nonblank(d.department.code).alias("head_code"),
        F.coalesce(d.department["name"], F.lit("")).alias("head_name"),
        d.line_items.alias("line_items")), "named")
    by_document = (named.filter(F.col("head_code").isNotNull()).groupBy("source_id")
                   .agg(F.max_by(F.struct("head_code", "head_name"), "callback_id").alias("h"))
                   .select("source_id", F.col("h.head_code").alias("dept_code"),
                           F.col("h.head_name").alias("department")))
    lines = named.select("callback_id", "source_id", "head_code",
                         F.posexplode("line_items").alias("pos", "line"))
    code = F.coalesce(S.nonblank(F.col("line.department.code")), F.col("head_code"))
    by_line = (lines.select("callback_id", "pos", "source_id", F.col("line.id").alias("line_id"),
                            code.alias("dept_code"))
               .filter(F.col("dept_code").isNotNull() & S.nonblank(F.col("line_id")).isNotNull())
               .groupBy("source_id", "line_id")
               .agg(F.max_by("dept_code", F.struct("callback_id", "pos")).alias("dept_code")))
    return settle(by_line, "by_line"), settle(by_document, "by_document")


def code_resolve(rows: DataFrame, by_line: DataFrame, by_document: DataFrame) -> DataFrame:
    """Add ``resolved_code``: exact line id, then the part before ``_``, then
    the document's code where the department names agree."""
    base = F.substring_index(F.coalesce(F.col("source_line_id"), F.lit("")), "_", 1)
    keyed = rows.withColumn("_base_id", base)
    exact = by_line.select("source_id", F.col("line_id").alias("source_line_id"),
                           F.col("dept_code").alias("_exact"))
    part = by_line.select("source_id", F.col("line_id").alias("_base_id"),
                          F.col("dept_code").alias("_part"))
    head = by_document.select("source_id", F.col("dept_code").alias("_head"),
                              F.col("department").alias("_head_name"))
    joined = (keyed.join(exact, ["source_id", "source_line_id"], "left")
              .join(part, ["source_id", "_base_id"], "left")
              .join(head, "source_id", "left"))
    agrees = S.name_key(F.col("_head_name")) == S.name_key(F.coalesce(F.col("department"), F.lit("")))
    resolved = F.coalesce(F.col("_exact"), F.col("_part"), F.when(agrees, F.col("_head")))
    return joined.select(*rows.columns, resolved.alias("resolved_code"))


def code_backfill(rows: DataFrame, by_line: DataFrame, by_document: DataFrame,
                  recheck: bool = False) -> DataFrame:
    """Rows of several tables (column ``table_name``) with ``new_code``.

    Without ``recheck`` only null codes are filled. With it every row is
    resolved anew and codes that do not hold are cleared, but only in a table
    where at least one row did resolve.
    """
    found = code_resolve(rows, by_line, by_document)
    old, new = F.col("dept_code"), F.col("resolved_code")
    if not recheck:
        return found.withColumn("new_code", F.coalesce(old, new))
    hit = (found.groupBy("table_name")
           .agg(F.coalesce(F.bool_or(new.isNotNull()), F.lit(False)).alias("_any")))
    # One row per ledger table, of which there are ten.
    joined = found.join(F.broadcast(hit), "table_name", "left")
    return joined.withColumn("new_code", F.when(F.col("_any"), new).otherwise(old)).drop("_any")


def backfill_report(filled: DataFrame, recheck: bool = False) -> DataFrame:
    """Per table: rows looked at, rows resolved, rows cleared."""
    looked = filled if recheck else filled.filter(F.col("dept_code").isNull())
    hit = F.col("resolved_code").isNotNull()
    cleared = F.count_if(~hit) if recheck else F.lit(0).cast("bigint")
    return looked.groupBy("table_name").agg(
        F.count("*").alias("missing"), F.count_if(hit).alias("matched"), cleared.alias("cleared"))


#: Columns that resolution reads from every table.
_READ = ("source_id", "source_line_id", "department", "dept_code")


def backfill_changes(tables: dict[str, DataFrame], by_line: DataFrame, by_document: DataFrame,
                     recheck: bool = False, key: str = "id") -> DataFrame:
    """(table_name, key, bucket, old_code, new_code) of every row whose code a backfill changes.

    All tables go through one pass: each gives only its row key and the columns resolution
    reads, tagged with its name, so the lookups are joined once for all of them. The clear
    rule of ``recheck`` stays per table. Tables without rows add nothing.
    """
    tagged = reduce(DataFrame.unionByName, [
        t.select(F.lit(n).alias("table_name"), F.col(key).alias(key), *_READ) for n, t in tables.items()])
    done = code_backfill(tagged, by_line, by_document, recheck)
    return TB.bucketed(done.filter(~F.col("new_code").eqNullSafe(F.col("dept_code"))).select(
        "table_name", key, "source_id", F.col("dept_code").alias("old_code"), "new_code"), BUCKETS).drop("source_id")


#: Buckets of a stored table, by source_id.
BUCKETS = 64


def backfill_run(spark: SparkSession, folder: str, names: list[str], schemas: dict, by_line: DataFrame,
                 by_document: DataFrame, recheck: bool = False, key: str = "id") -> DataFrame:
    """Backfill stored tables ``folder/<name>``, each partitioned by source_id bucket.

    The changes of all tables are found in one pass and written once to the shared folder;
    then each table rewrites only the buckets where a code changed (dynamic partition
    overwrite), reading only those. Returns the changes.
    """
    stored = {n: TB.read_buckets(spark, f"{folder}/{n}", schemas[n]) for n in names}
    changes = settle(backfill_changes(stored, by_line, by_document, recheck, key), "backfill")
    touched = {r.table_name: [] for r in changes.select("table_name").distinct().collect()}
    # One row per table and touched bucket: at most tables x BUCKETS.
    for r in changes.select("table_name", TB.BUCKET).distinct().collect():
        touched[r.table_name].append(r[TB.BUCKET])
    for n, buckets in touched.items():
        typed = spark.createDataFrame([], schemas[n]).withColumn(TB.BUCKET, F.lit(0)).schema
        rows = TB.touched(spark, f"{folder}/{n}", typed, buckets)
        new = changes.filter(F.col("table_name") == n).select(key, F.col("new_code").alias("_new"), "old_code")
        after = rows.join(new, key, "left").withColumn(
            "dept_code", F.when(F.col("old_code").isNotNull() | F.col("_new").isNotNull(), F.col("_new"))
            .otherwise(F.col("dept_code"))).drop("_new", "old_code")
        TB.replace_partitions(settle(after, "backfilled"), f"{folder}/{n}", [TB.BUCKET])
    return changes
