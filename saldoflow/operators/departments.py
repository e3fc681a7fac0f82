"""Department master: merge, prune, check and canonical names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from saldoflow.functions import scalars as S


def department_upsert(master: DataFrame, listing: DataFrame, now, prune: bool = False) -> DataFrame:
    """Master after merging the listing by code.

    Only a new code gets ``created_at``; codes the listing lacks stay unless
    pruned.
    """
    stamp = F.lit(now).cast("timestamp_ntz")
    m = master.select("dept_code", F.col("dept_name").alias("_old_name"),
                      F.col("created_at").alias("_created"), F.col("updated_at").alias("_updated"),
                      F.lit(True).alias("_known"))
    n = listing.select("dept_code", F.col("dept_name").alias("_new_name"),
                       F.lit(True).alias("_listed"))
    joined = m.join(n, "dept_code", "right" if prune else "full")
    listed, known = F.col("_listed").isNotNull(), F.col("_known").isNotNull()
    return joined.select(
        "dept_code", F.when(listed, F.col("_new_name")).otherwise(F.col("_old_name")).alias("dept_name"),
        F.when(known, F.col("_created")).otherwise(stamp).alias("created_at"),
        F.when(listed, stamp).otherwise(F.col("_updated")).alias("updated_at"))


def department_surplus(master: DataFrame, listing: DataFrame) -> DataFrame:
    return master.select("dept_code").join(listing, "dept_code", "left_anti")


def department_prune(master: DataFrame, listing: DataFrame) -> DataFrame:
    return master.join(listing.select("dept_code"), "dept_code", "left_semi")


def department_unexplained(ledgers: dict[str, DataFrame], listing: DataFrame) -> DataFrame:
    """Per ledger table, the codes in use that the listing does not have."""
    used = reduce(DataFrame.unionByName, [
        t.filter(F.col("dept_code").isNotNull()).select(F.lit(n).alias("table_name"), "dept_code")
        for n, t in ledgers.items()])
    return used.distinct().join(listing.select("dept_code"), "dept_code", "left_anti") \
        .select("table_name", "dept_code")


def department_canonicalise(table: DataFrame, master: DataFrame,
                            name: str = "department") -> DataFrame:
    """Stored names rewritten to the master's; rows without a code untouched."""
    names = master.select("dept_code", F.col("dept_name").alias("_master_name"))
    joined = table.join(names, "dept_code", "left")
    return joined.select(*[F.coalesce(F.col("_master_name"), F.col(name)).alias(name)
                           if c == name else F.col(c) for c in table.columns])


def department_stale_count(tables: dict[str, tuple[DataFrame, str]], master: DataFrame) -> DataFrame:
    """Per table, how many rows a rewrite would change. Values are (table, name column)."""
    names = master.select("dept_code", F.col("dept_name").alias("_master_name"))
    used = reduce(DataFrame.unionByName, [
        t.groupBy("dept_code", F.col(col).alias("name")).agg(F.count("*").alias("n"))
        .withColumn("table_name", F.lit(n)) for n, (t, col) in tables.items()])
    stale = F.col("_master_name").isNotNull() & ~F.col("name").eqNullSafe(F.col("_master_name"))
    return (used.join(names, "dept_code", "left").groupBy("table_name")
            .agg(F.sum(F.when(stale, F.col("n")).otherwise(0)).cast("bigint").alias("stale")))


def department_listing_clean(raw: DataFrame) -> DataFrame:
    """Trim headers and cells, keep the two columns, drop blank codes."""
    renamed = raw.select(*[F.col(f"`{c}`").alias(c.strip()) for c in raw.columns])
    wanted = {"DEPARTMENT NO": "dept_code", "DEPARTMENT NAME": "dept_name"}
    missing = sorted(set(wanted) - set(renamed.columns))
    if missing:
        raise ValueError(f"missing column(s) {missing}; found {renamed.columns}")
    rows = renamed.select(*[S.strip(F.col(f"`{c}`").cast("string")).alias(n)
                            for c, n in wanted.items()])
    return rows.filter((F.col("dept_code") != "") & (F.lower("dept_code") != "nan"))


def department_duplicates(listing: DataFrame) -> DataFrame:
    """Codes and names that occur more than once; a good listing has none."""
    def repeated(col, label):
        return (listing.groupBy(F.col(col).alias("value")).count().filter("count > 1")
                .select(F.lit(label).alias("kind"), "value"))
    return repeated("dept_code", "code").unionByName(repeated("dept_name", "name"))
