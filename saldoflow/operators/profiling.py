"""Looking at the callback feed before loading it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F, types as T

from saldoflow.operators.ordering import bracketed_quantiles
from saldoflow.sources import callbacks as C

_PREVIEW_SCHEMA = (
    "end_point STRING, method STRING, data STRUCT<id: STRING, number: STRING, date: STRING, "
    "description: STRING, status: STRING, payment_status: STRING, supplier: STRUCT<name: STRING>, "
    "subtotal: STRING, total_amount: STRING, total_tax: STRING, currency: STRUCT<code: STRING>, "
    "department: STRUCT<name: STRING>, project: STRUCT<name: STRING>>")


#: Columns every flattened feed has, null where no body has the field: the preview fields
#: and the payment status the timeline reads.
BASE_COLUMNS = ("id", "end_point", "method", "number", "date", "description", "status", "payment_status",
                "supplier.name", "subtotal", "total_amount", "total_tax", "currency.code", "department.name",
                "project.name")


def _struct_type(variant_schema: str) -> T.DataType:
    """A merged variant schema as a Spark type: OBJECT is STRUCT outside quoted names."""
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: m[0] if m[0].startswith("`") else "STRUCT<", variant_schema)
    return T.DataType.fromDDL(ddl)


def _leaves(kind: T.DataType, path: tuple[str, ...] = ()):
    if isinstance(kind, T.StructType):
        for field in kind.fields:
            yield from _leaves(field.dataType, path + (field.name,))
    elif path:
        yield path, kind


def callback_flatten(callbacks: DataFrame) -> DataFrame:
    """Bodies as dotted columns found in the bodies themselves.

    A body (decoded twice if it was encoded as a string) gives ``end_point`` and
    ``method`` and every field of its ``data`` object; nested objects become dotted
    names (``supplier.name``), arrays stay arrays. The columns are the union over all
    bodies: their variant schemas are merged by one aggregate, so a field that only
    one body has is a column, null elsewhere. A field whose type differs between bodies
    is kept as JSON text. A data field named end_point or method wins over the
    top-level one when not null. Bodies that are no object give nulls. Field names
    holding a single quote are not reached by the path and stay null.
    """
    rows = C.object_texts(callbacks).select("callback_id", "created_at",
                                           F.try_parse_json("object_text").alias("_v"))
    data = F.try_variant_get("_v", "$.data", "variant")
    merged = rows.agg(F.schema_of_variant_agg(data).alias("s")).first()
    kind = _struct_type(merged.s) if merged and merged.s else T.StructType([])
    columns, found = {}, {}
    for path, leaf in _leaves(kind):
        at = "$.data" + "".join(f"['{k}']" for k in path)
        if isinstance(leaf, T.VariantType):
            value = F.to_json(F.try_variant_get("_v", at, "variant"))
        else:
            value = F.try_variant_get("_v", at, leaf.simpleString())
        found[".".join(path)] = value
    for name in ("end_point", "method"):
        top = F.try_variant_get("_v", f"$.{name}", "string")
        columns[name] = F.coalesce(found.pop(name).cast("string"), top) if name in found else top
    columns.update(found)
    for name in BASE_COLUMNS:
        columns.setdefault(name, F.lit(None).cast("string"))
    return rows.select("callback_id", "created_at", *[v.alias(k) for k, v in columns.items()])


def callback_value_counts(flat: DataFrame) -> DataFrame:
    """Counts by end point, method and status, in one scan."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value"))
                      for c in ("end_point", "method", "status")])
    return (flat.select(F.inline(pairs)).filter(F.col("value").isNotNull())
            .groupBy("field", "value").agg(F.count("*").alias("n"))
            .orderBy("field", F.desc("n"), "value"))


def callback_status_crosstab(flat: DataFrame, statuses: list[str]) -> DataFrame:
    """End point by status with totals both ways."""
    known = flat.filter(F.col("end_point").isNotNull() & F.col("status").isNotNull())
    counts = [F.count_if(F.col("status") == s).alias(s) for s in statuses]
    return (known.rollup("end_point").agg(*counts, F.count("*").alias("All"))
            .withColumn("end_point", F.coalesce("end_point", F.lit("All"))))


def document_counts(flat: DataFrame) -> DataFrame:
    named = flat.filter(F.col("end_point").isNotNull() & F.col("id").isNotNull())
    return named.groupBy("end_point", "id").agg(F.count("*").alias("callback_count"))


def callbacks_per_document(flat: DataFrame) -> DataFrame:
    """How many documents have how many callbacks."""
    return (document_counts(flat).groupBy("callback_count").agg(F.count("*").alias("documents"))
            .orderBy("callback_count"))


def callbacks_per_document_totals(flat: DataFrame) -> DataFrame:
    return document_counts(flat).agg(
        F.sum("callback_count").alias("callbacks"), F.count("*").alias("documents"),
        F.count_if(F.col("callback_count") > 1).alias("duplicated"))


def document_timeline(flat: DataFrame) -> DataFrame:
    """All callbacks of the first document that has several, by time."""
    first = (document_counts(flat).filter("callback_count > 1")
             .agg(F.min(F.struct("end_point", "id")).alias("d")).select("d.*"))
    # One row: the smallest key.
    return (flat.join(F.broadcast(first), ["end_point", "id"], "left_semi")
            .select("created_at", "callback_id", "end_point", "id", "method", "number", "status",
                    "payment_status").orderBy("created_at", "callback_id"))


def source_preview(callbacks: DataFrame, n: int = 10) -> DataFrame:
    return callbacks.orderBy(F.col("created_at").desc_nulls_last(),
                             F.col("callback_id").desc()).limit(n)


def table_describe(table: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of numeric columns, long form."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value"))
                      for c in columns])
    values = table.select(F.inline(pairs))
    stats = values.groupBy("field").agg(
        F.count("value").alias("count"), F.mean("value").alias("mean"),
        F.stddev("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = (bracketed_quantiles(values).groupBy("field")
                 .agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(n)
                        for q, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]))
    return stats.join(quartiles, "field", "left").select(
        "field", "count", "mean", "std", "min", "p25", "p50", "p75", "max")
