"""Queries: the callback feed, its parsing, window, activity and profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldoflow.catalog import inputs as I, query
from saldoflow.operators import activity as A, profiling as P
from saldoflow.functions import scalars as S
from saldoflow.session import settle
from saldoflow.sources import callbacks as C

# A feed of small documents: every order is created once, every third changed a
# day later, every seventh deleted and every eleventh turned to draft after
# that. Some bodies are encoded twice, some are no JSON, some rows are deleted,
# some end points are unknown.
FEED_SQL = """
base AS (SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) AS t0, o_orderstatus AS st,
  CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders),
ev AS (
  SELECT *, 0 AS v, 'POST' AS m, 'approved' AS s FROM base UNION ALL
  SELECT *, 1, 'PUT', CASE WHEN st = 'P' THEN 'draft' ELSE 'approved' END FROM base WHERE k % 3 = 0 UNION ALL
  SELECT *, 2, 'DELETE', 'approved' FROM base WHERE k % 7 = 0 UNION ALL
  SELECT *, 3, 'patch', 'Draft' FROM base WHERE k % 11 = 0),
feed AS (
  SELECT k * 10 + v AS callback_id, k, v, m AS method, s AS status, d, p + v AS amount,
    t0 + v * INTERVAL 1 DAY AS created_at, k % 13 = 5 AS deleted, k % 19 = 4 AS garbage,
    CASE k % 4 WHEN 0 THEN 'manual_journals' WHEN 1 THEN 'cash_ins' WHEN 2 THEN 'cash_outs' ELSE 'invoices' END AS end_point,
    CASE k % 4 WHEN 0 THEN 'manual_journal' WHEN 1 THEN 'cash_in' WHEN 2 THEN 'cash_out' END AS module
  FROM ev)
"""
_SEEN = "NOT deleted"
_GOOD = "NOT deleted AND NOT garbage AND module IS NOT NULL"


def feed(spark, sf):
    """The same feed as callbacks with JSON bodies."""
    base = I.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp_ntz").alias("t0"),
        F.to_date("o_orderdate").alias("d"), I.money("o_totalprice").alias("p"),
        F.col("o_orderstatus").alias("st"))

    def event(v, method, status, when):
        return F.when(when, F.struct(F.lit(v).alias("v"), F.lit(method).alias("m"), status.alias("s")))
    k = F.col("k")
    approved = F.lit("approved")
    events = F.array_compact(F.array(
        event(0, "POST", approved, F.lit(True)),
        event(1, "PUT", F.when(F.col("st") == "P", "draft").otherwise("approved"), k % 3 == 0),
        event(2, "DELETE", approved, k % 7 == 0), event(3, "patch", F.lit("Draft"), k % 11 == 0)))
    # The given table may be one file; a real feed comes in many, more the larger it is.
    rows = base.select("*", F.inline(events)).repartition(I.pieces(spark, sf), "k", "v")
    kind = (F.when(k % 4 == 0, "manual_journals").when(k % 4 == 1, "cash_ins")
            .when(k % 4 == 2, "cash_outs").otherwise("invoices"))
    key = k.cast("string")
    amount = (F.col("p") + F.col("v")).cast("decimal(20,2)")
    account = I._obj(code="111211", name="Bank")

    def line(ident, code, debit, credit):
        return I._obj(id=ident, amount=amount, debit=debit, credit=credit,
                      account=I._obj(code=code, name="Line"),
                      department=F.when(k % 5 == 0, I._obj(code="L1", name="Line dept")))
    zero = F.lit(0).cast("decimal(20,2)")
    manual = F.array(line("L1", "6101", amount, zero), line("L2", "2101", zero, amount))
    single = F.array(line("L1", "6101", zero, zero))
    moment = F.date_format(F.col("t0") + F.expr("make_dt_interval(v)"), "yyyy-MM-dd'T'HH:mm:ss")
    user = I._obj(name=F.concat(F.lit("u"), (k % 5).cast("string")), email=F.lit("u@example.org"))
    data = I._obj(id=F.concat(F.lit("DOC-"), key), number=F.concat(F.lit("NO/"), key),
                  date=F.col("d").cast("string"), description=F.lit("feed"), status=F.col("s"),
                  department=I._obj(code="H1", name="Head"),
                  created=I._obj(time=F.concat(F.col("d").cast("string"), F.lit("T00:00:00+00:00")),
                                 user=I._obj(name=F.lit("creator"), email=F.lit("c@example.org"))),
                  updated=F.when(F.col("v") > 0, I._obj(time=F.concat(moment, F.lit("+00:00")), user=user)),
                  cash=F.when(k % 4 != 0, I._obj(amount=amount, account=account)),
                  line_items=F.when(k % 4 == 0, manual).otherwise(single))
    rows = S.once(rows, plain=F.to_json(I._obj(end_point=kind, method=F.col("m"), data=data)))
    body = F.col("plain")
    twice = F.concat(F.lit('"'), F.replace(body, F.lit('"'), F.lit('\\"')), F.lit('"'))
    text = (F.when(k % 19 == 4, "not json {").when(k % 6 == 0, twice)
            .when(k % 6 == 1, F.concat(F.lit("  "), body)).otherwise(body))
    at = F.col("t0") + F.expr("make_dt_interval(v)")
    rows = S.once(rows, body=text)
    return rows.select((k * 10 + F.col("v")).alias("callback_id"), F.lit("POST").alias("method"),
                       "body", at.alias("created_at"), F.when(k % 13 == 5, at).alias("deleted_at"))


SINCE, UNTIL = "1997-01-01", "1998-06-30"
_IN = "created_at > TIMESTAMP '1997-01-01 00:00:00' AND created_at <= TIMESTAMP '1998-06-30 23:59:59'"


@query("callback_window_extract", f"""WITH {FEED_SQL}
SELECT callback_id, created_at, module, 'DOC-' || k AS source_id, status, method FROM feed
WHERE {_GOOD} AND {_IN}""")
def callback_window_extract(spark, sf):
    since, until, _ = C.resolve_window(SINCE, UNTIL)
    rows = C.callback_window_extract(feed(spark, sf), since, until, schema=C.HEAD_SCHEMA)
    return rows.select("callback_id", "created_at", "module", "source_id", "status", "method")


@query("extract_frontier", f"WITH {FEED_SQL} SELECT MAX(created_at) AS frontier FROM feed WHERE {_SEEN} AND {_IN}")
def extract_frontier(spark, sf):
    """The frontier as a run gets it: observed on the one scan that extracts and writes the rows."""
    since, until, _ = C.resolve_window(SINCE, UNTIL)
    rows, seen = C.observed_extract(feed(spark, sf), since, until, schema=C.HEAD_SCHEMA)
    settle(rows, "extract")
    return C.observed_frontier(spark, seen)


@query("watermark_update", f"""WITH {FEED_SQL}
SELECT 'callback_watermark' AS state_key, MAX(created_at) AS watermark FROM feed WHERE {_SEEN}
UNION ALL SELECT 'other', TIMESTAMP '1996-01-01 00:00:00'""")
def watermark_update(spark, sf):
    state = spark.sql("""SELECT * FROM VALUES ('other', TIMESTAMP_NTZ '1996-01-01 00:00:00'),
        ('callback_watermark', TIMESTAMP_NTZ '1996-01-01 00:00:00') AS t(state_key, watermark)""")
    return C.watermark_update(state, C.extract_frontier(feed(spark, sf)))


@query("callback_newest_n", f"""WITH {FEED_SQL},
newest AS (SELECT * FROM feed ORDER BY created_at DESC, callback_id DESC LIMIT 1500)
SELECT callback_id, 'DOC-' || k AS source_id, status, method FROM newest
WHERE NOT garbage AND module = 'cash_in' ORDER BY created_at DESC, callback_id DESC LIMIT 50""")
def callback_newest_n(spark, sf):
    rows = C.callback_newest_n(feed(spark, sf), "cash_in", 50)
    return rows.select("callback_id", "source_id", "status", "method")


@query("json_body_parse", f"""WITH {FEED_SQL}
SELECT callback_id, CASE WHEN NOT garbage THEN end_point END AS end_point,
  CASE WHEN NOT garbage THEN method END AS method, CASE WHEN NOT garbage THEN 'DOC-' || k END AS id FROM feed""")
def json_body_parse(spark, sf):
    p = C.parse_bodies(feed(spark, sf), C.HEAD_SCHEMA)
    return p.select("callback_id", F.col("payload.end_point").alias("end_point"),
                    F.col("payload.method").alias("method"), F.col("payload.data.id").alias("id"))


@query("json_unwrap_deep", f"""WITH {FEED_SQL}
SELECT callback_id, CASE WHEN NOT garbage THEN 'DOC-' || k END AS id,
  CASE WHEN NOT garbage THEN 'H1' END AS head_code,
  CASE WHEN NOT garbage THEN CASE WHEN k % 4 = 0 THEN 2 ELSE 1 END END AS n_lines FROM feed""")
def json_unwrap_deep(spark, sf):
    body = F.col("body")
    # Once more encoded for some rows, which only the deep reading undoes.
    again = F.concat(F.lit('"'), F.replace(F.replace(body, F.lit("\\"), F.lit("\\\\")),
                                           F.lit('"'), F.lit('\\"')), F.lit('"'))
    rows = feed(spark, sf).withColumn(
        "body", F.when(F.pmod(F.floor(F.col("callback_id") / 10), F.lit(6)) == 0, again).otherwise(body))
    d = C.parse_documents_deep(rows)
    return d.select("callback_id", F.col("document.id").alias("id"),
                    F.col("document.department.code").alias("head_code"),
                    F.when(F.col("document.line_items").isNotNull(),
                           F.size("document.line_items")).alias("n_lines"))


_ACTIVITY = f"""SELECT CASE WHEN v > 0 THEN created_at ELSE CAST(d AS TIMESTAMP) END + INTERVAL 7 HOUR AS created_date,
  CASE WHEN v > 0 THEN 'u' || (k % 5) ELSE 'creator' END AS created_by,
  CASE WHEN v > 0 THEN 'u@example.org' ELSE 'c@example.org' END AS created_by_email,
  CASE v WHEN 0 THEN 'create' WHEN 2 THEN 'delete' ELSE 'update' END AS activity_type, upper(method) AS action,
  module, end_point AS endpoint, 'NO/' || k AS ref_no, 'DOC-' || k AS source_id, status, d AS doc_date,
  'feed' AS note, CAST(callback_id AS VARCHAR) AS callback_id, created_at + INTERVAL 7 HOUR AS callback_at
FROM feed WHERE {_GOOD}"""


def activity(spark, sf):
    return A.activity_rows(C.callback_window_extract(feed(spark, sf), schema=C.HEAD_SCHEMA))


@query("activity_rows", f"WITH {FEED_SQL} {_ACTIVITY}")
def activity_rows(spark, sf):
    return activity(spark, sf)


@query("activity_upsert", f"""WITH {FEED_SQL}, a AS ({_ACTIVITY})
SELECT * REPLACE (CASE WHEN CAST(callback_id AS BIGINT) % 2 = 0 THEN note ELSE 'old' END AS note) FROM a""")
def activity_upsert(spark, sf):
    """A log that holds everything, re-scanned in part and delivered twice."""
    rows = activity(spark, sf)
    log = rows.withColumn("note", F.lit("old"))
    again = rows.filter(F.col("callback_id").cast("bigint") % 2 == 0)
    doubled = again.withColumn("note", F.lit("first")).withColumn("o", F.lit(0)).unionByName(
        again.withColumn("o", F.lit(1)))
    return A.activity_upsert(log, doubled, ["o"])


@query("callback_flatten", f"""WITH {FEED_SQL}
SELECT callback_id, created_at, CASE WHEN NOT garbage THEN end_point END AS end_point,
  CASE WHEN NOT garbage THEN method END AS method, CASE WHEN NOT garbage THEN 'DOC-' || k END AS id,
  CASE WHEN NOT garbage THEN 'NO/' || k END AS number, CASE WHEN NOT garbage THEN status END AS status,
  CASE WHEN NOT garbage THEN 'Head' END AS "department.name" FROM feed""")
def callback_flatten(spark, sf):
    flat = P.callback_flatten(feed(spark, sf))
    return flat.select("callback_id", "created_at", "end_point", "method", "id", "number", "status",
                       "`department.name`")


@query("callback_value_counts", f"""WITH {FEED_SQL}, g AS (SELECT * FROM feed WHERE NOT garbage)
SELECT 'end_point' AS field, end_point AS value, COUNT(*) AS n FROM g GROUP BY 2 UNION ALL
SELECT 'method', method, COUNT(*) FROM g GROUP BY 2 UNION ALL
SELECT 'status', status, COUNT(*) FROM g GROUP BY 2""")
def callback_value_counts(spark, sf):
    return P.callback_value_counts(P.callback_flatten(feed(spark, sf)))


@query("callback_status_crosstab", f"""WITH {FEED_SQL}, g AS (SELECT * FROM feed WHERE NOT garbage)
SELECT COALESCE(end_point, 'All') AS end_point, COUNT(*) FILTER (status = 'approved') AS approved,
  COUNT(*) FILTER (status = 'draft') AS draft, COUNT(*) FILTER (status = 'Draft') AS "Draft_2",
  COUNT(*) AS "All" FROM g GROUP BY GROUPING SETS ((end_point), ())""")
def callback_status_crosstab(spark, sf):
    flat = P.callback_flatten(feed(spark, sf)).withColumn(
        "status", F.when(F.col("status") == "Draft", "Draft_2").otherwise(F.col("status")))
    return P.callback_status_crosstab(flat, ["approved", "draft", "Draft_2"])


@query("callbacks_per_document", f"""WITH {FEED_SQL},
c AS (SELECT end_point, k, COUNT(*) AS callback_count FROM feed WHERE NOT garbage GROUP BY 1, 2)
SELECT callback_count, COUNT(*) AS documents FROM c GROUP BY 1""")
def callbacks_per_document(spark, sf):
    return P.callbacks_per_document(P.callback_flatten(feed(spark, sf)))


@query("callbacks_per_document_totals", f"""WITH {FEED_SQL},
c AS (SELECT end_point, k, COUNT(*) AS n FROM feed WHERE NOT garbage GROUP BY 1, 2)
SELECT CAST(SUM(n) AS BIGINT) AS callbacks, COUNT(*) AS documents, COUNT(*) FILTER (n > 1) AS duplicated FROM c""")
def callbacks_per_document_totals(spark, sf):
    return P.callbacks_per_document_totals(P.callback_flatten(feed(spark, sf)))


@query("document_timeline", f"""WITH {FEED_SQL},
c AS (SELECT end_point, 'DOC-' || k AS id FROM feed WHERE NOT garbage GROUP BY 1, 2 HAVING COUNT(*) > 1),
f AS (SELECT end_point, id FROM c ORDER BY 1, 2 LIMIT 1)
SELECT created_at, callback_id, method, status FROM feed JOIN f
  ON feed.end_point = f.end_point AND 'DOC-' || feed.k = f.id WHERE NOT garbage""")
def document_timeline(spark, sf):
    t = P.document_timeline(P.callback_flatten(feed(spark, sf)))
    return t.select("created_at", "callback_id", "method", "status")


@query("source_preview", f"""WITH {FEED_SQL}
SELECT callback_id, created_at FROM feed ORDER BY created_at DESC, callback_id DESC LIMIT 10""")
def source_preview(spark, sf):
    return P.source_preview(feed(spark, sf)).select("callback_id", "created_at")


@query("table_describe", """
WITH v AS (SELECT 'quantity' AS field, l_quantity AS x FROM lineitem UNION ALL
           SELECT 'price', l_extendedprice FROM lineitem)
SELECT field, COUNT(x) AS count, ROUND(AVG(x), 4) AS mean, ROUND(STDDEV_SAMP(x), 4) AS std, MIN(x) AS min,
  ROUND(QUANTILE_CONT(x, 0.25), 6) AS p25, ROUND(QUANTILE_CONT(x, 0.5), 6) AS p50,
  ROUND(QUANTILE_CONT(x, 0.75), 6) AS p75, MAX(x) AS max FROM v GROUP BY 1""")
def table_describe(spark, sf):
    li = I.table(spark, sf, "lineitem").select(F.col("l_quantity").alias("quantity"),
                                               F.col("l_extendedprice").alias("price"))
    d = P.table_describe(li, ["quantity", "price"])
    return d.select("field", "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"),
                    "min", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")
