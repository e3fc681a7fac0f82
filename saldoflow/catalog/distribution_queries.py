"""Queries: cost distribution over ledger lines made of order lines.

Nations are departments, regions their buckets, one region is swept; headcount
comes from customers and revenue from suppliers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from saldoflow import constants as K
from saldoflow.catalog import inputs as I, query
from saldoflow.operators import distribution as D
from saldoflow.plans import distribution_run as R

_CODE = """CASE p_type WHEN 'LARGE' THEN '6101-00-000' WHEN 'MEDIUM' THEN '5101-00-000' WHEN 'ECONOMY' THEN '4101-00-000'
  WHEN 'PROMO' THEN '7201-00-000' WHEN 'SMALL' THEN '6201-00-000' ELSE '6301-00-000' END"""
_NAME = """CASE p_type WHEN 'LARGE' THEN 'Salary' WHEN 'MEDIUM' THEN 'Materials' WHEN 'ECONOMY' THEN 'Sales'
  WHEN 'PROMO' THEN 'Depreciation' WHEN 'SMALL' THEN 'Lab supplies' ELSE 'Travel' END"""
_LOCATION = """CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Head Office' WHEN 'BUILDING' THEN 'Central LABORATORY'
  WHEN 'FURNITURE' THEN 'surabaya' WHEN 'HOUSEHOLD' THEN 'Medan' ELSE 'Elsewhere' END"""
_DETAIL = "CASE c_custkey % 3 WHEN 0 THEN 'Head Office : Tower G' WHEN 1 THEN 'head office : tower b' END"
_BUCKET = "CASE WHEN r_regionkey = 0 THEN 'Administration Indonesia' ELSE r_name END"
_LOGIC = """CASE r_regionkey WHEN 0 THEN '7201-00-000' WHEN 1 THEN '6101-00-000' WHEN 2 THEN '6201-00-000'
    WHEN 3 THEN '6301-00-000' ELSE '5101-00-000' END AS account_code,
  CASE r_regionkey WHEN 0 THEN 'Depreciation' WHEN 1 THEN 'Salary' WHEN 2 THEN 'Lab supplies' WHEN 3 THEN 'Travel'
    ELSE 'Materials' END AS account_name,
  CASE WHEN r_regionkey > 0 THEN r_name END AS pc,
  CASE r_regionkey WHEN 0 THEN 'FTE - All' WHEN 1 THEN 'FTE - All' WHEN 2 THEN 'Lab Distribution' WHEN 3 THEN 'Revenue'
    ELSE 'Corporate Services' END AS distribution"""

SHEETS_SQL = f"""
pc AS (SELECT 'N' || n_nationkey AS dept_code, n_name AS dept, 'Div ' || r_name AS div, {_BUCKET} AS pc, n_nationkey AS seq
  FROM nation JOIN region ON n_regionkey = r_regionkey),
coa AS (SELECT {_CODE} AS code, {_NAME} AS account_name, '2' || p_type AS reporting_code, 'Line ' || p_type AS reporting_line,
    '2' || p_type || ' Line ' || p_type AS reporting_account FROM (SELECT DISTINCT p_type FROM part)
  UNION ALL SELECT '7501-00-000', 'Allocation Overhead', '360', 'Allocation overhead', '360 Allocation overhead' FROM region WHERE r_regionkey = 0),
logic AS (SELECT {_LOGIC} FROM region),
fte AS (SELECT n_name AS dept, CAST(1 + c_custkey % 3 AS DOUBLE) AS hc, {_LOCATION} AS location, {_DETAIL} AS location_detail
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
rev AS (SELECT n_name AS div, 1.0::DOUBLE / (SELECT COUNT(*) FROM supplier) AS pct_all, s_suppkey % 4 / 10.0::DOUBLE AS pct_ho,
  s_suppkey % 2 / 10.0::DOUBLE AS pct_certification_services FROM supplier JOIN nation ON s_nationkey = n_nationkey),
hc AS (SELECT dept, SUM(hc) AS hc FROM fte GROUP BY 1),
rv AS (SELECT div, SUM(1.0::DOUBLE) / (SELECT COUNT(*) FROM supplier) AS p FROM rev GROUP BY 1),
alloc AS (
  SELECT 'FTE - All' AS distribution, NULL AS account_name, dept AS new_dept, hc / (SELECT SUM(hc) FROM hc) AS percentage, pc.seq
  FROM hc JOIN pc USING (dept) UNION ALL
  SELECT 'Revenue', NULL, rv.div, p, 100 + pc.seq FROM rv JOIN pc ON pc.dept = rv.div UNION ALL
  SELECT 'Lab Distribution', 'LAB supplies', n_name, 0.2::DOUBLE, 200 + n_nationkey FROM nation WHERE n_regionkey = 1 UNION ALL
  SELECT 'Corporate Services', NULL, n_name, CASE n_nationkey WHEN 4 THEN 0.2::DOUBLE ELSE 0.4::DOUBLE END, 300 + n_nationkey
  FROM nation WHERE n_nationkey IN (4, 9, 14))
"""
GL_SQL = f"""
ol AS (SELECT l_orderkey AS k, l_linenumber AS n, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross, MIN(l_suppkey) AS supp,
  MIN(l_partkey) AS part, CAST(MIN(l_shipdate) AS DATE) AS d FROM lineitem GROUP BY 1, 2),
gl AS (SELECT k * 10 + n AS seq, CASE WHEN k % 200 <> 3 THEN d END AS date, 'GJ' AS type, 'R-' || k AS ref_no,
  CASE WHEN k % 6 <> 0 THEN 'N' || n_nationkey END AS dept_code,
  CASE WHEN k % 60 = 0 THEN 'Nowhere' WHEN k % 25 = 0 AND k % 6 <> 0 THEN 'Old name' ELSE n_name END AS dept,
  CAST(CASE WHEN p_type = 'ECONOMY' THEN 0 WHEN k % 40 = 1 THEN -gross ELSE gross END AS DOUBLE) AS debit,
  CAST(CASE WHEN p_type = 'ECONOMY' THEN gross ELSE 0 END AS DOUBLE) AS credit, {_CODE} AS account_code,
  CASE WHEN k % 2 = 0 THEN {_NAME} ELSE upper({_NAME}) END AS account_name, lower({_NAME}) AS akey
  FROM ol JOIN supplier ON s_suppkey = supp JOIN nation ON s_nationkey = n_nationkey JOIN part ON p_partkey = part),
res AS (SELECT gl.*, CASE WHEN gl.account_code LIKE '4%' THEN credit - debit ELSE debit - credit END AS amount,
  c.pc AS bucket_by_code, b.pc AS bucket_by_name, COALESCE(c.pc, b.pc) AS bucket, lg.distribution AS method,
  coa.reporting_code, coa.reporting_line AS reporting_account_name, coa.reporting_account
  FROM gl LEFT JOIN pc c ON c.dept_code = gl.dept_code LEFT JOIN pc b ON b.dept = gl.dept LEFT JOIN coa ON coa.code = gl.account_code
  LEFT JOIN logic lg ON lg.account_code = gl.account_code AND lower(lg.account_name) = akey AND lg.pc IS NOT DISTINCT FROM COALESCE(c.pc, b.pc)),
ch AS (
  SELECT res.*, 'direct' AS kind, dept AS to_dept, 1.0::DOUBLE AS percentage, amount AS allocation FROM res WHERE method IS NULL UNION ALL
  SELECT res.*, CASE WHEN a.new_dept IS NULL THEN 'reject' ELSE 'distributed' END, a.new_dept, a.percentage, amount * a.percentage
  FROM res LEFT JOIN alloc a ON a.distribution = method AND (method <> 'Lab Distribution' OR lower(a.account_name) = akey) WHERE method IS NOT NULL),
base AS (SELECT ch.* EXCLUDE (to_dept), CAST(date_trunc('month', date) AS DATE) AS period,
  COALESCE(c.dept, to_dept) AS new_dept, COALESCE(c.div, b.div) AS div, COALESCE(c.pc, b.pc) AS pc,
  CASE WHEN method IS NULL THEN COALESCE(ch.dept_code, b.dept_code) ELSE b.dept_code END AS new_dept_code,
  account_code || ' ' || account_name AS account, CASE WHEN method IS NOT NULL THEN method || ' / ' || to_dept END AS label
  FROM ch LEFT JOIN pc b ON b.dept = to_dept
  LEFT JOIN pc c ON c.dept_code = CASE WHEN method IS NULL THEN COALESCE(ch.dept_code, b.dept_code) ELSE b.dept_code END
  WHERE kind <> 'reject'),
wr AS (SELECT new_dept, alloc.seq, round_even(percentage / SUM(percentage) OVER () * 10000, 0) / 10000 AS w
  FROM alloc JOIN pc ON pc.dept = new_dept WHERE distribution = 'FTE - All' AND pc.pc <> 'Administration Indonesia'),
wt AS (SELECT new_dept, seq, w + CASE WHEN row_number() OVER (ORDER BY w DESC, seq) = 1 THEN 1 - SUM(w) OVER () ELSE 0 END AS weight FROM wr),
own AS (SELECT period, new_dept, SUM(CASE WHEN account_code LIKE '4%' THEN -allocation ELSE allocation END) AS net
  FROM base JOIN (SELECT dept FROM pc WHERE pc = 'Administration Indonesia') s ON s.dept = new_dept WHERE period IS NOT NULL GROUP BY 1, 2 HAVING net <> 0),
sweep AS (SELECT x.*, pc.dept_code AS new_dept_code, pc.div, pc.pc FROM (
  SELECT period, new_dept, -net AS amount, 1.0::DOUBLE AS percentage, -net AS allocation FROM own UNION ALL
  SELECT period, wt.new_dept, pool, weight, pool * weight FROM (SELECT period, SUM(net) AS pool FROM own GROUP BY 1) p, wt) x
  JOIN pc ON pc.dept = x.new_dept)
"""
ALL_SQL = f"{SHEETS_SQL}, {GL_SQL}"


def sheets(spark, sf) -> dict:
    nation, region, part = (I.table(spark, sf, t) for t in ("nation", "region", "part"))
    customer, supplier = I.table(spark, sf, "customer"), I.table(spark, sf, "supplier")
    pc = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "concat('N', n_nationkey) AS dept_code", "n_name AS dept", "concat('Div ', r_name) AS div",
        f"{_BUCKET} AS pc", "CAST(n_nationkey AS BIGINT) AS seq")
    overhead = region.filter("r_regionkey = 0").selectExpr(
        "'7501-00-000' AS code", "'Allocation Overhead' AS account_name", "'360' AS reporting_code",
        "'Allocation overhead' AS reporting_line", "'360 Allocation overhead' AS reporting_account", "0L AS seq")
    coa = part.select("p_type").distinct().selectExpr(
        f"{_CODE} AS code", f"{_NAME} AS account_name", "concat('2', p_type) AS reporting_code",
        "concat('Line ', p_type) AS reporting_line", "concat('2', p_type, ' Line ', p_type) AS reporting_account",
        "1L AS seq").unionByName(overhead)
    logic = region.selectExpr(*[c.strip() for c in _split(_LOGIC)], "CAST(NULL AS STRING) AS code")
    fte = customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "n_name AS dept", "CAST(1 + c_custkey % 3 AS DOUBLE) AS hc", f"{_LOCATION} AS location",
        f"{_DETAIL} AS location_detail")
    total = supplier.agg(F.count("*").alias("total"))
    # Totals are one row, so the cross joins add a column.
    rev = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
           .crossJoin(F.broadcast(total)).selectExpr(
        "n_name AS div", "1.0D / total AS pct_all", "s_suppkey % 4 / 10.0D AS pct_ho",
        "s_suppkey % 2 / 10.0D AS pct_certification_services"))
    return {"PC": pc, "COA": coa, "LOGIC": logic, "FTE": fte, "REV": rev,
            "ALLOCATION": _allocation(nation, fte, rev)}


def _split(text):
    """The select items of a text whose items end in AS name."""
    out, depth, item = [], 0, ""
    for token in text.replace("\n", " ").split(" "):
        depth += (token == "CASE") - (token.strip(",") == "END")
        if token.endswith(",") and depth == 0:
            out.append(item + " " + token[:-1])
            item = ""
        else:
            item += " " + token
    return out + [item]


def _allocation(nation, fte, rev):
    hc = fte.groupBy("dept").agg(F.sum("hc").alias("hc"))
    total = hc.agg(F.sum("hc").alias("total"))
    key = nation.selectExpr("n_name", "CAST(n_nationkey AS BIGINT) AS nk", "n_regionkey")
    head = (hc.crossJoin(F.broadcast(total)).join(key, F.col("dept") == F.col("n_name"))
            .selectExpr("'FTE - All' AS distribution", "CAST(NULL AS STRING) AS account_name",
                        "dept AS new_dept", "hc / total AS percentage", "nk AS seq"))
    counts = rev.groupBy("div").agg(F.count("*").cast("double").alias("n"))
    n_all = counts.agg(F.sum("n").alias("total"))
    revenue = (counts.crossJoin(F.broadcast(n_all)).join(key, F.col("div") == F.col("n_name"))
               .selectExpr("'Revenue' AS distribution", "CAST(NULL AS STRING) AS account_name",
                           "div AS new_dept", "n / total AS percentage", "100 + nk AS seq"))
    lab = key.filter("n_regionkey = 1").selectExpr(
        "'Lab Distribution' AS distribution", "'LAB supplies' AS account_name", "n_name AS new_dept",
        "0.2D AS percentage", "200 + nk AS seq")
    fixed = key.filter("nk IN (4, 9, 14)").selectExpr(
        "'Corporate Services' AS distribution", "CAST(NULL AS STRING) AS account_name", "n_name AS new_dept",
        "IF(nk = 4, 0.2D, 0.4D) AS percentage", "300 + nk AS seq")
    return head.unionByName(revenue).unionByName(lab).unionByName(fixed)


def ledger(spark, sf):
    """Ledger lines in sheet form, one per order line."""
    li = I.table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n")).agg(
        F.sum(I.money("l_extendedprice")).alias("gross"), F.min("l_suppkey").alias("supp"),
        F.min("l_partkey").alias("part"), F.to_date(F.min("l_shipdate")).alias("d"))
    supplier, nation, part = (I.table(spark, sf, t) for t in ("supplier", "nation", "part"))
    rows = (li.join(supplier, F.col("supp") == supplier.s_suppkey)
            .join(nation, supplier.s_nationkey == nation.n_nationkey)
            .join(part, F.col("part") == part.p_partkey))
    return rows.selectExpr(
        "k * 10 + n AS seq", "IF(k % 200 <> 3, d, NULL) AS date", "'GJ' AS type", "concat('R-', k) AS ref_no",
        "IF(k % 6 <> 0, concat('N', n_nationkey), NULL) AS dept_code",
        "CASE WHEN k % 60 = 0 THEN 'Nowhere' WHEN k % 25 = 0 AND k % 6 <> 0 THEN 'Old name' ELSE n_name END AS dept",
        "CAST(CASE WHEN p_type = 'ECONOMY' THEN 0 WHEN k % 40 = 1 THEN -gross ELSE gross END AS DOUBLE) AS debit",
        "CAST(IF(p_type = 'ECONOMY', gross, 0) AS DOUBLE) AS credit", f"{_CODE} AS account_code",
        f"IF(k % 2 = 0, {_NAME}, upper({_NAME})) AS account_name")


def numbered(spark, sf):
    """Lines with an id; the ledger's own sequence serves as one."""
    return ledger(spark, sf).withColumn("gl_line_id", F.col("seq"))


def lookups(spark, sf):
    return R.build_lookups(sheets(spark, sf))


def resolved(spark, sf):
    return R.resolve(numbered(spark, sf), lookups(spark, sf))


def charged(spark, sf):
    lk = lookups(spark, sf)
    return D.charge(R.resolve(numbered(spark, sf), lk), lk.split)


def run(spark, sf, **options):
    return R.distribute(numbered(spark, sf), sheets(spark, sf), **options)


def cent(value):
    """Rounded to cents; a value on the half goes up in both engines, whatever
    the last bits of the double are."""
    return F.floor(value * 100 + 0.500001) / 100


def cents(df, *columns):
    return df.select(*[cent(F.col(c)).alias(c)
                       if c in ("amount", "allocation", "debit", "credit", "net", "total") else F.col(c)
                       for c in columns])


def _c(value, name):
    return f"floor(({value}) * 100 + 0.500001) / 100 AS {name}"


def _m(c):
    return _c(c, c)


@query("gl_period_filter", f"""WITH {ALL_SQL} SELECT seq, date, {_m('debit')}, {_m('credit')} FROM gl
WHERE date >= DATE '1997-03-01' AND date < DATE '1997-04-01'""")
def gl_period_filter(spark, sf):
    return cents(D.gl_period_filter(ledger(spark, sf), "1997-03-01"), "seq", "date", "debit", "credit")


@query("gl_period_report", f"""WITH {ALL_SQL} SELECT
  COUNT(*) FILTER (date_trunc('month', date) = DATE '1997-03-01') AS kept,
  COUNT(*) FILTER (date_trunc('month', date) <> DATE '1997-03-01') AS other_period,
  COUNT(*) FILTER (date IS NULL) AS undated FROM gl""")
def gl_period_report(spark, sf):
    return D.gl_period_report(ledger(spark, sf), "1997-03-01")


@query("gl_line_id", f"WITH {ALL_SQL} SELECT seq, row_number() OVER (ORDER BY seq) - 1 AS gl_line_id FROM gl")
def gl_line_id(spark, sf):
    return R.number_lines(ledger(spark, sf)).select("seq", "gl_line_id")


@query("pc_lookup", f"""WITH {ALL_SQL} SELECT 'name' AS lookup, lower(dept) AS key, pc, div, dept_code, dept FROM pc
UNION ALL SELECT 'code', dept_code, pc, div, dept_code, dept FROM pc""")
def pc_lookup(spark, sf):
    by_name, by_code = D.pc_lookup(sheets(spark, sf)["PC"])
    return (by_name.select(F.lit("name").alias("lookup"), F.col("name_key").alias("key"), "pc", "div", "dept_code", "dept")
            .unionByName(by_code.select(F.lit("code").alias("lookup"), F.col("code_key").alias("key"), "pc", "div",
                                        "dept_code", "dept")))


@query("coa_reporting_lookup", f"""WITH {ALL_SQL} SELECT code AS coa_key, reporting_line AS reporting_account_name,
  reporting_code, reporting_account, reporting_code || ' ' || reporting_line AS derived FROM coa""")
def coa_reporting_lookup(spark, sf):
    coa = sheets(spark, sf)["COA"]
    older = D.coa_reporting_lookup(coa.drop("reporting_account")).select(
        "coa_key", F.col("reporting_account").alias("derived"))
    return D.coa_reporting_lookup(coa).join(older, "coa_key")


@query("logic_rules", f"""WITH {ALL_SQL} SELECT account_code AS code_key, lower(account_name) AS account_key,
  lower(pc) AS bucket_key, distribution AS method FROM logic""")
def logic_rules(spark, sf):
    return D.logic_rules(sheets(spark, sf)["LOGIC"])


@query("allocation_split", f"""WITH {ALL_SQL} SELECT distribution, CASE WHEN distribution = 'Lab Distribution'
  THEN lower(account_name) END AS lab_key, new_dept, ROUND(percentage, 9) AS percentage,
  distribution = 'Lab Distribution' AS is_lab FROM alloc""")
def allocation_split(spark, sf):
    rows = D.allocation_split(sheets(spark, sf)["ALLOCATION"])
    return rows.select("distribution", "lab_key", "new_dept", F.round("percentage", 9).alias("percentage"), "is_lab")


@query("line_amount", f"WITH {ALL_SQL} SELECT seq, {_m('amount')}, account_code LIKE '4%' AS credit_side FROM res")
def line_amount(spark, sf):
    return cents(D.line_amount(ledger(spark, sf)), "seq", "amount", "credit_side")


@query("bucket_resolve", f"""WITH {ALL_SQL} SELECT COUNT(*) FILTER (bucket_by_code <> bucket_by_name) AS disagreed,
  COUNT(*) FILTER (bucket_by_code IS NOT NULL AND bucket_by_name IS NULL) AS rescued FROM res""")
def bucket_resolve(spark, sf):
    return D.bucket_report(resolved(spark, sf))


@query("rule_resolve", f"WITH {ALL_SQL} SELECT seq, bucket, method, reporting_code, reporting_account FROM res")
def rule_resolve(spark, sf):
    return resolved(spark, sf).select("seq", "bucket", "method", "reporting_code", "reporting_account")


_CH = ["seq", "method", "new_dept", "amount", "allocation"]
_CHS = f"seq, method, to_dept AS new_dept, {_m('amount')}, {_m('allocation')}"


@query("charge_direct", f"WITH {ALL_SQL} SELECT {_CHS} FROM ch WHERE kind = 'direct'")
def charge_direct(spark, sf):
    return cents(D.charge_direct(charged(spark, sf)), *_CH)


@query("charge_distributed", f"""WITH {ALL_SQL} SELECT {_CHS} FROM ch
WHERE kind = 'distributed' AND method <> 'Lab Distribution'""")
def charge_distributed(spark, sf):
    return cents(D.charge_distributed(charged(spark, sf)), *_CH)


@query("charge_lab", f"WITH {ALL_SQL} SELECT {_CHS} FROM ch WHERE kind = 'distributed' AND method = 'Lab Distribution'")
def charge_lab(spark, sf):
    return cents(D.charge_lab(charged(spark, sf)), *_CH)


@query("charge_rejects", f"""WITH {ALL_SQL} SELECT seq, method, {_m('amount')} FROM res WHERE method = 'Corporate Services'""")
def charge_rejects(spark, sf):
    """One method's split is missing, so all its lines are rejected."""
    s = sheets(spark, sf)
    s["ALLOCATION"] = s["ALLOCATION"].filter("distribution <> 'Corporate Services'")
    lk = R.build_lookups(s)
    rejects = D.charge_rejects(D.charge(R.resolve(numbered(spark, sf), lk), lk.split))
    return cents(rejects, "seq", "method", "amount")


_OUT = ["seq", "new_dept", "new_dept_code", "div", "pc", "account", "period", "allocation"]


@query("receiver_enrich", f"""WITH {ALL_SQL} SELECT seq, new_dept, new_dept_code, div, pc, account, period,
  {_m('allocation')}, label AS distribution_and_allocation FROM base""")
def receiver_enrich(spark, sf):
    return cents(run(spark, sf, overhead=False).base, *_OUT, "distribution_and_allocation")


@query("overhead_weights", f"WITH {ALL_SQL} SELECT new_dept, ROUND(weight, 6) AS weight FROM wt")
def overhead_weights(spark, sf):
    lk = lookups(spark, sf)
    return D.overhead_weights(lk.split, lk.swept).select("new_dept", F.round("weight", 6).alias("weight"))


_MONTH_ID = ("CASE month(period - INTERVAL 1 MONTH) " + " ".join(
    f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(K.MONTHS_ID)) + " END")


@query("overhead_sweep", f"""WITH {ALL_SQL} SELECT period, new_dept, new_dept_code, div, pc, {_m('amount')}, {_m('allocation')},
  ROUND(percentage, 6) AS percentage, 'Allocation Overhead ' || strftime(period, '%m%y') AS description,
  '7501-00-000' AS account_code, 'FTE : PC ' || {_MONTH_ID} AS method, '360' AS reporting_code,
  floor((GREATEST(amount, 0)) * 100 + 0.500001) / 100 AS debit, floor((GREATEST(-amount, 0)) * 100 + 0.500001) / 100 AS credit FROM sweep""")
def overhead_sweep(spark, sf):
    rows = run(spark, sf).overhead.withColumn("percentage", F.round("percentage", 6))
    return cents(rows, "period", "new_dept", "new_dept_code", "div", "pc", "amount", "allocation", "percentage",
                 "description", "account_code", "method", "reporting_code", "debit", "credit")


_RECON = """recon AS (SELECT (SELECT SUM(amount) FROM res) AS source_total,
  (SELECT SUM(allocation) FROM base) AS allocated_total, (SELECT COUNT(*) FROM res) AS n_gl_lines,
  (SELECT COUNT(*) FROM base) + (SELECT COUNT(*) FROM sweep) AS n_output_rows,
  (SELECT COUNT(*) FROM base WHERE method IS NULL) AS n_direct, (SELECT COUNT(*) FROM base WHERE method IS NOT NULL) AS n_distributed,
  CAST(0 AS BIGINT) AS n_rejects, (SELECT COUNT(*) FROM sweep) AS n_overhead,
  (SELECT -SUM(allocation) FROM sweep WHERE allocation < 0) AS overhead_pool,
  (SELECT SUM(amount) FROM res WHERE amount < 0) AS negative_source,
  (SELECT SUM(allocation) FROM base WHERE allocation < 0) AS negative_allocation)"""
_COUNTS = ["n_gl_lines", "n_output_rows", "n_direct", "n_distributed", "n_rejects", "n_overhead"]
_SUMS = ["source_total", "allocated_total", "overhead_pool"]


@query("recon_summary", f"""WITH {ALL_SQL}, {_RECON} SELECT {', '.join(_COUNTS)},
  {', '.join(f'CAST({c} AS DECIMAL(24,2)) AS {c}' for c in _SUMS)} FROM recon""")
def recon_summary(spark, sf):
    r = run(spark, sf).recon
    return r.select(*_COUNTS, *[F.col(c).cast("decimal(24,2)").alias(c) for c in _SUMS])


@query("check_sign_totals", f"""WITH {ALL_SQL}, {_RECON} SELECT CAST(negative_source AS DECIMAL(24,2)) AS negative_source,
  CAST(negative_allocation AS DECIMAL(24,2)) AS negative_allocation FROM recon""")
def check_sign_totals(spark, sf):
    r = D.check_sign_totals(run(spark, sf).recon)
    return r.select(*[F.col(c).cast("decimal(24,2)").alias(c) for c in r.columns])


# A second set of books from the first: some direct lines lost, some splits halved, some
# children turned into rejects, and a sweep without its negative side.
_BROKEN = """bch AS (SELECT * REPLACE (CASE WHEN kind = 'distributed' AND seq % 11 = 0 THEN 'reject' ELSE kind END AS kind,
    CASE WHEN kind = 'distributed' AND seq % 5 = 0 THEN allocation / 2 ELSE allocation END AS allocation)
  FROM ch WHERE NOT (kind = 'direct' AND seq % 7 = 0)),
bsweep AS (SELECT * FROM sweep WHERE allocation > 0)"""


def _broken(r):
    charged = r.charged.filter("NOT (kind = 'direct' AND seq % 7 = 0)").withColumns({
        "allocation": F.expr("IF(kind = 'distributed' AND seq % 5 = 0, allocation / 2, allocation)"),
        "kind": F.expr("IF(kind = 'distributed' AND seq % 11 = 0, 'reject', kind)")})
    return D.recon_summary(r.resolved, charged, r.overhead.filter("allocation > 0")), charged


def _gate(name, gate, of_recon=True):
    def verdict(ch, sweep):
        return {
            "total_tieout": f"ABS((SELECT SUM(allocation) FROM {ch} WHERE kind <> 'reject') + (SELECT SUM(allocation) FROM {sweep}) - (SELECT SUM(amount) FROM res)) < 0.01",
            "sweep_zero_sum": f"ABS((SELECT SUM(allocation) FROM {sweep})) < 0.01",
            "no_rejects": f"NOT EXISTS (SELECT 1 FROM {ch} WHERE kind = 'reject')",
            "direct_count": f"(SELECT COUNT(*) FROM {ch} WHERE kind = 'direct') = (SELECT COUNT(*) FROM res WHERE method IS NULL)",
            "line_conservation": f"""NOT EXISTS (SELECT 1 FROM {ch} WHERE kind <> 'reject' GROUP BY seq
              HAVING ABS(SUM(allocation) - MAX(amount)) > 1e-6)"""}[gate]

    @query(name, f"""WITH {ALL_SQL}, {_BROKEN} SELECT 'sound' AS book, '{gate}' AS gate, {verdict('ch', 'sweep')} AS ok
UNION ALL SELECT 'broken', '{gate}', {verdict('bch', 'bsweep')}""")
    def fn(spark, sf):
        r = run(spark, sf)
        books = {"sound": (r.recon, r.charged), "broken": _broken(r)}
        return D.union_all(*[getattr(D, name)(recon if of_recon else charged).withColumn("book", F.lit(b))
                             for b, (recon, charged) in books.items()])


for _n, _g in (("gate_total_tieout", "total_tieout"), ("gate_sweep_zero_sum", "sweep_zero_sum"),
               ("gate_no_rejects", "no_rejects"), ("gate_direct_count", "direct_count")):
    _gate(_n, _g)
_gate("gate_line_conservation", "line_conservation", of_recon=False)


@query("check_percentage_sets", f"""WITH {ALL_SQL} SELECT distribution, lower(account_name) AS account_key,
  ROUND(SUM(percentage * 1.5), 6) AS total FROM alloc GROUP BY 1, 2 HAVING ABS(SUM(percentage * 1.5) - 1) > 1e-6""")
def check_percentage_sets(spark, sf):
    """Splits blown up by half, so that none adds up."""
    a = sheets(spark, sf)["ALLOCATION"].withColumn("percentage", F.col("percentage") * 1.5)
    rows = D.check_percentage_sets(D.allocation_split(a))
    return rows.withColumn("total", F.round("total", 6))


@query("check_referential", f"""WITH {ALL_SQL} SELECT DISTINCT 'department' AS kind, lower(x) AS value FROM (
  SELECT dept AS x FROM res UNION ALL SELECT new_dept FROM base) WHERE x NOT IN (SELECT dept FROM pc)""")
def check_referential(spark, sf):
    s = sheets(spark, sf)
    r = run(spark, sf, overhead=False)
    return D.check_referential(r.resolved, r.base, D.pc_lookup(s["PC"])[0], s["COA"])


_PROJ = """SELECT date, type AS "Type", ref_no AS "Ref No.", NULL::VARCHAR AS "Contact", NULL::VARCHAR AS "Description",
  NULL::VARCHAR AS "Note", account_code AS "Code", account_name AS "Account Name", account AS "Account",
  reporting_code AS "Reporting Code", reporting_account_name AS "Reporting Account Name", reporting_account AS "Reporting Account",
  dept AS "Dept", new_dept AS "New Dept", div AS "Dept_div", pc AS "PC", floor((debit) * 100 + 0.500001) / 100 AS "Debit",
  floor((credit) * 100 + 0.500001) / 100 AS "Credit", floor((amount) * 100 + 0.500001) / 100 AS "Amount", ROUND(percentage, 9) AS "Percentage",
  floor((allocation) * 100 + 0.500001) / 100 AS "Allocation", label AS "Distribution And Allocation" FROM base"""


@query("distribution_project", f"WITH {ALL_SQL} {_PROJ}")
def distribution_project(spark, sf):
    out = D.distribution_project(run(spark, sf, overhead=False).out)
    money = {c: cent(F.col(c)) for c in ("Debit", "Credit", "Amount", "Allocation")}
    return out.withColumns({**money, "Percentage": F.round("Percentage", 9)})


@query("distribution_run", f"""WITH {ALL_SQL},
o AS (SELECT period, new_dept, pc, kind, allocation FROM base UNION ALL SELECT period, new_dept, pc, 'overhead', allocation FROM sweep)
SELECT period, new_dept, pc, kind, COUNT(*) AS n, floor((SUM(allocation)) * 100 + 0.500001) / 100 AS total FROM o GROUP BY 1, 2, 3, 4""")
def distribution_run(spark, sf):
    """The gated run, summed by month and receiving department."""
    r = run(spark, sf)
    R.validate(r)
    return (r.out.groupBy("period", "new_dept", "pc", "kind")
            .agg(F.count("*").alias("n"), cent(F.sum("allocation")).alias("total")))


@query("distribution_compare", f"""WITH {ALL_SQL}, t AS (SELECT new_dept, SUM(allocation) AS a FROM base GROUP BY 1),
s AS (SELECT new_dept, SUM(allocation) AS b FROM sweep GROUP BY 1)
SELECT new_dept, floor((a) * 100 + 0.500001) / 100 AS left_total, floor((a + COALESCE(b, 0)) * 100 + 0.500001) / 100 AS right_total,
  floor((ABS(COALESCE(b, 0))) * 100 + 0.500001) / 100 AS difference FROM t LEFT JOIN s USING (new_dept)""")
def distribution_compare(spark, sf):
    r = run(spark, sf)
    rows = D.distribution_compare(r.base, r.out)
    return rows.select("new_dept", *[cent(F.col(c)).alias(c)
                                     for c in ("left_total", "right_total", "difference")])


# --- ledger import ----------------------------------------------------------

_LEDGER = """lg AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS date, 'GJ' AS type, 'R' || o_orderkey AS ref_no,
  CASE WHEN o_orderkey % 6 <> 0 THEN 'N' || c_nationkey END AS dept_code,
  CASE o_orderkey % 3 WHEN 0 THEN ' CERTIFICATION SERVICES' ELSE 'Stored' END AS department,
  CAST(CASE o_orderkey % 7 WHEN 1 THEN 0 ELSE o_totalprice END AS DECIMAL(18,2)) AS debit,
  CAST(CASE o_orderkey % 7 WHEN 1 THEN o_totalprice ELSE 0 END AS DECIMAL(18,2)) AS credit,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '4101-00-000' WHEN 2 THEN '9101-00-000' ELSE '6101-00-000' END AS coa_code,
  CASE o_orderkey % 2 WHEN 0 THEN 'Internal Events, Meeting and Briefing ' ELSE 'Travel' END AS coa_name,
  CASE o_orderkey % 5 WHEN 0 THEN 'Balance Sheet' WHEN 1 THEN NULL ELSE 'Profit & Loss' END AS reporting,
  CASE o_orderstatus WHEN 'P' THEN 'draft' ELSE 'approved' END AS status
  FROM orders JOIN customer ON c_custkey = o_custkey)"""
_REASON = """CASE WHEN reporting IS NULL OR reporting <> 'Profit & Loss' THEN 'not_profit_and_loss' WHEN status <> 'approved' THEN 'status_not_allowed'
  WHEN coa_code IS NULL OR substr(coa_code, 1, 1) NOT IN ('4', '5', '6', '7') THEN 'outside_cost_accounts' END"""
_MONTH = "date >= DATE '1997-01-01' AND date < DATE '1997-02-01'"


def _accounting(spark, sf):
    o, c = I.table(spark, sf, "orders"), I.table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "o_orderkey AS k", "CAST(o_orderdate AS DATE) AS date", "'GJ' AS type", "concat('R', o_orderkey) AS ref_no",
        "CAST(NULL AS STRING) AS contact", "CAST(NULL AS STRING) AS description", "CAST(NULL AS STRING) AS note",
        "IF(o_orderkey % 6 <> 0, concat('N', c_nationkey), NULL) AS dept_code",
        "IF(o_orderkey % 3 = 0, ' CERTIFICATION SERVICES', 'Stored') AS department", "'N/A' AS project", "'IDR' AS currency",
        "CAST(IF(o_orderkey % 7 = 1, 0, o_totalprice) AS DECIMAL(18,2)) AS debit",
        "CAST(IF(o_orderkey % 7 = 1, o_totalprice, 0) AS DECIMAL(18,2)) AS credit",
        "CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '4101-00-000' WHEN 2 THEN '9101-00-000' ELSE '6101-00-000' END AS coa_code",
        "IF(o_orderkey % 2 = 0, 'Internal Events, Meeting and Briefing ', 'Travel') AS coa_name",
        "CASE o_orderkey % 5 WHEN 0 THEN 'Balance Sheet' WHEN 1 THEN NULL ELSE 'Profit & Loss' END AS reporting",
        "IF(o_orderstatus = 'P', 'draft', 'approved') AS status")


@query("gl_import_from_ledger", f"""WITH {_LEDGER} SELECT ref_no, date, dept_code,
  CASE WHEN dept_code IS NOT NULL THEN n_name WHEN k % 3 = 0 THEN 'System Certification Services' ELSE 'Stored' END AS dept,
  debit, credit, CAST(debit - credit AS DECIMAL(18,2)) AS balance, coa_code AS account_code,
  CASE k % 2 WHEN 0 THEN 'Internal Events' ELSE 'Travel' END AS account_name, DATE '1997-01-01' AS period
FROM lg LEFT JOIN nation ON dept_code = 'N' || n_nationkey WHERE {_MONTH} AND {_REASON} IS NULL""")
def gl_import_from_ledger(spark, sf):
    master = I.table(spark, sf, "nation").selectExpr("concat('N', n_nationkey) AS dept_code", "n_name AS dept_name")
    rows = D.gl_import_from_ledger(_accounting(spark, sf), master, "1997-01-01")
    return rows.select("ref_no", "date", "dept_code", "dept", *[F.col(c).cast("decimal(18,2)").alias(c)
                       for c in ("debit", "credit", "balance")], "account_code", "account_name", "period")


@query("gl_import_exclusions", f"""WITH {_LEDGER}, x AS (SELECT debit - credit AS net,
  COALESCE({_REASON}, CASE WHEN coa_code LIKE '4%' THEN 'revenue' ELSE 'cost' END) AS outcome FROM lg WHERE {_MONTH})
SELECT outcome, COUNT(*) AS n, CAST(SUM(CASE WHEN outcome = 'revenue' THEN -net ELSE net END) AS DECIMAL(38,2)) AS net FROM x GROUP BY 1""")
def gl_import_exclusions(spark, sf):
    return D.gl_import_exclusions(_accounting(spark, sf), "1997-01-01")


# --- basis ------------------------------------------------------------------

_SCOPES = """scope AS (SELECT 'FTE - All' AS m, dept, hc FROM fte UNION ALL
  SELECT 'FTE - Head Office', dept, hc FROM fte WHERE lower(location) LIKE '%head office%' UNION ALL
  SELECT 'FTE - Laboratory', dept, hc FROM fte WHERE lower(location) LIKE '%laboratory%' UNION ALL
  SELECT 'FTE - Surabaya', dept, hc FROM fte WHERE lower(location) LIKE '%surabaya%' UNION ALL
  SELECT 'FTE - Medan', dept, hc FROM fte WHERE lower(location) LIKE '%medan%' UNION ALL
  SELECT 'Head Office : Tower G', dept, hc FROM fte WHERE lower(location_detail) LIKE '%head office : tower g%' UNION ALL
  SELECT 'Head Office : Tower B', dept, hc FROM fte WHERE lower(location_detail) LIKE '%head office : tower b%'),
tot AS (SELECT m, SUM(hc) AS total FROM scope GROUP BY 1),
share AS (SELECT m, dept, SUM(hc) / MAX(total) AS p FROM scope JOIN tot USING (m) GROUP BY 1, 2),
methods AS (SELECT DISTINCT m FROM scope UNION SELECT 'FTE - Medan'),
ff AS (SELECT x.m AS distribution, n_name AS new_dept, COALESCE(p, 0) AS percentage FROM
  (SELECT unnest(['FTE - All', 'FTE - Head Office', 'FTE - Laboratory', 'FTE - Surabaya', 'FTE - Medan', 'Head Office : Tower G', 'Head Office : Tower B']) AS m) x,
  nation LEFT JOIN share ON share.m = x.m AND share.dept = n_name),
rf AS (SELECT x.m AS distribution, n_name AS new_dept, COALESCE(SUM(CASE x.m WHEN 'Revenue' THEN pct_all WHEN 'Revenue HO' THEN pct_ho
    ELSE pct_certification_services END), 0) AS percentage FROM
  (SELECT unnest(['Revenue', 'Revenue HO', 'Revenue - System Certification Services']) AS m) x, nation LEFT JOIN rev ON rev.div = n_name GROUP BY 1, 2),
stored AS (SELECT distribution, new_dept, 0.04::DOUBLE AS percentage FROM ff UNION ALL SELECT distribution, new_dept, 0.04::DOUBLE FROM rf
  UNION ALL SELECT distribution, new_dept, percentage FROM alloc WHERE distribution IN ('Lab Distribution', 'Corporate Services')),
fresh AS (SELECT * FROM ff UNION ALL SELECT * FROM rf
  UNION ALL SELECT distribution, new_dept, percentage FROM alloc WHERE distribution IN ('Lab Distribution', 'Corporate Services'))"""
_BASIS = """CASE WHEN distribution LIKE 'FTE%' OR distribution LIKE 'Head%' THEN 'basis_fte' WHEN distribution LIKE 'Revenue%'
  THEN 'basis_rev' ELSE 'Fixed' END"""


def full_roster(spark, sf):
    """A stored split where every nation receives under every derived method."""
    methods = F.array(*[F.lit(m) for m in list(K.FTE_SCOPES) + list(K.REVENUE_COLUMNS)])
    derived = I.table(spark, sf, "nation").select(
        F.explode(methods).alias("distribution"), F.lit(None).cast("string").alias("account_name"),
        F.col("n_name").alias("new_dept"), F.lit(0.04).alias("percentage"), F.col("n_nationkey").cast("bigint").alias("seq"))
    fixed = sheets(spark, sf)["ALLOCATION"].filter("distribution IN ('Lab Distribution', 'Corporate Services')")
    return derived.unionByName(fixed)


def _rounded(df):
    return df.select("distribution", "new_dept", F.round("percentage", 9).alias("percentage"))


@query("fte_factors", f"WITH {SHEETS_SQL}, {_SCOPES} SELECT distribution, new_dept, ROUND(percentage, 9) AS percentage FROM ff")
def fte_factors(spark, sf):
    return _rounded(D.fte_factors(sheets(spark, sf)["FTE"], full_roster(spark, sf)))


@query("revenue_factors", f"WITH {SHEETS_SQL}, {_SCOPES} SELECT distribution, new_dept, ROUND(percentage, 9) AS percentage FROM rf")
def revenue_factors(spark, sf):
    return _rounded(D.revenue_factors(sheets(spark, sf)["REV"], full_roster(spark, sf)))


def _fresh(spark, sf):
    s = sheets(spark, sf)
    return D.allocation_recompute(full_roster(spark, sf), s["FTE"], s["REV"])


@query("allocation_recompute", f"""WITH {SHEETS_SQL}, {_SCOPES}
SELECT distribution, new_dept, ROUND(percentage, 9) AS percentage, {_BASIS} AS basis FROM fresh""")
def allocation_recompute(spark, sf):
    return _fresh(spark, sf).select("distribution", "new_dept", F.round("percentage", 9).alias("percentage"), "basis")


_DRIFT = """d AS (SELECT s.distribution AS method, s.new_dept, s.percentage AS stored, ABS(s.percentage - f.percentage) AS drift
  FROM stored s JOIN fresh f USING (distribution, new_dept))"""


@query("basis_drift", f"""WITH {SHEETS_SQL}, {_SCOPES}, {_DRIFT} SELECT method, {_BASIS.replace('distribution', 'method')} AS basis,
  COUNT(*) AS depts, ROUND(SUM(stored), 9) AS sum_stored, ROUND(MAX(drift), 9) AS max_drift, MAX(drift) <= 1e-6 AS in_sync FROM d GROUP BY 1""")
def basis_drift(spark, sf):
    return D.basis_drift(_fresh(spark, sf), full_roster(spark, sf)).withColumn("max_drift", F.round("max_drift", 9))


@query("basis_max_drift", f"""WITH {SHEETS_SQL}, {_SCOPES}, {_DRIFT}
SELECT ROUND(MAX(drift), 9) AS max_drift, COUNT(*) FILTER (drift > 1e-6) AS breaches FROM d""")
def basis_max_drift(spark, sf):
    return D.basis_max_drift(_fresh(spark, sf), full_roster(spark, sf)).withColumn("max_drift", F.round("max_drift", 9))


@query("basis_map_summary", f"""WITH {SHEETS_SQL} SELECT {_BASIS} AS basis, distribution, COUNT(*) AS n, ROUND(SUM(percentage), 6) AS total
FROM alloc GROUP BY 1, 2""")
def basis_map_summary(spark, sf):
    from saldoflow.sources import sheets as SH
    alloc = SH.basis_stored_form(sheets(spark, sf)["ALLOCATION"].withColumn("basis", F.lit(None).cast("string")), "ALLOCATION")
    march, april = (alloc.withColumn("period", F.lit(p).cast("date")) for p in ("1997-03-01", "1997-04-01"))
    return D.basis_map_summary(march.unionByName(april), "1997-03-01")


# --- period lock ------------------------------------------------------------

_LOCKS = """locks AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS period, 'closed' AS status FROM orders
  WHERE year(o_orderdate) = 1997)"""


def _locks(spark, sf):
    return (I.table(spark, sf, "orders").filter("year(o_orderdate) = 1997")
            .select(F.trunc("o_orderdate", "month").alias("period")).distinct()
            .selectExpr("period", "'closed' AS status", "CAST(NULL AS TIMESTAMP_NTZ) AS closed_at", "CAST(NULL AS STRING) AS note"))


@query("period_lock", f"""WITH {_LOCKS} SELECT period, status, CASE WHEN period = DATE '1997-03-01' THEN 'again' END AS note FROM locks
WHERE period <> DATE '1997-05-01' UNION ALL SELECT DATE '1999-01-01', 'closed', 'new'""")
def period_lock(spark, sf):
    """One month closed again, one closed anew, one reopened."""
    locks = D.period_close(_locks(spark, sf), "1997-03-01", "2026-01-01 00:00:00", "again")
    locks = D.period_close(locks, "1999-01-01", "2026-01-01 00:00:00", "new")
    return D.period_reopen(locks, "1997-05-01")[0].select("period", "status", "note")


@query("period_guard", f"""WITH {_LOCKS}, {ALL_SQL} SELECT period FROM locks WHERE period IN (SELECT date_trunc('month', date) FROM gl)""")
def period_guard(spark, sf):
    written = ledger(spark, sf).select(F.trunc("date", "month").alias("period"))
    return D.period_guard(_locks(spark, sf), written).select("period")
