"""Queries: column functions over texts and figures of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldoflow.catalog import inputs as I, query
from saldoflow.functions import scalars as S, text as X

# Texts that cover the cases of each function, by order key.
_ORDERS_SQL = """
t AS (SELECT o_orderkey AS k, o_totalprice, CAST(o_orderdate AS DATE) AS d, o_orderstatus AS st,
  CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) WHEN 1 THEN ''
    WHEN 2 THEN 'abc' || o_orderkey WHEN 3 THEN ' 12 ' WHEN 4 THEN NULL ELSE '1e3' END AS num,
  CASE o_orderkey % 5 WHEN 0 THEN '4' WHEN 1 THEN '2' WHEN 2 THEN '11' WHEN 3 THEN 'X' ELSE NULL END
    || CASE o_orderkey % 2 WHEN 0 THEN '12-11-000' ELSE '01-0A0' END AS code
FROM orders)"""


def _orders(spark, sf):
    o = I.table(spark, sf, "orders")
    return o.selectExpr(
        "o_orderkey AS k", "o_totalprice", "CAST(o_orderdate AS DATE) AS d", "o_orderstatus AS st",
        """CASE o_orderkey % 6 WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)
           WHEN 1 THEN '' WHEN 2 THEN concat('abc', o_orderkey) WHEN 3 THEN ' 12 ' WHEN 4 THEN NULL
           ELSE '1e3' END AS num""",
        """concat(CASE o_orderkey % 5 WHEN 0 THEN '4' WHEN 1 THEN '2' WHEN 2 THEN '11' WHEN 3 THEN 'X'
           ELSE NULL END, CASE o_orderkey % 2 WHEN 0 THEN '12-11-000' ELSE '01-0A0' END) AS code""")


def _on_orders(name, columns, sql):
    """A query of expressions over order texts; ``sql`` is the same select list.

    An expression is a text, or a function that makes the column: without a
    session no column can be made.
    """
    @query(name, f"WITH {_ORDERS_SQL} SELECT k, {sql} FROM t")
    def run(spark, sf):
        made = {n: F.expr(c) if isinstance(c, str) else c() for n, c in columns.items()}
        return _orders(spark, sf).select("k", *[c.alias(n) for n, c in made.items()])


_on_orders("decimal_lenient", {"value": f"CAST({X.decimal_lenient('num')} AS DECIMAL(18,2))"},
           """CAST(CASE k % 6 WHEN 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) WHEN 3 THEN 12
              WHEN 5 THEN 1000 ELSE 0 END AS DECIMAL(18,2)) AS value""")
_on_orders("first_nonzero", {"value": "CAST(" + X.first_nonzero(
    "IF(k % 3 = 0, CAST(0 AS DECIMAL(30,9)), IF(k % 3 = 1, NULL, CAST(7 AS DECIMAL(30,9))))",
    "CAST(k % 2 AS DECIMAL(30,9))") + " AS DECIMAL(18,2))"},
    "CAST(CASE WHEN k % 3 = 2 THEN 7 ELSE k % 2 END AS DECIMAL(18,2)) AS value")
_on_orders("signed_amount", {"value": "CAST(" + X.signed_amount(
    "code", "CAST(o_totalprice AS DECIMAL(18,2))", "CAST(5 AS DECIMAL(18,2))") + " AS DECIMAL(20,2))"},
    """CAST(CASE WHEN substr(code, 1, 1) IN ('2', '3', '4', '8')
       THEN 5 - CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) - 5 END
       AS DECIMAL(20,2)) AS value""")
_TAX_CODE = "CASE k % 7 WHEN 0 THEN 'PPN 11%' WHEN 1 THEN 'PPN' WHEN 2 THEN 'PPh 23-2' " \
            "WHEN 3 THEN 'PPN  1.2%' WHEN 4 THEN '' WHEN 5 THEN 'PPN 1.2%' END"
_TAX_NAME = "CASE k % 4 WHEN 0 THEN 'PPN 2 1,1%' WHEN 1 THEN 'Other' WHEN 2 THEN '' END"
_TAX = {s: X.tax_account(f"({_TAX_CODE})", f"({_TAX_NAME})", s) for s in ("sales", "purchase")}
_HIT = "k % 7 IN (0, 1, 3) OR (k % 7 <> 2 AND k % 4 = 0)"
_MISS = f"COALESCE(NULLIF({_TAX_NAME}, ''), NULLIF({_TAX_CODE}, ''))"
_on_orders("tax_account_resolve", {
    "sales_code": _TAX["sales"][0], "sales_name": _TAX["sales"][1],
    "purchase_code": _TAX["purchase"][0], "purchase_name": _TAX["purchase"][1]},
    f"""CASE WHEN {_HIT} THEN '212411' WHEN k % 7 = 2 THEN '114411' END AS sales_code,
    CASE WHEN {_HIT} THEN 'Sales VAT' WHEN k % 7 = 2 THEN 'Pre TA 23 (Cust./Client)'
      ELSE {_MISS} END AS sales_name,
    CASE WHEN {_HIT} THEN '212412' WHEN k % 7 = 2 THEN '212423' END AS purchase_code,
    CASE WHEN {_HIT} THEN 'Purchase VAT' WHEN k % 7 = 2 THEN 'W/H TA 23 (Supplier/Vendor)'
      ELSE {_MISS} END AS purchase_name""")
_SIDES = {s: X.discount_account(s) for s in ("sales", "purchase")}
_on_orders("discount_account_resolve", {
    "account_code": f"IF(k % 2 = 0, {_SIDES['sales'][0]}, {_SIDES['purchase'][0]})",
    "coa_name": f"IF(k % 2 = 0, {_SIDES['sales'][1]}, {_SIDES['purchase'][1]})"},
    """CASE WHEN k % 2 = 0 THEN '114411' ELSE '212423' END AS account_code,
    CASE WHEN k % 2 = 0 THEN 'Pre TA 23 (Cust./Client)' ELSE 'W/H TA 23 (Supplier/Vendor)' END AS coa_name""")
_CUR = "CASE k % 4 WHEN 0 THEN 'idr' WHEN 1 THEN '' WHEN 2 THEN 'USD' END"
_XR = "CASE k % 5 WHEN 0 THEN '1' WHEN 1 THEN '0' WHEN 2 THEN '15000.5' WHEN 3 THEN 'x' END"
_on_orders("fx_settlement_flag", {"fx": X.fx_settlement(f"({_CUR})", f"({_XR})")},
           "(k % 4 = 2 OR k % 5 = 2) AS fx")
_FX = X.forex_account("k % 2 = 0")
_on_orders("forex_account_pick", {"account_code": _FX[0], "coa_name": _FX[1]},
           """CASE WHEN k % 2 = 0 THEN '9104' ELSE '8104' END AS account_code,
           CASE WHEN k % 2 = 0 THEN 'Realize Forex Loss' ELSE 'Realize Forex Gain' END AS coa_name""")
_on_orders("original_currency_amount", {"value": lambda: S.original_currency_amount(
    F.expr("CAST(k AS DECIMAL(18,3)) + CAST(0.125 AS DECIMAL(4,3))"),
    F.expr("CASE k % 3 WHEN 0 THEN CAST(0 AS DECIMAL(20,8)) WHEN 1 THEN CAST(1 AS DECIMAL(20,8)) "
           "ELSE CAST(0.5 AS DECIMAL(20,8)) END"))},
    "CAST(CASE WHEN k % 3 = 2 THEN k * 2 + 0.25 ELSE k + 0.12 END AS DECIMAL(18,2)) AS value")
_on_orders("account_code_normalise", {
    "python_form": lambda: S.account_code_normalise(F.col("code")), "sql_form": lambda: S.account_key(F.col("code"))},
    """NULLIF(rtrim(regexp_replace(code, '[^0-9]', '', 'g'), '0'), '') AS python_form,
    rtrim(replace(code, '-', ''), '0') AS sql_form""")
_on_orders("name_key_normalise", {"name_key": lambda: S.name_key(
    F.expr("concat('  Head \\t QUARTER ', st, '  ', k, ' ')"))},
    "'head quarter ' || lower(st) || ' ' || k AS name_key")
_MON = "CASE month(d) " + " ".join(
    f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(
        ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"])) + " END"
_on_orders("period_label", {"period": lambda: S.period_label(F.expr("IF(k % 11 = 0, NULL, d)"))},
           f"CASE WHEN k % 11 <> 0 THEN {_MON} || '-' || year(d) END AS period")
_PERIOD_TEXT = """CASE k % 4 WHEN 0 THEN date_format(d, 'MMM-yyyy') WHEN 1 THEN date_format(d, 'yyyy-MM')
    WHEN 2 THEN concat(' ', lower(date_format(d, 'MMM-yyyy')), ' ') ELSE '2026-13' END"""
_on_orders("period_date", {"period": lambda: S.period_date(F.expr(_PERIOD_TEXT))},
           "CASE WHEN k % 4 <> 3 THEN CAST(date_trunc('month', d) AS DATE) END AS period")
_on_orders("period_normalise", {"period": lambda: S.period_normalise(F.expr(_PERIOD_TEXT))},
           f"CASE WHEN k % 4 <> 3 THEN {_MON} || '-' || year(d) END AS period")
_PREV = _MON.replace("month(d)", "month(d - INTERVAL 1 MONTH)")
_on_orders("period_previous", {"period": lambda: S.period_previous(F.expr(_PERIOD_TEXT))},
           f"CASE WHEN k % 4 <> 3 THEN {_PREV} || '-' || year(date_trunc('month', d) - INTERVAL 1 MONTH) END AS period")
_ID = "CASE month(d) " + " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(
    ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus", "September",
     "Oktober", "November", "Desember"])) + " END"
_on_orders("period_month_name_id", {"month_name": lambda: S.period_month_name_id(F.expr(_PERIOD_TEXT))},
           f"CASE WHEN k % 4 <> 3 THEN {_ID} END AS month_name")
_on_orders("receivable_account", {"account": lambda: S.receivable_account(F.expr(
    "CASE k % 4 WHEN 0 THEN ' idr ' WHEN 1 THEN 'USD' WHEN 2 THEN NULL ELSE '' END"))},
    "CASE WHEN k % 4 = 1 THEN '1121-12-000' ELSE '1121-11-000' END AS account")
_on_orders("credit_balance_flag", {"credit_balance": lambda: S.credit_balance(F.col("code"))},
           "COALESCE(code LIKE '4%', false) AS credit_balance")
_METHOD = ("CASE k % 6 WHEN 0 THEN 'FTE - All' WHEN 1 THEN ' Revenue HO' WHEN 2 THEN 'Lab Distribution' "
           "WHEN 3 THEN 'Head Office : Tower B' WHEN 4 THEN 'Revenue' END")
_on_orders("basis_label", {"basis": lambda: S.basis_label(F.expr(_METHOD))},
           "CASE WHEN k % 6 IN (0, 3) THEN 'basis_fte' WHEN k % 6 IN (1, 4) THEN 'basis_rev' ELSE 'Fixed' END AS basis")
_on_orders("activity_type", {
    "action": lambda: S.activity_action(F.expr("CASE k % 6 WHEN 0 THEN 'post' WHEN 1 THEN 'PUT' WHEN 2 THEN 'patch' "
                                       "WHEN 3 THEN 'DELETE' WHEN 4 THEN 'HEAD' END")),
    "activity_type": lambda: S.activity_type(F.expr("CASE k % 6 WHEN 0 THEN 'post' WHEN 1 THEN 'PUT' "
                                            "WHEN 2 THEN 'patch' WHEN 3 THEN 'DELETE' WHEN 4 THEN 'HEAD' END"))},
    """CASE k % 6 WHEN 1 THEN 'PUT' WHEN 2 THEN 'PATCH' WHEN 3 THEN 'DELETE' WHEN 4 THEN 'HEAD' ELSE 'POST' END AS action,
    CASE k % 6 WHEN 0 THEN 'create' WHEN 5 THEN 'create' WHEN 3 THEN 'delete' ELSE 'update' END AS activity_type""")
_DEPT = ("CASE k % 4 WHEN 0 THEN ' CERTIFICATION SERVICES ' WHEN 1 THEN "
         "'Automotive (System Certification Services Technical Ops)' WHEN 2 THEN 'Automotive' END")
_on_orders("alias_replace", {"dept": lambda: S.alias(F.expr(_DEPT), {
    "Automotive (System Certification Services Technical Ops)": "Automotive",
    "CERTIFICATION SERVICES": "System Certification Services"})},
    "CASE k % 4 WHEN 0 THEN 'System Certification Services' WHEN 1 THEN 'Automotive' WHEN 2 THEN 'Automotive' END AS dept")
_on_orders("endpoint_to_module", {"module": lambda: S.endpoint_to_module(F.expr(
    "CASE k % 5 WHEN 0 THEN 'purchases_invoices' WHEN 1 THEN 'purchase_invoices' WHEN 2 THEN 'cash_ins' "
    "WHEN 3 THEN 'manual_journals' END"))},
    "CASE k % 5 WHEN 0 THEN 'purchase_invoice' WHEN 2 THEN 'cash_in' WHEN 3 THEN 'manual_journal' END AS module")
_on_orders("to_wib", {"wib": lambda: S.to_wib(F.expr(
    """CASE k % 6 WHEN 0 THEN concat(d, 'T03:26:40+00:00') WHEN 1 THEN concat(d, ' 20:00:00')
       WHEN 2 THEN concat(d, 'T03:00:00+07:00') WHEN 3 THEN '' WHEN 4 THEN '2026'
       ELSE CAST(d AS STRING) END"""))},
    """CASE k % 6 WHEN 0 THEN CAST(d AS TIMESTAMP) + INTERVAL '10 hours 26 minutes 40 seconds'
      WHEN 1 THEN CAST(d AS TIMESTAMP) + INTERVAL '27 hours' WHEN 2 THEN CAST(d AS TIMESTAMP) + INTERVAL '3 hours'
      WHEN 5 THEN CAST(d AS TIMESTAMP) + INTERVAL '7 hours' END AS wib""")
_on_orders("party_name_coalesce", {"party": X.first_nonblank(
    "IF(k % 3 = 0, '', IF(k % 3 = 1, NULL, 'v'))", "IF(k % 2 = 0, '', 's')", "IF(k % 5 = 0, NULL, 'c')")},
    "CASE WHEN k % 3 = 2 THEN 'v' WHEN k % 2 = 1 THEN 's' WHEN k % 5 <> 0 THEN 'c' END AS party")
_NET, _PAYABLE = "CAST(IF(k % 3 = 0, 0, 100) AS DECIMAL(30,9))", "CAST(IF(k % 4 = 0, 0, 120) AS DECIMAL(30,9))"
_PAYMENT, _OFF = "CAST(CASE k % 5 WHEN 0 THEN 120 WHEN 1 THEN 2 ELSE 0 END AS DECIMAL(30,9))", "CAST(k % 2 AS DECIMAL(30,9))"
_WHT = ("(CASE WHEN k % 3 = 0 THEN 0 WHEN k % 5 = 0 THEN CASE WHEN k % 4 = 0 THEN 120 ELSE 0 END "
        "WHEN k % 5 = 1 THEN 2 ELSE 0 END)")
_on_orders("settlement_split", {
    "settled": f"CAST({X.settled_amount(_NET, _OFF, _PAYABLE, _PAYMENT)} AS DECIMAL(18,2))",
    "withheld": f"CAST({X.withheld_amount(_NET, _PAYABLE, _PAYMENT)} AS DECIMAL(18,2))"},
    f"""CAST(CASE WHEN k % 3 = 0 THEN CASE WHEN k % 4 <> 0 THEN 120 WHEN k % 5 = 0 THEN 120 WHEN k % 5 = 1 THEN 2
      ELSE 0 END ELSE 100 + k % 2 + {_WHT} END AS DECIMAL(18,2)) AS settled,
    CAST({_WHT} AS DECIMAL(18,2)) AS withheld""")


@query("nested_get_default", """
SELECT event_id, COALESCE(CAST(json_extract_string(props, '$.k') AS VARCHAR), 'none') AS k,
  'none' AS absent, COALESCE(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) % 2 AS parity FROM events""")
def nested_get_default(spark, sf):
    e = S.once(I.table(spark, sf, "events"), v=F.try_parse_json("props"))
    return e.select("event_id", F.expr(X.nested_get_default("v", "$.k", "'none'")).alias("k"),
                    F.expr(X.nested_get_default("v", "$.a.b", "'none'")).alias("absent"),
                    (F.expr(X.nested_get_default("v", "$.k", "'0'")).cast("int") % 2).alias("parity"))


@query("purchase_reference_pick", """
SELECT l_orderkey AS k, l_linenumber AS n, 'SI/' || l_orderkey || '-' || l_linenumber AS number,
  CAST(MIN(o_orderdate) AS DATE) AS date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def purchase_reference_pick(spark, sf):
    from saldoflow.catalog.journal_queries import transformed
    docs = transformed(spark, sf, "payable_payment")
    claims = docs.select(F.inline("claims"))
    key = F.split(F.regexp_replace("ref_id", "^SI-", ""), "-")
    return claims.select(key[0].cast("bigint").alias("k"), key[1].cast("int").alias("n"),
                         F.col("ref_no").alias("number"), F.col("ref_date").cast("date").alias("date"))
