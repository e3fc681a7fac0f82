"""The same journals in SQL over the base tables, without any JSON."""

BASE = """
ol AS (
  SELECT l_orderkey AS k, l_linenumber AS n,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS gross,
    SUM(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)) AS net,
    SUM(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)) AS tax,
    MIN(l_suppkey) AS supp
  FROM lineitem GROUP BY 1, 2),
ot AS (
  SELECT k, SUM(net) AS nsum, SUM(CASE WHEN n = 6 THEN -tax ELSE tax END) AS tsum,
    SUM(CASE WHEN n = 7 THEN gross ELSE net END) AS paid,
    SUM(CASE WHEN n = 6 THEN 0 ELSE net END) AS funded, MIN(supp) AS supp
  FROM ol GROUP BY k),
od AS (
  SELECT o_orderkey AS k, o_orderstatus AS st, CAST(o_orderdate AS DATE) AS d, c_name AS cname,
    n_nationkey AS nk, n_name AS nname, o_orderpriority AS prio, nsum, tsum, paid, funded, supp,
    CAST(CASE o_orderkey % 4 WHEN 1 THEN 0 WHEN 3 THEN 1.5 ELSE 1 END AS DECIMAL(4,2)) AS r,
    CASE WHEN n_nationkey % 5 = 0 THEN 'USD' ELSE 'IDR' END AS cur
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN ot ON ot.k = o_orderkey),
l AS (
  SELECT ol.*, od.r, od.cur, od.d, od.nk, CASE WHEN n = 6 THEN -tax ELSE tax END AS stax,
    CASE WHEN n % 2 = 0 THEN 'D' || n WHEN n = 5 THEN NULL ELSE 'N' || nk END AS dc,
    CASE WHEN n % 2 = 0 THEN 'Dept ' || n WHEN n = 5 THEN 'Named only' ELSE nname END AS dn
  FROM ol JOIN od USING (k)),
h AS (SELECT od.*, 'N' || nk AS dc, nname AS dn FROM od)
"""

_COLUMNS = ["k", "note", "debit", "credit", "account_code", "coa_name", "source_line_id", "dc", "dn",
            "currency", "rate", "ref_no2", "ref_date2", "ref_id2", "sign_code"]
_NOTE = "CASE WHEN n % 3 = 0 THEN '{}' ELSE 'Line ' || n END"
_TAX_NOTE = ("CASE WHEN n <= 4 THEN 'Pajak 11' WHEN n = 5 THEN 'PPN 2 1,1%' WHEN n = 6 THEN 'PPh' "
             "ELSE 'ZZ' END")
_TAX_ID = "CASE WHEN n <= 4 THEN 'T1' WHEN n = 5 THEN 'T2' WHEN n = 6 THEN 'T3' ELSE 'T4' END"
_SIDE = {
    "sales": ("CASE WHEN n <= 5 THEN '212411' WHEN n = 6 THEN '114411' END",
              "CASE WHEN n <= 5 THEN 'Sales VAT' WHEN n = 6 THEN 'Pre TA 23 (Cust./Client)' ELSE 'ZZ' END",
              "'114411'", "'Pre TA 23 (Cust./Client)'"),
    "purchase": ("CASE WHEN n <= 5 THEN '212412' WHEN n = 6 THEN '212423' END",
                 "CASE WHEN n <= 5 THEN 'Purchase VAT' WHEN n = 6 THEN 'W/H TA 23 (Supplier/Vendor)' ELSE 'ZZ' END",
                 "'212423'", "'W/H TA 23 (Supplier/Vendor)'"),
}


def _row(source, note, value, on_debit, code, name, line_id, where="TRUE", cur="cur", rate="r",
         ref=("NULL", "NULL", "NULL"), sign=None):
    d, c = (value, "0") if on_debit else ("0", value)
    v = [note, f"CAST({d} AS DECIMAL(24,4))", f"CAST({c} AS DECIMAL(24,4))", code, name, line_id,
         "dc", "dn", cur, f"CAST({rate} AS DECIMAL(18,6))", ref[0], f"CAST({ref[1]} AS DATE)", ref[2],
         sign or code]
    cols = ", ".join(f"{x} AS {n}" for x, n in zip(v, _COLUMNS[1:]))
    return f"SELECT k, {cols} FROM {source} WHERE {where}"


def _trade(side, on_debit, group, label, note, times="", gross_id="'L' || n", ref=("NULL",) * 3):
    tax_code, tax_name, off_code, off_name = _SIDE[side]
    return [
        _row("l", _NOTE.format(note), "gross" + times, on_debit, f"'{group}' || n || '00'",
             f"'{label} ' || n", gross_id, ref=ref),
        _row("l", "'Discount'", f"(gross - net){times}", not on_debit, off_code, off_name,
             "'L' || n || '_disc'", ref=ref),
        _row("l", _TAX_NOTE, "stax" + times, on_debit, tax_code, tax_name,
             f"'L' || n || '_' || {_TAX_ID} || '_tax'", ref=ref)]


_MEMO = ("'SI/' || k", "d", "'SI-' || k")
_LINE_REF = ("'SI/' || k || '-' || n", "d", "'SI-' || k || '-' || n")
# Rows of a payment that belong to no line carry the first line's reference.
_FIRST = ("'SI/' || k || '-' || (SELECT MIN(n) FROM ol x WHERE x.k = h.k)", "d",
          "'SI-' || k || '-' || (SELECT MIN(n) FROM ol x WHERE x.k = h.k)")


def _settlement(money_in):
    gap = "(k % 6)"
    side = "sales" if money_in else "purchase"
    _, _, off_code, off_name = _SIDE[side]
    fx = "nk % 5 = 0"
    claim_code = "'112111'" if money_in else "CASE WHEN n % 2 = 0 THEN '211211' ELSE '211311' END"
    claim_name = "'Accounts Receivable'" if money_in else \
        "CASE WHEN n % 2 = 0 THEN 'Trade Payables' ELSE 'Accounts Payable' END"
    settled = ("CASE WHEN n = 7 THEN gross ELSE net + CASE WHEN n = 2 THEN 3 WHEN n = 3 THEN 1.5 "
               "ELSE 0 END END")
    moved = "CASE k % 8 WHEN 0 THEN -2 WHEN 4 THEN 4 ELSE 0 END"
    # A balancing row that is a debit is a loss; money in lacks debits here.
    fx_code, fx_name = ("'9104'", "'Realize Forex Loss'") if money_in else ("'8104'", "'Realize Forex Gain'")
    other_note = "Other Charge" if money_in else "Other Adjustment"
    other_gain = "Other Adjustment" if money_in else "Other Charge"
    return [
        _row("h", "'Cash Receipt'" if money_in else "'Cash Payment'", f"paid + {moved} - {gap}", money_in,
             "CASE WHEN k % 7 <> 0 THEN '111211' ELSE '111999' END",
             "CASE WHEN k % 7 <> 0 THEN 'Bank' ELSE 'Cash/Bank Clearing' END",
             "CASE WHEN k % 7 <> 0 THEN 'C1' ELSE 'cash' END", ref=_FIRST,
             sign="CASE WHEN k % 7 <> 0 THEN '111211' END"),
        _row("h", f"CASE WHEN {fx} THEN {fx_name} ELSE '{other_note}' END", "2", money_in,
             f"CASE WHEN {fx} THEN {fx_code} ELSE '6924' END",
             f"CASE WHEN {fx} THEN {fx_name} ELSE 'Bank Administrative' END", "'O1'",
             "k % 8 = 0", ref=_FIRST),
        _row("h", f"'{other_gain}'", "4", not money_in, "'6101'", "'Freight'", "'O1'", "k % 8 = 4",
             ref=_FIRST),
        _row("l", "'Sales Discount'" if money_in else "'Purchase Discount'", "1.5", money_in, off_code,
             off_name, "'L' || n || '_discount'", "n = 3", ref=_LINE_REF),
        _row("l", "'Accounts Receivable (Payment)'" if money_in else "'Accounts Payable (Payment)'",
             settled, not money_in, claim_code, claim_name, "'L' || n", ref=_LINE_REF),
        _row("l", "'Withholding Tax (PPh 23)'", "3", money_in, off_code, off_name,
             "'L' || n || '_wht'", "n = 2", ref=_LINE_REF),
        _row("h", f"CASE WHEN {fx} THEN {fx_name} ELSE 'Bank Administrative' END", gap, money_in,
             f"CASE WHEN {fx} THEN {fx_code} ELSE '6924' END",
             f"CASE WHEN {fx} THEN {fx_name} ELSE 'Bank Administrative' END",
             f"CASE WHEN {fx} THEN 'forex_diff' ELSE 'bank_charge' END", ref=_FIRST)]


def _cash(money_in):
    return [
        _row("h", "NULL", "funded", money_in, "CASE WHEN k % 7 <> 0 THEN '111211' ELSE '111999' END",
             "CASE WHEN k % 7 <> 0 THEN 'Bank' ELSE 'Cash/Bank Clearing' END",
             "CASE WHEN k % 7 <> 0 THEN 'C1' ELSE 'cash' END", rate="1",
             sign="CASE WHEN k % 7 <> 0 THEN '111211' END"),
        _row("l", "CASE WHEN n % 3 <> 0 THEN 'Note ' || n END", "CASE WHEN n = 6 THEN 0 ELSE net END",
             not money_in, "'61' || n || '00'", "'Fund ' || n", "'L' || n", cur="'IDR'", rate="1")]


ROWS = {
    "sales_invoice": [_row("h", "'Accounts Receivable'", "nsum + tsum", True, "'112111'",
                           "'Accounts Receivable'", "'P1'")]
    + _trade("sales", False, "41", "Revenue", "Revenue"),
    "sales_return": _trade("sales", True, "41", "Revenue", "Sales Return", " * r", "'L' || n || '_rev'", _MEMO)
    + [_row("h", "'Accounts Receivable Reversal'", "(nsum + tsum) * r", False, "'112111'",
            "'Accounts Receivable'", "'P1_ar'", ref=_MEMO)],
    "purchase_invoice": _trade("purchase", True, "51", "Purchase", "Purchase", " * r")
    + [_row("h", "'Freight'", "12.5", True, "'6101'", "'Freight'", "'O1_other'"),
       _row("h", "'Accounts Payable'", "(nsum + tsum) * r + 12.5", False, "'211211'",
            "'Accounts Payable'", "'P1'")],
    "purchase_return": [_row("h", "'Accounts Payable Reversal'", "nsum + tsum", True, "'211211'",
                             "'Accounts Payable'", "'P1'", ref=_MEMO)]
    + _trade("purchase", False, "51", "Purchase", "Purchase Return", ref=_MEMO),
    "receivable_payment": _settlement(True),
    "payable_payment": _settlement(False),
    "cash_in": _cash(True),
    "cash_out": _cash(False),
    "manual_journal": [
        _row("l", "CASE WHEN n = 5 THEN 'Manual Journal' ELSE 'Expense ' || n END", "net", True,
             "'71' || n || '00'", "CASE WHEN n <> 5 THEN 'Expense ' || n END", "'L' || n", cur="'IDR'",
             rate="1"),
        _row("h", "'Accruals'", "nsum + CASE WHEN k % 23 = 0 THEN 0.5 ELSE 0 END", False, "'211000'",
             "'Accruals'", "'LB'", cur="'IDR'", rate="1")],
}
VALID = {
    "sales_invoice": "k % 29 <> 0 AND k % 17 <> 0",
    "sales_return": "k % 29 <> 0",
    "purchase_invoice": "k % 29 <> 0",
    "purchase_return": "k % 29 <> 0",
    "receivable_payment": "k % 29 <> 0 AND k % 31 <> 0",
    "payable_payment": "k % 29 <> 0 AND k % 31 <> 0",
    "cash_in": "TRUE", "cash_out": "TRUE",
    "manual_journal": "k % 37 <> 0",
}
CONTACT = {
    "sales_invoice": "cname", "sales_return": "cname", "receivable_payment": "cname",
    "purchase_invoice": "'Supplier ' || supp", "purchase_return": "'Supplier ' || supp",
    "payable_payment": "'Supplier ' || supp", "manual_journal": "NULL",
    "cash_in": "CASE WHEN k % 29 <> 0 THEN cname END",
    "cash_out": "CASE WHEN k % 29 <> 0 THEN cname END",
}


def ctes(module: str, name: str = "j") -> str:
    """CTEs ending in ``name``: the journal rows of one kind, all columns."""
    from saldoflow.catalog.inputs import PREFIX
    from saldoflow.constants import DOCUMENT_TYPES

    rows = "\n UNION ALL ".join(ROWS[module])
    p = PREFIX[module]
    return f"""{BASE},
{name}_rows AS ({rows}),
{name} AS (
  SELECT k, '{p}-' || k AS source_id, source_line_id, d AS date, '{DOCUMENT_TYPES[module]}' AS type,
    '{p}/' || k AS ref_no, CAST({CONTACT[module]} AS VARCHAR) AS contact, 'Order ' || k AS description,
    CAST(note AS VARCHAR) AS note, x.dc AS dept_code, x.dn AS department, prio AS project,
    CAST(debit AS DECIMAL(18,4)) AS debit, CAST(credit AS DECIMAL(18,4)) AS credit,
    CAST(CASE WHEN substr(sign_code, 1, 1) IN ('2', '3', '4', '8') THEN credit - debit
         ELSE debit - credit END AS DECIMAL(18,4)) AS amount,
    account_code, coa_name, currency, rate AS exchange_rate,
    CASE WHEN st = 'P' THEN 'draft' ELSE 'approved' END AS status,
    CAST(d AS TIMESTAMP) + INTERVAL '12 hours 6 minutes 7 seconds' AS created_at,
    'clerk-' || (k % 10) AS created_by, CAST(ref_no2 AS VARCHAR) AS doc_ref_no,
    ref_date2 AS doc_ref_date, CAST(ref_id2 AS VARCHAR) AS doc_ref_id
  FROM {name}_rows x JOIN h USING (k) WHERE (debit <> 0 OR credit <> 0) AND {VALID[module]})"""


JOURNAL_SELECT = """SELECT source_id, source_line_id, date, type, ref_no, contact, description, note,
  dept_code, department, project, debit, credit, amount, account_code, coa_name, currency,
  CAST(CASE WHEN exchange_rate = 0 THEN ROUND(amount, 2)
       ELSE ROUND(CAST(amount AS DOUBLE) / CAST(exchange_rate AS DOUBLE), 2) END AS DECIMAL(18,2)) AS original_currency,
  exchange_rate, status, created_at, created_by, doc_ref_no, doc_ref_date, doc_ref_id FROM j"""


def journal(module: str) -> str:
    return f"WITH {ctes(module)}\n{JOURNAL_SELECT}"
