"""Journal rows of the nine document kinds, as array expressions.

Every kind is a list of array expressions over a document's typed parts (see
``operators.documents``). Rows keep both sides; those without a value are
dropped when rows leave the document.
"""

from __future__ import annotations

from saldoflow import constants as K
from saldoflow.functions import text as X

PAYMENT_KINDS = ("receivable_payment", "payable_payment")
ROW_FIELDS = ("note STRING, debit {m}, credit {m}, account_code STRING, sign_code STRING, "
              "coa_name STRING, source_line_id STRING, dept_code STRING, department STRING, "
              "project STRING, currency STRING, exchange_rate {r}, doc_ref_no STRING, "
              "doc_ref_date STRING, doc_ref_id STRING").format(m=X.MONEY, r=X.RATE)
ROW_TYPE = "ARRAY<STRUCT<" + ROW_FIELDS.replace(" STRING", ": STRING").replace(
    f" {X.MONEY}", f": {X.MONEY}").replace(f" {X.RATE}", f": {X.RATE}") + ">>"


# --- typed parts -----------------------------------------------------------

def money_items(items: str) -> str:
    """Payments or other charges with exact amounts and resolved rates."""
    return f"transform({items}, p -> " + X.struct(
        id="p.id", amount=X.decimal_lenient("p.amount"),
        currency="coalesce(nullif(p.currency.code, ''), base_currency)",
        rate=X.rate_or("p.exchange_rate", "base_rate"), code="p.account.code",
        name="p.account.name") + ")"


def cash() -> str:
    c = "data.cash"
    return X.struct(
        amount=X.decimal_lenient(f"{c}.amount"),
        currency=f"coalesce(nullif({c}.currency.code, ''), base_currency)",
        rate=X.rate_or(f"{c}.exchange_rate", "base_rate"), account_id=f"{c}.account.id",
        code=f"{c}.account.code", name=f"{c}.account.name",
        fx=X.fx_settlement(f"{c}.currency.code", X.variant_text(f"{c}.exchange_rate")))


def _place() -> dict:
    """Department and project of a line; one it does not name is the document's.

    All or nothing: a line that names a department without a code has no code.
    """
    def part(key, field):
        return (f"IF({X.object_given(f'x.{key}')}, {X.variant_text(f'x.{key}', f'$.{field}')}, "
                f"data.{key}.{field})")
    return {"dept_code": part("department", "code"), "department": part("department", "name"),
            "project": part("project", "name"),
            "currency": "coalesce(nullif(x.currency.code, ''), base_currency)",
            "rate": X.rate_or("x.exchange_rate", "base_rate")}


def lines() -> str:
    """Lines of trade, cash and manual documents."""
    return "transform(data.line_items, x -> " + X.struct(
        id="x.id", description="x.description", note="x.note",
        amount=X.decimal_lenient("x.amount"), debit=X.decimal_lenient("x.debit"),
        credit=X.decimal_lenient("x.credit"),
        before=X.decimal_lenient("x.subtotal_before_discount"),
        after=X.decimal_lenient("coalesce(x.subtotal_after_discount, x.subtotal_before_discount)"),
        code="x.account.code", name="x.account.name", taxes="x.taxes", **_place()) + ")"


def _purchase_reference() -> str:
    """The purchase a payment line settles: the first kind of reference given."""
    kinds = [f"x.{k}" for k in ("invoice", "purchase_invoice", "purchase", "bill")]
    given = [f"IF(coalesce({r}.id, {r}.number, {r}.date, {r}.account.code, {r}.account.name) "
             f"IS NULL, NULL, {r})" for r in kinds]
    return f"coalesce({', '.join(given)})"


def claims() -> str:
    """Lines of payment documents, with settled and withheld amounts."""
    raw = "transform(data.line_items, x -> " + X.struct(
        id="x.id", net=X.decimal_lenient("x.amount"), discount=X.decimal_lenient("x.discount.amount"),
        payable=X.decimal_lenient("x.payable.amount"),
        payment=X.decimal_lenient("x.payment.amount"),
        ref=f"IF(module = 'receivable_payment', x.invoice, {_purchase_reference()})",
        own=("IF(module = 'payable_payment' AND coalesce(x.payable.account.id, "
             "x.payable.account.code, x.payable.account.name) IS NOT NULL, "
             "x.payable.account, NULL)"), **_place()) + ")"
    return f"transform({raw}, x -> " + X.struct(
        id="x.id", discount="x.discount",
        settled=X.settled_amount("x.net", "x.discount", "x.payable", "x.payment"),
        withheld=X.withheld_amount("x.net", "x.payable", "x.payment"),
        ref_no="x.ref.number", ref_date="x.ref.date", ref_id="x.ref.id",
        code="IF(x.own IS NULL, x.ref.account.code, x.own.code)",
        name="IF(x.own IS NULL, x.ref.account.name, x.own.name)",
        dept_code="x.dept_code", department="x.department", project="x.project",
        currency="x.currency", rate="x.rate") + ")"


# --- rows ------------------------------------------------------------------

_DOCUMENT_PLACE = ("data.department.code", "data.department.name", "data.project.name")
_LINE_PLACE = ("x.dept_code", "x.department", "x.project")
_NO_REF = ("CAST(NULL AS STRING)",) * 3
_MEMO_REF = ("data.parent_memo.number", "data.parent_memo.date", "data.parent_memo.id")
_FIRST_REF = tuple(f"try_element_at(claims, 1).{c}" for c in ("ref_no", "ref_date", "ref_id"))
_LINE_REF = ("x.ref_no", "x.ref_date", "x.ref_id")


def _row(note, debit, credit, code, name, line_id, place, currency, rate, ref, sign_code=None):
    return X.struct(
        note=note, debit=f"CAST({debit} AS {X.MONEY})", credit=f"CAST({credit} AS {X.MONEY})",
        account_code=code, sign_code=sign_code or code, coa_name=name, source_line_id=line_id,
        dept_code=place[0], department=place[1], project=place[2], currency=currency,
        exchange_rate=rate, doc_ref_no=ref[0], doc_ref_date=ref[1], doc_ref_id=ref[2])


def _sides(value: str, on_debit: bool) -> tuple[str, str]:
    """(debit, credit) with the value on one of them."""
    return (value, "0") if on_debit else ("0", value)


def _if_given(value: str, row: str) -> str:
    """The row in an array, or none when its value is zero: such a row would be dropped later."""
    return f"IF({value} <> 0, array({row}), array())"


def _suffixed(ident: str, *tail: str) -> str:
    return f"concat(coalesce({ident}, 'None'), {', '.join(tail)})"


def _converted(amount: str, rate: str) -> str:
    """Amount times rate; a product out of range unbalances its document."""
    return (f"coalesce(try_cast(try_multiply(CAST({amount} AS DECIMAL(28,9)), {rate}) "
            f"AS {X.MONEY}), 0)")


def _payments(note: str, on_debit: bool, ref, suffix: str | None = None) -> str:
    line_id = "p.id" if suffix is None else _suffixed("p.id", X.lit(suffix))
    return "transform(payments, p -> " + _row(
        X.lit(note), *_sides("p.amount", on_debit), "p.code", "p.name", line_id, _DOCUMENT_PLACE,
        "p.currency", "p.rate", ref) + ")"


def _trade(side, on_debit, note, tax_note, ref, rate=None, currency="x.currency", suffix=None):
    """Gross, discount and tax rows of every trade line.

    Gross and taxes go to one side, the line discount to the other, so a zero
    discount leaves a plain net posting. ``rate`` converts the amounts.
    """
    off_code, off_name = X.discount_account(side)
    tax_code, tax_name = X.tax_account("t.code", "t.name", side)

    def value(amount):
        return amount if rate is None else _converted(amount, rate)
    where = (_LINE_PLACE, currency, rate or "x.rate", ref)
    gross = _row(X.first_nonblank("x.description", X.lit(note)), *_sides(value("x.before"), on_debit),
                 "x.code", "x.name", "x.id" if suffix is None else _suffixed("x.id", X.lit(suffix)),
                 *where)
    off = _row("'Discount'", *_sides(value("(x.before - x.after)"), not on_debit), off_code, off_name,
               _suffixed("x.id", "'_disc'"), *where)
    tax = _row(X.first_nonblank("t.name", "t.code", X.lit(tax_note)),
               *_sides(value(X.decimal_lenient("t.amount")), on_debit), tax_code, tax_name,
               _suffixed("x.id", "'_'", "coalesce(t.id, 'None')", "'_tax'"), *where)
    taxes = f"transform(coalesce(x.taxes, array()), t -> {tax})"
    off = _if_given(value("(x.before - x.after)"), off)
    return f"flatten(transform(lines, x -> concat(array({gross}), {off}, {taxes})))"


def _cash(note: str, on_debit: bool, ref) -> str:
    clearing, clearing_name = K.CASH_CLEARING
    return "array(" + _row(
        note, *_sides("cash.amount", on_debit),
        f"coalesce(nullif(cash.code, ''), {X.lit(clearing)})",
        f"coalesce(nullif(cash.name, ''), {X.lit(clearing_name)})",
        "coalesce(nullif(cash.account_id, ''), 'cash')", _DOCUMENT_PLACE, "cash.currency",
        "cash.rate", ref, sign_code="cash.code") + ")"


def sales_invoice() -> list[str]:
    return [_payments("Accounts Receivable", True, _NO_REF),
            _trade("sales", False, "Revenue", "Tax", _NO_REF)]


def sales_return() -> list[str]:
    # A return is converted as a whole: its lines take the document's rate.
    return [_trade("sales", True, "Sales Return", "Tax Reversal", _MEMO_REF, "base_rate",
                   "base_currency", "_rev"),
            _payments("Accounts Receivable Reversal", False, _MEMO_REF, "_ar")]


def purchase_invoice() -> list[str]:
    other = _row("coalesce(nullif(p.name, ''), 'Other Charge')", *_sides("p.amount", True), "p.code",
                 "p.name", _suffixed("p.id", "'_other'"), _DOCUMENT_PLACE, "p.currency", "p.rate",
                 _NO_REF)
    return [_trade("purchase", True, "Purchase", "Input Tax", _NO_REF, "x.rate"),
            f"transform(others, p -> {other})", _payments("Accounts Payable", False, _NO_REF)]


def purchase_return() -> list[str]:
    return [_payments("Accounts Payable Reversal", True, _MEMO_REF),
            _trade("purchase", False, "Purchase Return", "Input Tax Reversal", _MEMO_REF)]


def _settlement(cash_note, cash_on_debit, discount_note, claim_note, side) -> list[str]:
    """Cash, other amounts and the claim lines of a payment document.

    Money received and money paid mirror each other: every row of one sits on
    the opposite side in the other.
    """
    off_code, off_name = X.discount_account(side)
    # Below zero is a charge when money comes in and an adjustment when it goes out.
    on_debit = f"(p.amount < 0) = {str(cash_on_debit).lower()}"
    moved = f"(cash.fx AND coalesce(p.code = {X.lit(K.BANK_CHARGE[0])}, false))"
    fx_code, fx_name = X.forex_account(f"({on_debit})")
    other = _row(f"IF({moved}, {fx_name}, IF({on_debit}, 'Other Charge', 'Other Adjustment'))",
                 f"IF({on_debit}, abs(p.amount), 0)", f"IF({on_debit}, 0, abs(p.amount))",
                 f"IF({moved}, {fx_code}, p.code)", f"IF({moved}, {fx_name}, p.name)", "p.id",
                 _DOCUMENT_PLACE, "p.currency", "p.rate", _FIRST_REF)
    where = (_LINE_PLACE, "x.currency", "x.rate", _LINE_REF)
    rows = [
        _if_given("x.discount", _row(X.lit(discount_note), *_sides("x.discount", cash_on_debit), off_code,
                                     off_name, _suffixed("x.id", "'_discount'"), *where)),
        _if_given("x.settled", _row(X.lit(claim_note), *_sides("x.settled", not cash_on_debit), "x.code",
                                    "x.name", "x.id", *where)),
        _if_given("x.withheld", _row("'Withholding Tax (PPh 23)'", *_sides("x.withheld", cash_on_debit),
                                     off_code, off_name, _suffixed("x.id", "'_wht'"), *where))]
    return [_cash(X.lit(cash_note), cash_on_debit, _FIRST_REF), f"transform(others, p -> {other})",
            f"flatten(transform(claims, x -> concat({', '.join(rows)})))"]


def receivable_payment() -> list[str]:
    return _settlement("Cash Receipt", True, "Sales Discount", "Accounts Receivable (Payment)",
                       "sales")


def payable_payment() -> list[str]:
    return _settlement("Cash Payment", False, "Purchase Discount", "Accounts Payable (Payment)",
                       "purchase")


def _funds(on_debit: bool) -> str:
    return "transform(lines, x -> " + _row(
        "x.note", *_sides("x.amount", on_debit), "x.code", "x.name", "x.id", _LINE_PLACE,
        "x.currency", "x.rate", _NO_REF) + ")"


def cash_in() -> list[str]:
    return [_cash(X.lit(None), True, _NO_REF), _funds(False)]


def cash_out() -> list[str]:
    return [_funds(True), _cash(X.lit(None), False, _NO_REF)]


def manual_journal() -> list[str]:
    return ["transform(lines, x -> " + _row(
        "coalesce(nullif(x.name, ''), 'Manual Journal')", "x.debit", "x.credit", "x.code", "x.name",
        "x.id", _LINE_PLACE, "x.currency", "x.rate", _NO_REF) + ")"]


KINDS = {
    "manual_journal": manual_journal,
    "sales_invoice": sales_invoice,
    "receivable_payment": receivable_payment,
    "sales_return": sales_return,
    "purchase_invoice": purchase_invoice,
    "payable_payment": payable_payment,
    "purchase_return": purchase_return,
    "cash_in": cash_in,
    "cash_out": cash_out,
}


def rows_by_module(modules=None) -> str:
    """All rows of a document by its kind."""
    whens = []
    for module in (K.MODULES if modules is None else modules):
        parts = [f"coalesce(CAST({p} AS {ROW_TYPE}), CAST(array() AS {ROW_TYPE}))"
                 for p in KINDS[module]()]
        whens.append(f"WHEN {X.lit(module)} THEN concat({', '.join(parts)})")
    return f"CASE module {' '.join(whens)} ELSE CAST(array() AS {ROW_TYPE}) END"


def totals() -> str:
    """Debit and credit of all rows, a fold each."""
    def total(side):
        return (f"aggregate(draft_rows, CAST(0 AS {X.TOTAL}), "
                f"(a, r) -> CAST(a + r.{side} AS {X.TOTAL}))")
    return X.struct(debit=total("debit"), credit=total("credit"))


def filled() -> str:
    """True when some row has a value; the rows are looked at only if the totals do not tell."""
    return ("(draft.debit <> 0 OR draft.credit <> 0 "
            "OR exists(draft_rows, r -> r.debit <> 0 OR r.credit <> 0))")


def residual() -> str:
    """The gap of a payment document that is small enough to absorb, else 0.

    Credit less debit. An empty document has no such row; larger gaps stay and
    fail the balance gate.
    """
    gap = f"CAST(draft.credit - draft.debit AS {X.MONEY})"
    return (f"IF(module IN {X.in_list(PAYMENT_KINDS)} AND {filled()} "
            f"AND abs({gap}) <= {K.RESIDUAL_CAP}, {gap}, CAST(0 AS {X.MONEY}))")


def rows_with_residual() -> str:
    """Rows, and one more that absorbs the residual.

    It is a realised exchange difference when the cash settles in foreign
    currency, else a bank charge.
    """
    fx_code, fx_name = X.forex_account("residual > 0")
    code, name = K.BANK_CHARGE
    label = f"IF(cash.fx, {fx_name}, {X.lit(name)})"
    extra = _row(label, "greatest(residual, 0)", "greatest(-residual, 0)",
                 f"IF(cash.fx, {fx_code}, {X.lit(code)})", label,
                 "IF(cash.fx, 'forex_diff', 'bank_charge')", _DOCUMENT_PLACE, "base_currency",
                 "base_rate", _FIRST_REF)
    return (f"IF(residual <> 0, concat(draft_rows, CAST(array({extra}) AS {ROW_TYPE})), "
            f"draft_rows)")
