"""From a parsed document to its journal rows, inside one row of the feed.

A document arrives whole in one callback row, so its journal is built as an
array on that row: empty and balance gates and the balancing residual are
folds over the array, and nothing is shuffled until rows leave the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from saldoflow import constants as K
from saldoflow.functions import scalars as S, text as X
from saldoflow.operators import journals as J
from saldoflow.sources import callbacks as C


_OWN_BOOKS = X.in_list(["manual_journal", "cash_in", "cash_out"])
_SALES = X.in_list(["sales_invoice", "sales_return", "receivable_payment"])
_PURCHASES = X.in_list(["purchase_invoice", "purchase_return", "payable_payment"])
_CASH = X.in_list(["cash_in", "cash_out"])


def once(df: DataFrame, **texts: str) -> DataFrame:
    """Like :func:`saldoflow.functions.scalars.once`, but a column that nobody reads is not worked out.

    What depends on a random number is not substituted into the projections and filters above
    it; the number picks the only item there is.
    """
    only = (F.rand(0) == 2).cast("int")
    return df.select("*", *[F.get(F.array(F.expr(text)), only).alias(name) for name, text in texts.items()])


def with_typed_parts(docs: DataFrame) -> DataFrame:
    """Add base fields and typed arrays that every journal kind reads.

    Cash and manual documents are kept in base currency whatever they say.
    """
    vendor = X.first_nonblank("data.vendor.name", "data.supplier.name", "data.contact.name")
    base = once(
        docs,
        base_currency=(f"IF(module IN {_OWN_BOOKS}, '{K.BASE_CURRENCY}', "
                       f"coalesce(nullif(data.currency.code, ''), '{K.BASE_CURRENCY}'))"),
        base_rate=(f"IF(module IN {_OWN_BOOKS}, CAST(1 AS {X.RATE}), "
                   f"{X.rate_or('data.exchange_rate', '1')})"),
        party=(f"CASE WHEN module IN {_SALES} THEN data.customer.name "
               f"WHEN module IN {_PURCHASES} THEN {vendor} "
               f"WHEN module IN {_CASH} THEN data.contact.name END"))
    payment = f"module IN {X.in_list(J.PAYMENT_KINDS)}"
    return once(
        base, lines=f"IF({payment}, NULL, {J.lines()})", claims=f"IF({payment}, {J.claims()}, NULL)",
        payments=J.money_items("data.payments"), others=J.money_items("data.others"), cash=J.cash())


def missing_fields() -> str:
    """Names of the required fields a document leaves null or empty."""
    def gap(value, name):
        return f"IF(coalesce({value}, '') = '', {name}, NULL)"
    party = (f"CASE WHEN module IN {_PURCHASES} THEN 'data.vendor.name' "
             f"WHEN module IN {_SALES} THEN 'data.customer.name' END")
    return "concat_ws(', ', " + ", ".join([
        gap("data.id", "'data.id'"), gap("data.number", "'data.number'"),
        gap("data.date", "'data.date'"), gap("party", party)]) + ")"


def payload_validate() -> str:
    """Why a document cannot be posted, or null."""
    allowed = []
    for module, end_point in K.MODULE_ENDPOINTS.items():
        spellings = sorted({end_point, K.OLD_PURCHASE_ENDPOINTS.get(module, end_point)})
        allowed.append(f"WHEN '{module}' THEN end_point IN {X.in_list(spellings)}")
    return (f"CASE WHEN NOT coalesce(CASE module {' '.join(allowed)} END, false) "
            f"THEN concat('unexpected end_point: ', coalesce(end_point, 'None')) "
            f"WHEN data IS NULL THEN 'payload.data must be a dict' "
            f"WHEN {missing_fields()} <> '' "
            f"THEN concat('missing required fields: ', {missing_fields()}) END")


def out_of_range() -> str:
    """True when a figure of the document, or one converted at its rate, does not fit.

    Such a figure must stop its document; read leniently it would count as nothing.
    """
    def some(of: str, name: str, *fields: str) -> str:
        return f"exists({of}, {name} -> {' OR '.join(X.too_large(f) for f in fields)})"

    def converted(of: str, *fields: str) -> str:
        largest = "greatest(" + ", ".join(f"abs(CAST(x.{f} AS DOUBLE))" for f in fields) + ")" if len(fields) > 1 \
            else f"abs(CAST(x.{fields[0]} AS DOUBLE))"
        return f"exists({of}, x -> {largest} * greatest(abs(CAST(x.rate AS DOUBLE)), 1D) >= {X.LARGEST})"

    parts = [some("data.line_items", "x", "x.amount", "x.debit", "x.credit", "x.subtotal_before_discount",
                  "x.subtotal_after_discount", "x.discount.amount", "x.payable.amount", "x.payment.amount"),
             "exists(data.line_items, x -> coalesce(" + some("x.taxes", "t", "t.amount") + ", false))",
             some("data.payments", "x", "x.amount"), some("data.others", "x", "x.amount"), X.too_large("data.cash.amount"),
             converted("lines", "amount", "debit", "credit", "before", "after"), converted("claims", "settled", "discount"),
             converted("payments", "amount"), converted("others", "amount"), converted("array(cash)", "amount")]
    return " OR ".join(f"coalesce({p}, false)" for p in parts)


def _plain(value: str) -> str:
    text = f"CAST(CAST({value} AS DECIMAL(38,4)) AS STRING)"
    return f"regexp_replace(regexp_replace({text}, '0+$', ''), '[.]$', '')"


def gates() -> str:
    """Empty and balance gates of one document, as an error text or null."""
    debit, credit, diff = "total_debit", "total_credit", "(total_debit - total_credit)"
    source = "coalesce(data.id, 'None')"
    slack = (f"CAST(IF(module = 'manual_journal', {K.MANUAL_BALANCE_TOLERANCE}, "
             f"{K.BALANCE_TOLERANCE}) AS DECIMAL(4,2))")
    kind = "IF(module = 'sales_invoice', 'unbalanced', concat('unbalanced ', module))"
    return (f"CASE WHEN {out_of_range()} "
            f"THEN concat('amount out of range for ', module, ' source_id=', {source}) "
            f"WHEN NOT {J.filled()} "
            f"THEN concat('no rows generated for ', module, ' source_id=', {source}) "
            f"WHEN abs({diff}) > {slack} "
            f"THEN concat({kind}, ' transform for source_id=', {source}, ': total_debit=', "
            f"{_plain(debit)}, ', total_credit=', {_plain(credit)}, ', diff=', {_plain(diff)}) END")


def transform_documents(docs: DataFrame, modules=None) -> DataFrame:
    """Documents with their journal ``rows`` and ``error`` (null when posted).

    Failures stay on their document; the run goes on.
    """
    df = once(with_typed_parts(docs), draft_rows=J.rows_by_module(modules))
    df = once(df, draft=J.totals())
    df = once(df, residual=J.residual())
    df = once(df, rows=J.rows_with_residual(),
              total_debit=f"CAST(draft.debit + greatest(residual, 0) AS {X.TOTAL})",
              total_credit=f"CAST(draft.credit + greatest(-residual, 0) AS {X.TOTAL})")
    df = once(df, error=f"coalesce({payload_validate()}, {gates()})")
    return with_head(df).select("callback_id", F.col("created_at").alias("raw_created_at"), "module",
                     "end_point", "method", "source_id", "status", "data", "head", "party",
                     "base_currency", "base_rate", "lines", "claims", "rows", "total_debit",
                     "total_credit", "error")


def documents_of(callbacks: DataFrame, module: str) -> DataFrame:
    """Callbacks read as documents of one module whatever their end point says."""
    parsed = C.parse_bodies(callbacks)
    return parsed.select("callback_id", "created_at", F.lit(module).alias("module"),
                         F.col("payload.end_point").alias("end_point"),
                         F.col("payload.method").alias("method"),
                         F.col("payload.data.id").alias("source_id"),
                         F.col("payload.data.status").alias("status"),
                         F.col("payload.data").alias("data"))


#: Fields of a document that the activity log reads.
PEOPLE = ("updated", "created", "number", "date", "description")


def with_head(docs: DataFrame) -> DataFrame:
    """Add ``head``, the fields every row of a document repeats, and what the activity log needs.

    Texts are converted here, once per document, before its rows multiply them.
    """
    d = F.col("data")
    return S.once(docs, head=F.struct(
        d.date.try_cast("date").alias("date"), d.number.alias("ref_no"),
        F.when(F.col("module") != "manual_journal", F.col("party")).alias("contact"),
        d.description.alias("description"), S.to_wib(d.created.time).alias("created_at"),
        d.created.user["name"].alias("created_by"), F.struct(*[d[c].alias(c) for c in PEOPLE]).alias("people")))


def journal_lines(transformed: DataFrame) -> DataFrame:
    """One row per accounting line of the documents that passed every gate."""
    heads = transformed.filter(F.col("error").isNull()).select(
        "head.*", S.literal_lookup(F.col("module"), K.DOCUMENT_TYPES).alias("type"),
        "source_id", "status", "module", F.col("callback_id").cast("string").alias("raw_callback_id"),
        "raw_created_at", "rows").drop("people")
    flat = heads.select(*[c for c in heads.columns if c != "rows"],
                        F.posexplode("rows").alias("row_no", "row"))
    valued = flat.filter((F.col("row.debit") != 0) | (F.col("row.credit") != 0))
    plain = valued.select("*", "row.*").drop("row").withColumns({
        "doc_ref_date": F.col("doc_ref_date").try_cast("date"),
        "amount": F.expr(X.signed_amount("sign_code", "debit", "credit"))}).drop("sign_code")
    return plain.withColumn("original_currency",
                            S.original_currency_amount(F.col("amount"), F.col("exchange_rate")))


def with_reference_names(lines: DataFrame, module: str) -> DataFrame:
    """Name the reference columns the way the module's table does."""
    names = K.REFERENCE_COLUMNS.get(module)
    if not names:
        return lines.drop("doc_ref_no", "doc_ref_date", "doc_ref_id")
    number, day, ident = names
    return lines.withColumnsRenamed(
        {"doc_ref_no": number, "doc_ref_date": day, "doc_ref_id": ident})


def failed_records(transformed: DataFrame) -> DataFrame:
    return transformed.filter(F.col("error").isNotNull()).select("callback_id", "module", "error")
