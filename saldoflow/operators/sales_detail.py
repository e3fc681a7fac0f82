"""Journal of imported invoice lines: one balanced entry per invoice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from saldoflow import constants as K
from saldoflow.functions import scalars as S
from saldoflow.operators import changes as CH, ledger as L
from saldoflow.session import settle

REQUIRED_ACCOUNTS = [K.RECEIVABLE_DOMESTIC, K.RECEIVABLE_FOREIGN, K.SALES_VAT]
MONEY = "decimal(18,2)"
TEXT_COLUMNS = ["ref_no", "contact", "dept_code", "dept", "description", "service_code",
                "service_name", "service", "account", "status", "income_type", "classification",
                "location", "reporting_line", "new_dept", "dept_div", "pc"]


def coa_resolver(coa: DataFrame, order: str = "seq") -> DataFrame:
    """Account name or dashed code -> (short code, account name); last one wins.

    ``order`` is the order of the chart's rows.
    """
    base = coa.select(S.strip(F.col("account_code")).alias("code"),
                      S.strip(F.col("account_name")).alias("name"), F.col(order).alias("_seq"))
    entry = F.struct(S.account_code_normalise(F.col("code")).alias("short_code"),
                     F.col("name").alias("coa_name"))
    both = base.select(F.explode(F.array(
        F.struct(F.col("name").alias("account_key"), F.lit(0).alias("k")),
        F.struct(F.col("code").alias("account_key"), F.lit(1).alias("k")))).alias("e"),
        entry.alias("v"), "_seq")
    return (both.filter(F.col("e.account_key").isNotNull()).groupBy(F.col("e.account_key").alias("account_key"))
            .agg(F.max_by("v", F.struct("_seq", "e.k")).alias("v")).select("account_key", "v.*"))


def missing_required_accounts(resolver: DataFrame) -> DataFrame:
    """The fixed accounts the journal needs and the chart lacks."""
    needed = resolver.sparkSession.createDataFrame([(a,) for a in REQUIRED_ACCOUNTS],
                                                   "account_key string")
    return needed.join(resolver, "account_key", "left_anti")


def sales_sheet_normalise(sheet: DataFrame, resolver: DataFrame | None = None) -> DataFrame:
    """Known columns only, money and dates typed, currency defaults, account code.

    A column that the sheet lacks is there as null.
    """
    have = {c.strip(): F.col(f"`{c}`") for c in sheet.columns}
    out = []
    absent = F.lit(None).cast("string")
    for c in TEXT_COLUMNS:
        out.append(have.get(c, absent).cast("string").alias(c))
    for c in ("subtotal", "tax", "total"):
        value = have[c].cast("string").try_cast("double") if c in have else F.lit(None)
        out.append(F.coalesce(value, F.lit(0.0)).cast(MONEY).alias(c))
    for c in ("date", "period"):
        out.append(have.get(c, absent).cast("string").try_cast("date").alias(c))
    out.append(have.get("created_at", absent).cast("string").try_cast("timestamp_ntz").alias("created_at"))
    currency = have.get("currency", F.lit(None).cast("string"))
    out.append(F.upper(S.strip(F.coalesce(currency, F.lit(K.BASE_CURRENCY)))).alias("currency"))
    rate = have["exchange_rate"].cast("string").try_cast("decimal(18,6)") \
        if "exchange_rate" in have else F.lit(None)
    out.append(F.coalesce(rate, F.lit(1)).cast("decimal(18,6)").alias("exchange_rate"))
    rows = sheet.select(*out)
    if resolver is None:
        return rows
    codes = resolver.select(F.col("account_key").alias("_key"),
                            F.col("short_code").alias("account_code"))
    key = S.strip(F.coalesce(F.col("account"), F.lit("")))
    return rows.join(codes, key == F.col("_key"), "left").drop("_key")


def sales_detail_read(lines: DataFrame, period: str | None = None,
                      refs: DataFrame | None = None) -> DataFrame:
    """Stored lines of a month (first day of it) and/or of some invoices."""
    if period is not None:
        start = F.lit(period).cast("date")
        lines = lines.filter((F.col("date") >= start) & (F.col("date") < F.add_months(start, 1)))
    return lines if refs is None else lines.join(refs.select("ref_no").distinct(), "ref_no",
                                                 "left_semi")


def _account_text() -> Column:
    return S.strip(F.coalesce(F.col("account"), F.lit("")))


def unmapped_accounts(lines: DataFrame, resolver: DataFrame) -> DataFrame:
    return lines.join(resolver, _account_text() == resolver["account_key"], "left_anti")


def _head_struct() -> Column:
    return F.struct("date", "contact", "description", "service", "dept_code", "dept", "currency",
                    "exchange_rate", "status", "created_at")


def _dominance() -> Column:
    return F.struct(F.coalesce(F.col("subtotal"), F.lit(0)).alias("s"),
                    F.coalesce(F.col("service_code"), F.lit("")).alias("c"))


def dominant_line(lines: DataFrame) -> DataFrame:
    """Per invoice, the line with the largest (subtotal, service code)."""
    whole = F.struct(*[c for c in lines.columns if c != "ref_no"])
    return lines.groupBy("ref_no").agg(F.max_by(whole, _dominance()).alias("r")).select(
        "ref_no", "r.*")


def sales_invoice_journal(lines: DataFrame, resolver: DataFrame) -> DataFrame:
    """Balanced ledger rows: receivable, revenue per line, VAT when there is any.

    The receivable is the sum of the parts, not of the sheet's own totals, so
    an entry balances by construction. Lines are combined per invoice before the
    shuffle and only joined back for their head fields.
    """
    money = {c: F.coalesce(F.col(c), F.lit(0)).cast(MONEY) for c in ("subtotal", "tax")}
    clean = lines.withColumns(money)
    heads = (clean.groupBy("ref_no")
             .agg(F.max_by(_head_struct(), _dominance()).alias("h"),
                  F.sum("subtotal").alias("s"), F.sum("tax").alias("t"))
             .select("ref_no", "h", F.col("s").cast("decimal(28,2)").alias("s"),
                     F.col("t").cast("decimal(28,2)").alias("t")))
    zero = F.lit(0).cast("decimal(28,2)")
    ar = F.struct(S.receivable_account(F.col("h.currency")).alias("account"),
                  F.col("h.description").alias("description"), F.col("h.service").alias("note"),
                  F.col("h.dept_code").alias("dept_code"), F.col("h.dept").alias("department"),
                  (F.col("s") + F.col("t")).cast("decimal(28,2)").alias("debit"), zero.alias("credit"),
                  F.concat(F.col("ref_no"), F.lit("#AR")).alias("source_line_id"))
    vat = F.struct(F.lit(K.SALES_VAT).alias("account"), F.col("h.description").alias("description"),
                   F.col("h.service").alias("note"), F.col("h.dept_code").alias("dept_code"),
                   F.col("h.dept").alias("department"), zero.alias("debit"),
                   F.col("t").alias("credit"),
                   F.concat(F.col("ref_no"), F.lit("#VAT")).alias("source_line_id"))
    invoice_rows = heads.select("ref_no", "h", F.explode(
        F.when(F.col("t") != 0, F.array(ar, vat)).otherwise(F.array(ar))).alias("r"))
    revenue = F.struct(_account_text().alias("account"), F.col("description"),
                       F.col("service").alias("note"), F.col("dept_code"),
                       F.col("dept").alias("department"), zero.alias("debit"),
                       F.col("subtotal").cast("decimal(28,2)").alias("credit"),
                       F.concat(F.col("ref_no"), F.lit("#"),
                                F.coalesce(F.col("service_code"), F.lit("None"))).alias("source_line_id"))
    line_rows = clean.select("ref_no", revenue.alias("r")).join(
        heads.select("ref_no", "h"), "ref_no").select("ref_no", "h", "r")
    rows = invoice_rows.unionByName(line_rows).join(
        resolver, F.col("r.account") == resolver["account_key"])
    amount = (F.col("r.debit") - F.col("r.credit")).cast("decimal(28,2)")
    given = F.coalesce(F.col("h.exchange_rate"), F.lit(0))
    rate = F.when(given == 0, F.lit(1)).otherwise(given).cast("decimal(18,6)")
    return rows.select(
        F.lit(K.SALES_DETAIL).alias("module"), F.lit(K.SALES_DETAIL).alias("type"),
        F.col("ref_no").alias("ref_key"), "ref_no", F.col("h.date").alias("date"),
        F.col("h.contact").alias("contact"), F.col("r.description").alias("description"),
        F.col("r.note").alias("note"), F.col("r.dept_code").alias("dept_code"),
        F.col("r.department").alias("department"), F.lit(None).cast("string").alias("project"),
        F.col("r.debit").alias("debit"), F.col("r.credit").alias("credit"), amount.alias("amount"),
        F.col("short_code").alias("account_code"), "coa_name", F.col("ref_no").alias("source_id"),
        F.col("r.source_line_id").alias("source_line_id"),
        F.upper(S.strip(F.coalesce(S.nonblank(F.col("h.currency")), F.lit(K.BASE_CURRENCY)))).alias("currency"),
        (amount / rate).cast("decimal(38,12)").alias("original_currency"), rate.alias("exchange_rate"),
        F.col("h.status").alias("status"), F.col("h.created_at").alias("created_at"),
        F.lit(None).cast("string").alias("created_by"))


def journal_unbalanced(gl: DataFrame) -> DataFrame:
    net = (gl.groupBy("ref_no").agg(F.sum(F.col("debit") - F.col("credit")).alias("net")))
    return net.filter(F.abs("net") > F.lit("0.005").cast("decimal(4,3)")).select("ref_no")


def sales_detail_check(lines: DataFrame, resolver: DataFrame) -> DataFrame:
    """One report row over all lines, in one pass and one distinct count."""
    keys = resolver.select(F.col("account_key").alias("_key"))
    marked = lines.join(keys, _account_text() == F.col("_key"), "left")
    drift = F.abs(F.col("subtotal") + F.col("tax") - F.col("total")) > F.lit("0.005").cast("decimal(4,3)")
    per_invoice = marked.groupBy("ref_no").agg(
        F.count("*").alias("lines"), F.count_if(F.col("_key").isNull()).alias("unmapped"),
        F.count_if(drift).alias("drift"), F.sum("subtotal").alias("subtotal"),
        F.sum("tax").alias("tax"), F.sum("total").alias("total"))
    rows = F.col("lines") + 1 + F.when(F.col("tax") != 0, 1).otherwise(0)
    report = per_invoice.agg(
        F.sum("lines").alias("lines"), F.count("*").alias("invoices"), F.sum(rows).alias("_rows"),
        F.sum("unmapped").alias("unmapped"), F.sum("drift").alias("total_drift_rows"),
        *[F.sum(c).cast("decimal(38,2)").alias(c) for c in ("subtotal", "tax", "total")])
    mapped = F.col("unmapped") == 0
    # The receivable is the sum of the credits, so no entry can be unbalanced
    # once every account resolves; import and repost still test the entries.
    return report.select(
        "lines", "invoices", F.when(mapped, F.col("_rows")).otherwise(0).alias("gl_rows"),
        "unmapped", "total_drift_rows", "subtotal", "tax", "total", mapped.alias("ok"))


def posting_status(lines: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per invoice: expected and posted receivable, and where they differ.

    ``state`` is in_sync, unposted, stale, or orphan (posted without lines).
    """
    expected = lines.groupBy("ref_no").agg(
        F.round(F.sum("subtotal") + F.sum("tax"), 2).cast("decimal(28,2)").alias("expected"))
    posted = (ledger.filter(F.col("type") == K.SALES_DETAIL).groupBy(F.col("source_id").alias("ref_no"))
              .agg(F.sum(F.when(F.col("source_line_id").endswith("#AR"), F.col("debit"))).alias("p")))
    both = expected.join(posted.withColumn("_in_gl", F.lit(True)), "ref_no", "full")
    value = F.round(F.coalesce(F.col("p"), F.lit(0)), 2).cast("decimal(28,2)")
    gap = F.abs(F.col("expected") - value) > F.lit("0.005").cast("decimal(4,3)")
    state = (F.when(F.col("expected").isNull(), "orphan").when(F.col("p").isNull(), "unposted")
             .when(gap, "stale").otherwise("in_sync"))
    return both.select("ref_no", "expected", value.alias("posted"), state.alias("state"))


def posting_in_sync(status: DataFrame) -> DataFrame:
    def n(s):
        return F.count_if(F.col("state") == s).alias(s)
    counts = status.agg(F.count_if(F.col("state") != "orphan").alias("invoices"),
                        n("unposted"), n("stale"), n("orphan"))
    ok = (F.col("unposted") + F.col("stale") + F.col("orphan")) == 0
    return counts.withColumn("in_sync", ok)


#: From this many changed invoices on they are looked up in a hash table of each shuffle piece.
MANY_REFS = 500_000


def replace_posted(ledger: DataFrame, gl: DataFrame, refs: DataFrame,
                   drop_orphans_of: DataFrame | None = None, many: bool = False) -> DataFrame:
    """Ledger with the entries of ``refs`` replaced by ``gl``.

    With ``drop_orphans_of`` (all stored lines) posted invoices that have no
    line any more go as well. ``many`` refs, too many to be sent to all tasks, are hashed piece by
    piece, so the ledger's wide rows are shuffled but not sorted.
    """
    mine = F.col("type") == K.SALES_DETAIL
    others = ledger.filter(~mine | F.col("type").isNull())
    posted = ledger.filter(mine)
    gone = refs.select(F.col("ref_no").alias("source_id")).distinct()
    kept = posted.join(gone.hint("shuffle_hash") if many else gone, "source_id", "left_anti")
    if drop_orphans_of is not None:
        lined = drop_orphans_of.select(F.col("ref_no").alias("source_id")).distinct()
        kept = kept.join(lined.hint("shuffle_hash") if many else lined, "source_id", "left_semi")
    columns = ledger.columns
    return (others.select(*columns).unionByName(kept.select(*columns))
            .unionByName(gl.select(*columns)))


def _stop_if_any(rows: DataFrame, text: str, column: str) -> None:
    found = [str(r[0]) for r in rows.select(column).limit(10).collect()]
    if found:
        raise ValueError(f"{text}: {found}")


def guarded_journal(lines: DataFrame, resolver: DataFrame) -> DataFrame:
    """The journal of the lines, after the tests that must pass before it is posted.

    It is stored once, as the balance test and the caller both read it.
    """
    _stop_if_any(missing_required_accounts(resolver),
                 "the chart of accounts lacks account(s) the sales journal needs", "account_key")
    _stop_if_any(unmapped_accounts(lines, resolver),
                 "line(s) name a revenue account that is not in the chart", "account")
    journal = settle(sales_invoice_journal(lines, resolver), "sales-journal")
    _stop_if_any(journal_unbalanced(journal), "journal does not balance for invoice(s)", "ref_no")
    return journal


def sales_detail_autopost(ledger: DataFrame, lines: DataFrame, changed: DataFrame,
                          coa: DataFrame) -> DataFrame:
    """Ledger after re-posting only the invoices named in ``changed``.

    An invoice whose lines are all gone loses its entry. An unmapped account or an
    entry that does not balance stops it before anything is replaced. New entries
    carry the chart's code and reporting group when the ledger has these columns.
    """
    touched = lines.join(changed.select("ref_no").distinct(), "ref_no", "left_semi")
    journal = guarded_journal(touched, coa_resolver(coa))
    if "coa_code" in ledger.columns:
        journal = L.gl_reporting_enrich(journal, coa)
    return replace_posted(ledger, journal, changed, many=changed.count() >= MANY_REFS)


def sales_detail_autopost_versions(ledger: DataFrame, before: DataFrame, after: DataFrame,
                                   coa: DataFrame) -> DataFrame:
    """Ledger after re-posting every invoice whose stored lines changed from ``before`` to ``after``.

    What changed is found by comparing the two versions (inserted, updated and deleted
    lines all count), not named by the caller; an invoice whose lines are all deleted
    loses its entry. Otherwise as :func:`sales_detail_autopost`.
    """
    changed = settle(CH.changed_keys(before, after, "ref_no").select("ref_no"), "changed-invoices")
    return sales_detail_autopost(ledger, after, changed, coa)
