"""Cost distribution: rules, charges, receivers, overhead sweep, gates.

Ledger lines pass through narrow lookups into the sheets; only the gates and
the sweep aggregate. No join is told to broadcast: a run stores its lookups, so
Spark knows their size and broadcasts those below its threshold, and joins
larger ones by shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from saldoflow import constants as K
from saldoflow.functions import scalars as S

# --- lookups ---------------------------------------------------------------

def in_period(gl: DataFrame, period: str) -> DataFrame:
    """Lines dated in the month that starts on ``period``; a range for the scan."""
    start = F.lit(period).cast("date")
    return gl.filter((F.col("date") >= start) & (F.col("date") < F.add_months(start, 1)))


def gl_period_filter(gl: DataFrame, period: str) -> DataFrame:
    return in_period(gl, period)


def gl_period_report(gl: DataFrame, period: str) -> DataFrame:
    """Lines kept, lines of other months, undated lines."""
    start = F.lit(period).cast("date")
    inside = (F.col("date") >= start) & (F.col("date") < F.add_months(start, 1))
    return gl.agg(F.count_if(inside).alias("kept"),
                  F.count_if(F.col("date").isNotNull() & ~inside).alias("other_period"),
                  F.count_if(F.col("date").isNull()).alias("undated"))


def pc_lookup(pc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Departments by normalised name and by code; the last row of a key wins."""
    entry = F.struct(S.strip(F.col("pc")).alias("pc"), S.strip(F.col("div")).alias("div"),
                     S.strip(F.col("dept_code")).alias("dept_code"),
                     S.strip(F.col("dept")).alias("dept"))
    rows = pc.select(S.name_key(F.col("dept")).alias("name_key"),
                     S.strip(F.col("dept_code")).alias("code_key"), entry.alias("e"), "seq")

    def by(key):
        return (rows.filter(F.col(key).isNotNull()).groupBy(key)
                .agg(F.max_by("e", "seq").alias("e")).select(key, "e.*"))
    return by("name_key"), by("code_key")


def coa_reporting_lookup(coa: DataFrame) -> DataFrame:
    """Account code -> reporting line, code and label; the last row wins."""
    line = S.strip(F.col("reporting_line"))
    code = S.strip(F.col("reporting_code")) if "reporting_code" in coa.columns \
        else F.lit(None).cast("string")
    # Label and code are later additions to the chart: an older layout without
    # the label column derives it.
    label = S.strip(F.col("reporting_account")) if "reporting_account" in coa.columns else S.strip(
        F.concat(F.coalesce(code, F.lit("")), F.lit(" "), F.coalesce(line, F.lit(""))))
    rows = coa.select(
        S.strip(F.col("code")).alias("coa_key"),
        F.struct(line.alias("reporting_account_name"), code.alias("reporting_code"),
                 label.alias("reporting_account")).alias("e"), "seq")
    return (rows.filter(F.col("coa_key").isNotNull()).groupBy("coa_key")
            .agg(F.max_by("e", "seq").alias("e")).select("coa_key", "e.*"))


def logic_rules(logic: DataFrame) -> DataFrame:
    return logic.select(S.strip(F.col("account_code")).alias("code_key"),
                        S.name_key(F.col("account_name")).alias("account_key"),
                        S.name_key(F.col("pc")).alias("bucket_key"),
                        S.strip(F.col("distribution")).alias("method"))


def logic_duplicates(logic: DataFrame) -> DataFrame:
    """Ambiguous rule keys; a run with any of them is refused."""
    return (logic_rules(logic).groupBy("code_key", "account_key", "bucket_key")
            .agg(F.count("*").alias("n")).filter("n > 1"))


def allocation_split(allocation: DataFrame) -> DataFrame:
    """Split rows by method; only the lab method also goes by account name."""
    method = S.strip(F.col("distribution"))
    return allocation.select(
        method.alias("distribution"),
        F.when(method == K.LAB_METHOD, S.name_key(F.col("account_name"))).alias("lab_key"),
        S.name_key(F.col("account_name")).alias("account_key"),
        S.strip(F.col("new_dept")).alias("new_dept"),
        F.col("percentage").cast("double").alias("percentage"), "seq",
        (method == K.LAB_METHOD).alias("is_lab"))


# --- resolve ---------------------------------------------------------------

def line_amount(gl: DataFrame) -> DataFrame:
    """Cost is debit less credit, revenue the mirror, so both read positive."""
    code = S.strip(F.col("account_code"))
    debit = F.coalesce(F.col("debit").cast("double"), F.lit(0.0))
    credit = F.coalesce(F.col("credit").cast("double"), F.lit(0.0))
    return (gl.withColumns({"account_code": code, "debit": debit, "credit": credit,
                            "dept": S.strip(F.col("dept")), "dept_code": S.strip(F.col("dept_code"))})
            .withColumn("credit_side", S.credit_balance(F.col("account_code")))
            .withColumn("amount", F.when(F.col("credit_side"), F.col("credit") - F.col("debit"))
                        .otherwise(F.col("debit") - F.col("credit"))))


def bucket_resolve(lines: DataFrame, by_name: DataFrame, by_code: DataFrame) -> DataFrame:
    """Bucket of the line's department, by its code and else by its name."""
    named = by_name.select(F.col("name_key").alias("_nk"), F.col("pc").alias("bucket_by_name"))
    coded = by_code.select(F.col("code_key").alias("_ck"), F.col("pc").alias("bucket_by_code"))
    joined = (lines.join(named, S.name_key(lines["dept"]) == F.col("_nk"), "left")
              .join(coded, F.col("dept_code") == F.col("_ck"), "left").drop("_nk", "_ck"))
    return joined.withColumn("bucket", F.coalesce("bucket_by_code", "bucket_by_name"))


def bucket_report(resolved: DataFrame) -> DataFrame:
    a, b = F.col("bucket_by_code"), F.col("bucket_by_name")
    return resolved.agg(F.count_if(a.isNotNull() & b.isNotNull() & (a != b)).alias("disagreed"),
                        F.count_if(a.isNotNull() & b.isNull()).alias("rescued"))


def rule_resolve(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """Method of a line by account code, account name and bucket.

    Missing parts match missing parts: a line without a bucket takes a rule
    without one.
    """
    r = rules.select(F.col("code_key").alias("_c"), F.col("account_key").alias("_a"),
                     F.col("bucket_key").alias("_b"), "method")
    hit = (F.col("account_code").eqNullSafe(F.col("_c"))
           & S.name_key(F.col("account_name")).eqNullSafe(F.col("_a"))
           & S.name_key(F.col("bucket")).eqNullSafe(F.col("_b")))
    return lines.join(r, hit, "left").drop("_c", "_a", "_b")


def reporting_resolve(lines: DataFrame, reporting: DataFrame, code: str = "account_code") -> DataFrame:
    return lines.join(reporting, F.col(code) == F.col("coa_key"), "left").drop("coa_key")


# --- charge ----------------------------------------------------------------

def charge(resolved: DataFrame, split: DataFrame) -> DataFrame:
    """One row per line and receiving department, with its ``kind``.

    Lines without a method are charged directly; lines with one fan out over its
    split rows; a method without split rows is a reject, kept as a row of its
    own. The lab key is null for every other method, so one join serves both.
    """
    s = split.select(F.col("distribution").alias("_m"), F.col("lab_key").alias("_l"),
                     F.col("new_dept").alias("_to"), F.col("percentage").alias("_pct"))
    lab = F.when(F.col("method") == K.LAB_METHOD, S.name_key(F.col("account_name")))
    joined = resolved.join(s, (F.col("method") == F.col("_m")) & lab.eqNullSafe(F.col("_l")), "left")
    direct = F.col("method").isNull()
    kind = (F.when(direct, "direct").when(F.col("_to").isNull(), "reject").otherwise("distributed"))
    pct = F.when(direct, F.lit(1.0)).otherwise(F.col("_pct"))
    return (joined.withColumn("kind", kind)
            .withColumn("new_dept", F.when(direct, F.col("dept")).otherwise(F.col("_to")))
            .withColumn("percentage", pct)
            .withColumn("allocation", F.when(direct, F.col("amount")).otherwise(F.col("amount") * pct))
            .drop("_m", "_l", "_to", "_pct"))


def charge_direct(charged: DataFrame) -> DataFrame:
    return charged.filter(F.col("kind") == "direct")


def charge_distributed(charged: DataFrame) -> DataFrame:
    return charged.filter((F.col("kind") == "distributed") & (F.col("method") != K.LAB_METHOD))


def charge_lab(charged: DataFrame) -> DataFrame:
    return charged.filter((F.col("kind") == "distributed") & (F.col("method") == K.LAB_METHOD))


def charge_rejects(charged: DataFrame) -> DataFrame:
    return charged.filter(F.col("kind") == "reject")


def receiver_enrich(children: DataFrame, by_name: DataFrame, by_code: DataFrame) -> DataFrame:
    """Receiving code, division, profit centre and labels.

    A direct charge keeps its line's code; a distributed one is named by the
    split, so its code comes from that name. Everything else is read off the
    code first, which survives renames.
    """
    n = by_name.select(F.col("name_key").alias("_nk"), F.col("dept_code").alias("_n_code"),
                       F.col("div").alias("_n_div"), F.col("pc").alias("_n_pc"))
    c = by_code.select(F.col("code_key").alias("_ck"), F.col("dept").alias("_c_dept"),
                       F.col("div").alias("_c_div"), F.col("pc").alias("_c_pc"))
    named = children.join(n, S.name_key(F.col("new_dept")) == F.col("_nk"), "left")
    own = F.when(F.col("method").isNull(), F.col("dept_code"))
    coded = named.withColumn("new_dept_code", F.coalesce(own, F.col("_n_code")))
    joined = coded.join(c, F.col("new_dept_code") == F.col("_ck"), "left")
    target = F.coalesce(F.col("_c_dept"), F.col("new_dept"))
    named_account = S.strip(F.concat(F.coalesce(F.col("account_code"), F.lit("")), F.lit(" "),
                                     F.coalesce(F.col("account_name"), F.lit(""))))
    label = F.when(F.col("method").isNotNull(), F.concat(
        F.col("method"), F.lit(" / "), F.coalesce(F.col("new_dept"), F.lit(""))))
    return (joined.withColumn("new_dept", target)
            .withColumn("div", F.coalesce("_c_div", "_n_div"))
            .withColumn("pc", F.coalesce("_c_pc", "_n_pc"))
            .withColumn("account", named_account)
            .withColumn("distribution_and_allocation", label)
            .withColumn("period", F.trunc("date", "month"))
            .drop("_nk", "_n_code", "_n_div", "_n_pc", "_ck", "_c_dept", "_c_div", "_c_pc"))


# --- overhead --------------------------------------------------------------

def swept_departments(pc: DataFrame) -> DataFrame:
    """Names of the departments whose cost is swept out."""
    target = " ".join(K.OVERHEAD_SWEEP_PC.split()).lower()
    return (pc.filter(S.name_key(F.col("pc")) == target)
            .select(S.name_key(F.col("dept")).alias("swept_key")).filter("swept_key is not null").distinct())


def overhead_weights(split: DataFrame, swept: DataFrame) -> DataFrame:
    """Receiving department -> share of the pool, in roster order.

    The roster is the headcount split without the swept departments. Shares are
    renormalised and rounded; what rounding leaves goes to the largest share,
    the first one on ties.
    """
    roster = (split.filter(F.col("distribution") == K.OVERHEAD_METHOD)
              .join(swept, S.name_key(F.col("new_dept")) == F.col("swept_key"), "left_anti")
              .groupBy("distribution", "new_dept")
              .agg(F.sum("percentage").alias("share"), F.min("seq").alias("seq")))
    # One row per department of one method's roster.
    whole = Window.partitionBy("distribution")
    rounded = roster.withColumn("rounded", S.round_half_even(
        F.col("share") / F.sum("share").over(whole), K.OVERHEAD_DECIMALS))
    rank = F.row_number().over(whole.orderBy(F.desc("rounded"), "seq"))
    rest = F.lit(1.0) - F.sum("rounded").over(whole)
    fixed = rounded.withColumn("rest", rest).withColumn("rank", rank)
    take = (F.col("rank") == 1) & (F.abs("rest") > 1e-12)
    weight = F.when(take, F.col("rounded") + F.col("rest")).otherwise(F.col("rounded"))
    return fixed.select("distribution", "new_dept", weight.alias("weight"), "seq")


def overhead_sweep(base: DataFrame, weights: DataFrame, swept: DataFrame, by_name: DataFrame,
                   by_code: DataFrame, reporting: DataFrame) -> DataFrame:
    """Rows that move the swept departments' net cost to the receivers.

    Per period every swept department gets one reversal row, and the pool of all
    of them is charged out by weight. Revenue of a swept department first
    settles its own cost. The rows of a period add up to zero.
    """
    net = F.when(S.credit_balance(F.col("account_code")), -F.col("allocation")).otherwise(
        F.col("allocation"))
    own = (base.filter(F.col("period").isNotNull())
           .withColumn("_net", net)
           .groupBy("period", "new_dept").agg(F.sum("_net").alias("net"))
           .join(swept, S.name_key(F.col("new_dept")) == F.col("swept_key"), "left_semi")
           .filter("net <> 0"))
    reversal = own.select("period", "new_dept", (-F.col("net")).alias("amount"),
                          F.lit(1.0).alias("percentage"), (-F.col("net")).alias("allocation"))
    pool = own.groupBy("period").agg(F.sum("net").alias("pool"))
    # Charged like any other line: by the split of one method.
    charged = (pool.withColumn("distribution", F.lit(K.OVERHEAD_METHOD)).join(weights, "distribution")
               .select("period", "new_dept", F.col("pool").alias("amount"),
                       F.col("weight").alias("percentage"),
                       (F.col("pool") * F.col("weight")).alias("allocation")))
    code, name = K.OVERHEAD_ACCOUNT
    month = F.get(F.array(*[F.lit(m) for m in K.MONTHS_ID]),
                  F.month(F.add_months("period", -1)) - 1)
    label = F.concat(F.lit("FTE : PC "), month)
    n = by_name.select(F.col("name_key").alias("_nk"), F.col("dept_code").alias("_code"),
                       F.col("div").alias("_n_div"), F.col("pc").alias("_n_pc"))
    c = by_code.select(F.col("code_key").alias("_ck"), F.col("div").alias("_c_div"),
                       F.col("pc").alias("_c_pc"))
    rows = (reversal.unionByName(charged)
            .join(n, S.name_key(F.col("new_dept")) == F.col("_nk"), "left")
            .join(c, F.col("_code") == F.col("_ck"), "left"))
    rows = rows.select(
        "period", F.col("period").alias("date"), "new_dept", F.col("new_dept").alias("dept"),
        F.col("_code").alias("dept_code"), F.col("_code").alias("new_dept_code"),
        F.coalesce("_c_div", "_n_div").alias("div"), F.coalesce("_c_pc", "_n_pc").alias("pc"),
        F.concat(F.lit(f"{name} "), F.date_format("period", "MMyy")).alias("description"),
        F.lit(code).alias("account_code"), F.lit(name).alias("account_name"),
        F.lit(f"{code} {name}").alias("account"), "amount", "percentage", "allocation",
        F.greatest(F.col("amount"), F.lit(0.0)).alias("debit"),
        F.greatest(-F.col("amount"), F.lit(0.0)).alias("credit"),
        label.alias("distribution_and_allocation"), label.alias("method"),
        F.lit("overhead").alias("kind"), F.lit(None).cast("bigint").alias("gl_line_id"))
    return reporting_resolve(rows, reporting)


# --- reconciliation --------------------------------------------------------

def _side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Columns of several one-row frames in one row."""
    stacked = union_all(*single_rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _exact(amount: Column) -> Column:
    """Sum of amounts to twelve decimals, the same in whatever order they are added."""
    return F.coalesce(F.sum(amount.cast("decimal(28,12)")), F.lit(0).cast("decimal(38,12)"))


def recon_summary(resolved: DataFrame, charged: DataFrame, overhead: DataFrame | None = None) -> DataFrame:
    """One row of totals and counts; every input is read once.

    Totals and their differences are decimal and become double only in the result, so a
    tie-out neither drifts with the number of lines nor changes between runs.
    """
    amount, allocation = F.col("amount"), F.col("allocation")
    source = resolved.agg(_exact(amount).alias("source_total"),
                          F.count("*").alias("n_gl_lines"),
                          F.count_if(F.col("method").isNull()).alias("expected_direct"),
                          _exact(F.when(amount < 0, amount)).alias("negative_source"))
    good = F.col("kind") != "reject"
    out = charged.agg(
        _exact(F.when(good, allocation)).alias("base_total"),
        F.count_if(F.col("kind") == "direct").alias("n_direct"),
        F.count_if(F.col("kind") == "distributed").alias("n_distributed"),
        F.count_if(F.col("kind") == "reject").alias("n_rejects"),
        _exact(F.when(good & (allocation < 0), allocation)).alias("negative_allocation"))
    if overhead is None:
        zero = F.lit(0).cast("decimal(38,12)")
        swept = charged.sparkSession.range(1).select(
            zero.alias("overhead_net"), F.lit(0).cast("bigint").alias("n_overhead"), zero.alias("overhead_pool"))
    else:
        swept = overhead.agg(
            _exact(allocation).alias("overhead_net"), F.count("*").alias("n_overhead"),
            (-_exact(F.when(allocation < 0, allocation))).alias("overhead_pool"))
    one = _side_by_side(source, out, swept)
    total = F.col("base_total") + F.col("overhead_net")
    limit = F.greatest(F.lit(K.TOLERANCE), F.abs(F.col("source_total").cast("double")) * K.RELATIVE_TOLERANCE)
    double = lambda c: c.cast("double")
    return one.select(
        double(F.col("source_total")).alias("source_total"), double(total).alias("allocated_total"),
        double(total - F.col("source_total")).alias("variance"), "n_gl_lines",
        (F.col("n_direct") + F.col("n_distributed") + F.col("n_overhead")).alias("n_output_rows"),
        "n_direct", "expected_direct", "n_distributed", "n_rejects", "n_overhead",
        *[double(F.col(c)).alias(c) for c in ("overhead_net", "overhead_pool", "negative_source", "negative_allocation")],
        limit.alias("total_tolerance"))


def gate_total_tieout(recon: DataFrame) -> DataFrame:
    return recon.select(F.lit("total_tieout").alias("gate"),
                        (F.abs("variance") <= F.col("total_tolerance")).alias("ok"))


def gate_sweep_zero_sum(recon: DataFrame) -> DataFrame:
    return recon.select(F.lit("sweep_zero_sum").alias("gate"),
                        (F.abs("overhead_net") <= F.col("total_tolerance")).alias("ok"))


def gate_no_rejects(recon: DataFrame) -> DataFrame:
    return recon.select(F.lit("no_rejects").alias("gate"), (F.col("n_rejects") == 0).alias("ok"))


def gate_direct_count(recon: DataFrame) -> DataFrame:
    return recon.select(F.lit("direct_count").alias("gate"),
                        (F.col("n_direct") == F.col("expected_direct")).alias("ok"))


def line_breaches(charged: DataFrame) -> DataFrame:
    """Lines whose children do not add up to the line; childless lines are left out.

    A child carries its line's amount, so no join back to the lines is needed.
    """
    sums = (charged.filter(F.col("kind") != "reject").groupBy("gl_line_id")
            .agg(F.sum("allocation").alias("allocated"), F.max("amount").alias("amount")))
    return sums.filter(F.abs(F.col("allocated") - F.col("amount")) > K.TOLERANCE)


def gate_line_conservation(charged: DataFrame) -> DataFrame:
    return line_breaches(charged).agg((F.count("*") == 0).alias("ok")).select(
        F.lit("line_conservation").alias("gate"), "ok")


def gates(recon: DataFrame, charged: DataFrame) -> DataFrame:
    single = F.array(*[F.struct(F.lit(n).alias("gate"), c.alias("ok")) for n, c in (
        ("total_tieout", F.abs("variance") <= F.col("total_tolerance")),
        ("sweep_zero_sum", F.abs("overhead_net") <= F.col("total_tolerance")),
        ("no_rejects", F.col("n_rejects") == 0),
        ("direct_count", F.col("n_direct") == F.col("expected_direct")))])
    return recon.select(F.inline(single)).unionByName(gate_line_conservation(charged))


def check_percentage_sets(split: DataFrame) -> DataFrame:
    """Splits that do not add up to one, per method and account name."""
    return (split.groupBy("distribution", "account_key").agg(F.sum("percentage").alias("total"))
            .filter(F.abs(F.col("total") - 1.0) > 1e-6))


def check_referential(resolved: DataFrame, base: DataFrame, by_name: DataFrame,
                      coa: DataFrame) -> DataFrame:
    """Departments and accounts in use that the masters do not have."""
    used = (resolved.select(S.name_key(F.col("dept")).alias("value"))
            .unionByName(base.select(S.name_key(F.col("new_dept")).alias("value")))
            .filter("value is not null").distinct())
    lost = used.join(by_name, F.col("value") == F.col("name_key"), "left_anti")
    codes = resolved.select(F.col("account_code").alias("value")).filter("value is not null").distinct()
    known = coa.select(S.strip(F.col("code")).alias("_code"))
    unknown = codes.join(known, F.col("value") == F.col("_code"), "left_anti")
    return (lost.select(F.lit("department").alias("kind"), "value")
            .unionByName(unknown.select(F.lit("account").alias("kind"), "value")))


def check_sign_totals(recon: DataFrame) -> DataFrame:
    return recon.select("negative_source", "negative_allocation")


# --- output ----------------------------------------------------------------

_PROJECTION = {
    "Date": "date", "Type": "type", "Ref No.": "ref_no", "Contact": "contact",
    "Description": "description", "Note": "note", "Code": "account_code",
    "Account Name": "account_name", "Account": "account", "Reporting Code": "reporting_code",
    "Reporting Account Name": "reporting_account_name", "Reporting Account": "reporting_account",
    "Dept": "dept", "New Dept": "new_dept", "Div": "div", "PC": "pc", "Debit": "debit",
    "Credit": "credit", "Amount": "amount", "Percentage": "percentage", "Allocation": "allocation",
    "Distribution And Allocation": "distribution_and_allocation",
}


def distribution_project(out: DataFrame) -> DataFrame:
    """The 22 output columns in their written spelling; absent ones are null."""
    have = set(out.columns)
    picked = [F.col(_PROJECTION[c]) if _PROJECTION[c] in have else F.lit(None).cast("string")
              for c in K.OUTPUT_COLUMNS]
    return out.select(*[p.alias(K.OUTPUT_HEADERS.get(c, c))
                        for p, c in zip(picked, K.OUTPUT_COLUMNS)])


_STORED = {
    "date": "date", "type": "string", "ref_no": "string", "contact": "string",
    "description": "string", "note": "string", "code": "string", "account_name": "string",
    "account": "string", "reporting_code": "string", "reporting_account_name": "string",
    "reporting_account": "string", "dept_code": "string", "dept": "string",
    "new_dept_code": "string", "new_dept": "string", "dept_div": "string", "pc": "string",
    "debit": "decimal(18,2)", "credit": "decimal(18,2)", "amount": "decimal(18,2)",
    "percentage": "decimal(18,9)", "allocation": "decimal(18,2)",
    "distribution_and_allocation": "string", "method": "string", "gl_line_id": "bigint",
}
_STORED_FROM = {"code": "account_code", "dept_div": "div"}


def distribution_stored(out: DataFrame, run_id, period: str | None = None) -> DataFrame:
    """Output in its stored form; an undated row takes the run's period."""
    have = set(out.columns)
    cols = []
    for name, kind in _STORED.items():
        source = _STORED_FROM.get(name, name)
        value = F.col(source) if source in have else F.lit(None)
        cols.append(value.cast(kind).alias(name))
    month = F.coalesce(F.col("period"), F.lit(period).cast("date"))
    return out.select(*cols, F.lit(run_id).cast("bigint").alias("run_id"), month.alias("period"))


def distribution_run_row(recon: DataFrame, stored: DataFrame, run_id, period: str | None = None,
                         recompute_basis: bool = False) -> DataFrame:
    """Run log row; without a period, the one month the output covers, if one."""
    months = stored.agg(F.min("period").alias("a"), F.max("period").alias("b"))
    single = F.when(F.col("a") == F.col("b"), F.col("a"))
    return _side_by_side(recon, months).select(
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.coalesce(F.lit(period).cast("date"), single).alias("period"),
        F.col("source_total").cast("decimal(20,2)").alias("source_total"),
        F.col("allocated_total").cast("decimal(20,2)").alias("allocated_total"),
        F.col("variance").cast("decimal(20,6)").alias("variance"),
        "n_gl_lines", "n_output_rows", "n_direct", "n_distributed", "n_rejects",
        F.lit(int(recompute_basis)).alias("recompute_basis"))


def distribution_compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """Receiving department totals of two outputs and their difference."""
    def totals(df, name):
        return df.groupBy("new_dept").agg(F.sum("allocation").alias(name))
    both = totals(left, "left_total").join(totals(right, "right_total"), "new_dept", "full")
    gap = F.abs(F.coalesce("left_total", F.lit(0.0)) - F.coalesce("right_total", F.lit(0.0)))
    return both.withColumn("difference", gap)


# --- ledger import ---------------------------------------------------------

def _ledger_month(ledger: DataFrame, period: str) -> DataFrame:
    start = F.lit(period).cast("date")
    return ledger.filter((F.col("date") >= start) & (F.col("date") < F.add_months(start, 1)))


def _ledger_reason() -> Column:
    """First reason a ledger row stays out of the distribution, or null."""
    code = S.strip(F.col("coa_code"))
    group = F.coalesce(F.col("reporting") == K.LEDGER_REPORTING_GROUP, F.lit(False))
    status = F.coalesce(F.col("status").isin(*K.LEDGER_STATUSES), F.lit(False))
    return (F.when(~group, "not_profit_and_loss").when(~status, "status_not_allowed")
            .when(~S.starts_with_any(code, K.LEDGER_PREFIXES), "outside_cost_accounts"))


def gl_import_from_ledger(ledger: DataFrame, master: DataFrame, period: str) -> DataFrame:
    """Ledger rows of a month as distribution lines, under the master's names."""
    names = master.select("dept_code", "dept_name")
    rows = _ledger_month(ledger, period).filter(_ledger_reason().isNull())
    joined = rows.join(names, "dept_code", "left")
    debit = F.coalesce(F.col("debit"), F.lit(0)).cast("decimal(28,12)")
    credit = F.coalesce(F.col("credit"), F.lit(0)).cast("decimal(28,12)")
    return joined.select(
        "date", "type", "ref_no", "contact", "description", "note", "dept_code",
        S.alias(F.coalesce("dept_name", "department"), K.DEPARTMENT_ALIASES).alias("dept"),
        "project", F.col("currency").alias("curr"), debit.alias("debit"), credit.alias("credit"),
        (debit - credit).cast("decimal(28,12)").alias("balance"),
        F.col("coa_code").alias("account_code"),
        S.alias(F.col("coa_name"), K.ACCOUNT_ALIASES).alias("account_name"),
        F.lit(None).cast("string").alias("note2"), F.lit(period).cast("date").alias("period"))


def gl_import_report(ledger: DataFrame, master: DataFrame, period: str) -> DataFrame:
    """One row: ledger rows of the month, rows imported, and of these how many go by
    another department or account name than the ledger has."""
    names = master.select("dept_code", "dept_name")
    rows = _ledger_month(ledger, period).withColumn("_taken", _ledger_reason().isNull()).join(names, "dept_code", "left")
    dept = S.alias(F.coalesce("dept_name", "department"), K.DEPARTMENT_ALIASES)
    account = S.alias(F.col("coa_name"), K.ACCOUNT_ALIASES)
    return rows.agg(
        F.count("*").alias("source_rows"), F.count_if("_taken").alias("imported"),
        F.count_if(F.col("_taken") & ~dept.eqNullSafe(F.col("department"))).alias("departments_renamed"),
        F.count_if(F.col("_taken") & ~account.eqNullSafe(F.col("coa_name"))).alias("accounts_renamed"))


def gl_import_exclusions(ledger: DataFrame, period: str) -> DataFrame:
    """Rows and net per outcome: kept cost, kept revenue, or why left out."""
    net = F.coalesce(F.col("debit"), F.lit(0)) - F.coalesce(F.col("credit"), F.lit(0))
    revenue = S.credit_balance(F.col("coa_code"))
    outcome = F.coalesce(_ledger_reason(), F.when(revenue, "revenue").otherwise("cost"))
    return (_ledger_month(ledger, period)
            .select(outcome.alias("outcome"),
                    F.when(outcome == "revenue", -net).otherwise(net).alias("net"))
            .groupBy("outcome").agg(F.count("*").alias("n"),
                                    F.sum("net").cast("decimal(38,2)").alias("net")))


# --- basis -----------------------------------------------------------------

def _roster(allocation: DataFrame, methods) -> DataFrame:
    a = allocation.select(S.strip(F.col("distribution")).alias("distribution"),
                          S.strip(F.col("new_dept")).alias("new_dept"), "seq")
    return a.filter(F.col("distribution").isin(*methods))


_SCOPE_COLUMN = {"Location": "location", "Location Detail": "location_detail"}


def fte_factors(fte: DataFrame, allocation: DataFrame) -> DataFrame:
    """Headcount share of every receiving department, per headcount method.

    An employee counts for each method whose scope text their location holds;
    that is worked out on the row. A roster department without headcount gets 0.
    """
    inside = []
    for method, (column, token) in K.FTE_SCOPES.items():
        if token is None:
            inside.append(F.lit(method))
        else:
            where = F.lower(F.col(_SCOPE_COLUMN[column]))
            inside.append(F.when(F.contains(where, F.lit(token.lower())), F.lit(method)))
    counted = fte.select(S.strip(F.col("dept")).alias("new_dept"), F.col("hc").cast("double").alias("hc"),
                         F.explode(F.array_compact(F.array(*inside))).alias("distribution"))
    # Staff without a department is in no department's share, nor in the total.
    counted = counted.filter(F.col("new_dept").isNotNull())
    by_dept = counted.groupBy("distribution", "new_dept").agg(F.sum("hc").alias("hc"))
    total = by_dept.groupBy("distribution").agg(F.sum("hc").alias("total"))
    share = by_dept.join(total, "distribution").select(
        "distribution", "new_dept",
        F.when(F.col("total") != 0, F.col("hc") / F.col("total")).otherwise(F.col("hc")).alias("p"))
    return _on_roster(_roster(allocation, list(K.FTE_SCOPES)), share)


def _on_roster(roster: DataFrame, share: DataFrame) -> DataFrame:
    """Roster rows with their share, 0 for those that have none."""
    return roster.join(share, ["distribution", "new_dept"], "left").select(
        "distribution", "new_dept", F.coalesce("p", F.lit(0.0)).alias("percentage"), "seq")


def revenue_factors(rev: DataFrame, allocation: DataFrame) -> DataFrame:
    """Revenue share of every receiving department, per revenue method."""
    columns = {"Percentage HO": "pct_ho", "Percentage All": "pct_all",
               "Percentage Certification Services": "pct_certification_services"}
    pairs = F.array(*[F.struct(F.lit(m).alias("distribution"),
                               F.col(columns[c]).cast("double").alias("p"))
                      for m, c in K.REVENUE_COLUMNS.items()])
    share = (rev.select(S.strip(F.col("div")).alias("new_dept"), F.inline(pairs))
             .groupBy("distribution", "new_dept").agg(F.coalesce(F.sum("p"), F.lit(0.0)).alias("p")))
    return _on_roster(_roster(allocation, list(K.REVENUE_COLUMNS)), share)


def allocation_recompute(allocation: DataFrame, fte: DataFrame, rev: DataFrame) -> DataFrame:
    """Split with headcount and revenue methods refreshed, fixed ones as they are."""
    a = allocation.select(S.strip(F.col("distribution")).alias("distribution"), "account_name",
                          S.strip(F.col("new_dept")).alias("new_dept"),
                          F.col("percentage").cast("double").alias("percentage"), "seq")
    moving = list(K.FTE_SCOPES) + list(K.REVENUE_COLUMNS)
    fixed = a.filter(~F.coalesce(F.col("distribution").isin(*moving), F.lit(False)))
    fresh = fte_factors(fte, allocation).unionByName(revenue_factors(rev, allocation))
    fresh = fresh.select("distribution", F.lit(None).cast("string").alias("account_name"),
                         "new_dept", "percentage", "seq")
    return fixed.unionByName(fresh).withColumn("basis", S.basis_label(F.col("distribution")))


def _drift(refreshed: DataFrame, stored: DataFrame) -> DataFrame:
    def keyed(df, name):
        return df.groupBy(S.strip(F.col("distribution")).alias("method"),
                          S.strip(F.col("new_dept")).alias("new_dept")).agg(
            F.sum("percentage").alias(name))
    both = keyed(stored, "stored").join(keyed(refreshed, "recomputed"), ["method", "new_dept"], "full")
    both = both.na.fill(0.0, ["stored", "recomputed"])
    return both.withColumn("drift", F.abs(F.col("stored") - F.col("recomputed")))


def basis_drift(refreshed: DataFrame, stored: DataFrame) -> DataFrame:
    """Per method, how far the stored split is from what its basis implies."""
    return (_drift(refreshed, stored).groupBy("method")
            .agg(F.count("*").alias("depts"), F.round(F.sum("stored"), 9).alias("sum_stored"),
                 F.max("drift").alias("max_drift"))
            .select("method", S.basis_label(F.col("method")).alias("basis"), "depts", "sum_stored",
                    "max_drift", (F.col("max_drift") <= K.TOLERANCE).alias("in_sync")))


def basis_max_drift(refreshed: DataFrame, stored: DataFrame) -> DataFrame:
    return _drift(refreshed, stored).agg(
        F.coalesce(F.max("drift"), F.lit(0.0)).alias("max_drift"),
        F.count_if(F.col("drift") > K.TOLERANCE).alias("breaches"))


def basis_map_summary(stored: DataFrame, period: str) -> DataFrame:
    return (stored.filter(F.col("period") == F.lit(period).cast("date"))
            .groupBy("basis", "distribution")
            .agg(F.count("*").alias("n"), F.round(F.sum("percentage"), 6).alias("total")))


# --- period lock -----------------------------------------------------------

def period_close(locks: DataFrame, period: str, now, note: str | None = None) -> DataFrame:
    new = locks.sparkSession.range(1).select(
        F.lit(period).cast("date").alias("period"), F.lit("closed").alias("status"),
        F.lit(now).cast("timestamp_ntz").alias("closed_at"), F.lit(note).cast("string").alias("note"))
    other = locks.filter(F.col("period") != F.lit(period).cast("date"))
    return other.select(*new.columns).unionByName(new)


def period_reopen(locks: DataFrame, period: str) -> tuple[DataFrame, DataFrame]:
    """(locks without the period, one row saying whether it was locked)."""
    mine = F.col("period") == F.lit(period).cast("date")
    return locks.filter(~mine), locks.agg(F.coalesce(F.bool_or(mine), F.lit(False)).alias("existed"))


def period_guard(locks: DataFrame, written: DataFrame) -> DataFrame:
    """Closed months among those about to be written."""
    closed = locks.filter(F.col("status") == "closed")
    months = written.select("period").filter("period is not null").distinct()
    return closed.join(months, "period", "left_semi")


def refuse_closed_month(locks: DataFrame | None, period: str, action: str) -> None:
    """Stop a writer of one month (its first day) when the month is closed."""
    if locks is None:
        return
    written = locks.sparkSession.range(1).select(F.lit(period).cast("date").alias("period"))
    refuse_closed(locks, written, action)


def refuse_closed(locks: DataFrame, written: DataFrame, action: str) -> None:
    closed = [str(r.period) for r in period_guard(locks, written).orderBy("period").collect()]
    if closed:
        raise PermissionError(f"period(s) {', '.join(closed)} are closed; refusing to {action}")


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
