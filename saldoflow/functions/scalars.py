"""Column functions shared by every operator. All of them stay in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from saldoflow import constants as K



def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once per row.

    The optimizer substitutes a projected expression into every filter and
    projection above it, so a parsed body or a long array expression would be
    repeated at each use. The output of a generator is not substituted.
    """
    value = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline_outer(F.array(value)))


def nonblank(text: Column) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(text, F.lit(""))


def first_nonblank(*texts: Column) -> Column:
    return F.coalesce(*[nonblank(t) for t in texts])


def to_wib(text: Column) -> Column:
    """ISO text to Jakarta wall-clock time; texts without offset are UTC.

    The session time zone must be UTC, as :func:`saldoflow.session.build` sets.
    """
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text)
    shifted = iso.try_cast("timestamp") + F.expr("INTERVAL 7 HOURS")
    return shifted.cast("timestamp_ntz")


def literal_lookup(key: Column, pairs: dict) -> Column:
    """Value of a small fixed dictionary, null when the key is unknown."""
    chain = None
    for k, v in pairs.items():
        chain = F.when(key == k, F.lit(v)) if chain is None else chain.when(key == k, F.lit(v))
    return chain


def original_currency_amount(amount: Column, rate: Column) -> Column:
    """Amount in its own currency, two places, half to even; rate 0 keeps it."""
    flat = F.coalesce(rate, F.lit(0).cast("decimal(20,8)")) == 0
    value = F.when(flat, amount.cast("decimal(38,9)")).otherwise(
        (amount.cast("decimal(28,9)") / rate.cast("decimal(18,8)")).cast("decimal(38,9)"))
    return F.bround(value, 2).cast("decimal(18,2)")


def account_key(code: Column) -> Column:
    """Short account code of the ledger join: no dashes, no trailing zeros."""
    return F.rtrim(F.replace(code, F.lit("-"), F.lit("")), F.lit("0"))


def account_code_normalise(code: Column) -> Column:
    """Digits only, no trailing zeros; nothing left gives null."""
    return nonblank(F.rtrim(F.regexp_replace(code, r"\D", ""), F.lit("0")))


def name_key(name: Column) -> Column:
    """Matching form of a name: white space collapsed, trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(name, r"(?U)\s+", " ")))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def period_label(day: Column) -> Column:
    return F.upper(F.date_format(day, "MMM-yyyy"))


def period_date(text: Column) -> Column:
    """First day of a month given as ``APR-2026`` (any case) or ``2026-04``."""
    t = F.upper(strip(text))
    month = F.array_position(F.array(*[F.lit(m) for m in K.MONTHS]), F.substring(t, 1, 3))
    named = F.when(t.rlike(r"^[A-Z]{3}-\d{4}$") & (month > 0),
                   F.make_date(F.substring(t, 5, 4).cast("int"), month.cast("int"), F.lit(1)))
    number = F.substring(t, 6, 2).try_cast("int")
    numeric = F.when(t.rlike(r"^\d{4}-\d{2}$") & number.between(1, 12),
                     F.make_date(F.substring(t, 1, 4).try_cast("int"), number, F.lit(1)))
    return F.coalesce(named, numeric)


def period_normalise(text: Column) -> Column:
    return period_label(period_date(text))


def period_previous(text: Column) -> Column:
    return period_label(F.add_months(period_date(text), -1))


def period_month_name_id(text: Column) -> Column:
    names = F.array(*[F.lit(m) for m in K.MONTHS_ID])
    day = period_date(text)
    return F.when(day.isNotNull(), F.get(names, F.month(day) - 1))


def receivable_account(currency: Column) -> Column:
    code = F.upper(strip(F.coalesce(nonblank(currency), F.lit(K.BASE_CURRENCY))))
    return F.when(code == K.BASE_CURRENCY, K.RECEIVABLE_DOMESTIC).otherwise(K.RECEIVABLE_FOREIGN)


def starts_with_any(code: Column, prefixes) -> Column:
    if not prefixes:
        return F.lit(False)
    hits = [F.coalesce(code.startswith(p), F.lit(False)) for p in prefixes]
    return reduce(lambda a, b: a | b, hits)


def credit_balance(code: Column, prefixes=K.CREDIT_PREFIXES) -> Column:
    """True for accounts that naturally carry a credit balance (revenue)."""
    return starts_with_any(code, prefixes)


def basis_label(method: Column) -> Column:
    m = strip(method)
    return (F.when(m.isin(*K.FTE_SCOPES), K.BASIS_FTE)
            .when(m.isin(*K.REVENUE_COLUMNS), K.BASIS_REV)
            .otherwise(K.BASIS_FIXED))


def activity_action(method: Column) -> Column:
    return F.upper(F.coalesce(nonblank(method), F.lit("POST")))


def activity_type(method: Column) -> Column:
    return F.coalesce(literal_lookup(activity_action(method), K.ACTIVITY_BY_METHOD),
                      F.lit("update"))


def alias(name: Column, renames: dict) -> Column:
    """Exact-match rename after trimming."""
    trimmed = strip(name)
    return F.coalesce(literal_lookup(trimmed, renames), trimmed) if renames else trimmed


def endpoint_to_module(end_point: Column) -> Column:
    return literal_lookup(end_point, {e: m for m, e in K.MODULE_ENDPOINTS.items()})


def round_half_even(x: Column, places: int = 2) -> Column:
    """Binary half-to-even rounding of a double (scale, rint, unscale)."""
    scale = float(10 ** places)
    return F.rint(x * F.lit(scale)) / F.lit(scale)
