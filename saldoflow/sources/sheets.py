"""Reference sheets of the cost distribution and the department listing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from saldoflow import constants as K
from saldoflow.functions import scalars as S
from saldoflow.operators import distribution as D
from saldoflow.sources import tables as TB

# Sheet header -> column, with the stored type.
SHEETS = {
    "PC": {"Dept Code": ("dept_code", "string"), "Dept": ("dept", "string"),
           "Div": ("div", "string"), "PC": ("pc", "string")},
    "COA": {"Code": ("code", "string"), "Account Name": ("account_name", "string"),
            "Reporting Code": ("reporting_code", "string"),
            "Reporting Line": ("reporting_line", "string"),
            "Reporting Account": ("reporting_account", "string")},
    "RL": {"Head Code": ("head_code", "string"), "Head Description": ("head_description", "string"),
           "Reporting Line": ("reporting_line", "string"),
           "reporting_line_name": ("reporting_line_name", "string"),
           "reporting_code": ("reporting_code", "string"), "Description": ("description", "string")},
    "LOGIC": {"Account Code": ("account_code", "string"), "Account Name": ("account_name", "string"),
              "PC": ("pc", "string"), "Distribution": ("distribution", "string"),
              "Code": ("code", "string")},
    "ALLOCATION": {"Distribution": ("distribution", "string"), "Basis": ("basis", "string"),
                   "Account Name": ("account_name", "string"), "New Dept": ("new_dept", "string"),
                   "Percentage": ("percentage", "double")},
    "FTE": {"FTE": ("fte", "double"), "HC": ("hc", "double"), "Name": ("name", "string"),
            "Employee_No.": ("employee_no", "string"), "Dept": ("dept", "string"),
            "Div": ("div", "string"), "PC": ("pc", "string"), "Location": ("location", "string"),
            "Location Detail": ("location_detail", "string")},
    "REV": {"Div": ("div", "string"), "PC": ("pc", "string"), "Location": ("location", "string"),
            "Amount": ("amount", "double"),
            "Percentage Certification Services": ("pct_certification_services", "double"),
            "Percentage HO": ("pct_ho", "double"), "Percentage All": ("pct_all", "double")},
    "GL": {"Dept Code": ("dept_code", "string"), "Date": ("date", "date"), "Type": ("type", "string"),
           "Ref No.": ("ref_no", "string"), "Contact": ("contact", "string"),
           "Description": ("description", "string"), "Note": ("note", "string"),
           "Dept": ("dept", "string"), "Project": ("project", "string"), "Curr": ("curr", "string"),
           "Debit": ("debit", "double"), "Credit": ("credit", "double"),
           "Balance": ("balance", "double"), "Account Code": ("account_code", "string"),
           "Account Name": ("account_name", "string"), "Note2": ("note2", "string")},
}
GLOBAL_SHEETS = ("PC", "COA", "LOGIC", "RL")
OPTIONAL_SHEETS = ("RL",)


def from_headers(raw: DataFrame, sheet: str) -> DataFrame:
    """Sheet columns by trimmed header; a header an older layout lacks is null.

    The chart's label column is left out instead, so that it gets derived.
    Codes stay text; a measure that is not a number fails the read.
    """
    have = {c.strip(): F.col(f"`{c}`") for c in raw.columns}
    out = [(have[h] if h in have else F.lit(None)).cast(t).alias(n)
           for h, (n, t) in SHEETS[sheet].items() if h in have or h != "Reporting Account"]
    if "seq" in have:
        out.append(have["seq"].cast("bigint").alias("seq"))
    else:
        out.append(F.monotonically_increasing_id().alias("seq"))
    return raw.select(*out)


def to_headers(sheet: DataFrame, name: str) -> DataFrame:
    """Columns under their headers, and ``seq``, the order of the rows, where there is one."""
    columns = [F.col(n).alias(h) for h, (n, _) in SHEETS[name].items() if n in sheet.columns]
    return sheet.select(*columns, *(["seq"] if "seq" in sheet.columns else []))


def sheet_tables_read(spark: SparkSession, folder: str, names=None, fmt: str = "csv") -> dict:
    """Read one folder of sheet files; RL may be absent.

    The order of rows matters: a sheet in several files needs a stored ``seq``.
    """
    out = {}
    for name in (SHEETS if names is None else names):
        path = f"{folder}/{name}"
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        try:
            raw = reader.format(fmt).load(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            if name in OPTIONAL_SHEETS:
                continue
            raise ValueError(f"{folder} has no sheet {name!r}") from e
        if "seq" not in [c.strip() for c in raw.columns] and len(raw.inputFiles()) > 1:
            raise ValueError(f"sheet {name!r} of {folder} has several files and no seq that orders its rows")
        out[name] = from_headers(raw, name)
    return out


def department_listing_read(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated department listing; a repeated code or name is an error."""
    from saldoflow.operators import departments

    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    listing = departments.department_listing_clean(raw)
    bad = departments.department_duplicates(listing).limit(10).collect()
    if bad:
        raise ValueError(f"duplicate department(s): {[(r['kind'], r['value']) for r in bad]}")
    return listing


def basis_stored_form(sheet: DataFrame, name: str) -> DataFrame:
    """What seeding stores: basis label on the split, current account names."""
    if name == "ALLOCATION":
        return sheet.withColumn("basis", F.coalesce(F.col("basis"), S.basis_label(F.col("distribution"))))
    if name == "COA":
        return sheet.withColumn("account_name", S.alias(F.col("account_name"), K.ACCOUNT_ALIASES))
    return sheet


def basis_seed(sheets: dict, stored: dict, period: str, refresh_global: bool = False,
               locks: DataFrame | None = None) -> tuple:
    """(tables after seeding, sheets written).

    Monthly tables replace the period's rows; policy tables are only filled when
    empty unless forced. A closed month is refused.
    """
    D.refuse_closed_month(locks, period, "seed the basis")
    tables, written = dict(stored), []
    for name in SHEETS:
        if name == "GL":
            continue
        old = stored.get(name)
        if name in GLOBAL_SHEETS and old is not None and not refresh_global and not old.isEmpty():
            continue
        if name not in sheets:
            if name in OPTIONAL_SHEETS:
                continue
            raise ValueError(f"no sheet {name!r}")
        new = basis_stored_form(sheets[name], name)
        if name in GLOBAL_SHEETS:
            tables[name] = new
        elif old is None:
            tables[name] = new.withColumn("period", F.lit(period).cast("date"))
        else:
            tables[name] = TB.replace_period(old, new, period)
        written.append(name)
    return tables, written


def basis_read(stored: dict, period: str, name: str) -> DataFrame:
    """One basis table in sheet form: policy tables whole, monthly by period."""
    table = stored[name]
    if name in GLOBAL_SHEETS:
        return table
    return table.filter(F.col("period") == F.lit(period).cast("date")).drop("period")


def require_rows(table: DataFrame, name: str, where: str) -> DataFrame:
    if name not in OPTIONAL_SHEETS and table.isEmpty():
        raise ValueError(f"no rows for sheet {name!r} at {where}; seed it first")
    return table


def allocation_persist(stored: DataFrame, refreshed: DataFrame, period: str,
                       locks: DataFrame | None = None) -> DataFrame:
    """Split table with one period's rows replaced by a refreshed split, unless it is closed."""
    D.refuse_closed_month(locks, period, "persist the split")
    return TB.replace_period(stored, basis_stored_form(refreshed, "ALLOCATION"), period)


def gl_entry_seed_sheet(gl: DataFrame, stored: DataFrame, period: str,
                        locks: DataFrame | None = None) -> DataFrame:
    """Ledger lines of the period from the sheet, under current names.

    A closed month and a month without lines are refused.
    """
    D.refuse_closed_month(locks, period, "seed ledger lines")
    month = D.in_period(gl, period)
    if month.isEmpty():
        raise ValueError(f"the sheet has no ledger line in the month of {period}")
    rows = (month
            .withColumn("account_name", S.alias(F.col("account_name"), K.ACCOUNT_ALIASES))
            .withColumn("dept", S.alias(F.col("dept"), K.DEPARTMENT_ALIASES)))
    return TB.replace_period(stored, rows, period)


def gl_entry_read(stored: DataFrame, period: str) -> DataFrame:
    """Stored ledger lines of a month; a month that was never seeded is an error."""
    month = stored.filter(F.col("period") == F.lit(period).cast("date")).drop("period")
    if month.isEmpty():
        raise ValueError(f"no ledger lines stored for the month of {period}; seed or import it first")
    return month
