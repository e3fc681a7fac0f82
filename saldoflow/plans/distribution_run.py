"""One cost distribution run, from ledger lines to gated output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from saldoflow.operators import distribution as D
from saldoflow.operators.ordering import global_position
from saldoflow.session import settle
from saldoflow.sources import tables as TB


@dataclass
class Lookups:
    by_name: DataFrame
    by_code: DataFrame
    reporting: DataFrame
    rules: DataFrame
    split: DataFrame
    swept: DataFrame


def build_lookups(sheets: dict) -> Lookups:
    """Sheet lookups, stored once; an ambiguous rule key is refused.

    Every join of the run reads them, and a stored table has a known size, which
    is what decides whether it is broadcast.
    """
    doubled = D.logic_duplicates(sheets["LOGIC"]).limit(10).collect()
    if doubled:
        raise ValueError(f"ambiguous rule keys (account code, account name, bucket): {doubled}")
    by_name, by_code = D.pc_lookup(sheets["PC"])
    lookups = {"by_name": by_name, "by_code": by_code,
               "reporting": D.coa_reporting_lookup(sheets["COA"]),
               "rules": D.logic_rules(sheets["LOGIC"]),
               "split": D.allocation_split(sheets["ALLOCATION"]),
               "swept": D.swept_departments(sheets["PC"])}
    return Lookups(**{name: settle(df, name) for name, df in lookups.items()})


def resolve(gl: DataFrame, lk: Lookups) -> DataFrame:
    lines = D.line_amount(gl)
    lines = D.bucket_resolve(lines, lk.by_name, lk.by_code)
    lines = D.reporting_resolve(lines, lk.reporting)
    return D.rule_resolve(lines, lk.rules)


def number_lines(gl: DataFrame) -> DataFrame:
    """Lines with their position in ledger order."""
    return global_position(gl, ["seq"], "gl_line_id")


def checked_weights(lk: Lookups) -> DataFrame:
    weights = settle(D.overhead_weights(lk.split, lk.swept), "weights")
    total = weights.agg({"weight": "sum"}).head()[0]
    if not total or total <= 0:
        raise ValueError("the overhead sweep has no receiving department with a share")
    return weights


@dataclass
class Run:
    resolved: DataFrame
    charged: DataFrame
    base: DataFrame
    overhead: DataFrame | None
    out: DataFrame
    rejects: DataFrame
    recon: DataFrame


def distribute(gl: DataFrame, sheets: dict, period: str | None = None, overhead: bool = True,
               recompute_basis: bool = False, keep: bool = True) -> Run:
    """The whole chain as DataFrames. ``gl`` has ``gl_line_id`` (see number_lines).

    The charged rows feed the output, the sweep, the totals and the line gate;
    with ``keep`` they are stored once instead of being joined anew for each.
    """
    if period is not None:
        gl = D.gl_period_filter(gl, period)
        if gl.isEmpty():
            raise ValueError(f"no ledger lines dated in the month of {period}")
    if recompute_basis:
        sheets = {**sheets, "ALLOCATION": settle(D.allocation_recompute(
            sheets["ALLOCATION"], sheets["FTE"], sheets["REV"]), "allocation")}
    lk = build_lookups(sheets)
    resolved = resolve(gl, lk)
    charged = D.charge(resolved, lk.split)
    charged = settle(charged, "charged") if keep else charged
    rejects = D.charge_rejects(charged)
    base = D.receiver_enrich(charged.filter("kind <> 'reject'"), lk.by_name, lk.by_code)
    swept = None
    if overhead:
        swept = D.overhead_sweep(base, checked_weights(lk), lk.swept, lk.by_name, lk.by_code,
                                 lk.reporting)
    out = base if swept is None else D.union_all(base, swept)
    recon = D.recon_summary(resolved, charged, swept)
    return Run(resolved, charged, base, swept, out, rejects, recon)


def validate(run: Run) -> DataFrame:
    """The reconciliation row; a run that does not tie out is stopped here."""
    failed = [r["gate"] for r in D.gates(run.recon, run.charged).filter("not ok").collect()]
    if failed:
        raise ValueError(f"distribution does not reconcile: {', '.join(sorted(failed))}")
    return run.recon


def write(run: Run, recon: DataFrame, folder: str) -> None:
    """Distribution, reconciliation and, if there are any, rejects."""
    D.distribution_project(run.out).write.mode("overwrite").parquet(f"{folder}/Distribution")
    reconciliation(recon).write.mode("overwrite").parquet(f"{folder}/Reconciliation")
    if not run.rejects.isEmpty():
        run.rejects.write.mode("overwrite").parquet(f"{folder}/rejects")


def reconciliation(recon: DataFrame) -> DataFrame:
    names = {"source_total": "Source Total", "allocated_total": "Allocated Total",
             "variance": "Variance", "n_gl_lines": "GL Lines", "n_output_rows": "Output Rows",
             "n_direct": "Direct", "n_distributed": "Distributed", "n_overhead": "Overhead",
             "overhead_pool": "Overhead Pool", "n_rejects": "Rejects"}
    return recon.select(*names).withColumnsRenamed(names)


def snapshot_replace(stored: DataFrame, run: Run, recon: DataFrame, locks: DataFrame, run_id: int,
                     period: str | None = None, recompute_basis: bool = False):
    """(snapshot, run row) with exactly the months of the output replaced."""
    rows = D.distribution_stored(run.out, run_id, period)
    D.refuse_closed(locks, rows, "write the distribution")
    row = D.distribution_run_row(recon, rows, run_id, period, recompute_basis)
    return TB.replace_seen_periods(stored, rows), row


def import_month(ledger: DataFrame, master: DataFrame, stored: DataFrame, period: str,
                 locks: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(distribution lines with the month replaced from the ledger, report row).

    A closed month and a month without any row to import are refused before anything is
    replaced.
    """
    D.refuse_closed_month(locks, period, "import ledger lines")
    rows = settle(D.gl_import_from_ledger(ledger, master, period), "import")
    if rows.isEmpty():
        raise ValueError(f"the ledger has no row to import in the month of {period}")
    return TB.replace_period(stored, rows, period), D.gl_import_report(ledger, master, period)
