"""Run the model DAG (or the dependency closure of some targets) as Spark jobs.

``stg_transactions`` is written once, partitioned by transaction month: every
later read prunes months.  The staged and reconciled series that other models
read are written once a run to scratch; other staging and intermediate models
are lazy views.  An incremental run rewrites the staged months in which anything
changed, whatever their age, and upserts recent months of the monthly mart; the
other marts are written whole.  Raw batches are gated, and each model's checks run once it is
built; a failed check of severity "error" raises ``DataQualityError``, so no
downstream model reads bad rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import month_start
from ..quality.checks import DataQualityError, Unique, evaluate, newest_partition
from ..quality.quarantine import sends_away, split_rows
from ..quality.suites import RAW_GATES, SUITES
from ..sinks.publish import publish_partitions, recover
from ..sinks.writers import has_data, materialize, write_partitioned
from . import enrich, marts, rates, staging
from .changed import MartRefresh, PendingMonths
from .incremental import run_monthly_incremental
from .ledger import RUN_DATE, VersionLedger, load_versions

# model -> upstream models / raw inputs
DAG: dict[str, tuple[str, ...]] = {
    "stg_transactions": ("raw:transactions",),
    "stg_rates": ("raw:rates",),
    "stg_yields": ("raw:yields",),
    "stg_rate_events": ("raw:rate_events",),
    "int_rates_reconciled": ("stg_rates", "stg_rate_events"),
    "int_transactions_with_rates": ("stg_transactions", "int_rates_reconciled", "stg_yields"),
    "monthly_transactions_by_region": ("int_transactions_with_rates",),
    "rate_change_events": ("int_rates_reconciled",),
    "rate_lag_analysis": ("monthly_transactions_by_region", "int_rates_reconciled"),
    "regional_sensitivity": ("rate_lag_analysis",),
}
TABLES = {"stg_transactions", "monthly_transactions_by_region", "rate_change_events",
          "rate_lag_analysis", "regional_sensitivity"}
# what each source's scheduled load refreshes; the marts only on full runs
SCHEDULES: dict[str, tuple[str, ...]] = {
    "transactions": ("stg_transactions", "stg_rates", "stg_yields", "stg_rate_events"),
    "rates": ("stg_rates", "int_rates_reconciled", "rate_change_events"),
    "yields": ("stg_yields", "int_transactions_with_rates"),
}


def raw_inputs(targets: Iterable[str] | None, have: Iterable[str] = ()) -> list[str]:
    """Raw inputs that ``targets`` and what lies upstream of them read; tables
    in ``have`` are read as they are and need nothing."""
    need = {d for m in closure(targets, have) for d in DAG[m] if d.startswith("raw:") and m not in have}
    return sorted(d[4:] for d in need)


def closure(targets: Iterable[str] | None, have: Iterable[str] = ()) -> list[str]:
    """Targets plus everything upstream, in dependency order; nothing upstream
    of a table in ``have``."""
    wanted: set[str] = set()

    def visit(m: str):
        if m in wanted or m.startswith("raw:"):
            return
        if m not in have:
            for d in DAG[m]:
                visit(d)
        wanted.add(m)

    for t in (targets or DAG):
        visit(t)
    return [m for m in DAG if m in wanted]


@dataclass
class PipelineResult:
    paths: dict[str, str] = field(default_factory=dict)
    checks: dict[str, list] = field(default_factory=dict)
    quarantined: dict[str, str] = field(default_factory=dict)  # raw input or model -> table of its bad rows


def run_pipeline(spark: SparkSession, raw: dict[str, DataFrame], out_root: str,
                 targets: Iterable[str] | None = None, county_map=None,
                 raw_suites: dict | None = None, check: bool = True,
                 lags=(1, 2, 3, 6), min_months: int = 12,
                 incremental: bool = True, overlap_months: int = 1,
                 on_failure: str = "raise", reuse_tables: bool = False,
                 change_driven: bool = False) -> PipelineResult:
    """Build ``targets`` (default: all models) and their upstream models.

    ``raw``: DataFrames for ``transactions``, ``rates``, ``rate_events``,
    ``yields`` (only those the closure needs).  With ``check`` the newest
    landed batch of each gated raw input (``raw_suites``, default
    ``RAW_GATES``) is validated before staging and every model, view or table,
    after it is built.  ``on_failure='warn'`` records failed checks in the
    result instead of raising.  ``on_failure='quarantine'`` sets bad rows of the
    gated raw inputs and of staging and intermediate models aside, with the checks
    they fail, below ``quarantine/``; models downstream read the good rows.  What
    no row can be blamed for (counts, columns, shares) and bad rows of marts still
    raise.  Raw rows are judged one by one there: uniqueness of a raw input raises.
    ``incremental``, where a table of earlier runs
    exists, rewrites changed months only when staging, and upserts the monthly
    mart from ``overlap_months`` before its newest month.  ``transactions``
    always holds all landed rows; with a ``run_date`` column it grows by later
    run dates only, without one staged rows that it lacks go.  ``change_driven``
    rebuilds the marts for the months that changed, of any age, instead of the
    cutoff's (see ``changed.MartRefresh``).  ``reuse_tables`` reads
    tables upstream of the targets as earlier runs left them (a scheduled load
    of one source).  Returns the written table paths and check results.
    """
    out_root = out_root.rstrip("/")
    for table in TABLES:  # what a lost run left half-published
        recover(spark, f"{out_root}/{table}")
    targets = list(targets) if targets else list(DAG)
    have = {m for m in TABLES - set(targets) if reuse_tables and has_data(spark, f"{out_root}/{m}")}
    needed = raw_inputs(targets, have)
    if on_failure not in ("raise", "warn", "quarantine"):
        raise ValueError(f"unknown on_failure: {on_failure}")
    if missing := [n for n in needed if n not in raw]:
        raise ValueError(f"raw inputs missing: {', '.join(missing)}")
    res = PipelineResult()
    frames: dict[str, DataFrame] = {}
    pending = PendingMonths(spark, out_root)  # staged anew, not yet in the marts
    refresh = None

    def checked(name: str, df: DataFrame, suite, spared=()) -> list:
        """The checks of ``spared`` (which may be set aside) that failed."""
        if not (check and suite):
            return []
        res.checks[name], errors = evaluate(df, suite)
        if on_failure == "quarantine":
            failed = [c for c, r in zip(suite, res.checks[name]) if c in spared and not r["success"]]
            errors = [r for c, r in zip(suite, res.checks[name])
                      if not r["success"] and c.severity != "warn" and c not in spared]
        if errors and on_failure != "warn":
            raise DataQualityError(errors)
        return failed if on_failure == "quarantine" else []

    def set_aside(name: str, bad: DataFrame, load: str = "all") -> None:
        # one folder a load: a lost run that is done again writes its own anew
        res.quarantined[name] = f"{out_root}/quarantine/{name}"
        bad.write.mode("overwrite").parquet(f"{res.quarantined[name]}/load={quote(load, safe='')}")

    raw = dict(raw)
    for name, suite in (RAW_GATES if raw_suites is None else raw_suites).items():
        if name in needed:
            landed = raw[name]
            single = [c for c in suite if sends_away(c) and not isinstance(c, Unique)]
            if "run_date" in landed.columns:  # validate the newest landed batch only
                landed = newest_partition(landed, "run_date")
            checked(f"raw_{name}", landed, suite, single)
            if check and on_failure == "quarantine" and single:
                unread, load = raw[name], "all"
                if name == "transactions" and RUN_DATE in unread.columns and incremental:
                    # staging reads later run dates only; so does this
                    ledger = VersionLedger(spark, f"{out_root}/stg_transactions__versions")
                    unread, load = ledger.unread(unread), ledger.mark() or "first"
                set_aside(f"raw_{name}", split_rows(unread, single)[1], load)
                raw[name] = split_rows(raw[name], single)[0]

    def staged(path: str) -> DataFrame:
        return spark.read.parquet(path).drop("transaction_month")

    def once(name: str, df: DataFrame) -> DataFrame:
        """A series that its checks and the models downstream read: worked out once a run."""
        readers = [m for m in closure(targets, have) if m not in have and name in DAG[m]]
        return materialize(df, name) if readers else df

    clean: dict[str, list] = {}  # model -> failed checks whose rows are set aside

    def enriched(since):
        t = spark.read.parquet(f"{out_root}/stg_transactions")
        if clean.get("stg_transactions"):
            t = split_rows(t, clean["stg_transactions"])[0]
        if since is not None:  # partition pruning on the staged table
            t = t.filter(F.col("transaction_month") >= F.lit(since))
        return enrich.int_transactions_with_rates(
            t.drop("transaction_month"), frames["int_rates_reconciled"], frames["stg_yields"])

    for m in closure(targets, have):
        path = f"{out_root}/{m}"
        if m in have:
            frames[m] = staged(path) if m == "stg_transactions" else spark.read.parquet(path)
            continue
        if m == "stg_transactions":
            stage_transactions(spark, raw["transactions"], path, county_map, incremental, pending.add)
            frames[m] = staged(path)
        elif m == "stg_rates":
            frames[m] = once(m, staging.stg_rates(raw["rates"]))
        elif m == "stg_yields":
            frames[m] = once(m, staging.stg_yields(raw["yields"]))
        elif m == "stg_rate_events":
            frames[m] = once(m, staging.stg_rate_events(raw["rate_events"]))
        elif m == "int_rates_reconciled":
            frames[m] = once(m, rates.int_rates_reconciled(frames["stg_rates"], frames["stg_rate_events"]))
        elif m == "int_transactions_with_rates":
            if m not in targets:  # the monthly mart makes its own, of recent months
                continue
            frames[m] = enriched(None)
        elif m == "monthly_transactions_by_region":
            if change_driven:
                refresh = MartRefresh(spark, out_root, frames["int_rates_reconciled"], frames["stg_yields"], lags)
                refresh.monthly(pending.months())
            elif incremental:
                run_monthly_incremental(spark, enriched, path, overlap_months)
            else:
                write_partitioned(marts.monthly_transactions_by_region(enriched(None)), path,
                                  "month", ["region", "property_type"])
            frames[m] = spark.read.parquet(path)
        elif m == "rate_change_events":
            rates.rate_change_events(frames["int_rates_reconciled"]).write.mode("overwrite").parquet(path)
            frames[m] = spark.read.parquet(path)
        elif m == "rate_lag_analysis" and refresh:
            refresh.lag()
            pending.clear()
            frames[m] = spark.read.parquet(path)
        elif m == "regional_sensitivity" and refresh and not refresh.lag_months and has_data(spark, path):
            frames[m] = spark.read.parquet(path)
        elif m == "rate_lag_analysis":
            write_partitioned(marts.rate_lag_analysis(frames["monthly_transactions_by_region"],
                                                      frames["int_rates_reconciled"], lags), path, "month", ["region"])
            frames[m] = spark.read.parquet(path)
        elif m == "regional_sensitivity":
            marts.regional_sensitivity(frames["rate_lag_analysis"], min_months).write.mode("overwrite").parquet(path)
            frames[m] = spark.read.parquet(path)
        suite = SUITES.get(m, ())
        spared = [c for c in suite if sends_away(c)] if m.startswith(("stg_", "int_")) else []
        if failed := checked(m, frames[m], suite, spared):
            clean[m] = failed
            frames[m], bad = split_rows(frames[m], failed)
            set_aside(m, bad)
        if m in TABLES:
            res.paths[m] = path
    return res


def stage_transactions(spark: SparkSession, raw: DataFrame, path: str, county_map=None,
                       incremental: bool = True, note=None) -> list | None:
    """Write the staged transactions, partitioned by month; returns the months
    that were rewritten (``None``: all).

    Raw rows with a ``run_date`` go through the version ledger
    (``ledger.load_versions``): only later run dates than before are read.
    Without one nothing tells new rows from old: all of ``raw`` is staged again,
    compared with the table row by row, and only months in which a row came,
    changed or went are rewritten."""
    if RUN_DATE in raw.columns:
        return load_versions(spark, raw, path, county_map, incremental, note)
    note = note or (lambda months: None)
    month, cluster = "transaction_month", ["region", "property_type"]
    staged = staging.stg_transactions(raw, county_map=county_map)
    fresh = staged.withColumn(month, month_start("transaction_date"))
    if not incremental or not has_data(spark, path):
        note(None)
        write_partitioned(fresh, path, month, cluster, split_cols=["transaction_id"])
        return None
    old = spark.read.parquet(path).select(*fresh.columns)
    # ids are unique on both sides: 1 is a new row, -1 a row that went or changed
    sides = fresh.withColumn("_side", F.lit(1)).unionByName(old.withColumn("_side", F.lit(-1)))
    changed = materialize(sides.groupBy(*fresh.columns).agg(F.sum("_side").alias("_side")).filter("_side <> 0"),
                          "stg_changed")
    months = changed.select(month).distinct()
    stale = changed.filter("_side < 0").select(F.col("transaction_id").alias("_stale"))
    kept = (old.join(months, month, "left_semi")
            .join(stale, F.col("transaction_id").eqNullSafe(F.col("_stale")), "left_anti"))
    rows = kept.unionByName(changed.filter("_side > 0").drop("_side"))
    touched = sorted(r[0] for r in months.collect())  # bounded by the calendar
    note(touched)
    publish_partitions(spark, rows, path, month, cluster, ["transaction_id"], drop=touched)
    return touched
