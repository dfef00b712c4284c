"""The data-quality gate: every check of a table in one aggregation, plus the quarantine split."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalyst.contracts import Contract
from medalyst.operators.dedupe import duplicate_keys

FRESHNESS_DAYS = 2
MIN_ROWS = 100

RESULT_COLUMNS = ("table_name", "check_name", "check_type", "failed_rows", "total_rows", "status", "severity")


def batch_slice(df: DataFrame, start: str | None, end: str | None, column: str = "bronze_ingestion_ts",
                fmt: str = "yyyyMMddHHmmss", date_column: str = "bronze_date") -> DataFrame:
    """Rows with ``start <= column < end``; without both bounds the whole table.

    Where the table is laid out by ``date_column`` (the date of ``column``), only the folders of those dates are read.
    """
    if not (start and end):
        return df
    bound = lambda text: F.to_timestamp(F.lit(text), fmt).cast(df.schema[column].dataType)
    inside = (F.col(column) >= bound(start)) & (F.col(column) < bound(end))
    if date_column in df.columns and date_column != column:
        inside = inside & F.col(date_column).between(F.to_date(bound(start)), F.to_date(bound(end)))
    return df.where(inside)


def clean_table_name(name: str | None) -> str:
    return "unknown_table" if name is None else name.strip().lower()


def schema_drift(df: DataFrame, expected: Sequence[str]) -> tuple[set[str], set[str]]:
    """(missing, unexpected) column names."""
    have, want = set(df.columns), set(expected)
    return want - have, have - want


def drift_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Drifted columns with the rows they concern: values held by an unexpected one, all rows for a missing one."""
    missing, unexpected = schema_drift(df, expected)
    found = [(c, "unexpected", F.count(F.col(c))) for c in sorted(unexpected)]
    found += [(c, "missing", F.count(F.lit(1))) for c in sorted(missing)]
    if not found:
        return df.sparkSession.createDataFrame([], "column_name string, drift string, n_rows bigint")
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kind).alias("drift"), F.col(f"d{i}").alias("n_rows"))
                     for i, (c, kind, _) in enumerate(found)])
    counts = df.agg(*[n.alias(f"d{i}") for i, (_, _, n) in enumerate(found)])
    return counts.select(F.explode(rows).alias("d")).select("d.*")


def type_drift(df: DataFrame, contract: Contract) -> dict[str, tuple[str, str]]:
    """Columns whose type differs from the contract: name to (expected, found)."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    return {f.name: (f.dataType.simpleString(), found[f.name]) for f in contract.bronze
            if f.name in found and found[f.name] != f.dataType.simpleString()}


def days_since(newest: Column, now: Column) -> Column:
    """Whole days from the newest row to now; NULL without a row."""
    return F.floor(F.timestamp_diff("SECOND", newest, now) / F.lit(86400))


def is_stale(newest: Column, now: Column) -> Column:
    """True for an empty table, and beyond ``FRESHNESS_DAYS`` whole days."""
    return newest.isNull() | (days_since(newest, now) > FRESHNESS_DAYS)


def is_empty(n_rows: Column) -> Column:
    return n_rows == 0


def is_small(n_rows: Column, least: int = MIN_ROWS) -> Column:
    return n_rows < least


def check_results(df: DataFrame, contract: Contract, as_of: Column | datetime | None = None,
                  table: str | None = None, ingest_column: str = "bronze_ingestion_ts",
                  full_table: DataFrame | None = None, types: bool = False) -> DataFrame:
    """One row per check. Reads ``df`` twice: once for all row rules, the row count and the
    newest load, once for the key counts.

    Rules over columns the table lacks are left out; the drift check reports them.
    With ``full_table`` the emptiness and volume checks count that table instead of the batch. With ``types`` one more
    check counts the columns whose type is not the contract's.
    """
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    name = clean_table_name(table or f"{contract.entity}_raw")
    dated = df.withColumn("_today", now.cast("date"))
    rules = [r for r in contract.rules if set(r.reads.split()) <= set(df.columns)]

    measures = [F.count_if(r.fails()).alias(f"r{i}") for i, r in enumerate(rules)]
    duplicates = duplicate_keys(df, [contract.key]).select(F.count(F.lit(1)))
    stats = dated.agg(F.count(F.lit(1)).alias("n"), F.max(ingest_column).alias("newest"), *measures)
    volume = F.col("n") if full_table is None else full_table.select(F.count(F.lit(1))).scalar()

    missing, unexpected = schema_drift(df, contract.bronze.names)
    checks = [
        ("schema_exact_match", "schema_check", F.lit(int(bool(missing or unexpected))), "CRITICAL"),
        *([("schema_types_match", "schema_check", F.lit(len(type_drift(df, contract))), "CRITICAL")] if types else []),
        ("table_not_empty", "table_check", is_empty(volume).cast("int"), "CRITICAL"),
        (f"{contract.key}_unique", "duplicate_check", duplicates.scalar(), "CRITICAL"),
        *[(r.name, r.kind, F.col(f"r{i}"), r.severity) for i, r in enumerate(rules)],
        (contract.freshness_check, "freshness_check", is_stale(F.col("newest"), now).cast("int"), "CRITICAL"),
        ("volume_reasonable_min_threshold", "volume_check", is_small(volume).cast("int"), "WARNING"),
    ]
    rows = F.array(*[
        F.struct(F.lit(check).alias("check_name"), F.lit(kind).alias("check_type"),
                 failed.cast("bigint").alias("failed_rows"), F.lit(severity).alias("severity"))
        for check, kind, failed, severity in checks])
    long = stats.select(F.col("n").alias("total_rows"), F.explode(rows).alias("c")).select("total_rows", "c.*")
    return long.select(
        F.lit(name).alias("table_name"), "check_name", "check_type", "failed_rows", "total_rows",
        F.when(F.col("failed_rows") == 0, "PASS").otherwise("FAIL").alias("status"), "severity")


def log_results(results: DataFrame, path: str, run_ts: Column | None = None) -> None:
    """Append one run's check results to the log, stamped with the run."""
    results.select(*RESULT_COLUMNS, (F.current_timestamp() if run_ts is None else run_ts).cast("timestamp").alias("run_ts")).write.mode("append").parquet(path)


def latest_results(log: DataFrame) -> DataFrame:
    """The newest run's row of each table and check; the log may hold any number of runs."""
    rest = [c for c in log.columns if c not in ("table_name", "check_name")]
    newest = log.groupBy("table_name", "check_name").agg(F.max_by(F.struct(*rest), F.struct("run_ts", "failed_rows")).alias("r"))
    return newest.select("table_name", "check_name", *[F.col(f"r.{c}").alias(c) for c in rest])


def with_validity(df: DataFrame, contract: Contract, as_of: Column | datetime | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    return df.withColumn("is_valid", contract.valid(now.cast("date")))


def quarantined(flagged: DataFrame, undecided_is_bad: bool = True) -> DataFrame:
    """Rows that failed. An undecided (NULL) verdict is bad unless told otherwise."""
    verdict = F.coalesce("is_valid", F.lit(False)) if undecided_is_bad else F.col("is_valid")
    return flagged.where(~verdict)


def accepted(flagged: DataFrame, key: str, undecided_is_bad: bool = True, by_key: bool = True) -> DataFrame:
    """Rows let through.

    ``by_key`` drops every version of a key that has a bad version; otherwise only
    the bad rows go. With ``undecided_is_bad`` rows without a key go as well.
    """
    bad = quarantined(flagged, undecided_is_bad)
    if not by_key:
        verdict = F.coalesce("is_valid", F.lit(not undecided_is_bad))
        return flagged.where(verdict).drop("is_valid")
    kept = flagged.join(bad.select(key).distinct(), key, "left_anti")
    return (kept.where(F.col(key).isNotNull()) if undecided_is_bad else kept).drop("is_valid")


def health_score(df: DataFrame, required: Sequence[str], status: str, healthy: Sequence[str]) -> DataFrame:
    """Share of rows with all ``required`` columns set and a healthy status."""
    good = F.col(status).isin(*healthy)
    for c in required:
        good = good & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("total_records"), F.count_if(good).alias("valid_records")).withColumn(
        "overall_health_pct", F.round(F.try_divide(F.col("valid_records") * 100.0, "total_records"), 2))
