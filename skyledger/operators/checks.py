"""Freshness and run checks; each gives rows ``(name, severity, detail)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.ages import age_seconds, age_severity, age_text, severity_name, severity_rank
from skyledger.functions.rounding import round_exact

# Age limits in seconds.
ELEMENT_WARNING_SECONDS, ELEMENT_CRITICAL_SECONDS = 64_800, 129_600
CATALOGUE_WARNING_SECONDS, CATALOGUE_CRITICAL_SECONDS = 129_600, 259_200
MEBIBYTE = 1024.0**2


def dataset_checks(
    expected: DataFrame, states: DataFrame, as_of: Column, *,
    warning: int = ELEMENT_WARNING_SECONDS, critical: int = ELEMENT_CRITICAL_SECONDS,
) -> DataFrame:
    """One check per expected dataset, on the age of its last publication."""

    found = states.select("dataset", "last_success", "error", F.lit(True).alias("_found"))
    rows = expected.join(found, "dataset", "left")
    age = age_seconds(F.col("last_success"), as_of)
    by_age = age_severity(age, warning=warning, critical=critical)
    reason = F.when(by_age != "ok", F.nullif(F.col("error"), F.lit("")))
    detail = F.concat_ws("; last error: ", age_text(age), reason)
    missing = F.col("_found").isNull()
    return rows.select(
        F.concat(F.lit("gp:"), "dataset").alias("name"),
        F.coalesce(by_age, F.lit("critical")).alias("severity"),
        F.when(missing, "no status row")
        .when(age.isNull(), "never published")
        .otherwise(detail).alias("detail"),
    )


def run_verdict(as_of: Column) -> tuple[Column, Column]:
    """Severity and detail of a run summary row.

    A refusal outranks a spent allowance, which outranks failed subsets, which
    outrank age. A summary without ``checked_at`` is fine.
    """

    used = F.format_string("%.1f", round_exact(F.coalesce("daily_bytes", F.lit(0)) / F.lit(MEBIBYTE), 1))
    budget = F.coalesce("budget_bytes", F.lit(0))
    allowance = F.when(budget != 0, F.concat(
        F.lit(" of "), F.format_string("%.0f", round_exact(budget / F.lit(MEBIBYTE), 0)), F.lit(" MiB")))
    summary = F.concat(
        F.coalesce("published", F.lit(0)).cast("string"), F.lit(" published, "), used, F.lit(" MiB/24h"),
        F.coalesce(allowance, F.lit("")),
    )
    age = age_seconds(F.col("checked_at"), as_of)
    by_age = age_severity(age, warning=ELEMENT_WARNING_SECONDS, critical=ELEMENT_CRITICAL_SECONDS)
    blocked, spent = F.coalesce("blocked", F.lit(False)), F.coalesce("budget_exhausted", F.lit(False))
    failed = F.coalesce("derived_failed", F.lit(0))
    reason = F.coalesce(F.nullif("stop_reason", F.lit("")), F.lit("refused"))
    severity = (
        F.when(blocked, "critical").when(spent | (failed != 0), "warning").otherwise(F.coalesce(by_age, F.lit("ok")))
    )
    detail = (
        F.when(blocked, F.concat(F.lit("upstream refuses requests ("), reason, F.lit("); "), summary))
        .when(spent, F.concat(F.lit("the day's allowance is used up; "), summary))
        .when(failed != 0, F.concat(failed.cast("string"), F.lit(" subsets not published; "), summary))
        .when(age.isNull(), summary)
        .otherwise(F.concat(F.lit("last run "), age_text(age), F.lit("; "), summary))
    )
    return severity, detail


def run_check(run: DataFrame, as_of: Column) -> DataFrame:
    """The fetch job itself, from the newest run row; no row is critical."""

    return _or_missing(run, "gp-run", *run_verdict(as_of), "no run row")


def catalogue_verdict(as_of: Column) -> tuple[Column, Column]:
    """Severity and detail of a catalogue run: its age, at least a warning when it failed."""

    age = age_seconds(F.col("checked_at"), as_of)
    by_age = age_severity(age, warning=CATALOGUE_WARNING_SECONDS, critical=CATALOGUE_CRITICAL_SECONDS)
    failed = ~F.coalesce("successful", F.lit(False))
    rank = F.greatest(severity_rank(by_age), F.when(failed, 1).otherwise(0))
    outcome = F.concat(F.lit("last run "), F.coalesce("result", F.lit("failed")))
    outcome = F.concat_ws(": ", outcome, F.nullif("error", F.lit("")))
    detail = F.concat_ws("; ", age_text(age), F.when(failed, outcome))
    return (
        F.when(age.isNull(), "critical").otherwise(severity_name(rank)),
        F.when(age.isNull(), "no time of a run").otherwise(detail),
    )


def catalogue_check(status: DataFrame, as_of: Column) -> DataFrame:
    """Catalogue freshness by when the job last ran."""

    return _or_missing(status, "catalog", *catalogue_verdict(as_of), "no status row")


def manifest_check(manifest: DataFrame) -> DataFrame:
    """The published catalogue resolves and holds records."""

    sound = F.coalesce(F.col("records") >= 1, F.lit(False))
    return _or_missing(
        manifest, "public-tree",
        F.when(sound, "ok").otherwise("critical"),
        F.when(sound, F.concat(F.col("records").cast("string"), F.lit(" records published")))
        .otherwise("the manifest is empty"),
        "no manifest",
    )


def _or_missing(one_row: DataFrame, name: str, severity: Column, detail: Column, missing: str) -> DataFrame:
    """The check of a table of at most one row; an empty table is critical."""

    evaluated = one_row.select(F.struct(severity.alias("severity"), detail.alias("detail")).alias("check"))
    found = F.coalesce(
        F.max("check"), F.struct(F.lit("critical").alias("severity"), F.lit(missing).alias("detail"))
    )
    return evaluated.agg(found.alias("check")).select(F.lit(name).alias("name"), "check.severity", "check.detail")


def all_checks(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def report(checks: DataFrame) -> DataFrame:
    """Worst severity and the count at each level, zero ones included."""

    worst = severity_name(F.max(severity_rank(F.col("severity"))))
    counts = [F.count_if(F.col("severity") == level).alias(f"n_{level}") for level in ("ok", "warning", "critical")]
    return checks.agg(worst.alias("severity"), *counts).withColumn("successful", F.col("severity") != "critical")
