"""Append-only state tables and the decisions read from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.ages import next_attempt
from skyledger.functions.responses import classify_response, expected_bytes
from skyledger.functions.text import zoned_instant
from skyledger.operators.prefix import ranked, running_greatest

# The fields only a request can set.
REQUEST_FIELDS = ("last_http_status", "retry_after", "last_response_bytes")
NEVER_ATTEMPTED = "never-attempted"


def current_state(log: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The newest row per key of an append-only table."""

    others = [name for name in log.columns if name not in (*keys, order)]
    newest = log.groupBy(*keys).agg(
        F.max_by(F.struct(*others), F.col(order)).alias("_row"), F.max(order).alias(order)
    )
    return newest.select(*keys, order, "_row.*")


def attempt_order(states: DataFrame, configured: DataFrame) -> DataFrame:
    """Each dataset's turn as ``rank``: least recently attempted first, never attempted ahead of all.

    Ties go by ``position``, then by name.
    """

    joined = configured.join(states, "dataset", "left")
    return ranked(joined, [F.col("last_attempt").asc_nulls_first(), F.col("position").asc(), F.col("dataset").asc()])


def due_datasets(states: DataFrame, as_of: Column, interval_seconds: int) -> DataFrame:
    """Datasets whose next eligible instant is unset or has come."""

    eligible = next_attempt(F.col("retry_after"), F.col("last_attempt"), interval_seconds)
    return states.withColumn("due_at", eligible).filter(F.col("due_at").isNull() | (F.col("due_at") <= as_of))


def size_forecasts(log: DataFrame) -> DataFrame:
    """Per dataset, the forecast from its last complete response; null when unusable."""

    complete_at = F.when(F.col("status") == 200, F.col("ts"))
    last = log.groupBy("dataset").agg(F.max_by(F.struct("bytes", "wire_format"), complete_at).alias("last"))
    return last.select(
        "dataset", expected_bytes(F.col("last.bytes"), F.col("last.wire_format")).alias("expected_bytes")
    )


def admission(forecasts: DataFrame, remaining: Column, cap: Column) -> DataFrame:
    """Whether a request fits its own cap and the shared allowance; an unknown size is tried."""

    expected = F.col("expected_bytes")
    verdict = (
        F.when(expected.isNull(), "attempt")
        .when(expected > cap, "over-dataset-cap")
        .when(expected > remaining, "budget-skipped")
        .otherwise("attempt")
    )
    return forecasts.withColumn("admission", verdict)


def classify_log(log: DataFrame) -> DataFrame:
    return log.withColumn("outcome", classify_response(F.col("status"), F.col("body")))


def run_counters(outcomes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counters over outcome rows ``(outcome, derived)``; derived ones are counted apart."""

    fetched, outcome = ~F.col("derived"), F.col("outcome")
    skipped = outcome.isin("skipped", "over-dataset-cap", "budget-skipped")
    failed = outcome.isin("forbidden", "upstream-error", "http-error", "validation-error", "network-error")
    counted = outcomes.groupBy(*keys).agg(
        F.count_if(fetched & ~skipped).alias("attempted"),
        F.count_if(fetched & (outcome == "published")).alias("published"),
        F.count_if(fetched & skipped).alias("skipped"),
        F.count_if(fetched & failed).alias("failed"),
        F.coalesce(F.bool_or(fetched & (outcome == "forbidden")), F.lit(False)).alias("blocked"),
        F.coalesce(F.bool_or(fetched & (outcome == "budget-skipped")), F.lit(False)).alias("budget_exhausted"),
        F.count_if(F.col("derived") & (outcome == "published")).alias("derived_published"),
        F.count_if(F.col("derived") & failed).alias("derived_failed"),
    )
    return counted


def stale_rules(rules: DataFrame, states: DataFrame) -> DataFrame:
    """Rules whose members were cut from another version of their source than the current one.

    ``rules`` has ``(rule, source)``, ``states`` has ``(dataset, last_success)``. A
    source that was never published yields nothing.
    """

    published = states.filter(F.col("last_success").isNotNull())
    sources = published.select(F.col("dataset").alias("source"), F.col("last_success").alias("source_success"))
    own = states.select(F.col("dataset").alias("rule"), F.col("last_success").alias("rule_success"))
    joined = rules.join(sources, "source").join(own, "rule", "left")
    return joined.filter(~F.col("source_success").eqNullSafe(F.col("rule_success")))


def repair_states(states: DataFrame, derived: Column) -> DataFrame:
    """New state rows for derived datasets that still carry request fields; data is untouched."""

    carries = F.coalesce(*[F.col(name).cast("string") for name in REQUEST_FIELDS]).isNotNull()
    affected = states.filter(derived & carries)
    cleared = {name: F.lit(None).cast(states.schema[name].dataType) for name in REQUEST_FIELDS}
    return affected.withColumns(cleared)


def checked_states(raw: DataFrame) -> DataFrame:
    """Typed state rows with a ``valid`` flag; a bad row spoils only its own dataset.

    ``raw`` holds text. Instants must state a zone, counts must be whole and not negative.
    """

    instants = ("last_attempt", "last_success", "retry_after")
    counts = ("last_response_bytes", "record_count")
    typed = {name: zoned_instant(F.col(name)) for name in instants}
    typed |= {
        name: F.when(F.col(name).rlike("^[0-9]+$"), F.col(name).try_cast("bigint")) for name in counts
    }
    sound = F.lit(True)
    for name, value in typed.items():
        sound = sound & (F.col(name).isNull() | value.isNotNull())
    return raw.select(
        "dataset",
        *[value.alias(name) for name, value in typed.items()],
        *[name for name in raw.columns if name not in ("dataset", *typed)],
        sound.alias("valid"),
    )


def last_good_sources(snapshots: DataFrame) -> DataFrame:
    """Per source, the newest good body and whether it is served stale.

    ``snapshots`` has ``source, ts, status, body_path`` and may have ``error``, for attempts without a
    response. ``304`` repeats the last body and is not stale; any other failure of the newest
    attempt serves the last good one as stale, with the error. A source without a
    good body has ``usable`` false.
    """

    good, attempt = _good_and_attempt(snapshots)
    found = snapshots.groupBy("source").agg(F.max(good).alias("good"), F.max(attempt).alias("attempt"))
    return found.select("source", *_served())


def sources_as_of(runs: DataFrame, snapshots: DataFrame) -> DataFrame:
    """What each run was served: the newest good body at or before it, as :func:`last_good_sources` tells it.

    ``runs`` has ``source, run_at``. An attempt at the very instant of a run counts for it. Runs before a source's
    first attempt have nothing usable and no error.
    """

    good, attempt = _good_and_attempt(snapshots)
    nothing = [F.lit(None).cast(snapshots.select(c.alias("c")).schema["c"].dataType) for c in (good, attempt)]
    events = snapshots.select("source", F.col("ts").alias("at"), F.lit(0).alias("is_run"), good.alias("g"), attempt.alias("a"))
    asked = runs.select("source", F.col("run_at").alias("at"), F.lit(1).alias("is_run"), nothing[0].alias("g"), nothing[1].alias("a"))
    seen = running_greatest(
        events.unionByName(asked), ["at", "is_run"], {"good": F.col("g"), "attempt": F.col("a")}, keys=["source"], label="attempts")
    return seen.filter("is_run = 1").select(F.col("at").alias("run_at"), "source", *_served())


def _good_and_attempt(snapshots: DataFrame) -> tuple[Column, Column]:
    """Values that grow with time: a good body with its instant, and any attempt with what came of it."""

    error = F.col("error") if "error" in snapshots.columns else F.lit(None).cast("string")
    said = F.coalesce(error, F.concat(F.lit("HTTP "), F.col("status").cast("string")), F.lit("no response"))
    outcome = F.when(F.col("status") == 200, "new").when(F.col("status") == 304, "same").otherwise(said)
    return (F.when(F.col("status") == 200, F.struct("ts", "body_path")),
            F.struct("ts", F.coalesce(F.col("status").isin(200, 304), F.lit(False)).alias("sound"), outcome.alias("outcome")))


def _served() -> list[Column]:
    failed = ~F.col("attempt.sound")
    return [
        F.col("good.body_path").alias("body_path"), F.col("good.ts").alias("fetched_at"),
        (F.col("attempt.outcome") != "new").alias("from_cache"), failed.alias("stale"),
        F.when(failed, F.col("attempt.outcome")).alias("error"), F.col("good").isNotNull().alias("usable"),
    ]
