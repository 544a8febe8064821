"""Trailing sums over an event log, however dense it is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.prefix import running_totals

MICROS = 1_000_000


def trailing_bytes(
    log: DataFrame, *, keys: Sequence[str] = (), at: str = "ts", amount: str = "bytes", window_seconds: int = 86_400,
) -> DataFrame:
    """``used`` bytes in the window ending at each logged instant, per key (or over all).

    The window leaves out an entry exactly ``window_seconds`` old. Each instant
    counts its bytes in and, one window later, out again, so the trailing sum is
    a running sum of signed amounts. Equal instants add up before the first shuffle; the
    running sum is taken over ranges of instants, so neither a busy key nor one without keys,
    nor all entries in one minute, end up in a single task. Entries without an instant
    count for nothing, and an unknown amount counts as zero.
    """

    keys = list(keys)
    instant = F.unix_micros(F.col(at).cast("timestamp"))
    amount_in = F.coalesce(F.col(amount), F.lit(0))
    signed = F.explode(F.array(
        F.struct(instant.alias("_t"), amount_in.alias("_delta"), F.lit(True).alias("_real")),
        F.struct((instant + window_seconds * MICROS).alias("_t"), (-amount_in).alias("_delta"), F.lit(False).alias("_real")),
    ))
    steps = log.select(*keys, signed.alias("_s")).select(*keys, "_s.*").filter("_t is not null")
    steps = steps.groupBy(*keys, "_t").agg(F.sum("_delta").alias("_delta"), F.bool_or("_real").alias("_real"))
    running = running_totals(steps, ["_t"], {"used": F.col("_delta")}, keys=keys, label="steps")
    stamp = F.timestamp_micros("_t").cast(log.schema[at].dataType)
    return running.filter("_real").select(*keys, stamp.alias(at), "used")


def remaining_bytes(used: Column, budget: int) -> Column:
    """What is left of an allowance, never below zero."""

    return F.greatest(F.lit(budget).cast("bigint") - used, F.lit(0).cast("bigint"))
