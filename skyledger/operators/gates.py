"""Dataset-level decisions taken on aggregate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floor_error(count: Column, minimum: Column) -> Column:
    text = F.format_string("record count %d is below minimum %d", count, minimum)
    return F.when(count < minimum, text)


def drop_error(count: Column, previous: Column, fraction: Column, label: str = "record count") -> Column:
    """Too large a fall against the last published count; no or zero previous passes."""

    text = F.format_string(f"{label} dropped from %d to %d", previous, count)
    return F.when((previous > 0) & (count < previous * (F.lit(1.0) - fraction)), text)


def element_gate(
    profiled: DataFrame, *, minimum: Column, previous: Column, fraction: Column
) -> DataFrame:
    """``error`` and ``accepted`` for each profiled row: floor, then drop, then records."""

    failure = F.format_string("record %s: %s", F.col("first_position").cast("string"), F.col("first_rule"))
    error = F.coalesce(
        floor_error(F.col("record_count"), minimum),
        drop_error(F.col("record_count"), previous, fraction),
        F.when(F.col("first_rule").isNotNull(), failure),
    )
    return profiled.withColumn("error", error).withColumn("accepted", F.col("error").isNull())


def source_floor_gate(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows per source against its floor; a source that delivered nothing counts as zero."""

    joined = limits.join(rows, "source", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint")))
    text = F.format_string("%s count %d is below minimum %d", F.col("source"), F.col("rows"), F.col("minimum"))
    return joined.withColumn("error", F.when(F.col("rows") < F.col("minimum"), text)).withColumn(
        "accepted", F.col("error").isNull()
    )


def merge_gate(
    metrics: DataFrame, *, minimum_join_fraction: float, previous: Column, maximum_drop: float
) -> DataFrame:
    """Gate a merged catalogue: not empty, enough joined, no sudden shrink."""

    share = F.col("with_gcat") / F.col("records").cast("double")
    error = F.coalesce(
        F.when(F.col("records") < 1, "merged catalogue is empty"),
        F.when(share < minimum_join_fraction, "GCAT join fraction is below minimum"),
        drop_error(F.col("records"), previous, F.lit(maximum_drop), "catalogue record count"),
    )
    return metrics.withColumn("error", error).withColumn("accepted", F.col("error").isNull())
