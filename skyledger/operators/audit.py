"""Comparison of a rule's members with an official membership list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership_difference(ours: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    """``extra`` and ``missing`` members. One aggregate, so repeats on either side do no harm."""

    marked = (
        ours.select(*keys, F.lit(1).alias("ours"), F.lit(0).alias("theirs"))
        .unionByName(theirs.select(*keys, F.lit(0).alias("ours"), F.lit(1).alias("theirs")))
        .groupBy(*keys)
        .agg(F.max("ours").alias("ours"), F.max("theirs").alias("theirs"))
    )
    verdict = F.when(F.col("theirs") == 0, "extra").when(F.col("ours") == 0, "missing").otherwise("both")
    return marked.select(*keys, verdict.alias("verdict"))


def membership_counts(difference: DataFrame, group: str) -> DataFrame:
    """Extra, missing and shared counts; ``subset`` when ours is strictly inside theirs."""

    counted = difference.groupBy(group).agg(
        F.count_if(F.col("verdict") == "extra").alias("extra"),
        F.count_if(F.col("verdict") == "missing").alias("missing"),
        F.count_if(F.col("verdict") == "both").alias("shared"),
    )
    return counted.withColumn("strict_subset", (F.col("extra") == 0) & (F.col("missing") > 0))
