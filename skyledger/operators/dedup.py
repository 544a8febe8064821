"""Keyed duplicates: last one wins, and where the first repeat is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: str, position: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the one at the highest position; positions are unique.

    The highest position of each key comes from a hash aggregate over these two columns alone. Whole
    rows are then fetched once, by key and position together: they are neither sorted nor kept in
    aggregation buffers, and a key that holds most of the rows is spread over all tasks.
    """

    kept = [name for name in (columns or df.columns) if name not in (key, position)]
    newest = df.groupBy(F.col(key).alias("_key")).agg(F.max(position).alias("_position")).hint("shuffle_hash")
    chosen = df.join(newest, (F.col(key) == F.col("_key")) & (F.col(position) == F.col("_position")), "left_semi")
    return chosen.select(key, position, *kept)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""

    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def second_occurrences(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Key and position of each key's second occurrence.

    Spark limits each key to two rows per map task ahead of the shuffle
    (``WindowGroupLimit``), so hot keys are cut down before they move.
    """

    order = Window.partitionBy(*keys).orderBy(position)
    narrow = df.select(*keys, position).withColumn("_nth", F.row_number().over(order))
    return narrow.filter("_nth <= 2").filter("_nth = 2").drop("_nth")
