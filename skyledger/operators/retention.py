"""Which released versions to keep and which to drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def retention(versions: DataFrame, keep: int, *, stream: str = "stream", version: str = "version") -> DataFrame:
    """Each version with ``retained``: the newest ``keep`` of its stream and the current one.

    The newest versions are found with a per-task limit ahead of the shuffle; the
    rest only compares with the oldest of them.
    """

    if keep < 2:
        raise ValueError("at least two versions must be kept")
    order = Window.partitionBy(stream).orderBy(F.col(version).desc())
    newest = versions.select(stream, version).withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= keep)
    oldest_kept = newest.groupBy(stream).agg(F.min(version).alias("_oldest_kept"))
    joined = versions.join(oldest_kept, stream)
    kept = (F.col(version) >= F.col("_oldest_kept")) | F.col("is_current")
    return joined.withColumn("retained", kept).drop("_oldest_kept")


def prune_list(versions: DataFrame, keep: int) -> DataFrame:
    return retention(versions, keep).filter("not retained").drop("retained")
