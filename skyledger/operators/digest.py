"""Deterministic content digests that ignore row order and partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_OUT = 1000


def canonical_json(*columns: Column) -> Column:
    """One record as JSON with its nulls written out; give the columns in a fixed order."""

    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def row_digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def shard_of(key: Column) -> Column:
    """``floor(key / 1000)`` in whole numbers."""

    return F.call_function("div", key - F.pmod(key, F.lit(FAN_OUT)), F.lit(FAN_OUT))


def shard_digests(df: DataFrame, key: str, canonical: Column) -> DataFrame:
    """Digest and size of each shard. ``key`` must be unique, which bounds a shard at 1000 rows."""

    rows = df.select(shard_of(F.col(key)).alias("bucket"), F.col(key).alias("_key"), row_digest(canonical).alias("_row"))
    members = F.array_sort(F.collect_list(F.struct("_key", "_row")))
    joined = F.array_join(F.transform(members, lambda member: member["_row"]), "")
    return rows.groupBy("bucket").agg(F.sha2(joined, 256).alias("digest"), F.count(F.lit(1)).alias("members"))


def content_digest(shards: DataFrame) -> DataFrame:
    """One digest over all shards, and their number; summed lane-wise, so no task holds them all."""

    shard = canonical_json(F.col("bucket"), F.col("digest"))
    return shards.agg(multiset_digest(shard).alias("content_sha256"), F.count(F.lit(1)).alias("buckets"))


def group_digests(shards: DataFrame) -> DataFrame:
    """``node, digest``: the level above the shards, a digest for each thousand of them."""

    return shards.groupBy(shard_of(F.col("bucket")).alias("node")).agg(
        multiset_digest(canonical_json(F.col("bucket"), F.col("digest"))).alias("digest"))


def shard_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``bucket, change, digest`` of the shards that are ``added``, ``changed`` or ``removed``; ``digest`` is the new one.

    Both sides have ``bucket, digest``. The level above is compared first, and only shards below a digest that
    differs are looked at.
    """

    def level(side: DataFrame, name: str) -> DataFrame:
        return group_digests(side).withColumnRenamed("digest", name)

    upper = level(old, "_old").join(level(new, "_new"), "node", "full_outer")
    moved = upper.filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("node")

    def below(side: DataFrame, name: str) -> DataFrame:
        rows = side.select("bucket", F.col("digest").alias(name), shard_of(F.col("bucket")).alias("node"))
        return rows.join(moved, "node", "left_semi").drop("node")

    both = below(old, "_old").join(below(new, "_new"), "bucket", "full_outer")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(
        F.col("_old") != F.col("_new"), "changed")
    return both.select("bucket", change.alias("change"), F.col("_new").alias("digest")).filter("change is not null")


def multiset_digest(canonical: Column) -> Column:
    """Aggregate digest of rows whose keys may repeat.

    Four 64-bit lanes, the whole of each row hash, are summed, which combines on the map
    side and needs neither a sort nor a list; the sums are then hashed.
    """

    hashed = row_digest(canonical)
    lanes = [
        F.sum(F.conv(F.substring(hashed, start, 16), 16, 10).cast("decimal(28,0)")).cast("string")
        for start in (1, 17, 33, 49)
    ]
    return F.sha2(F.concat_ws(",", *lanes), 256)
