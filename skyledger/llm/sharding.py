"""Shards of near equal size, as the leaves of a k-d tree over what is known of each document."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.prefix import running_totals
from skyledger.session import materialize

#: A group of equal texts is one point of the tree up to this share of a shard; larger ones become pieces,
#: which lie side by side, so that only a cut through the group parts it.
WHOLE_SHARE = 1 / 64
#: Pieces of a group that is larger.
PIECES = 1024
#: Rows of the tree's narrow tables that a task writes; with fewer, starting tasks and files costs more than the rows.
TASK_ROWS = 20_000


def category(value: Column) -> Column:
    """A text as a coordinate from 0 to 1: equal texts coincide, null lies at 0."""

    return F.coalesce(F.crc32(value.cast("string").cast("binary")) / F.lit(float(1 << 32)), F.lit(0.0))


def kd_shards(
    docs: DataFrame, dimensions: Mapping[str, Column], *, shards: int | None = None, target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text", whole_share: float = WHOLE_SHARE,
) -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row; give ``shards``, or ``target_bytes`` of a shard.

    The tree starts with one node that is to become all shards. A node is cut along its widest dimension (its range as
    a share of that dimension's range over all documents; the first one of equals), at the weighted median: of a
    node meant for k shards, k // 2 go below the cut with their share of the bytes. All nodes of a level are cut
    together from running totals of the bytes, which no single task gathers. Points are groups of equal texts, placed
    at their least coordinates. Tables are written by a task for each ``TASK_ROWS`` rows at most, however many partitions a shuffle has.

    The size is the UTF-8 length plus one, so every row weighs something. A null text counts as an empty one, and a null or non-finite
    coordinate as 0. Null and repeated ids and repeated rows are rows of their own. Without rows there are no shards.
    Shards differ by the largest point at most: an uncut group or a single long text.
    """

    if (shards is None) == (target_bytes is None) or (shards or target_bytes) < 1:
        raise ValueError("give either a number of shards or their size")
    axes = [f"c{i}" for i in range(len(dimensions))]
    rows = _rows(docs, dict(zip(axes, dimensions.values())), id_col, text_col)
    spans = rows.agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("rows"), *[F.min(a).alias(f"low_{a}") for a in axes],
                     *[F.max(a).alias(f"high_{a}") for a in axes]).first()
    total, tasks = spans["total"] or 0, max(1, math.ceil(spans["rows"] / TASK_ROWS))
    shards = shards or max(1, math.ceil(total / target_bytes))
    ranges = {a: (spans[f"high_{a}"] or 0.0) - (spans[f"low_{a}"] or 0.0) for a in axes}

    # Groups above a share of a shard number shards / share at most.
    large = rows.groupBy("g").agg(F.sum("size").alias("_bytes"))
    large = large.filter(F.col("_bytes") > total / shards * whole_share).select("g", F.lit(True).alias("_large"))
    rows = rows.join(F.broadcast(large), "g", "left").withColumn("piece", F.when(F.col("_large"), F.col("piece")).otherwise(-1)).drop("_large")
    rows = materialize(rows.coalesce(tasks), "shard-rows")
    points = rows.groupBy("g", "piece").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), *[F.min(a).alias(a) for a in axes])
    points = materialize(points.withColumns({"first": F.lit(0), "leaves": F.lit(shards)}).coalesce(tasks), "points")
    leaves = _leaves(points, axes, ranges, shards, tasks)

    counted = running_totals(leaves, ["g", "piece"], {"_end": F.col("n")}, keys=["first"], label="slots", tasks=tasks)
    placed = counted.select("g", "piece", F.col("first").alias("shard"), (F.col("_end") - F.col("n")).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("g", "piece").orderBy("id", "row"))
    return rows.join(placed, ["g", "piece"]).select(
        "id", "size", "text_crc32", "shard", (F.col("_start") + nth - 1).cast("long").alias("slot")).coalesce(tasks)


def _rows(docs: DataFrame, coordinates: Mapping[str, Column], id_col: str, text_col: str) -> DataFrame:
    """What the tree needs of each document, written once; texts are read here alone."""

    places = {a: F.coalesce(F.when(F.abs(x := c.cast("double")) < F.lit(float("inf")), x), F.lit(0.0)) for a, c in coordinates.items()}
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g"),
        F.monotonically_increasing_id().alias("row"), *[place.alias(a) for a, place in places.items()])
    piece = F.pmod(F.xxhash64("row"), F.lit(PIECES)).cast("int")
    return materialize(narrow.withColumn("piece", piece), "documents")


def _leaves(points: DataFrame, axes: list[str], ranges: Mapping[str, float], shards: int, tasks: int) -> DataFrame:
    """Points with the shard they end in, as ``first``; a node is named by the first of its shards."""

    most = shards
    while most > 1:
        # A row a node, fewer than there are shards.
        nodes = points.groupBy("first").agg(
            F.sum("bytes").alias("_total"), *[(F.max(a) - F.min(a)).alias(f"_w{a}") for a in axes])
        widths = [F.col(f"_w{a}") / F.lit(ranges[a]) if ranges[a] else F.lit(0.0) for a in axes]
        widest = F.array_position(F.array(*widths), F.array_max(F.array(*widths))) if axes else F.lit(0)
        nodes = nodes.select("first", "_total", widest.alias("_axis"))
        at = F.coalesce(*[F.when(F.col("_axis") == i + 1, F.col(a)) for i, a in enumerate(axes)], F.lit(0.0))
        ordered = running_totals(
            points.join(F.broadcast(nodes), "first").withColumn("_at", at), ["_at", "g", "piece"],
            {"_run": F.col("bytes")}, keys=["first"], label="cuts", tasks=tasks)
        below = F.floor(F.col("leaves") / 2).cast("int")
        middle = (F.col("_run") - F.col("bytes") / 2) / F.col("_total")
        under = middle <= below / F.col("leaves")
        points = materialize(ordered.select(
            "g", "piece", "bytes", "n", *axes,
            F.when(under, F.col("first")).otherwise(F.col("first") + below).alias("first"),
            F.when(under & (below > 0), below).otherwise(F.col("leaves") - below).alias("leaves")).coalesce(tasks), "points")
        most = most - most // 2
    return points


def document_shards(docs: DataFrame, shards: int) -> DataFrame:
    """Shards of the documents table, cut by length, language and source."""

    return kd_shards(docs, {
        "length": F.log2(F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(1)),
        "lang": category(F.col("lang")), "source": category(F.col("source")),
    }, shards=shards)
