"""Importance resampling towards a target: documents drawn by how much more the target says what they say."""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import small_batches, texts_of
from skyledger.session import materialize

#: Words are runs of letters, digits and everything beyond ASCII, A to Z in lower case.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BUCKETS, SCALE = 10_000, 1000
LEAST_WORDS, DRAWN_PERCENT, SEED = 20, 10, 2024
#: Sampled places of the sorted runs for each segment, and the rows a segment is meant for at most.
SAMPLES, SEGMENT_ROWS = 16, 1_000_000
#: Words whose bucket a task remembers; only speed depends on it.
KNOWN_WORDS = 200_000

Batches = Iterator[pa.RecordBatch]


def resample(
    docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", runs: int = 1,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT, seed: int = SEED,
) -> DataFrame:
    """``id, n_features, weight, score, rank`` of every row of ``docs``.

    Features are the runs of up to ``runs`` words, hashed into buckets. A weight is the mean gain of a document's features, a
    score adds Gumbel noise drawn from the id, so that the highest scores are a sample without replacement in proportion to the
    weights. Of the N documents with at least ``least_words`` words, the N * percent // 100 highest scores get a rank from 1.

    A null text has no words and weight 0, a null id reads as an empty one and comes first among equal scores. Equal scores go
    by id, rows with equal score and id in any order. Repeated rows count and are drawn each on its own. An empty target
    is a target without words; without documents there are no rows.
    """

    features = bucketed(docs, id_col, text_col, runs=runs, buckets=buckets)
    gains = gains_of(bucket_counts(features, buckets), bucket_counts(bucketed(target, target.columns[0], text_col, runs=runs, buckets=buckets), buckets))
    kind = features.schema["id"].dataType.simpleString()
    weighed = features.mapInArrow(_weigher(gains, buckets), f"row long, id {kind}, n_words long, n_features long, weight long")
    scored = materialize(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scores")
    eligible = F.col("n_words") >= least_words
    found = scored.filter(eligible).count()
    ranked = highest(scored.filter(eligible), found * percent // 100, found)
    return ranked.unionByName(scored.filter(~eligible).withColumn("rank", F.lit(None).cast("long"))).select(
        "id", "n_features", "weight", "score", "rank")


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate, rounded down, that depends on the key and the seed alone."""

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln(share))).cast("long")


def _bucketer(runs: int, buckets: int) -> Callable[[Batches], Batches]:
    def pack(batches: Batches) -> Batches:
        known: dict[bytes, int] = {}
        for batch in batches:
            sizes, packed = [], []
            for text in texts_of(batch.column(2)):
                grams = words = WORD.findall(text.lower())
                if runs > 1:
                    grams = [b" ".join(words[i:i + k]) for k in range(1, runs + 1) for i in range(len(words) - k + 1)]
                out = np.empty(len(grams), _packing(buckets))
                for i, gram in enumerate(grams):
                    bucket = known.get(gram)
                    if bucket is None:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        bucket = known[gram] = zlib.crc32(gram) % buckets
                    out[i] = bucket
                sizes.append(len(words))
                packed.append(out.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())],
                ["row", "id", "n_words", "features"])

    return pack


def _packing(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def bucketed(docs: DataFrame, id_col: str, text_col: str, *, runs: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``row, id, n_words, features`` of each row: the buckets of its features as an array of packed integers.

    Written once, as both the counts and the weights read it.
    """

    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return materialize(texts.mapInArrow(_bucketer(runs, buckets), f"row long, id {kind}, n_words long, features binary"), "features")


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows. Every task adds up its own rows; the result has a number a bucket."""

    def count(batches: Batches) -> Batches:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += np.bincount(np.frombuffer(cell.as_py(), _packing(buckets)), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    parts = features.select("features").mapInArrow(count, "bucket int, n long")
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares in the target and the source, rounded down."""

    buckets, all_source, all_target = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(SCALE * math.log((t + 1) * (all_source + buckets) / ((s + 1) * (all_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigher(gains: np.ndarray, buckets: int) -> Callable[[Batches], Batches]:
    def weigh(batches: Batches) -> Batches:
        for batch in batches:
            sizes, weights = [], []
            for cell in batch.column(3):
                found = np.frombuffer(cell.as_py(), _packing(buckets))
                sizes.append(len(found))
                weights.append(int(gains[found].sum()) // len(found) if len(found) else 0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(sizes, pa.int64()), pa.array(weights, pa.int64())],
                ["row", "id", "n_words", "n_features", "weight"])

    return weigh


def highest(scored: DataFrame, drawn: int, rows: int) -> DataFrame:
    """``scored`` (row, id, score and more; ``rows`` of them) with ``rank`` from 1 for the ``drawn`` highest scores.

    Sorting by regular sampling: each task sorts its run and gives every so-many-th row. Regular places of those split
    all rows into segments of about equal size, ``row`` telling apart what has equal scores and ids. Rows go to
    their segment, counts of the segments before it give its first rank, and only segments that hold drawn
    rows are put in order. The driver sees SAMPLES rows a segment, one more a run, and a count a segment.
    """

    spark = scored.sparkSession
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / SEGMENT_ROWS))
    order = [F.col("score").desc(), F.col("id").asc_nulls_first(), F.col("row").asc()]
    runs = scored.sortWithinPartitions(*order)
    places = runs.select("score", "id", "row")
    picked = sorted(map(_place, places.mapInArrow(_every(max(1, rows // (SAMPLES * segments))), places.schema).collect()))
    splitters = [picked[len(picked) * i // segments] for i in range(1, segments)] if picked else []
    dealt = materialize(runs.mapInArrow(_dealer(splitters), ", ".join(
        [*[f"{f.name} {f.dataType.simpleString()}" for f in runs.schema], "segment int"])), "segments")

    counts = {row["segment"]: row["n"] for row in dealt.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = dict(zip(sorted(counts), [0, *accumulate(counts[s] for s in sorted(counts))]))
    needed = {s: n for s, n in before.items() if n < drawn}
    last = max(needed, default=-1)
    starts = F.broadcast(spark.createDataFrame(list(needed.items()), "segment int, _before long"))
    nth = F.row_number().over(Window.partitionBy("segment").orderBy(*order)) + F.col("_before")
    front = dealt.filter(F.col("segment") <= last).join(starts, "segment").withColumn("rank", nth.cast("long"))
    front = front.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).drop("_before")
    back = dealt.filter(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))
    return front.unionByName(back).drop("segment")


def _place(row) -> tuple:
    """A row's place in the order, as something Python compares."""

    score, key, number = row
    return -score, key is not None, key, number


def _every(stride: int) -> Callable[[Batches], Batches]:
    """Every ``stride``-th row of a sorted run."""

    def pick(batches: Batches) -> Batches:
        at = stride // 2
        for batch in batches:
            places = range(at, batch.num_rows, stride)
            if places:
                yield batch.take(pa.array(places, pa.int32()))
            at += len(places) * stride - batch.num_rows

    return pick


def _dealer(splitters: list[tuple]) -> Callable[[Batches], Batches]:
    """The segment of each row of a sorted run."""

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            rows = zip(*[batch.column(batch.schema.get_field_index(name)).to_pylist() for name in ("score", "id", "row")])
            found = pa.array([bisect_right(splitters, _place(row)) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "segment"])

    return deal
