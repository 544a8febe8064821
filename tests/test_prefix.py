"""Running totals, ranks and trailing sums where all rows lie close together."""

import random
from datetime import datetime, timedelta
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from skyledger.operators.prefix import ranked, running_totals
from skyledger.operators.rolling import trailing_bytes


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "j"]])
def test_running_totals(spark, keys):
    generator = random.Random(len(keys))
    rows = [(generator.choice(["hot", "hot", "hot", "a", None]), generator.randrange(2), i, generator.randrange(-5, 9)) for i in range(3000)]
    generator.shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, j int, pos int, x long")
    found = running_totals(frame, ["pos"], {"total": F.col("x"), "n": F.lit(1).cast("bigint")}, keys=keys).collect()
    expected, sums = {}, {}
    for k, j, pos, x in sorted(rows, key=lambda r: r[2]):
        key = tuple({"k": k, "j": j}[name] for name in keys)
        total, n = sums.get(key, (0, 0))
        sums[key] = total + x, n + 1
        expected[pos] = sums[key]
    assert {r.pos: (r.total, r.n) for r in found} == expected and len(found) == 3000


def test_ranks_with_nulls_ties_and_directions(spark):
    rows = [(None, 1), (3, 2), (3, 3), (None, 4), (1, 5)]
    frame = spark.createDataFrame(rows, "v int, pos int").repartition(3)
    up = {r.pos: r["rank"] for r in ranked(frame, [F.col("v").asc_nulls_first(), "pos"]).collect()}
    down = {r.pos: r["rank"] for r in ranked(frame, [F.col("v").desc_nulls_last(), F.col("pos").desc()]).collect()}
    assert up == {1: 1, 4: 2, 5: 3, 2: 4, 3: 5} and down == {3: 1, 2: 2, 5: 3, 4: 4, 1: 5}
    assert ranked(frame.filter("false"), ["pos"]).collect() == []


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_ranks_use_no_single_partition(spark):
    found = ranked(spark.range(50_000).select(F.pmod(F.xxhash64("id"), F.lit(97)).alias("v"), "id"), ["v", "id"])
    assert "SinglePartition" not in plan_of(found)
    ranks = found.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()
    assert tuple(ranks) == (1, 50_000, 50_000)


@pytest.mark.parametrize("keys", [[], ["dataset"]])
def test_trailing_sum_of_one_dense_minute(spark, keys):
    start, generator = datetime(2026, 8, 9, 12), random.Random(1)
    rows = [("active" if i % 3 else None, start + timedelta(microseconds=generator.randrange(60_000_000)), generator.randrange(9)) for i in range(20_000)]
    rows += [("active", start + timedelta(microseconds=5), None), ("active", None, 9), ("late", start + timedelta(seconds=30), 4)]
    found = trailing_bytes(spark.createDataFrame(rows, "dataset string, ts timestamp_ntz, bytes long"), keys=keys, window_seconds=30)
    assert "SinglePartition" not in plan_of(found)
    expected = {}
    for key in {row[0] if keys else None for row in rows} if keys else {None}:
        mine = sorted((ts, n or 0) for name, ts, n in rows if ts is not None and (not keys or name == key))
        sums, low = [0, *accumulate(n for _, n in mine)], 0
        for high, (ts, _) in enumerate(mine):
            while mine[low][0] <= ts - timedelta(seconds=30):
                low += 1
            expected[(key, ts) if keys else ts] = sums[high + 1] - sums[low]
    got = {((r.dataset, r.ts) if keys else r.ts): r.used for r in found.collect()}
    assert got == expected
