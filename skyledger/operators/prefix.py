"""Running totals and ranks over whole tables, without a window that gathers all rows in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.session import materialize


def running_totals(
    df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, Column], *, keys: Sequence[str] = (),
    label: str = "ranges", tasks: int | None = None,
) -> DataFrame:
    """``df`` with a running total of each of ``totals`` in ``order``, the row itself included.

    Rows are dealt into ranges of (keys, order) and written, so that both later steps see
    the same ranges. Each range adds up its own rows; the sums of the ranges, a row for each
    range and key, are scanned on their own and added as an offset. No task holds more than
    a range, however dense a key or an instant is; a busy key spans many ranges. Rows that tie
    in ``order`` get totals in any order among themselves: end it with a unique column where
    that matters. Null keys and null order values are values of their own, nulls first.
    At most ``tasks`` tasks write the ranges, one file each: a caller that knows its rows keeps files from being many and tiny.
    """

    return _scanned(df, order, totals, list(keys), label, F.sum, lambda own, before: own + before, add, tasks)


def running_greatest(
    df: DataFrame, order: Sequence[Column | str], values: Mapping[str, Column], *, keys: Sequence[str],
    label: str = "ranges",
) -> DataFrame:
    """``df`` with the greatest of each of ``values`` so far, per key; nulls are passed over.

    With values that grow along ``order`` that is the latest one, which is how rows of one table find the
    newest row of another at or before them. Scanned like :func:`running_totals`.
    """

    return _scanned(df, order, values, list(keys), label, F.max, F.greatest, None)


def _scanned(df, order, values, keys, label, aggregate, combine, accumulator, tasks=None) -> DataFrame:
    whole = set(df.columns)
    part, value = _free("_part", whole), {name: _free(f"_of_{name}", whole) for name in values}
    ranged = df.withColumns({value[name]: amount for name, amount in values.items()})
    ranged = ranged.repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id())
    ranged = materialize(ranged.coalesce(tasks) if tasks else ranged, label)

    ends = ranged.groupBy(part, *keys).agg(*[aggregate(value[name]).alias(name) for name in values])
    before = _before(ends, part, keys, list(values), aggregate, accumulator)
    within = Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = ranged.withColumns({name: aggregate(value[name]).over(within) for name in values})
    same = F.lit(True)
    for name in (part, *keys):
        same = same & running[name].eqNullSafe(before[f"_b{name}"])
    joined = running.join(before, same)
    found = [combine(running[name], before[f"_s{name}"]).alias(name) for name in values]
    return joined.select(*[running[name] for name in df.columns if name not in values], *found)


def _before(ends: DataFrame, part: str, keys: list[str], names: list[str], aggregate, accumulator) -> DataFrame:
    """What all earlier ranges of a key come to, for each range and key."""

    kept = [F.col(name).alias(f"_b{name}") for name in (part, *keys)]
    if keys:
        # A key's ranges are as many as the shuffle has partitions at most.
        earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        first = F.lit(0) if accumulator else F.lit(None)
        return ends.select(*kept, *[F.coalesce(aggregate(n).over(earlier), first).alias(f"_s{n}") for n in names])
    # One row a shuffle partition.
    rows = ends.orderBy(part).collect()
    carried = {n: [0, *accumulate((row[n] or 0 for row in rows), accumulator)] for n in names}
    schema = ", ".join([f"_b{part} int", *[f"_s{n} {ends.schema[n].dataType.simpleString()}" for n in names]])
    return ends.sparkSession.createDataFrame(
        [(row[part], *[carried[n][i] for n in names]) for i, row in enumerate(rows)], schema)


def ranked(
    df: DataFrame, order: Sequence[Column | str], name: str = "rank", *, keys: Sequence[str] = (), label: str = "ranked",
) -> DataFrame:
    """``df`` with each row's place in ``order``, from 1, over all rows or within ``keys``."""

    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, keys=keys, label=label)


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name = f"_{name}"
    return name
