"""Small driver-side tables as constant relations."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, rows: Sequence[Sequence[Any]], schema: dict[str, str]) -> DataFrame:
    """``rows`` as a DataFrame without shipping a Python collection to executors."""

    structs = [
        F.struct(*[F.lit(value).cast(kind).alias(name) for value, (name, kind) in zip(row, schema.items(), strict=True)])
        for row in rows
    ]
    fields = ", ".join(f"{name}: {kind}" for name, kind in schema.items())
    table = F.array(*structs).cast(f"array<struct<{fields}>>")
    return spark.range(1, numPartitions=1).select(F.inline(table))
