"""Columns that later steps must not recompute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, *columns: Column, keep: list[str] | None = None) -> DataFrame:
    """Add columns behind a generator of one row.

    The optimizer copies a plain projected expression into every filter and
    column that uses it. Parsing a line is too costly for that: behind a
    generator each value is worked out once per row, in generated code.
    """

    kept = df.columns if keep is None else keep
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))
