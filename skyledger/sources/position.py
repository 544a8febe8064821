"""File positions for text sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def positioned(scan: DataFrame) -> DataFrame:
    """Add ``pos``, which orders rows as they stand in the files.

    ``scan`` must come straight from a file reader. Rows are ordered by file, then
    by the block a task read, then by the row counter inside the task; a block is
    read by one task from front to back, so this is file order however the files
    are split, and it needs no pass over the data to number the rows.
    """

    return scan.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("pos"),
        F.col("_metadata.file_size").alias("file_size"),
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value``, ``pos`` and ``file_size`` of every line, ended by a line feed only."""

    return positioned(spark.read.option("lineSep", "\n").text(path))


def without_return(value: Column) -> Column:
    """The line without the carriage return a CRLF ending leaves behind."""

    return F.when(value.endswith("\r"), F.left(value, F.char_length(value) - 1)).otherwise(value)
