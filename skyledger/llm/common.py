"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import materialize

#: The white space between words: space and the ASCII controls from tab to return.
BLANKS = r"[\x20\x09-\x0D]+"
#: Bits of a row's place in its file.
FILE_ROW_BITS = 40
#: Rows of one Arrow batch. Whole texts may be long, so batches hold few of them.
BATCH_ROWS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Arrow batches hold few rows, so that a batch of long texts fits a Python worker."""

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fold_of(key: Column, folds: int) -> Column:
    """The fold of a row: CRC-32 of the key's decimal text, modulo ``folds`` (a null key counts as empty text)."""

    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that no other column can clash."""

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, or a longer one that no column has."""

    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def numbered(docs: DataFrame, label: str = "numbered") -> tuple[DataFrame, str]:
    """``docs`` with a number for each row, and that column's name; a row keeps its number however often it is read.

    Rows that come straight from Parquet files are numbered by their file and their place in it. Others are
    written once with a number.
    """

    name, file = free_name("_row", docs.columns), free_name("_file", docs.columns)
    try:
        place = docs.metadataColumn("_metadata")
        rows = docs.select("*", place["row_index"].alias(name), place["file_path"].alias(file))
    except AnalysisException:
        return materialize(docs.withColumn(name, F.monotonically_increasing_id()), label), name
    # A row a file.
    files = sorted(r[0] for r in rows.select(file).distinct().collect())
    if len(files) >= 1 << (63 - FILE_ROW_BITS):
        return materialize(docs.withColumn(name, F.monotonically_increasing_id()), label), name
    order = free_name("_order", [*rows.columns])
    places = docs.sparkSession.createDataFrame(list(zip(files, range(len(files)))), f"`{file}` string, `{order}` long")
    number = F.shiftleft(F.col(order), FILE_ROW_BITS) + F.col(name)
    numbers = rows.join(F.broadcast(places), file)
    return numbers.select(*[F.col(f"`{c}`") for c in docs.columns], number.alias(name)), name


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow string column, one at a time."""

    for cell in column.cast(pa.binary()) if not pa.types.is_binary(column.type) else column:
        yield cell.as_py() or b""


def lower_words(text: bytes) -> list[bytes]:
    """The words of a text with A to Z in lower case; bytes.split and BLANKS name the same characters."""

    return text.lower().split()
