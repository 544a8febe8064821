"""Append-only Parquet tables for state and runs, and single files beside them."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from skyledger.operators.state import current_state


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def table_exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def names_in(spark: SparkSession, folder: str, *, folders: bool) -> list[str]:
    """Names of the folders or of the files in a folder; an absent folder has none."""

    files, target = _located(spark, folder)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory() == folders)


def sizes_in(spark: SparkSession, folder: str) -> dict[str, int]:
    """Size of each file of a folder by its path; files of no bytes count as well."""

    files, target = _located(spark, folder)
    return {s.getPath().toString(): s.getLen() for s in files.listStatus(target) if s.isFile()} if files.exists(target) else {}


def delete(spark: SparkSession, path: str) -> None:
    files, target = _located(spark, path)
    files.delete(target, True)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False when it does.

    The file system decides who comes first, as far as its create without overwriting is exclusive.
    """

    files, target = _located(spark, path)
    try:
        out = files.create(target, False)
    except Py4JJavaError as exc:
        if exc.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_small(spark: SparkSession, path: str) -> str:
    files, target = _located(spark, path)
    source = files.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def append_rows(rows: DataFrame, path: str) -> None:
    """Add rows; a job that fails leaves none of them."""

    rows.write.mode("append").parquet(path)


def all_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every row of a state table; an absent table has none."""

    if not table_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def newest_rows(spark: SparkSession, path: str, schema: str, keys: list[str], order: str) -> DataFrame:
    """Current rows of a state table; an absent table has none."""

    return current_state(all_rows(spark, path, schema), keys, order)
