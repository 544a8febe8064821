"""Masking row by row, whatever ids and column names the rows have."""

from pyspark.sql import functions as F

from skyledger.llm.common import free_name, numbered
from skyledger.llm.pii import find_personal_data, masked


def test_rows_are_masked_by_their_own_spans(spark):
    rows = [
        (None, "mail a.b@c.org now", 1, "s", "w"), (7, "first text with 10.0.0.1 inside", 2, "s", "w"), (7, "nothing here", 3, "s", "w"),
        (7, "first text with 10.0.0.1 inside", 2, "s", "w"), (8, None, 4, None, None), (9, "", 5, None, None),
        (10, "x@y.z 10.0.0.2 " * 3, 6, "s", "w"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _row int, spans string, walked string")
    docs, row = numbered(frame)
    assert row == "__row" and docs.columns[:-1] == frame.columns
    found = masked(docs, find_personal_data(docs, row), row).drop(row)
    assert found.columns == frame.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in found.collect()) == sorted([
        (0, "mail <EMAIL> now"), (7, "first text with <IP> inside"), (7, "nothing here"), (7, "first text with <IP> inside"), (8, ""), (9, ""),
        (10, "<EMAIL> <IP> " * 3)])
    assert masked(docs.filter("false"), find_personal_data(docs.filter("false"), row), row).collect() == []


def test_free_names(spark):
    assert (free_name("a", ["b"]), free_name("a", ["A", "_a"])) == ("a", "__a")
    assert numbered(spark.range(3).select(F.col("id").alias("_ROW")))[1] == "__row"


def test_rows_of_files_keep_their_numbers(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(5000, numPartitions=3).select(F.col("id"), F.lit("x").alias("_row"), (F.col("id") % 7).alias("k")).write.parquet(path)
    docs = spark.read.parquet(path)
    numbers, row = numbered(docs)
    assert "Exchange" not in numbers._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    first = {r.id: r[row] for r in numbers.collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4KB")
    try:
        again = {r.id: r[row] for r in numbers.filter("k = 3").select("id", row).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(set(first.values())) == 5000 and all(first[i] == n for i, n in again.items()) and len(again) == 714
    assert numbered(spark.read.parquet(path).union(docs))[0].count() == 10000
    assert numbered(docs.filter("false"))[0].collect() == []
