"""Refresh a data set from every snapshot that lands in a folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.plans.elements import Dataset, ElementJobs
from skyledger.sinks.tables import sizes_in


def ingest_landed(
    spark: SparkSession, jobs: ElementJobs, dataset: Dataset, folder: str, checkpoint: str,
    clock: Callable[[], datetime],
) -> None:
    """Process the files that are there and were not seen before, then stop.

    Each micro-batch is one snapshot, so a snapshot is gated and published whole or
    not at all. The stream's own checkpoint remembers which files are done, and the batch's
    number names the arrival: a batch that is run again after a lost driver finds its state row, or finishes what was
    begun, and makes no second version. A file of no bytes makes a batch without lines; it
    is refused like any other damaged one.
    """

    files = (
        spark.readStream.option("maxFilesPerTrigger", 1).option("lineSep", "\n").text(folder)
        .select(F.col("_metadata.file_path").alias("path"))
    )
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:8]

    def refresh(batch: DataFrame, number: int) -> None:
        take_batch(spark, jobs, dataset, folder, batch, f"{stream}.{number}", clock)

    query = (
        files.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def take_batch(
    spark: SparkSession, jobs: ElementJobs, dataset: Dataset, folder: str, batch: DataFrame, landing: str, clock: Callable[[], datetime],
) -> None:
    """Refresh from the file of one batch; ``landing`` tells arrivals apart."""

    first = batch.head()
    path = first["path"] if first is not None else _next_empty(spark, jobs, dataset, folder)
    if path is not None:
        jobs.refresh(dataset, path, clock(), landing=landing)


def _next_empty(spark: SparkSession, jobs: ElementJobs, dataset: Dataset, folder: str) -> str | None:
    """A file without bytes that has no state row yet; batches of such files carry no path."""

    empty = sorted(path for path, size in sizes_in(spark, folder).items() if size == 0)
    return next(iter(jobs.untaken(dataset, empty)), None)
