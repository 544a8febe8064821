"""One health pass over the state tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators import checks
from skyledger.operators.literals import literal_rows


def health(
    as_of: Column, *, expected: Sequence[str], states: DataFrame, runs: DataFrame, catalogue: DataFrame,
    manifest: DataFrame,
) -> DataFrame:
    """All checks, one row each; ``expected`` is the configured list of data sets."""

    names = literal_rows(states.sparkSession, [(name,) for name in expected], {"dataset": "string"})
    newest = runs.agg(F.max_by(F.struct(*runs.columns), "checked_at").alias("run")).filter("run is not null")
    return checks.all_checks(
        checks.manifest_check(manifest),
        checks.catalogue_check(catalogue, as_of),
        checks.run_check(newest.select("run.*"), as_of),
        checks.dataset_checks(names, states, as_of),
    )
