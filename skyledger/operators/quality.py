"""Per-record checks on element sets and the one-row profile they add up to."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.text import epoch_instant, finite, parse_double, strip
from skyledger.functions.text import NON_FINITE_PATTERN, NUMBER_PATTERN, whole_number
from skyledger.operators.dedup import second_occurrences
from skyledger.operators.stages import computed_once

# The fields a record must carry, and the fields that are numeric.
REQUIRED_FIELDS = (
    "OBJECT_NAME", "OBJECT_ID", "EPOCH", "MEAN_MOTION", "ECCENTRICITY", "INCLINATION",
    "RA_OF_ASC_NODE", "ARG_OF_PERICENTER", "MEAN_ANOMALY", "BSTAR", "MEAN_MOTION_DOT",
    "MEAN_MOTION_DDOT", "EPHEMERIS_TYPE", "CLASSIFICATION_TYPE", "NORAD_CAT_ID", "ELEMENT_SET_NO",
)
NUMERIC_FIELDS = (
    "MEAN_MOTION", "ECCENTRICITY", "INCLINATION", "RA_OF_ASC_NODE", "ARG_OF_PERICENTER",
    "MEAN_ANOMALY", "BSTAR", "MEAN_MOTION_DOT", "MEAN_MOTION_DDOT", "EPHEMERIS_TYPE",
    "NORAD_CAT_ID", "ELEMENT_SET_NO", "REV_AT_EPOCH",
)
HIGHEST_NORAD = 999_999_999
DUPLICATE_RULE = "duplicate NORAD_CAT_ID"


@dataclass(frozen=True)
class Check:
    """One way a record can fail; ``failed`` is null or false when it does not.

    ``reads`` are values that it tests, by the names it has for them: texts are parsed once a row, whatever
    number of checks look at them.
    """

    rule: str
    failed: Column
    reads: tuple[tuple[str, Column], ...] = ()

    @property
    def column(self) -> str:
        return "n_" + self.rule.lower().replace(" ", "_").replace("-", "_")


def _numeric(df: DataFrame, name: str) -> tuple[Column, Column, Column, tuple]:
    """Finite value, 'does not parse' and 'parses but is not finite' of a field, and what they read."""

    if isinstance(df.schema[name].dataType, T.StringType):
        read = f"_read_{name}"
        value, text = F.col(read), strip(F.col(name))
        # Only what gave no value is looked at again.
        shaped = text.rlike(NUMBER_PATTERN) | text.rlike(NON_FINITE_PATTERN)
        return value, value.isNull() & (F.col(name).isNull() | ~shaped), value.isNull() & shaped, ((read, parse_double(F.col(name))),)
    raw = F.col(name).cast("double")
    return finite(raw), raw.isNull(), raw.isNotNull() & finite(raw).isNull(), ()


def element_checks(df: DataFrame, columns: dict[str, str]) -> list[Check]:
    """Checks in the order a record is tested.

    ``columns`` names the column that holds each field; a field left out is not
    tested. Numeric columns may be text or already typed.
    """

    checks: list[Check] = []

    def once(field: str, parse: Callable[[Column], Column]) -> tuple[Column, tuple]:
        """A field that may be text, parsed once a row."""

        name = columns[field]
        if not isinstance(df.schema[name].dataType, T.StringType):
            return F.col(name), ()
        return F.col(f"_read_{name}"), ((f"_read_{name}", parse(F.col(name))),)

    def unreadable(field: str) -> tuple[Column, tuple] | None:
        if field not in columns:
            return None
        value, invalid, non_finite, reads = _numeric(df, columns[field])
        checks.append(Check(f"invalid {field}", invalid, reads))
        checks.append(Check(f"non-finite {field}", non_finite, reads))
        return value, reads

    def outside(field: str, within: Column, reads: tuple) -> None:
        checks.append(Check(f"out-of-range {field}", ~within, reads))

    if "NORAD_CAT_ID" in columns:
        norad, reads = once("NORAD_CAT_ID", whole_number)
        checks.append(Check("invalid NORAD_CAT_ID", norad.isNull(), reads))
        outside("NORAD_CAT_ID", norad.between(1, HIGHEST_NORAD), reads)

    readable = {name: unreadable(name) for name in ("MEAN_MOTION", "ECCENTRICITY", "INCLINATION")}
    bands = {
        "MEAN_MOTION": lambda x: (x > 0) & (x < 20),
        "ECCENTRICITY": lambda x: (x >= 0) & (x < 1),
        "INCLINATION": lambda x: (x >= 0) & (x <= 180),
    }
    for field, found in readable.items():
        if found is not None:
            outside(field, bands[field](found[0]), found[1])
    for field in ("RA_OF_ASC_NODE", "ARG_OF_PERICENTER", "MEAN_ANOMALY"):
        found = unreadable(field)
        if found is not None:
            outside(field, (found[0] >= 0) & (found[0] <= 360), found[1])
    for field in ("BSTAR", "MEAN_MOTION_DOT", "MEAN_MOTION_DDOT"):
        unreadable(field)
    if "EPOCH" in columns:
        instant, reads = once("EPOCH", epoch_instant)
        checks.append(Check("invalid EPOCH", instant.isNull(), reads))
    return checks


def _read(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add what the checks read."""

    reads = {name: value for check in checks for name, value in check.reads}
    return computed_once(df, *[value.alias(name) for name, value in reads.items()]) if reads else df


def first_failed(checks: Sequence[Check]) -> Column:
    """Index of the first failed check of a record, or null."""

    chosen = F.when(checks[0].failed, 0)
    for index, check in enumerate(checks[1:], start=1):
        chosen = chosen.when(check.failed, index)
    return chosen.cast("int")


def flag_records(df: DataFrame, checks: Sequence[Check], name: str = "_failed") -> DataFrame:
    return computed_once(_read(df, checks), first_failed(checks).alias(name), keep=df.columns)


def rule_name(index: Column, checks: Sequence[Check]) -> Column:
    names = F.array(*[F.lit(check.rule) for check in checks], F.lit(DUPLICATE_RULE))
    return F.try_element_at(names, index + 1)


def tally(df: DataFrame, checks: Sequence[Check], keys: Sequence[str] = ()) -> DataFrame:
    """Number of records failing each check, whatever else they fail; one row per group."""

    return _read(df, checks).groupBy(*keys).agg(*[F.count_if(check.failed).alias(check.column) for check in checks])


#: A rule's place in the packed value of a failure; there are fewer rules.
RULES = 1000


class _FirstFailure:
    """Position and rule of a failure as one number that sorts like the pair.

    Numbers fit the fixed-width buffers of a hash aggregate, which a pair does not. Positions are
    whole numbers, or (file, block, row) as readers give them: those are numbered within their file, and files
    are compared in a last step over a row for each.
    """

    def __init__(self, df: DataFrame, position: str) -> None:
        self.in_files = isinstance(df.schema[position].dataType, T.StructType)
        self.position = position
        #: Further grouping columns while rows are aggregated.
        self.keys = [F.col(f"{position}.file").alias("_file")] if self.in_files else []
        self.names = ["_file"] if self.in_files else []

    def packed(self, rule: Column) -> Column:
        def digits(name: str, precision: int) -> Column:
            return F.col(name).cast(f"decimal({precision},0)")

        if not self.in_files:
            return (digits(self.position, 20) * RULES + rule.cast("decimal(3,0)")).cast("decimal(38,0)")
        # Blocks of files under ten petabytes, any row number, and the rule fill 38 digits.
        block = digits(f"{self.position}.block", 16) * F.lit("10000000000000000000000").cast("decimal(23,0)")
        row = digits(f"{self.position}.row", 19) * F.lit(RULES).cast("decimal(4,0)")
        return (block.cast("decimal(38,0)") + row.cast("decimal(38,0)")).cast("decimal(38,0)") + rule.cast("decimal(3,0)")

    def unpacked(self, value: Column, file: Column | None) -> tuple[Column, Column]:
        rule = F.pmod(value, F.lit(RULES)).cast("int")
        place = (value - F.pmod(value, F.lit(RULES))) / RULES
        if not self.in_files:
            return F.floor(place).cast("bigint"), rule
        rows = F.lit("10000000000000000000").cast("decimal(20,0)")
        whole = F.floor(place).cast("decimal(38,0)")
        row = F.pmod(whole, rows)
        block = F.floor((whole - row) / rows)
        return F.when(value.isNotNull(), F.struct(file.alias("file"), block.cast("bigint").alias("block"), row.cast("bigint").alias("row"))), rule


def profile(
    df: DataFrame, checks: Sequence[Check], *, key: str, position: str, epoch: str,
    keys: Sequence[str] = (), unique: bool = False,
) -> DataFrame:
    """Count, epoch range, failures and first failure, one row per group.

    Two column-pruned passes: every check in one partial hash aggregate, and the
    repeats in a shuffle of just key and position; ``unique`` says that no key repeats, and saves
    the second. Within one record a repeat is reported after every other failure.
    """

    first = _FirstFailure(df, position)
    flagged = flag_records(df, checks).withColumn("_packed", F.when(F.col("_failed").isNotNull(), first.packed(F.col("_failed"))))
    groups = [*[F.col(name) for name in keys], *first.keys]
    rows = flagged.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min(epoch).alias("earliest_epoch"),
        F.max(epoch).alias("latest_epoch"),
        F.count("_failed").alias("failed_records"),
        # Only failures touch the wide buffer.
        F.expr("min(_packed) filter (where _failed is not null)").alias("_failure"),
    )
    if not unique:
        repeated = second_occurrences(df, [*keys, key], position)
        repeats = repeated.groupBy(*groups).agg(F.min(first.packed(F.lit(len(checks)))).alias("_failure"))
        rows = _added_up(rows.unionByName(repeats, allowMissingColumns=True), [*keys, *first.names], F.min("_failure"))
    if first.in_files:
        # A row for each group and file.
        earliest = F.min(F.when(F.col("_failure").isNotNull(), F.struct("_file", "_failure")))
        rows = _added_up(rows, list(keys), earliest).select("*", "_failure._file", F.col("_failure._failure").alias("_value"))
    else:
        rows = rows.withColumn("_value", F.col("_failure"))
    place, rule = first.unpacked(F.col("_value"), F.col("_file") if first.in_files else None)
    return rows.select(
        *keys, F.coalesce("record_count", F.lit(0)).alias("record_count"), "earliest_epoch", "latest_epoch",
        F.coalesce("failed_records", F.lit(0)).alias("failed_records"),
        place.alias("first_position"), rule_name(rule, checks).alias("first_rule"),
    )


def _added_up(rows: DataFrame, keys: Sequence[str], failure: Column) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("record_count").alias("record_count"),
        F.min("earliest_epoch").alias("earliest_epoch"),
        F.max("latest_epoch").alias("latest_epoch"),
        F.sum("failed_records").alias("failed_records"),
        failure.alias("_failure"),
    )


def valid_unique(df: DataFrame, checks: Sequence[Check], *, key: str) -> DataFrame:
    """Records that fail nothing and whose key occurs once."""

    sound = flag_records(df, checks).filter("_failed is null").drop("_failed")
    return sound.join(duplicate_keys_only(sound, key), key, "left_anti")


def duplicate_keys_only(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)
