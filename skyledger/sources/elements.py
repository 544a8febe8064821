"""Element sets from strict CSV and from JSON."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.text import (
    INTEGER_PATTERN, epoch_instant, fits_bigint, parse_double, token_kind, whole_number,
)
from skyledger.operators.stages import computed_once
from skyledger.operators.quality import NUMERIC_FIELDS, REQUIRED_FIELDS
from skyledger.sources.files import DamagedSource, refuse
from skyledger.sources.position import read_lines, without_return

WHOLE_FIELDS = ("NORAD_CAT_ID", "ELEMENT_SET_NO", "REV_AT_EPOCH", "EPHEMERIS_TYPE")

# A line whose quoted cells are closed and followed by a comma or the end.
_CELL = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",][^,]*+|)'
QUOTING_PATTERN = rf"^{_CELL}(?:,{_CELL})*+$"


def split_header(line: str) -> list[str]:
    """Column names of a header line; the required ones must be there."""

    try:
        names = next(csv.reader([line.rstrip("\r\n")], strict=True), [])
    except csv.Error as exc:
        raise DamagedSource(f"header cannot be read: {exc}") from exc
    if not names:
        raise DamagedSource("no header line")
    missing = sorted(set(REQUIRED_FIELDS) - set(names))
    if missing:
        raise DamagedSource(f"header lacks {', '.join(missing)}")
    return names


def typed_field(name: str, raw: Column) -> Column:
    """A cell under its column type; cells of other fields stay text."""

    if name in WHOLE_FIELDS:
        return whole_number(raw)
    return parse_double(raw) if name in NUMERIC_FIELDS else raw


def parse_element_lines(lines: DataFrame, header: Sequence[str]) -> DataFrame:
    """Data lines as typed columns named after the header, in any order of columns.

    ``damage`` says why a line cannot be used, or is null. Cells bind by name; of
    two columns with one name the last counts.
    """

    cells = ", ".join(f"c{index} string" for index in range(len(header)))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "escape": '"'}
    others = [column for column in lines.columns if column != "value"]
    line = F.col("value")
    structure = (
        F.when(~F.is_valid_utf8(line), "not UTF-8")
        .when(line == "", "blank line")
        .when(line.contains("\r") | (line.contains('"') & ~line.rlike(QUOTING_PATTERN)), "malformed quoting")
    )
    row = F.from_csv(line, f"{cells}, _bad string", options)
    trimmed = lines.withColumn("value", without_return(line))
    split = computed_once(trimmed, row.alias("_row"), structure.alias("_structure"), keep=others)
    place = {name: f"c{index}" for index, name in enumerate(header)}
    cell = {name: F.coalesce(F.col(f"_row.{column}"), F.lit("")) for name, column in place.items()}
    typed = computed_once(
        split,
        *[cell[name].alias(f"_{name}") for name in cell if name in NUMERIC_FIELDS],
        *[typed_field(name, raw).alias(name.lower()) for name, raw in cell.items()],
        epoch_instant(cell["EPOCH"]).alias("epoch_at"),
        F.coalesce("_structure", F.when(F.col("_row._bad").isNotNull(), "wrong number of fields")).alias("_damage"),
        keep=others,
    )
    names = [*others, *[name.lower() for name in place], "epoch_at", "_damage"]
    found = computed_once(typed, _first_faulty([n for n in place if n in NUMERIC_FIELDS]).alias("_faulty"), keep=names)
    fault = F.concat(token_kind(F.col("_faulty.cell")), F.lit(" "), F.col("_faulty.field"))
    damage = F.coalesce("_damage", F.when(F.col("_faulty").isNotNull(), fault))
    return computed_once(found, damage.alias("damage"), keep=names[:-1])


def _first_faulty(fields: Sequence[str]) -> Column:
    """Name and text of the first numeric cell that is not a usable number, or null."""

    first = None
    for name in fields:
        raw = F.col(f"_{name}")
        faulty = F.col(name.lower()).isNull()
        if name not in WHOLE_FIELDS:
            # Too long for a whole number, though it still reads as a double.
            faulty = faulty | ((F.char_length(raw) > 18) & raw.rlike(INTEGER_PATTERN) & ~fits_bigint(raw))
        cell = F.struct(F.lit(name).alias("field"), raw.alias("cell"))
        first = F.when(faulty, cell) if first is None else first.when(faulty, cell)
    return first


def file_faults(lines: DataFrame, header_line: str) -> DataFrame:
    """Whole-file faults, one row per file at fault.

    Line lengths plus one terminator each add up to the file size exactly when the
    last line is terminated (and no byte-order mark was skipped), so a file cut
    short shows without loading it whole.
    """

    is_header = without_return(F.col("value")) == header_line
    per_file = lines.groupBy(F.col("pos.file").alias("file"), "file_size").agg(
        F.sum(F.octet_length("value") + F.lit(1)).alias("bytes"),
        F.count_if(is_header).alias("headers"),
        F.min_by(is_header, F.col("pos")).alias("starts_with_header"),
    )
    fault = (
        F.when(F.col("bytes") != F.col("file_size"), "last line is not ended")
        .when(~F.col("starts_with_header"), "header differs")
        .when(F.col("headers") != 1, "header is repeated")
    )
    return per_file.select("file", fault.alias("fault")).filter("fault is not null")


def read_header_line(spark: SparkSession, lines: DataFrame) -> str:
    files = sorted(lines.inputFiles())
    first = spark.read.option("lineSep", "\n").text(files[:1]).head() if files else None
    if first is None:
        raise DamagedSource("no header line")
    return first["value"].rstrip("\r")


def read_element_csv(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Typed records with ``damage`` and ``pos``, and the whole-file faults.

    Nothing is dropped: the caller gates on both before it publishes.
    """

    lines = read_lines(spark, path)
    header_line = read_header_line(spark, lines)
    header = split_header(header_line)
    data = lines.filter(without_return(F.col("value")) != header_line).drop("file_size")
    return parse_element_lines(data, header), file_faults(lines, header_line)


def csv_gate(records: DataFrame, faults: DataFrame) -> str | None:
    """The first reason to reject a CSV source, or None; two one-row aggregates."""

    fault = faults.agg(F.min(F.struct("file", "fault")).alias("first")).first()["first"]
    if fault is not None:
        return f"{fault['file']}: {fault['fault']}"
    damaged = records.filter("damage is not null").agg(F.min(F.struct("pos", "damage")).alias("first")).first()["first"]
    if damaged is None:
        return None
    place = F.struct(*[F.lit(damaged["pos"][name]).alias(name) for name in ("file", "block", "row")])
    index = records.filter(F.col("pos") < place).count()
    return f"CSV row {index}: {damaged['damage']}"


def missing_fields(record: Column) -> Column:
    """Required names absent from a ``map<string,string>`` record; a null value is present."""

    names = F.array(*[F.lit(name) for name in sorted(REQUIRED_FIELDS)])
    absent = F.filter(names, lambda name: ~F.map_contains_key(record, name))
    return F.when(record.isNull(), "not an object").when(
        F.size(absent) > 0, F.concat(F.lit("lacks "), F.array_join(absent, ", "))
    )


def parse_element_objects(objects: DataFrame, column: str = "value") -> DataFrame:
    """JSON text, one object per row, as typed columns and ``damage`` (missing fields)."""

    record = F.from_json(column, "map<string,string>")
    rows = objects.withColumn("_record", record)
    names = (*REQUIRED_FIELDS, "REV_AT_EPOCH")
    raw = {name: F.try_element_at("_record", F.lit(name)) for name in names}
    others = [name for name in objects.columns if name != column]
    return rows.select(
        *others,
        *[typed_field(name, value).alias(name.lower()) for name, value in raw.items()],
        epoch_instant(raw["EPOCH"]).alias("epoch_at"),
        missing_fields(F.col("_record")).alias("damage"),
    )


def read_element_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A published data set with one object per line; splits like any text file."""

    return parse_element_objects(read_lines(spark, path).drop("file_size"))


def read_element_json_array(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A published JSON array; ``pos`` is the file and the place in it.

    The document is read by one task, as JSON has to be; its records leave it as rows of variants, are
    dealt out, and are taken apart by many. A file that is no JSON array is refused.
    """

    documents = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    refuse(documents.select("file", F.when(_records_of("value").isNull(), "not a JSON array").alias("fault")))
    return parse_element_documents(documents)


def _records_of(column: str) -> Column:
    return F.try_variant_get(F.try_parse_json(column), "$", "array<variant>")


def parse_element_documents(documents: DataFrame) -> DataFrame:
    """``file, value`` with a JSON array each, as typed records with ``pos`` and ``damage`` (missing fields).

    A field is missing when the record lacks its key; a null value is present.
    """

    records = documents.select("file", F.posexplode(_records_of("value")).alias("place", "_record"))
    dealt = records.select(F.struct("file", "place").alias("pos"), "_record").repartition("pos")
    names = (*REQUIRED_FIELDS, "REV_AT_EPOCH")
    absent = F.array_compact(F.array(*[
        F.when(F.try_variant_get("_record", f"$.{name}", "variant").isNull(), name) for name in sorted(REQUIRED_FIELDS)]))
    damage = F.when(~F.schema_of_variant("_record").startswith("OBJECT"), "not an object").when(
        F.size(absent) > 0, F.concat(F.lit("lacks "), F.array_join(absent, ", ")))
    cells = computed_once(
        dealt, *[F.try_variant_get("_record", f"$.{name}", "string").alias(name) for name in names], damage.alias("damage"), keep=["pos"])
    return cells.select(
        "pos", *[typed_field(name, F.col(name)).alias(name.lower()) for name in names],
        epoch_instant(F.col("EPOCH")).alias("epoch_at"), "damage")
