"""What has to be known of a landed file as a whole before its lines are used.

Files are judged one by one: each has its own header and its own verdict, and both are joined
to its lines, so a list of files may mix column orders and hold damaged ones. Lines carry ``pos``
from :func:`skyledger.sources.position.read_lines`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.stages import computed_once

#: Ends inside a quoted cell, so its record goes on in the next line.
_CLOSED = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|)'
OPEN_QUOTE_PATTERN = rf'^(?:{_CLOSED},)*+"[^"]*+(?:""[^"]*+)*+$'


class DamagedSource(ValueError):
    """A landed file that must not be used at all."""


def not_utf8(line: Column) -> Column:
    return ~F.is_valid_utf8(line)


def not_ascii(line: Column) -> Column:
    return ~F.is_valid_utf8(line) | (F.octet_length(line) != F.char_length(line))


def left_open(line: Column) -> Column:
    """Whether a quoted cell is still open at the end of the line."""

    return line.contains('"') & line.rlike(OPEN_QUOTE_PATTERN)


def first_lines(lines: DataFrame) -> DataFrame:
    """``file, pos, value`` of the first line of each file; only its first block is looked at."""

    first = lines.filter("pos.block = 0").groupBy(F.col("pos.file").alias("file"))
    return first.agg(F.min_by(F.struct("pos", "value"), F.col("pos.row")).alias("_first")).select("file", "_first.*")


def first_marked(lines: DataFrame, mark: str) -> DataFrame:
    """``file, pos, value`` of the first line of each file that starts with ``mark``."""

    found = lines.filter(F.col("value").startswith(mark)).groupBy(F.col("pos.file").alias("file"))
    return found.agg(F.min(F.struct("pos", "value")).alias("_first")).select("file", "_first.*")


def line_faults(lines: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """``file, fault`` of every file: the first of ``tests`` that any of its lines fails, or null."""

    files = lines.groupBy(F.col("pos.file").alias("file")).agg(
        *[F.bool_or(test).alias(f"_t{i}") for i, test in enumerate(tests.values())])
    fault = F.coalesce(*[F.when(F.col(f"_t{i}"), reason) for i, reason in enumerate(tests)], F.lit(None).cast("string"))
    return files.select("file", fault.alias("fault"))


def file_facts(
    lines: DataFrame, headers: DataFrame, tests: Mapping[str, Column], *, required: Sequence[str], used: Sequence[str], label: str,
) -> DataFrame:
    """``file, fault, header_pos, at`` of every file.

    ``headers`` has ``file, pos, names``. ``at`` holds the place of each used column in that file, null for one it does
    not have; of two columns with one name the last counts.
    """

    names = F.transform("names", lambda name: F.coalesce(name, F.lit("")))
    place = {name: F.when(F.array_contains(names, name), F.size(names) - F.array_position(F.reverse(names), name)) for name in used}
    absent = F.array_join(F.array_compact(F.array(*[F.when(~F.array_contains(names, n), n) for n in sorted(required)])), ", ")
    known = headers.select("file", F.col("pos").alias("header_pos"), absent.alias("_absent"),
                           F.struct(*[place[name].cast("int").alias(name) for name in used]).alias("at"))
    joined = line_faults(lines, tests).join(known, "file", "left")
    fault = F.coalesce(
        "fault", F.when(F.col("header_pos").isNull(), f"{label}: header not found"),
        F.when(F.col("_absent") != "", F.concat(F.lit(f"{label}: missing columns: "), "_absent")))
    return joined.select("file", fault.alias("fault"), "header_pos", "at")


def named_cells(lines: DataFrame, facts: DataFrame, cells: Column, used: Sequence[str]) -> DataFrame:
    """``pos`` and the used columns of the data lines of every file without fault, each by its own header."""

    sound = facts.filter("fault is null").select(F.col("file").alias("_file"), "header_pos", "at")
    data = lines.join(sound, F.col("pos.file") == F.col("_file")).filter(F.col("pos") != F.col("header_pos"))
    split = computed_once(data, cells.alias("_cells"), keep=["pos", "at"])
    return split.select("pos", *[F.get("_cells", F.col(f"at.{name}")).alias(name) for name in used])


def refuse(faults: DataFrame) -> None:
    """Raise for the first file at fault."""

    first = faults.filter("fault is not null").agg(F.min(F.struct("file", "fault")).alias("first")).first()["first"]
    if first is not None:
        raise DamagedSource(f"{first['file']}: {first['fault']}")
