"""Satellite catalogue, general catalogue and magnitude files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import codes, orbits
from skyledger.functions.text import (
    canonical_id, digits_id, iso_date, name_list, number, optional_string, strip, worded_date,
)
from skyledger.operators.dedup import last_wins
from skyledger.operators.stages import computed_once
from skyledger.sources.files import (
    DamagedSource, file_facts, first_lines, first_marked, left_open, line_faults, named_cells, not_utf8, refuse,
)
from skyledger.sources.position import read_lines, without_return

# The columns that must be there and the ones that are used.
SATCAT_REQUIRED = ("NORAD_CAT_ID", "OBJECT_NAME", "OBJECT_ID", "OBJECT_TYPE", "DECAY_DATE")
SATCAT_USED = (
    "OBJECT_NAME", "OBJECT_ID", "OBJECT_TYPE", "OPS_STATUS_CODE", "OWNER", "LAUNCH_DATE",
    "LAUNCH_SITE", "DECAY_DATE", "PERIOD", "INCLINATION", "APOGEE", "PERIGEE", "RCS",
    "DATA_STATUS_CODE", "ORBIT_CENTER",
)
GCAT_USED = (
    "LDate", "DDate", "Status", "Owner", "State", "TotMass", "Mass", "DryMass", "Length",
    "Diameter", "Span", "Shape", "OpOrbit", "AltNames",
)
PLACEHOLDER_IDS = ("1", "99999")


def _with_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Absent optional columns as typed nulls."""

    return df.withColumns({name: F.lit(None).cast("string") for name in names if name not in df.columns})


def clean_satcat(raw: DataFrame, position: str = "pos") -> DataFrame:
    """Raw text columns as one cleaned record per ``norad``; unreadable ids are skipped.

    Repeats are resolved on the raw text, so only the surviving rows are parsed.
    """

    missing = sorted(set(SATCAT_REQUIRED) - set(raw.columns))
    if missing:
        raise DamagedSource(f"satellite catalogue is missing columns: {', '.join(missing)}")
    named = _with_columns(raw, SATCAT_USED).withColumn("norad", canonical_id(F.col("NORAD_CAT_ID")))
    kept = named.filter("norad is not null").select("norad", position, *SATCAT_USED)
    numbers = ("PERIOD", "INCLINATION", "APOGEE", "PERIGEE", "RCS")
    newest = computed_once(
        last_wins(kept, "norad", position), *[number(F.col(name)).alias(f"_{name}") for name in numbers]
    )
    return newest.select(
        "norad",
        optional_string(F.col("OBJECT_ID")).alias("cospar"),
        optional_string(F.col("OBJECT_NAME")).alias("name"),
        codes.object_type(F.col("OBJECT_TYPE")).alias("objectType"),
        codes.ops_status(F.col("OPS_STATUS_CODE")).alias("opsStatus"),
        optional_string(F.col("OWNER")).alias("country"),
        iso_date(F.col("LAUNCH_DATE")).alias("launchDate"),
        optional_string(F.col("LAUNCH_SITE")).alias("launchSite"),
        iso_date(F.col("DECAY_DATE")).alias("decayDate"),
        F.col("_RCS").alias("rcsValue_m2"),
        orbits.rcs_band(F.col("_RCS")).alias("rcsSize"),
        codes.data_status(F.col("DATA_STATUS_CODE")).alias("dataStatus"),
        codes.orbit_center(F.col("ORBIT_CENTER")).alias("orbitCenter"),
        orbits.approximate_orbit(
            F.col("_PERIOD"), F.col("_INCLINATION"), F.col("_APOGEE"), F.col("_PERIGEE")
        ).alias("approximateOrbit"),
    )


def satcat_files(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw columns of all sound files by each one's own header, and ``file, fault`` of all files.

    A file is at fault when a line is not UTF-8, when a quoted cell runs over the end of a line, or
    when its header lacks a required column.
    """

    line = without_return(F.col("value"))
    first = first_lines(lines).withColumn("value", line)
    # No header has more columns than this, and no line needs more of its cells.
    width = first.agg(F.max(F.size(F.split("value", ",")))).first()[0] or 1
    schema = ", ".join(f"c{i} string" for i in range(width))

    def cells(text: Column) -> Column:
        row = F.from_csv(text, schema, {"mode": "PERMISSIVE", "escape": '"'})
        return F.transform(F.array(F.struct(row.alias("r"))), lambda x: F.array(*[x["r"][f"c{i}"] for i in range(width)]))[0]

    used = ("NORAD_CAT_ID", *SATCAT_USED)
    facts = file_facts(
        lines, first.withColumn("names", cells(F.col("value"))), {"not UTF-8": not_utf8(line), "a quoted cell is left open": left_open(line)},
        required=SATCAT_REQUIRED, used=used, label="satellite catalogue")
    data = lines.select("pos", line.alias("value"))
    return named_cells(data, facts, cells(F.col("value")), used), facts.select("file", "fault")


def read_satcat(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The CSV catalogue with header, cleaned; one file at fault refuses all."""

    rows, faults = satcat_files(_lines(spark, path))
    refuse(faults)
    return clean_satcat(rows)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = read_lines(spark, path).drop("file_size")
    if lines.isEmpty():
        raise DamagedSource("the file is empty")
    return lines


def clean_gcat(raw: DataFrame, position: str = "pos") -> DataFrame:
    """Raw text columns as one cleaned record per ``norad``; only digit-only ids count."""

    named = _with_columns(raw, GCAT_USED).withColumn("norad", digits_id(F.col("Satcat")))
    kept = named.filter("norad is not null").select("norad", position, *GCAT_USED)
    sizes = ("Span", "Length", "Diameter")
    newest = computed_once(
        last_wins(kept, "norad", position),
        *[number(F.col(name), positive=True).alias(f"_{name}") for name in sizes],
    )
    return newest.select(
        "norad",
        optional_string(F.col("Owner")).alias("owner"),
        optional_string(F.col("State")).alias("country"),
        worded_date(F.col("LDate")).alias("launchDate"),
        worded_date(F.col("DDate")).alias("decayDate"),
        orbits.first_positive(F.col("TotMass"), F.col("Mass"), F.col("DryMass")).alias("massKg"),
        orbits.dimensions(F.col("_Span"), F.col("_Length"), F.col("_Diameter")).alias("dimensions"),
        optional_string(F.col("Shape")).alias("shape"),
        orbits.orbit_class(F.col("OpOrbit")).alias("orbitClass"),
        orbits.lifecycle(F.col("Status")).alias("status"),
        name_list(F.col("AltNames")).alias("altNames"),
    )


def split_tab_lines(lines: DataFrame, header_line: str) -> DataFrame:
    """Data lines under the names of the ``#JCAT`` line; comments and blank lines skipped."""

    names = header_line.removeprefix("#").split("\t")
    value = without_return(F.col("value"))
    data = lines.withColumn("value", value).filter((F.col("value") != "") & ~F.col("value").startswith("#"))
    cells = F.split("value", "\t")
    place = {name: F.get(cells, F.lit(index)).alias(name) for index, name in enumerate(names)}
    if "Satcat" not in place:
        place["Satcat"] = F.lit(None).cast("string").alias("Satcat")
    others = [name for name in lines.columns if name != "value"]
    return data.select(*others, *place.values())


def gcat_files(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw columns of all sound files by each one's own ``#JCAT`` line, and ``file, fault`` of all files.

    A file is at fault when a line is not UTF-8 or when it has no such line. Other lines that start with ``#``
    and blank ones are skipped.
    """

    line = without_return(F.col("value"))
    headers = first_marked(lines, "#JCAT").withColumn("names", F.split(F.substr(line, F.lit(2)), "\t"))
    used = ("Satcat", *GCAT_USED)
    facts = file_facts(lines, headers, {"not UTF-8": not_utf8(line)}, required=(), used=used, label="general catalogue")
    data = lines.select("pos", line.alias("value")).filter((F.col("value") != "") & ~F.col("value").startswith("#"))
    return named_cells(data, facts, F.split("value", "\t"), used), facts.select("file", "fault")


def read_gcat(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The tab-separated catalogue, cleaned; one file at fault refuses all."""

    rows, faults = gcat_files(_lines(spark, path))
    refuse(faults)
    return clean_gcat(rows)


def clean_magnitudes(lines: DataFrame, position: str = "pos") -> DataFrame:
    """Fixed-width magnitude lines: id in columns 1-5, magnitude in 34-37."""

    line = without_return(F.col("value"))
    token = strip(F.substring(line, 1, 5))
    magnitude = number(F.substring(line, 34, 4))
    long_enough = lines.filter((F.char_length(line) >= 37) & ~token.isin(*PLACEHOLDER_IDS))
    rows = computed_once(long_enough, digits_id(token).alias("norad"), magnitude.alias("stdMag"), keep=[position])
    return last_wins(rows.filter("norad is not null and stdMag is not null"), "norad", position).drop(position)


def read_magnitudes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Magnitude lines; a file that is not UTF-8 refuses all."""

    lines = read_lines(spark, path).drop("file_size")
    refuse(line_faults(lines, {"not UTF-8": not_utf8(F.col("value"))}))
    return clean_magnitudes(lines)


def source_rows(**sources: DataFrame) -> DataFrame:
    """Rows per source."""

    counted: list[DataFrame] = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), "rows")
        for name, df in sources.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result

