"""Naked-eye stars and constellation figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.functions.orbits import declination_degrees, right_ascension_degrees
from skyledger.functions.rounding import round_exact
from skyledger.functions.text import number, optional_string, strip
from skyledger.operators.prefix import ranked
from skyledger.operators.stages import computed_once
from skyledger.sources.files import line_faults, not_ascii, refuse
from skyledger.sources.position import read_lines, without_return

MAXIMUM_MAGNITUDE = 4.5

#: Kinds of JSON values that count as numbers; true and false are one and zero.
_NUMERIC = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"
#: Polylines of one figure that are nested in one row.
PIECE_LINES = 1000


def parse_stars(
    lines: DataFrame, names: DataFrame, *, maximum_magnitude: float = MAXIMUM_MAGNITUDE
) -> DataFrame:
    """Stars up to a magnitude from fixed-width lines, named by catalogue number.

    ``names`` has ``(hr, name)`` as text. A star without a name uses its Bayer
    designation. Sort by ``mag, pos`` for the published order.
    """

    line = without_return(F.col("value"))

    def piece(start: int, stop: int) -> Column:
        return F.substring(line, start + 1, stop - start)

    token = strip(piece(0, 4))
    cells = {
        "_rah": (75, 77), "_ram": (77, 79), "_ras": (79, 83),
        "_ded": (84, 86), "_dem": (86, 88), "_des": (88, 90), "mag": (102, 107),
    }
    rows = computed_once(
        lines.filter((F.char_length(line) >= 107) & token.rlike("^[0-9]+$")),
        token.alias("_hr"), optional_string(piece(4, 14)).alias("bayer"), piece(83, 84).alias("_sign"),
        *[number(piece(*span)).alias(name) for name, span in cells.items()],
        keep=["pos"],
    )
    complete = rows.dropna(subset=list(cells)).filter(F.col("mag") <= maximum_magnitude)
    named = complete.join(names.select(F.col("hr").alias("_hr"), F.col("name").alias("_name")), "_hr", "left")
    ra = right_ascension_degrees(F.col("_rah"), F.col("_ram"), F.col("_ras"))
    dec = declination_degrees(F.col("_sign"), F.col("_ded"), F.col("_dem"), F.col("_des"))
    placed = computed_once(named, ra.alias("_ra"), dec.alias("_dec"))
    return placed.select(
        "pos",
        F.col("_hr").cast("bigint").alias("hr"),
        F.coalesce(F.nullif("_name", F.lit("")), "bayer").alias("name"),
        "bayer",
        round_exact(F.col("_ra"), 4).alias("ra"),
        round_exact(F.col("_dec"), 4).alias("dec"),
        "mag",
    )


def read_stars(spark: SparkSession, catalogue: str, names: str) -> DataFrame:
    """Star lines with the names file, a JSON object of number to name. A line outside ASCII refuses the file."""

    lines = read_lines(spark, catalogue).drop("file_size")
    refuse(line_faults(lines, {"not ASCII": not_ascii(F.col("value"))}))
    whole = spark.read.text(names, wholetext=True)
    table = whole.select(F.explode(F.from_json("value", "map<string,string>")).alias("hr", "name"))
    return parse_stars(lines, table)


def by_magnitude(stars: DataFrame) -> DataFrame:
    """Brightest first, with the place as ``rank``; equal magnitudes keep file order."""

    return ranked(stars, ["mag", "pos"], label="stars").orderBy("rank")


def _number_at(point: Column, place: int) -> Column:
    """A number of a point, or null when it has none there or something else, such as a number in quotes."""

    cell = F.try_variant_get(point, f"$[{place}]", "variant")
    return F.when(F.schema_of_variant(cell).rlike(_NUMERIC), F.try_variant_get(point, f"$[{place}]", "double"))


def figure_lines(features: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Flattened polylines of each figure, one row per line.

    ``features`` has ``pos``, ``id``, ``coordinates`` (a variant, or JSON text, of a list of
    polylines) and ``keys``. A polyline with fewer than two points, or with a point that does
    not start with two numbers, is dropped. ``(pos, line)`` is the file order.
    """

    keys = list(keys)
    value = F.col("coordinates")
    if isinstance(features.schema["coordinates"].dataType, T.StringType):
        value = F.try_parse_json(value)
    figures = features.filter(F.coalesce("id", F.lit("")) != "")
    lines = figures.select(*keys, "pos", "id", F.posexplode(F.try_variant_get(value, "$", "array<variant>")).alias("line", "_line"))
    points = F.transform(
        F.try_variant_get("_line", "$", "array<variant>"),
        lambda point: F.struct(_number_at(point, 0).alias("ra"), _number_at(point, 1).alias("dec")))
    typed = computed_once(lines, points.alias("_points"), keep=[*keys, "pos", "id", "line"])
    sound = (F.size("_points") >= 2) & F.forall("_points", lambda p: p["ra"].isNotNull() & p["dec"].isNotNull())
    flat = F.flatten(F.transform("_points", lambda p: F.array(
        round_exact(F.when(p["ra"] < 0, p["ra"] + 360).otherwise(p["ra"]), 4), round_exact(p["dec"], 4))))
    return typed.filter(sound).select(*keys, "pos", "id", "line", flat.alias("points"))


def figure_documents(lines: DataFrame, *, keys: Sequence[str] = (), piece_lines: int = PIECE_LINES) -> DataFrame:
    """``id, piece, lines``: each figure's lines in file order, for the published file.

    A figure has one piece for every ``piece_lines`` lines, so that no row nests more of them however often an id
    occurs. Pieces are numbered from 0.
    """

    keys = [*keys, "id"]
    placed = ranked(lines, ["pos", "line"], "_place", keys=keys, label="figures")
    piece = F.floor((F.col("_place") - 1) / piece_lines).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("_place", "points")))
    nested = placed.groupBy(*keys, piece.alias("piece")).agg(F.transform(ordered, lambda row: row["points"]).alias("lines"))
    return nested.orderBy(*keys, "piece")


def features_of(documents: DataFrame) -> DataFrame:
    """``file, pos, id, coordinates`` of the features of feature collections (``file, value``).

    Only taking a document apart into features needs it whole; these are dealt out as rows of variants. An id
    may be any value that is not empty, null, zero or false, and is kept as text.
    """

    features = F.try_variant_get(F.try_parse_json("value"), "$.features", "array<variant>")
    rows = documents.select("file", F.posexplode(features).alias("pos", "_feature")).repartition("file", "pos")
    found = F.try_variant_get("_feature", "$.id", "string")
    return rows.select(
        "file", "pos", F.when(~found.isin("", "0", "false"), found).alias("id"),
        F.try_variant_get("_feature", "$.geometry.coordinates", "variant").alias("coordinates"))


def read_figures(spark: SparkSession, path: str) -> DataFrame:
    """Figures from a feature collection file; a file that is not JSON is refused."""

    documents = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    refuse(documents.select("file", F.when(F.try_parse_json("value").isNull(), "not JSON").alias("fault")))
    return figure_lines(features_of(documents))
