"""Code tables and the lookups over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.text import literal_map, strip

# Published code tables of the satellite catalogue format.
OBJECT_TYPES = {"PAY": "payload", "R/B": "rocket-body", "DEB": "debris", "UNK": "unknown"}
OPS_STATUS = {
    "+": "operational", "P": "partial", "B": "backup", "S": "backup",
    "-": "nonoperational", "X": "extended", "D": "decayed", "?": "unknown",
}
DATA_STATUS = {
    "NCE": "no-current-elements", "NIE": "no-initial-elements", "NEA": "no-elements-available",
}
ORBIT_CENTERS = {
    "AS": "asteroid", "CO": "comet", "EA": "earth", "EL": "earth-lagrange",
    "EL1": "earth-sun-l1", "EL2": "earth-sun-l2", "EL3": "earth-sun-l3",
    "EL4": "earth-sun-l4", "EL5": "earth-sun-l5", "EM": "earth-moon-barycenter",
    "JU": "jupiter", "MA": "mars", "ME": "mercury", "MO": "moon", "NE": "neptune",
    "PL": "pluto", "SA": "saturn", "SS": "solar-system-escape", "SU": "sun",
    "UR": "uranus", "VE": "venus",
}


def lookup(code: Column, table: dict[str, str]) -> Column:
    return F.try_element_at(literal_map(table), code)


def object_type(code: Column) -> Column:
    """Exact code match; anything else is ``unknown``."""

    return F.coalesce(lookup(code, OBJECT_TYPES), F.lit("unknown"))


def ops_status(code: Column) -> Column:
    return F.coalesce(lookup(code, OPS_STATUS), F.lit("unknown"))


def data_status(code: Column) -> Column:
    """Why an object has no elements; an unlisted code is dropped."""

    return lookup(F.upper(strip(code)), DATA_STATUS)


def orbit_center(code: Column) -> Column:
    """The body orbited; an unlisted code (such as a host's id) stays as it is."""

    cleaned = F.nullif(F.upper(strip(code)), F.lit(""))
    return F.coalesce(lookup(cleaned, ORBIT_CENTERS), cleaned)
