"""Derived orbital and physical fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.text import number, strip

# Orbit-class prefixes, tested in this order.
ORBIT_CLASSES = (
    ("LEO", ("LEO", "LLEO")),
    ("MEO", ("MEO",)),
    ("GEO", ("GEO", "GSO")),
    ("HEO", ("HEO", "GTO", "MOL", "EEO")),
)

# Magnitude guesses by name family; the third marks a match anywhere.
MAGNITUDE_FAMILIES = (
    ("ONEWEB", "start", 7.5, "OneWeb"),
    ("KUIPER", "start", 6.0, "Kuiper"),
    ("QIANFAN", "start", 5.5, "Qianfan"),
    ("HULIANWANG", "anywhere", 6.5, "Guowang"),
)
EARLY_STARLINK_BEFORE = "2020-06-01"


def rcs_band(value: Column) -> Column:
    return (
        F.when(value < 0.1, "small").when(value <= 1, "medium").when(value.isNotNull(), "large")
    )


def approximate_orbit(period: Column, inclination: Column, apogee: Column, perigee: Column) -> Column:
    """The catalogue's own orbit summary; null when it gives neither period nor inclination."""

    return F.when(
        period.isNotNull() | inclination.isNotNull(),
        F.struct(
            period.alias("periodMinutes"), inclination.alias("inclinationDeg"),
            apogee.alias("apogeeKm"), perigee.alias("perigeeKm"),
        ),
    )


def orbit_class(text: Column) -> Column:
    """First matching prefix; upper-cased but not trimmed."""

    upper = F.upper(text)
    chosen = None
    for label, prefixes in ORBIT_CLASSES:
        test = F.lit(False)
        for prefix in prefixes:
            test = test | upper.startswith(prefix)
        chosen = F.when(test, label) if chosen is None else chosen.when(test, label)
    return chosen.when((upper != "") & (upper != "-"), "other")


def lifecycle(text: Column) -> Column:
    first = F.substring(F.upper(strip(text)), 1, 1)
    return (
        F.when(first == "O", "in-orbit").when(first == "L", "landed").when(first.isin("R", "D"), "decayed")
    )


def first_positive(*texts: Column) -> Column:
    return F.coalesce(*[number(text, positive=True) for text in texts])


def dimensions(span: Column, length: Column, diameter: Column) -> Column:
    """The sizes that are known; null when there is none."""

    return F.when(
        F.coalesce(span, length, diameter).isNotNull(),
        F.struct(span.alias("span_m"), length.alias("length_m"), diameter.alias("diameter_m")),
    )


def magnitude_estimate(name: Column, launch_date: Column) -> Column:
    """``struct(mag, basis)`` guessed from the name family, or null.

    ``launch_date`` is ISO text, so text order is date order.
    """

    upper = F.upper(name)

    def guess(mag: float, basis: str) -> Column:
        return F.struct(F.lit(mag).alias("mag"), F.lit(basis).alias("basis"))

    starlink = upper.startswith("STARLINK")
    early = F.coalesce(F.nullif(launch_date, F.lit("")) < EARLY_STARLINK_BEFORE, F.lit(False))
    chosen = F.when(starlink & early, guess(4.5, "Starlink (early, pre-visor)")).when(
        starlink, guess(5.5, "Starlink")
    )
    for family, where, mag, basis in MAGNITUDE_FAMILIES:
        test = upper.startswith(family) if where == "start" else upper.contains(family)
        chosen = chosen.when(test, guess(mag, basis))
    return chosen


def right_ascension_degrees(hours: Column, minutes: Column, seconds: Column) -> Column:
    return F.lit(15) * (hours + minutes / F.lit(60) + seconds / F.lit(3600))


def declination_degrees(sign: Column, degrees: Column, minutes: Column, seconds: Column) -> Column:
    size = degrees + minutes / F.lit(60) + seconds / F.lit(3600)
    return size * F.when(sign == "-", F.lit(-1)).otherwise(F.lit(1))
