"""Three-way catalogue merge with field precedence and provenance."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.orbits import magnitude_estimate

DECAY_WINDOW_DAYS = 365


@dataclass(frozen=True)
class Field:
    """A merged field: (source label, column) candidates, the first present one wins."""

    name: str
    candidates: tuple[tuple[str, str], ...]


# Columns are prefixed s_ (satellite catalogue), g_ (general catalogue), m_ (magnitudes).
PRECEDENCE = (
    Field("cospar", (("satcat", "s_cospar"),)),
    Field("name", (("satcat", "s_name"),)),
    Field("altNames", (("gcat", "g_altNames"),)),
    Field("objectType", (("satcat", "s_objectType"),)),
    Field("opsStatus", (("satcat", "s_opsStatus"),)),
    Field("status", (("gcat", "g_status"), ("satcat:derived", "s_derivedStatus"))),
    Field("orbitClass", (("gcat", "g_orbitClass"),)),
    Field("owner", (("gcat", "g_owner"),)),
    Field("country", (("satcat", "s_country"), ("gcat", "g_country"))),
    Field("launchDate", (("gcat", "g_launchDate"), ("satcat", "s_launchDate"))),
    Field("launchSite", (("satcat", "s_launchSite"),)),
    Field("massKg", (("gcat", "g_massKg"),)),
    Field("dimensions", (("gcat", "g_dimensions"),)),
    Field("shape", (("gcat", "g_shape"),)),
    Field("rcsSize", (("satcat", "s_rcsSize"),)),
    Field("rcsValue_m2", (("satcat", "s_rcsValue_m2"),)),
    Field("dataStatus", (("satcat", "s_dataStatus"),)),
    Field("orbitCenter", (("satcat", "s_orbitCenter"),)),
    Field("approximateOrbit", (("satcat", "s_approximateOrbit"),)),
    Field("decayDate", (("satcat", "s_decayDate"),)),
)

# These are published even when null; every other null field is left out.
ALWAYS_PRESENT = ("dataStatus", "orbitCenter", "approximateOrbit")


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("norad", *[F.col(name).alias(prefix + name) for name in df.columns if name != "norad"])


def _winner(field: Field) -> Column:
    chosen = None
    for source, column in field.candidates:
        present = F.col(column).isNotNull()
        chosen = F.when(present, source) if chosen is None else chosen.when(present, source)
    return chosen


def merge_catalogues(satcat: DataFrame, gcat: DataFrame, magnitudes: DataFrame) -> DataFrame:
    """Every satellite-catalogue object with its merged fields and ``sources``.

    Inputs hold one row per ``norad``. All three are then already partitioned by
    that key, so the joins add no further shuffle, and no key can be hot.
    """

    names = F.col("g_altNames")
    base = _prefixed(satcat, "s_").withColumn("s_launchDate", F.col("s_launchDate").cast("string"))
    base = base.withColumn(
        "s_derivedStatus", F.when(F.col("s_decayDate").isNotNull(), "decayed").otherwise("in-orbit")
    )
    extra = _prefixed(gcat, "g_").withColumn("g_altNames", F.when(F.size(names) > 0, names))
    joined = (
        base.join(extra.withColumn("withGcat", F.lit(True)), "norad", "left")
        .join(_prefixed(magnitudes, "m_"), "norad", "left")
    )
    fields = [F.coalesce(*[F.col(column) for _, column in f.candidates]).alias(f.name) for f in PRECEDENCE]
    winners = [_winner(f).alias("_w_" + f.name) for f in PRECEDENCE]
    chosen = joined.select("norad", F.col("withGcat").isNotNull().alias("withGcat"), "m_stdMag", *fields, *winners)

    measured = F.col("m_stdMag").isNotNull()
    guessed = chosen.withColumn("_guess", F.when(~measured, magnitude_estimate(F.col("name"), F.col("launchDate"))))
    mag_source = F.when(measured, "mmccants").when(F.col("_guess").isNotNull(), "estimate")
    provenance = F.create_map(
        *[part for f in PRECEDENCE for part in (F.lit(f.name), F.col("_w_" + f.name))],
        F.lit("stdMag"), mag_source,
    )
    return guessed.select(
        "norad",
        *[f.name for f in PRECEDENCE],
        F.coalesce(F.col("m_stdMag"), F.col("_guess.mag")).alias("stdMag"),
        mag_source.alias("magSource"),
        F.col("_guess.basis").alias("magBasis"),
        F.map_filter(provenance, lambda _, source: source.isNotNull()).alias("sources"),
        "withGcat",
    )


def long_decayed(as_of: date) -> Column:
    """Decayed before the trailing window; null decay dates are kept."""

    cutoff = as_of - timedelta(days=DECAY_WINDOW_DAYS)
    return F.coalesce(F.col("decayDate") < F.lit(cutoff), F.lit(False))


def within_decay_window(merged: DataFrame, as_of: date) -> DataFrame:
    return merged.filter(~long_decayed(as_of))


def merge_metrics(merged: DataFrame, as_of: date) -> DataFrame:
    """One row of counts; the with… counts cover kept records only."""

    kept = ~long_decayed(as_of)
    return merged.agg(
        F.count_if(kept).alias("records"),
        F.count_if(kept & F.col("withGcat")).alias("with_gcat"),
        F.count_if(kept & (F.col("magSource") == "mmccants")).alias("with_mag"),
        F.count_if(kept & (F.col("magSource") == "estimate")).alias("with_mag_est"),
        F.count_if(~kept).alias("dropped_decayed"),
    )
