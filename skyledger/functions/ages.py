"""Ages, severities and due times, always against an explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.rounding import round_exact
from skyledger.functions.text import zoned_instant

# Severities in rising order.
SEVERITIES = ("ok", "warning", "critical")


def micros(instant: Column) -> Column:
    """Microseconds since 1970; zone-less instants are taken in the session zone (UTC)."""

    return F.unix_micros(instant.cast("timestamp"))


def age_seconds(instant: Column, as_of: Column) -> Column:
    return (micros(as_of) - micros(instant)) / F.lit(1_000_000.0)


def age_of_text(instant: Column, as_of: Column) -> Column:
    """The age of an instant given as text; null unless it states its zone."""

    return age_seconds(zoned_instant(instant), as_of)


def age_text(age: Column) -> Column:
    return F.format_string("%.1fh old", round_exact(age / F.lit(3600.0), 1))


def age_severity(age: Column, *, warning: int, critical: int) -> Column:
    """Both bounds are inclusive; an unknown age gives null."""

    return (
        F.when(age >= critical, "critical").when(age >= warning, "warning").when(age.isNotNull(), "ok")
    )


def severity_rank(severity: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name in SEVERITIES]), severity).cast("int") - 1


def severity_name(rank: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(name) for name in SEVERITIES]), rank + 1)


def next_attempt(retry_after: Column, last_attempt: Column, interval_seconds: int) -> Column:
    """The earliest instant a dataset may be requested again; null means at once."""

    floor = F.make_interval(secs=F.lit(interval_seconds))
    return F.coalesce(retry_after, last_attempt + floor)


def is_due(retry_after: Column, last_attempt: Column, interval_seconds: int, as_of: Column) -> Column:
    eligible = next_attempt(retry_after, last_attempt, interval_seconds)
    return eligible.isNull() | (eligible <= as_of)
