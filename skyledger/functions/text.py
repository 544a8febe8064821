"""Text cleaning, guarded number parsing and date parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank around a cell.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# What reads as a decimal number; ``try_cast`` alone also takes '1.5d' and '0x1p3'.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"
BIGINT_PATTERN = r"^[+-]?0*[0-9]{1,19}$"
NON_FINITE_PATTERN = r"(?i)^[+-]?(nan|inf|infinity)$"
HIGHEST_BIGINT = str(2**63 - 1)

# Month abbreviations as the tab-separated catalogue writes them.
MONTHS = {
    "Jan": "01", "Feb": "02", "Mar": "03", "Apr": "04", "May": "05", "Jun": "06",
    "Jul": "07", "Aug": "08", "Sep": "09", "Oct": "10", "Nov": "11", "Dec": "12",
}


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def literal_map(values: dict[str, str]) -> Column:
    """A constant map, folded once at planning time."""

    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def optional_string(text: Column) -> Column:
    """Trimmed text; blank and a lone dash are null."""

    return F.nullif(F.nullif(strip(text), F.lit("")), F.lit("-"))


def finite(value: Column) -> Column:
    """The value, or null for NaN and the infinities (NaN sorts above them)."""

    return F.when(F.abs(value) < F.lit(float("inf")), value)


def matched(text: Column, pattern: str) -> Column:
    """The text if it matches (a pattern that no empty text matches), else null.

    A failing ``try_cast`` builds and discards an exception, which costs far more
    than a match, so text is matched before it is cast. The text appears once in
    the expression and is worked out once in generated code, which keeps plans small where many cells are parsed.
    """

    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def parse_double(text: Column) -> Column:
    """A finite double, or null for anything that is not a plain decimal number.

    One match decides what is cast, and what is too large for a double becomes null again. The
    text appears once in the expression, as in :func:`matched`.
    """

    value = matched(strip(text), NUMBER_PATTERN).try_cast("double")
    return F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))


def number(text: Column, *, positive: bool = False) -> Column:
    """A number whose uncertainty marks ``? ~ *`` are dropped first."""

    value = parse_double(F.translate(text, "?~*", ""))
    return F.nullif(F.greatest(value, F.lit(0.0)), F.lit(0.0)) if positive else value


def canonical_id(text: Column) -> Column:
    """An integer identifier without leading zeros; null when it is not one."""

    return matched(strip(text), BIGINT_PATTERN).try_cast("bigint")


def digits_id(text: Column) -> Column:
    """Like :func:`canonical_id`, for sources that allow digits only (no sign)."""

    return matched(strip(text), "^0*[0-9]{1,19}$").try_cast("bigint")


def fits_bigint(integer: Column) -> Column:
    """Whether an integer token lies within the type, sign aside."""

    digits = F.regexp_replace(integer, "^[+-]?0*", "")
    short = F.char_length(integer) <= 18
    return short | (F.char_length(digits) < 19) | ((F.char_length(digits) == 19) & (digits <= HIGHEST_BIGINT))


def token_kind(text: Column) -> Column:
    """How a numeric cell reads: integer, float, out-of-range, non-finite or invalid."""

    return (
        F.when(text.rlike(INTEGER_PATTERN), F.when(fits_bigint(text), "integer").otherwise("out-of-range"))
        .when(parse_double(text).isNotNull(), "float")
        .when(strip(text).rlike(NON_FINITE_PATTERN) | strip(text).rlike(NUMBER_PATTERN), "non-finite")
        .otherwise("invalid")
    )


def whole_number(text: Column) -> Column:
    """A numeric cell as BIGINT; ``9.0`` is whole, and a cell with a fraction is null."""

    decimal = F.transform(F.array(matched(strip(text), r"^(?![+-]?\d+$)" + NUMBER_PATTERN[1:])), lambda t: t.try_cast("double"))
    whole = F.filter(decimal, lambda value: value == F.floor(value).cast("double"))
    return F.coalesce(matched(text, BIGINT_PATTERN).try_cast("bigint"), F.get(whole, F.lit(0)).try_cast("bigint"))


def iso_date(text: Column) -> Column:
    """``YYYY-MM-DD`` or ``YYYYMMDD`` as DATE; impossible and partial dates are null."""

    dashed = F.regexp_replace(strip(text), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return matched(dashed, r"^(?!0000)\d{4}-\d{2}-\d{2}$").try_cast("date")


def worded_date(text: Column) -> Column:
    """``1998 Nov 20 …`` as ISO text. The day is copied, not checked against the month."""

    pattern = r"^(\d{4})\s+([A-Z][a-z]{2})\s+(\d{1,2})\b"
    cleaned = strip(text)
    month = F.try_element_at(literal_map(MONTHS), F.regexp_extract(cleaned, pattern, 2))
    day = F.lpad(F.regexp_extract(cleaned, pattern, 3), 2, "0")
    return F.when(
        month.isNotNull(), F.concat_ws("-", F.regexp_extract(cleaned, pattern, 1), month, day)
    )


def name_list(text: Column) -> Column:
    """Names split on ``;`` or ``,``, trimmed, blanks dropped."""

    parts = F.transform(F.split(optional_string(text), "[;,]"), strip)
    return F.filter(parts, lambda part: part != "")


def zoned_instant(text: Column) -> Column:
    """An ISO instant that states its zone; null when it is naive or unreadable."""

    stated = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(stated, text.try_cast("timestamp"))


def epoch_instant(text: Column) -> Column:
    """An element epoch: ISO date or date-time, a zone optional, ``Z`` accepted (session is UTC).

    The basic form without separators and a comma before the fraction are put into the usual form first.
    """

    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    basic = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    timed = F.regexp_replace(basic, r"^(\d{4})(\d{2})(\d{2})T(\d{2})(\d{2})(\d{2})(?=$|[.,Z+-])", "$1-$2-$3T$4:$5:$6")
    usual = F.regexp_replace(timed, r"(:\d{2}),(?=\d)", "$1.")
    return F.coalesce(matched(text, shape), matched(usual, shape)).try_cast("timestamp")
