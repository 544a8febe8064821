"""Reading of upstream responses from a request log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sentence that marks a harmless refusal, the wire format in
# use, the summary length and the growth allowance.
UNCHANGED_MARKER = "has not updated since your last successful"
WIRE_FORMAT = "CSV"
DETAIL_CHARS = 500
GROWTH_PERCENT = 5


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def classify_response(status: Column, body: Column) -> Column:
    """The outcome a response stands for, before its body is parsed."""

    unchanged = F.lower(one_line(body)).contains(UNCHANGED_MARKER)
    return (
        F.when((status == 403) & unchanged, "not-updated")
        .when(status == 403, "forbidden")
        .when(status >= 500, "upstream-error")
        .when(status != 200, "http-error")
        .otherwise("received")
    )


def refusal_text(status: Column, body: Column) -> Column:
    """One line safe to publish: tags removed, blanks collapsed."""

    tagged = body.contains("<") & body.contains(">")
    plain = F.when(tagged, F.regexp_replace(body, "<[^>]+>", " ")).otherwise(body)
    detail = F.left(one_line(plain), F.lit(DETAIL_CHARS))
    label = F.concat(F.lit("HTTP "), status.cast("string"))
    return F.when(F.coalesce(detail, F.lit("")) == "", label).otherwise(F.concat_ws(": ", label, detail))


def expected_bytes(last_bytes: Column, last_format: Column) -> Column:
    """Forecast of the next response; a size from another format is no forecast."""

    padded = last_bytes + F.call_function("div", last_bytes * GROWTH_PERCENT, F.lit(100))
    return F.when(last_format == WIRE_FORMAT, padded)
