"""Column functions against values worked out by hand or by Python."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.functions import ages, codes, orbits, responses, text
from skyledger.functions.rounding import round_exact


def evaluate(spark, values, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row["r"] for row in rows.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


@pytest.mark.parametrize("digits, bound", [(4, 400.0), (1, 5000.0), (0, 90_000.0), (4, 1e6), (4, 1e13), (1, 1e17)])
def test_rounding_agrees_with_python(spark, digits, bound):
    generator = random.Random(digits)
    values = [generator.uniform(-bound, bound) for _ in range(20_000)]
    values += [15 * (h + m / 60 + s / 3600) for h in range(0, 24, 5) for m in range(0, 60, 7) for s in (0.3, 0.9, 12.3, 59.9)]
    values += [0.5, 1.5, 2.5, -0.5, 0.25, 0.35, 3.25, 0.00005, 0.00015, 1e-9, 0.0, 359.99995]
    values = [v for v in values if abs(v) <= bound]
    assert evaluate(spark, values, lambda c: round_exact(c, digits), "double") == [round(v, digits) for v in values]


def test_optional_string(spark):
    assert evaluate(spark, [" a ", "", "-", " - ", None, "\tx\r", "--"], text.optional_string) == [
        "a", None, None, None, None, "x", "--"]


def test_number_marks_and_java_only_tokens(spark):
    values = ["92.94", "96.70?", "~0.5", "12*", "-", "", None, "1.5d", "0x1p3", "nan", "inf", "1e999", "-.5E-3", " 7 ", "0.5 ?", "1_0"]
    assert evaluate(spark, values, text.number) == [
        92.94, 96.7, 0.5, 12.0, None, None, None, None, None, None, None, None, -0.0005, 7.0, 0.5, None]
    assert evaluate(spark, ["0", "-5", "3"], lambda c: text.number(c, positive=True)) == [None, None, 3.0]


def test_numbers_at_the_ends_of_the_doubles(spark):
    values = ["1e295", "1e304", "1.7e308", "1" * 30 + "e289", "1" * 400, "1e-400", "\u2003 7\u3000"]
    assert evaluate(spark, values, text.number) == [1e295, 1e304, 1.7e308, None, None, 0.0, 7.0]
    assert evaluate(spark, values[:5], text.token_kind) == ["float", "float", "float", "non-finite", "out-of-range"]


def test_epochs_in_other_forms(spark):
    import datetime as dt

    values = ["20260102T030405", "20260102", "2026-01-02T03:04:05,5Z", "2026-01-02T::", "20260102T0304"]
    found = evaluate(spark, values, lambda c: text.epoch_instant(c).cast("timestamp_ntz"))
    assert found == [dt.datetime(2026, 1, 2, 3, 4, 5), dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 2, 3, 4, 5, 500000), None, None]


def test_tokens(spark):
    values = ["12", "-7", "1.0", "1e5", ".5", "", "x", "NaN", "-Infinity", "1e400", "9223372036854775807",
              "9223372036854775808", "-9223372036854775807", "-9223372036854775808", "000000000000000000000005", "1.5f"]
    assert evaluate(spark, values, text.token_kind) == [
        "integer", "integer", "float", "float", "float", "invalid", "invalid", "non-finite", "non-finite", "non-finite",
        "integer", "out-of-range", "integer", "out-of-range", "integer", "invalid"]
    assert evaluate(spark, ["12", "5.9", "-5.0", "x", "9223372036854775808"], text.whole_number) == [12, None, -5, None, None]


def test_dates(spark):
    import datetime as dt

    values = ["2026-01-02", "20260102", "2026", "2026-1-1", "2001-02-30", "", None, " 1999-12-31 ", "2026-01-01T00"]
    assert evaluate(spark, values, text.iso_date) == [
        dt.date(2026, 1, 2), dt.date(2026, 1, 2), None, None, None, None, None, dt.date(1999, 12, 31), None]
    worded = ["1998 Nov 20", "2019 May  4 1200:30", "1998 Nov?", "1998 Foo 1", "1998 Nov 31", "1998 Nov 200", None]
    assert evaluate(spark, worded, text.worded_date) == ["1998-11-20", "2019-05-04", None, None, "1998-11-31", None, None]


def test_instants_need_a_zone(spark):
    values = ["2026-08-09T12:00:00+00:00", "2026-08-09T12:00:00", "2026-08-09T12:00:00Z", "soon", None]
    found = evaluate(spark, values, lambda c: text.zoned_instant(c).isNotNull())
    assert found == [True, False, True, False, False]


def test_ids_and_names(spark):
    assert evaluate(spark, ["007", " 25544 ", "-5", "abc", "1.0", ""], text.canonical_id) == [7, 25544, -5, None, None, None]
    assert evaluate(spark, ["007", "-5", "²", "00000000000000000000012"], text.digits_id) == [7, None, None, 12]
    assert evaluate(spark, ["ISS; Zarya", "A,B;;C ", ";", "-", None], text.name_list) == [
        ["ISS", "Zarya"], ["A", "B", "C"], [], None, None]


def test_codes(spark):
    assert evaluate(spark, ["PAY", "pay", "R/B", None, " PAY"], codes.object_type) == [
        "payload", "unknown", "rocket-body", "unknown", "unknown"]
    assert evaluate(spark, ["B", "S", "?", "z", "-"], codes.ops_status) == [
        "backup", "backup", "unknown", "unknown", "nonoperational"]
    assert evaluate(spark, [" nea", "ZZZ", None, "NIE "], codes.data_status) == [
        "no-elements-available", None, None, "no-initial-elements"]
    assert evaluate(spark, ["ea", "EL", "25544", " ", None], codes.orbit_center) == [
        "earth", "earth-lagrange", "25544", None, None]
    assert len(codes.ORBIT_CENTERS) == 21


def test_orbit_fields(spark):
    assert evaluate(spark, ["LEO/I", "LLEO", "meo", "GSO", "EEO", " LEO", "-", "", None], orbits.orbit_class) == [
        "LEO", "LEO", "MEO", "GEO", "HEO", "other", None, None, None]
    assert evaluate(spark, ["O", " l", "Reentry", "D?", "E", ""], orbits.lifecycle) == [
        "in-orbit", "landed", "decayed", "decayed", None, None]
    assert evaluate(spark, [0.05, 0.1, 1.0, 1.01, None], orbits.rcs_band, "double") == [
        "small", "medium", "medium", "large", None]


def test_magnitude_estimates(spark):
    rows = spark.createDataFrame(
        [("starlink-1", "2020-05-31"), ("STARLINK-2", "2020-06-01"), ("STARLINK-3", None), ("CZ Hulianwang", None),
         ("My ONEWEB", None), ("oneweb-1", None), (None, None)], "name string, day string")
    found = rows.select(orbits.magnitude_estimate(F.col("name"), F.col("day")).alias("g")).select("g.*").collect()
    assert [tuple(row) for row in found] == [
        (4.5, "Starlink (early, pre-visor)"), (5.5, "Starlink"), (5.5, "Starlink"), (6.5, "Guowang"), (None, None),
        (7.5, "OneWeb"), (None, None)]


def test_responses(spark):
    rows = spark.createDataFrame(
        [(403, "GP data\nHAS not   updated since your last\nsuccessful download"), (403, "<b>No</b> entry"), (500, ""),
         (404, "a < b"), (200, "ok")], "status int, body string")
    found = rows.select(
        responses.classify_response(F.col("status"), F.col("body")).alias("c"),
        responses.refusal_text(F.col("status"), F.col("body")).alias("t")).collect()
    assert [row["c"] for row in found] == ["not-updated", "forbidden", "upstream-error", "http-error", "received"]
    assert [row["t"] for row in found][1:4] == ["HTTP 403: No entry", "HTTP 500", "HTTP 404: a < b"]
    long = evaluate(spark, ["x" * 2000], lambda c: F.char_length(responses.refusal_text(F.lit(403), c)))
    assert long == [len("HTTP 403: ") + 500]


def test_age_bounds_are_inclusive(spark):
    hours = [17 + 59 / 60, 18.0, 35 + 59 / 60, 36.0]
    found = evaluate(spark, [h * 3600 for h in hours],
                     lambda c: ages.age_severity(c, warning=64_800, critical=129_600), "double")
    assert found == ["ok", "warning", "warning", "critical"]
    assert evaluate(spark, [900.0, 11_700.0], ages.age_text, "double") == ["0.2h old", "3.2h old"]


def test_ages_of_texts_need_a_zone(spark):
    as_of = F.lit("2026-08-09T13:00:00Z").cast("timestamp")
    values = ["2026-08-09T12:00:00+00:00", "2026-08-09T14:00:00+02:00", "2026-08-09T12:00:00", "soon", None]
    assert evaluate(spark, values, lambda c: ages.age_of_text(c, as_of)) == [3600.0, 3600.0, None, None, None]
