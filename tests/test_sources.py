"""Readers on real files."""

import json

import pytest
from pyspark.sql import functions as F

from skyledger.sources.catalogues import read_gcat, read_magnitudes, read_satcat
from skyledger.sources.elements import (
    DamagedSource, csv_gate, read_element_csv, read_element_json_array, read_element_json_lines, split_header,
)
from skyledger.sources.position import read_lines
from skyledger.sources.sky import by_magnitude, figure_documents, read_figures, read_stars

HEADER = ("OBJECT_NAME,OBJECT_ID,EPOCH,MEAN_MOTION,ECCENTRICITY,INCLINATION,RA_OF_ASC_NODE,ARG_OF_PERICENTER,"
          "MEAN_ANOMALY,EPHEMERIS_TYPE,CLASSIFICATION_TYPE,NORAD_CAT_ID,ELEMENT_SET_NO,REV_AT_EPOCH,BSTAR,"
          "MEAN_MOTION_DOT,MEAN_MOTION_DDOT")


def element(norad, name="SAT", mean_motion="15.5", bstar=".5115E-4", epoch="2026-08-16T13:36:37.459008"):
    return (f"{name},1998-067A,{epoch},{mean_motion},.0006,51.6,200.1,10.2,349.9,0,U,{norad},999,12,{bstar},.1E-5,0")


def body(*rows, header=HEADER, end="\r\n"):
    return end.join([header, *rows]) + end


@pytest.fixture
def landed(tmp_path):
    def write(content, name="gp.csv"):
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)

    return write


def gate(spark, path):
    return csv_gate(*read_element_csv(spark, path))


def test_positions_follow_the_file_however_it_is_split(spark, landed):
    path = landed("".join(f"{i}\n" for i in range(40_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        lines = read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 4
        values = [row["value"] for row in lines.repartition(5).orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert values == [str(i) for i in range(40_000)]


def test_good_csv(spark, landed):
    path = landed(body(element(25544, '"ISS, ""Z"""'), element(5, bstar="0")))
    assert gate(spark, path) is None
    records, _ = read_element_csv(spark, path)
    rows = records.orderBy("pos").collect()
    assert [row["object_name"] for row in rows] == ['ISS, "Z"', "SAT"]
    assert rows[0]["norad_cat_id"] == 25544 and rows[0]["bstar"] == 0.5115e-4
    assert rows[0]["epoch_at"].isoformat() == "2026-08-16T13:36:37.459008"


def test_columns_bind_by_name(spark, landed):
    names = HEADER.split(",")
    order = list(reversed(range(len(names))))
    swapped = ",".join(names[i] for i in order)
    row = ",".join(element(7).split(",")[i] for i in order)
    records, faults = read_element_csv(spark, landed(body(row, header=swapped)))
    assert csv_gate(records, faults) is None
    found = records.first()
    assert (found["norad_cat_id"], found["inclination"], found["mean_motion"]) == (7, 51.6, 15.5)


@pytest.mark.parametrize("content, reason", [
    (body(element(1)).rstrip("\r\n"), "last line is not ended"),
    (body(element(1), element(2)[:60]), "CSV row 1: wrong number of fields"),
    (body(element(1) + ",9"), "CSV row 0: wrong number of fields"),
    (body(element(1), "", element(2)), "CSV row 1: blank line"),
    (body(element(1, '"A"B')), "CSV row 0: malformed quoting"),
    (body(element(1), element(2, '"A')), "CSV row 1: malformed quoting"),
    (body(element(1, mean_motion="x")), "CSV row 0: invalid MEAN_MOTION"),
    (body(element(1, mean_motion="")), "CSV row 0: invalid MEAN_MOTION"),
    (body(element(1, bstar="NaN")), "CSV row 0: non-finite BSTAR"),
    (body(element("99999999999999999999")), "CSV row 0: out-of-range NORAD_CAT_ID"),
    (body(element(1), HEADER), "header is repeated"),
    (b"\xef\xbb\xbf" + body(element(1)).encode(), "last line is not ended"),
    (body(element(1), element(2)).encode().replace(b"SAT", b"S\xff", 1), "CSV row 0: not UTF-8"),
])
def test_damaged_csv(spark, landed, content, reason):
    assert reason in gate(spark, landed(content))


def test_bad_headers(spark, landed):
    with pytest.raises(DamagedSource, match="lacks EPOCH"):
        read_element_csv(spark, landed(body(header=HEADER.replace("EPOCH,", "", 1))))
    with pytest.raises(DamagedSource, match="no header line"):
        read_element_csv(spark, landed(""))
    with pytest.raises(DamagedSource, match="cannot be read"):
        split_header('"A"B,C')


def test_json_sources(spark, landed):
    names = HEADER.split(",")
    record = dict(zip(names, ["SAT", "1998-067A", "2026-08-16T13:36:37Z", 15.5, 0.1, 51.6, 1, 2, 3, 0, "U", 5, 999, 12, 0.5, 0, 0]))
    partial = {key: value for key, value in record.items() if key not in ("BSTAR", "EPOCH")}
    nulled = record | {"OBJECT_ID": None}
    lines = read_element_json_lines(spark, landed("\n".join(map(json.dumps, [record, partial, nulled, [1]])) + "\n", "a.jsonl"))
    found = [(row["damage"], row["norad_cat_id"]) for row in lines.orderBy("pos").collect()]
    assert found == [(None, 5), ("lacks BSTAR, EPOCH", 5), (None, 5), ("not an object", None)]
    whole = read_element_json_array(spark, landed(json.dumps([record, partial]), "a.json"))
    assert sorted(str(row["damage"]) for row in whole.collect()) == ["None", "lacks BSTAR, EPOCH"]


def test_satcat_file(spark, landed):
    header = "OBJECT_NAME,OBJECT_ID,NORAD_CAT_ID,OBJECT_TYPE,OPS_STATUS_CODE,OWNER,LAUNCH_DATE,LAUNCH_SITE,DECAY_DATE,RCS"
    rows = ["ISS (ZARYA),1998-067A,25544,PAY,+,ISS,1998-11-20,TYMSC,,400", "OLD,1998-067A,00007,PAY,+,ISS,1998-11-20,TYMSC,,0.05",
            "BAD,X,abc,PAY,+,,,,,", '"NEW, ""7""",1998-067A,7,DEB,D,US,1998-11-20,,2020-01-01,0.5', "", "SHORT,1,8,PAY"]
    found = {row["norad"]: row for row in read_satcat(spark, landed("\n".join([header, *rows]) + "\n")).collect()}
    assert sorted(found) == [7, 8, 25544]
    assert (found[7]["name"], found[7]["objectType"], found[7]["rcsSize"]) == ('NEW, "7"', "debris", "medium")
    assert found[25544]["rcsSize"] == "large" and found[25544]["dataStatus"] is None
    assert found[8]["decayDate"] is None and found[8]["opsStatus"] == "unknown"
    with pytest.raises(DamagedSource):
        read_satcat(spark, landed("A,B\n1,2\n", "other.csv"))


def test_gcat_file(spark, landed):
    names = "#JCAT\tSatcat\tLDate\tDDate\tStatus\tOwner\tState\tTotMass\tMass\tDryMass\tLength\tDiameter\tSpan\tShape\tOpOrbit\tAltNames"
    rows = ["S1\t25544\t1998 Nov 20\t\tO\tNASA\tUS\t419725\t0\t0\t73\t20\t109\tcomplex\tLEO/I\tISS; Zarya", "# remark", "",
            "S2\tA001\t-", "S3\t00009\t1998 Nov 20"]
    found = {row["norad"]: row for row in read_gcat(spark, landed("\n".join(["# note", names, *rows]) + "\n")).collect()}
    assert sorted(found) == [9, 25544]
    iss = found[25544]
    assert (iss["massKg"], iss["status"], iss["orbitClass"], iss["altNames"]) == (419725.0, "in-orbit", "LEO", ["ISS", "Zarya"])
    assert iss["dimensions"].asDict() == {"span_m": 109.0, "length_m": 73.0, "diameter_m": 20.0}
    assert found[9]["owner"] is None and found[9]["dimensions"] is None
    with pytest.raises(DamagedSource):
        read_gcat(spark, landed("S1\t1\n", "none.tsv"))


def test_magnitude_file(spark, landed):
    def line(norad, magnitude):
        return f"{norad:>5} obj".ljust(33) + f"{magnitude:>4}"

    content = "\n".join([line(25544, "-1.8"), line(1, "2.0"), line(99999, "2.0"), line("x", "1.0"), line(7, "bad"), line(25544, "-1.3"), "short"])
    assert [tuple(row) for row in read_magnitudes(spark, landed(content + "\n")).collect()] == [(25544, -1.3)]


def star_line(hr, magnitude, *, bayer="", ra=("05", "55", "10.3"), sign="+", dec=("07", "24", "25")):
    return (f"{hr:>4}{bayer:<10}".ljust(75) + "".join(ra) + sign + "".join(dec)).ljust(102) + f"{magnitude:>5}"


def test_star_file(spark, landed):
    lines = [star_line(2061, "0.50", bayer="58Alp Ori"), star_line(5, "4.51"), star_line(6, "4.50", sign="-"), star_line(7, "0.50"),
             star_line(8, ""), star_line(9, "1.0", ra=("  ", "55", "10.3")), "short"]
    names = landed(json.dumps({"2061": "Betelgeuse", "6": ""}), "names.json")
    rows = by_magnitude(read_stars(spark, landed("\n".join(lines) + "\n", "stars.dat"), names)).collect()
    assert [row["hr"] for row in rows] == [2061, 7, 6]
    assert rows[0]["name"] == "Betelgeuse" and rows[0]["bayer"] == "58Alp Ori"
    assert rows[0]["ra"] == round(15 * (5 + 55 / 60 + 10.3 / 3600), 4)
    assert rows[2]["dec"] == round(-(7 + 24 / 60 + 25 / 3600), 4)
    assert rows[1]["name"] is None


def test_figure_file(spark, landed):
    document = {"features": [
        {"id": "Ori", "geometry": {"coordinates": [[[-10.0, 5], [20.123456, 6, "z"]], [[1, 2]], [["1", 2], [3, 4]]]}},
        {"id": "And", "geometry": {"coordinates": [[[1, 2], [3, 4]]]}},
        {"id": "", "geometry": {"coordinates": [[[1, 2], [3, 4]]]}},
        {"id": "Bad", "geometry": {"coordinates": "none"}},
        {"id": "Ori", "geometry": {"coordinates": [[[5, 6], [7, 8]]]}},
    ]}
    rows = figure_documents(read_figures(spark, landed(json.dumps(document), "f.json"))).collect()
    assert [(row["id"], row["lines"]) for row in rows] == [
        ("And", [[1.0, 2.0, 3.0, 4.0]]), ("Ori", [[350.0, 5.0, 20.1235, 6.0], [5.0, 6.0, 7.0, 8.0]])]


def test_last_wins_under_a_hot_key(spark):
    from skyledger.operators.dedup import last_wins

    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("pos"))
    found = {row["k"]: row["pos"] for row in last_wins(rows.withColumn("v", F.col("pos")), "k", "pos").collect()}
    assert len(found) == 40_001 and found[-1] == 59_997


SATCAT_HEADER = "OBJECT_NAME,OBJECT_ID,NORAD_CAT_ID,OBJECT_TYPE,OPS_STATUS_CODE,OWNER,LAUNCH_DATE,LAUNCH_SITE,DECAY_DATE,RCS"


def test_three_catalogue_files_of_their_own_layout(spark, landed):
    first = landed(SATCAT_HEADER + "\r\nISS,1998-067A,25544,PAY,+,ISS,1998-11-20,TYMSC,,400\r\n", "a.csv")
    second = landed("NORAD_CAT_ID,DECAY_DATE,OBJECT_TYPE,OBJECT_ID,OBJECT_NAME\n7,2020-01-01,DEB,1998-067B,\"SEVEN, \"\"X\"\"\"\n25544,,PAY,1998-067A,ISS 2\n", "b.csv")
    third = landed("OBJECT_NAME," + SATCAT_HEADER + "\nskipped,NINE,1998-067C,9,PAY,+,US,,,,0.5\n", "c.csv")
    found = {row["norad"]: row for row in read_satcat(spark, [first, second, third]).collect()}
    assert {n: row["name"] for n, row in found.items()} == {7: 'SEVEN, "X"', 25544: "ISS 2", 9: "NINE"}
    assert found[7]["decayDate"].isoformat() == "2020-01-01" and found[7]["country"] is None and found[9]["rcsSize"] == "medium"
    names = ["#JCAT\tSatcat\tOwner\tTotMass", "#JCAT\tTotMass\tOwner\tSatcat", "#JCAT\tSatcat"]
    rows = ["S1\t5\tNASA\t12", "S2\t7?\tESA\t6", "S3\t8\tlost"]
    paths = [landed(f"# note\n{name}\n{row}\n\n", f"{i}.tsv") for i, (name, row) in enumerate(zip(names, rows))]
    found = {row["norad"]: row for row in read_gcat(spark, paths).collect()}
    assert {n: (row["owner"], row["massKg"]) for n, row in found.items()} == {5: ("NASA", 12.0), 6: ("ESA", 7.0), 8: (None, None)}


@pytest.mark.parametrize("content, reason", [
    (SATCAT_HEADER + "\nI\xffS,1998-067A,25544,PAY,+,ISS,,,,\n", "not UTF-8"),
    (SATCAT_HEADER + '\n"ISS\nZARYA",1998-067A,25544,PAY,+,ISS,,,,\n', "quoted cell is left open"),
    (SATCAT_HEADER.replace("DECAY_DATE", "DECAYED") + "\nISS,1998-067A,25544,PAY,+,ISS,,,,\n", "missing columns: DECAY_DATE"),
    ("", "empty"),
])
def test_one_damaged_catalogue_file_refuses_all(spark, landed, content, reason):
    good = landed(SATCAT_HEADER + '\n5" DISH,1998-067A,25544,PAY,+,"I""S,S",,,,\n', "good.csv")
    assert read_satcat(spark, good).first()["country"] == 'I"S,S'
    with pytest.raises(DamagedSource, match=reason):
        read_satcat(spark, [landed(content.encode("latin-1"), "bad.csv")] + ([good] if content else []))


def test_other_files_that_do_not_decode(spark, landed):
    with pytest.raises(DamagedSource, match="g.tsv: not UTF-8"):
        read_gcat(spark, landed(b"#JCAT\tSatcat\nS1\t5\xff\n", "g.tsv"))
    with pytest.raises(DamagedSource, match="m.mag: not UTF-8"):
        read_magnitudes(spark, landed(b"25544 \xff".ljust(33) + b"-1.8\n", "m.mag"))
    with pytest.raises(DamagedSource, match="s.dat: not ASCII"):
        read_stars(spark, landed((star_line(2061, "0.50") + "\né\n").encode(), "s.dat"), landed("{}", "n.json"))
    with pytest.raises(DamagedSource, match="not JSON"):
        read_figures(spark, landed('{"features": [', "f.json"))
    with pytest.raises(DamagedSource, match="not a JSON array"):
        read_element_json_array(spark, landed('{"a": 1}', "o.json"))


def test_figures_keep_json_types_and_come_in_pieces(spark, landed):
    rows = [{"id": "A", "geometry": {"coordinates": [[[i, 1], [i + 0.5, -2e0]]]}} for i in range(5)]
    rows += [{"id": 7, "geometry": {"coordinates": [[[True, 1], [2, 3, "x"]], [[None, 1], [2, 3]], [{"0": 1}, [2, 3]], "x", [[1], [2, 3]]]}},
             {"id": 0, "geometry": {"coordinates": [[[1, 1], [2, 3]]]}}, {"id": "none", "geometry": {"coordinates": {"a": [1]}}}, {"id": "B"}, 5, None]
    lines = read_figures(spark, landed(json.dumps({"features": rows}), "f.json"))
    found = [tuple(row) for row in figure_documents(lines, piece_lines=2).collect()]
    pair = [[float(i), 1.0, i + 0.5, -2.0] for i in range(5)]
    assert found == [("7", 0, [[1.0, 1.0, 2.0, 3.0]]), ("A", 0, pair[:2]), ("A", 1, pair[2:4]), ("A", 2, pair[4:])]


def test_json_array_tells_null_from_missing(spark, landed):
    record = dict(zip(HEADER.split(","), ["SAT", None, "2026-08-16T13:36:37Z", "15.5", 1e-7, 51.6, 1, 2, 3, 0, "U", 5, 999, 12, 0.5, 0, 0]))
    del record["REV_AT_EPOCH"]
    lost = {key: value for key, value in record.items() if key != "OBJECT_ID"}
    found = read_element_json_array(spark, landed(json.dumps([record, lost, 5, None]), "a.json")).orderBy("pos").collect()
    assert [row["damage"] for row in found] == [None, "lacks OBJECT_ID", "not an object", "not an object"]
    assert (found[0]["mean_motion"], found[0]["eccentricity"], found[0]["norad_cat_id"], found[0]["rev_at_epoch"]) == (15.5, 1e-7, 5, None)
