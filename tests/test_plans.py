"""Whole jobs on small landed files: publish, refuse, derive, release, monitor, stream."""

import json
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.operators.merge import merge_catalogues, merge_metrics, within_decay_window
from skyledger.operators.rules import Rule, RuleError, SHIPPED_RULES, validate_rules
from skyledger.plans.catalogue import CatalogueJob, CatalogueLimits, CataloguePaths
from skyledger.plans.elements import Dataset, ElementJobs, SHIPPED_DATASETS
from skyledger.plans.monitoring import health
from skyledger.sinks.artifacts import catalogue_digest, record_json
from skyledger.sinks.release import PublishError, ReleaseStore
from skyledger.streaming.landing import ingest_landed
from tests.test_sources import body, element, star_line

NOW = datetime(2026, 8, 9, 12, tzinfo=UTC)
ACTIVE = Dataset("active", minimum_records=1, maximum_count_drop_fraction=0.25)
RULES = (
    Rule("starlink", "active", pattern="^STARLINK", maximum_count_drop_fraction=0.4),
    Rule("geo", "active", minimum_mean_motion=0.95, maximum_mean_motion=1.05, maximum_count_drop_fraction=0.5),
    Rule("starlink-geo", "active", pattern="^STARLINK", minimum_mean_motion=0.95, maximum_mean_motion=1.05,
         maximum_count_drop_fraction=0.5),
)
MIXED = [element(1, "STARLINK-1008"), element(2, "STARLINK-1012"), element(3, "INTELSAT 901", "1.0027"),
         element(4, "COSMOS 2251 DEB"), element(5, "STARLINK-9001", "1.0")]


def land(tmp_path, content, name="snapshot.csv"):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    return str(path)


def names(frame):
    return [row["object_name"] for row in frame.orderBy("pos").collect()]


def test_publish_then_derive_then_nothing_to_do(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    outcome = jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    assert outcome.published and outcome.record_count == 5
    assert [o.result for o in jobs.derive(RULES, NOW)] == ["published"] * 3
    assert names(jobs.members(RULES[0])) == ["STARLINK-1008", "STARLINK-1012", "STARLINK-9001"]
    assert names(jobs.members(RULES[1])) == ["INTELSAT 901", "STARLINK-9001"]
    assert names(jobs.members(RULES[2])) == ["STARLINK-9001"]
    state = jobs.state_of("starlink")
    assert state["last_success"] == jobs.state_of("active")["last_success"] and state["record_count"] == 3
    assert jobs.derive(RULES, NOW + timedelta(hours=1)) == []


def test_refused_snapshot_keeps_the_published_one(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    success = jobs.state_of("active")["last_success"]
    cases = {
        "dropped from 5 to 3": body(*MIXED[:3]),
        "invalid BSTAR": body(*MIXED[:4], element(9, bstar="x")),
        "duplicate NORAD_CAT_ID": body(*MIXED[:4], element(1)),
        "out-of-range MEAN_MOTION": body(*MIXED[:4], element(9, mean_motion="20")),
        "invalid EPOCH": body(*MIXED[:4], element(9, epoch="today")),
        "not ended": body(*MIXED).rstrip("\r\n"),
        "lacks": body(*MIXED).replace("BSTAR", "B*", 1),
    }
    for number, (reason, content) in enumerate(cases.items(), start=1):
        outcome = jobs.refresh(ACTIVE, land(tmp_path, content, f"bad{number}.csv"), NOW + timedelta(hours=number))
        assert not outcome.published and reason in outcome.error
        state = jobs.state_of("active")
        assert state["last_success"] == success and state["record_count"] == 5 and state["error"] == outcome.error
        assert len(names(jobs.store.read("active", "records"))) == 5


def test_old_versions_go_but_pointed_ones_stay(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"), keep=2)
    for number in range(4):
        rows = MIXED if number == 0 else [row.replace("STARLINK", "RENAMED") for row in MIXED]
        at = NOW + timedelta(hours=number)
        jobs.refresh(ACTIVE, land(tmp_path, body(*rows), f"{number}.csv"), at)
        jobs.derive(RULES[:2], at)
    assert len(jobs.store.listed("active")) == 2
    assert len(jobs.store.listed("active.subsets")) == 3
    assert len(names(jobs.members(RULES[0]))) == 3 and len(names(jobs.members(RULES[1]))) == 2


def test_floor_comes_before_record_faults(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    outcome = jobs.refresh(Dataset("active", minimum_records=10), land(tmp_path, body(element(0))), NOW)
    assert outcome.error == "record count 1 is below minimum 10"


def test_failed_rule_leaves_the_others_and_its_old_members(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    jobs.derive(RULES, NOW)
    renamed = [row.replace("STARLINK", "RENAMED") for row in MIXED]
    later = NOW + timedelta(hours=6)
    jobs.refresh(ACTIVE, land(tmp_path, body(*renamed), "second.csv"), later)
    found = {o.dataset: o for o in jobs.derive(RULES, later)}
    assert found["geo"].published and not found["starlink"].published
    assert "below minimum 1" in found["starlink"].error
    assert len(names(jobs.members(RULES[0]))) == 3
    assert jobs.state_of("starlink")["record_count"] == 3


def test_rule_lists_are_refused_whole(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    for bad in (RULES[0], Rule("named", "active", pattern="(?P<n>STAR).*")):
        with pytest.raises(RuleError):
            jobs.derive([*RULES, bad], NOW)
    assert "last_result" not in jobs.state_of("starlink")


def test_unreadable_source_is_recorded(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    jobs._record({"dataset": "active", "run_at": NOW, "last_success": NOW, "record_count": 5})
    found = jobs.derive(RULES[:1], NOW)
    assert [o.result for o in found] == ["source-unreadable"]
    assert jobs.state_of("starlink")["last_result"] == "source-unreadable"


def test_inherited_request_fields_are_cleared(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    jobs.derive(RULES[:1], NOW)
    jobs._record(jobs.state_of("starlink") | {"run_at": NOW + timedelta(hours=1), "last_http_status": 200})
    assert jobs.derive(RULES[:1], NOW + timedelta(hours=2)) == []
    state = jobs.state_of("starlink")
    assert state["last_http_status"] is None and state["record_count"] == 3


def test_digest_ignores_order_and_partitions(spark, tmp_path):
    digests = []
    for number, rows in enumerate((MIXED, MIXED[::-1])):
        jobs = ElementJobs(spark, str(tmp_path / f"store{number}"))
        jobs.refresh(ACTIVE, land(tmp_path, body(*rows), f"{number}.csv"), NOW)
        digests.append(jobs.state_of("active")["sha256"])
    assert digests[0] == digests[1] and len(digests[0]) == 64


@pytest.mark.parametrize("rule, reason", [
    (Rule("active", "active", pattern="x"), "duplicate"),
    (Rule("Upper", "active", pattern="x"), "lowercase"),
    (Rule("a", "other", pattern="x"), "unknown source"),
    (Rule("a", "active"), "needs a pattern"),
    (Rule("a", "active", pattern="("), "bad pattern"),
    (Rule("a", "active", pattern="  "), "empty pattern"),
    (Rule("a", "active", minimum_mean_motion=20.0), "between 0 and 20"),
    (Rule("a", "active", minimum_mean_motion=2.0, maximum_mean_motion=1.0), "above"),
    (Rule("a", "active", pattern="x", minimum_records=0), "positive"),
    (Rule("a", "active", pattern="x", maximum_count_drop_fraction=1.1), "between 0 and 1"),
])
def test_rule_lists_are_checked(rule, reason):
    with pytest.raises(RuleError, match=reason):
        validate_rules([rule], ["active"])


def test_shipped_configuration_covers_thirteen_names():
    sources = [dataset.name for dataset in SHIPPED_DATASETS]
    validate_rules(SHIPPED_RULES, sources)
    assert len({*sources, *[rule.name for rule in SHIPPED_RULES]}) == 13


def test_release_store(spark, tmp_path):
    store = ReleaseStore(spark, str(tmp_path / "store"), keep=2)
    for number in range(4):
        store.stage("catalog", f"v{number}", {"rows": spark.range(number + 1)})
        assert store.current("catalog") == (f"v{number - 1}" if number else None)
        store.point("catalog", f"v{number}", NOW)
    with pytest.raises(PublishError, match="already exists"):
        store.stage("catalog", "v1", {"rows": spark.range(1)})
    with pytest.raises(PublishError, match="unsafe"):
        store.stage("catalog", "../x", {"rows": spark.range(1)})
    store.point("catalog", "v0", NOW)
    assert store.read("catalog", "rows").count() == 1
    assert store.prune("catalog") == ["v1"]
    assert sorted(row["version"] for row in store.versions("catalog").collect()) == ["v0", "v2", "v3"]
    with pytest.raises(ValueError):
        ReleaseStore(spark, str(tmp_path), keep=1)


@pytest.fixture
def catalogue_files(tmp_path):
    header = ("OBJECT_NAME,OBJECT_ID,NORAD_CAT_ID,OBJECT_TYPE,OPS_STATUS_CODE,OWNER,LAUNCH_DATE,LAUNCH_SITE,DECAY_DATE,"
              "PERIOD,INCLINATION,APOGEE,PERIGEE,RCS,DATA_STATUS_CODE,ORBIT_CENTER")
    rows = ["ISS (ZARYA),1998-067A,25544,PAY,+,ISS,1998-11-20,TYMSC,,92.94,51.63,424,413,399,,EA",
            "USA 224,2011-002A,37348,PAY,+,US,2011-01-20,AFWTR,,96.70,97.94,948,258,,NEA,EA",
            "STARLINK-1,2019-029A,44235,PAY,+,,2019-05-24,AFETR,,,,,,,,EA",
            "OLD,1958-001A,4,PAY,D,US,1958-02-01,AFETR,1970-03-31,,,,,,,",
            "GONE,1998-067B,5,PAY,D,US,1998-02-01,AFETR,2026-03-31,,,,,,,"]
    gcat = "#JCAT\tSatcat\tLDate\tStatus\tOwner\tState\tTotMass\tMass\tDryMass\tSpan\tLength\tDiameter\tOpOrbit\tAltNames\tShape"
    line = "S1\t25544\t1998 Nov 21\tO\tNASA\tRU\t419725\t\t\t109\t\t\tLEO/I\tISS; Zarya\tbox"
    star = "S2\t44235\t-\t\tSPX\tUS\t-\t227\t\t\t\t\tLLEO/I\t;\t-"
    figure = {"features": [{"id": "Ori", "geometry": {"coordinates": [[[1, 2], [3, 4]]]}}]}
    return CataloguePaths(
        satcat=land(tmp_path, "\n".join([header, *rows]) + "\n", "in/satcat.csv"),
        gcat=land(tmp_path, "\n".join([gcat, line, star]) + "\n", "in/gcat.tsv"),
        magnitudes=land(tmp_path, "25544 obj".ljust(33) + "-1.8\n", "in/qs.mag"),
        stars=land(tmp_path, star_line(2061, "0.50") + "\n", "in/stars.dat"),
        star_names=land(tmp_path, '{"2061": "Betelgeuse"}', "in/names.json"),
        figures=land(tmp_path, json.dumps(figure), "in/figures.json"),
    )


LIMITS = CatalogueLimits(satcat=1, magnitudes=1, stars=1, figures=1, gcat_join_fraction=0.4)


def test_catalogue_release(spark, tmp_path, catalogue_files):
    job = CatalogueJob(spark, str(tmp_path / "store"), limits=LIMITS)
    outcome = job.run(catalogue_files, NOW)
    assert (outcome.result, outcome.record_count) == ("published", 4) and outcome.error is None
    assert outcome.release.startswith("20260809T120000Z-")
    records = {row["norad"]: row for row in job.store.read("catalog", "records").collect()}
    iss, starlink = records[25544], records[44235]
    assert (iss["launchDate"], iss["country"], iss["owner"], iss["stdMag"], iss["magSource"]) == (
        "1998-11-21", "ISS", "NASA", -1.8, "mmccants")
    assert iss["sources"]["launchDate"] == "gcat" and iss["sources"]["country"] == "satcat"
    assert (starlink["country"], starlink["sources"]["country"], starlink["altNames"]) == ("US", "gcat", None)
    assert (starlink["stdMag"], starlink["magBasis"]) == (4.5, "Starlink (early, pre-visor)")
    assert starlink["sources"]["status"] == "satcat:derived" and starlink["status"] == "in-orbit"
    assert 4 not in records and records[5]["status"] == "decayed"
    manifest = job.store.read("catalog", "manifest").first()
    assert (manifest["dropped_decayed"], manifest["with_gcat"], manifest["with_mag"], manifest["with_mag_est"]) == (1, 2, 1, 1)
    assert manifest["buckets"] == 4 and manifest["rows_satcat"] == 5
    path = job.store.version_path("catalog", outcome.release, "index")
    index = {row["norad"]: row for row in map(json.loads, [r["value"] for r in spark.read.text(path).collect()])}
    assert index["37348"]["dataStatus"] == "no-elements-available" and "magEst" not in index["37348"]
    assert index["44235"]["magEst"] == 1 and index["37348"]["stdMag"] is None
    shard = job.enrichment().filter("bucket = 37")
    record = json.loads(shard.first()["record"])
    assert record["dataStatus"] == "no-elements-available" and "massKg" not in record
    assert record["approximateOrbit"]["apogeeKm"] == 948.0 and record["_sources"]["dataStatus"] == "satcat"
    gone = json.loads(job.enrichment().filter("norad = 5").first()["record"])
    assert gone["dataStatus"] is None and gone["approximateOrbit"] is None and gone["orbitCenter"] is None

    again = job.run(catalogue_files, NOW + timedelta(hours=1))
    assert (again.result, again.changed, again.successful) == ("unchanged", False, True)
    assert job.store.current("catalog") == outcome.release


def test_catalogue_gates_keep_the_release(spark, tmp_path, catalogue_files):
    root = str(tmp_path / "store")
    first = CatalogueJob(spark, root, limits=LIMITS).run(catalogue_files, NOW)
    for hours, (limits, reason) in enumerate((
        (CatalogueLimits(satcat=6, magnitudes=1, stars=1, figures=1), "SATCAT count 5 is below minimum 6"),
        (CatalogueLimits(satcat=1, magnitudes=1, stars=1, figures=1, gcat_join_fraction=0.9), "join fraction"),
        (CatalogueLimits(satcat=1, magnitudes=1, stars=2, figures=1), "star count 1 is below minimum 2"),
    ), start=2):
        job = CatalogueJob(spark, root, limits=limits)
        outcome = job.run(catalogue_files, NOW + timedelta(hours=hours))
        assert not outcome.successful and reason in outcome.error
        assert job.store.current("catalog") == first.release
        assert job.status().first()["error"] == outcome.error


def test_merge_and_digest_do_not_depend_on_layout(spark, catalogue_files):
    from skyledger.sources.catalogues import read_gcat, read_magnitudes, read_satcat

    inputs = [read_satcat(spark, catalogue_files.satcat), read_gcat(spark, catalogue_files.gcat),
              read_magnitudes(spark, catalogue_files.magnitudes)]
    plain = merge_catalogues(*inputs)
    mixed = merge_catalogues(*[frame.repartition(5).orderBy(F.rand(3)) for frame in inputs])
    day = date(2026, 8, 9)
    assert merge_metrics(plain, day).collect() == merge_metrics(mixed, day).collect()
    digests = {catalogue_digest(within_decay_window(frame, day)).first() for frame in (plain, mixed)}
    assert len(digests) == 1
    assert catalogue_digest(plain).first() not in digests
    texts = [sorted(r["t"] for r in frame.select(record_json().alias("t")).collect()) for frame in (plain, mixed)]
    assert texts[0] == texts[1]


def test_health(spark, tmp_path, catalogue_files):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    job = CatalogueJob(spark, str(tmp_path / "store"), limits=LIMITS)
    job.run(catalogue_files, NOW)
    runs = spark.sql("""select timestamp'2026-08-09 12:00:00' as checked_at, 1 as published, 1048576L as daily_bytes, 83886080L as budget_bytes,
        false as blocked, cast(null as string) as stop_reason, false as budget_exhausted, 0 as derived_failed""")

    def evaluate(at, rows=runs):
        found = health(F.lit(at), expected=["active", "stations"], states=jobs.states(), runs=rows,
                       catalogue=job.status(), manifest=job.store.read("catalog", "manifest"))
        return {row["name"]: (row["severity"], row["detail"]) for row in found.collect()}

    fresh = evaluate(NOW + timedelta(hours=1))
    assert fresh["gp:active"] == ("ok", "1.0h old")
    assert fresh["gp:stations"] == ("critical", "no status row")
    assert fresh["gp-run"] == ("ok", "last run 1.0h old; 1 published, 1.0 MiB/24h of 80 MiB")
    assert fresh["catalog"][0] == "ok" and fresh["public-tree"] == ("ok", "4 records published")
    late = evaluate(NOW + timedelta(hours=36), runs.filter("false"))
    assert late["gp:active"][0] == "critical" and late["catalog"][0] == "warning"
    assert late["gp-run"] == ("critical", "no run row")


def test_streamed_snapshots_are_taken_once(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    clock = iter(NOW + timedelta(hours=n) for n in range(10))
    folder, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    land(folder, body(*MIXED), "a.csv")
    ingest_landed(spark, jobs, ACTIVE, str(folder), checkpoint, lambda: next(clock))
    assert jobs.state_of("active")["record_count"] == 5
    land(folder, body(*MIXED, element(6)), "b.csv")
    ingest_landed(spark, jobs, ACTIVE, str(folder), checkpoint, lambda: next(clock))
    assert jobs.state_of("active")["record_count"] == 6
    ingest_landed(spark, jobs, ACTIVE, str(folder), checkpoint, lambda: next(clock))
    assert next(clock) == NOW + timedelta(hours=2)


def test_second_of_two_writers_is_refused(spark, tmp_path):
    ours, theirs = (ReleaseStore(spark, str(tmp_path / "store")) for _ in range(2))
    seen = ours.sequence("catalog"), theirs.sequence("catalog")
    ours.stage("catalog", "v1", {"rows": spark.range(1)})
    theirs.stage("catalog", "v2", {"rows": spark.range(2)})
    theirs.point("catalog", "v2", NOW, after=seen[1])
    with pytest.raises(PublishError, match="meanwhile"):
        ours.point("catalog", "v1", NOW, after=seen[0])
    assert ours.current("catalog") == "v2" and ours.sequence("catalog") == 1
    ours.point("catalog", "v1", NOW, after=ours.sequence("catalog"))
    assert theirs.current("catalog") == "v1"


def test_a_file_is_put_once(spark, tmp_path):
    from skyledger.sinks.tables import put_if_absent, read_small

    path = str(tmp_path / "folder/one.json")
    assert put_if_absent(spark, path, "é 1") and not put_if_absent(spark, path, "2") and read_small(spark, path) == "é 1"


def test_pointers_go_with_their_versions_and_torn_ones_are_passed_over(spark, tmp_path):
    store = ReleaseStore(spark, str(tmp_path / "store"), keep=2)
    for number in range(5):
        store.stage("catalog", f"v{number}", {"rows": spark.range(1)})
        store.point("catalog", f"v{number}", NOW)
    (tmp_path / "store/pointers/catalog/000000000006.json").write_text("{")
    assert store.current("catalog") == "v4" and store.sequence("catalog") == 6
    assert store.prune("catalog") == ["v0", "v1", "v2"]
    assert store._numbers("catalog") == [4, 5, 6]
    store.point("catalog", "v3", NOW)
    assert store.current("catalog") == "v3" and store.sequence("catalog") == 7


def test_refresh_that_was_overtaken_is_refused(spark, tmp_path, monkeypatch):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    real = ReleaseStore.stage

    def overtaken(store, stream, version, parts):
        real(store, stream, version, parts)
        monkeypatch.setattr(ReleaseStore, "stage", real)
        ElementJobs(spark, str(tmp_path / "store")).refresh(ACTIVE, land(tmp_path, body(*MIXED, element(6)), "b.csv"), NOW + timedelta(hours=2))

    monkeypatch.setattr(ReleaseStore, "stage", overtaken)
    outcome = jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED[:4]), "c.csv"), NOW + timedelta(hours=1))
    assert not outcome.published and "meanwhile" in outcome.error
    assert len(names(jobs.store.read("active", "records"))) == 6 and len(jobs.store.listed("active")) == 2


def test_a_batch_taken_again_makes_no_second_version(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    path = land(tmp_path, body(*MIXED))
    first = jobs.refresh(ACTIVE, path, NOW, landing="s.0")
    again = jobs.refresh(ACTIVE, path, NOW + timedelta(hours=1), landing="s.0")
    assert first == again and len(jobs.store.listed("active")) == 1
    assert jobs.state_of("active")["run_at"] == NOW.replace(tzinfo=None)

    # Lost after the pointer and before the state row: the row is written, the version stays.
    lost = "20260809T140000000000Z-s.1"
    records = jobs.store.read("active", "records")
    jobs.store.stage("active", lost, {"records": records})
    jobs.store.point("active", lost, NOW)
    done = jobs.refresh(ACTIVE, path, NOW + timedelta(hours=2), landing="s.1")
    assert done.published and jobs.store.current("active") == lost and jobs.state_of("active")["landing"] == "s.1"

    # Lost before the pointer: what it left is removed.
    half = "20260809T143000000000Z-s.2"
    jobs.store.stage("active", half, {"records": records})
    assert jobs.refresh(ACTIVE, path, NOW + timedelta(hours=3), landing="s.2").published
    assert half not in jobs.store.listed("active") and jobs.store.current("active").endswith("-s.2")


def test_empty_landed_files_get_state_rows(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    clock = iter(NOW + timedelta(hours=n) for n in range(10))
    folder, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    land(folder, body(*MIXED), "a.csv")
    land(folder, "", "b.csv")
    land(folder, "", "c.csv")
    ingest_landed(spark, jobs, ACTIVE, str(folder), checkpoint, lambda: next(clock))
    rows = spark.read.parquet(jobs.state_path).orderBy("run_at").collect()
    assert sorted(row["last_result"] for row in rows) == ["published", "validation-error", "validation-error"]
    assert sorted(row["landed_path"].rsplit("/", 1)[1] for row in rows) == ["a.csv", "b.csv", "c.csv"]
    assert len({row["landing"] for row in rows}) == 3
    assert [row["error"] for row in rows if row["error"]] == ["no header line"] * 2


@pytest.mark.parametrize("damage", ["cut", "garbled"])
def test_damaged_published_version_leaves_other_sources_alone(spark, tmp_path, damage):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    other = Dataset("stations", minimum_records=1)
    jobs.refresh(ACTIVE, land(tmp_path, body(*MIXED)), NOW)
    jobs.refresh(other, land(tmp_path, body(*MIXED[:2]), "s.csv"), NOW)
    folder = tmp_path / "store/releases/active" / jobs.store.current("active") / "records"
    for file in folder.glob("part-*.parquet"):
        data = file.read_bytes()
        file.write_bytes(data[:len(data) // 2] if damage == "cut" else data[:4] + b"\xa5" * (len(data) // 2) + data[4 + len(data) // 2:])
    for crc in folder.glob(".*.crc"):
        crc.unlink()
    found = jobs.derive([RULES[0], Rule("their-starlink", "stations", pattern="^STARLINK")], NOW)
    assert [(o.dataset, o.result) for o in found] == [("starlink", "source-unreadable"), ("their-starlink", "published")]
    assert "cannot be read" in jobs.state_of("starlink")["error"] and jobs.store.listed("active.subsets") == []


def test_run_summary_feeds_the_run_check(spark, tmp_path):
    jobs = ElementJobs(spark, str(tmp_path / "store"))
    log = spark.createDataFrame(
        [(NOW - timedelta(hours=30), 9, "received"), (NOW - timedelta(hours=24), 7, "received"), (NOW - timedelta(hours=3), 2 << 20, "received"),
         (NOW + timedelta(hours=6), 1, "forbidden")], "ts timestamp, bytes long, outcome string")
    bad = land(tmp_path, body(element(1, bstar="x")), "bad.csv")
    rules = [*RULES[:2], Rule("none", "active", pattern="^NOTHING")]
    jobs.run([(ACTIVE, land(tmp_path, body(*MIXED))), (Dataset("stations"), bad)], rules, NOW, requests=log, budget_bytes=80 << 20)
    jobs.run([], rules, NOW + timedelta(hours=6), requests=log, budget_bytes=1 << 20)
    first, second = jobs.runs().orderBy("checked_at").collect()
    assert (first["attempted"], first["published"], first["failed"], first["derived_published"], first["derived_failed"]) == (2, 1, 1, 2, 1)
    assert (first["daily_bytes"], first["budget_remaining_bytes"], first["blocked"]) == (2 << 20, 78 << 20, False)
    assert (second["attempted"], second["derived_failed"], second["daily_bytes"], second["budget_remaining_bytes"]) == (0, 1, (2 << 20) + 1, 0)

    def check(hours, runs):
        found = health(F.lit(NOW + timedelta(hours=hours)), expected=[], states=jobs.states(), runs=runs,
                       catalogue=spark.createDataFrame([], "checked_at timestamp, successful boolean, result string, error string"),
                       manifest=spark.createDataFrame([], "records long"))
        return next((row["severity"], row["detail"]) for row in found.collect() if row["name"] == "gp-run")

    assert check(1, jobs.runs().filter(F.col("checked_at") == F.lit(NOW))) == (
        "warning", "1 subsets not published; 1 published, 2.0 MiB/24h of 80 MiB")
    assert check(7, jobs.runs())[0] == "critical" and "forbidden" in check(7, jobs.runs())[1]


def snapshots_of(spark, *rows):
    return spark.createDataFrame(rows, "source string, ts timestamp, status int, body_path string, error string")


def test_sources_are_served_from_their_last_good_body(spark, tmp_path, catalogue_files):
    from dataclasses import replace

    vendored = replace(catalogue_files, satcat=None, gcat=None)
    job = CatalogueJob(spark, str(tmp_path / "store"), limits=LIMITS)
    fetched = [("satcat", NOW, 200, catalogue_files.satcat, None), ("gcat", NOW, 200, catalogue_files.gcat, None)]
    nothing = job.run(vendored, NOW - timedelta(hours=1), snapshots=snapshots_of(spark, *fetched))
    assert (nothing.result, job.store.current("catalog")) == ("failed", None) and "satcat: no good body" in nothing.error
    assert job.run(vendored, NOW, snapshots=snapshots_of(spark, *fetched)).result == "published"
    served = {row["source"]: row.asDict() for row in job.store.read("catalog", "sources").collect()}
    assert (served["satcat"]["ok"], served["satcat"]["stale"], served["satcat"]["from_cache"], served["satcat"]["rows"]) == (True, False, False, 5)
    assert served["figures"]["vendored"] and served["stars"]["rows"] == 1

    day = NOW + timedelta(days=1)
    same = job.run(vendored, day, snapshots=snapshots_of(spark, *fetched, ("satcat", day, 304, None, None), ("gcat", day, 304, None, None)))
    assert (same.result, same.changed) == ("unchanged", False)
    later = NOW + timedelta(days=2)
    outage = job.run(vendored, later, snapshots=snapshots_of(spark, *fetched, ("satcat", later, None, None, "offline"), ("gcat", later, 503, None, None)))
    assert outage.result == "unchanged" and len(job.store.listed("catalog")) == 1
    status = {(row["checked_at"], row["source"]): row for row in job.source_status().collect()}
    assert not status[day.replace(tzinfo=None), "satcat"]["stale"] and status[day.replace(tzinfo=None), "satcat"]["from_cache"]
    stale = status[later.replace(tzinfo=None), "satcat"]
    assert (stale["stale"], stale["error"], stale["fetched_at"]) == (True, "offline", NOW.replace(tzinfo=None))
    assert status[later.replace(tzinfo=None), "gcat"]["error"] == "HTTP 503"
    assert status[(NOW - timedelta(hours=1)).replace(tzinfo=None), "satcat"]["ok"] is False


def test_first_failure_publishes_nothing(spark, tmp_path, catalogue_files):
    job = CatalogueJob(spark, str(tmp_path / "store"), limits=LIMITS)
    failed = job.run(catalogue_files, NOW, snapshots=snapshots_of(spark, ("satcat", NOW, None, None, "offline"), ("gcat", NOW, 503, None, None)))
    assert (failed.result, failed.error) == ("failed", "satcat: no good body so far (offline)")
    assert job.store.current("catalog") is None and job.status().first()["result"] == "failed"


def test_sources_as_of_each_run(spark):
    from skyledger.operators.state import sources_as_of

    def at(hours):
        return NOW + timedelta(hours=hours)

    rows = [("a", at(1), 200, "one", None), ("a", at(3), 503, None, None), ("a", at(5), 304, None, None), ("a", at(7), 200, "two", None),
            ("b", at(2), None, None, "offline")]
    runs = [("a", at(h)) for h in range(9)] + [("b", at(1)), ("b", at(2)), ("c", at(1))]
    found = {(r.source, r.run_at): tuple(r)[2:] for r in sources_as_of(spark.createDataFrame(runs, "source string, run_at timestamp"), snapshots_of(spark, *rows)).collect()}

    def naive(hours):
        return at(hours).replace(tzinfo=None)

    none = (None, None, None, None, None, False)
    one = ("one", naive(1), False, False, None, True)
    stale, same = ("one", naive(1), True, True, "HTTP 503", True), ("one", naive(1), True, False, None, True)
    two = ("two", naive(7), False, False, None, True)
    assert [found["a", naive(h)] for h in range(9)] == [none, one, one, stale, stale, same, same, two, two]
    assert found["b", naive(1)] == none and found["b", naive(2)] == (None, None, True, True, "offline", False) and found["c", naive(1)] == none


def test_unchanged_shards_keep_their_files(spark, tmp_path, catalogue_files):
    job = CatalogueJob(spark, str(tmp_path / "store"), limits=LIMITS, keep=2)
    shards = tmp_path / "store/shards"

    def files():
        return {p.relative_to(shards): (p.stat().st_ino, p.stat().st_mtime_ns) for p in shards.rglob("part-*.json")}

    job.run(catalogue_files, NOW)
    first, text = files(), open(catalogue_files.satcat).read()
    assert len(first) == 4
    steps = [text.replace("USA 224", "USA 225"), text.replace("USA 224", "USA 226").replace("STARLINK-1,", "STARLINK-9,"), text.replace("USA 224", "USA 227")]
    for number, changed in enumerate(steps, start=1):
        land(tmp_path, changed, "in/satcat.csv")
        assert job.run(catalogue_files, NOW + timedelta(hours=number)).changed
        if number == 1:
            kept = files()
            assert {p: s for p, s in kept.items() if p in first} == first and len(kept) == 5
            named = [(row["bucket"], row["change"]) for row in job.store.read("catalog", "shard_changes").collect()]
            assert named == [(37, "changed")] and job.store.read("catalog", "manifest").first()["shards_changed"] == 1
    assert len(job.store.listed("catalog")) == 2 and job.enrichment().count() == 4
    assert sorted(json.loads(r["record"])["name"] for r in job.enrichment().collect())[-1] == "USA 227"
    # Shards that only dropped releases had are gone: 4 now, and the two that the release before differs in.
    assert len(files()) == 6


def test_many_rules_find_what_plain_tests_find(spark):
    import random
    import re

    from skyledger.operators.rule_index import literal_starts, tag_members_indexed
    from skyledger.operators.rules import check_patterns

    generator = random.Random(5)

    def word(n):
        return "".join(generator.choice("ABC") for _ in range(n))

    rules = []
    for i in range(5000):
        low, high = sorted(round(generator.uniform(0.01, 19.99), 4) for _ in range(2))
        pattern = generator.choice([f"^{word(3)}", f"^({word(2)}|{word(3)}|{word(2)})", rf"^{word(2)}\d", word(4), None, f"^{word(2)}{word(1)}*"])
        if i % 400 == 0:
            pattern = rf"{word(1)}\d{word(1)}|{word(3)}$"
        bounds = generator.choice([{}, {"minimum_mean_motion": low}, {"maximum_mean_motion": high}, {"minimum_mean_motion": low, "maximum_mean_motion": high}])
        if pattern is None and not bounds:
            bounds = {"minimum_mean_motion": low, "maximum_mean_motion": low + 0.0005}
        rules.append(Rule(f"r{i}", "active", pattern=pattern, **bounds))
    check_patterns(spark, rules[:50])
    bounds = [r.minimum_mean_motion for r in rules if r.minimum_mean_motion][:30]
    rows = [(i, generator.choice([word(6), f"{word(3)}{i % 10}{word(2)}", word(2), ""]), round(generator.uniform(0.0, 20.0), 4)) for i in range(120)]
    rows += [(200 + i, word(5), b) for i, b in enumerate(bounds)] + [(300, None, 5.0), (301, "ABCABC", None), (302, "CCC", 20.5), (303, "BBB", -1.0)]

    def plain(rule, name, motion):
        if rule.pattern is not None and (name is None or not re.search(rule.pattern, name)):
            return False
        low, high = rule.minimum_mean_motion, rule.maximum_mean_motion
        if low is None and high is None:
            return True
        return motion is not None and (low is None or motion >= low) and (high is None or motion <= high)

    frame = spark.createDataFrame(rows, "pos int, object_name string, mean_motion double")
    found = tag_members_indexed(frame, rules)
    assert found.columns == ["pos", "object_name", "mean_motion", "rule"]
    got = [(r.pos, r.rule) for r in found.collect()]
    expected = {(pos, rule.name) for pos, name, motion in rows for rule in rules if plain(rule, name, motion)}
    assert sorted(set(got) ^ expected)[:5] == [] and len(got) == len(expected)

    def plan(count):
        chosen = [r for r in rules if r.pattern is None or literal_starts(r.pattern)][:count]
        return len(tag_members_indexed(frame, chosen)._jdf.queryExecution().optimizedPlan().toString())

    assert plan(4000) < 1.2 * plan(400)


def test_both_predicates_of_a_rule_must_hold(spark):
    from skyledger.operators.rules import tag_members

    rows = spark.createDataFrame([(1, "STARLINK-1", 1.0), (2, "STARLINK-2", 15.0), (3, "INTELSAT", 1.0), (4, "STARLINK-4", None)], "pos int, object_name string, mean_motion double")
    assert [(r.pos, r.rule) for r in tag_members(rows, RULES[2:]).collect()] == [(1, "starlink-geo")]
