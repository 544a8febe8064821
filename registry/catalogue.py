"""Queries on catalogue sources, the merge, its artifacts and the sky files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry.views import Inputs, with_views
from skyledger.functions import codes, orbits, text
from skyledger.operators import gates, merge
from skyledger.operators.dedup import last_wins
from skyledger.operators.digest import canonical_json, content_digest, multiset_digest, shard_changes, shard_digests
from skyledger.operators.literals import literal_rows
from skyledger.operators.prefix import ranked
from skyledger.operators.state import last_good_sources
from skyledger.session import materialize
from skyledger.sinks import artifacts
from skyledger.sources.catalogues import (
    GCAT_USED, clean_gcat, clean_magnitudes, clean_satcat, gcat_files, satcat_files, source_rows, split_tab_lines,
)
from skyledger.sources.sky import by_magnitude, features_of, figure_documents, figure_lines, parse_stars

AS_OF = date(2025, 6, 1)
GCAT_HEADER = "#JCAT\tSatcat\t" + "\t".join(
    ["LDate", "DDate", "Status", "Owner", "State", "TotMass", "Mass", "DryMass", "Length", "Diameter", "Span",
     "Shape", "OpOrbit", "AltNames"]
)


def satcat_raw(v: Inputs) -> DataFrame:
    raw = v.fx_satcat
    return raw.select(*[F.col(name).alias(name if name == "pos" else name.upper()) for name in raw.columns])


def gcat_raw(v: Inputs) -> DataFrame:
    names = {name.lower(): name for name in (*GCAT_USED, "Satcat")}
    raw = v.fx_gcat
    return raw.select(*[F.col(name).alias(names.get(name, name)) for name in raw.columns])


def satcat(v: Inputs) -> DataFrame:
    return clean_satcat(satcat_raw(v))


def gcat(v: Inputs) -> DataFrame:
    return clean_gcat(gcat_raw(v))


def magnitudes(v: Inputs) -> DataFrame:
    return clean_magnitudes(v.fx_mag_lines)


def merged(v: Inputs) -> DataFrame:
    return merge.merge_catalogues(satcat(v), gcat(v), magnitudes(v))


def kept(v: Inputs) -> DataFrame:
    return merge.within_decay_window(merged(v), AS_OF)


def satcat_clean(v: Inputs) -> DataFrame:
    return satcat(v).select("norad", "cospar", "name", "country", "launchDate", "launchSite", "decayDate")


def satcat_code_maps(v: Inputs) -> DataFrame:
    return v.fx_satcat.select(
        "pos",
        codes.object_type(F.col("object_type")).alias("object_type"),
        codes.ops_status(F.col("ops_status_code")).alias("ops_status"),
        codes.data_status(F.col("data_status_code")).alias("data_status"),
    )


def satcat_orbit_centre(v: Inputs) -> DataFrame:
    return v.fx_satcat.select("pos", codes.orbit_center(F.col("orbit_center")).alias("orbit_center"))


def satcat_rcs_band(v: Inputs) -> DataFrame:
    value = text.number(F.col("rcs"))
    return v.fx_satcat.select("pos", value.alias("rcs"), orbits.rcs_band(value).alias("band"))


def satcat_approx_orbit(v: Inputs) -> DataFrame:
    orbit = orbits.approximate_orbit(*[text.number(F.col(n)) for n in ("period", "inclination", "apogee", "perigee")])
    rows = v.fx_satcat.select("pos", orbit.alias("o"))
    return rows.select("pos", F.col("o").isNotNull().alias("described"), "o.periodMinutes", "o.inclinationDeg",
                       "o.apogeeKm", "o.perigeeKm")


def gcat_clean(v: Inputs) -> DataFrame:
    return gcat(v).select("norad", "owner", "country", "shape", "orbitClass", "status")


def gcat_tsv_lines(v: Inputs) -> DataFrame:
    rows = clean_gcat(split_tab_lines(v.fx_gcat_lines, GCAT_HEADER))
    return rows.select("norad", "launchDate", "massKg", "orbitClass", F.array_join("altNames", "|").alias("names"))


def _files(lines: DataFrame) -> DataFrame:
    """Lines as a reader would give them; the mark becomes a byte that is not UTF-8."""

    damaged = F.expr("cast(concat(cast(replace(value, '~!', '') as binary), X'FF') as string)")
    value = F.when(F.col("value").contains("~!"), damaged).otherwise(F.col("value"))
    return lines.select(value.alias("value"), F.struct("file", F.lit(0).cast("long").alias("block"), F.col("pos").alias("row")).alias("pos"))


def satcat_files_clean(v: Inputs) -> DataFrame:
    rows, _ = satcat_files(_files(v.fx_satcat_files))
    return clean_satcat(rows).select("norad", "cospar", "name", "country", "objectType", "decayDate", "rcsValue_m2")


def satcat_file_faults(v: Inputs) -> DataFrame:
    return satcat_files(_files(v.fx_satcat_files))[1]


def gcat_files_clean(v: Inputs) -> DataFrame:
    rows, _ = gcat_files(_files(v.fx_gcat_files))
    return clean_gcat(rows).select("norad", "owner", "country", "massKg", "orbitClass")


def gcat_file_faults(v: Inputs) -> DataFrame:
    return gcat_files(_files(v.fx_gcat_files))[1]


def gcat_dates(v: Inputs) -> DataFrame:
    return v.fx_gcat.select("pos", text.worded_date(F.col("ldate")).alias("launch_date"),
                            text.worded_date(F.col("ddate")).alias("decay_date"))


def gcat_alt_names(v: Inputs) -> DataFrame:
    names = text.name_list(F.col("altnames"))
    return v.fx_gcat.select("pos", F.array_join(names, "|").alias("names"),
                            F.when(names.isNotNull(), F.size(names)).alias("n"))


def gcat_mass_dims(v: Inputs) -> DataFrame:
    rows = v.fx_gcat.select(
        "pos", orbits.first_positive(F.col("totmass"), F.col("mass"), F.col("drymass")).alias("mass_kg"),
        orbits.dimensions(*[text.number(F.col(n), positive=True) for n in ("span", "length", "diameter")]).alias("d"),
    )
    return rows.select("pos", "mass_kg", F.col("d").isNotNull().alias("sized"), "d.span_m", "d.length_m", "d.diameter_m")


def mag_clean(v: Inputs) -> DataFrame:
    return magnitudes(v)


def star_positions(v: Inputs) -> DataFrame:
    return parse_stars(v.fx_star_lines, v.fx_star_names)


def star_list(v: Inputs) -> DataFrame:
    """The published order of the stars: by magnitude, equal ones as in the file."""

    return by_magnitude(star_positions(v)).select("rank", "hr", "name", "mag")


def figures(v: Inputs) -> DataFrame:
    return figure_lines(v.fx_features).select("pos", "id", "line", F.array_join(F.transform("points", lambda p: p.cast("string")), " ").alias("points"))


def figure_files(v: Inputs) -> DataFrame:
    """Figures of whole feature collections, a thousand orders a file, nested as they are published."""

    feature = F.concat(F.lit('{"id":"'), "id", F.lit('","geometry":{"coordinates":'), "coordinates", F.lit("}}"))
    rows = v.fx_features.select(F.floor(F.col("pos") / 1000).alias("file"), "pos", feature.alias("feature"))
    members = F.transform(F.array_sort(F.collect_list(F.struct("pos", "feature"))), lambda row: row["feature"])
    documents = rows.groupBy("file").agg(F.concat(F.lit('{"features":['), F.array_join(members, ","), F.lit("]}")).alias("value"))
    lines = figure_lines(features_of(documents), keys=["file"])
    text = F.transform("lines", lambda points: F.array_join(F.transform(points, lambda p: p.cast("string")), " "))
    nested = figure_documents(lines, keys=["file"], piece_lines=8)
    return nested.select("file", "id", "piece", F.size("lines").alias("n"), F.array_join(text, "|").alias("lines"))


def catalog_last_wins(v: Inputs) -> DataFrame:
    rows = v.fx_satcat.select(text.canonical_id(F.col("norad_cat_id")).alias("norad"), "pos", "object_name")
    return last_wins(rows.filter("norad is not null"), "norad", "pos")


FLAT = ["cospar", "name", "objectType", "opsStatus", "status", "orbitClass", "owner", "country", "launchDate",
        "launchSite", "massKg", "shape", "rcsSize", "rcsValue_m2", "dataStatus", "orbitCenter", "decayDate",
        "stdMag", "magSource", "magBasis"]


def catalog_merge(v: Inputs) -> DataFrame:
    return kept(v).select(
        "norad", *FLAT, F.array_join("altNames", "|").alias("altNames"), F.col("dimensions.span_m").alias("span_m"),
        F.col("approximateOrbit.periodMinutes").alias("periodMinutes"),
    )


def catalog_provenance(v: Inputs) -> DataFrame:
    entries = F.transform(F.array_sort(F.map_entries("sources")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return kept(v).select("norad", F.array_join(entries, ",").alias("sources"))


def catalog_decay_window(v: Inputs) -> DataFrame:
    return merged(v).filter(merge.long_decayed(AS_OF)).select("norad", "decayDate")


def catalog_metrics(v: Inputs) -> DataFrame:
    return merge.merge_metrics(merged(v), AS_OF)


GATE_CASES = [(0.4, None, 0.2), (0.9, None, 0.2), (0.4, 500, 0.2), (0.4, 10_000_000_000, 0.2)]


def catalog_gates(v: Inputs) -> DataFrame:
    """Each gate setting over the metrics row of the whole merge."""

    cases = F.array(*[F.struct(F.lit(i).alias("case_id"), F.lit(p).cast("bigint").alias("previous")) for i, (_, p, _) in enumerate(GATE_CASES)])
    rows = merge.merge_metrics(merged(v), AS_OF).select("*", F.inline(cases))
    parts = [
        gates.merge_gate(rows.filter(F.col("case_id") == i), minimum_join_fraction=share, previous=F.col("previous"), maximum_drop=drop)
        for i, (share, _, drop) in enumerate(GATE_CASES)
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select("case_id", "records", "accepted", "error")


def mag_estimate(v: Inputs) -> DataFrame:
    guess = orbits.magnitude_estimate(text.optional_string(F.col("object_name")), text.iso_date(F.col("launch_date")).cast("string"))
    return v.fx_satcat.select("pos", guess.alias("g")).select("pos", F.col("g.mag").alias("mag"), F.col("g.basis").alias("basis"))


def catalog_index(v: Inputs) -> DataFrame:
    return artifacts.index_rows(kept(v))


def catalog_index_order(v: Inputs) -> DataFrame:
    """The place of each record in the published index."""

    return ranked(kept(v).select("norad", "name"), ["norad"])


def catalog_index_json(v: Inputs) -> DataFrame:
    index = artifacts.index_rows(kept(v))
    return index.select("norad", artifacts.index_json(index).alias("document"))


def catalog_record_json(v: Inputs) -> DataFrame:
    """Which keys each full record carries: the sparse ones only when set."""

    rows = artifacts.record_shards(kept(v))
    return rows.select("norad", "bucket", F.array_join(F.array_sort(F.json_object_keys("record")), ",").alias("keys"))


def catalog_shards(v: Inputs) -> DataFrame:
    rows = kept(v).select(artifacts.shard_of(F.col("norad")).alias("bucket"), "norad")
    return rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("records"), F.min("norad").alias("lowest"), F.max("norad").alias("highest"))


def _shards(v: Inputs) -> DataFrame:
    return shard_digests(kept(v), "norad", artifacts.canonical_record())


def catalog_shard_hash(v: Inputs) -> DataFrame:
    return _shards(v)


def catalog_content_hash(v: Inputs) -> DataFrame:
    return content_digest(_shards(v))


def _otherwise(rows: DataFrame) -> DataFrame:
    """A catalogue in another state: some shards gone, some with one record changed."""

    rows = rows.filter(F.pmod(artifacts.shard_of(F.col("norad")), F.lit(5)) != 3)
    return rows.withColumn("owner", F.when((F.col("norad") % 4000 < 9) & F.col("owner").isNotNull(), "CHANGED").otherwise(F.col("owner")))


def catalog_shard_changes(v: Inputs) -> DataFrame:
    """Which shards a release would have to write, and which it would leave behind."""

    # Both states come from one merge, filtered once its dates are parsed; the comparison reads each side twice.
    rows = merge.within_decay_window(materialize(merged(v), "merged"), AS_OF)
    before = materialize(shard_digests(rows, "norad", artifacts.canonical_record()), "shards").filter(F.pmod(F.col("bucket"), F.lit(7)) != 1)
    after = materialize(shard_digests(_otherwise(rows), "norad", artifacts.canonical_record()), "shards")
    return shard_changes(before, after)


def catalog_manifest(v: Inputs) -> DataFrame:
    """Counts, shard count and content hash, with how each fetched source was served: a row a source."""

    fetched = {"satcat": materialize(satcat(v), "satcat"), "gcat": materialize(gcat(v), "gcat")}
    every = materialize(merge.merge_catalogues(fetched["satcat"], fetched["gcat"], magnitudes(v)), "merged")
    digest = artifacts.catalogue_digest(merge.within_decay_window(every, AS_OF))
    metrics = merge.merge_metrics(every, AS_OF)
    both = metrics.unionByName(digest, allowMissingColumns=True)
    totals = both.agg(*[F.max(name).alias(name) for name in both.columns]).withColumn("all", F.lit(1))
    served = last_good_sources(v.fx_source_snapshots).join(source_rows(**fetched), "source")
    sources = served.select("source", F.col("usable").alias("ok"), "fetched_at", "from_cache", "stale", "error", "rows", F.lit(1).alias("all"))
    return sources.join(totals, "all").drop("all")


def source_row_counts(v: Inputs) -> DataFrame:
    return source_rows(satcat=satcat(v), gcat=gcat(v), mmccants=magnitudes(v), bsc5=parse_stars(v.fx_star_lines, v.fx_star_names),
                       constellationFigures=figure_lines(v.fx_features).select("id").distinct())


def source_floors(v: Inputs) -> DataFrame:
    counts = source_rows(SATCAT=satcat(v), magnitude=magnitudes(v))
    limits = literal_rows(v.spark, [("SATCAT", 100), ("magnitude", 10_000_000_000), ("star", 1)],
                          {"source": "string", "minimum": "bigint"})
    return gates.source_floor_gate(counts, limits)


STAR_FIELDS = ("hr", "name", "bayer", "ra", "dec", "mag")


def sky_digest(v: Inputs) -> DataFrame:
    """Order-free digest of the star list; it must not move when rows are shuffled."""

    stars = parse_stars(v.fx_star_lines, v.fx_star_names).repartition(7, "hr")
    return stars.agg(multiset_digest(canonical_json(*[F.col(name) for name in STAR_FIELDS])).alias("digest"))


# --- the same queries as SQL -------------------------------------------------------------------

_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"


def _num(column: str, positive: bool = False) -> str:
    cleaned = f"translate(trim({column}), '?~*', '')"
    value = f"case when regexp_full_match({cleaned}, '{_NUMBER}') then try_cast({cleaned} as double) end"
    return f"case when ({value}) > 0 then ({value}) end" if positive else value


def _opt(column: str) -> str:
    return f"nullif(nullif(trim({column}), ''), '-')"


def _iso(column: str) -> str:
    return rf"case when regexp_full_match({column}, '\d{{4}}-\d{{2}}-\d{{2}}') then try_cast({column} as date) end"


def _worded(column: str) -> str:
    months = " ".join(f"when '{name}' then '{n:02d}'" for n, name in enumerate(
        ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"], start=1))
    pattern = r"^(\d{4})\s+([A-Z][a-z]{2})\s+(\d{1,2})\b"
    group = [f"regexp_extract(trim({column}), '{pattern}', {i})" for i in range(4)]
    return f"case when {group[0]} <> '' then {group[1]} || '-' || (case {group[2]} {months} end) || '-' || lpad({group[3]}, 2, '0') end"


def _map(column: str, pairs: dict[str, str], default: str) -> str:
    whens = " ".join(f"when '{code}' then '{label}'" for code, label in pairs.items())
    return f"case {column} {whens} else {default} end"


_TYPES = _map("object_type", {"PAY": "payload", "R/B": "rocket-body", "DEB": "debris", "UNK": "unknown"}, "'unknown'")
_OPS = _map("ops_status_code", {"+": "operational", "P": "partial", "B": "backup", "S": "backup", "-": "nonoperational",
                                "X": "extended", "D": "decayed", "?": "unknown"}, "'unknown'")
_DATA = _map("upper(trim(data_status_code))", {"NCE": "no-current-elements", "NIE": "no-initial-elements",
                                               "NEA": "no-elements-available"}, "null")
_CENTRE = _map("upper(trim(orbit_center))", {"EA": "earth", "SU": "sun", "EL1": "earth-sun-l1", "": None} | {}, "upper(trim(orbit_center))").replace("then 'None'", "then null")
_BAND = f"case when ({_num('rcs')}) < 0.1 then 'small' when ({_num('rcs')}) <= 1 then 'medium' when ({_num('rcs')}) is not null then 'large' end"
_CLASS = """case when upper(oporbit) like 'LEO%' or upper(oporbit) like 'LLEO%' then 'LEO' when upper(oporbit) like 'MEO%' then 'MEO'
 when upper(oporbit) like 'GEO%' or upper(oporbit) like 'GSO%' then 'GEO'
 when regexp_matches(upper(oporbit), '^(HEO|GTO|MOL|EEO)') then 'HEO' when oporbit not in ('', '-') then 'other' end"""
_LIFE = "case left(upper(trim(status)), 1) when 'O' then 'in-orbit' when 'L' then 'landed' when 'R' then 'decayed' when 'D' then 'decayed' end"
_NAMES = f"list_filter(list_transform(regexp_split_to_array({_opt('altnames')}, '[;,]'), lambda x: trim(x)), lambda x: x <> '')"
_MASS = f"coalesce({_num('totmass', True)}, {_num('mass', True)}, {_num('drymass', True)})"
_ORBIT = (f"case when ({_num('period')}) is not null or ({_num('inclination')}) is not null then struct_pack(periodMinutes := {_num('period')}, "
          f"inclinationDeg := {_num('inclination')}, apogeeKm := {_num('apogee')}, perigeeKm := {_num('perigee')}) end")
_DIMS = (f"case when coalesce({_num('span', True)}, {_num('length', True)}, {_num('diameter', True)}) is not null then "
         f"struct_pack(span_m := {_num('span', True)}, length_m := {_num('length', True)}, diameter_m := {_num('diameter', True)}) end")


def _guess(name: str, launch: str) -> str:
    rows = [(f"upper({name}) like 'STARLINK%' and {launch} < '2020-06-01'", 4.5, "Starlink (early, pre-visor)"),
            (f"upper({name}) like 'STARLINK%'", 5.5, "Starlink"), (f"upper({name}) like 'ONEWEB%'", 7.5, "OneWeb"),
            (f"upper({name}) like 'KUIPER%'", 6.0, "Kuiper"), (f"upper({name}) like 'QIANFAN%'", 5.5, "Qianfan"),
            (f"upper({name}) like '%HULIANWANG%'", 6.5, "Guowang")]
    return "case " + " ".join(f"when {test} then struct_pack(mag := {mag}::double, basis := '{basis}')" for test, mag, basis in rows) + " end"


_LATEST = "select * exclude (rn) from (select *, row_number() over (partition by norad order by pos desc) rn from ({inner})) where rn = 1"
_STAR = r"""
select pos, token, cast(token as bigint) as hr, nullif(trim(substr(value, 5, 10)), '') as bayer, substr(value, 84, 1) as sgn,
 try_cast(trim(substr(value, 76, 2)) as double) rah, try_cast(trim(substr(value, 78, 2)) as double) ram, try_cast(trim(substr(value, 80, 4)) as double) ras,
 try_cast(substr(value, 85, 2) as double) ded, try_cast(substr(value, 87, 2) as double) dem, try_cast(substr(value, 89, 2) as double) des,
 try_cast(trim(substr(value, 103, 5)) as double) mag
from (select pos, value, trim(substr(value, 1, 4)) as token from fx_star_lines where length(value) >= 107) t where regexp_full_match(token, '[0-9]+')"""

_FIELDS = ["cospar", "name", "altNames", "objectType", "opsStatus", "status", "orbitClass", "owner", "country", "launchDate", "launchSite",
           "massKg", "dimensions", "shape", "rcsSize", "rcsValue_m2", "dataStatus", "orbitCenter", "approximateOrbit", "decayDate",
           "stdMag", "magSource", "magBasis"]
_PROVENANCE = sorted([name for name in _FIELDS if name not in ("magSource", "magBasis")])
_SOURCE_OF = {name: f"case when {name} is not null then 'satcat' end" for name in
              ("cospar", "name", "objectType", "opsStatus", "launchSite", "rcsSize", "rcsValue_m2", "dataStatus", "orbitCenter",
               "approximateOrbit", "decayDate")}
_SOURCE_OF |= {name: f"case when {name} is not null then 'gcat' end" for name in ("altNames", "orbitClass", "owner", "massKg", "dimensions", "shape")}
_SOURCE_OF |= {"status": "status_from", "country": "country_from", "launchDate": "launch_from", "stdMag": "magSource"}
_ENTRIES = ("list_filter([" + ", ".join(f"struct_pack(\"key\" := '{n}', \"value\" := {_SOURCE_OF[n]})" for n in _PROVENANCE) + "], lambda e: e.value is not null)")
_CANONICAL = "to_json(struct_pack(norad := norad, " + ", ".join(f"{n} := {n}" for n in _FIELDS) + f", sources := {_ENTRIES}))"

EXTRA = {
    "sx_satcat": _LATEST.replace("{inner}", f"""
select try_cast(trim(norad_cat_id) as bigint) as norad, pos, {_opt('object_id')} as cospar, {_opt('object_name')} as name, {_TYPES} as objectType,
 {_OPS} as opsStatus, {_opt('owner')} as country, {_iso('launch_date')} as launchDate, {_opt('launch_site')} as launchSite,
 {_iso('decay_date')} as decayDate, {_num('rcs')} as rcsValue_m2, {_BAND} as rcsSize, {_DATA} as dataStatus, {_CENTRE} as orbitCenter,
 {_ORBIT} as approximateOrbit
from fx_satcat where try_cast(trim(norad_cat_id) as bigint) is not null"""),
    "sx_gcat": _LATEST.replace("{inner}", f"""
select try_cast(satcat as bigint) as norad, pos, {_opt('owner')} as owner, {_opt('state')} as country, {_worded('ldate')} as launchDate,
 {_MASS} as massKg, {_DIMS} as dimensions, {_opt('shape')} as shape, {_CLASS} as orbitClass, {_LIFE} as status, {_NAMES} as altNames
from fx_gcat where try_cast(satcat as bigint) is not null"""),
    "sx_mag": _LATEST.replace("{inner}", """
select cast(trim(substr(value, 1, 5)) as bigint) as norad, pos, try_cast(trim(substr(value, 34, 4)) as double) as stdMag from fx_mag_lines
where length(value) >= 37 and trim(substr(value, 1, 5)) not in ('1', '99999') and try_cast(trim(substr(value, 34, 4)) as double) is not null"""),
    "sx_joined": f"""
select s.norad, s.cospar, s.name, case when len(g.altNames) > 0 then g.altNames end as altNames, s.objectType, s.opsStatus,
 coalesce(g.status, case when s.decayDate is not null then 'decayed' else 'in-orbit' end) as status,
 case when g.status is not null then 'gcat' else 'satcat:derived' end as status_from, g.orbitClass, g.owner,
 coalesce(s.country, g.country) as country, case when s.country is not null then 'satcat' when g.country is not null then 'gcat' end as country_from,
 coalesce(g.launchDate, cast(s.launchDate as varchar)) as launchDate,
 case when g.launchDate is not null then 'gcat' when s.launchDate is not null then 'satcat' end as launch_from, s.launchSite, g.massKg,
 g.dimensions, g.shape, s.rcsSize, s.rcsValue_m2, s.dataStatus, s.orbitCenter, s.approximateOrbit, s.decayDate,
 m.stdMag as measured, g.norad is not null as with_gcat
from sx_satcat s left join sx_gcat g on g.norad = s.norad left join sx_mag m on m.norad = s.norad""",
    "sx_merged": f"""
select *, coalesce(measured, guess.mag) as stdMag, case when measured is not null then 'mmccants' when guess is not null then 'estimate' end as magSource,
 case when measured is null then guess.basis end as magBasis from (select *, {_guess('name', 'launchDate')} as guess from sx_joined)""",
    "sx_kept": "select * from sx_merged where decayDate is null or decayDate >= date '2025-06-01' - 365",
    "sx_shards": f"""
select cast(norad // 1000 as bigint) as bucket, sha256(string_agg(sha256({_CANONICAL}), '' order by norad)) as digest, count(*) as members
from sx_kept group by 1""",
    "sx_star": _STAR,
}


def _content(shards: str) -> str:
    row = "to_json(struct_pack(bucket := bucket, digest := digest))"
    sums = ", ',', ".join(f"cast(sum(cast(concat('0x', substr(sha256({row}), {s}, 16)) as ubigint)) as varchar)" for s in (1, 17, 33, 49))
    return f"select sha256(concat({sums})) as content_sha256, count(*) as buckets from {shards}"


_METRICS = """
select count(*) filter (where not old) as records, count(*) filter (where not old and with_gcat) as with_gcat,
 count(*) filter (where not old and magSource = 'mmccants') as with_mag, count(*) filter (where not old and magSource = 'estimate') as with_mag_est,
 count(*) filter (where old) as dropped_decayed
from (select *, coalesce(decayDate < date '2025-06-01' - 365, false) as old from sx_merged)"""
_DENSE = ["name", "objectType", "country", "opsStatus", "rcsSize", "stdMag"]
_INDEX_DENSE = "to_json(struct_pack(norad := cast(norad as varchar), " + ", ".join(f"{n} := {n}" for n in _DENSE) + "))"
_SPARSE_KEYS = sorted([*[n for n in _FIELDS if n not in ("dataStatus", "orbitCenter", "approximateOrbit")]])
_KEYS = ("list_sort(list_filter(['norad', 'dataStatus', 'orbitCenter', 'approximateOrbit', '_sources', "
         + ", ".join(f"case when {n} is not null then '{n}' end" for n in _SPARSE_KEYS) + "], lambda k: k is not null))")
_STAR_VALID = """
select s.*, coalesce(nullif(n.name, ''), bayer) as name, 15 * (rah + ram / 60 + ras / 3600) as ra0,
 (ded + dem / 60 + des / 3600) * (case when sgn = '-' then -1 else 1 end) as dec0
from sx_star s left join fx_star_names n on n.hr = s.token
where mag <= 4.5 and rah is not null and ram is not null and ras is not null and ded is not null and dem is not null and des is not null"""
EXTRA["sx_star_rows"] = _STAR_VALID

_LINES = """
select pos, id, 0 as line, [case when (pos * 7) % 36000 < 18000 then cast(printf('%.4f', cast((pos * 7) % 36000 as double) / 100 - 180 + 360) as double) else
  cast(printf('%.4f', cast((pos * 7) % 36000 as double) / 100 - 180) as double) end, cast(pos % 180 as double) - 90, cast(pos % 180 as double), 1.25::double] as p
from fx_features where id <> '' and pos % 43 <> 0
union all select pos, id, 1, [1.0::double, 2.0, 353.5, 7.0, 8.0, 9.0] from fx_features where id <> '' and pos % 43 <> 0 and pos % 4 = 3"""
EXTRA["sx_lines"] = _LINES

QUERIES = {
    "satcat_clean": (satcat_clean, "select norad, cospar, name, country, launchDate, launchSite, decayDate from sx_satcat"),
    "satcat_code_maps": (satcat_code_maps, f"select pos, {_TYPES} as object_type, {_OPS} as ops_status, {_DATA} as data_status from fx_satcat"),
    "satcat_orbit_centre": (satcat_orbit_centre, f"select pos, {_CENTRE} as orbit_center from fx_satcat"),
    "satcat_rcs_band": (satcat_rcs_band, f"select pos, {_num('rcs')} as rcs, {_BAND} as band from fx_satcat"),
    "satcat_approx_orbit": (satcat_approx_orbit, f"""
select pos, o is not null as described, o.periodMinutes as periodMinutes, o.inclinationDeg as inclinationDeg, o.apogeeKm as apogeeKm,
 o.perigeeKm as perigeeKm from (select pos, {_ORBIT} as o from fx_satcat)"""),
    "gcat_clean": (gcat_clean, "select norad, owner, country, shape, orbitClass, status from sx_gcat"),
    "gcat_tsv_lines": (gcat_tsv_lines, """
select norad, launchDate, massKg, orbitClass, case when pos % 500 <> 4 then array_to_string(altNames, '|') end as names
from sx_gcat where pos % 500 not in (0, 2)"""),
    "satcat_files_clean": (satcat_files_clean, _LATEST.replace("{inner}", f"""
select try_cast(trim(norad_cat_id) as bigint) as norad, pos, {_opt('object_id')} as cospar,
 case when pos % 12 = 0 then concat(trim(object_name), case when object_name like '% ' then ' ' else '' end, ', "X" Y') else {_opt('object_name')} end as name,
 case when pos % 7 in (1, 5) then null else {_opt('owner')} end as country, {_TYPES} as objectType, {_iso('decay_date')} as decayDate, {_num('rcs')} as rcsValue_m2
from fx_satcat where pos % 7 in (0, 1, 5, 6) and try_cast(trim(norad_cat_id) as bigint) is not null""").replace("exclude (rn)", "exclude (rn, pos)").replace("order by pos desc", "order by pos % 7 desc, pos desc")),
    "satcat_file_faults": (satcat_file_faults, """
select distinct concat('f', pos % 7) as file, case pos % 7 when 2 then 'not UTF-8' when 3 then 'satellite catalogue: missing columns: DECAY_DATE'
 when 4 then 'a quoted cell is left open' end as fault from fx_satcat"""),
    "gcat_files_clean": (gcat_files_clean, _LATEST.replace("{inner}", f"""
select norad, pos, case when file in (0, 1) then {_opt('owner')} end as owner, case file when 4 then {_opt('owner')} end as country, {_num('totmass', True)} as massKg,
 case file when 0 then {_CLASS} end as orbitClass
from (select *, pos % 5 as file, try_cast(satcat as bigint) as norad from fx_gcat where pos % 5 in (0, 1, 4))
where norad is not null""").replace("exclude (rn)", "exclude (rn, pos)").replace("order by pos desc", "order by pos % 5 desc, pos desc")),
    "gcat_file_faults": (gcat_file_faults, """
select distinct concat('g', pos % 5) as file, case pos % 5 when 2 then 'not UTF-8' when 3 then 'general catalogue: header not found' end as fault from fx_gcat"""),
    "gcat_dates": (gcat_dates, f"select pos, {_worded('ldate')} as launch_date, {_worded('ddate')} as decay_date from fx_gcat"),
    "gcat_alt_names": (gcat_alt_names, f"""
select pos, case when l is not null then coalesce(array_to_string(l, '|'), '') end as names, cast(len(l) as int) as n
from (select pos, {_NAMES} as l from fx_gcat)"""),
    "gcat_mass_dims": (gcat_mass_dims, f"""
select pos, mass_kg, d is not null as sized, d.span_m as span_m, d.length_m as length_m, d.diameter_m as diameter_m
from (select pos, {_MASS} as mass_kg, {_DIMS} as d from fx_gcat)"""),
    "mag_clean": (mag_clean, "select norad, stdMag from sx_mag"),
    "star_positions": (star_positions, """
select pos, hr, name, bayer, cast(printf('%.4f', ra0) as double) as ra, cast(printf('%.4f', dec0) as double) as dec, mag from sx_star_rows"""),
    "star_list": (star_list, "select row_number() over (order by mag, pos) as rank, hr, name, mag from sx_star_rows"),
    "figure_lines": (figures, "select pos, id, line, array_to_string(list_transform(p, lambda x: cast(x as varchar)), ' ') as points from sx_lines"),
    "figure_files": (figure_files, """
select file, id, piece, cast(count(*) as int) as n, string_agg(points, '|' order by k) as lines
from (select *, cast((k - 1) // 8 as int) as piece from (select cast(pos // 1000 as bigint) as file, id, array_to_string(list_transform(p, lambda x: cast(x as varchar)), ' ') as points,
 row_number() over (partition by pos // 1000, id order by pos, line) as k from sx_lines)) group by file, id, piece"""),
    "catalog_last_wins": (catalog_last_wins, """
select norad, pos, object_name from (select try_cast(norad_cat_id as bigint) as norad, pos, object_name,
 row_number() over (partition by try_cast(norad_cat_id as bigint) order by pos desc) rn from fx_satcat) where rn = 1 and norad is not null"""),
    "catalog_merge": (catalog_merge, f"""
select norad, {", ".join(FLAT)}, array_to_string(altNames, '|') as altNames, dimensions.span_m as span_m,
 approximateOrbit.periodMinutes as periodMinutes from sx_kept"""),
    "catalog_provenance": (catalog_provenance, f"""
select norad, array_to_string(list_transform({_ENTRIES}, lambda e: e.key || '=' || e.value), ',') as sources from sx_kept"""),
    "catalog_decay_window": (catalog_decay_window, "select norad, decayDate from sx_merged where decayDate < date '2025-06-01' - 365"),
    "catalog_metrics": (catalog_metrics, _METRICS),
    "catalog_gates": (catalog_gates, f"""
select case_id, records, error is null as accepted, error from (select c.case_id, m.records, case when m.records < 1 then 'merged catalogue is empty'
 when m.with_gcat / m.records < share then 'GCAT join fraction is below minimum'
 when previous > 0 and records < previous * 0.8 then concat('catalogue record count dropped from ', previous, ' to ', records) end as error
 from (values (0, 0.4, cast(null as bigint)), (1, 0.9, null), (2, 0.4, 500), (3, 0.4, 10000000000)) c(case_id, share, previous), ({_METRICS}) m)"""),
    "mag_estimate": (mag_estimate, f"""
select pos, g.mag as mag, g.basis as basis from (select pos, {_guess(_opt('object_name'), 'cast(' + _iso('launch_date') + ' as varchar)')} as g from fx_satcat)"""),
    "catalog_index": (catalog_index, f"""
select cast(norad as varchar) as norad, {", ".join(_DENSE)}, case when magSource = 'estimate' then 1 end as magEst, dataStatus from sx_kept"""),
    "catalog_index_order": (catalog_index_order, "select norad, name, row_number() over (order by norad) as rank from sx_kept"),
    "catalog_index_json": (catalog_index_json, f"""
select cast(norad as varchar) as norad, concat(left(d, len(d) - 1), case when magSource = 'estimate' then ',"magEst":1' else '' end,
 case when dataStatus is not null then concat(',"dataStatus":"', dataStatus, '"') else '' end, '}}') as document
from (select *, {_INDEX_DENSE} as d from sx_kept)"""),
    "catalog_record_json": (catalog_record_json, f"select norad, cast(norad // 1000 as bigint) as bucket, array_to_string({_KEYS}, ',') as keys from sx_kept"),
    "catalog_shards": (catalog_shards, "select cast(norad // 1000 as bigint) as bucket, count(*) as records, min(norad) as lowest, max(norad) as highest from sx_kept group by 1"),
    "catalog_shard_hash": (catalog_shard_hash, "select bucket, digest, members from sx_shards"),
    "catalog_content_hash": (catalog_content_hash, _content("sx_shards")),
    "catalog_shard_changes": (catalog_shard_changes, f"""
select bucket, case when o.digest is null then 'added' when n.digest is null then 'removed' else 'changed' end as change, n.digest as digest
from (select bucket, digest from sx_shards where bucket % 7 <> 1) o
full join (select cast(norad // 1000 as bigint) as bucket, sha256(string_agg(sha256({_CANONICAL}), '' order by norad)) as digest
 from (select * replace (case when norad % 4000 < 9 and owner is not null then 'CHANGED' else owner end as owner) from sx_kept where (norad // 1000) % 5 <> 3) group by 1) n using (bucket)
where o.digest is distinct from n.digest"""),
    "catalog_manifest": (catalog_manifest, f"""
select s.*, m.*, c.* from (select source, body_path is not null as ok, fetched_at, newest <> 200 as from_cache, newest not in (200, 304) as stale,
  case when newest not in (200, 304) then concat('HTTP ', newest) end as error,
  case source when 'satcat' then (select count(*) from sx_satcat) else (select count(*) from sx_gcat) end as rows
 from (select source, arg_max(body_path, ts) filter (where status = 200) as body_path, max(ts) filter (where status = 200) as fetched_at,
  arg_max(status, ts) as newest from fx_source_snapshots group by source)) s, ({_METRICS}) m, ({_content('sx_shards')}) c"""),
    "source_row_counts": (source_row_counts, """
select 'satcat' as source, count(*) as rows from sx_satcat union all select 'gcat', count(*) from sx_gcat union all select 'mmccants', count(*) from sx_mag
union all select 'bsc5', count(*) from sx_star_rows union all select 'constellationFigures', count(distinct id) from sx_lines"""),
    "source_floors": (source_floors, """
select source, rows, minimum, error is null as accepted, error from (select *, case when rows < minimum then concat(source, ' count ', rows, ' is below minimum ', minimum) end as error
 from (select 'SATCAT' as source, count(*) as rows, cast(100 as bigint) as minimum from sx_satcat union all select 'magnitude', count(*), 10000000000 from sx_mag
  union all select 'star', 0, 1))"""),
    "sky_digest": (sky_digest, "select sha256(concat(" + ", ',', ".join(
        f"cast(sum(cast(concat('0x', substr(sha256(to_json(struct_pack(hr := hr, name := name, bayer := bayer, ra := cast(printf('%.4f', ra0) as double), \"dec\" := cast(printf('%.4f', dec0) as double), mag := mag))), {s}, 16)) as ubigint)) as varchar)"
        for s in (1, 17, 33, 49)) + ")) as digest from sx_star_rows"),
}
ORACLES = {name: with_views(sql, EXTRA) for name, (_, sql) in QUERIES.items()}
