"""Queries on element sets and on the subsets cut from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry.views import Inputs, with_views
from skyledger.functions.text import epoch_instant, parse_double, token_kind, whole_number
from skyledger.operators import audit, dedup, quality, rules
from skyledger.operators.digest import canonical_json, multiset_digest
from skyledger.operators.gates import element_gate
from skyledger.operators.state import stale_rules
from skyledger.sinks.artifacts import element_json
from skyledger.sources.elements import parse_element_lines, parse_element_objects

FIELDS = {
    "NORAD_CAT_ID": "norad", "MEAN_MOTION": "mean_motion", "ECCENTRICITY": "eccentricity",
    "INCLINATION": "inclination", "RA_OF_ASC_NODE": "ra_of_asc_node",
    "ARG_OF_PERICENTER": "arg_of_pericenter", "MEAN_ANOMALY": "mean_anomaly", "BSTAR": "bstar_raw",
    "EPOCH": "epoch",
}
KEYS = {"key": "norad", "position": "pos", "epoch": "epoch"}
HEADER = (
    "OBJECT_NAME,OBJECT_ID,EPOCH,MEAN_MOTION,ECCENTRICITY,INCLINATION,RA_OF_ASC_NODE,ARG_OF_PERICENTER,"
    "MEAN_ANOMALY,EPHEMERIS_TYPE,CLASSIFICATION_TYPE,NORAD_CAT_ID,ELEMENT_SET_NO,REV_AT_EPOCH,BSTAR,"
    "MEAN_MOTION_DOT,MEAN_MOTION_DDOT"
).split(",")


def _checks(gp: DataFrame) -> list[quality.Check]:
    return quality.element_checks(gp, FIELDS)


def _valid(v: Inputs) -> DataFrame:
    gp = v.fx_gp
    return quality.valid_unique(gp, _checks(gp), key="norad")


def violations(v: Inputs) -> DataFrame:
    gp = v.fx_gp
    checks = _checks(gp)
    counted = quality.tally(gp, checks)
    pairs = [F.struct(F.lit(check.rule).alias("rule"), F.col(check.column).alias("n")) for check in checks]
    return counted.select(F.inline(F.array(*pairs))).filter("n > 0")


def first_violation(v: Inputs) -> DataFrame:
    gp = v.fx_gp
    profiled = quality.profile(gp, _checks(gp), **KEYS)
    return profiled.select("first_position", "first_rule", "failed_records")


def record_verdicts(v: Inputs) -> DataFrame:
    gp = v.fx_gp
    checks = _checks(gp)
    flagged = quality.flag_records(gp, checks).filter("_failed is not null")
    return flagged.select("pos", "norad", quality.rule_name(F.col("_failed"), checks).alias("rule"))


def metrics(v: Inputs) -> DataFrame:
    return v.fx_gp.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("epoch").alias("earliest_epoch"),
        F.max("epoch").alias("latest_epoch"),
        multiset_digest(canonical_json(*[_digested(name) for name in DIGESTED])).alias("digest"),
    )


DIGESTED = ("pos", "norad", "object_name", "epoch", "mean_motion", "eccentricity", "inclination", "ra_of_asc_node",
            "arg_of_pericenter", "mean_anomaly", "bstar_raw")


def _digested(name: str) -> Column:
    """A column as it goes into the digest; instants as microseconds."""

    return F.unix_micros(F.col(name).cast("timestamp")).alias(name) if name == "epoch" else F.col(name)


def duplicate_keys(v: Inputs) -> DataFrame:
    gp = v.fx_gp
    second = dedup.second_occurrences(gp, ["norad"], "pos")
    return dedup.duplicate_keys(gp, ["norad"]).join(second.withColumnRenamed("pos", "second_pos"), "norad")


def valid_records(v: Inputs) -> DataFrame:
    return _valid(v).select("pos", "norad", "object_name")


def _profile_cases(profiled: DataFrame, cases: list[tuple]) -> DataFrame:
    """The one profiled row against several bounds."""

    table = F.array(*[
        F.struct(F.lit(low).cast("bigint").alias("minimum"), F.lit(before).cast("bigint").alias("previous"),
                 F.lit(drop).cast("double").alias("fraction"))
        for low, before, drop in cases
    ])
    gated = element_gate(
        profiled.select("*", F.inline(table)),
        minimum=F.col("minimum"), previous=F.col("previous"), fraction=F.col("fraction"),
    )
    return gated.select("minimum", "previous", "fraction", "record_count", "accepted", "error")


FLOOR_CASES = [(1, None, 0.0), (500, None, 0.0), (10_000_000_000, None, 0.0)]
DROP_CASES = [(1, None, 0.2), (1, 0, 0.2), (1, 500, 0.2), (1, 10_000_000_000, 0.2), (1, 10_000_000_000, 1.0)]


def gate_count_floor(v: Inputs) -> DataFrame:
    valid = _valid(v)
    return _profile_cases(quality.profile(valid, _checks(valid), unique=True, **KEYS), FLOOR_CASES)


def gate_count_drop(v: Inputs) -> DataFrame:
    valid = _valid(v)
    return _profile_cases(quality.profile(valid, _checks(valid), unique=True, **KEYS), DROP_CASES)


def gate_records(v: Inputs) -> DataFrame:
    gp = v.fx_gp
    return _profile_cases(quality.profile(gp, _checks(gp), **KEYS), [(1, None, 0.2), (10_000_000_000, None, 0.2)])


def token_coercion(v: Inputs) -> DataFrame:
    cell = F.col("cell")
    return v.fx_cells.select(
        "pos", "cell", token_kind(cell).alias("kind"),
        F.when(token_kind(cell).isin("integer", "float"), parse_double(cell)).alias("value"),
        F.when(token_kind(cell).isin("integer", "float"), whole_number(cell)).alias("whole"),
    )


def epoch_parse(v: Inputs) -> DataFrame:
    return v.fx_cells.select("pos", epoch_instant(F.col("epoch_text")).cast("timestamp_ntz").alias("epoch"))


def csv_lines(v: Inputs) -> DataFrame:
    parsed = parse_element_lines(v.fx_gp_lines, HEADER)
    sound = F.col("damage").isNull()
    names = ("object_name", "classification_type", "norad_cat_id", "mean_motion", "bstar", "element_set_no")
    return parsed.select("pos", "damage", *[F.when(sound, F.col(name)).alias(name) for name in names],
                         F.when(sound, F.col("epoch_at")).cast("timestamp_ntz").alias("epoch_at"))


def csv_damage(v: Inputs) -> DataFrame:
    parsed = parse_element_lines(v.fx_gp_lines, HEADER)
    return parsed.filter("damage is not null").groupBy("damage").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos")
    )


def json_objects(v: Inputs) -> DataFrame:
    parsed = parse_element_objects(v.fx_gp_objects)
    sound = F.col("damage").isNull()
    names = ("object_name", "object_id", "norad_cat_id", "mean_motion", "mean_anomaly")
    return parsed.select("pos", "damage", *[F.when(sound, F.col(name)).alias(name) for name in names])


def rule_membership(v: Inputs) -> DataFrame:
    return rules.tag_members(v.fx_gp, rules.SHIPPED_RULES).select("pos", "norad", "rule")


def many_rules() -> list[rules.Rule]:
    """Six hundred rules of every kind: starts, alternatives, inner texts, bounds, and both together."""

    made = []
    for i in range(100):
        made += [
            rules.Rule(f"start-{i}", "active", pattern=f"^STARLINK-{i}"),
            rules.Rule(f"either-{i}", "active", pattern=f"^(ONEWEB-{i}|ONEWEB-{i}0|KUIPER-{i})"),
            rules.Rule(f"digits-{i}", "active", pattern=rf"^GSAT{i:02d}\d{{2}}"),
            rules.Rule(f"inner-{i}", "active", pattern=f"{i}7"),
            rules.Rule(f"band-{i}", "active", minimum_mean_motion=0.1 + i / 10, maximum_mean_motion=0.35 + i / 8),
            rules.Rule(f"both-{i}", "active", pattern="^BEIDOU-", minimum_mean_motion=0.15 * (i + 1)),
        ]
    return made


def rule_membership_many(v: Inputs) -> DataFrame:
    """Members of six hundred rules."""

    return rules.tag_members(v.fx_gp, many_rules()).groupBy("rule").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos"), F.sum("norad").alias("norads"))


PUBLISHED = ("object_name", "object_id", "epoch", "mean_motion", "eccentricity", "norad_cat_id", "element_set_no", "bstar", "mean_motion_dot", "mean_motion_ddot")


def record_json(v: Inputs) -> DataFrame:
    """Sound CSV records as they are published, numbers by the kind of their token."""

    parsed = parse_element_lines(v.fx_gp_lines, HEADER).filter("damage is null")
    return parsed.select("pos", element_json(parsed.select(*PUBLISHED)).alias("document"))


def json_round_trip(v: Inputs) -> DataFrame:
    """Published records read back: what the reader makes of them."""

    parsed = parse_element_lines(v.fx_gp_lines, HEADER).filter("damage is null")
    whole = parsed.drop("damage", "epoch_at", "pos")
    again = parse_element_objects(parsed.select("pos", element_json(whole).alias("value")))
    return again.select("pos", "damage", "object_name", "classification_type", "norad_cat_id", "mean_motion", "bstar", "mean_motion_ddot",
                        F.col("epoch_at").cast("timestamp_ntz").alias("epoch_at"))


def rule_counts(v: Inputs) -> DataFrame:
    """The source and its ten subsets from one scan."""

    tags = F.array_append(rules.matched_rules(rules.SHIPPED_RULES), F.lit("active"))
    return v.fx_gp.select("epoch", F.explode(tags).alias("rule")).groupBy("rule").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("epoch").alias("earliest_epoch"),
        F.max("epoch").alias("latest_epoch"),
    )


GATE_COLUMNS = ["rule", "source", "minimum_records", "record_count", "earliest_epoch", "latest_epoch",
                "previous_count", "accepted", "error"]


def rule_gates(v: Inputs) -> DataFrame:
    gp = v.fx_gp
    return rules.gate_rules(gp, rules.SHIPPED_RULES, _checks(gp), **KEYS).select(*GATE_COLUMNS)


def rule_gates_valid(v: Inputs) -> DataFrame:
    valid = _valid(v)
    previous = rules.tag_members(v.fx_gp, rules.SHIPPED_RULES).groupBy("rule").agg(
        F.count(F.lit(1)).alias("previous_count")
    )
    gated = rules.gate_rules(valid, rules.SHIPPED_RULES, _checks(valid), previous=previous, unique=True, **KEYS)
    return gated.select(*GATE_COLUMNS)


def rule_overlap(v: Inputs) -> DataFrame:
    matched = v.fx_gp.select(F.array_sort(rules.matched_rules(rules.SHIPPED_RULES)).alias("names"))
    several = matched.filter(F.size("names") > 1).select(F.array_join("names", "+").alias("rules"))
    return several.groupBy("rules").agg(F.count(F.lit(1)).alias("n"))


def _audit(v: Inputs) -> DataFrame:
    gps = [rule for rule in rules.SHIPPED_RULES if rule.name == "gps-ops"]
    ours = rules.tag_members(v.fx_gp, gps).select(F.col("rule").alias("dataset"), "norad")
    return audit.membership_difference(ours, v.fx_group, ["dataset", "norad"])


def rule_audit_extra_missing(v: Inputs) -> DataFrame:
    return _audit(v).filter("verdict <> 'both'")


def rule_audit_counts(v: Inputs) -> DataFrame:
    return audit.membership_counts(_audit(v), "dataset")


def rule_refresh_due(v: Inputs) -> DataFrame:
    from skyledger.operators.state import current_state

    states = current_state(v.fx_state_log, ["dataset"], "run_at").select("dataset", "last_success")
    return stale_rules(v.fx_rules, states)


def flagship(v: Inputs) -> DataFrame:
    """Scan, check, count and gate the source and every subset, one row each."""

    gp = v.fx_gp
    everything = rules.Rule("active", "active", minimum_mean_motion=None, minimum_records=1000,
                            maximum_count_drop_fraction=0.2)
    tags = F.array_append(rules.matched_rules(rules.SHIPPED_RULES), F.lit(everything.name))
    tagged = gp.withColumn("rule", F.explode(tags))
    profiled = quality.profile(tagged, _checks(gp), keys=["rule"], **KEYS)
    bounds = rules.rule_bounds(gp.sparkSession, [everything, *rules.SHIPPED_RULES])
    rows = bounds.join(profiled, "rule", "left").withColumn(
        "record_count", F.coalesce("record_count", F.lit(0).cast("bigint"))
    )
    gated = element_gate(rows, minimum=F.col("minimum_records"), previous=F.lit(None).cast("bigint"),
                         fraction=F.col("drop_fraction"))
    return gated.select("rule", "record_count", "failed_records", "earliest_epoch", "latest_epoch",
                        "first_position", "first_rule", "accepted", "error")


# --- the same queries as SQL -------------------------------------------------------------------

_BAD = {
    "out-of-range NORAD_CAT_ID": "not (norad between 1 and 999999999)",
    "out-of-range MEAN_MOTION": "not (mean_motion > 0 and mean_motion < 20)",
    "out-of-range ECCENTRICITY": "not (eccentricity >= 0 and eccentricity < 1)",
    "out-of-range INCLINATION": "not (inclination between 0 and 180)",
    "out-of-range RA_OF_ASC_NODE": "not (ra_of_asc_node between 0 and 360)",
    "out-of-range ARG_OF_PERICENTER": "not (arg_of_pericenter between 0 and 360)",
    "out-of-range MEAN_ANOMALY": "not (mean_anomaly between 0 and 360)",
    "invalid BSTAR": "bstar_raw in ('', 'x')",
    "non-finite BSTAR": "bstar_raw = 'NaN'",
}
_CASE = "case " + " ".join(f"when {test} then '{rule}'" for rule, test in _BAD.items()) + " end"
_INDEX = "case " + " ".join(f"when {test} then {i}" for i, test in enumerate(_BAD.values())) + " end"
_NAMES = "[" + ", ".join(f"'{rule}'" for rule in [*_BAD, "duplicate NORAD_CAT_ID"]) + "]"

_RULE_SQL = {
    "starlink": "starts_with(object_name, 'STARLINK')", "oneweb": "starts_with(object_name, 'ONEWEB')",
    "kuiper": "starts_with(object_name, 'KUIPER')", "qianfan": "starts_with(object_name, 'QIANFAN')",
    "hulianwang": "regexp_matches(object_name, '^(HULIANWANG|GUOWANG)')",
    "gps-ops": "regexp_matches(object_name, '^NAVSTAR')", "galileo": r"regexp_matches(object_name, '^GSAT\d{4}')",
    "glo-ops": "contains(object_name, 'GLONASS')", "beidou": "regexp_matches(object_name, '^BEIDOU')",
    "geo": "mean_motion between 0.95 and 1.05",
}
_MEMBERS = " union all ".join(
    f"select '{name}' as rule, g.* from {{source}} g where {test}" for name, test in _RULE_SQL.items()
)
_BOUNDS = "(values " + ", ".join(
    f"('{r.name}', '{r.source}', cast({r.minimum_records} as bigint), cast({r.maximum_count_drop_fraction} as double))"
    for r in rules.SHIPPED_RULES
) + ") b(rule, source, minimum_records, drop_fraction)"

EXTRA = {
    "sx_flagged": f"select *, {_INDEX} as bad from fx_gp",
    "sx_sound": "select * from sx_flagged where bad is null",
    "sx_valid": "select * from sx_sound where norad not in (select norad from sx_sound group by norad having count(*) > 1)",
    "sx_members": _MEMBERS.replace("{source}", "sx_flagged"),
    "sx_valid_members": _MEMBERS.replace("{source}", "sx_valid"),
    "sx_states": "select * exclude (rn) from (select *, row_number() over (partition by dataset order by run_at desc) rn from fx_state_log) where rn = 1",
}


def _gate_sql(metrics: str, cases: list[tuple]) -> str:
    def text(value, kind):
        return f"cast({'null' if value is None else value} as {kind})"

    rows = ", ".join(f"({text(a, 'bigint')}, {text(b, 'bigint')}, {text(c, 'double')})" for a, b, c in cases)
    return f"""
select minimum, previous, fraction, n as record_count, error is null as accepted, error from (
 select *, case when n < minimum then concat('record count ', n, ' is below minimum ', minimum)
  when previous > 0 and n < previous * (1.0 - fraction) then concat('record count dropped from ', previous, ' to ', n)
  else failure end as error
 from (values {rows}) c(minimum, previous, fraction), ({metrics}) m)"""


def _first_failure(source: str, keys: str = "") -> str:
    """First failing position and rule name; repeats rank after everything else."""

    part, select = (f"{keys}, ", f"{keys}, ") if keys else ("", "")
    group = f"group by {keys}" if keys else ""
    return f"""
select {select}min(struct_pack(p := pos, r := bad)) as f from (
 select {select}pos, bad from {source} where bad is not null
 union all
 select {select}pos, {len(_BAD)} as bad from (
  select {select}pos, row_number() over (partition by {part}norad order by pos) rn from {source}) where rn = 2) {group}"""


_FAILURE = f"""select count(*) as n, (select concat('record ', f.p, ': ', {_NAMES}[f.r + 1]) from ({_first_failure('sx_flagged')})) as failure
 from sx_flagged"""
_VALID_METRICS = "select count(*) as n, cast(null as varchar) as failure from sx_valid"


def _rule_gate_sql(members: str, previous: str) -> str:
    return f"""
select rule, source, minimum_records, record_count, earliest_epoch, latest_epoch, previous_count, error is null as accepted, error from (
 select *, case when record_count < minimum_records then concat('record count ', record_count, ' is below minimum ', minimum_records)
   when previous_count > 0 and record_count < previous_count * (1.0 - drop_fraction)
    then concat('record count dropped from ', previous_count, ' to ', record_count)
   when f is not null then concat('record ', f.p, ': ', {_NAMES}[f.r + 1]) end as error
 from (select b.rule, b.source, b.minimum_records, b.drop_fraction, coalesce(n, 0) as record_count, earliest_epoch, latest_epoch, f,
   p.previous_count
  from {_BOUNDS}
  left join (select rule, count(*) n, min(epoch) earliest_epoch, max(epoch) latest_epoch from {members} group by rule) m on m.rule = b.rule
  left join ({_first_failure(members, 'rule')}) e on e.rule = b.rule
  left join ({previous}) p on p.rule = b.rule))"""


_LINE_DAMAGE = """case when pos % 97 in (1, 2) then 'wrong number of fields' when pos % 97 = 3 then 'blank line'
 when pos % 97 = 4 then 'malformed quoting' when pos % 89 in (1, 2) then 'invalid MEAN_MOTION'
 when pos % 89 = 3 then 'out-of-range ELEMENT_SET_NO' when pos % 89 in (4, 5) then 'non-finite BSTAR'
 when pos % 89 = 6 then 'invalid BSTAR' end"""
_OBJECT_DAMAGE = """case pos % 79 when 1 then 'not an object' when 2 then 'lacks OBJECT_ID'
 when 4 then 'lacks EPOCH, INCLINATION' when 5 then 'lacks INCLINATION' end"""
_SPARK_KINDS = """case when pos % 23 in (0, 1, 2, 14, 16, 21) then 'integer' when pos % 23 in (3, 4, 5, 17, 18, 20, 22) then 'float'
 when pos % 23 in (8, 9, 10, 19) then 'non-finite' when pos % 23 = 13 then 'out-of-range' else 'invalid' end"""


def _lanes(text: str) -> str:
    sums = ", ',', ".join(
        f"cast(sum(cast(concat('0x', substr(sha256({text}), {s}, 16)) as ubigint)) as varchar)" for s in (1, 17, 33, 49)
    )
    return f"sha256(concat({sums}))"


QUERIES = {
    "gp_violations": (violations, " union all ".join(
        f"select '{rule}' as rule, count(*) as n from fx_gp where {test} having count(*) > 0" for rule, test in _BAD.items())),
    "gp_first_violation": (first_violation, f"""
select f.p as first_position, {_NAMES}[f.r + 1] as first_rule, (select count(*) from sx_flagged where bad is not null) as failed_records
from ({_first_failure('sx_flagged')})"""),
    "gp_record_verdicts": (record_verdicts, f"select pos, norad, {_CASE} as rule from fx_gp where {_CASE} is not null"),
    "gp_metrics": (metrics, f"""
select count(*) as record_count, min(epoch) as earliest_epoch, max(epoch) as latest_epoch,
 {_lanes("to_json(struct_pack(" + ", ".join(f"{n} := {'epoch_us(epoch::timestamp)' if n == 'epoch' else n}" for n in DIGESTED) + "))")} as digest from fx_gp"""),
    "gp_duplicate_keys": (duplicate_keys, """
select norad, count(*) as copies, min(pos) filter (where rn = 2) as second_pos
from (select norad, pos, row_number() over (partition by norad order by pos) rn from fx_gp) group by norad having count(*) > 1"""),
    "gp_valid_records": (valid_records, "select pos, norad, object_name from sx_valid"),
    "gp_gate_count_floor": (gate_count_floor, _gate_sql(_VALID_METRICS, FLOOR_CASES)),
    "gp_gate_count_drop": (gate_count_drop, _gate_sql(_VALID_METRICS, DROP_CASES)),
    "gp_gate_records": (gate_records, _gate_sql(_FAILURE, [(1, None, 0.2), (10_000_000_000, None, 0.2)])),
    "gp_token_coercion": (token_coercion, f"""
select pos, cell, kind, case when kind in ('integer', 'float') then cast(cell as double) end as value,
 case when kind = 'integer' then cast(cell as bigint) when cell = '5.' then 5 when cell = '9.0' then 9 end as whole from (select *, {_SPARK_KINDS} as kind from fx_cells)"""),
    "gp_epoch_parse": (epoch_parse, """
select pos, case pos % 7 when 0 then date_trunc('day', epoch) + interval 12 hour + interval 30 minute + interval 15250 millisecond
 when 1 then date_trunc('day', epoch) + interval 12 hour + interval 30 minute + interval 15 second
 when 2 then date_trunc('day', epoch) + interval 10 hour + interval 30 minute + interval 15 second
 when 3 then date_trunc('day', epoch) end as epoch from fx_gp"""),
    "gp_csv_lines": (csv_lines, f"""
select pos, damage, case when damage is null then case when pos % 97 = 7 then 'X, Y "Z"' else object_name end end as object_name,
 case when damage is null then case when pos % 97 = 5 then 'U"' else 'U' end end as classification_type,
 case when damage is null then norad end as norad_cat_id, case when damage is null then mean_motion end as mean_motion,
 case when damage is null then 0.5115e-4::double end as bstar, case when damage is null then cast(999 as bigint) end as element_set_no,
 case when damage is null then epoch end as epoch_at from (select *, {_LINE_DAMAGE} as damage from fx_gp)"""),
    "gp_csv_damage": (csv_damage, f"""
select damage, count(*) as n, min(pos) as first_pos from (select pos, {_LINE_DAMAGE} as damage from fx_gp)
where damage is not null group by damage"""),
    "gp_json_objects": (json_objects, f"""
select pos, damage, case when damage is null then object_name end as object_name,
 case when damage is null and pos % 79 <> 3 then '1998-067A' end as object_id, case when damage is null then norad end as norad_cat_id,
 case when damage is null then mean_motion end as mean_motion, case when damage is null then 3.25::double end as mean_anomaly
from (select *, {_OBJECT_DAMAGE} as damage from fx_gp)"""),
    "rule_membership": (rule_membership, "select pos, norad, rule from sx_members"),
    "rule_membership_many": (rule_membership_many, """
select rule, count(*) as n, min(pos) as first_pos, cast(sum(norad) as bigint) as norads from (
 select g.*, concat(kind, '-', i) as rule from fx_gp g, (select unnest(range(100)) as i), (select unnest(['start', 'either', 'digits', 'inner', 'band', 'both']) as kind)
 where case kind when 'start' then starts_with(object_name, concat('STARLINK-', i))
  when 'either' then starts_with(object_name, concat('ONEWEB-', i)) or starts_with(object_name, concat('KUIPER-', i))
  when 'digits' then regexp_matches(object_name, '^GSAT[0-9]{4}') and substr(object_name, 5, 2) = lpad(cast(i as varchar), 2, '0')
  when 'inner' then contains(object_name, concat(i, '7'))
  when 'band' then mean_motion >= 0.1::double + i / 10 and mean_motion <= 0.35::double + i / 8
  else starts_with(object_name, 'BEIDOU-') and mean_motion >= 0.15::double * (i + 1) end) group by rule"""),
    "gp_record_json": (record_json, f"""
select pos, concat('{{{{"OBJECT_NAME":"', case when pos % 97 = 7 then 'X, Y \\"Z\\"' else object_name end, '","OBJECT_ID":"1998-067A","EPOCH":"',
 replace(cast(epoch as varchar), ' ', 'T'), '","MEAN_MOTION":', mean_motion, ',"ECCENTRICITY":', eccentricity, ',"NORAD_CAT_ID":', norad,
 ',"ELEMENT_SET_NO":999,"BSTAR":5.115E-5,"MEAN_MOTION_DOT":1.0E-6,"MEAN_MOTION_DDOT":0}}}}') as document
from (select *, {_LINE_DAMAGE} as damage from fx_gp) where damage is null""".replace("{{", "{").replace("}}", "}")),
    "gp_json_round_trip": (json_round_trip, f"""
select pos, cast(null as varchar) as damage, case when pos % 97 = 7 then 'X, Y "Z"' else object_name end as object_name,
 case when pos % 97 = 5 then 'U"' else 'U' end as classification_type, norad as norad_cat_id, mean_motion, 0.5115e-4::double as bstar, 0.0::double as mean_motion_ddot,
 epoch as epoch_at from (select *, {_LINE_DAMAGE} as damage from fx_gp) where damage is null"""),
    "rule_counts": (rule_counts, """
select rule, count(*) as record_count, min(epoch) as earliest_epoch, max(epoch) as latest_epoch
from (select rule, epoch from sx_members union all select 'active', epoch from fx_gp) group by rule"""),
    "rule_gates": (rule_gates, _rule_gate_sql("sx_members", "select '' as rule, cast(null as bigint) as previous_count")),
    "rule_gates_valid": (rule_gates_valid, _rule_gate_sql(
        "sx_valid_members", "select rule, count(*) as previous_count from sx_members group by rule")),
    "rule_overlap": (rule_overlap, """
select rules, count(*) as n from (select pos, string_agg(rule, '+' order by rule) as rules from sx_members group by pos having count(*) > 1)
group by rules"""),
    "rule_audit_extra_missing": (rule_audit_extra_missing, """
select 'gps-ops' as dataset, norad, 'extra' as verdict from (select norad from sx_members where rule = 'gps-ops' except select norad from fx_group)
union all select 'gps-ops', norad, 'missing' from (select norad from fx_group except select norad from sx_members where rule = 'gps-ops')"""),
    "rule_audit_counts": (rule_audit_counts, """
select 'gps-ops' as dataset, *, extra = 0 and missing > 0 as strict_subset from (select
 (select count(*) from (select norad from sx_members where rule = 'gps-ops' except select norad from fx_group)) as extra,
 (select count(*) from (select norad from fx_group except select norad from sx_members where rule = 'gps-ops')) as missing,
 (select count(*) from (select norad from fx_group intersect select norad from sx_members where rule = 'gps-ops')) as shared)"""),
    "rule_refresh_due": (rule_refresh_due, """
select r.source, r.rule, s.last_success as source_success, o.last_success as rule_success
from fx_rules r join sx_states s on s.dataset = r.source left join sx_states o on o.dataset = r.rule
where s.last_success is not null and s.last_success is distinct from o.last_success"""),
    "element_gate_report": (flagship, f"""
select b.rule, coalesce(n, 0) as record_count, failed_records, earliest_epoch, latest_epoch,
 f.p as first_position, {_NAMES}[f.r + 1] as first_rule,
 coalesce(n, 0) >= minimum_records and f is null as accepted,
 case when coalesce(n, 0) < minimum_records then concat('record count ', coalesce(n, 0), ' is below minimum ', minimum_records)
  when f is not null then concat('record ', f.p, ': ', {_NAMES}[f.r + 1]) end as error
from (select rule, minimum_records from {_BOUNDS} union all select 'active', 1000) b
left join (select rule, count(*) n, count(bad) as failed_records, min(epoch) earliest_epoch, max(epoch) latest_epoch
 from (select rule, epoch, bad from sx_members union all select 'active', epoch, bad from sx_flagged) group by rule) m on m.rule = b.rule
left join ({_first_failure('sx_members', 'rule')} union all select 'active', f from ({_first_failure('sx_flagged')})) e on e.rule = b.rule"""),
}
ORACLES = {name: with_views(sql, EXTRA) for name, (_, sql) in QUERIES.items()}
