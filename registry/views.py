"""Views that turn the given tables into catalogue-shaped inputs.

The texts run on Spark and on the checking engine alike. A view names the tables
and views it reads in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.stages import computed_once
from skyledger.session import use_utc

VIEWS = {
    "fx_gp": """
select o_orderkey as pos,
 case when o_orderkey > 0 and o_orderkey % 997 = 0 then o_orderkey else o_orderkey + 1 end as norad,
 case o_orderkey % 11 when 0 then concat('STARLINK-', o_orderkey) when 1 then concat('ONEWEB-', o_orderkey)
  when 2 then concat('KUIPER-', o_orderkey) when 3 then concat('QIANFAN-', o_orderkey)
  when 4 then concat('HULIANWANG DIGUI-', o_orderkey) when 5 then concat('GUOWANG OBJECT ', o_orderkey)
  when 6 then concat('NAVSTAR ', o_orderkey)
  when 7 then concat('GSAT', lpad(cast(o_orderkey % 10000 as string), 4, '0'))
  when 8 then concat('GSAT-', o_orderkey % 40) when 9 then concat('COSMOS ', o_orderkey, ' (GLONASS)')
  else concat('BEIDOU-', o_orderkey) end as object_name,
 o_orderdate as epoch,
 cast((o_orderkey * 37) % 2010 as double) / 100 as mean_motion,
 cast((o_orderkey * 7) % 1010 as double) / 1000 as eccentricity,
 cast((o_orderkey * 13) % 1811 as double) / 10 as inclination,
 cast((o_orderkey * 29) % 3611 as double) / 10 as ra_of_asc_node,
 cast((o_orderkey * 31) % 3601 as double) / 10 as arg_of_pericenter,
 cast((o_orderkey * 41) % 3601 as double) / 10 as mean_anomaly,
 case o_orderkey % 50 when 7 then 'NaN' when 8 then 'x' when 9 then '' else '.5115E-4' end as bstar_raw
from {orders}""",
    "fx_satcat": """
select o_orderkey as pos,
 case when o_orderkey % 101 = 3 then 'abc' when o_orderkey % 103 = 4 then cast(o_orderkey as string)
  when o_orderkey % 10 = 2 then lpad(cast(o_orderkey + 1 as string), 9, '0')
  else cast(o_orderkey + 1 as string) end as norad_cat_id,
 case o_orderkey % 11 when 0 then concat('STARLINK-', o_orderkey) when 1 then concat('OneWeb-', o_orderkey)
  when 2 then concat('KUIPER-', o_orderkey) when 3 then concat('QIANFAN-', o_orderkey)
  when 4 then concat('CZ HULIANWANG-', o_orderkey) when 5 then ' - ' else concat(' OBJ ', o_orderkey, ' ') end as object_name,
 concat('1998-', lpad(cast(o_orderkey % 1000 as string), 3, '0'), 'A') as object_id,
 case o_orderkey % 5 when 0 then 'PAY' when 1 then 'R/B' when 2 then 'DEB' when 3 then 'UNK' else 'pay' end as object_type,
 case o_orderkey % 9 when 0 then '+' when 1 then 'P' when 2 then 'B' when 3 then 'S' when 4 then '-' when 5 then 'X'
  when 6 then 'D' when 7 then '?' else '' end as ops_status_code,
 case when o_orderkey % 7 = 0 then '-' else concat(' OWN', o_custkey % 20, ' ') end as owner,
 case when o_orderkey % 13 = 0 then '2026' when o_orderkey % 13 = 1 then '2001-02-30'
  else substr(cast(o_orderdate + interval 7000 day as string), 1, 10) end as launch_date,
 case when o_orderkey % 6 = 0 then '-' else concat('SITE', o_orderkey % 8) end as launch_site,
 case when o_orderkey % 4 = 0 then substr(cast(o_orderdate + interval 9400 day as string), 1, 10) else '' end as decay_date,
 case o_orderkey % 3 when 0 then '' when 1 then '92.94' else '96.70?' end as period,
 case o_orderkey % 6 when 0 then '' when 3 then '51.63' else '97.94' end as inclination,
 case o_orderkey % 5 when 0 then '-' else cast(400 + o_orderkey % 50 as string) end as apogee,
 case o_orderkey % 5 when 1 then 'n/a' else cast(300 + o_orderkey % 50 as string) end as perigee,
 case o_orderkey % 8 when 0 then '' when 1 then '0.05' when 2 then '~0.5' when 3 then '12?' when 4 then '-'
  when 5 then '1.5d' when 6 then '0.1' else '1' end as rcs,
 case o_orderkey % 10 when 0 then 'nea' when 1 then ' NCE ' when 2 then 'ZZZ' when 3 then 'NIE' else '' end as data_status_code,
 case o_orderkey % 9 when 0 then 'EA' when 1 then 'su' when 2 then '25544' when 3 then 'QQ' when 4 then 'EL1' else ' ' end as orbit_center
from {orders}""",
    "fx_gcat": """
select o_orderkey as pos, concat('S', lpad(cast(o_orderkey as string), 9, '0')) as jcat,
 case when o_orderkey % 2 = 1 or o_orderkey % 202 = 0 then 'A001' else lpad(cast(o_orderkey + 1 as string), 9, '0') end as satcat,
 case o_orderkey % 8 when 0 then '1998 Nov 20' when 2 then '2019 May  4 1200:30' when 4 then '1998 Nov?' else '-' end as ldate,
 case o_orderkey % 10 when 0 then '2024 Sep 1' else '' end as ddate,
 case o_orderkey % 12 when 0 then 'O' when 2 then 'L' when 4 then 'R' when 6 then 'D' when 8 then 'E' else '' end as status,
 case when o_orderkey % 14 = 0 then '-' else 'NASA' end as owner,
 case when o_orderkey % 16 = 0 then '' else 'US' end as state,
 case o_orderkey % 6 when 0 then '0' when 2 then '419725?' else '-' end as totmass,
 case o_orderkey % 4 when 0 then '-5' else '700' end as mass,
 '300~' as drymass,
 case o_orderkey % 6 when 0 then '' else '73' end as length,
 case o_orderkey % 6 when 0 then '0' else '20' end as diameter,
 case o_orderkey % 6 when 0 then '-' else '109' end as span,
 case o_orderkey % 18 when 0 then '-' else 'complex' end as shape,
 case o_orderkey % 16 when 0 then 'LEO/I' when 2 then 'LLEO/S' when 4 then 'MEO' when 6 then 'GEO/D' when 8 then 'GTO'
  when 10 then 'mol' when 12 then '-' else 'DSO' end as oporbit,
 case o_orderkey % 8 when 0 then 'ISS; Zarya' when 2 then 'A,B;;C ' when 4 then ';' else '-' end as altnames
from {orders}""",
    "fx_mag_lines": """
select o_orderkey as pos,
 concat(rpad(concat(lpad(cast(1 + o_orderkey % 99998 as string), 5, ' '), ' obj'), 33, ' '),
  lpad(case when o_orderkey % 9 <> 0 then 'n/a' when o_orderkey % 5 = 0 then '-1.8' when o_orderkey % 5 = 1 then '4.5'
   when o_orderkey % 5 = 2 then 'bad' else '6.0' end, 4, ' ')) as value
from {orders}""",
    "fx_group": """
select 'gps-ops' as dataset, o_orderkey + 1 as norad from {orders}
where (o_orderkey % 11 = 6 and o_orderkey % 5 <> 0) or o_orderkey % 1001 = 0""",
    "fx_request_log": """
select event_id, ts, event_type as dataset,
 case event_id % 10 when 0 then 403 when 1 then 403 when 2 then 503 when 3 then 404 when 4 then 304 else 200 end as status,
 cast(floor(abs(value) * 1000) as bigint) as bytes,
 case event_id % 3 when 0 then 'JSON' else 'CSV' end as wire_format,
 case event_id % 10 when 0 then concat('GP data HAS NOT', chr(10), ' updated   since your last successful', chr(10), 'download ', event_id)
  when 1 then concat('<h1>Forbidden</h1> <p>', event_id, '</p>') when 2 then '' else 'ok' end as body
from {events}""",
    "fx_versions": """
select event_type as stream, concat('v', lpad(cast(event_id as string), 9, '0')) as version, event_id % 300 = 0 as is_current
from {events}""",
    "fx_source_snapshots": """
select case event_id % 2 when 0 then 'satcat' else 'gcat' end as source, ts,
 case event_id % 5 when 0 then 304 when 1 then 503 else 200 end as status, concat('body-', event_id) as body_path
from {events}""",
    # Element records as CSV lines, some of them damaged in transit.
    "fx_gp_lines": """
select pos, case pos % 97
  when 1 then substr(line, 1, 40) when 2 then concat(line, ',9') when 3 then ''
  when 4 then concat('"A"B', substr(line, instr(line, ','))) when 5 then replace(line, ',U,', ',U",')
  when 6 then concat(line, chr(13)) when 7 then concat('"X, Y ""Z""', '"', substr(line, instr(line, ',')))
  else line end as value
from (select pos, concat_ws(',', object_name, '1998-067A', replace(cast(epoch as string), ' ', 'T'),
  case pos % 89 when 1 then 'x' when 2 then '' else cast(mean_motion as string) end,
  cast(eccentricity as string), cast(inclination as string), cast(ra_of_asc_node as string),
  cast(arg_of_pericenter as string), cast(mean_anomaly as string), '0', 'U', cast(norad as string),
  case pos % 89 when 3 then '99999999999999999999' else '999' end, cast(pos % 1000 as string),
  case pos % 89 when 4 then 'NaN' when 5 then '1e999' when 6 then '1.5d' else '.5115E-4' end, '.1E-5', '0') as line
 from {fx_gp}) l""",
    # Element records as JSON objects, some without a required field.
    "fx_gp_objects": """
select pos, case when pos % 79 = 1 then '[1]' else concat('{{"OBJECT_NAME":"', object_name, '"',
  case when pos % 79 = 2 then '' when pos % 79 = 3 then ',"OBJECT_ID":null' else ',"OBJECT_ID":"1998-067A"' end,
  case when pos % 79 = 4 then '' else concat(',"EPOCH":"', replace(cast(epoch as string), ' ', 'T'), 'Z"') end,
  ',"MEAN_MOTION":', cast(mean_motion as string), ',"ECCENTRICITY":', cast(eccentricity as string),
  case when pos % 79 in (4, 5) then '' else concat(',"INCLINATION":', cast(inclination as string)) end,
  ',"RA_OF_ASC_NODE":1.5,"ARG_OF_PERICENTER":2,"MEAN_ANOMALY":3.25,"BSTAR":0.5,"MEAN_MOTION_DOT":0,"MEAN_MOTION_DDOT":0',
  ',"EPHEMERIS_TYPE":0,"CLASSIFICATION_TYPE":"U","NORAD_CAT_ID":', cast(norad as string), ',"ELEMENT_SET_NO":999}}') end as value
from {fx_gp}""",
    # Numeric cells of every kind, and epochs that do and do not parse.
    "fx_cells": """
select pos, case pos % 23 when 17 then '1e295' when 18 then '1.7e308' when 19 then '111111111111111111111111111111e289'
  when 20 then '9.5' when 21 then '00000000000000000000012' when 22 then '9.0' when 0 then '12' when 1 then '+7' when 2 then '-0' when 3 then '1.50' when 4 then '.5115E-4'
  when 5 then '5.' when 6 then '' when 7 then 'x' when 8 then 'NaN' when 9 then '-inf' when 10 then '1e999'
  when 11 then '1.5d' when 12 then '0x1p3' when 13 then '9223372036854775808' when 14 then '9223372036854775807'
  when 15 then '1_0' else cast(pos as string) end as cell,
 case pos % 7 when 0 then concat(substr(cast(epoch as string), 1, 10), 'T12:30:15.250000')
  when 1 then concat(substr(cast(epoch as string), 1, 10), 'T12:30:15Z')
  when 2 then concat(substr(cast(epoch as string), 1, 10), ' 12:30:15+02:00')
  when 3 then substr(cast(epoch as string), 1, 10) when 4 then 'yesterday' when 5 then '2026-02-30T00:00:00' else '' end as epoch_text
from {fx_gp}""",
    "fx_gcat_lines": """
select pos, case when pos % 500 = 0 then '# remark' when pos % 500 = 2 then '' else
 concat_ws(chr(9), jcat, satcat, ldate, ddate, status, owner, state, totmass, mass, drymass, length, diameter, span, shape,
  oporbit, case when pos % 500 = 4 then null else altnames end) end as value
from {fx_gcat}""",
    # Catalogue files with headers of their own; '~!' stands for a byte that no UTF-8 text has.
    "fx_satcat_files": """
select concat('f', o_orderkey % 7) as file, o_orderkey as pos, concat(
 case when o_orderkey % 7 in (1, 5) then concat(name, ',', rcs, ',', decay_date, ',', object_type, ',', object_id, ',', norad_cat_id)
  when o_orderkey % 7 = 3 then concat(norad_cat_id, ',', name, ',', object_id, ',', object_type)
  else concat(norad_cat_id, ',', name, ',', object_id, ',', object_type, ',', decay_date, ',', owner, ',', rcs) end,
 case when o_orderkey % 7 = 2 and o_orderkey % 5 = 2 then '~!' when o_orderkey % 7 = 4 and o_orderkey % 3 = 1 then ',"half a' else '' end,
 case when o_orderkey % 2 = 0 then chr(13) else '' end) as value
from (select pos as o_orderkey, norad_cat_id, case when pos % 12 = 0 then concat('"', object_name, ', ""X"" Y"') else object_name end as name,
  object_id, object_type, decay_date, owner, rcs from {fx_satcat}) s
union all select file, cast(-1 as bigint), value from (
 select 'f0' as file, 'NORAD_CAT_ID,OBJECT_NAME,OBJECT_ID,OBJECT_TYPE,DECAY_DATE,OWNER,RCS' as value
 union all select 'f1', 'OBJECT_NAME,RCS,DECAY_DATE,OBJECT_TYPE,OBJECT_ID,NORAD_CAT_ID'
 union all select 'f2', 'NORAD_CAT_ID,OBJECT_NAME,OBJECT_ID,OBJECT_TYPE,DECAY_DATE,OWNER,RCS'
 union all select 'f3', 'NORAD_CAT_ID,OBJECT_NAME,OBJECT_ID,OBJECT_TYPE'
 union all select 'f4', 'NORAD_CAT_ID,OBJECT_NAME,OBJECT_ID,OBJECT_TYPE,DECAY_DATE,OWNER,RCS'
 union all select 'f5', 'OBJECT_NAME,RCS,DECAY_DATE,OBJECT_TYPE,OBJECT_ID,NORAD_CAT_ID'
 union all select 'f6', 'NORAD_CAT_ID,OBJECT_NAME,OBJECT_ID,OBJECT_TYPE,DECAY_DATE,OWNER,RCS') h""",
    "fx_gcat_files": """
select concat('g', pos % 5) as file, pos, concat(
 case when pos % 5 in (0, 2) then concat_ws(chr(9), jcat, satcat, owner, totmass, oporbit) else concat_ws(chr(9), oporbit, totmass, owner, satcat) end,
 case when pos % 5 = 2 and pos % 3 = 0 then '~!' else '' end) as value
from {fx_gcat}
union all select file, cast(pos as bigint), value from (
 select 'g0' as file, -2 as pos, concat_ws(chr(9), '#JCAT', 'Satcat', 'Owner', 'TotMass', 'OpOrbit') as value
 union all select 'g0', -3, '# a remark' union all select 'g1', -2, concat_ws(chr(9), '#JCAT', 'TotMass', 'Owner', 'Satcat')
 union all select 'g2', -2, concat_ws(chr(9), '#JCAT', 'Satcat', 'Owner', 'TotMass', 'OpOrbit') union all select 'g3', -2, '# no header here'
 union all select 'g4', -2, concat_ws(chr(9), '#JCAT', 'Mass', 'State', 'Satcat')) h""",
    "fx_star_lines": """
select o_orderkey as pos, concat(
 case when o_orderkey % 61 = 0 then ' x  ' else lpad(cast(o_orderkey % 9000 + 1 as string), 4, ' ') end,
 rpad(case when o_orderkey % 3 = 0 then '' else concat(o_orderkey % 90, 'Alp Ori') end, 10, ' '), rpad('', 61, ' '),
 lpad(cast(o_orderkey % 24 as string), 2, '0'), lpad(cast((o_orderkey * 7) % 60 as string), 2, '0'),
 case when o_orderkey % 59 = 0 then '    ' else concat(lpad(cast((o_orderkey * 11) % 60 as string), 2, '0'), '.', o_orderkey % 10) end,
 case when o_orderkey % 2 = 0 then '-' else '+' end, lpad(cast(o_orderkey % 90 as string), 2, '0'),
 lpad(cast((o_orderkey * 3) % 60 as string), 2, '0'), lpad(cast((o_orderkey * 5) % 60 as string), 2, '0'),
 rpad('', 12, ' '), case when o_orderkey % 57 = 0 then '' else lpad(cast(cast((o_orderkey * 17) % 700 as double) / 100 as string), 5, ' ') end) as value
from {orders}""",
    "fx_star_names": """
select cast(k + 1 as string) as hr, case when k % 25 <> 0 or k % 100 = 0 then '' else concat('Star ', k) end as name
from (select distinct o_orderkey % 9000 as k from {orders}) o""",
    "fx_features": """
select o_orderkey as pos, case when o_orderkey % 41 = 0 then '' else concat('F', o_custkey % 88) end as id,
 case when o_orderkey % 43 = 0 then '"none"' else concat(
  '[[[', cast(cast((o_orderkey * 7) % 36000 as double) / 100 - 180 as string), ',', cast(cast(o_orderkey % 180 as double) - 90 as string), '],[',
  o_orderkey % 180, ',1.25', case when o_orderkey % 5 = 0 then ',"n"' else '' end, ']],[[1,2]',
  case o_orderkey % 4 when 0 then '' when 1 then ',["3",4]' when 2 then ',[5]' else ',[-6.5,7],[8,9]' end, ']]') end as coordinates
from {orders}""",
    # State rows, one per run and data set.
    "fx_state_log": """
select concat(event_type, '-', user_id % 40) as dataset, ts as run_at, ts as last_attempt,
 case event_id % 4 when 0 then cast(null as timestamp) when 1 then ts - interval 20 hour when 2 then ts - interval 40 hour else ts end as last_success,
 case event_id % 5 when 0 then null else 200 end as last_http_status,
 case event_id % 3 when 0 then concat('HTTP 503: ', event_id) when 1 then '' else null end as error,
 event_id * 3 as record_count,
 case event_id % 4 when 0 then cast(null as timestamp) else ts + interval 7500 second end as retry_after,
 case event_id % 5 when 0 then null else cast(floor(abs(value) * 1000) as bigint) end as last_response_bytes
from {events}""",
    "fx_expected": """
select distinct concat(event_type, '-', user_id % 45) as dataset, user_id % 45 as position from {events}""",
    "fx_rules": """
select distinct concat(event_type, '-', user_id % 40) as rule, concat(event_type, '-', user_id % 4) as source
from {events}""",
    # Run summaries of several sites.
    "fx_runs": """
select user_id as site, case when event_id % 13 = 0 then cast(null as timestamp) else ts end as checked_at, ts,
 cast(event_id % 4 as int) as published, cast(floor(abs(value) * 200000) as bigint) as daily_bytes,
 case when event_id % 5 = 0 then 0 else 83886080 end as budget_bytes, event_id % 7 = 0 as blocked,
 case event_id % 14 when 0 then 'forbidden' when 7 then '' else null end as stop_reason,
 event_id % 6 = 1 as budget_exhausted, cast(case when event_id % 5 = 2 then event_id % 3 else 0 end as int) as derived_failed
from {events}""",
    "fx_catalogue_runs": """
select user_id as site, case when event_id % 17 = 0 then cast(null as timestamp) else ts end as checked_at, ts,
 event_id % 3 <> 0 as successful, case when event_id % 9 = 0 then null else 'failed' end as result,
 case event_id % 6 when 0 then 'HTTP 503' when 3 then '' else null end as error
from {events}""",
    "fx_raw_states": """
select concat('d', event_id) as dataset,
 case event_id % 6 when 0 then cast(ts as string) when 1 then 'soon' when 2 then null else concat(substr(cast(ts as string), 1, 19), '+00:00') end as last_attempt,
 case event_id % 5 when 0 then null else concat(substr(cast(ts as string), 1, 10), 'T', substr(cast(ts as string), 12, 8), 'Z') end as last_success,
 cast(null as string) as retry_after,
 case event_id % 7 when 0 then '-1' when 1 then '1.5' when 2 then null when 3 then 'true' else cast(event_id as string) end as record_count,
 case event_id % 11 when 0 then '[]' else cast(event_id * 2 as string) end as last_response_bytes
from {events}""",
}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


def _reads(text: str) -> list[str]:
    return re.findall(r"(?<!\{)\{([a-z_]+)\}(?!\})", text)


class Inputs:
    """Tables and views of one folder as DataFrames; nothing is registered in the session."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = use_utc(spark), sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        text = VIEWS[name]
        frame = self.spark.sql(text, **{source: self.view(source) for source in _reads(text)})
        built = [F.col(column) for column in ("value", "coordinates") if column in frame.columns]
        # A reader would deliver these texts ready made; do not rebuild them at every use.
        return computed_once(frame, *built, keep=[c for c in frame.columns if c not in ("value", "coordinates")]) if built else frame

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_") or name in TABLES:
            return self.view(name)
        raise AttributeError(name)


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the definitions of every view it reads, as one statement."""

    known = VIEWS | (extra or {})
    order: list[str] = []

    def add(text: str) -> None:
        for name in re.findall(r"\b([fs]x_[a-z_]+)\b", text):
            if name in known and name not in order:
                add(known[name])
                order.append(name)

    add(body)
    plain = {name: re.sub(r"(?<!\{)\{([a-z_]+)\}(?!\})", r"\1", known[name]).replace("{{", "{").replace("}}", "}") for name in order}
    ctes = ",\n".join(f"{name} as ({plain[name].strip()})" for name in order)
    return f"with {ctes}\n{body.strip()}" if order else body.strip()
