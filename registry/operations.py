"""Queries on request logs, state tables, releases and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry.views import Inputs, with_views
from skyledger.functions.ages import is_due, next_attempt
from skyledger.functions.responses import refusal_text
from skyledger.operators import checks, state
from skyledger.operators.retention import prune_list, retention
from skyledger.operators.rolling import remaining_bytes, trailing_bytes

INTERVAL = 7500
BUDGET = 83_886_080


def as_of() -> Column:
    return F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")


def states(v: Inputs) -> DataFrame:
    return state.current_state(v.fx_state_log, ["dataset"], "run_at")


def log_classify(v: Inputs) -> DataFrame:
    return state.classify_log(v.fx_request_log).select("event_id", "dataset", "status", "outcome")


def log_outcome_counts(v: Inputs) -> DataFrame:
    return state.classify_log(v.fx_request_log).groupBy("dataset", "outcome").agg(F.count(F.lit(1)).alias("n"))


def log_refusal_text(v: Inputs) -> DataFrame:
    log = v.fx_request_log.filter("status <> 200")
    return log.select("event_id", refusal_text(F.col("status"), F.col("body")).alias("detail"))


def log_rolling_bytes(v: Inputs) -> DataFrame:
    used = trailing_bytes(v.fx_request_log, keys=["dataset"])
    return used.withColumn("remaining", remaining_bytes(F.col("used"), 10_000_000))


def log_rolling_bytes_all(v: Inputs) -> DataFrame:
    return trailing_bytes(v.fx_request_log)


def log_size_forecast(v: Inputs) -> DataFrame:
    return state.size_forecasts(v.fx_request_log)


def log_admission(v: Inputs) -> DataFrame:
    forecasts = state.size_forecasts(v.fx_request_log)
    return state.admission(forecasts, F.lit(20_000), F.lit(50_000))


def run_counters(v: Inputs) -> DataFrame:
    """Counters per hour of the log; a subset row is one of the derived kind."""

    log = state.classify_log(v.fx_request_log)
    outcome = F.when(F.col("outcome") == "received", "published").otherwise(F.col("outcome"))
    outcome = F.when(F.col("event_id") % 21 == 5, "skipped").when(F.col("event_id") % 21 == 6, "budget-skipped").otherwise(outcome)
    rows = log.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("run"), outcome.alias("outcome"),
                      (F.col("event_id") % 4 == 3).alias("derived"))
    return state.run_counters(rows, ["run"])


def state_current(v: Inputs) -> DataFrame:
    return states(v)


def state_attempt_order(v: Inputs) -> DataFrame:
    ordered = state.attempt_order(states(v), v.fx_expected)
    return ordered.select("dataset", "position", "last_attempt", "rank")


def state_due(v: Inputs) -> DataFrame:
    due = state.due_datasets(states(v), as_of(), INTERVAL)
    return due.select("dataset", "last_attempt", "retry_after", "due_at")


def state_next_attempt(v: Inputs) -> DataFrame:
    return v.fx_state_log.select(
        "dataset", "run_at",
        next_attempt(F.col("retry_after"), F.col("last_attempt"), INTERVAL).alias("due_at"),
        is_due(F.col("retry_after"), F.col("last_attempt"), INTERVAL, as_of()).alias("due"),
    )


def state_repair(v: Inputs) -> DataFrame:
    return state.repair_states(states(v), F.col("dataset").startswith("click"))


def state_sanity(v: Inputs) -> DataFrame:
    typed = state.checked_states(v.fx_raw_states)
    return typed.select("dataset", "valid", "record_count", "last_response_bytes",
                        F.col("last_attempt").cast("timestamp_ntz").alias("last_attempt"))


def source_last_good(v: Inputs) -> DataFrame:
    return state.last_good_sources(v.fx_source_snapshots)


def source_as_of(v: Inputs) -> DataFrame:
    """What each hourly run over the log was served of each source."""

    runs = v.fx_source_snapshots.select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("run_at")).distinct()
    asked = runs.select(F.explode(F.array(F.lit("satcat"), F.lit("gcat"))).alias("source"), "run_at")
    return state.sources_as_of(asked, v.fx_source_snapshots)


def release_retention(v: Inputs) -> DataFrame:
    return retention(v.fx_versions, 3)


def release_prune(v: Inputs) -> DataFrame:
    return prune_list(v.fx_versions, 2)


def health_dataset_age(v: Inputs) -> DataFrame:
    return checks.dataset_checks(v.fx_expected, states(v), as_of())


def health_run_rows(v: Inputs) -> DataFrame:
    severity, detail = checks.run_verdict(as_of())
    return v.fx_runs.select("site", "ts", severity.alias("severity"), detail.alias("detail"))


def _newest(runs: DataFrame) -> DataFrame:
    return state.current_state(runs.withColumn("_all", F.lit(1)), ["_all"], "ts").drop("_all")


def health_run(v: Inputs) -> DataFrame:
    return checks.run_check(_newest(v.fx_runs), as_of())


def health_catalog_rows(v: Inputs) -> DataFrame:
    severity, detail = checks.catalogue_verdict(as_of())
    return v.fx_catalogue_runs.select("site", "ts", severity.alias("severity"), detail.alias("detail"))


def health_catalog(v: Inputs) -> DataFrame:
    return checks.catalogue_check(_newest(v.fx_catalogue_runs), as_of())


def _manifest(v: Inputs) -> DataFrame:
    return v.fx_state_log.agg(F.countDistinct("dataset").alias("records"))


def health_public_tree(v: Inputs) -> DataFrame:
    return checks.manifest_check(_manifest(v))


def _all(v: Inputs) -> DataFrame:
    return checks.all_checks(health_public_tree(v), health_catalog(v), health_run(v), health_dataset_age(v))


def health_summary(v: Inputs) -> DataFrame:
    return checks.report(_all(v))


# --- the same queries as SQL -------------------------------------------------------------------

_NOW = "timestamp '2024-01-31 00:00:00'"
_CLASSIFY = r"""case when status = 403 and contains(lower(regexp_replace(body, '\s+', ' ', 'g')), 'has not updated since your last successful') then 'not-updated'
 when status = 403 then 'forbidden' when status >= 500 then 'upstream-error' when status <> 200 then 'http-error' else 'received' end"""
_FORECAST = """
select dataset, case when last.wire_format = 'CSV' then last.bytes + last.bytes * 5 // 100 end as expected_bytes
from (select dataset, arg_max(struct_pack(bytes := bytes, wire_format := wire_format), ts) filter (where status = 200) as last from fx_request_log group by dataset)"""
_AGE = "(epoch_us({now}) - epoch_us({at})) / 1000000.0"


def _age(at: str) -> str:
    return _AGE.format(now=_NOW, at=at)


def _severity(at: str, warning: int, critical: int) -> str:
    return f"case when {_age(at)} >= {critical} then 'critical' when {_age(at)} >= {warning} then 'warning' when {at} is not null then 'ok' end"


def _old(at: str) -> str:
    return f"printf('%.1fh old', {_age(at)} / 3600)"


_RUN = f"""
select *, case when blocked then 'critical' when budget_exhausted or derived_failed <> 0 then 'warning' else coalesce(by_age, 'ok') end as severity,
 case when blocked then concat('upstream refuses requests (', coalesce(nullif(stop_reason, ''), 'refused'), '); ', summary)
  when budget_exhausted then concat('the day''s allowance is used up; ', summary)
  when derived_failed <> 0 then concat(derived_failed, ' subsets not published; ', summary)
  when checked_at is null then summary else concat('last run ', {_old('checked_at')}, '; ', summary) end as detail
from (select *, {_severity('checked_at', 64800, 129600)} as by_age, concat(published, ' published, ', printf('%.1f', daily_bytes / 1048576.0), ' MiB/24h',
 case when budget_bytes <> 0 then concat(' of ', printf('%.0f', budget_bytes / 1048576.0), ' MiB') else '' end) as summary from fx_runs)"""
_CATALOGUE = f"""
select site, ts, case when checked_at is null then 'critical' when by_age = 'ok' and not successful then 'warning' else by_age end as severity,
 case when checked_at is null then 'no time of a run' else concat({_old('checked_at')}, case when successful then '' else
  concat('; last run ', coalesce(result, 'failed'), case when coalesce(error, '') <> '' then concat(': ', error) else '' end) end) end as detail
from (select *, {_severity('checked_at', 129600, 259200)} as by_age from fx_catalogue_runs)"""
_DATASETS = f"""
select concat('gp:', e.dataset) as name, coalesce(by_age, 'critical') as severity,
 case when s.dataset is null then 'no status row' when last_success is null then 'never published'
  else concat({_old('last_success')}, case when by_age <> 'ok' and coalesce(error, '') <> '' then concat('; last error: ', error) else '' end) end as detail
from fx_expected e left join (select *, {_severity('last_success', 64800, 129600)} as by_age from sx_states) s on s.dataset = e.dataset"""
_TREE = """select 'public-tree' as name, 'ok' as severity, concat(count(distinct dataset), ' records published') as detail from fx_state_log"""
_NEWEST_RUN = "select 'gp-run' as name, severity, detail from sx_runs order by ts desc limit 1"
_NEWEST_CATALOGUE = "select 'catalog' as name, severity, detail from sx_catalogue_runs order by ts desc limit 1"
_FAILED = "('forbidden', 'upstream-error', 'http-error', 'validation-error', 'network-error')"
_ZONED = r"regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d+)?(Z|\+00:00)')"


def _bad_instant(column: str) -> str:
    return f"({column} is not null and not {_ZONED.format(c=column)})"


def _bad_count(column: str) -> str:
    return f"({column} is not null and not regexp_full_match({column}, '[0-9]+'))"


EXTRA = {
    "sx_states": "select * exclude (rn) from (select *, row_number() over (partition by dataset order by run_at desc) rn from fx_state_log) where rn = 1",
    "sx_runs": _RUN,
    "sx_catalogue_runs": _CATALOGUE,
}
_STATE_COLUMNS = "dataset, run_at, last_attempt, last_success, last_http_status, error, record_count, retry_after, last_response_bytes"

QUERIES = {
    "log_classify": (log_classify, f"select event_id, dataset, status, {_CLASSIFY} as outcome from fx_request_log"),
    "log_outcome_counts": (log_outcome_counts, f"select dataset, {_CLASSIFY} as outcome, count(*) as n from fx_request_log group by 1, 2"),
    "log_refusal_text": (log_refusal_text, r"""
select event_id, case when text = '' then concat('HTTP ', status) else concat('HTTP ', status, ': ', text) end as detail from (select *,
 left(trim(regexp_replace(case when contains(body, '<') and contains(body, '>') then regexp_replace(body, '<[^>]+>', ' ', 'g') else body end, '\s+', ' ', 'g')), 500) as text
 from fx_request_log where status <> 200)"""),
    "log_rolling_bytes": (log_rolling_bytes, """
select dataset, ts, used, greatest(10000000 - used, 0) as remaining from (select distinct dataset, ts, cast(sum(bytes) over
 (partition by dataset order by ts range between interval '86399.999999 seconds' preceding and current row) as bigint) as used from fx_request_log)"""),
    "log_rolling_bytes_all": (log_rolling_bytes_all, """
select distinct ts, cast(sum(bytes) over (order by ts range between interval '86399.999999 seconds' preceding and current row) as bigint) as used from fx_request_log"""),
    "log_size_forecast": (log_size_forecast, _FORECAST),
    "log_admission": (log_admission, f"""
select dataset, expected_bytes, case when expected_bytes is null then 'attempt' when expected_bytes > 50000 then 'over-dataset-cap'
 when expected_bytes > 20000 then 'budget-skipped' else 'attempt' end as admission from ({_FORECAST})"""),
    "run_counters": (run_counters, f"""
select run, count(*) filter (where not derived and outcome not in ('skipped', 'budget-skipped')) as attempted,
 count(*) filter (where not derived and outcome = 'published') as published, count(*) filter (where not derived and outcome in ('skipped', 'budget-skipped')) as skipped,
 count(*) filter (where not derived and outcome in {_FAILED}) as failed, coalesce(bool_or(not derived and outcome = 'forbidden'), false) as blocked,
 coalesce(bool_or(not derived and outcome = 'budget-skipped'), false) as budget_exhausted, count(*) filter (where derived and outcome = 'published') as derived_published,
 count(*) filter (where derived and outcome in {_FAILED}) as derived_failed
from (select date_trunc('hour', ts) as run, event_id % 4 = 3 as derived, case event_id % 21 when 5 then 'skipped' when 6 then 'budget-skipped'
 else case {_CLASSIFY} when 'received' then 'published' else {_CLASSIFY} end end as outcome from fx_request_log) group by run"""),
    "state_current": (state_current, f"select {_STATE_COLUMNS} from sx_states"),
    "state_attempt_order": (state_attempt_order, """
select e.dataset, position, last_attempt, row_number() over (order by last_attempt nulls first, position, e.dataset) as rank
from fx_expected e left join sx_states s on s.dataset = e.dataset"""),
    "state_due": (state_due, f"""
select dataset, last_attempt, retry_after, coalesce(retry_after, last_attempt + interval 7500 second) as due_at from sx_states
where coalesce(retry_after, last_attempt + interval 7500 second) is null or coalesce(retry_after, last_attempt + interval 7500 second) <= {_NOW}"""),
    "state_next_attempt": (state_next_attempt, f"""
select dataset, run_at, coalesce(retry_after, last_attempt + interval 7500 second) as due_at,
 coalesce(coalesce(retry_after, last_attempt + interval 7500 second) <= {_NOW}, true) as due from fx_state_log"""),
    "state_repair": (state_repair, """
select dataset, run_at, last_attempt, last_success, cast(null as integer) as last_http_status, error, record_count, cast(null as timestamp) as retry_after,
 cast(null as bigint) as last_response_bytes from sx_states where starts_with(dataset, 'click')
 and (last_http_status is not null or retry_after is not null or last_response_bytes is not null)"""),
    "state_sanity": (state_sanity, f"""
select dataset, not ({_bad_instant('last_attempt')} or {_bad_instant('last_success')} or {_bad_count('record_count')} or {_bad_count('last_response_bytes')}) as valid,
 case when regexp_full_match(record_count, '[0-9]+') then cast(record_count as bigint) end as record_count,
 case when regexp_full_match(last_response_bytes, '[0-9]+') then cast(last_response_bytes as bigint) end as last_response_bytes,
 case when {_ZONED.format(c='last_attempt')} then cast(left(last_attempt, 19) as timestamp) end as last_attempt from fx_raw_states"""),
    "source_last_good": (source_last_good, """
select source, body_path, fetched_at, newest <> 200 as from_cache, newest not in (200, 304) as stale,
 case when newest not in (200, 304) then concat('HTTP ', newest) end as error, body_path is not null as usable
from (select source, arg_max(body_path, ts) filter (where status = 200) as body_path, max(ts) filter (where status = 200) as fetched_at,
 arg_max(status, ts) as newest from fx_source_snapshots group by source)"""),
    "source_as_of": (source_as_of, """
select r.run_at, r.source, g.body_path, g.ts as fetched_at, n.status <> 200 as from_cache, n.status not in (200, 304) as stale,
 case when n.status not in (200, 304) then concat('HTTP ', n.status) end as error, g.body_path is not null as usable
from (select distinct date_trunc('hour', ts) as run_at, unnest(['satcat', 'gcat']) as source from fx_source_snapshots) r asof left join (select * from fx_source_snapshots where status = 200) g on g.source = r.source and g.ts <= r.run_at
 asof left join fx_source_snapshots n on n.source = r.source and n.ts <= r.run_at"""),
    "release_retention": (release_retention, """
select stream, version, is_current, rn <= 3 or is_current as retained
from (select *, row_number() over (partition by stream order by version desc) rn from fx_versions)"""),
    "release_prune": (release_prune, """
select stream, version, is_current from (select *, row_number() over (partition by stream order by version desc) rn from fx_versions) where rn > 2 and not is_current"""),
    "health_dataset_age": (health_dataset_age, _DATASETS),
    "health_run_rows": (health_run_rows, "select site, ts, severity, detail from sx_runs"),
    "health_run": (health_run, _NEWEST_RUN),
    "health_catalog_rows": (health_catalog_rows, "select * from sx_catalogue_runs"),
    "health_catalog": (health_catalog, _NEWEST_CATALOGUE),
    "health_public_tree": (health_public_tree, _TREE),
    "health_summary": (health_summary, f"""
select case max(case severity when 'critical' then 2 when 'warning' then 1 else 0 end) when 2 then 'critical' when 1 then 'warning' else 'ok' end as severity,
 count(*) filter (where severity = 'ok') as n_ok, count(*) filter (where severity = 'warning') as n_warning,
 count(*) filter (where severity = 'critical') as n_critical, count(*) filter (where severity = 'critical') = 0 as successful
from (({_TREE}) union all ({_NEWEST_CATALOGUE}) union all ({_NEWEST_RUN}) union all ({_DATASETS}))"""),
}
ORACLES = {name: with_views(sql, EXTRA) for name, (_, sql) in QUERIES.items()}
