"""Refresh of an element data set and of the subsets cut from it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import rules as rule_ops
from skyledger.operators.digest import canonical_json, multiset_digest
from skyledger.operators.gates import element_gate
from skyledger.operators.literals import literal_rows
from skyledger.operators.quality import element_checks, profile
from skyledger.operators.rules import Rule
from skyledger.operators.rolling import trailing_bytes
from skyledger.operators.state import REQUEST_FIELDS, run_counters
from skyledger.sinks.release import PublishError, ReleaseStore
from skyledger.sinks.tables import all_rows, append_rows, newest_rows
from skyledger.sources.elements import DamagedSource, csv_gate, read_element_csv

STATE_SCHEMA = (
    "dataset string, run_at timestamp, last_attempt timestamp, last_success timestamp, "
    "last_http_status int, last_result string, error string, record_count bigint, sha256 string, "
    "earliest_epoch timestamp, latest_epoch timestamp, retry_after timestamp, "
    "last_response_bytes bigint, wire_format string, landing string, landed_path string"
)
STATE_FIELDS = dict(field.rsplit(" ", 1) for field in STATE_SCHEMA.split(", "))

#: One row a run; :func:`skyledger.operators.checks.run_check` reads the newest.
RUN_FIELDS = {
    "checked_at": "timestamp", "attempted": "bigint", "published": "bigint", "skipped": "bigint", "failed": "bigint",
    "blocked": "boolean", "budget_exhausted": "boolean", "derived_published": "bigint", "derived_failed": "bigint",
    "daily_bytes": "bigint", "budget_bytes": "bigint", "budget_remaining_bytes": "bigint", "stop_reason": "string",
}
RUN_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RUN_FIELDS.items())

CHECKED_FIELDS = {
    name: name.lower()
    for name in (
        "NORAD_CAT_ID", "MEAN_MOTION", "ECCENTRICITY", "INCLINATION", "RA_OF_ASC_NODE", "ARG_OF_PERICENTER",
        "MEAN_ANOMALY", "BSTAR", "MEAN_MOTION_DOT", "MEAN_MOTION_DDOT",
    )
} | {"EPOCH": "epoch_at"}


# Kept beside the records, but no part of their content.
UNPUBLISHED = ("pos", "damage", "rule")


@dataclass(frozen=True)
class Dataset:
    """A fetched data set and the bounds it must keep."""

    name: str
    minimum_records: int = 1
    maximum_count_drop_fraction: float = 1.0


# The three fetched data sets.
SHIPPED_DATASETS = (
    Dataset("active", minimum_records=10_000, maximum_count_drop_fraction=0.20),
    Dataset("stations", minimum_records=1, maximum_count_drop_fraction=0.35),
    Dataset("special-decaying", minimum_records=1, maximum_count_drop_fraction=0.90),
)


@dataclass(frozen=True)
class Outcome:
    dataset: str
    result: str
    error: str | None
    record_count: int | None

    @property
    def published(self) -> bool:
        return self.result == "published"


class ElementJobs:
    """Gate, publish and derive; state rows say what happened.

    A data set that fails a gate keeps its published version and its last success.
    """

    def __init__(self, spark: SparkSession, root: str, *, keep: int = 3) -> None:
        self.spark = spark
        self.store = ReleaseStore(spark, root, keep=keep)
        self.state_path = f"{self.store.root}/state/elements"
        self.runs_path = f"{self.store.root}/state/element-runs"

    def states(self) -> DataFrame:
        return newest_rows(self.spark, self.state_path, STATE_SCHEMA, ["dataset"], "run_at")

    def state_of(self, dataset: str) -> dict:
        row = self.states().filter(F.col("dataset") == dataset).first()
        return row.asDict() if row else {"dataset": dataset}

    def _record(self, *states: dict) -> None:
        rows = [[state.get(name) for name in STATE_FIELDS] for state in states]
        append_rows(literal_rows(self.spark, rows, STATE_FIELDS), self.state_path)

    def runs(self) -> DataFrame:
        """Summaries of all runs so far."""

        return all_rows(self.spark, self.runs_path, RUN_SCHEMA)

    def run(
        self, landed: Sequence[tuple[Dataset, str]], rules: Sequence[Rule], at: datetime, *,
        requests: DataFrame | None = None, budget_bytes: int = 0,
    ) -> list[Outcome]:
        """Refresh what has landed, derive the subsets, and write one summary row of the run.

        ``requests`` is the log the files were fetched by (``ts, bytes, outcome``): its trailing day is the allowance
        used, and a refusal or a spent allowance at ``at`` is told in the summary.
        """

        fetched = [self.refresh(dataset, path, at) for dataset, path in landed]
        derived = self.derive(rules, at)
        rows = [(o.dataset, o.result, False) for o in fetched] + [(o.dataset, o.result, True) for o in derived]
        kinds = {"dataset": "string", "outcome": "string", "derived": "boolean"}
        outcomes = literal_rows(self.spark, rows, kinds) if rows else self.spark.createDataFrame([], "dataset string, outcome string, derived boolean")
        counts = run_counters(outcomes).first().asDict() | self._asked(requests, at)
        counts["budget_remaining_bytes"] = max(budget_bytes - counts["daily_bytes"], 0)
        found = {"checked_at": at, "budget_bytes": budget_bytes, **counts}
        append_rows(literal_rows(self.spark, [[found[name] for name in RUN_FIELDS]], RUN_FIELDS), self.runs_path)
        return fetched + derived

    @staticmethod
    def _asked(requests: DataFrame | None, at: datetime) -> dict:
        """What the request log says of a run: bytes of the trailing day, refusals, and what stopped it."""

        if requests is None:
            return {"daily_bytes": 0, "blocked": False, "budget_exhausted": False, "stop_reason": None}
        until = requests.filter(F.col("ts") <= F.lit(at))
        # The sum at the last instant, less what has left the window since.
        last = trailing_bytes(until.select("ts", "bytes").unionByName(
            requests.sparkSession.range(1).select(F.lit(at).cast(requests.schema["ts"].dataType).alias("ts"), F.lit(0).cast("bigint").alias("bytes"))))
        used = last.agg(F.max_by("used", "ts").alias("used")).first()["used"]
        now = until.filter(F.col("ts") == F.lit(at)).agg(
            F.max(F.when(F.col("outcome") == "forbidden", "forbidden")).alias("stop"),
            F.coalesce(F.bool_or(F.col("outcome") == "budget-skipped"), F.lit(False)).alias("spent")).first()
        return {"daily_bytes": used, "blocked": now["stop"] is not None, "budget_exhausted": now["spent"], "stop_reason": now["stop"]}

    def refresh(self, dataset: Dataset, path: str, at: datetime, *, landing: str | None = None) -> Outcome:
        """Publish a landed CSV snapshot if every gate passes.

        The text is parsed once, into a version nothing points to yet; the gates
        read that, and a refused version is removed. ``landing`` names the arrival: one that has a state row is not
        taken again, and what a lost attempt left of it is finished or removed first. Of two writers
        that work on one data set at once the second is refused.
        """

        known = self._landed(dataset, landing)
        if known is not None:
            return known
        seen = self.store.sequence(dataset.name)
        state = self.state_of(dataset.name) | {"run_at": at, "last_attempt": at, "landing": landing, "landed_path": path}
        version = f"{at.astimezone(UTC):%Y%m%dT%H%M%S%f}Z" + (f"-{landing}" if landing else "")
        pointed = False
        for earlier in self._attempts(dataset, landing):
            pointed = earlier == self.store.current(dataset.name)
            if pointed:
                version = earlier
            else:
                self.store.discard(dataset.name, earlier)
        try:
            records, faults = read_element_csv(self.spark, path)
            if not pointed:
                self.store.stage(dataset.name, version, {"records": records})
        except DamagedSource as exc:
            return self._refuse(dataset, state, str(exc))
        staged = self.spark.read.parquet(self.store.version_path(dataset.name, version, "records"))
        gate = None
        error = csv_gate(staged, faults)
        if error is None:
            checks = element_checks(staged, CHECKED_FIELDS)
            profiled = profile(staged, checks, key="norad_cat_id", position="pos", epoch="epoch_at")
            gate = element_gate(
                profiled,
                minimum=F.lit(dataset.minimum_records).cast("bigint"),
                previous=F.lit(state.get("record_count")).cast("bigint"),
                fraction=F.lit(dataset.maximum_count_drop_fraction),
            ).first()
            error = gate["error"]
        if error is not None:
            self.store.discard(dataset.name, version)
            return self._refuse(dataset, state, error)
        if not pointed:
            try:
                self.store.point(dataset.name, version, at, after=seen)
            except PublishError as exc:
                self.store.discard(dataset.name, version)
                return self._refuse(dataset, state, str(exc))
        self._record(state | self._published(staged, gate, at))
        self.store.prune(dataset.name)
        return Outcome(dataset.name, "published", None, gate["record_count"])

    def _landed(self, dataset: Dataset, landing: str | None) -> Outcome | None:
        """What an arrival came to, if it was taken before."""

        if landing is None:
            return None
        rows = all_rows(self.spark, self.state_path, STATE_SCHEMA)
        row = rows.filter((F.col("dataset") == dataset.name) & (F.col("landing") == landing)).orderBy(F.desc("run_at")).first()
        if row is None:
            return None
        count = row["record_count"] if row["last_result"] == "published" else None
        return Outcome(dataset.name, row["last_result"], row["error"], count)

    def _attempts(self, dataset: Dataset, landing: str | None) -> list[str]:
        return [v for v in self.store.listed(dataset.name) if v.endswith(f"-{landing}")] if landing else []

    def untaken(self, dataset: Dataset, paths: Sequence[str]) -> list[str]:
        """Those of some landed files that have no state row yet."""

        rows = all_rows(self.spark, self.state_path, STATE_SCHEMA).filter(F.col("dataset") == dataset.name)
        taken = {row["landed_path"] for row in rows.filter(F.col("landed_path").isin(list(paths))).select("landed_path").distinct().collect()}
        return [path for path in paths if path not in taken]

    def _refuse(self, dataset: Dataset, state: dict, error: str) -> Outcome:
        self._record(state | {"last_result": "validation-error", "error": error})
        return Outcome(dataset.name, "validation-error", error, None)

    def _published(self, members: DataFrame, gate, at: datetime) -> dict:
        return self._success(gate, members.agg(self._digest(members).alias("d")).first()["d"], at)

    @staticmethod
    def _digest(members: DataFrame) -> Column:
        return multiset_digest(canonical_json(*[F.col(name) for name in sorted(members.columns) if name not in UNPUBLISHED]))

    def _digests(self, members: DataFrame, rules: Sequence[Rule]) -> dict[str, str]:
        """The digest of each rule's members, all from one pass."""

        found = members.groupBy("rule").agg(self._digest(members).alias("d")).collect()
        return {row["rule"]: row["d"] for row in found}

    @staticmethod
    def _success(gate, digest: str, at: datetime) -> dict:
        return {
            "last_success": at, "last_result": "published", "error": None, "sha256": digest,
            "record_count": gate["record_count"],
            "earliest_epoch": gate["earliest_epoch"], "latest_epoch": gate["latest_epoch"],
        }

    def derive(self, rules: Sequence[Rule], at: datetime) -> list[Outcome]:
        """Bring every subset up to its source's current version.

        The rules of one source share one tagging pass for their gates and one for
        their write. A rule that fails leaves the others alone, and so does a source whose published version is
        missing, damaged or cut short; a rule list that must not be run is refused whole.
        """

        rule_ops.validate_rules(rules, list(dict.fromkeys(rule.source for rule in rules)))
        rule_ops.check_patterns(self.spark, rules)
        states = {row["dataset"]: row.asDict() for row in self.states().collect()}
        outcomes: list[Outcome] = []
        for source in dict.fromkeys(rule.source for rule in rules):
            success = states.get(source, {}).get("last_success")
            if success is None:
                continue
            own = [rule for rule in rules if rule.source == source]
            stale = [rule for rule in own if states.get(rule.name, {}).get("last_success") != success]
            current = [states[rule.name] for rule in own if rule not in stale]
            self._repair([state for state in current if any(state[name] is not None for name in REQUEST_FIELDS)], at)
            if stale:
                outcomes += self._derive_source(source, stale, states, success, at)
        return outcomes

    def _repair(self, states: list[dict], at: datetime) -> None:
        if states:
            self._record(*[state | dict.fromkeys(REQUEST_FIELDS) | {"run_at": at} for state in states])

    def _derive_source(self, source, stale, states, success, at) -> list[Outcome]:
        version = f"{success.astimezone(UTC):%Y%m%dT%H%M%S%f}Z-{at.astimezone(UTC):%Y%m%dT%H%M%S%f}Z"
        try:
            gates, passed, written = self._cut(source, stale, states, version)
        except (PySparkException, Py4JJavaError, PublishError) as exc:
            if version in self.store.listed(f"{source}.subsets"):
                self.store.discard(f"{source}.subsets", version)
            error = f"published version of {source} cannot be read: {str(exc).splitlines()[0]}"
            self._record(*[
                states.get(rule.name, {"dataset": rule.name}) | dict.fromkeys(REQUEST_FIELDS)
                | {"run_at": at, "last_result": "source-unreadable", "error": error} for rule in stale
            ])
            return [Outcome(rule.name, "source-unreadable", error, None) for rule in stale]
        outcomes, rows = [], []
        digests = self._digests(written, passed) if passed else {}
        for rule in stale:
            base = states.get(rule.name, {"dataset": rule.name}) | dict.fromkeys(REQUEST_FIELDS) | {"run_at": at}
            gate = gates[rule.name]
            if rule in passed:
                rows.append(base | self._success(gate, digests[rule.name], success) | {"last_attempt": success})
                self.store.point(rule.name, version, at)
                outcomes.append(Outcome(rule.name, "published", None, gate["record_count"]))
            else:
                rows.append(base | {"last_result": "validation-error", "error": gate["error"]})
                outcomes.append(Outcome(rule.name, "validation-error", gate["error"], None))
        self._record(*rows)
        if passed:
            self.store.prune_shared(f"{source}.subsets")
        return outcomes

    def _cut(self, source, stale, states, version) -> tuple[dict, list[Rule], DataFrame | None]:
        """Gates of the rules of a source, the rules that pass, and their members as written."""

        records = self.store.read(source, "records")
        previous = literal_rows(
            self.spark,
            [(rule.name, states.get(rule.name, {}).get("record_count")) for rule in stale],
            {"rule": "string", "previous_count": "bigint"},
        )
        checks = element_checks(records, CHECKED_FIELDS)
        # One row per configured rule.
        gates = {
            row["rule"]: row
            for row in rule_ops.gate_rules(
                records, stale, checks, key="norad_cat_id", position="pos", epoch="epoch_at", previous=previous
            ).collect()
        }
        passed = [rule for rule in stale if gates[rule.name]["accepted"]]
        written = None
        if passed:
            self.store.stage(
                f"{source}.subsets", version,
                {"members": lambda path: self._write_members(records, passed, path)},
            )
            written = self.spark.read.parquet(self.store.version_path(f"{source}.subsets", version, "members"))
        return gates, passed, written

    @staticmethod
    def _write_members(records: DataFrame, rules: Sequence[Rule], path: str) -> None:
        """A folder a rule; members are dealt out by rule, and adaptive execution splits the large ones."""

        tagged = rule_ops.tag_members(records, rules).hint("rebalance", "rule")
        tagged.write.partitionBy("rule").parquet(path)

    def members(self, rule: Rule) -> DataFrame:
        """The current members of a subset; only its own partition is read."""

        version = self.store.current(rule.name)
        path = self.store.version_path(f"{rule.source}.subsets", version, "members")
        return self.spark.read.parquet(path).filter(F.col("rule") == rule.name).drop("rule")
