"""Declarative subset rules over a published dataset."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.gates import element_gate
from skyledger.operators.literals import literal_rows
from skyledger.operators.quality import Check, profile


#: Rules up to this number are conditions in the plan itself.
LITERAL_RULES = 64


class RuleError(ValueError):
    """A rule list that must not be run."""


@dataclass(frozen=True)
class Rule:
    """A subset of ``source``: every predicate that is set must hold."""

    name: str
    source: str
    pattern: str | None = None
    minimum_mean_motion: float | None = None
    maximum_mean_motion: float | None = None
    minimum_records: int = 1
    maximum_count_drop_fraction: float = 1.0


# The ten shipped subsets.
SHIPPED_RULES = (
    Rule("starlink", "active", pattern="^STARLINK", minimum_records=5000, maximum_count_drop_fraction=0.20),
    Rule("oneweb", "active", pattern="^ONEWEB", minimum_records=100, maximum_count_drop_fraction=0.35),
    Rule("kuiper", "active", pattern="^KUIPER", minimum_records=50, maximum_count_drop_fraction=0.50),
    Rule("qianfan", "active", pattern="^QIANFAN", minimum_records=50, maximum_count_drop_fraction=0.50),
    Rule("hulianwang", "active", pattern="^(HULIANWANG|GUOWANG)", minimum_records=50,
         maximum_count_drop_fraction=0.50),
    Rule("gps-ops", "active", pattern="^NAVSTAR", minimum_records=20, maximum_count_drop_fraction=0.35),
    Rule("galileo", "active", pattern=r"^GSAT\d{4}", minimum_records=20, maximum_count_drop_fraction=0.35),
    Rule("glo-ops", "active", pattern="GLONASS", minimum_records=15, maximum_count_drop_fraction=0.35),
    Rule("beidou", "active", pattern="^BEIDOU", minimum_records=20, maximum_count_drop_fraction=0.35),
    Rule("geo", "active", minimum_mean_motion=0.95, maximum_mean_motion=1.05, minimum_records=200,
         maximum_count_drop_fraction=0.35),
)


def validate_rules(rules: Sequence[Rule], sources: Sequence[str]) -> None:
    """Reject a rule list that could publish under a taken name or select everything."""

    taken: set[str] = set()
    for name in [*sources, *[rule.name for rule in rules]]:
        if not re.fullmatch(r"[a-z0-9]+(-[a-z0-9]+)*", name):
            raise RuleError(f"{name!r}: only lowercase letters, numbers and hyphens")
        if name in taken:
            raise RuleError(f"duplicate dataset name: {name}")
        taken.add(name)
    for rule in rules:
        _validate_rule(rule, sources)


def _validate_rule(rule: Rule, sources: Sequence[str]) -> None:
    low, high = rule.minimum_mean_motion, rule.maximum_mean_motion
    if rule.source not in sources:
        raise RuleError(f"{rule.name}: unknown source {rule.source}")
    if rule.pattern is None and low is None and high is None:
        raise RuleError(f"{rule.name}: needs a pattern or a mean-motion bound")
    if rule.pattern is not None:
        if not rule.pattern.strip():
            raise RuleError(f"{rule.name}: empty pattern")
        try:
            re.compile(rule.pattern)
        except re.error as exc:
            raise RuleError(f"{rule.name}: bad pattern: {exc}") from exc
    for bound in (low, high):
        if bound is not None and not 0 < bound < 20:
            raise RuleError(f"{rule.name}: mean-motion bounds must lie between 0 and 20")
    if low is not None and high is not None and low > high:
        raise RuleError(f"{rule.name}: minimum above maximum")
    if isinstance(rule.minimum_records, bool) or rule.minimum_records < 1:
        raise RuleError(f"{rule.name}: minimum_records must be positive")
    if not 0 <= rule.maximum_count_drop_fraction <= 1:
        raise RuleError(f"{rule.name}: maximum_count_drop_fraction must be between 0 and 1")


def check_patterns(spark: SparkSession, rules: Sequence[Rule]) -> None:
    """Reject patterns that the engine running them cannot read."""

    compiled = spark._jvm.java.util.regex.Pattern
    for rule in rules:
        if rule.pattern is not None:
            try:
                compiled.compile(rule.pattern)
            except (PySparkException, Py4JJavaError) as exc:
                raise RuleError(f"{rule.name}: bad pattern: {rule.pattern}") from exc


def predicate(rule: Rule, name: Column, mean_motion: Column) -> Column:
    """The rule as a filter. Plain prefixes become ``startswith``, which a scan can push down."""

    tests: list[Column] = []
    if rule.pattern is not None:
        plain = re.fullmatch(r"(\^?)([A-Za-z0-9 _-]+)", rule.pattern)
        if plain is None:
            tests.append(name.rlike(rule.pattern))
        elif plain[1]:
            tests.append(name.startswith(plain[2]))
        else:
            tests.append(name.contains(plain[2]))
    if rule.minimum_mean_motion is not None:
        tests.append(mean_motion >= rule.minimum_mean_motion)
    if rule.maximum_mean_motion is not None:
        tests.append(mean_motion <= rule.maximum_mean_motion)
    combined = tests[0]
    for test in tests[1:]:
        combined = combined & test
    return combined


def matched_rules(rules: Sequence[Rule], name: str = "object_name", mean_motion: str = "mean_motion") -> Column:
    """Names of all rules a record belongs to."""

    tags = [F.when(predicate(rule, F.col(name), F.col(mean_motion)), rule.name) for rule in rules]
    return F.array_compact(F.array(*tags))


def tag_members(df: DataFrame, rules: Sequence[Rule], **columns: str) -> DataFrame:
    """One row per record and rule it belongs to, from a single scan of the source.

    A few rules are literal conditions of one expression. Beyond that records look rules up by an index.
    """

    if len(rules) > LITERAL_RULES:
        from skyledger.operators.rule_index import tag_members_indexed

        return tag_members_indexed(df, rules, **columns)
    return df.withColumn("rule", F.explode(matched_rules(rules, **columns)))


def rule_bounds(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rule list as a table; its size is that of the configuration."""

    rows = [(rule.name, rule.source, rule.minimum_records, rule.maximum_count_drop_fraction) for rule in rules]
    schema = {"rule": "string", "source": "string", "minimum_records": "bigint", "drop_fraction": "double"}
    if len(rows) > LITERAL_RULES:
        return spark.createDataFrame(rows, ", ".join(f"{name} {kind}" for name, kind in schema.items()))
    return literal_rows(spark, rows, schema)


def gate_rules(
    df: DataFrame, rules: Sequence[Rule], checks: Sequence[Check], *, key: str, position: str,
    epoch: str, previous: DataFrame | None = None, unique: bool = False,
) -> DataFrame:
    """One verdict per rule, rules without members included, from one tagging pass.

    ``previous`` holds ``(rule, previous_count)`` of the last published members; ``unique`` says that no key repeats.
    """

    members = profile(
        tag_members(df, rules), checks, key=key, position=position, epoch=epoch, keys=["rule"], unique=unique
    )
    rows = rule_bounds(df.sparkSession, rules).join(members, "rule", "left")
    rows = rows.withColumn("record_count", F.coalesce("record_count", F.lit(0).cast("bigint")))
    if previous is not None:
        rows = rows.join(previous, "rule", "left")
    else:
        rows = rows.withColumn("previous_count", F.lit(None).cast("bigint"))
    return element_gate(
        rows, minimum=F.col("minimum_records"), previous=F.col("previous_count"), fraction=F.col("drop_fraction")
    )
