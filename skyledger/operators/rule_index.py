"""Many rules over one table: each record meets only the rules that can hold for it.

A rule is looked up by what it needs literally: the start of the name, a text inside the name, or the part of the
scale its mean motion lies in. A record asks for those of its own by equality, so the plan has one join whatever the
number of rules, and what it finds is tested in full. Rules with a pattern that needs no literal text
are few in practice; they stay literal conditions on every record.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.rules import Rule, matched_rules

_LITERAL = re.compile(r"[A-Za-z0-9 _-]+")
#: Quantifiers under which the character before them may be absent.
_OPTIONAL = "*?{"
#: The scale of mean motions is halved so often; a rule's interval is a few of the resulting nodes.
LEVELS, SCALE_END = 12, 20.0
#: A list of this many entries is sent to every task; longer ones are joined by shuffling.
BROADCAST_ENTRIES = 200_000
ENTRY_SCHEMA = "_key string, rule string, _pattern string, _earlier array<string>, _low double, _high double"


def literal_starts(pattern: str) -> tuple[list[str], bool] | None:
    """Texts one of which a name must start with, and whether that is all the pattern asks; None if there are none."""

    if not pattern.startswith("^"):
        return None
    group = re.match(r"\^\(([A-Za-z0-9 _-]+(?:\|[A-Za-z0-9 _-]+)*)\)(?![*?{])", pattern)
    if group:
        rest = pattern[group.end():]
        return (group[1].split("|"), rest == "") if "|" not in rest else None
    if "|" in pattern:
        return None
    found = _LITERAL.match(pattern, 1)
    if found is None:
        return None
    text, rest = found[0], pattern[found.end():]
    if rest[:1] and rest[0] in _OPTIONAL:
        text = text[:-1]
    return ([text], rest == "") if text else None


def nodes_of(low: float | None, high: float | None) -> list[str]:
    """The fewest nodes of the halved scale that cover an interval, which may overlap it at both ends."""

    last = (1 << LEVELS) - 1
    first = cell_of(low) if low is not None else 0
    stop = cell_of(high) if high is not None else last
    found, level = [], 0
    while first <= stop:
        if first % 2:
            found.append(f"m{level}:{first}")
            first += 1
        if stop % 2 == 0:
            found.append(f"m{level}:{stop}")
            stop -= 1
        first, stop, level = first // 2, stop // 2, level + 1
    return found


def cell_of(value: float) -> int:
    last = (1 << LEVELS) - 1
    return min(last, max(0, int(value / SCALE_END * (1 << LEVELS))))


def entries_of(rule: Rule) -> Iterator[tuple] | None:
    """What a rule is found by, a row each; None for a rule that has nothing to be found by."""

    bounds = (rule.minimum_mean_motion, rule.maximum_mean_motion)
    if rule.pattern is not None:
        starts = literal_starts(rule.pattern)
        if starts is not None:
            texts, whole = starts
            texts = list(dict.fromkeys(texts))
            # A name that has two of the starts is found once, by the first of them.
            return ((f"p{t}", rule.name, None if whole else rule.pattern, [f"p{x}" for x in texts[:i]], *bounds) for i, t in enumerate(texts))
        if _LITERAL.fullmatch(rule.pattern):
            return iter([(f"s{rule.pattern}", rule.name, None, [], *bounds)])
    if bounds != (None, None):
        return ((node, rule.name, rule.pattern, [], *bounds) for node in nodes_of(*bounds))
    return None


def tag_members_indexed(
    df: DataFrame, rules: Sequence[Rule], *, name: str = "object_name", mean_motion: str = "mean_motion",
) -> DataFrame:
    """One row per record and rule it belongs to, as :func:`skyledger.operators.rules.tag_members` gives.

    A record without a name, or without a mean motion, belongs to no rule that looks at it.
    """

    found = {rule.name: entries_of(rule) for rule in rules}
    entries = [entry for rows in found.values() if rows is not None for entry in rows]
    plain = [rule for rule in rules if found[rule.name] is None]
    columns = [F.col(f"`{c}`") for c in df.columns]
    parts = []
    if entries:
        table = df.sparkSession.createDataFrame(entries, ENTRY_SCHEMA)
        table = F.broadcast(table) if len(entries) <= BROADCAST_ENTRIES else table
        keys = _asked(F.col(name), F.col(mean_motion), {entry[0][0]: set() for entry in entries} | _lengths(entries))
        met = df.withColumn("_keys", F.array_distinct(keys)).withColumn("_key", F.explode("_keys")).join(table, "_key")
        text, motion = F.col(name), F.col(mean_motion).cast("double")
        holds = (
            (F.col("_pattern").isNull() | F.rlike(text, F.col("_pattern")))
            & ~F.arrays_overlap("_earlier", "_keys")
            & (F.col("_low").isNull() | (motion >= F.col("_low"))) & (F.col("_high").isNull() | (motion <= F.col("_high"))))
        parts.append(met.filter(holds).select(*columns, "rule"))
    if plain or not entries:
        tags = matched_rules(plain, name, mean_motion) if plain else F.array().cast("array<string>")
        parts.append(df.withColumn("rule", F.explode(tags)).select(*columns, "rule"))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0]


def _lengths(entries: Sequence[tuple]) -> dict[str, set[int]]:
    """The lengths of literal texts by kind, and the levels of nodes."""

    found: dict[str, set[int]] = {}
    for entry in entries:
        key = entry[0]
        found.setdefault(key[0], set()).add(int(key[1:key.index(":")]) if key[0] == "m" else len(key) - 1)
    return found


def _asked(name: Column, motion: Column, lengths: dict[str, set[int]]) -> Column:
    """The keys under which a record's rules lie: its starts, its inner texts and its nodes, of the lengths that occur."""

    def numbers(kind: str) -> Column:
        return F.array(*[F.lit(n) for n in sorted(lengths.get(kind, ()))]).cast("array<int>")

    size = F.char_length(name)
    starts = F.transform(F.filter(numbers("p"), lambda n: n <= size), lambda n: F.concat(F.lit("p"), F.left(name, n)))
    inner = F.flatten(F.transform(
        F.filter(numbers("s"), lambda n: n <= size),
        lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda at: F.concat(F.lit("s"), F.substring(name, at, n)))))
    scaled = F.floor(motion.cast("double") / F.lit(SCALE_END) * F.lit(float(1 << LEVELS)))
    cell = F.greatest(F.lit(0), F.least(F.lit((1 << LEVELS) - 1), scaled.cast("int")))
    nodes = F.transform(numbers("m"), lambda level: F.concat(
        F.lit("m"), level.cast("string"), F.lit(":"), F.floor(cell / F.pow(F.lit(2.0), level)).cast("string")))
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(starts, none), F.coalesce(inner, none), F.when(motion.isNotNull(), nodes).otherwise(none))
