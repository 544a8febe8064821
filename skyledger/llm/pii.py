"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them.

1. *Candidates.* Strict patterns (email, ip, card, phone) and looser ones (near misses,
   national numbers, phone numbers without a country code, names after a cue) mark spans.
2. *Votes.* Five labelers (pattern, checksum or shape, gazetteer, context words, outline)
   vote yes, no or nothing on every candidate.
3. *Reliabilities.* Candidates are counted by kind and vote pattern (a bounded table,
   whatever the input); expectation-maximisation over that table estimates how often each
   labeler is right and the share of true spans of each kind.
4. *Classifier.* The resulting probabilities train a naive Bayes classifier on features of
   the span itself. It decides on the loose candidates; strict matches always stay.

All row work is DataFrame functions. Positions come from the text between matches, summed
by a window over the candidates of a row; offsets are code points, ends exclusive.

Null and empty texts have no spans; repeated rows are told apart by a row number that is
written once; ties in position are ordered by kind. Without any candidate every list is empty.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import free_name, ids_and_texts
from skyledger.session import materialize

#: Strict kinds first; the order breaks ties of position. The patterns of the strict kinds
#: find the same spans as the plain ones: a match can start only where a run of its first
#: characters starts or the last match ended, and what is repeated is never given back.
STRICT = ("email", "ip", "card", "phone")
LOOSE = ("near_card", "national_id", "loose_phone", "name")
KINDS = STRICT + LOOSE
CUES = r"(?:[Mm]y name is|[Mm]e llamo|[Jj]e m'appelle|[Ii]ch heiße|Mrs?\.|Dr\.|Herr|Frau|Madame|Monsieur|Señora?)"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])(?<![0-9][\x20-])(?>[0-9](?:[\x20-]?[0-9]){11,18}+)(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "loose_phone": r"(?<![0-9+(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "name": rf"(?<={CUES}\x20)\p{{Lu}}\p{{L}}{{1,30}}(?:\x20\p{{Lu}}\p{{L}}{{1,30}})?",
}
#: A text without a match of the guard has no match of the pattern.
GUARDS = {
    "email": "@", "phone": r"\+[0-9]", "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "national_id": r"[0-9]-[0-9]{2}-[0-9]", "loose_phone": r"[0-9]{3}[\x20.-][0-9]{4}", "name": CUES,
}
CONTEXT = 40
YES_WORDS = r"(?i)\b(?:e-?mail|mail|contact|kontakt|call|phone|tel|telefon|téléphone|teléfono|mobile|fax|card|visa|karte|" \
            r"carte|tarjeta|ip|host|server|address|ssn|name|nombre|nom)\b"
NO_WORDS = r"(?i)\b(?:version|release|isbn|issn|order|invoice|page|section|chapter|figure|table|build|rev)\b"
#: Gazetteers: common endings of domains, country calling codes, first digits of card issuers, given names.
DOMAIN_ENDS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at", "be")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49",
                 "52", "54", "55", "61", "81", "86", "91")
CARD_STARTS = ("34", "37", "4", "51", "52", "53", "54", "55", "6")
GIVEN_NAMES = ("Anna", "Ana", "Carlos", "Claire", "David", "Emma", "Hans", "Jean", "John", "José", "Julia", "Karl", "Laura",
               "Luis", "Maria", "María", "Marie", "Mary", "Michael", "Paul", "Peter", "Pierre", "Robert", "Sarah", "Thomas")
LABELERS = ("pattern", "shape", "gazetteer", "context", "outline")
ROUNDS = 30
THRESHOLD = 0.5


def _marks(text: Column, kind: str, hits: Column) -> Column:
    """Candidates of one kind in order, each with the length of the text since the last one."""

    gaps = F.split(text, PATTERNS[kind], -1)
    return F.when(F.size(hits) > 0, F.transform(F.arrays_zip(
        hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"),
        F.slice(gaps, F.lit(2), F.size(hits)).alias("next"),
    ), lambda m, i: F.struct(
        F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"), m["hit"].alias("hit"),
        F.length(m["gap"]).alias("gap"), F.right(m["gap"], F.lit(CONTEXT)).alias("before"), F.left(m["next"], F.lit(1)).alias("after"),
    )))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, marks): the candidate spans of each text, read from the text once and written."""

    rows = ids_and_texts(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    found = rows.select("row", "id", "text", *[
        F.when(F.col("text").rlike(GUARDS[kind]), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(kind)
        for kind, pattern in PATTERNS.items()])
    none = F.array().cast("array<struct<kind:int,i:int,hit:string,gap:int,before:string,after:string>>")
    marks = [F.coalesce(_marks(F.col("text"), kind, F.col(kind)), none) for kind in PATTERNS]
    return materialize(found.select("row", "id", F.concat(*marks).alias("marks")), "candidates")


def spans_of(found: DataFrame) -> DataFrame:
    """One row for each candidate with its place and its digits; failing strict matches become near misses or go."""

    order = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = found.select("row", F.inline("marks"))
    placed = each.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(order)).withColumn(
        "start", F.col("end") - F.length("hit")).withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
    digits, parts = F.length("digits"), F.split("hit", r"\.")
    # Parts may be longer than any number type: leading zeros aside, three digits decide.
    small = F.forall(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    holds = (
        F.when(F.col("kind") == KINDS.index("ip"), small)
        .when(F.col("kind") == KINDS.index("card"), F.call_function("luhn_check", F.col("digits")))
        .when(F.col("kind") == KINDS.index("phone"), digits.between(9, 15)).otherwise(True)
    )
    kept = placed.withColumn("holds", holds)
    near = (F.col("kind") == KINDS.index("card")) & ~F.col("holds")
    return kept.filter(F.col("holds") | near).select(
        "row", F.when(near, KINDS.index("near_card")).otherwise(F.col("kind")).alias("kind"), "start", "end", "hit", "digits",
        "before", "after").withColumn("strict", F.col("kind") < len(STRICT))


def _is(kind: str) -> Column:
    return F.col("kind") == KINDS.index(kind)


def votes() -> list[Column]:
    """What each labeler says of a candidate: 1 yes, 0 no, -1 nothing."""

    said = lambda yes, no: F.when(yes, 1).when(no, 0).otherwise(-1)
    hit, digits = F.col("hit"), F.col("digits")
    domain_end = F.lower(F.element_at(F.split(hit, r"\."), -1))
    starts = lambda column, given: F.lit(False) if not given else column.rlike("^(?:" + "|".join(given) + ")")
    shape = (
        F.when(_is("email"), said(domain_end.rlike("^[a-z]{2,}$"), domain_end.rlike("[0-9]")))
        .when(_is("ip"), said(hit.rlike("[0-9]{2}"), ~hit.rlike("[0-9]{2}")))
        .when(_is("card"), F.lit(1)).when(_is("near_card"), F.lit(0))
        .when(_is("phone") | _is("loose_phone"), said(F.length(digits).between(10, 13), F.length(digits) > 13))
        .when(_is("national_id"), said(~digits.rlike("^(?:000|666|9)"), digits.rlike("^(?:000|666|9)")))
        .otherwise(-1)
    )
    gazetteer = (
        F.when(_is("email"), said(domain_end.isin(*DOMAIN_ENDS), F.lit(False)))
        .when(_is("ip"), said(~starts(hit, (r"0\.", r"127\.", r"255\.")), starts(hit, (r"0\.", r"127\.", r"255\."))))
        .when(_is("card") | _is("near_card"), said(starts(digits, CARD_STARTS), ~starts(digits, CARD_STARTS)))
        .when(_is("phone"), said(starts(digits, CALLING_CODES), ~starts(digits, CALLING_CODES)))
        .when(_is("name"), said(F.split(hit, " ")[0].isin(*GIVEN_NAMES), F.lit(False))).otherwise(-1)
    )
    context = said(F.col("before").rlike(YES_WORDS), F.col("before").rlike(NO_WORDS))
    apart = ~F.right("before", F.lit(1)).rlike(r"[\p{L}\p{N}_]") & ~F.col("after").rlike(r"[\p{L}\p{N}_]")
    return [c.alias(name) for c, name in zip(
        (F.col("strict").cast("int"), shape, gazetteer, context, said(apart, ~apart)), LABELERS)]


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = ROUNDS) -> dict[tuple[int, tuple[int, ...]], float]:
    """Expectation-maximisation over counted vote patterns: the probability that a span with them is true.

    ``patterns`` holds (kind, votes, count). Starting from the share of yes votes, each round
    estimates the share of true spans by kind and, for each labeler, how often it says yes to
    true and to false spans; then the probability of each pattern anew. Counts are smoothed.
    """

    belief = {}
    for kind, given, _ in patterns:
        cast = [v for v in given if v >= 0]
        belief[kind, given] = (sum(cast) + 0.5) / (len(cast) + 1)
    for _ in range(rounds):
        true, total = defaultdict(float), defaultdict(float)
        yes = defaultdict(float)
        cast = defaultdict(float)
        for kind, given, count in patterns:
            p = belief[kind, given]
            true[kind] += count * p
            total[kind] += count
            for who, vote in enumerate(given):
                if vote >= 0:
                    for truth, weight in ((1, p * count), (0, (1 - p) * count)):
                        cast[who, truth] += weight
                        yes[who, truth] += weight * vote
        for kind, given, _ in patterns:
            share = (true[kind] + 1) / (total[kind] + 2)
            odds = math.log(share / (1 - share))
            for who, vote in enumerate(given):
                if vote >= 0:
                    # Labelers are taken to be better than chance, which keeps the classes in place.
                    said = [(yes[who, truth] + (4 if truth else 1)) / (cast[who, truth] + 5) for truth in (0, 1)]
                    odds += math.log(said[1] / said[0]) if vote else math.log((1 - said[1]) / (1 - said[0]))
            belief[kind, given] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def features() -> Column:
    """The numbers of a span's features: kind, length, share of digits, and the characters around it."""

    length = F.least(F.length("hit"), F.lit(40))
    share = F.floor(10 * F.length("digits") / F.greatest(F.length("hit"), F.lit(1)))
    side = lambda c: F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"\p{L}"), 2).when(c.rlike(r"\p{N}"), 3).otherwise(4)
    return F.array(
        F.col("kind"), 10 + length, 60 + share.cast("int"), 80 + side(F.right("before", F.lit(1))), 90 + side(F.col("after")),
    )


FEATURES = 100


def classify(spans: DataFrame) -> DataFrame:
    """Candidates with the final probability ``p`` and whether they stay."""

    voted = spans.withColumn("votes", F.array(*votes())).withColumn("features", features())
    counted = voted.groupBy("kind", "votes").count().collect()  # kinds x 3 ^ labelers rows at most
    belief = reliabilities([(r["kind"], tuple(r["votes"]), r["count"]) for r in counted])
    if not belief:
        return spans.withColumn("p", F.lit(1.0)).withColumn("stays", F.col("strict"))
    soft = F.create_map(*[F.lit(v) for (kind, given), p in sorted(belief.items())
                          for v in (",".join(map(str, (kind, *given))), p)])
    key = F.concat_ws(",", F.col("kind").cast("string"), F.col("votes").cast("array<string>"))
    likely = voted.withColumn("soft", F.element_at(soft, key))
    learned = likely.select("soft", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("soft").alias("true"), F.sum(1 - F.col("soft")).alias("false")).collect()  # FEATURES rows at most
    of_kind = [r for r in learned if r["feature"] < len(KINDS)]
    true, false = sum(r["true"] for r in of_kind) + 1, sum(r["false"] for r in of_kind) + 1
    weights = [0.0] * FEATURES
    for r in learned:
        weights[r["feature"]] = math.log((r["true"] + 0.5) / true) - math.log((r["false"] + 0.5) / false)
    table = F.array(*[F.lit(w) for w in weights])
    odds = F.aggregate(F.transform("features", lambda f: F.element_at(table, f + 1)), F.lit(math.log(true / false)), lambda a, b: a + b)
    return likely.withColumn("p", 1 / (1 + F.exp(-odds))).withColumn("stays", F.col("strict") | (F.col("p") >= THRESHOLD))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, spans): spans are structs (start, kind, end, name, strict), by start and kind."""

    found = candidates(docs, id_col, text_col)
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = classify(spans_of(found)).filter("stays").select("row", F.struct(
        "start", "kind", "end", F.element_at(names, F.col("kind") + 1).alias("name"), "strict").alias("span"))
    # A row's spans are bounded by its text.
    lists = kept.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    empty = F.array().cast(lists.schema["spans"].dataType)
    return found.select("row", "id").join(lists, "row", "left").select("row", "id", F.coalesce("spans", empty).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_digests(found: DataFrame) -> DataFrame:
    """Counts of strict spans by kind, the digest of their places, and all spans as text."""

    count = lambda kind: F.size(F.filter("spans", lambda s: s["name"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"), *[count(kind) for kind in STRICT],
        F.sha2(_joined(F.filter("spans", lambda s: s["strict"])), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans give way to the earlier.

    ``id_col`` has to tell rows apart (:func:`skyledger.llm.common.numbered` gives such a column): spans are places in
    one row's text and fit no other. A row whose id ``found`` does not have keeps its text. Columns of ``docs`` may have any names.
    """

    key, spans, walked = (free_name(name, docs.columns) for name in ("span_id", "spans", "walked"))
    chosen = found.filter(F.size("spans") > 0).select(F.col("id").alias(key), F.col("spans").alias(spans))
    joined = docs.join(chosen, F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left")
    original = F.col(f"`{text_col}`")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def put(done: Column, span: Column) -> Column:
        taken = F.substring(original, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        return F.when(span["start"] < done["at"], done).otherwise(F.struct(
            span["end"].alias("at"), F.concat(done["out"], taken, F.lit("<"), F.upper(span["name"]), F.lit(">")).alias("out")))

    tail = F.substr(original, (F.col(f"{walked}.at") + 1).cast("int"))
    text = F.when(F.col(spans).isNull(), original).otherwise(F.concat(F.col(f"{walked}.out"), tail))
    done = joined.withColumn(walked, F.aggregate(spans, start, put))
    return done.select(*[(text.alias(c) if c == text_col else F.col(f"`{c}`")) for c in docs.columns])
