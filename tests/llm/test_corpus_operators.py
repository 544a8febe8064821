"""Shards, spelling variants and resampling against plain versions, and their edge cases on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import pytest
import xxhash
from pyspark.sql import functions as F

from skyledger.llm import queries, resampling, sharding, spelling
from skyledger.session import shared_dir

FOLDER = "/root/testdata/sf0.001"
EDGE = "doc_id long, text string, id long, row int, word string, n long, size int, g long, segment int, score long, lang string, source string"
SAME = (7, 7, "w", 3, 1, 1, 1, 1, "en", None)
EDGE_ROWS = [
    (1, None, *SAME), (2, "", *SAME), (None, "a null id of a text", *SAME), (3, "colour colour colour colours colours colours", *SAME),
    (4, "tie tie " * 30, *SAME), (4, "tie tie " * 30, *SAME), (4, "tie tie " * 30, *SAME), (5, "Wort" * 30000 + " " + "word " * 9000, *SAME),
    (6, "Élève élève çà und naïve \U0001f600", *SAME), (9223372036854775807, "max", *SAME),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").collect()


@pytest.fixture(scope="module")
def benchmark_texts(spark):
    return [r.text or "" for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]


def ascii_lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


# --- shards ------------------------------------------------------------------------------------


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def plain_tree(points, axes, ranges, first, leaves):
    """points: (group, bytes, coordinates) -> {group: shard}."""

    if leaves == 1:
        return {p[0]: first for p in points}
    widths = [(max(p[2][a] for p in points) - min(p[2][a] for p in points)) / ranges[a] if ranges[a] else 0.0 for a in range(axes)]
    axis = widths.index(max(widths))
    total, run, sides = sum(p[1] for p in points), 0, ([], [])
    for p in sorted(points, key=lambda p: (p[2][axis], p[0])):
        run += p[1]
        sides[(run - p[1] / 2) / total > (leaves // 2) / leaves].append(p)
    found = plain_tree(sides[0], axes, ranges, first, leaves // 2) if sides[0] else {}
    return found | (plain_tree(sides[1], axes, ranges, first + leaves // 2, leaves - leaves // 2) if sides[1] else {})


@pytest.mark.parametrize("shards", [1, 2, 5, 8])
def test_shards_equal_a_plain_tree(spark, documents, shards):
    groups = {}
    for r in documents:
        text = (r.text or "").encode()
        place = (math.log2(len(text) + 1), zlib.crc32(r.lang.encode()) / 2**32, zlib.crc32((r.source or "").encode()) / 2**32)
        bytes_, least = groups.get(text, (0, place))
        groups[text] = (bytes_ + len(text) + 1, tuple(map(min, least, place)))
    points = [(signed(xxhash.xxh64_intdigest(t, 42)), b, p) for t, (b, p) in groups.items()]
    ranges = [max(p[2][a] for p in points) - min(p[2][a] for p in points) for a in range(3)]
    expected = plain_tree(points, 3, ranges, 0, shards)
    found = sharding.kd_shards(
        spark.read.parquet(f"{FOLDER}/documents.parquet"),
        {"length": F.log2(F.octet_length("text") + 1), "lang": sharding.category(F.col("lang")), "source": sharding.category(F.col("source"))},
        shards=shards, whole_share=1e9).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in documents}
    assert {r.id: r.shard for r in found} == {i: expected[signed(xxhash.xxh64_intdigest(t, 42))] for i, t in texts.items()}


def shards_are_sound(rows, count):
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert {r.shard for r in rows} <= set(range(count))
    return [sum(r.size for r in rows if r.shard == s) for s in range(count)]


def test_shards_of_documents(spark, documents):
    rows = queries.QUERIES["op11_kd_shards"](spark, FOLDER).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in documents}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((i, len(t) + 1, zlib.crc32(t)) for i, t in texts.items())
    sizes = shards_are_sound(rows, 8)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)


def test_a_group_of_most_rows_is_parted_evenly(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.concat(F.lit("t"), F.lpad("id", 4, "0"))).alias("text"),
        F.lit("en").alias("lang"), F.lit("s").alias("source"))
    found = sharding.document_shards(rows, 8).collect()
    sizes = shards_are_sound(found, 8)
    assert max(sizes) / min(sizes) < 1.02


def test_shards_of_few_rows_write_few_files(spark):
    rows = spark.range(300, numPartitions=2).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text"), "id").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    few = sorted(map(tuple, sharding.document_shards(rows, 8).collect()))
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {key: spark.conf.get(key) for key in settings}
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        assert sorted(map(tuple, sharding.document_shards(rows, 8).collect())) == few
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    written = [len([*path.glob("part-*")]) for path in set(folder.iterdir()) - before]
    assert len(written) >= 8 and max(written) <= 2


def test_shards_by_target_size(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lpad("id", 99, "x").alias("text"))
    found = sharding.kd_shards(rows, {}, target_bytes=30_000).collect()
    assert max(shards_are_sound(found, 4)) <= 25_100
    with pytest.raises(ValueError):
        sharding.kd_shards(rows, {})


@pytest.mark.parametrize("rows", [EDGE_ROWS, []], ids=["edges", "empty"])
def test_shards_of_edge_rows(spark, rows):
    found = sharding.document_shards(spark.createDataFrame(rows, EDGE), 3).collect()
    assert len(found) == len(rows)
    shards_are_sound(found, 3)
    texts = Counter((r[0], len((r[1] or "").encode()) + 1) for r in rows)
    assert Counter((r.id, r.size) for r in found) == texts


def test_unusable_coordinates_count_as_zero(spark):
    places = [None, float("nan"), float("inf"), 0.0, 5.0, -5.0]
    rows = spark.createDataFrame([(i, f"abc{i}", x) for i, x in enumerate(places)], "doc_id long, text string, x double")
    found = {r.id: r.shard for r in sharding.kd_shards(rows, {"x": F.col("x")}, shards=2, whole_share=1.0).collect()}
    assert (found[5], found[4]) == (0, 1) and Counter(found.values()) == {0: 3, 1: 3}


# --- spelling ----------------------------------------------------------------------------------


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(word, letters):
    for i in range(len(word) + 1):
        if i < len(word):
            yield word[:i] + word[i + 1:]
        for c in letters:
            yield word[:i] + c + word[i:]
            if i < len(word):
                yield word[:i] + c + word[i + 1:]


def plain_forms(counts):
    letters, forms = {c for w in counts for c in w}, {}
    for word, n in counts.items():
        near = {w for w in one_apart(word, letters) if w != word and w in counts}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        forms[word] = (best if best and counts[best] >= 2 * n else None, len(near))
    out = set()
    for word, (form, n_near) in forms.items():
        root = word
        while forms[root][0]:
            root = forms[root][0]
        out.add((word, form, root, counts[word], n_near, counts[form] if form else None))
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_forms_equal_a_plain_search(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op12_spelling_forms"](spark, folder)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = found.collect()
    assert len(found) == len({r.word for r in found})
    assert {tuple(r) for r in found} == plain_forms(plain_words(rows))


def test_every_edit_is_found_at_every_place(spark):
    words = {}
    for length in (5, 6, 7, 8, 9, 11, 16, 23):
        base = ("abcdefghijklmnopqrstuvwxyz" * 2)[length:2 * length]
        for w in [base, "a" * length, *[base[:i] + base[i + 1:] for i in range(length)], *[base[:i] + "ÿ" + base[i:] for i in range(length + 1)],
                  *[base[:i] + "é" + base[i + 1:] for i in range(length)], "a" * (length + 1)]:
            if len(w) >= 5:
                words[w] = 3 + len(words)
    found = spelling.near_pairs(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    letters = {c for w in words for c in w}
    expected = {frozenset((w, v)) for w in words for v in one_apart(w, letters) if v != w and v in words}
    assert {frozenset((r.a, r.b)) for r in found} == expected and len(found) == len(expected)
    assert all(r.n_a == words[r.a] and r.n_b == words[r.b] for r in found)


def test_roots_at_the_end_of_long_ways_and_ties(spark):
    chain = [("a" * (5 + i), 3 * 2**i) for i in range(12)] + [("zebra", 5), ("zebre", 10), ("zebri", 10)]
    found = {r.word: r for r in spelling.spelling_forms(spark.createDataFrame(chain, "word string, n long")).collect()}
    assert {tuple(r) for r in found.values()} == plain_forms(dict(chain))
    assert found["aaaaa"].root == "a" * 16 and found["zebra"].form == "zebre" and found["zebri"].form is None


@pytest.mark.parametrize("rows", [EDGE_ROWS, []], ids=["edges", "empty"])
def test_words_of_edge_rows(spark, rows):
    frame = spark.createDataFrame(rows, EDGE)
    found = {tuple(r) for r in spelling.spelling_forms(spelling.count_words(frame)).collect()}
    assert found == plain_forms(plain_words([(r[0], r[1]) for r in rows]))


def test_very_long_words(spark):
    long = "ab" * 20000
    found = spelling.spelling_forms(spark.createDataFrame([(long, 9), (long + "c", 3), ("x" + long[1:], 4)], "word string, n long"))
    assert {(len(r.word), r.n, r.n_near, r.form == long) for r in found.collect()} == {(40000, 9, 2, False), (40001, 3, 1, True), (40000, 4, 1, True)}


# --- resampling --------------------------------------------------------------------------------


def plain_words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text or ""))


def plain_sample(rows, targets, runs=1, percent=10, least=20):
    def grams(text):
        words = plain_words_of(text)
        return [" ".join(words[i:i + k]) for k in range(1, runs + 1) for i in range(len(words) - k + 1)]

    def counts(texts):
        return Counter(zlib.crc32(g.encode()) % 10000 for t in texts for g in grams(t))

    s, t = counts(text for _, text in rows), counts(targets)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    out = []
    for doc_id, text in rows:
        found = [gain[zlib.crc32(g.encode()) % 10000] for g in grams(text)]
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(found) // len(found) if found else 0
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words_of(text)) >= least])
    drawn = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    ranks = {id(r): i for i, r in enumerate(drawn[:len(drawn) * percent // 100], 1)}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_sample_equals_a_plain_one(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = queries.QUERIES["op13_importance_resampling"](spark, folder)
    assert [d for _, d in found.dtypes] == ["bigint"] * 5
    assert Counter(map(tuple, found.collect())) == plain_sample(rows, targets)


@pytest.mark.parametrize("runs,percent", [(1, 100), (2, 50), (3, 0)])
def test_sample_of_edge_rows(spark, runs, percent):
    found = resampling.resample(spark.createDataFrame(EDGE_ROWS, EDGE), spark.createDataFrame([(1, "a word of a tie"), (2, None)], "item long, text string"),
                                runs=runs, percent=percent, least_words=3).collect()
    assert Counter(map(tuple, found)) == plain_sample([(r[0], r[1]) for r in EDGE_ROWS], ["a word of a tie", None], runs, percent, 3)


def test_sample_of_nothing(spark):
    nothing = spark.createDataFrame([], EDGE)
    assert resampling.resample(nothing, nothing).collect() == []
    some = resampling.resample(spark.createDataFrame(EDGE_ROWS, EDGE), nothing, percent=100).collect()
    assert Counter(map(tuple, some)) == plain_sample([(r[0], r[1]) for r in EDGE_ROWS], [], 1, 100)


def test_segments_split_equal_scores(spark):
    rows = spark.range(5000, numPartitions=7).select(F.col("id").alias("row"), F.lit(1).cast("long").alias("id"), (F.col("id") % 3 % 2).alias("score"))
    found = resampling.highest(rows, 4000, 5000).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 4001))
    assert max(r["rank"] for r in found if r.score == 1) == sum(r.score == 1 for r in found)
