"""Each pipeline stage on rows with null and repeated ids, ties, empty texts and clashing columns."""

import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, `_row` int, span_id string, row int, score double"
LONG = " ".join(f"word{i}" for i in range(60))
SPANS = {"EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "IP": r"[0-9]+(?:\.[0-9]+){3}"}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, "x", 3, 0.5) for i, t in rows], SCHEMA)


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


@pytest.fixture(scope="module")
def question(spark):
    return next(r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect() if len(r.text.split()) > 30)


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stage_of_no_rows(spark, name, stage):
    empty = frame(spark, [])
    found = stage(spark, empty, FOLDER)
    assert found.collect() == [] and (name == "pieces" or found.columns == empty.columns)


def test_join_keeps_the_first_of_each_group(spark):
    near = LONG.replace("word59", "other")
    rows = [(5, LONG), (3, near), (None, LONG), (3, "a text of its own"), (4, "a text of its own"), (None, "alone here now"), (7, ""), (7, ""), (8, None), (2, "x y")]
    assert pairs(pipeline.one_of_each_group(spark, frame(spark, rows), FOLDER)) == Counter(
        {(3, near): 1, (3, "a text of its own"): 1, (None, "alone here now"): 1, (7, ""): 2, (8, None): 1, (2, "x y"): 1})


def test_benchmark_rows_go_alone(spark, question):
    rows = [(1, f"before {question} after"), (1, "clean"), (None, question), (None, "clean too"), (2, "clean"), (2, "clean"), (3, None)]
    assert pairs(pipeline.without_benchmarks(spark, frame(spark, rows), FOLDER)) == Counter(
        {(1, "clean"): 1, (None, "clean too"): 1, (2, "clean"): 2, (3, None): 1})


def test_every_row_is_masked_by_itself(spark):
    rows = [(None, "mail a.b@c.org now"), (1, "text here with 10.0.0.1 inside"), (1, "b@c.de"), (1, "none"), (2, None), (3, ""), (3, "b@c.de")]
    found = pipeline.without_personal_data(spark, frame(spark, rows), FOLDER)
    expected = []
    for i, text in rows:
        for kind, pattern in SPANS.items():
            text = text and re.sub(pattern, f"<{kind}>", text)
        expected.append((i, text))
    assert pairs(found) == Counter(expected)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found.collect())


def test_quality_judges_rows_by_their_own_text(spark):
    from skyledger.llm import quality
    from skyledger.llm.common import numbered

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").limit(60).collect()]
    rows = [(None if i % 3 == 0 else i // 4, t) for i, t in enumerate(texts)] + [(None, None), (1, "")]
    frame_ = frame(spark, rows)
    network = quality.fit_quality(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), held_fold=None)
    original = quality.fit_quality
    quality.fit_quality = lambda *a, **k: network
    try:
        kept = pairs(pipeline.good_quality(spark, frame_, FOLDER))
    finally:
        quality.fit_quality = original
    scored, row = numbered(frame_)
    scores = {r.id: r.score for r in quality.score_quality(scored, network, row).collect()}
    assert kept == Counter((r.doc_id, r.text) for r in scored.collect() if scores[r[row]] >= pipeline.QUALITY_THRESHOLD)


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns and docs.count() <= before.count()
    whole = pipeline.run(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in whole) == sorted(r.doc_id for r in docs.select("doc_id").collect())
