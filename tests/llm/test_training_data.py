"""The training-data queries against plain versions, and their edge cases on small tables."""

import hashlib
import math
import re
import zlib

import pytest
import sentencepiece

from registry.check import compare, connect
from skyledger.llm import chat, contamination, jaccard, licenses, neighbours, pieces, pii, queries, weighting
from skyledger.llm.models import piece_model

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
EDGE = "doc_id long, text string, id long, size int, word string"
EDGE_ROWS = [
    (1, None, 7, 1, "a"), (2, "", 7, None, None), (3, "one", 7, 1, "a"), (None, "a null id", 7, 1, "a"),
    (4, "Mail a.b@c.org or +41 44 668 18 00 at 10.0.0.1 " * 2, 7, 1, "a"), (5, "one", 7, 1, "a"), (5, "one", 7, 1, "a"),
    (6, "w " * 40000, 7, 1, "a"), (7, "naïve ﬁ 　 日本 \U0001f600", 7, 1, "a"),
]


@pytest.fixture(scope="module")
def documents(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER).sql(queries.ORACLES[name])) is None


def test_pieces_equal_the_library(spark, documents):
    model = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rows = queries.QUERIES["op4_sentencepiece_offsets"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    for r in rows:
        ids = model.encode(documents[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_spans(text):
    def digits(m):
        return re.sub("[^0-9]", "", m)

    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", "[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return [(m.start(), k, kind, m.end()) for k, (kind, pattern, sound) in enumerate(kinds)
            for m in re.finditer(pattern, text) if sound(m[0])]


def test_base_spans_equal_plain_patterns(spark, documents):
    for r in queries.QUERIES["op5_pii_weak_supervision"](spark, FOLDER).collect():
        spans = sorted(base_spans(documents[r.doc_id]))
        named = [f"{kind}:{start}:{end}" for start, _, kind, end in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r.spans.split(",")) or not named
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[1] == k for s in spans) for k in range(4))


def test_scores_hold_the_base(spark, documents):
    tokens = {i: WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t)) + [None] for i, t in documents.items()}
    counts = {}
    for i, words in tokens.items():
        if zlib.crc32(str(i).encode()) % 10:
            for w in words:
                counts[w] = counts.get(w, 0) + 1
    total, distinct = sum(counts.values()), len(counts)
    rows = queries.QUERIES["op1_context_tree_weighting"](spark, FOLDER).collect()
    assert len(rows) == len(documents)
    for r in rows:
        words = tokens[r.doc_id]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (distinct + 1))) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(w in counts for w in words), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_quality_on_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").collect()}
    rows = queries.QUERIES["op2_byte_network"](spark, FOLDER).collect()
    held = [r for r in rows if r.held_out and labels.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.6


def test_search_recall(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()}
    rows = queries.QUERIES["op10_learned_partitions"](spark, FOLDER).collect()
    found = {(r.query_id, r.vec_id) for r in rows}
    wanted = set()
    for q in (v for v in vectors if v % 20 == 0):
        score = {v: sum(float(a) * float(b) for a, b in zip(vectors[q], x)) for v, x in vectors.items() if v != q}
        wanted |= {(q, v) for v in sorted(score, key=lambda v: (-score[v], v))[:20]}
    assert len(found & wanted) / len(wanted) >= 0.9


OPERATORS = {
    "weighting": weighting.score_texts, "licenses": licenses.find_licenses, "jaccard": jaccard.jaccard_components,
    "pieces": lambda d: pieces.piece_digests(pieces.encode_pieces(d, piece_model())),
    "pii": lambda d: pii.personal_digests(pii.find_personal_data(d)),
    "passages": lambda d: contamination.find_passages(d, d.selectExpr("'q' as item_id", "text").filter("text like 'Mail%'")),
}


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "passages" and n != "licenses"])
@pytest.mark.parametrize("rows", [EDGE_ROWS, []], ids=["edges", "empty"])
def test_one_row_a_document(spark, name, rows):
    assert len(OPERATORS[name](spark.createDataFrame(rows, EDGE)).collect()) == len(rows)


@pytest.mark.parametrize("rows", [EDGE_ROWS, []], ids=["edges", "empty"])
def test_no_license_in_plain_rows(spark, rows):
    assert licenses.find_licenses(spark.createDataFrame(rows, EDGE)).collect() == []


def test_chat_of_no_rows_and_of_controls(spark):
    schema = "conv_id long, turn int, role string, text string"
    assert chat.chat_digests(chat.format_conversations(spark.createDataFrame([], schema))).collect() == []
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", None), (2, 0, "assistant", "</s>")]
    got = {r.conv_id: r for r in chat.chat_digests(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\n</s>[INST] ok [/INST]\nassistant\n\n").hexdigest()
    assert (got[1].loss_chars, got[2].loss_chars) == (0, 4)


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [1.0, 1.0]), (6, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, lambda v: v % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 5), (0, 2, 6)]


def test_pipeline_keeps_clean_documents(spark, documents):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    kept = {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert kept and kept <= set(documents)
