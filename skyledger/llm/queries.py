"""The operators over their whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import (
    chat, contamination, jaccard, licenses, neighbours, pieces, pii, quality, resampling, sharding, spelling, warc, weighting,
)
from skyledger.llm.common import fold_of, table
from skyledger.llm.models import piece_model


def op1_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under word counts and under the context trees."""

    return weighting.score_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op2_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled rows of two folds in three."""

    docs = table(spark, sf_dir, "documents")
    network = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, network).select(
        F.col("id").alias("doc_id"), (fold_of(F.col("id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_license_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""

    return licenses.find_licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_sentencepiece_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, spans and decoded text of every document, as counts and digests."""

    return pieces.piece_digests(pieces.encode_pieces(table(spark, sf_dir, "documents"), piece_model()))


def op5_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: strict spans, and those that the votes add."""

    return pii.personal_digests(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op6_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that holds the template's own control strings, formatted and read back."""

    clash = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(clash)
    return chat.chat_digests(chat.format_conversations(rows))


def op7_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles overlap by nine tenths."""

    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""

    found = contamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return contamination.passage_digests(found)


def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""

    folder = warc.archive_folder(spark)
    archives = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""

    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op11_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of near equal size."""

    placed = sharding.document_shards(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op12_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frequent words of all documents, each with the form it is a variant of."""

    return spelling.spelling_forms(spelling.count_words(table(spark, sf_dir, "documents")))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight towards the benchmark, and the tenth that is drawn."""

    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (
    op1_context_tree_weighting, op2_byte_network, op3_license_windows,
    op4_sentencepiece_offsets, op5_pii_weak_supervision, op6_chat_round_trip, op7_signature_trees, op8_benchmark_passages, op9_warc_archives,
    op10_learned_partitions, op11_kd_shards, op12_spelling_forms, op13_importance_resampling,
)}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES = {
    "op6_chat_round_trip": r"""
        with t as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
            union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        m as (
            select *, (length(role) - length(replace(role, '\', '')) + length(text) - length(replace(text, '\', ''))
                       + len(regexp_extract_all(role, '</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '</?s>|\[/?INST\]')))
                      as marks from t)
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
            cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
            sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), ''))
                as loss_sha256,
            cast(sum(length(role) + length(text) + marks + 22) as bigint) as formatted_chars, true as round_trip
        from m group by conv_id""",
    "op7_signature_trees": rf"""
        with recursive words as (
            select row_number() over () as r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as w
            from documents),
        shingled as (
            select r, doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
                else list_distinct(list_transform(range(1, len(w) - 1), lambda s: array_to_string(list_slice(w, s, s + 2), ' ')))
                end as s from words),
        sets as (select md5(array_to_string(list_sort(s), '|')) as k, min(doc_id) as doc_id, any_value(s) as s, len(any_value(s)) as n
                 from shingled where len(s) > 0 group by 1),
        members as (select k, n, unnest(s) as x from sets),
        shared as (select a.k as a, b.k as b, a.n as na, b.n as nb, count(*) as i from members a join members b
                   on a.x = b.x and a.k < b.k and 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) group by all),
        links as (select a, b from shared where 100 * i >= 90 * (na + nb - i)),
        sides as (select a, b from links union all select b, a from links union all select k, k from sets),
        reach(a, b) as (select a, b from sides union select reach.a, sides.b from reach join sides on reach.b = sides.a),
        named as (select a as k, min(doc_id) as component_id from reach join sets on b = k group by a)
        select doc_id, len(s) as n_shingles, coalesce(component_id, doc_id) as component_id
        from shingled left join named on k = md5(array_to_string(list_sort(s), '|')) and len(s) > 0""",
    "op8_benchmark_passages": rf"""
        with words as (
            select row_number() over () as r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents),
        items as (
            select item_id,
                regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from benchmark),
        wins as (
            select distinct item_id, least(len(w), 10) as n, list_slice(w, s, s + least(len(w), 10) - 1) as p
            from (select item_id, w, unnest(range(1, greatest(2, len(w) - 8))) as s from items where len(w) > 0)),
        grams as (
            select r, s, n, list_slice(w, s, s + n - 1) as p
            from (select r, w, n, unnest(range(1, len(w) - n + 2)) as s
                  from words, (select distinct n from wins) where len(w) >= n)),
        hits as (select r, s, grams.n, item_id from grams join wins on grams.p = wins.p),
        marked as (select r, count(distinct k) as n_hit from (select r, unnest(range(s, s + n)) as k from hits) group by r),
        named as (
            select r, count(*) as n_items, string_agg(i, ',' order by i) as names
            from (select distinct r, cast(item_id as varchar) as i from hits) group by r)
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
            sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from words left join marked using (r) left join named using (r)""",
    "op9_warc_archives": f"""
        with p as (select page_id, coalesce(html, '') as payload from pages),
        g as (select payload, max(page_id) as kept, sha1(payload) as h from p group by payload)
        select page_id, strlen(payload) as payload_bytes,
            list_reduce(list_transform(range(0, 32), lambda i: substr('{BASE32}',
                ((cast('0x' || substr(h, 5 * (i // 4) + 1, 5) as bigint) >> (15 - 5 * (i % 4))) & 31) + 1, 1)),
                lambda a, b: a || b) as payload_digest,
            case when page_id = kept then 'response' else 'revisit' end as record_type,
            case when page_id = kept then null else kept end as refers_to
        from p join g using (payload)""",
}
