"""A corpus pipeline of five stages over ``documents``.

Every stage but the last returns the columns of ``documents``. Texts are whole throughout,
and each stage reads all that the one before it kept. Stages tell rows apart by a number of their own and not by
``doc_id``: rows with a null or repeated id are judged, kept and masked each by its own text. A null
text passes through as an empty one; repeated rows stay as often as they occur, except that the join keeps one row of a
group of linked texts. Further columns are kept whatever their names. Without rows each stage returns none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import contamination, jaccard, pieces, pii, quality
from skyledger.llm.common import numbered, table
from skyledger.llm.models import piece_model
from skyledger.session import materialize

#: Documents less likely than this to be good go. Half is where the classes balance; clean ones stay.
QUALITY_THRESHOLD = 0.5


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out what the network rejects; it learns from all labelled documents."""

    network = quality.fit_quality(docs, table(spark, sf_dir, "labels"), held_fold=None)
    rows, row = numbered(docs)
    return _without(rows, row, quality.score_quality(rows, network, row).filter(F.col("score") < QUALITY_THRESHOLD))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of each group of linked sets; a null id is larger than any other."""

    rows, row = numbered(docs)
    groups = jaccard.jaccard_components(rows, row).select("id", "component_id")
    named = rows.select(F.col(row).alias("id"), F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.col(row).alias("row")).alias("place"))
    first = groups.join(named, "id").groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.row").alias("id"))
    return rows.join(first, rows[row] == first["id"], "left_semi").drop(row)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that hold a passage of the benchmark."""

    rows, row = numbered(docs)
    found = contamination.find_passages(rows, table(spark, sf_dir, "benchmark"), row)
    return _without(rows, row, found.filter(F.size("hit_words") > 0))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace each personal span by its kind."""

    rows, row = numbered(docs)
    clean = pii.masked(rows, pii.find_personal_data(rows, row), row).drop(row)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document, with digests of the ids and of the decoded text."""

    return pieces.piece_digests(pieces.encode_pieces(docs, piece_model()))


def _without(rows: DataFrame, row: str, rejected: DataFrame) -> DataFrame:
    return rows.join(rejected.select("id"), rows[row] == rejected["id"], "left_anti").drop(row)


STAGES = [
    ("quality", good_quality),
    ("jaccard_join", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("personal_data", without_personal_data),
    ("pieces", as_pieces),
]
#: The network and the votes can't be said in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
