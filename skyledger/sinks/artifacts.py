"""What a merged catalogue is published as."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.digest import canonical_json, content_digest, shard_digests, shard_of
from skyledger.operators.merge import ALWAYS_PRESENT, PRECEDENCE

MERGED_FIELDS = (*[field.name for field in PRECEDENCE], "stdMag", "magSource", "magBasis")


def splice_json(dense: Column, sparse: Column) -> Column:
    """One JSON object out of two; the second may be empty."""

    inner = F.substr(sparse, F.lit(2))
    head = F.left(dense, F.char_length(dense) - 1)
    return F.when(sparse == "{}", dense).otherwise(F.concat(head, F.lit(","), inner))


#: Numbers of this field are published as whole ones where they are whole, as the feed writes them.
WHOLE_WHERE_WHOLE = ("MEAN_MOTION_DDOT",)


def element_json(records: DataFrame) -> Column:
    """A record of an element set as published: the fields of ``records`` in their order, under the feed's names.

    Whole-number fields are whole numbers, others have a fraction, and texts are texts, nulls included. Columns that only say
    where a record stood, or what is wrong with it, do not belong in ``records``.
    """

    def cell(name: str) -> Column:
        value = F.col(name)
        if name.upper() in WHOLE_WHERE_WHOLE:
            whole = (value == F.floor(value)) & (F.abs(value) < F.lit(float(2**53)))
            return F.when(whole, value.cast("bigint").cast("variant")).otherwise(value.cast("variant")).alias(name.upper())
        return value.alias(name.upper())

    return canonical_json(*[cell(name) for name in records.columns])


def index_rows(merged: DataFrame) -> DataFrame:
    """The narrow index; ``magEst`` and ``dataStatus`` are null for most rows."""

    return merged.select(
        F.col("norad").cast("string").alias("norad"),
        "name", "objectType", "country", "opsStatus", "rcsSize", "stdMag",
        F.when(F.col("magSource") == "estimate", 1).alias("magEst"),
        F.nullif("dataStatus", F.lit("")).alias("dataStatus"),
    )


def index_json(index: DataFrame) -> Column:
    """An index row as JSON: seven fields always, the sparse pair only when set."""

    dense = canonical_json(*[F.col(n) for n in index.columns if n not in ("magEst", "dataStatus")])
    return splice_json(dense, F.to_json(F.struct("magEst", "dataStatus")))


def record_json() -> Column:
    """A full record: null fields are left out, apart from the three that say something by it."""

    dense = canonical_json(F.col("norad").cast("string").alias("norad"), *[F.col(name) for name in ALWAYS_PRESENT])
    others = [F.col(name) for name in MERGED_FIELDS if name not in ALWAYS_PRESENT]
    return splice_json(dense, F.to_json(F.struct(*others, F.col("sources").alias("_sources"))))


def canonical_record() -> Column:
    """All published fields of a merged record in fixed order, nulls and provenance included."""

    entries = F.sort_array(F.map_entries("sources"))  # in generated code, which array_sort is not
    return canonical_json(F.col("norad"), *[F.col(n) for n in MERGED_FIELDS], entries.alias("sources"))


def record_shards(merged: DataFrame) -> DataFrame:
    """Records as JSON with the shard they are served from."""

    return merged.select(shard_of(F.col("norad")).alias("bucket"), "norad", record_json().alias("record"))


def catalogue_digest(merged: DataFrame) -> DataFrame:
    """Digest and number of shards of a merged catalogue, free of timestamps."""

    return content_digest(shard_digests(merged, "norad", canonical_record()))


def write_shards(merged: DataFrame, shards: DataFrame, path: str) -> None:
    """One folder per shard and digest, for the given ``bucket, digest`` only.

    A folder that is there from a lost attempt is written anew; every other one keeps its files. A
    shard has at most 1000 records, so none is oversized.
    """

    records = record_shards(merged).join(shards.select("bucket", "digest"), "bucket")
    dealt = records.repartition("bucket").sortWithinPartitions("bucket", "norad")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "digest").json(path)


def read_shards(spark: SparkSession, path: str, shards: DataFrame) -> DataFrame:
    """``norad, record, bucket, digest`` of the given ``bucket, digest``."""

    rows = spark.read.schema("norad bigint, record string, bucket bigint, digest string").json(path)
    return rows.join(shards.select("bucket", "digest"), ["bucket", "digest"], "left_semi")


def write_index(merged: DataFrame, path: str) -> None:
    """The index in numeric order, range-partitioned so that it scales with the catalogue."""

    ordered = merged.repartitionByRange("norad").sortWithinPartitions("norad")
    index = index_rows(ordered)
    index.select(index_json(index).alias("value")).write.mode("errorifexists").text(path)
