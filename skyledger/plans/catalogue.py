"""Refresh of the merged catalogue and its sky files."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.digest import canonical_json, content_digest, multiset_digest, shard_changes, shard_digests
from skyledger.operators.gates import merge_gate, source_floor_gate
from skyledger.operators.literals import literal_rows
from skyledger.operators.merge import merge_catalogues, merge_metrics, within_decay_window
from skyledger.operators.state import last_good_sources
from skyledger.session import materialize
from skyledger.sinks.artifacts import canonical_record, read_shards, write_index, write_shards
from skyledger.sinks.release import PublishError, ReleaseStore, release_id
from skyledger.sinks.tables import all_rows, append_rows, delete, newest_rows, table_exists
from skyledger.sources.catalogues import read_gcat, read_magnitudes, read_satcat, source_rows
from skyledger.sources.files import DamagedSource
from skyledger.sources.sky import MAXIMUM_MAGNITUDE, by_magnitude, figure_documents, read_figures, read_stars

STREAM = "catalog"
STATUS_FIELDS = {
    "job": "string", "checked_at": "timestamp", "successful": "boolean", "changed": "boolean",
    "result": "string", "release": "string", "record_count": "bigint", "error": "string",
}
STATUS_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in STATUS_FIELDS.items())
#: One row a source, in the manifest of a release and in the status of every run.
SOURCE_FIELDS = {
    "source": "string", "ok": "boolean", "vendored": "boolean", "fetched_at": "timestamp", "from_cache": "boolean",
    "stale": "boolean", "error": "string", "rows": "bigint",
}
SOURCE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in SOURCE_FIELDS.items())
SHARD_SCHEMA = "bucket bigint, digest string, members bigint"


@dataclass(frozen=True)
class CataloguePaths:
    """Where the sources lie; the two fetched ones may be chosen from a table of snapshots instead."""

    magnitudes: str
    stars: str
    star_names: str
    figures: str
    satcat: str | None = None
    gcat: str | None = None


@dataclass(frozen=True)
class CatalogueLimits:
    """The shipped floors and shares."""

    satcat: int = 20_000
    magnitudes: int = 3_000
    stars: int = 800
    figures: int = 80
    gcat_join_fraction: float = 0.40
    record_drop_fraction: float = 0.20


@dataclass(frozen=True)
class CatalogueOutcome:
    successful: bool
    changed: bool
    result: str
    release: str | None = None
    record_count: int | None = None
    error: str | None = None


class CatalogueJob:
    def __init__(self, spark: SparkSession, root: str, *, limits: CatalogueLimits | None = None, keep: int = 3) -> None:
        self.spark, self.limits = spark, limits or CatalogueLimits()
        self.store = ReleaseStore(spark, root, keep=keep)
        self.status_path = f"{self.store.root}/state/catalogue"
        self.sources_path = f"{self.store.root}/state/catalogue-sources"
        self.shards_path = f"{self.store.root}/shards"

    def status(self) -> DataFrame:
        return newest_rows(self.spark, self.status_path, STATUS_SCHEMA, ["job"], "checked_at")

    def source_status(self) -> DataFrame:
        """How each source was served in every run: ``checked_at`` and the manifest's columns."""

        return all_rows(self.spark, self.sources_path, f"checked_at timestamp, {SOURCE_SCHEMA}")

    def run(self, paths: CataloguePaths, at: datetime, *, snapshots: DataFrame | None = None) -> CatalogueOutcome:
        """Merge, gate and publish; an unchanged or refused result keeps the old release.

        ``snapshots`` (source, ts, status, body_path, error) are the attempts to fetch ``satcat`` and ``gcat``: each is taken from
        its newest good body at or before ``at``, stale or not. A source that has none fails the run.
        """

        sources: list[dict] = []
        try:
            served = self._served(snapshots, at)
            sources += served.values()
            for name, row in served.items():
                if not row["usable"]:
                    raise DamagedSource(f"{name}: no good body so far ({row['error'] or 'never fetched'})")
            paths = replace(paths, **{name: row["body_path"] for name, row in served.items()})
            outcome = self._update(paths, at, sources)
        except (DamagedSource, PublishError) as exc:
            outcome = CatalogueOutcome(False, False, "failed", error=str(exc))
        if sources:
            rows = [[at, *[row.get(name) for name in SOURCE_FIELDS]] for row in sources]
            append_rows(literal_rows(self.spark, rows, {"checked_at": "timestamp", **SOURCE_FIELDS}), self.sources_path)
        row = [STREAM, at, outcome.successful, outcome.changed, outcome.result, outcome.release,
               outcome.record_count, outcome.error]
        append_rows(literal_rows(self.spark, [row], STATUS_FIELDS), self.status_path)
        return outcome

    @staticmethod
    def _served(snapshots: DataFrame | None, at: datetime) -> dict[str, dict]:
        """One row a fetched source."""

        if snapshots is None:
            return {}
        found = last_good_sources(snapshots.filter(F.col("ts") <= F.lit(at)).filter(F.col("source").isin("satcat", "gcat")))
        rows = {row["source"]: row.asDict() | {"ok": row["usable"], "vendored": False} for row in found.collect()}
        missing = {"usable": False, "ok": False, "vendored": False, "error": None, "body_path": None}
        return {name: rows.get(name, {"source": name, **missing}) for name in ("satcat", "gcat")}

    def _previous(self) -> dict:
        if self.store.current(STREAM) is None:
            return {}
        return self.store.read(STREAM, "manifest").first().asDict()

    def _update(self, paths: CataloguePaths, at: datetime, sources: list[dict]) -> CatalogueOutcome:
        seen = self.store.sequence(STREAM)
        satcat = read_satcat(self.spark, paths.satcat)
        gcat = read_gcat(self.spark, paths.gcat)
        magnitudes = read_magnitudes(self.spark, paths.magnitudes)
        stars = materialize(by_magnitude(read_stars(self.spark, paths.stars, paths.star_names)), "stars")
        figures = materialize(read_figures(self.spark, paths.figures), "figures")

        merged = materialize(merge_catalogues(satcat, gcat, magnitudes), "merged")

        figure_ids = figures.select("id").distinct()
        counts = source_rows(SATCAT=merged, GCAT=gcat, magnitude=magnitudes, star=stars, constellation=figure_ids)
        rows = {row["source"]: row["rows"] for row in counts.collect()}
        self._count_sources(sources, rows, at)
        floors = source_floor_gate(
            literal_rows(self.spark, list(rows.items()), {"source": "string", "rows": "bigint"}),
            literal_rows(
                self.spark,
                [("SATCAT", self.limits.satcat), ("magnitude", self.limits.magnitudes),
                 ("star", self.limits.stars), ("constellation", self.limits.figures)],
                {"source": "string", "minimum": "bigint"},
            ),
        )
        error = floors.agg(F.min("error").alias("error")).first()["error"]
        if error is not None:
            return CatalogueOutcome(False, False, "failed", error=error)

        previous = self._previous()
        metrics = merge_gate(
            merge_metrics(merged, at.date()),
            minimum_join_fraction=self.limits.gcat_join_fraction,
            previous=F.lit(previous.get("records")).cast("bigint"),
            maximum_drop=self.limits.record_drop_fraction,
        ).first()
        if not metrics["accepted"]:
            return CatalogueOutcome(False, False, "failed", error=metrics["error"])

        kept = within_decay_window(merged, at.date())
        shards = materialize(shard_digests(kept, "norad", canonical_record()), "shards")
        digest = self._digest(shards, stars, figures)
        if previous.get("content_sha256") == digest["content_sha256"]:
            return CatalogueOutcome(True, False, "unchanged", record_count=metrics["records"])
        version = release_id(at, digest["content_sha256"])
        known = self._known_shards()
        write_shards(kept, shards.join(known, ["bucket", "digest"], "left_anti"), self.shards_path)
        changes = materialize(shard_changes(self._current_shards(), shards), "changes")
        named = changes.agg(*[F.count_if(F.col("change") == kind).alias(f"shards_{kind}") for kind in ("added", "changed", "removed")]).first()
        self.store.stage(STREAM, version, {
            "records": kept,
            "index": lambda path: write_index(kept, path),
            "shards": shards,
            "shard_changes": changes,
            "stars": stars.withColumn("maxMag", F.lit(MAXIMUM_MAGNITUDE)),
            "constellations": figure_documents(figures),
            "sources": literal_rows(self.spark, [[row.get(name) for name in SOURCE_FIELDS] for row in sources], SOURCE_FIELDS),
            "manifest": self._manifest(at, metrics, digest, rows, named.asDict()),
        })
        try:
            self.store.point(STREAM, version, at, after=seen)
        except PublishError:
            self.store.discard(STREAM, version)
            raise
        self._prune()
        return CatalogueOutcome(True, True, "published", version, metrics["records"])

    def enrichment(self) -> DataFrame:
        """The records of the current release as JSON, by shard."""

        return read_shards(self.spark, self.shards_path, self.store.read(STREAM, "shards"))

    def _current_shards(self) -> DataFrame:
        if self.store.current(STREAM) is None:
            return self.spark.createDataFrame([], SHARD_SCHEMA)
        return self.store.read(STREAM, "shards")

    def _shards_of(self, versions: list[str]) -> DataFrame:
        paths = [self.store.version_path(STREAM, version, "shards") for version in versions]
        paths = [path for path in paths if table_exists(self.spark, path)]
        none = self.spark.createDataFrame([], SHARD_SCHEMA)
        return self.spark.read.schema(SHARD_SCHEMA).parquet(*paths) if paths else none

    def _known_shards(self) -> DataFrame:
        """Shards that some release on storage has; a lost run's shards are in none, so they are written again."""

        return self._shards_of([row["version"] for row in self.store.versions(STREAM).collect()])

    def _prune(self) -> None:
        """Drop old releases, and the shards that only they had."""

        going = self.store.to_prune(STREAM)
        staying = [version for version in self.store.listed(STREAM) if version not in going]
        orphans = self._shards_of(going).join(self._shards_of(staying), ["bucket", "digest"], "left_anti")
        folders = [f"{self.shards_path}/bucket={row['bucket']}/digest={row['digest']}" for row in orphans.select("bucket", "digest").distinct().collect()]
        self.store.prune(STREAM)
        for folder in folders:
            delete(self.spark, folder)

    @staticmethod
    def _count_sources(sources: list[dict], rows: Mapping[str, int], at: datetime) -> None:
        """Complete the source rows: counts, and the sources that are files of this job."""

        by_name = {row["source"]: row for row in sources}
        for source, counted in (("satcat", "SATCAT"), ("gcat", "GCAT"), ("magnitudes", "magnitude"), ("stars", "star"), ("figures", "constellation")):
            if source in by_name:
                by_name[source]["rows"] = rows[counted]
            else:
                sources.append({"source": source, "ok": True, "vendored": True, "from_cache": False, "stale": False, "rows": rows[counted]})

    @staticmethod
    def _digest(shards: DataFrame, stars: DataFrame, figures: DataFrame) -> dict:
        """Records, stars and figures together; no timestamp goes in."""

        star = canonical_json(*[F.col(name) for name in ("hr", "name", "bayer", "ra", "dec", "mag")])
        figure = canonical_json(*[F.col(name) for name in ("id", "pos", "line", "points")])
        records = content_digest(shards).first()
        parts = [
            records["content_sha256"],
            stars.agg(multiset_digest(star).alias("d")).first()["d"],
            figures.agg(multiset_digest(figure).alias("d")).first()["d"],
        ]
        return {"content_sha256": hashlib.sha256("".join(parts).encode()).hexdigest(), "buckets": records["buckets"]}

    def _manifest(self, at: datetime, metrics, digest: dict, rows: dict[str, int], changes: dict[str, int]) -> DataFrame:
        counts = {name: metrics[name] for name in ("records", "with_gcat", "with_mag", "with_mag_est", "dropped_decayed")}
        fields = {"schema_version": "int", "generated_at": "timestamp", "content_sha256": "string", "buckets": "bigint"}
        fields |= {name: "bigint" for name in (*counts, *changes)} | {f"rows_{name.lower()}": "bigint" for name in rows}
        row = [1, at, digest["content_sha256"], digest["buckets"], *counts.values(), *changes.values(), *rows.values()]
        return literal_rows(self.spark, [row], fields)
