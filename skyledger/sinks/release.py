"""Immutable versions, a pointer to the current one, and retention."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators.retention import prune_list
from skyledger.sinks.tables import delete, names_in, put_if_absent, read_small, table_exists

_SAFE_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_POINTER = re.compile(r"[0-9]{12}\.json")


class PublishError(RuntimeError):
    """A version that cannot be published safely."""


def release_id(at: datetime, content_sha256: str) -> str:
    """A version name that sorts by time and tells its content."""

    return f"{at.astimezone(UTC):%Y%m%dT%H%M%SZ}-{content_sha256[:8]}"


class ReleaseStore:
    """Versions under ``<root>/releases/<stream>/<version>/<part>``.

    A version is written whole before a pointer file names it, so readers see the old version or
    the new one. Object stores need no rename for that. Pointers of a stream are numbered files that
    are never overwritten; the highest number counts.
    """

    def __init__(self, spark: SparkSession, root: str, *, keep: int = 3) -> None:
        if keep < 2:
            raise ValueError("at least two versions must be kept")
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self.pointers = f"{self.root}/pointers"

    def version_path(self, stream: str, version: str, part: str | None = None) -> str:
        for value in (stream, version, *([part] if part else [])):
            if not _SAFE_NAME.fullmatch(value):
                raise PublishError(f"unsafe name: {value!r}")
        return "/".join([self.root, "releases", stream, version, *([part] if part else [])])

    def stage(self, stream: str, version: str, parts: dict[str, DataFrame | Callable[[str], None]]) -> None:
        """Write every part of a new version; a version that exists already is refused."""

        if table_exists(self.spark, self.version_path(stream, version)):
            raise PublishError(f"release already exists: {version}")
        for part, content in parts.items():
            path = self.version_path(stream, version, part)
            if callable(content):
                content(path)
            else:
                content.write.mode("errorifexists").parquet(path)

    def discard(self, stream: str, version: str) -> None:
        """Remove a version that was staged and is not to be published."""

        if version == self.current(stream):
            raise PublishError(f"release is current: {version}")
        self._delete(stream, version)

    def _delete(self, stream: str, version: str) -> None:
        delete(self.spark, self.version_path(stream, version))

    def sequence(self, stream: str) -> int:
        """How often the stream was pointed; take it before work starts and hand it to :meth:`point`."""

        return max(self._numbers(stream), default=0)

    def point(self, stream: str, version: str, at: datetime, *, after: int | None = None) -> None:
        """Make a staged version the current one.

        ``after`` is the sequence this work was built on. The pointer's name is the next number, and only one writer can
        create it: whoever comes second is refused and may start again from what is current then.
        """

        last = self.sequence(stream)
        if after is not None and last != after:
            raise PublishError(f"{stream} was pointed elsewhere meanwhile")
        said = {"stream": stream, "version": version, "published_at": at.astimezone(UTC).isoformat()}
        if not put_if_absent(self.spark, self._pointer(stream, last + 1), json.dumps(said)):
            raise PublishError(f"{stream} was pointed elsewhere meanwhile")

    def _pointer(self, stream: str, number: int) -> str:
        if not _SAFE_NAME.fullmatch(stream):
            raise PublishError(f"unsafe name: {stream!r}")
        return f"{self.pointers}/{stream}/{number:012d}.json"

    def _numbers(self, stream: str) -> list[int]:
        names = names_in(self.spark, f"{self.pointers}/{stream}", folders=False)
        return sorted(int(name[:12]) for name in names if _POINTER.fullmatch(name))

    def _pointed(self, stream: str, number: int) -> str | None:
        """The version a pointer names; None for one that a lost writer left unfinished."""

        try:
            return json.loads(read_small(self.spark, self._pointer(stream, number)))["version"]
        except ValueError:
            return None

    def current(self, stream: str) -> str | None:
        for number in reversed(self._numbers(stream)):
            version = self._pointed(stream, number)
            if version is not None:
                return version
        return None

    def read(self, stream: str, part: str) -> DataFrame:
        version = self.current(stream)
        if version is None:
            raise PublishError(f"nothing published for {stream}")
        return self.spark.read.parquet(self.version_path(stream, version, part))

    def versions(self, stream: str) -> DataFrame:
        """Published versions that are still on storage."""

        current, listed = self.current(stream), set(self.listed(stream))
        last = {self._pointed(stream, number): number for number in self._numbers(stream)}
        rows = [(stream, version, number, version == current) for version, number in last.items() if version in listed]
        return self.spark.createDataFrame(rows, "stream string, version string, sequence long, is_current boolean")

    def listed(self, stream: str) -> list[str]:
        """Versions on storage, pointed to or not."""

        return names_in(self.spark, f"{self.root}/releases/{stream}", folders=True)

    def prune_shared(self, folder: str) -> list[str]:
        """Delete versions of a folder that several streams point into.

        The newest ``keep`` stay, and so does every version some stream points to.
        """

        listed = sorted(self.listed(folder), reverse=True)
        used = {self.current(stream) for stream in names_in(self.spark, self.pointers, folders=True)}
        dropped = [version for version in listed[self.keep:] if version not in used]
        for version in dropped:
            self._delete(folder, version)
        return sorted(dropped)

    def to_prune(self, stream: str) -> list[str]:
        """Versions beyond the newest ``keep``; the current one always stays."""

        return sorted(row["version"] for row in prune_list(self.versions(stream), self.keep).collect())

    def prune(self, stream: str) -> list[str]:
        """Delete old versions, and the pointers that name nothing that is left."""

        dropped = self.to_prune(stream)
        for version in dropped:
            self._delete(stream, version)
        listed = set(self.listed(stream))
        for number in self._numbers(stream)[:-1]:
            if self._pointed(stream, number) not in listed:
                delete(self.spark, self._pointer(stream, number))
        return dropped
