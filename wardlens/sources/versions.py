"""Tables whose parts are replaced atomically.

A versioned table is a folder of immutable part folders (each written once by a
Spark job) and a numbered list of versions. A version is one small JSON file
that names the live folder of every part, for instance of a reporting period or
of a bucket of keys. It is created only if its number is free, so of two writers
that start from the same version one wins; the other starts over from the
winner's version if they replaced different parts, and fails if both replaced
the same one. Readers take the newest version and read the folders that it
names: they see a replacement whole or not at all, and folders of older versions
stay until ``sweep`` removes them.

The list is as long as the table has parts, not rows; only it passes through
the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_VERSIONS, _DATA = "_versions", "data"


class Conflict(RuntimeError):
    """Another writer replaced the same part first."""


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ------------------------------------------------------------ files

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _put_if_absent(self, path: str, text: str) -> bool:
        """Create a file with its content in one step; False if it exists. A
        rename onto a file fails on HDFS; the local file system would replace
        it, so there a link is made instead."""
        target, files = self._at(path)
        staged, _ = self._at(f"{self.root}/{_VERSIONS}/.new-{uuid.uuid4().hex}")
        files.mkdirs(target.getParent())
        out = files.create(staged, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if files.resolvePath(staged).toUri().getScheme() != "file":
                return not files.exists(target) and files.rename(staged, target)
            jvm = self.spark._jvm
            local = [jvm.java.io.File(files.resolvePath(staged).toUri().getPath()).toPath()]
            local.insert(0, local[0].resolveSibling(target.getName()))
            try:
                jvm.java.nio.file.Files.createLink(*local)
            except Exception as e:  # noqa: BLE001 - only an existing target is an answer
                if "FileAlreadyExistsException" in str(e):
                    return False
                raise
            return True
        finally:
            files.delete(staged, False)

    def _names(self, folder: str) -> list[tuple[str, int]]:
        """Names and times of the entries of a folder, hidden ones left out."""
        where, files = self._at(folder)
        if not files.exists(where):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in files.listStatus(where)
                if not s.getPath().getName().startswith(".")]

    # --------------------------------------------------------- versions

    def newest(self) -> int:
        """The number of the newest version, 0 before the first."""
        return max((int(n) for n, _ in self._names(f"{self.root}/{_VERSIONS}")), default=0)

    def parts(self, version: int | None = None) -> dict[str, str]:
        """The live folder (under the root) of every part."""
        version = self.newest() if version is None else version
        if version == 0:
            return {}
        where, files = self._at(f"{self.root}/{_VERSIONS}/{version:012d}")
        stream = files.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def commit(self, base: int, changes: Mapping[str, str | None]) -> int:
        """Make the folders of ``changes`` live (None drops a part) on top of
        version ``base``; returns the new version. If later versions left these
        parts alone, the commit is repeated on the newest one."""
        mine, seen = self.parts(base), base
        while True:
            merged = {k: v for k, v in {**mine, **changes}.items() if v is not None}
            if self._put_if_absent(f"{self.root}/{_VERSIONS}/{seen + 1:012d}",
                                   json.dumps(merged, sort_keys=True)):
                return seen + 1
            started, seen = mine, self.newest()
            mine = self.parts(seen)
            lost = sorted(k for k in changes if mine.get(k) != started.get(k))
            if lost:
                raise Conflict(f"another writer replaced {', '.join(lost[:5])}")

    # ------------------------------------------------------------- data

    def new_folder(self) -> str:
        """A folder, relative to the root, that nothing else writes to."""
        return f"{_DATA}/{uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def read(self, schema: T.StructType, parts: list[str] | None = None,
             version: int | None = None) -> DataFrame:
        """The rows of some or all parts of one version."""
        live = self.parts(version)
        folders = sorted({live[p] for p in (live if parts is None else parts) if p in live})
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*map(self.path, folders))

    def sweep(self, older_than_seconds: float) -> int:
        """Delete part folders that the newest version does not name and that
        are older than any reader or writer at work can be; returns how many.
        Version files, which are small, stay: their numbers are not reused."""
        live = {f.split("/")[1] for f in self.parts().values()}
        limit = (time.time() - older_than_seconds) * 1000
        gone = [n for n, at in self._names(f"{self.root}/{_DATA}") if n not in live and at < limit]
        for name in gone:
            where, files = self._at(f"{self.root}/{_DATA}/{name}")
            files.delete(where, True)
        return len(gone)
