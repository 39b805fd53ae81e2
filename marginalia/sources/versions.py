"""Tables in versions: data in folders of their own, and manifests that say which folders make up a version."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Conflict(RuntimeError):
    """Another writer has taken the version."""


class Versions:
    """The versions of the tables below a folder.

    A version is one small JSON file, which is renamed into place when all its data are written: readers see the whole of a version or the one before, and a writer
    that fails leaves folders that no manifest names. A version's number is claimed first, by creating a file that must not exist: of two writers that
    start from one version, the second gets a Conflict and has to start anew. Works on every file system that Spark writes to.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.folder}/_versions"))

    def numbers(self) -> list[int]:
        names = (f.getPath().getName() for f in self._fs.listStatus(self._path(f"{self.folder}/_versions")))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def read(self, number: int | None = None) -> tuple[int, dict]:
        """(number, content) of a version, the latest if none is named; (0, {}) before the first."""
        if number is None:
            number = max(self.numbers(), default=0)
        if not number:
            return 0, {}
        return number, json.loads(self.spark.read.text(f"{self.folder}/_versions/{number:012d}.json", wholetext=True).first()[0])

    def new_folder(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def written(self, df: DataFrame, name: str, by: str | None = None) -> str:
        """Writes df to a folder of its own and returns that; it belongs to no version yet."""
        path = self.new_folder(name)
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        return path

    def commit(self, parent: int, content: dict) -> int:
        """Makes content the version after `parent`."""
        number = parent + 1
        claim, final = (self._path(f"{self.folder}/_versions/{number:012d}.{end}") for end in ("claim", "json"))
        if parent != max(self.numbers(), default=0) or not self._fs.createNewFile(claim):
            raise Conflict(f"version {number} of {self.folder} is taken, or {claim.getName()} was left by a writer that failed")
        draft = self._path(f"{self.folder}/_versions/{number:012d}.{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if not self._fs.rename(draft, final):
            raise Conflict(f"version {number} of {self.folder} can't be put in place")
        return number

    def delete(self, paths: list[str]) -> None:
        for p in paths:
            self._fs.delete(self._path(p), True)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Deletes all but the last `keep` versions, and the folders that none of those names; not to be run beside a writer. Returns the folders."""
        numbers = self.numbers()
        used = {p for n in numbers[-keep:] for p in _strings(self.read(n)[1])}
        for n in numbers[:-keep]:
            self.delete([f"{self.folder}/_versions/{n:012d}.{end}" for end in ("json", "claim")])
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path(self.folder))]
        gone = [f"{self.folder}/{n}" for n in names if n != "_versions" and f"{self.folder}/{n}" not in used]
        self.delete(gone)
        return gone


def _strings(x: object) -> list[str]:
    if isinstance(x, str):
        return [x]
    return [s for v in (x.values() if isinstance(x, dict) else x if isinstance(x, list) else []) for s in _strings(v)]
