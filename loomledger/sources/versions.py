"""Folders that change as a whole: new files are written beside the old, then one small file names what counts.

A table is a set of buckets, each a folder of Parquet files. A manifest says for every
bucket which written version holds it. Readers take the newest manifest, so a run that
dies at any moment leaves the table as it was; writers that started from the same manifest
cannot both publish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_MANIFESTS = "_manifests"
BUCKET = "_bucket"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def replace_folder(spark: SparkSession, draft: str, target: str) -> None:
    """Put a completely written folder in the place of another, which is kept until the new one stands."""
    files, retired = _files(spark, target), _retired(target)
    if files.exists(_path(spark, target)) and not files.rename(_path(spark, target), _path(spark, retired)):
        raise RuntimeError(f"{target} could not be set aside")
    if not files.rename(_path(spark, draft), _path(spark, target)):
        raise RuntimeError(f"{draft} could not be put at {target}")
    files.delete(_path(spark, retired), True)


def recover_folder(spark: SparkSession, target: str) -> None:
    """Undo a replacement that died between its two renames."""
    files, retired = _files(spark, target), _retired(target)
    if files.exists(_path(spark, retired)):
        if files.exists(_path(spark, target)):
            files.delete(_path(spark, retired), True)
        else:
            files.rename(_path(spark, retired), _path(spark, target))


def _retired(target: str) -> str:
    parent, name = target.rstrip("/").rsplit("/", 1)
    return f"{parent}/.{name}-retired"


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The paths of the folders in a folder; none where it does not exist."""
    files, folder = _files(spark, path), _path(spark, path)
    if not files.exists(folder):
        return []
    return sorted(f"{path.rstrip('/')}/{s.getPath().getName()}" for s in files.listStatus(folder) if s.isDirectory())


class Buckets:
    """A bucketed table under ``root``; ``versions`` maps bucket -> version, both from the newest manifest."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.number, self.n_buckets, self.versions = 0, n_buckets, {}
        self.refresh()

    def refresh(self) -> None:
        files = _files(self.spark, self.root)
        folder = _path(self.spark, f"{self.root}/{_MANIFESTS}")
        if not files.exists(folder):
            return
        numbers = [int(s.getPath().getName().removesuffix(".json")) for s in files.listStatus(folder)
                   if s.getPath().getName().endswith(".json")]
        if not numbers:
            return
        self.number = max(numbers)
        held = json.loads(self.spark.read.text(self._manifest(self.number), wholetext=True).first()[0])
        self.n_buckets, self.versions = held["n_buckets"], {int(b): v for b, v in held["versions"].items()}

    def _manifest(self, number: int) -> str:
        return f"{self.root}/{_MANIFESTS}/{number:012d}.json"

    def paths(self, buckets: Iterable[int] | None = None) -> list[str]:
        """The folders that hold the given buckets, all by default; buckets without rows have none."""
        wanted = sorted(self.versions if buckets is None else set(buckets) & self.versions.keys())
        return [f"{self.root}/{self.versions[b]}/{BUCKET}={b}" for b in wanted]

    def read(self, schema, buckets: Iterable[int] | None = None) -> DataFrame:
        paths = self.paths(buckets)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replace(self, rows: DataFrame, buckets: Iterable[int]) -> None:
        """Write ``rows`` (with their bucket in ``BUCKET``) as the new contents of ``buckets`` and publish them."""
        version = f"data-{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").partitionBy(BUCKET).parquet(f"{self.root}/{version}")
        files = _files(self.spark, self.root)
        written = {int(s.getPath().getName().removeprefix(f"{BUCKET}="))
                   for s in files.listStatus(_path(self.spark, f"{self.root}/{version}"))
                   if s.getPath().getName().startswith(f"{BUCKET}=")}
        kept = {b: v for b, v in self.versions.items() if b not in set(buckets)}
        self._publish(kept | {b: version for b in written})

    def _publish(self, versions: dict[int, str]) -> None:
        files, number = _files(self.spark, self.root), self.number + 1
        draft = _path(self.spark, f"{self.root}/{_MANIFESTS}/draft-{uuid.uuid4().hex}")
        stream = files.create(draft)
        stream.write(bytearray(json.dumps({"n_buckets": self.n_buckets, "versions": versions}).encode()))
        stream.close()
        target = _path(self.spark, self._manifest(number))
        if files.exists(target) or not files.rename(draft, target):
            raise RuntimeError(f"{self.root}: another run published version {number} first")
        self.number, self.versions = number, versions
