"""Parquet layers, addressed by path.

A plain layer is a folder of Parquet files that any tool can read; replacing it
is not atomic.  An atomic layer is a folder of snapshots and of numbered manifests:
a new snapshot is written whole, then a manifest that names it is created, and
readers follow the manifest of the highest number.  A job that dies before
that leaves the old layer as it was.  ``read_layer`` reads either kind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

MANIFESTS, SNAPSHOTS = "_manifests", "_snapshots"
DIGITS = 12  # of a manifest's number


class _Folder:
    """A path's file system, wherever it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path.rstrip("/")
        self.files = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, folder: str) -> list[str]:
        place = self.at(folder)
        return sorted(s.getPath().getName() for s in self.files.listStatus(place)) if self.files.exists(place) else []

    def read(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Fails if the file exists."""
        stream = self.files.create(self.at(name), False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def remove(self, name: str) -> None:
        self.files.delete(self.at(name), True)


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """What the manifests of an atomic layer say, oldest first; one that was not finished is left out."""
    folder, found = _Folder(spark, path), []
    for name in folder.names(MANIFESTS):
        if name.endswith(".json"):
            try:
                found.append(json.loads(folder.read(f"{MANIFESTS}/{name}")))
            except json.JSONDecodeError:
                continue
    return found


def layer_notes(spark: SparkSession, path: str) -> dict:
    """The notes that the current snapshot was published with."""
    there = manifests(spark, path)
    return there[-1]["notes"] if there else {}


def layer_names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder."""
    return _Folder(spark, path).names("")


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, milliseconds of the last change) of the files under a path or pattern, hidden ones left out."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for start in files.globStatus(place) or []:
        iterator = files.listFiles(start.getPath(), True)
        root = len(start.getPath().toString())
        while iterator.hasNext():
            file = iterator.next()
            name = file.getPath().toString()
            hidden = any(part.startswith(("_", ".")) for part in name[root:].split("/") if part)
            if not hidden:
                found.append((name, file.getLen(), file.getModificationTime()))
    return found


def remove_layer(spark: SparkSession, path: str) -> None:
    _Folder(spark, path).remove("")


def layer_exists(spark: SparkSession, path: str) -> bool:
    if manifests(spark, path):
        return True
    return any(not name.startswith(("_", ".")) for name in layer_names(spark, path))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    there = manifests(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/{there[-1]['snapshot']}" if there else path)


def write_layer(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    atomic: bool = False,
    keep: int = 2,
    notes: dict | None = None,
) -> None:
    """Replace the whole layer.

    A plain one must not be read in the same job, and the job is run again if
    it dies half way.  An atomic one may be read, stays whole whatever happens, and ``notes`` change
    together with it; its last ``keep`` snapshots stay for readers that are still at work.
    """
    if not atomic:
        _write(df, path, partition_by)
        return
    name = f"{SNAPSHOTS}/{uuid.uuid4().hex}"
    _write(df, f"{path.rstrip('/')}/{name}", partition_by)
    _publish(df.sparkSession, path, name, notes or {})
    remove_old(df.sparkSession, path, keep=keep)


def _write(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _publish(spark: SparkSession, path: str, snapshot: str, notes: dict) -> None:
    folder = _Folder(spark, path)
    numbers = [int(name[:DIGITS]) for name in folder.names(MANIFESTS) if name.endswith(".json")]
    number = max(numbers, default=0) + 1
    text = json.dumps({"number": number, "snapshot": snapshot, "notes": notes})
    # of two writers that take one number the second fails here, its snapshot unseen
    folder.create(f"{MANIFESTS}/{number:0{DIGITS}}.json", text)


def remove_old(spark: SparkSession, path: str, *, keep: int = 2) -> None:
    """Delete all but the last ``keep`` snapshots that were published, and their manifests."""
    folder = _Folder(spark, path)
    for old in manifests(spark, path)[: -max(keep, 1)]:
        folder.remove(f"{MANIFESTS}/{old['number']:0{DIGITS}}.json")
        folder.remove(old["snapshot"])


def remove_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Delete snapshots that no manifest names, as jobs that died leave them; only while nobody writes the layer."""
    folder = _Folder(spark, path)
    named = {m["snapshot"] for m in manifests(spark, path)}
    lost = [f"{SNAPSHOTS}/{name}" for name in folder.names(SNAPSHOTS) if f"{SNAPSHOTS}/{name}" not in named]
    for name in lost:
        folder.remove(name)
    return lost
