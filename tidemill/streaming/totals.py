"""Totals per key kept current as rows arrive, compacted in place while the stream runs.

Every micro-batch writes the keys it changed to a folder of its own. A manifest names the snapshot that stands for all batches up to
some number; it is a numbered file that is created once and never changed, so the highest number is the current version and a reader never
sees half of a compaction. What a version replaces is deleted by the compaction after it, so readers of the last version can finish.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


class _Folder:
    """The output folder through Spark's file systems."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.out = spark, out.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.out).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.path(f"{self.out}/{name}")

    def names(self, folder: str = "") -> list[str]:
        place = self.at(folder) if folder else self.path(self.out)
        return [s.getPath().getName() for s in self.fs.listStatus(place)] if self.fs.exists(place) else []

    def batches(self) -> list[int]:
        """Complete batches."""
        numbers = [int(n.removeprefix("batch=")) for n in self.names() if re.fullmatch(r"batch=\d+", n)]
        return sorted(n for n in numbers if self.complete(n))

    def complete(self, batch: int) -> bool:
        return self.fs.exists(self.at(f"batch={batch}/_SUCCESS"))

    def manifest(self) -> dict:
        """The current version: its number, snapshot folder (or none), the last batch in it, and what it replaced."""
        versions = sorted(int(n[:-5]) for n in self.names("manifest") if re.fullmatch(r"\d+\.json", n))
        if not versions:
            return {"version": 0, "snapshot": None, "upto": -1, "replaced": []}
        stream = self.fs.open(self.at(f"manifest/{versions[-1]:08d}.json"))
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def commit(self, manifest: dict) -> None:
        """Create the manifest's file; an error if another writer has made this version."""
        draft, place = self.at(f"manifest/draft-{uuid.uuid4().hex}"), self.at(f"manifest/{manifest['version']:08d}.json")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if self.fs.exists(place) or not self.fs.rename(draft, place):
            self.fs.delete(draft, False)
            raise RuntimeError(f"version {manifest['version']} was written by another compaction")

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def running_totals(stream: DataFrame, key: str, value: str, out: str, checkpoint: str, compact_every: int | None = None) -> StreamingQuery:
    """Maintain ``sum(value)`` and row counts per key of a stream as parquet below ``out``.

    Spark keeps the state; each micro-batch emits only the keys it changed and writes them with its batch number. A repeated
    batch gives the same rows, so one that is complete, or already part of a snapshot, is left as it is. ``read_totals``
    takes the newest version of every key. ``compact_every``: compact after so many batches.
    """
    totals = stream.groupBy(key).agg(F.sum(value).alias("total"), F.count("*").alias("n_rows"))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        folder = _Folder(batch.sparkSession, out)
        if batch_id > folder.manifest()["upto"] and not folder.complete(batch_id):
            batch.write.mode("overwrite").parquet(f"{folder.out}/batch={batch_id}")
        else:
            batch.write.format("noop").mode("overwrite").save()     # the state of the batch is still to be stored
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_totals(batch.sparkSession, out, key)

    return (totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(upsert).trigger(availableNow=True).start())


def _versions(spark: SparkSession, folder: _Folder, key: str, manifest: dict, batches: list[int]) -> DataFrame | None:
    """The latest row of every key with its batch, from the manifest's snapshot and the given later batches."""
    parts = []
    if manifest["snapshot"]:
        parts.append(spark.read.parquet(f"{folder.out}/{manifest['snapshot']}"))
    if batches:
        paths = [f"{folder.out}/batch={b}" for b in batches]
        parts.append(spark.read.option("basePath", folder.out).parquet(*paths).withColumn("batch", F.col("batch").cast("long")))
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.groupBy(key).agg(F.max(F.struct("batch", "total", "n_rows")).alias("l")).select(key, "l.*")


def read_totals(spark: SparkSession, out: str, key: str) -> DataFrame:
    """Current totals: for each key the row of its latest batch. Before the first batch there is nothing to read, which is an error."""
    folder = _Folder(spark, out)
    manifest = folder.manifest()
    latest = _versions(spark, folder, key, manifest, [b for b in folder.batches() if b > manifest["upto"]])
    if latest is None:
        raise ValueError(f"no batch has been written to {out}")
    return latest.select(key, "total", "n_rows")


def compact_totals(spark: SparkSession, out: str, key: str, target: str | None = None) -> int:
    """Replace the batches so far by one snapshot and return its version; the stream may go on meanwhile.

    Batches that arrive during the compaction are later than the snapshot and stay. With ``target`` nothing is replaced: the current totals are
    written there, as a folder that ``read_totals`` reads.
    """
    folder = _Folder(spark, out)
    manifest = folder.manifest()
    batches = [b for b in folder.batches() if b > manifest["upto"]]
    latest = _versions(spark, folder, key, manifest, batches)
    if target is not None:
        latest.select(key, "total", "n_rows").write.parquet(f"{target.rstrip('/')}/batch=0")
        return manifest["version"]
    if not batches:
        return manifest["version"]
    snapshot = f"snapshot-{manifest['version'] + 1:08d}-{uuid.uuid4().hex[:8]}"
    latest.write.parquet(f"{folder.out}/{snapshot}")
    replaced = [f"batch={b}" for b in batches] + ([manifest["snapshot"]] if manifest["snapshot"] else [])
    folder.commit({"version": manifest["version"] + 1, "snapshot": snapshot, "upto": batches[-1], "replaced": replaced})
    for name in manifest["replaced"]:       # readers of the version before the last are gone by now
        folder.remove(name)
    return manifest["version"] + 1
