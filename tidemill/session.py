"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

LOCAL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int = 8, app: str = "tidemill", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(cpus)))
    for key, value in LOCAL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run inside, put back afterwards."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a machine-local folder would lose data with its machine, so it is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = getattr(sc, "_tidemill_dir", None)
    if folder is None:
        folder = sc._tidemill_dir = tempfile.mkdtemp(prefix="tidemill-")
    return folder


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and go on from there.

    A lost executor then costs a re-read, never a replayed loop or a second, differently
    placed range shuffle. Later steps read only the columns they use, and joins see the real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    df.write.parquet(path)
    stage = spark.read.schema(df.schema).parquet(path)
    stage._stage_path = path
    return stage


def drop_stage(stage: DataFrame | None) -> None:
    """Delete a table of ``cut_lineage`` that a loop has superseded; nothing may read it, or what follows from it, again."""
    path = getattr(stage, "_stage_path", None)
    if path:
        spark = stage.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def bucketed_stage(df: DataFrame, key: str) -> DataFrame:
    """Write ``df`` below the shared folder, bucketed by ``key``, and read it back.

    Later joins on ``key`` find these rows in place: only the other side is shuffled.
    """
    spark = df.sparkSession
    name = f"stage_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_dir(spark)}/{name}"
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    stage = spark.table(name)
    stage._stage_table, stage._stage_path = name, path
    return stage


def drop_bucketed(stage: DataFrame) -> None:
    """Delete a table of ``bucketed_stage`` that has been superseded; nothing may read it, or what follows from it, again."""
    stage.sparkSession.sql(f"drop table if exists {stage._stage_table}")
    drop_stage(stage)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal a small table out by ``key`` for CPU-heavy work when it has fewer partitions than there are cores.

    A table that already fills the cluster is returned unchanged, so large inputs are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
