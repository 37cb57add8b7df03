"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Scratch tables are read a few times and then go: their bytes on disk count more than the codec's time.
SCRATCH_CODEC = "zstd"


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("vacancia")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a temporary
    folder: executors on other machines would not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = tempfile.mkdtemp(prefix="vacancia-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the shared folder; never reused, so a retry cannot clash.

    All paths of one application share a folder, which may go once the job is done.
    """
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/vacancia/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a reuse point and, unlike a local checkpoint, survives
    the loss of an executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=SCRATCH_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)
