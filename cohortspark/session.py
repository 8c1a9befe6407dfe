"""Session helpers: settings that suit large cohort jobs, and the shared folder for written state."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


_SCRATCH: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("cohortspark")
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a session on one machine may do without it; a scratch folder of that machine is used then.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if "local" not in _SCRATCH:
        _SCRATCH["local"] = tempfile.mkdtemp(prefix="cohortspark-")
    return _SCRATCH["local"]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so iterative jobs survive lost executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def staged(df: DataFrame) -> DataFrame:
    """Write a stage of a pipeline as a table in the shared folder and go on from the table.

    Later stages read a frame of known size instead of repeating the work before it, also after lost executors.
    """
    path = f"{shared_dir(df.sparkSession)}/stage-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
