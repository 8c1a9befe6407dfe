"""What the operators of this subpackage share: the registry of their queries, tables in the shared folder, text as
words, and documents gathered into batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.session import cut_lineage, shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
NULL_ID = 2**63 - 1  # a null id is later than every other id


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class Scratch:
    """Tables of one job, in a folder of their own inside the shared folder.  They cut lineage: what follows a lost
    executor is read from them.  Leaving the block removes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.name = spark, f"llm_{uuid4().hex}"
        self.root = f"{shared_dir(spark)}/{self.name}"
        self.made: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """A table whose rows lie by ``key``, so joins on ``key`` do not shuffle it."""
        name = f"{self.name}_{len(self.made)}"
        self.made.append(name)
        writer = df.write.option("compression", "zstd").option("path", f"{self.root}/{name}")
        writer.bucketBy(buckets, key).format("parquet").saveAsTable(name)
        return self.spark.table(name)

    def __exit__(self, *_) -> None:
        for name in self.made:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def kept(df: DataFrame) -> DataFrame:
    """A narrow result, checkpointed in the shared folder; Spark's cleaner removes it when nothing refers to it."""
    return cut_lineage(df)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


BATCH_BYTES = 4 << 20  # text that one batch holds at most, but for a single longer document
BATCH_COLUMNS = "batch string, n int, ids binary, sizes binary, body binary"


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, body) into batch rows of up to ``BATCH_BYTES``: ids and sizes as packed 64-bit numbers, bodies joined."""
    ids: list[int] = []
    bodies: list[bytes] = []
    size = 0

    def row():
        return pa.RecordBatch.from_pydict(
            {
                "batch": pa.array([uuid4().hex]),
                "n": pa.array([len(ids)], pa.int32()),
                "ids": pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                "sizes": pa.array([np.fromiter(map(len, bodies), np.int64, len(bodies)).tobytes()], pa.binary()),
                "body": pa.array([b"".join(bodies)], pa.binary()),
            }
        )

    for batch in batches:
        for i, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            data = body.as_py()
            if ids and size + len(data) > BATCH_BYTES:
                yield row()
                ids, bodies, size = [], [], 0
            ids.append(i)
            bodies.append(data)
            size += len(data)
    if ids:
        yield row()


def gathered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Documents as batch rows (``BATCH_COLUMNS``).  A batch's name is drawn anew at each run: store the frame before
    anything is joined on it."""
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(NULL_ID)).alias("id"),
        text_of(text_column).cast("binary").alias("body"),
    )
    return rows.mapInArrow(gather, BATCH_COLUMNS)


def real_id(column: str = "id") -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column))


_U = np.uint64


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of the 64-bit splitmix generator: every bit of the result depends on every bit of ``h``."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts, [len(values)]])
