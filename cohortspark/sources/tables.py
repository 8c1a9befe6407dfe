"""Reading and writing tables: relational databases, Parquet snapshots, result tables and score tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

SCORE_SCHEMA = (
    "label string, model string, n_clients int, window int, split string, metric string, fold int, client int, "
    "epoch int, value double"
)
PREDICTION_SCHEMA = (
    "label string, model string, n_clients int, window int, fold int, client int, y_true double, y_pred double"
)
RUN_KEY = ["label", "model", "n_clients", "window"]


def jdbc_options(
    url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 64,
    properties: Mapping[str, str] | None = None, fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Options of a database read.  With a numeric column and its bounds, ``partitions`` ranges are read in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows), **(properties or {})}
    if column:
        if not bounds:
            raise ValueError("a partition column needs bounds")
        options |= {
            "partitionColumn": column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, name: str, source: str | Mapping) -> DataFrame:
    """A table from a Parquet folder (``source`` is its path) or a database (``source`` holds ``jdbc_options`` arguments)."""
    if isinstance(source, Mapping):
        return spark.read.format("jdbc").options(**jdbc_options(table=name, **source)).load()
    return spark.read.parquet(f"{source.rstrip('/')}/{name}.parquet")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet files; with ``partition_by``, rows are gathered per folder first, so folders hold few files."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def table_name(name: str, hours: int) -> str:
    """Name of a result table; it carries the window length."""
    return f"{name}_{hours}h"


def write_table(df: DataFrame, folder: str, name: str, hours: int) -> str:
    """Replace a result table below ``folder``; returns its path."""
    path = f"{folder.rstrip('/')}/{table_name(name, hours)}"
    df.write.mode("overwrite").parquet(path)
    return path


def create_table(
    df: DataFrame, name: str, order: Sequence[str] = (), total_order: bool = False, path: str | None = None
) -> DataFrame:
    """CREATE TABLE AS SELECT.  Rows are sorted inside every file; a total order only on request.

    With ``path`` the files lie there.  Returns the table as it is read back.
    """
    out = df.orderBy(*order) if order and total_order else df.sortWithinPartitions(*order) if order else df
    _at(out.write.mode("overwrite"), path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, order: Sequence[str] = (), path: str | None = None
) -> DataFrame:
    """Table bucketed by entity, so that later joins and windows on the entity need no shuffle.

    Rows are dealt to their buckets first, so every bucket is one sorted file.  Returns the table as it is read back;
    tables that are joined need the same number of buckets.
    """
    dealt = df.repartition(buckets, key).sortWithinPartitions(key, *order)
    writer = _at(dealt.write.mode("overwrite"), path).bucketBy(buckets, key).sortBy(key, *order)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _at(writer: DataFrameWriter, path: str | None) -> DataFrameWriter:
    return writer.option("path", path) if path else writer


def code_table(spark: SparkSession, rows: Iterable[tuple], schema: str = "code string, type string") -> DataFrame:
    """Small literal table."""
    return spark.createDataFrame(list(rows), schema)


def write_scores(df: DataFrame, folder: str, kind: str = "scores") -> None:
    """Add the rows of a run; rows of the same run key (a partition) are replaced, other runs stay.

    Rows are gathered by run key into files of the advisory size: small runs share a task, a large run is split.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in RUN_KEY])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*RUN_KEY)
        .parquet(f"{folder.rstrip('/')}/{kind}")
    )


def read_scores(spark: SparkSession, folder: str, kind: str = "scores", **run_key) -> DataFrame:
    """Rows of a run.  Old runs have no predictions: a missing table or partition gives no rows."""
    schema = {"scores": SCORE_SCHEMA, "predictions": PREDICTION_SCHEMA}[kind]
    try:
        df = spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{kind}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    for name, value in run_key.items():
        df = df.filter(F.col(name) == value)
    return df
