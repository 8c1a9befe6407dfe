"""Sequencing, first/last rows, gaps, heads, spans, distinct rows and set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortspark.operators.grouped import fill, micros, number_rows, previous_next, running_sum


def sequence_episodes(
    df: DataFrame, part: str, order: str, name: str, first: str | None = None, target_rows: int | None = None
) -> DataFrame:
    """Dense rank of episodes inside ``part`` (ties share a rank) and an optional is-first flag."""
    out = number_rows(df, [part], order, name, method="dense_rank", target_rows=target_rows)
    out = out.withColumn(name, F.col(name).cast("int"))
    return out.withColumn(first, F.col(name) == 1) if first else out


def union_times(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    out = frames[0].select(*columns)
    for f in frames[1:]:
        out = out.unionByName(f.select(*columns))
    return out


def first_last_times(frames: Sequence[DataFrame], key: str, t: str) -> DataFrame:
    """First and last time per entity over all sources: one aggregate over their union."""
    return union_times(frames, [key, t]).groupBy(key).agg(F.min(t).alias("first_time"), F.max(t).alias("last_time"))


def edge_rows(df: DataFrame, key: str, t: str, last: bool = False) -> DataFrame:
    """All rows at the first (or last) time of their entity, ties included."""
    edge = df.groupBy(key).agg((F.max(t) if last else F.min(t)).alias(t))
    return df.join(edge, [key, t], "left_semi")


def ffill_bfill(df: DataFrame, key: str, t: str, columns: Sequence[str], **kw) -> DataFrame:
    return fill(df, [key], t, columns, ("forward", "backward"), **kw)


def bfill_ffill(df: DataFrame, key: str, t: str, columns: Sequence[str], **kw) -> DataFrame:
    return fill(df, [key], t, columns, ("backward", "forward"), **kw)


def time_gaps(df: DataFrame, key: str, t: str, target_rows: int | None = None) -> DataFrame:
    """Hours since the entity's previous row, 0 for its first."""
    out = previous_next(df, [key], t, {"_prev": t}, target_rows=target_rows)
    hours = (micros(t) - micros("_prev")) / F.lit(3.6e9)
    return out.withColumn("gap_hours", F.coalesce(hours, F.lit(0.0))).drop("_prev")


def head_per_group(df: DataFrame, key: str, t: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """First n rows per entity.  The rank limit is applied before the shuffle, so a hot entity sends n rows a task."""
    w = Window.partitionBy(key).orderBy(t, *ties)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def transform_span(df: DataFrame, key: str, t: str) -> DataFrame:
    """The entity's span in seconds on each of its rows: a small aggregate joined back, no window."""
    span = df.groupBy(key).agg(((micros(F.max(t)) - micros(F.min(t))) / F.lit(1e6)).alias("span_seconds"))
    return df.join(span, key)


def suffix_share(
    df: DataFrame, order: str, columns: Sequence[str], keys: Sequence[str] = (), target_rows: int | None = None
) -> DataFrame:
    """Sum from the row to the end, divided by the largest such sum."""
    keys = list(keys)
    out = running_sum(df, keys, order, {f"_s_{c}": c for c in columns}, descending=True, target_rows=target_rows)
    tops = out.groupBy(*keys).agg(F.struct(*[F.max(f"_s_{c}").alias(c) for c in columns]).alias("_top"))
    out = out.join(tops, keys) if keys else out.withColumn("_top", tops.scalar())
    return out.withColumns({c: F.col(f"_s_{c}") / F.col(f"_top.{c}") for c in columns}).drop(
        "_top", *[f"_s_{c}" for c in columns]
    )


def distinct_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in the given order.  An aggregate, so it combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def order_series(df: DataFrame, key: str, t: str, partitions: int | None = None) -> DataFrame:
    """Rows of an entity together and in time order, without a global sort.

    Range partitioning by (entity, time) also spreads an entity that is larger than one partition.
    """
    args = [partitions] if partitions else []
    return df.repartitionByRange(*args, key, t).sortWithinPartitions(key, t)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def entity_slice(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == value)
