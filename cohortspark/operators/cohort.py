"""Cohort filters and the flow table that reports what each of them leaves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.aggregates import span_seconds
from cohortspark.operators.windows import edge_rows, first_last_times
from cohortspark.operators.grouped import micros


def first_episode(df: DataFrame, subject: str, start: str) -> DataFrame:
    """Episodes at the subject's first start time (ties all count).  An aggregate and a semi join, no sort."""
    return edge_rows(df, subject, start)


def exclude(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows of the listed categories; a missing category is not excluded."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(list(values)))


def min_stay(df: DataFrame, days: str, hours: float) -> DataFrame:
    return df.filter(F.col(days) >= hours / 24.0)


def max_stay(df: DataFrame, days: str, hours: float, horizon_hours: float = 48) -> DataFrame:
    """Stays shorter than the window plus the longest horizon."""
    return df.filter(F.col(days) < (hours + horizon_hours) / 24.0)


def min_coverage(frames: Sequence[DataFrame], key: str, t: str, hours: float) -> DataFrame:
    """Ids whose data over all sources spans at least ``hours``."""
    span = first_last_times(frames, key, t)
    seconds = (micros("last_time") - micros("first_time")) / F.lit(1e6)
    return span.filter(seconds >= hours * 3600).select(key)


def coverage_in_both(a: DataFrame, b: DataFrame, key: str, t: str, hours: float, exact: bool = True) -> DataFrame:
    """Ids whose span is exactly (or at least) ``hours`` in both sources."""

    def ids(df: DataFrame) -> DataFrame:
        span = df.groupBy(key).agg(span_seconds(t).alias("_s"))
        return span.filter((F.col("_s") == hours * 3600) if exact else (F.col("_s") >= hours * 3600)).select(key)

    return ids(a).join(ids(b), key)


def cohort_flow(
    df: DataFrame, steps: Mapping[str, Column], counted: Mapping[str, str], event: str | None = None
) -> DataFrame:
    """One row per step: distinct ids left after it and all steps before it, and the events among the rows left.

    Steps are cumulative, so an id is left after a step exactly when its best row passes that many steps: one maximum
    per id replaces a distinct count per step.
    """
    so_far, passed = F.lit(True), F.lit(0)
    for condition in steps.values():
        so_far = so_far & F.coalesce(condition, F.lit(False))
        passed = passed + so_far.cast("int")
    rows = df.select(
        *set(counted.values()), *([F.col(event).alias("_event")] if event else []), passed.alias("_passed")
    )

    def upto(per_level: DataFrame, name: str) -> DataFrame:
        """A count per number of passed steps, summed up for every step."""
        levels = per_level.filter(F.col("_passed") > 0)
        listed = levels.withColumn("step_no", F.explode(F.sequence(F.lit(0), F.col("_passed") - 1)))
        return listed.groupBy("step_no").agg(F.sum("_n").alias(name))

    out = df.sparkSession.createDataFrame(list(enumerate(steps)), "step_no int, step string")
    for name, column in counted.items():
        best = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.max("_passed").alias("_passed"))
        levels = best.groupBy("_passed").agg(F.count(F.lit(1)).alias("_n"))
        out = out.join(upto(levels, name), "step_no", "left").na.fill(0, [name])
    if event:
        levels = rows.groupBy("_passed").agg(F.sum("_event").alias("_n"))
        out = out.join(upto(levels, "events"), "step_no", "left").na.fill(0, ["events"])
    return out


def retention(part: DataFrame, whole: DataFrame, key: str) -> DataFrame:
    """Percent of the distinct ids of ``whole`` that are left in ``part``; null when ``whole`` has none."""
    left = part.agg(F.count_distinct(key)).scalar()
    return whole.agg(F.count_distinct(key).alias("n_all")).select(
        "n_all", left.alias("n_left"), F.try_divide(left * 100.0, F.col("n_all")).alias("percent")
    )
