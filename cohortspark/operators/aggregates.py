"""Aggregates: pivots, counts, quantiles, histograms and cohort summaries.

Everything that is an ordinary aggregate combines map-side, so a hot key costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.grouped import (
    large_groups,
    match,
    micros,
    quantiles,
)


def pivot_mean(df: DataFrame, keys: Sequence[str], item: str, value: str, items: Mapping[str, object]) -> DataFrame:
    """Wide table of the mean value per item; ``items`` maps output column to item.  One shuffle, no item lookup."""
    return df.groupBy(*keys).agg(
        *[F.avg(F.when(F.col(item) == code, F.col(value))).alias(name) for name, code in items.items()]
    )


def mean_columns(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """Mean of already split columns (one expression per signal)."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(name) for name, c in columns.items()])


def unpivot(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form (keys, signal, value)."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "signal", "value")


def median_by(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], entity: str, target_rows: int | None = None
) -> DataFrame:
    """Exact median per group of every column, e.g. per (entity, time bin).

    The built-in median keeps the distinct values of a group in memory.  It serves entities of up to ``target_rows``
    rows; groups of larger entities go through counted values and running sums, which no single task holds.
    """
    large = F.broadcast(large_groups(df, [entity], target_rows))  # at most rows / target_rows ids
    few, many = df.join(large, entity, "left_anti"), df.join(large, entity, "left_semi")
    return medians_apart(few, many, keys, columns, target_rows)


def medians_apart(
    few: DataFrame, many: DataFrame, keys: Sequence[str], columns: Sequence[str], target_rows: int | None = None
) -> DataFrame:
    """Median per group of every column: of ``few`` by the built-in median, of ``many`` by counted values."""
    plain = few.groupBy(*keys).agg(*[F.median(c).alias(c) for c in columns])
    long = quantiles(unpivot(many, keys, columns), [*keys, "signal"], "value", {"_m": 0.5}, target_rows)
    wide = long.groupBy(*keys).agg(*[F.max(F.when(F.col("signal") == c, F.col("_m"))).alias(c) for c in columns])
    return plain.unionByName(match(many.select(*keys).distinct(), wide, keys))


def median_cont(column: Column | str) -> Column:
    """Interpolated median as an aggregate expression, for groups that fit one task."""
    return F.median(column)


def aggregate_signals(df: DataFrame, key: str, columns: Sequence[str], sentinel: float = -1) -> DataFrame:
    """Mean per entity; sentinel cells count as missing."""
    return df.groupBy(key).agg(*[F.avg(F.nullif(F.col(c), F.lit(sentinel))).alias(c) for c in columns])


def column_medians(df: DataFrame, columns: Sequence[str], target_rows: int | None = None) -> DataFrame:
    """Exact median of every column over all rows, as one row."""
    long = quantiles(unpivot(df, [], columns), ["signal"], "value", {"_m": 0.5}, target_rows)
    return long.agg(*[F.max(F.when(F.col("signal") == c, F.col("_m"))).alias(c) for c in columns])


def span_seconds(t: str) -> Column:
    return (micros(F.max(t)) - micros(F.min(t))) / F.lit(1e6)


def time_span(df: DataFrame, key: str, t: str) -> DataFrame:
    """First to last time per entity, in seconds."""
    return df.groupBy(key).agg(span_seconds(t).alias("span_seconds"))


def count_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of distinct values of each column."""
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def value_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts of ``column`` values (given, so no extra job) per row value, with a total."""
    return df.groupBy(row).agg(
        *[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values], F.count(F.lit(1)).alias("total")
    )


def count_distinct_by(df: DataFrame, by: str, column: str, condition: Column) -> DataFrame:
    return df.filter(condition).groupBy(by).agg(F.count_distinct(column).alias("n"))


def describe(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), target_rows: int | None = None
) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column (and group), one row each."""
    rows = [
        F.struct(
            F.lit(c).alias("signal"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    basic = df.groupBy(*by).agg(F.array(*rows).alias("_r")).select(*by, F.inline("_r"))
    g = [*by, "signal"]
    quartiles = quantiles(
        unpivot(df, by, columns), g, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, target_rows
    )
    return match(basic, quartiles, g)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (column, nulls); one aggregate row turned long."""
    columns = list(columns or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "nulls")


def quantile_cut(df: DataFrame, column: str, q: float, target_rows: int | None = None) -> DataFrame:
    """Rows above the q-quantile of the column, with the threshold."""
    cut = quantiles(df, [], column, {"q": q}, target_rows)
    return df.withColumn("threshold", cut.scalar()).filter(F.col(column) > F.col("threshold"))


def histogram(df: DataFrame, column: str, edges: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Counts per bin, closed on the left; the last bin is closed on both ends; empty bins stay.

    The bins are ``bin``, ``low`` and ``high``; values outside the edges are not counted.
    """
    v = F.col(column)
    last = len(edges) - 2
    counts = [
        F.count_if((v >= lo) & ((v <= hi) if i == last else (v < hi)))
        for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))
    ]
    bins = F.array(
        *[
            F.struct(
                F.lit(i).alias("bin"),
                F.lit(float(edges[i])).alias("low"),
                F.lit(float(edges[i + 1])).alias("high"),
                c.alias("n"),
            )
            for i, c in enumerate(counts)
        ]
    )
    return df.groupBy(*by).agg(bins.alias("_bins")).select(*by, F.inline("_bins"))


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Histogram of ``bins`` equal bins between the lowest and the highest value; a constant lies in the middle of bins
    of total width 1."""
    bounds = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b"))
    v = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_v"))
    v = v.withColumn("_b", bounds.scalar())
    spread = F.col("_b.hi") > F.col("_b.lo")
    width = F.when(spread, (F.col("_b.hi") - F.col("_b.lo")) / bins).otherwise(F.lit(1.0 / bins))
    low = F.when(spread, F.col("_b.lo")).otherwise(F.col("_b.lo") - F.lit(0.5))
    bin_no = F.least(F.floor((F.col("_v") - low) / width), F.lit(bins - 1)).cast("int")
    found = v.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(found, "bin", "left").select("bin", F.coalesce("_n", F.lit(0)).alias("n"))


def threshold_counts(df: DataFrame, column: str, cuts: Sequence[float], by: str, values: Sequence) -> DataFrame:
    """Rows (cut, one count per label, Total): how many entities reach at least each cut.  One pass."""
    v = F.col(column)
    rows = F.array(
        *[
            F.struct(
                F.lit(float(cut)).alias("cut"),
                *[F.count_if((v >= cut) & (F.col(by) == x)).alias(f"n_{x}") for x in values],
                F.count_if((v >= cut) & F.col(by).isin(list(values))).alias("total"),
            )
            for cut in cuts
        ]
    )
    return df.agg(rows.alias("_r")).select(F.inline("_r"))


def range_counts(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Counts of exactly the first edge, then of each half-open range (low, high]."""
    v = F.col(column)
    parts = [F.struct(F.lit(f"= {edges[0]:g}").alias("range"), F.count_if(v == edges[0]).alias("n"))]
    for lo, hi in zip(edges[:-1], edges[1:]):
        parts.append(F.struct(F.lit(f"({lo:g}, {hi:g}]").alias("range"), F.count_if((v > lo) & (v <= hi)).alias("n")))
    return df.agg(F.array(*parts).alias("_r")).select(F.inline("_r"))


def box_stats(
    df: DataFrame, column: str, by: Sequence[str], reach: float = 1.5, target_rows: int | None = None
) -> DataFrame:
    """Quartiles, whiskers (furthest value within ``reach`` interquartile ranges) and outlier count per group."""
    q = quantiles(df, by, column, {"q1": 0.25, "median": 0.5, "q3": 0.75}, target_rows)
    v = F.col(column)
    low, high = F.col("q1") - reach * (F.col("q3") - F.col("q1")), F.col("q3") + reach * (F.col("q3") - F.col("q1"))
    inside = (v >= low) & (v <= high)
    counts = df.filter(v.isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    return (
        match(counts, q, by)
        .groupBy(*by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
        )
    )


def shares(df: DataFrame, column: str) -> DataFrame:
    """Count and share of every category."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / df.agg(F.count(F.lit(1))).scalar())


def first_label(df: DataFrame, key: str, t: str, column: str) -> DataFrame:
    """Value of the earliest row per entity."""
    return df.groupBy(key).agg(F.min_by(column, t).alias(column))


def minmax_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (signal, lowest, highest); negative cells are left out of the minimum only."""
    row = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("signal"),
                    F.min(F.when(F.col(c) >= 0, F.col(c))).cast("double").alias("lowest"),
                    F.max(c).cast("double").alias("highest"),
                )
                for c in columns
            ]
        ).alias("_r")
    )
    return row.select(F.inline("_r"))


def duration_stats(df: DataFrame, seconds: Column, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample std of a duration, in hours and days."""
    h = seconds / 3600.0
    return df.groupBy(*by).agg(
        F.avg(h).alias("mean_hours"),
        F.stddev_samp(h).alias("std_hours"),
        F.avg(h / 24).alias("mean_days"),
        F.stddev_samp(h / 24).alias("std_days"),
        F.min(h).alias("min_hours"),
        F.max(h).alias("max_hours"),
    )


def class_counts(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(flag) == 0).alias("n_0"),
        F.count_if(F.col(flag) == 1).alias("n_1"),
        F.sum(flag).alias("flag_sum"),
        F.count(F.lit(1)).alias("n"),
    )
