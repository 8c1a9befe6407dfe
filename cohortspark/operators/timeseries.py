"""Regular series: resampling, gap filling, observation windows, fixed lengths and panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators import grouped
from cohortspark.operators.aggregates import column_medians, medians_apart
from cohortspark.operators.grouped import fill, from_micros, match, micros, number_rows, previous_next
from cohortspark.operators.windows import head_per_group

HOUR_US = 3_600_000_000


def _grid(df: DataFrame, key: str, t: str, step_hours: float, origin: str, target: int) -> tuple[DataFrame, int]:
    """One row per entity: the grid's origin, and whether its rows or steps are more than ``target``."""
    step = int(step_hours * HOUR_US)
    lo, hi = micros(F.min(t)), micros(F.max(t))
    steps = (F.floor((hi - lo) / F.lit(step)) + 1) if origin == "start" else (F.ceil((hi - lo) / F.lit(step)) + 1)
    edges = df.filter(F.col(t).isNotNull()).groupBy(key)
    large = (steps > target) | (F.count(F.lit(1)) > target)
    return edges.agg((lo if origin == "start" else hi).alias("_origin"), large.alias("_large")), step


def resample(
    df: DataFrame,
    key: str,
    t: str,
    step_hours: float,
    columns: Sequence[str],
    origin: str = "start",
    fill_gaps: bool = False,
    target_rows: int | None = None,
) -> DataFrame:
    """Median per step of every entity's own grid; steps without rows are emitted with nulls.

    ``origin='start'`` lays the grid from the entity's first time, with steps closed on the left and named by their
    start; ``origin='end'`` lays it back from the last time, closed on the right and named by their end.  Missing steps
    are written out from each step to the next one present, so no grid table is built or joined.
    ``fill_gaps`` adds the forward, then backward fill in the same partitioning.
    """
    target = target_rows or grouped.TARGET_ROWS
    bounds, step = _grid(df, key, t, step_hours, origin, target)
    large = F.col("_large")
    rows = df.filter(F.col(t).isNotNull()).select(key, micros(t).alias("_us"), *columns)
    steps_away = (F.col("_us") - F.col("_origin")) / F.lit(step)
    no = F.floor(steps_away) if origin == "start" else F.ceil(steps_away)

    def numbered(ends: DataFrame) -> DataFrame:
        return rows.join(ends, key).withColumn("_bin", no.cast("bigint")).drop("_us")

    few = numbered(bounds).filter(~large)
    # an entity is large by a target's worth of rows read or written, which bounds their number; where there is none the
    # broadcast comes out empty, and what follows from it is not run
    many = numbered(F.broadcast(bounds.filter(large)))
    binned = medians_apart(few, many, [key, "_origin", "_large", "_bin"], columns, target_rows)

    def pieces(number: str) -> tuple[Column, Column]:
        """A grid has at most one row per step, so equal lengths of it bound every piece."""
        return F.floor(F.col(number) / F.lit(target)), large

    binned = previous_next(binned, [key], "_bin", following={"_next": "_bin"}, split=pieces("_bin"))
    until = F.coalesce(F.col("_next") - 1, F.col("_bin"))
    out = binned.withColumn("_step", F.explode(F.sequence(F.col("_bin"), until)))
    here = F.col("_step") == F.col("_bin")
    out = out.select(
        key, "_origin", "_large", "_step", *[F.when(here, F.col(c)).alias(c) for c in columns]
    )
    if fill_gaps:
        out = fill(out, [key], "_step", columns, split=pieces("_step"))
    return out.select(key, from_micros(F.col("_origin") + F.col("_step") * step).alias(t), *columns)


def fill_values(df: DataFrame, values: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill the nulls left from a one-row frame of values."""
    row = values.select(F.struct(*columns)).scalar()
    out = df.withColumn("_fill", row)
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_fill.{c}")) for c in columns}).drop("_fill")


def resample_filled(
    df: DataFrame, key: str, t: str, step_hours: float, columns: Sequence[str], rest: str = "sentinel",
    sentinel: float = -1.0, target_rows: int | None = None,
) -> DataFrame:
    """Resample, fill forward then backward, then fill what is left by a sentinel or the column's overall median."""
    out = resample(df, key, t, step_hours, columns, fill_gaps=True, target_rows=target_rows)
    if rest == "sentinel":
        return out.na.fill(sentinel, list(columns))
    medians = column_medians(resample(df, key, t, step_hours, columns, target_rows=target_rows), columns, target_rows)
    return fill_values(out, medians, columns)


def observation_window(
    series: DataFrame, stays: DataFrame, key: str, t: str, start: str, hours: float, end: str | None = None
) -> DataFrame:
    """Rows before ``start + hours`` of the entity's stay, with ``predtime`` (and the horizon when ``end`` is given)."""
    stays = prediction_time(stays, start, hours, end)
    names = ["predtime"] + (["delta_t_pred"] if end else [])
    return series.join(stays.select(key, *names), key).filter(F.col(t) < F.col("predtime"))


def prediction_time(stays: DataFrame, start: str, hours: float, end: str | None = None) -> DataFrame:
    """Add ``predtime = start + hours`` and, with ``end``, the horizon ``delta_t_pred`` in seconds."""
    out = stays.withColumn("predtime", from_micros(micros(start) + F.lit(int(hours * HOUR_US))))
    if end:
        out = out.withColumn("delta_t_pred", F.floor((micros(end) - micros("predtime")) / F.lit(1_000_000)))
    return out


def restrict_observed(stays: DataFrame, sources: Sequence[DataFrame], key: str) -> DataFrame:
    """Stays with rows in at least one source; every source is reduced to ids before the semi join."""
    ids = sources[0].select(key)
    for s in sources[1:]:
        ids = ids.unionByName(s.select(key))
    return stays.join(ids.distinct(), key, "left_semi")


def fix_length(
    df: DataFrame, key: str, t: str, step_hours: float, n: int | None, columns: Sequence[str], label: str | None = None
) -> DataFrame:
    """Exactly n rows per entity: the first n, or all plus rows of null signals at the following steps.

    Without n, the longest series sets the length, so no row is cut.
    """
    keep = [key, t, *([label] if label else []), *columns]
    head = df.select(*keep) if n is None else head_per_group(df.select(*keep), key, t, n)
    first = [F.min_by(label, t).alias(label)] if label else []
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max(t).alias("_last"), *first)
    length = counts.agg(F.max("_n")).scalar() if n is None else F.lit(n)
    step = int(step_hours * HOUR_US)
    added = (
        counts.withColumn("_to", length)
        .filter(F.col("_n") < F.col("_to"))
        .withColumn("_i", F.explode(F.sequence(F.lit(1), (F.col("_to") - F.col("_n")).cast("int"))))
        .withColumn(t, from_micros(micros("_last") + F.col("_i") * step))
        .select(
            key, t, *([label] if label else []),
            *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns],
        )
    )
    return head.unionByName(added)


def to_panel(df: DataFrame, key: str, t: str, columns: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """One row per entity with ``panel``: channels by steps.  Meant for series of fixed length."""
    steps = F.array_sort(F.collect_list(F.struct(t, *[F.col(c).cast("double").alias(c) for c in columns])))
    keep = [F.min_by(c, t).alias(c) for c in extra]
    rows = df.groupBy(key).agg(steps.alias("_steps"), *keep)
    return rows.select(key, *extra, F.array(*[F.col("_steps")[c] for c in columns]).alias("panel"))


def pad_panel(panel: Column | str, n: int, value: float = 0.0) -> Column:
    """Every channel cut or padded to n steps."""
    col = F.col(panel) if isinstance(panel, str) else panel
    return F.transform(col, lambda ch: F.slice(F.concat(ch, F.array_repeat(F.lit(float(value)), n)), 1, n))


def pad_ragged(df: DataFrame, panel: str, value: float = -2.0) -> DataFrame:
    """Every channel padded with a mask value to the longest series of the frame."""
    longest = df.agg(F.max(F.size(F.element_at(panel, 1)))).scalar()
    out = df.withColumn("_len", longest)
    padded = F.transform(
        panel, lambda ch: F.concat(ch, F.array_repeat(F.lit(float(value)), F.col("_len") - F.size(ch)))
    )
    return out.withColumn(panel, padded).drop("_len")


def ragged_batches(
    df: DataFrame, client: str, key: str, panel: str, batch_size: int, value: float = -2.0
) -> DataFrame:
    """Batches of series of similar length: ``batch`` numbers them per client, ``length`` is the own length.

    Series are ranked by (length, key) inside their client and padded with the mask value to the longest of their
    batch only, so a long series costs its own batch.  A client may be of any size: ranks are taken in pieces.
    """
    sized = df.withColumn("length", F.size(F.element_at(panel, 1)))
    ranked = number_rows(sized.select(client, key, "length"), [client], "length", "_rank", [key])
    size = F.lit(batch_size)
    batches = ranked.withColumn("batch", F.floor((F.col("_rank") - 1) / size).cast("bigint"))
    longest = batches.groupBy(client, "batch").agg(F.max("length").alias("_longest"))
    placed = match(batches.select(client, key, "batch"), longest, [client, "batch"], "inner")
    out = match(sized, placed, [client, key], "inner")
    fill = F.array_repeat(F.lit(float(value)), F.col("_longest") - F.col("length"))
    return out.withColumn(panel, F.transform(panel, lambda ch: F.concat(ch, fill))).drop("_longest")


def padding_share(batches: DataFrame, by: Sequence[str], panel: str, length: str) -> DataFrame:
    """Per batch its series, steps, cells and the share of cells that are padding."""
    cells = F.sum(F.size(F.element_at(panel, 1)))
    return batches.groupBy(*by).agg(
        F.count(F.lit(1)).alias("series"), F.sum(length).alias("steps"), cells.alias("cells"),
        (1 - F.sum(length) / cells).alias("padding"),
    )


def flatten_panel(panel: Column | str) -> Column:
    return F.flatten(panel)


def unflatten_panel(flat: Column | str, channels: int, steps: int | None = None) -> Column:
    """Channels of ``steps`` values each; without it, the array is cut evenly."""
    col = F.col(flat) if isinstance(flat, str) else flat
    steps = F.lit(steps) if steps else F.floor(F.size(col) / channels).cast("int")
    return F.transform(F.sequence(F.lit(0), F.lit(channels - 1)), lambda i: F.slice(col, i * steps + 1, steps))


def series_quality(df: DataFrame, key: str, t: str, n: int, max_days: int = 4) -> DataFrame:
    """One row: entities with fewer, exactly and more than n rows, with too long spans, and with duplicate rows."""
    row_counts = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    per = row_counts.groupBy(key).agg(
        F.sum("_c").alias("_n"),
        (F.sum("_c") - F.count(F.lit(1))).alias("_dup"),
        F.floor((micros(F.max(t)) - micros(F.min(t))) / F.lit(24 * HOUR_US)).alias("_days"),
    )
    return per.agg(
        F.count_if(F.col("_n") < n).alias("fewer"),
        F.count_if(F.col("_n") == n).alias("exact"),
        F.count_if(F.col("_n") > n).alias("more"),
        F.count_if(F.col("_days") > max_days).alias("long_span"),
        F.count_if(F.col("_dup") > 0).alias("with_duplicates"),
        F.sum("_dup").alias("duplicate_rows"),
        F.count_distinct("_n").alias("distinct_lengths"),
    )
