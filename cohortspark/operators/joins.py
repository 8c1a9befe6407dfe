"""Joins between measurements, episodes and cohorts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.datetimes import datetime_add, datetime_diff, datetime_sub, seconds
from cohortspark.operators.grouped import previous_next


NULL_PIECES = 1024  # over how many keys rows without an id are dealt


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    key: str,
    t: str,
    start: str,
    end: str,
    how: str = "left",
    bucket_days: int | None = None,
) -> DataFrame:
    """Points joined to the intervals of the same subject with ``start <= t < end``.

    Every interval is listed once per bucket of days it touches and a point looks only into its own bucket, so the
    equi-join key is (subject, bucket): a subject with a long history is spread over many tasks.  A point lies in one
    bucket, so no match is found twice.  Unless given, a bucket is as long as the mean interval: then n intervals
    of any lengths touch at most 3 n buckets, since their lengths add up to n buckets and each touches at most two more.
    """
    if how not in ("left", "inner"):
        raise ValueError("an interval is listed once per bucket, so only left and inner joins keep its rows right")
    real = intervals.filter(F.col(start) < F.col(end))
    # the last moment inside the interval
    last = F.col(end) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001))

    def day(ts: Column) -> Column:
        return F.unix_date(ts.cast("date")).cast("bigint")

    if bucket_days:
        size = F.lit(bucket_days).cast("bigint")
    else:
        total = F.sum(day(last) - day(F.col(start)) + 1)
        size = F.coalesce(real.agg(F.ceil(total / F.count(F.lit(1))).cast("bigint")).scalar(), F.lit(1).cast("bigint"))

    def bucket(ts: Column) -> Column:
        return F.floor(day(ts) / F.col("_size")).cast("bigint")

    listed = (
        real.withColumnRenamed(key, "_key")
        .withColumn("_size", size)
        .withColumn("_bucket", F.explode(F.sequence(bucket(F.col(start)), bucket(last))))
        .drop("_size")
    )
    located = points.withColumn("_size", size).withColumn("_at", bucket(F.col(t))).drop("_size")
    on = (
        (F.col(key) == F.col("_key"))
        & (F.col("_at") == F.col("_bucket"))
        & (F.col(t) >= F.col(start))
        & (F.col(t) < F.col(end))
    )
    return located.join(listed, on, how).drop("_key", "_bucket", "_at")


def fuzzy_bounds(
    intervals: DataFrame,
    key: str,
    start: str,
    end: str,
    id_column: str,
    pad_hours: float = 12,
    merge_hours: float = 24,
    target_rows: int | None = None,
) -> DataFrame:
    """``data_start`` / ``data_end``: the interval widened by ``pad_hours``.

    Where the neighbouring interval of the subject is nearer than ``merge_hours`` the bound lies half-way to it,
    in whole seconds (halves are rounded up).
    """
    out = previous_next(
        intervals, [key], start, {"_prev_end": end}, {"_next_start": start}, ties=[id_column], target_rows=target_rows
    )
    half_back = F.round(datetime_diff(start, "_prev_end", "SECOND") / 2)
    half_ahead = F.round(datetime_diff("_next_start", end, "SECOND") / 2)
    near_prev = F.col("_prev_end") > datetime_sub(start, merge_hours, "HOUR")
    near_next = F.col("_next_start") < datetime_add(end, merge_hours, "HOUR")
    return out.withColumns(
        {
            "data_start": F.when(near_prev, F.col(start) - seconds(half_back)).otherwise(
                datetime_sub(start, pad_hours, "HOUR")
            ),
            "data_end": F.when(near_next, F.col(end) + seconds(half_ahead)).otherwise(
                datetime_add(end, pad_hours, "HOUR")
            ),
        }
    ).drop("_prev_end", "_next_start")


def star_join(
    stays: DataFrame, admissions: DataFrame, patients: DataFrame, admission_key: str, patient_key: str
) -> DataFrame:
    """Stays with their admission and patient; columns named alike are kept from the stay."""
    adm = admissions.drop(*[c for c in admissions.columns if c in stays.columns and c != admission_key])
    pat = patients.drop(
        *[c for c in patients.columns if (c in stays.columns or c in adm.columns) and c != patient_key]
    )
    return stays.join(adm, admission_key).join(pat, patient_key)


def flag_codes(
    df: DataFrame, diagnoses: DataFrame, on: str, code: str, sets: Mapping[str, Sequence], as_int: bool = True
) -> DataFrame:
    """One flag per code set: does the admission have a code of the set?  Admissions without codes get 0.

    All sets share one aggregate and one join; only diagnoses of some set are shuffled.
    """
    listed = sorted({c for codes in sets.values() for c in codes})
    found = (
        diagnoses.filter(F.col(code).isin(listed))
        .groupBy(on)
        .agg(*[F.max(F.col(code).isin(list(codes))).alias(f"_f_{name}") for name, codes in sets.items()])
    )
    out = df.join(found, on, "left")
    flags = {}
    for name in sets:
        flag = F.coalesce(F.col(f"_f_{name}"), F.lit(False))
        flags[name] = flag.cast("int") if as_int else flag
    return out.withColumns(flags).drop(*[f"_f_{name}" for name in sets])


def flag_by_max(df: DataFrame, diagnoses: DataFrame, on: str, code: str, codes: Sequence, name: str) -> DataFrame:
    """Highest flag of the admission's codes; an admission without any code gets null, not 0."""
    top = diagnoses.groupBy(on).agg(F.max(F.col(code).isin(list(codes)).cast("int")).alias(name))
    return df.join(top, on, "left")


def keep_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids, key, "left_semi")


def restrict_to_ids(df: DataFrame, ids: DataFrame, key: str, keep_missing: bool = True) -> DataFrame:
    """Distinct rows of the listed ids; an id without data stays as a row of nulls."""
    listed = ids.select(key).distinct()
    how = "left" if keep_missing else "inner"
    return listed.join(df, key, how).select(*df.columns).distinct()


def intersect_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def except_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def union_ids(frames: Sequence[DataFrame], key: str) -> DataFrame:
    out = frames[0].select(key)
    for f in frames[1:]:
        out = out.unionByName(f.select(key))
    return out.distinct()


def align_timelines(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames on the union of their (entity, time) rows; missing signals are null."""
    times = a.select(*keys).unionByName(b.select(*keys)).distinct()
    return times.join(a, list(keys), "left"), times.join(b, list(keys), "left")


def lookup(df: DataFrame, dim: DataFrame, key: str, column: str, name: str | None = None) -> DataFrame:
    """Value of ``column`` for the row's id (of several the smallest), so no row is multiplied.

    Rows without an id find nothing; they are dealt by a hash of the row, not all to one task.
    """
    name = name or column
    side = dim.groupBy(F.col(key).alias("_key")).agg(F.min(column).alias(name)).withColumn("_deal", F.lit(0))
    deal = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_PIECES))).otherwise(0).cast("int")
    on = (F.col(key) == F.col("_key")) & (F.col("_row_deal") == F.col("_deal"))
    return df.withColumn("_row_deal", deal).join(side, on, "left").select(*df.columns, name)


def update_from(df: DataFrame, other: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Add columns from ``other`` by key.  ``other`` is reduced to one row per key, so rows never multiply."""
    row = F.struct(*columns)
    side = other.groupBy(key).agg(F.min(row).alias("_row")).select(key, "_row.*")
    return df.drop(*columns).join(side, key, "left")


def merge_features(blocks: Sequence[DataFrame], on: str) -> DataFrame:
    """Feature blocks that share the id, joined where every block has it."""
    out = blocks[0]
    for b in blocks[1:]:
        out = out.join(b, on)
    return out


def attach_label(series: DataFrame, labels: DataFrame, on: str, columns: Sequence[str]) -> DataFrame:
    """Labels with the rows of their series; a labelled id without rows keeps one row of null signals."""
    return labels.select(on, *columns).join(series, on, "left")


def outer_merge(a: DataFrame, b: DataFrame, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer join; columns present on both sides get a suffix."""
    both = [c for c in a.columns if c in b.columns and c not in on]
    for c in both:
        a = a.withColumnRenamed(c, c + suffixes[0])
        b = b.withColumnRenamed(c, c + suffixes[1])
    return a.join(b, list(on), "full")


def missing_ids(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Rows (present_in, missing_from, id) for every ordered pair of tables."""
    bits = {name: 1 << i for i, name in enumerate(frames)}
    parts = [f.select(key, F.lit(bits[name]).alias("_in")) for name, f in frames.items()]
    tagged = parts[0]
    for part in parts[1:]:
        tagged = tagged.unionByName(part)
    pairs = [(a, b) for a in bits for b in bits if a != b]
    listed = F.array(
        *[
            F.when(
                (F.col("_in").bitwiseAND(bits[a]) != 0) & (F.col("_in").bitwiseAND(bits[b]) == 0),
                F.struct(F.lit(a).alias("present_in"), F.lit(b).alias("missing_from")),
            )
            for a, b in pairs
        ]
    )
    seen = tagged.groupBy(key).agg(F.bit_or("_in").alias("_in"))
    return seen.select(key, F.explode(listed).alias("_p")).filter("_p is not null").select("_p.*", key)
