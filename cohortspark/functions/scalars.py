"""Column functions for cleaning and coding measurements.  All are plain expressions that stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.grouped import from_micros, micros

HOUR_US = 3_600_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


class Bound(NamedTuple):
    """Plausible range of an item; an end left at None is open, ``*_in`` says whether the end itself is kept."""

    low: float | None = None
    high: float | None = None
    low_in: bool = True
    high_in: bool = True

    def keeps(self, v: Column) -> Column:
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & ((v >= self.low) if self.low_in else (v > self.low))
        if self.high is not None:
            ok = ok & ((v <= self.high) if self.high_in else (v < self.high))
        return ok


class Rule(NamedTuple):
    """Items whose values inside ``bound`` become ``(value - shift) / scale``."""

    items: tuple
    bound: Bound
    shift: float = 0.0
    scale: float = 1.0


def case(pairs: Iterable[tuple[Column, Column]], default: Column | None = None) -> Column:
    """CASE WHEN over (condition, value) pairs."""
    out = None
    for condition, value in pairs:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    if out is None:
        return default if default is not None else F.lit(None)
    return out if default is None else out.otherwise(default)


def map_items(item: Column | str, mapping: Mapping[object, str], default: str | None = None) -> Column:
    """Label of an item code; several codes may share a label."""
    labels: dict[str, list] = {}
    for code, label in mapping.items():
        labels.setdefault(label, []).append(code)
    return case(
        ((_col(item).isin(codes), F.lit(label)) for label, codes in labels.items()),
        F.lit(default).cast("string"),
    )


def clip_to_null(item: Column | str, value: Column | str, bounds: Mapping[object, Bound]) -> Column:
    """The value, or null when it lies outside its item's plausible range; items without a bound pass."""
    item, value = _col(item), _col(value)
    same: dict[Bound, list] = {}
    for code, bound in bounds.items():
        same.setdefault(bound, []).append(code)
    bad = [(item.isin(codes) & ~bound.keeps(value), F.lit(None).cast("double")) for bound, codes in same.items()]
    return case(bad, value)


def convert_units(item: Column | str, value: Column | str, rules: Sequence[Rule]) -> Column:
    """Value in the common unit of its rule; null when no rule covers the item or the value is implausible."""
    item, value = _col(item), _col(value)
    return case(
        (
            item.isin(list(r.items)) & r.bound.keeps(value),
            value if (r.shift, r.scale) == (0.0, 1.0) else (value - r.shift) / r.scale,
        )
        for r in rules
    )


def ordinal_encode(column: Column | str, levels: Sequence[str]) -> Column:
    """1 for the first level, 2 for the second, ...; null for other texts."""
    return case((_col(column) == level, F.lit(i)) for i, level in enumerate(levels, 1))


def text_to_code(
    item: Column | str, text: Column | str, value: Column | str, code: object, groups: Mapping[int, Sequence[str]]
) -> Column:
    """Overwrite the numeric value of one item by the class of its text; other items keep their value.

    Texts of that item outside every group give null.
    """
    classes = case(((_col(text).isin(list(texts)), F.lit(float(k))) for k, texts in groups.items()))
    return F.when(_col(item) == code, classes).otherwise(_col(value))


def group_category(column: Column | str, groups: Mapping[str, Sequence[str]], default: str = "other") -> Column:
    """Small category of a free-text category."""
    return case(
        ((_col(column).isin(list(texts)), F.lit(name)) for name, texts in groups.items()), F.lit(default)
    )


def filter_items(df: DataFrame, item: str, items: Sequence, value: str, positive: bool = True) -> DataFrame:
    """Rows of the listed items with a value (above zero); both tests reach the Parquet scan."""
    out = df.filter(F.col(item).isin(list(items)) & F.col(value).isNotNull())
    return out.filter(F.col(value) > 0) if positive else out


def drop_flagged(df: DataFrame, flag: str, episode: str, bad: int = 1) -> DataFrame:
    """Drop rows marked as errors or without an episode; a null mark is no error."""
    return df.filter((F.col(flag).isNull() | (F.col(flag) != bad)) & F.col(episode).isNotNull())


def event_in_interval(event: Column | str, start: Column | str, end: Column | str) -> tuple[Column, Column]:
    """(flag 0/1, event time or null) for an event inside the interval; both ends count."""
    inside = (_col(start) <= _col(event)) & (_col(event) <= _col(end))
    return F.when(inside, 1).otherwise(0), F.when(inside, _col(event))


def concat_label(a: Column | str, b: Column | str) -> Column:
    """Text of ``a`` followed by ``b``."""
    return F.concat(_col(a).cast("string"), _col(b).cast("string"))


def bin_column(
    column: Column | str, edges: Sequence[float], labels: Sequence[str] | None = None, right: bool = True
) -> Column:
    """Bin label (or bin number) by edges; values outside the edges give null.

    ``right=True`` bins are open on the left and closed on the right, ``right=False`` the other way round.
    """
    v = _col(column)
    out = []
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        inside = ((v > lo) & (v <= hi)) if right else ((v >= lo) & (v < hi))
        out.append((inside, F.lit(labels[i] if labels else i)))
    return case(out)


def select_signals(df: DataFrame, keys: Sequence[str], signals: Sequence[str]) -> DataFrame:
    return df.select(*keys, *signals)


def exclude_categories(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Drop rows of the listed categories; rows without a category stay."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(list(values)))


def drop_sparse_columns(df: DataFrame, max_null_fraction: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop columns with more than ``max_null_fraction`` nulls; one aggregate row decides for all columns."""
    columns = list(columns or df.columns)
    share = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if share[c] is not None and share[c] > max_null_fraction])


def round_hour(ts: Column | str) -> Column:
    """Nearest full hour; an exact half goes to the even hour."""
    us = micros(ts)
    hours = F.floor(us / F.lit(HOUR_US)).cast("bigint")
    rest = us - hours * HOUR_US
    half = F.lit(HOUR_US // 2)
    up = (rest > half) | ((rest == half) & (hours % 2 != 0))
    return from_micros((hours + up.cast("bigint")) * HOUR_US)


def sentinel_to_null(column: Column | str, sentinel: float = -1) -> Column:
    return F.nullif(_col(column), F.lit(sentinel))


def null_to_sentinel(column: Column | str, sentinel: float = -1) -> Column:
    return F.coalesce(_col(column), F.lit(sentinel))
