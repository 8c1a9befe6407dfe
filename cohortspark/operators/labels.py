"""Label functions: continuous risk labels and label bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.fixed import RISK_EXP, RISK_HOURS, RISK_LINE, RISK_RATE
from cohortspark.functions.scalars import case


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_hours(seconds: Column | str) -> Column:
    """Whole hours, rounded down (also below zero)."""
    return F.floor(_col(seconds) / F.lit(3600))


def label_continuous(delta_seconds: Column | str, positive: Column | str) -> Column:
    """Risk of a positive stay by the hours to its end: an exponential plus a line, never below 0; else 0."""
    h = whole_hours(delta_seconds)
    curve = F.lit(RISK_EXP) * F.exp(-RISK_RATE * h) + F.lit(RISK_LINE) * (1.0 - h / RISK_HOURS)
    return F.when(_col(positive) == 1, F.greatest(curve, F.lit(0.0))).otherwise(0.0)


def polynomial(x: Column | str, coefficients: Sequence[float]) -> Column:
    """Polynomial with the highest power first."""
    out = F.lit(0.0)
    for c in coefficients:
        out = out * _col(x) + F.lit(float(c))
    return out


def label_poly(delta_seconds: Column | str, positive: Column | str, coefficients: Sequence[float]) -> Column:
    """As ``label_continuous``, on a polynomial curve."""
    curve = polynomial(whole_hours(delta_seconds), coefficients)
    return F.when(_col(positive) == 1, F.greatest(curve, F.lit(0.0))).otherwise(0.0)


def curve_error(df: DataFrame, curve: Column, columns: Sequence[str]) -> DataFrame:
    """Mean absolute difference of a curve and the row mean of the columns."""
    mean = sum((F.col(c) for c in columns[1:]), F.col(columns[0])) / len(columns)
    return df.agg(F.avg(F.abs(mean - curve)).alias("mean_abs_error"))


def label_bins(n: int) -> list[tuple[float, float]]:
    """Bounds of n label bins on [0, 1], cut half-way between the labels i / (n - 1)."""
    cuts = [(2 * i + 1) / (2 * (n - 1)) for i in range(n - 1)]
    return list(zip([0.0, *cuts], [*cuts, 1.0]))


def assign_bin(y: Column | str, n: int) -> Column:
    """Bin of a label; bins are open on the left, so 0 (and anything outside) falls to bin 0."""
    y = _col(y)
    return case((((y > lo) & (y <= hi), F.lit(i)) for i, (lo, hi) in enumerate(label_bins(n))), F.lit(0))


def equal_bin(y: Column | str, n: int) -> Column:
    """Equal-width bin number; 1 falls to the last bin."""
    return F.least(F.floor(_col(y) * n), F.lit(n - 1)).cast("int")
