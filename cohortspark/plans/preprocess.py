"""From wide tables to regular, filled and labelled series of a cohort.

Every step that later steps read more than once is written as a stage table first.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.fixed import CHILD_UNITS
from cohortspark.functions.scalars import round_hour
from cohortspark.operators.cohort import exclude, max_stay, min_coverage, min_stay
from cohortspark.operators.joins import align_timelines, attach_label, keep_ids, lookup
from cohortspark.operators.labels import label_continuous
from cohortspark.operators.timeseries import observation_window, prediction_time, resample_filled, restrict_observed
from cohortspark.operators.windows import ffill_bfill
from cohortspark.session import staged

KEY, T = "icustay_id", "charttime"


class Cohort(NamedTuple):
    demographics: DataFrame
    vitals: DataFrame
    labs: DataFrame


def mortality_cohort(episodes: DataFrame, vitals: DataFrame, labs: DataFrame, hours: float) -> Cohort:
    """First stays of adults, long enough and with enough data in vitals and labs together."""
    stays = min_stay(exclude(episodes.filter(F.col("first_icu_stay_patient")), "first_careunit", CHILD_UNITS), "los_icu", hours)
    return _covered(stays, vitals, labs, hours)


def ckd_cohort(episodes: DataFrame, vitals: DataFrame, labs: DataFrame, hours: float, coverage_hours: float | None = None) -> Cohort:
    """Stays long enough and with enough data; ``coverage_hours`` defaults to the window."""
    return _covered(min_stay(episodes, "los_icu", hours), vitals, labs, coverage_hours or hours)


def _covered(stays: DataFrame, vitals: DataFrame, labs: DataFrame, hours: float) -> Cohort:
    ids = stays.select(KEY).distinct()
    vitals, labs = keep_ids(vitals, ids, KEY).distinct(), keep_ids(labs, ids, KEY).distinct()
    covered = min_coverage([vitals, labs], KEY, T, hours)
    covered = staged(covered)
    return Cohort(*(staged(keep_ids(df, covered, KEY)) for df in (stays, vitals, labs)))


def regular_series(
    cohort: Cohort, vital_signals: Sequence[str], lab_signals: Sequence[str], rest: str = "sentinel"
) -> Cohort:
    """Vitals per hour and labs per eight hours on one shared timeline, filled.

    Both sources first get the union of their times, rounded to the hour, so their grids start together.
    """
    vitals = cohort.vitals.select(KEY, T, *vital_signals)
    labs = cohort.labs.select(KEY, T, *lab_signals)
    vitals, labs = align_timelines(vitals, labs, [KEY, T])
    vitals, labs = (staged(df.withColumn(T, round_hour(T))) for df in (vitals, labs))
    return Cohort(
        cohort.demographics,
        staged(resample_filled(vitals, KEY, T, 1, vital_signals, rest)),
        staged(resample_filled(labs, KEY, T, 8, lab_signals, rest)),
    )


def windowed(cohort: Cohort, hours: float) -> Cohort:
    """Series before the prediction time, and the stays that still have rows."""
    stays = cohort.demographics
    vitals, labs = (
        staged(observation_window(df, stays, KEY, T, "intime", hours, "outtime"))
        for df in (cohort.vitals, cohort.labs)
    )
    return Cohort(
        restrict_observed(prediction_time(stays, "intime", hours, "outtime"), [vitals, labs], KEY), vitals, labs
    )


def mortality_labels(cohort: Cohort, hours: float, horizon_hours: float = 48) -> Cohort:
    """Stays within the horizon, windowed, with the binary and the continuous label on stays and series."""
    short = max_stay(cohort.demographics, "los_icu", hours, horizon_hours)
    out = windowed(Cohort(short, cohort.vitals, cohort.labs), hours)
    stays = out.demographics.withColumn(
        "label_death_continuous", label_continuous("delta_t_pred", "label_death_icu")
    )
    names = ["label_death_icu", "label_death_continuous"]
    return Cohort(stays, *(attach_label(df, stays, KEY, names) for df in (out.vitals, out.labs)))


def ckd_labels(cohort: Cohort, hours: float, vital_signals: Sequence[str]) -> Cohort:
    """Windowed series with the CKD flag of the stay; vitals are filled once more inside the window."""
    out = windowed(cohort, hours)
    vitals = ffill_bfill(out.vitals, KEY, T, list(vital_signals)).na.fill(-1.0, list(vital_signals))
    return Cohort(
        out.demographics, *(lookup(df, out.demographics, KEY, "ckd") for df in (vitals, out.labs))
    )
