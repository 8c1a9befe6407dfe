"""Wide laboratory and vital-sign tables from long measurements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.fixed import (
    APPETITE_ITEM, APPETITE_LEVELS, BACTERIA_GROUPS, BACTERIA_ITEM, EXTRA_VITAL_RULES, LAB_BOUNDS, LAB_ITEMS,
    VITAL_RULES,
)
from cohortspark.functions.scalars import (
    clip_to_null, convert_units, drop_flagged, filter_items, map_items, ordinal_encode, text_to_code,
)
from cohortspark.operators.aggregates import median_cont, pivot_mean
from cohortspark.operators.joins import fuzzy_bounds, interval_join, lookup


def lab_means(labevents: DataFrame, by: Sequence[str] = ("subject_id",), with_bacteria: bool = True) -> DataFrame:
    """Mean of every laboratory signal per subject and time.  Filters and aggregation come before any join."""
    items = {code: label for code, label in LAB_ITEMS.items() if with_bacteria or label != "bacteria"}
    rows = labevents.filter(F.col("itemid").isin(list(items)))
    if with_bacteria:
        code = text_to_code("itemid", "value", "valuenum", BACTERIA_ITEM, BACTERIA_GROUPS)
        rows = rows.withColumn("valuenum", code)
    rows = filter_items(rows, "itemid", list(items), "valuenum")
    rows = rows.select(
        *by, "charttime", map_items("itemid", items).alias("label"),
        clip_to_null("itemid", "valuenum", LAB_BOUNDS).alias("valuenum"),
    )
    signals = list(dict.fromkeys(items.values()))
    return pivot_mean(rows, [*by, "charttime"], "label", "valuenum", {s: s for s in signals})


def pivoted_lab(labevents: DataFrame, stays: DataFrame, episodes: DataFrame | None = None) -> DataFrame:
    """Laboratory means with the stay they fall in (null outside stays) and, given episodes, its CKD flag."""
    intervals = stays.select("icustay_id", "subject_id", "intime", "outtime")
    out = interval_join(lab_means(labevents), intervals, "subject_id", "charttime", "intime", "outtime")
    out = out.drop("intime", "outtime")
    return lookup(out, episodes, "icustay_id", "ckd") if episodes is not None else out


def pivoted_lab_fuzzy(labevents: DataFrame, stays: DataFrame, admissions: DataFrame) -> DataFrame:
    """Laboratory means with admission and stay, both widened at their ends."""
    adm = fuzzy_bounds(
        admissions.select("subject_id", "hadm_id", "admittime", "dischtime"),
        "subject_id", "admittime", "dischtime", "hadm_id",
    ).drop("admittime", "dischtime")
    icu = fuzzy_bounds(
        stays.select("subject_id", "icustay_id", "intime", "outtime"), "subject_id", "intime", "outtime", "icustay_id"
    ).drop("intime", "outtime")
    rows = lab_means(labevents, with_bacteria=False)
    for intervals in (adm, icu):
        rows = interval_join(rows, intervals, "subject_id", "charttime", "data_start", "data_end")
        rows = rows.drop("data_start", "data_end")
    return rows


def pivoted_vital(chartevents: DataFrame, extra: bool = True, episodes: DataFrame | None = None) -> DataFrame:
    """Mean of every vital sign per stay and time; ``extra`` adds the kidney signals and the median appetite."""
    rules = {**VITAL_RULES, **(EXTRA_VITAL_RULES if extra else {})}
    items = [i for rs in rules.values() for r in rs for i in r.items] + ([APPETITE_ITEM] if extra else [])
    rows = drop_flagged(chartevents, "error", "icustay_id").filter(F.col("itemid").isin(items))
    cells = [F.avg(convert_units("itemid", "valuenum", rs)).alias(name) for name, rs in rules.items()]
    if extra:
        cells.append(median_cont(ordinal_encode("value", APPETITE_LEVELS)).alias("appetite_median"))
    out = rows.groupBy("icustay_id", "charttime").agg(*cells)
    return lookup(out, episodes, "icustay_id", "ckd") if episodes is not None else out


def long_stays(table: DataFrame, episodes: DataFrame, days: float = 4) -> DataFrame:
    """Rows of stays of at least ``days`` days."""
    ids = episodes.filter(F.col("los_icu") >= days).select("icustay_id")
    return table.join(ids, "icustay_id", "left_semi")
