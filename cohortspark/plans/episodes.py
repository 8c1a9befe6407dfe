"""Episode table: one row per stay with subject, sequence numbers, in-stay death and comorbidity flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.datetimes import datetime_diff
from cohortspark.functions.fixed import CODE_SETS, ETHNICITY_GROUPS
from cohortspark.functions.scalars import event_in_interval, group_category
from cohortspark.operators.joins import flag_by_max, flag_codes, star_join
from cohortspark.operators.windows import sequence_episodes


def episode_detail(
    stays: DataFrame, admissions: DataFrame, patients: DataFrame, diagnoses: DataFrame | None = None
) -> DataFrame:
    """Stays of admissions with charted data; with ``diagnoses`` also the four comorbidity flags.

    The coronary flag is null for an admission without any diagnosis, the other flags are 0.
    """
    charted = admissions.filter(F.col("has_chartevents_data") == 1)
    rows = star_join(stays, charted, patients, "hadm_id", "subject_id")
    rows = sequence_episodes(rows, "subject_id", "admittime", "hospstay_seq", "first_hosp_stay")
    rows = sequence_episodes(rows, "hadm_id", "intime", "icustay_seq", "first_icu_stay_current_hosp")
    rows = sequence_episodes(rows, "subject_id", "intime", "_seq", "first_icu_stay_patient")
    died, when = event_in_interval("deathtime", "intime", "outtime")
    out = rows.select(
        "subject_id", "hadm_id", "icustay_id", "gender", "dod", "admittime", "dischtime",
        datetime_diff("dischtime", "admittime", "DAY").alias("los_hospital"),
        datetime_diff("intime", "dob", "YEAR").alias("admission_age"),
        "ethnicity",
        group_category("ethnicity", ETHNICITY_GROUPS).alias("ethnicity_grouped"),
        "hospital_expire_flag", "hospstay_seq", "first_hosp_stay", "intime", "outtime",
        datetime_diff("outtime", "intime", "DAY").alias("los_icu"),
        "icustay_seq", "first_icu_stay_current_hosp", "first_icu_stay_patient", "first_careunit",
        when.alias("deathtime_icu"),
        died.alias("label_death_icu"),
    )
    if diagnoses is None:
        return out
    out = flag_by_max(out, diagnoses, "hadm_id", "icd9_code", CODE_SETS["label_cor_art"], "label_cor_art")
    others = {name: codes for name, codes in CODE_SETS.items() if name != "label_cor_art"}
    return flag_codes(out, diagnoses, "hadm_id", "icd9_code", others)
