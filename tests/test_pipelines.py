"""The whole chain on a small made-up ward, checked against pandas where the result is easy to state."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortspark.functions.fixed import CKD_LABS, CKD_VITALS, LAB_ITEMS, MORTALITY_LABS, MORTALITY_VITALS
from cohortspark.plans import federated, multimodal
from cohortspark.plans import preprocess as pp
from cohortspark.plans.episodes import episode_detail
from cohortspark.plans.pivots import long_stays, pivoted_lab, pivoted_lab_fuzzy, pivoted_vital

START = dt.datetime(2150, 1, 1)
SUBJECTS = 30


def ntz(df):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n, k in df.dtypes if k == "timestamp"})


@pytest.fixture(scope="module")
def ward(spark):
    rng = np.random.default_rng(11)
    stays, adm, pat, diag, lab, chart = [], [], [], [], [], []
    codes = {v: k for k, v in LAB_ITEMS.items()}
    chart_items = {"heartrate": 211, "sysbp": 51, "diasbp": 8368, "meanbp": 456, "resprate": 615, "tempc": 223762,
                   "spo2": 646, "glucose": 807, "rbc": 3799, "specificgravity": 227471}
    for s in range(SUBJECTS):
        pat.append((s, "FM"[s % 2], START - dt.timedelta(days=365 * (20 + s)), None))
        begin = START + dt.timedelta(days=s, minutes=17 * s)
        for n in range(1 + (s % 3 == 0)):
            hadm, stay = 100 + 10 * s + n, 1000 + 10 * s + n
            intime = begin + dt.timedelta(days=20 * n)
            outtime = intime + dt.timedelta(hours=110 if s % 5 else 30)
            death = outtime - dt.timedelta(hours=1) if s % 4 == 0 else None
            adm.append((s, hadm, intime - dt.timedelta(hours=2), outtime + dt.timedelta(hours=3), death,
                        ["WHITE", "ASIAN - THAI", "MARTIAN"][s % 3], int(death is not None), int(s != 29)))
            stays.append((s, hadm, stay, intime, outtime, "NICU" if s == 7 else "MICU"))
            if s != 5:
                diag.append((s, hadm, "5859" if s % 2 == 0 else "99999"))
                diag.append((s, hadm, "25000" if s % 3 == 0 else "41401"))
            hours = int((outtime - intime).total_seconds() // 3600)
            for h in range(0, hours, 1):
                t = intime + dt.timedelta(hours=h, minutes=int(rng.integers(0, 50)))
                for name, item in chart_items.items():
                    if rng.random() < 0.5:
                        chart.append((stay, item, t, None, float(rng.uniform(11, 12.5) if name == "rbc" else rng.uniform(40, 49)), None))
                if h % 6 == 0:
                    chart.append((stay, 225120, t, ["Poor", "Good", "?"][h // 6 % 3], None, None))
                    chart.append((stay, 211, t, None, 250.0, 1))
                    for name, item in codes.items():
                        if name == "bacteria":
                            lab.append((s, hadm, item, t, ["FEW", "NEG", "??"][h // 6 % 3], None))
                        elif rng.random() < 0.7:
                            lab.append((s, hadm, item, t, None, float(rng.uniform(1, 9) + 3 * (s % 2))))
    ts = "timestamp_ntz"
    make = spark.createDataFrame
    tables = {
        "stays": make(stays, f"subject_id long, hadm_id long, icustay_id long, intime {ts}, outtime {ts}, first_careunit string"),
        "admissions": make(adm, f"subject_id long, hadm_id long, admittime {ts}, dischtime {ts}, deathtime {ts}, ethnicity string, hospital_expire_flag int, has_chartevents_data int"),
        "patients": make(pat, f"subject_id long, gender string, dob {ts}, dod {ts}"),
        "diagnoses": make(diag, "subject_id long, hadm_id long, icd9_code string"),
        "lab": make(lab, f"subject_id long, hadm_id long, itemid int, charttime {ts}, value string, valuenum double"),
        "chart": make(chart, f"icustay_id long, itemid int, charttime {ts}, value string, valuenum double, error int"),
    }
    return {k: v.cache() for k, v in tables.items()}


@pytest.fixture(scope="module")
def episodes(ward):
    return episode_detail(ward["stays"], ward["admissions"], ward["patients"], ward["diagnoses"]).cache()


@pytest.fixture(scope="module")
def wide(ward, episodes):
    return pivoted_vital(ward["chart"], episodes=episodes).cache(), pivoted_lab(ward["lab"], ward["stays"], episodes).cache()


def test_episode_detail(ward, episodes):
    pdf = episodes.toPandas().set_index("icustay_id")
    assert len(pdf) == ward["stays"].filter("subject_id != 29").count()
    assert pdf.loc[1001 + 0, "hospstay_seq"] == 2 and not pdf.loc[1001, "first_icu_stay_patient"]
    assert pdf.loc[1000, "first_hosp_stay"] and pdf.loc[1000, "icustay_seq"] == 1
    assert pdf.loc[1000, "label_death_icu"] == 1 and pdf.loc[1010, "label_death_icu"] == 0
    assert pdf.loc[1010, "los_icu"] == pytest.approx(110 / 24)
    assert pdf.loc[1010, "admission_age"] == pytest.approx((365 * 21 + 1 + 17 / 1440) / 365.242)
    assert list(pdf.loc[[1000, 1010, 1020], "ethnicity_grouped"]) == ["white", "asian", "other"]
    assert pd.isna(pdf.loc[1050, "label_cor_art"]) and pdf.loc[1050, "ckd"] == 0
    assert pdf.loc[1000, "label_cor_art"] == 0 and pdf.loc[1010, "label_cor_art"] == 1
    assert pdf.loc[1000, "ckd"] == 1 and pdf.loc[1000, "diabetes_mellitus"] == 1 and pdf.loc[1000, "anemia_flag"] == 0


def test_pivots(ward, wide):
    vitals, labs = wide
    raw = ward["chart"].toPandas()
    hr = raw[(raw.itemid == 211) & raw.error.isna()].groupby(["icustay_id", "charttime"]).valuenum.mean()
    got = vitals.filter("heartrate IS NOT NULL").toPandas().set_index(["icustay_id", "charttime"]).heartrate
    pd.testing.assert_series_equal(got.sort_index(), hr.sort_index(), check_names=False)
    assert {r[0] for r in vitals.select("appetite_median").distinct().collect()} == {None, 1.0, 3.0}
    assert {r[0] for r in labs.select("bacteria").distinct().collect()} == {None, 1.0, 2.0}
    assert labs.filter("icustay_id IS NULL").count() == 0
    assert labs.count() == ward["lab"].filter("valuenum IS NOT NULL OR value = 'FEW' OR value = 'NEG'").select("subject_id", "charttime").distinct().count()
    assert set(CKD_LABS) <= set(labs.columns) and set(CKD_VITALS) <= set(vitals.columns)
    fuzzy = pivoted_lab_fuzzy(ward["lab"], ward["stays"], ward["admissions"])
    assert fuzzy.filter("icustay_id IS NULL OR hadm_id IS NULL").count() == 0
    assert "bacteria" not in fuzzy.columns


def test_long_stays(wide, episodes):
    assert long_stays(wide[0], episodes).join(episodes.filter("los_icu < 4"), "icustay_id", "left_semi").count() == 0


def test_mortality_line(wide, episodes):
    vitals, labs = wide
    cohort = pp.mortality_cohort(episodes, vitals, labs, 48)
    ids = {r[0] for r in cohort.demographics.select("icustay_id").collect()}
    assert 1070 not in ids and 1001 not in ids and 1050 not in ids and 1010 in ids  # child unit, second, short stay
    series = pp.regular_series(cohort, MORTALITY_VITALS, MORTALITY_LABS)
    series = pp.Cohort(series.demographics, series.vitals.cache(), series.labs.cache())
    for df, cols, step in ((series.vitals, MORTALITY_VITALS, 1), (series.labs, MORTALITY_LABS, 8)):
        pdf = df.toPandas()
        assert not pdf.isna().any().any()
        gaps = pdf.sort_values(["icustay_id", "charttime"]).groupby("icustay_id").charttime.diff().dropna()
        assert set(gaps) == {pd.Timedelta(hours=step)}
    first = [df.groupBy("icustay_id").agg(F.min("charttime").alias("t")) for df in (series.vitals, series.labs)]
    assert first[0].exceptAll(first[1]).count() == 0
    out = pp.mortality_labels(series, 48, horizon_hours=72)
    pdf = out.demographics.toPandas().set_index("icustay_id")
    row = pdf.loc[1040]  # dies; 110 h stay, 62 whole hours after the window
    assert row.label_death_continuous == pytest.approx(max(0.55 * np.exp(-0.66 * 62) + 0.45 * (1 - 62 / 48), 0))
    assert (pdf[pdf.label_death_icu == 0].label_death_continuous == 0).all()
    late = out.vitals.join(out.demographics.select("icustay_id", F.col("predtime").alias("p")), "icustay_id").filter("charttime >= p")
    assert late.count() == 0 and "label_death_continuous" in out.labs.columns


def test_resampling_matches_pandas(wide, episodes):
    vitals, labs = wide
    cohort = pp.ckd_cohort(episodes, vitals, labs, 96)
    series = pp.regular_series(cohort, ["heartrate"], ["sodium"], rest="median")
    v = cohort.vitals.select("icustay_id", "charttime", "heartrate").toPandas()
    b = cohort.labs.select("icustay_id", "charttime").toPandas()
    both = v.merge(b, on=["icustay_id", "charttime"], how="outer").drop_duplicates()
    both["charttime"] = both.charttime.dt.round("h")
    grid = both.set_index("charttime").groupby("icustay_id")["heartrate"].resample("1h", origin="start").median()
    filled = grid.groupby("icustay_id").transform(lambda x: x.ffill().bfill()).fillna(grid.median())
    got = series.vitals.toPandas().set_index(["icustay_id", "charttime"]).heartrate.sort_index()
    pd.testing.assert_series_equal(got, filled.sort_index(), check_names=False, check_index_type=False)


def test_ckd_line_and_vote(wide, episodes):
    vitals, labs = wide
    cohort = pp.ckd_cohort(episodes, vitals, labs, 96)
    series = pp.regular_series(cohort, CKD_VITALS, CKD_LABS, rest="median")
    out = pp.ckd_labels(series, 96, CKD_VITALS)
    out = pp.Cohort(*(df.cache() for df in out))
    panel = multimodal.lab_panels(out).first()
    assert (len(panel["panel"]), len(panel["panel"][0])) == (20, 12)
    vital = multimodal.vital_panels(out)
    shape = vital.select(F.size("panel"), F.size(F.element_at("panel", 1))).distinct().collect()
    assert [tuple(r) for r in shape] == [(11, 96)]
    static = multimodal.static_table(out)
    assert static.columns == ["icustay_id", "gender", "ethnicity_grouped", "label_cor_art", "diabetes_mellitus",
                              "anemia_flag", "age_group", "ckd"]
    agg = multimodal.aggregate_table(out)
    assert agg.count() == out.demographics.count()
    votes, scores = multimodal.multimodal_vote(
        static, multimodal.lab_panels(out), vital, n_kernels=20, test_fraction=0.4,
        forest={"numTrees": 5, "maxDepth": 4}, logistic={"maxIter": 20, "regParam": 0.1},
    )
    assert {r["model"] for r in scores.collect()} == {"static", "labs", "vitals", "vote"}
    rows = votes.collect()
    assert rows and all(abs(sum(r["vote"]) - 1) < 1e-6 for r in rows)


def test_federated_evaluation(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(120, 2))
    rows = [(i, int(x[i, 0] > 0), x[i].tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, y int, x array<double>").cache()
    fit = {"rounds": 2}
    fl = federated.evaluate(df, "x", "y", "id", "fl", 2, k=2, **fit)
    assert fl.count() == 120 and fl.filter("(y_pred > 0.5) = (y_true = 1)").count() > 90
    lml = federated.evaluate(df, "x", "y", "id", "lml", 2, k=2, **fit)
    assert lml.count() == 240 and {r[0] for r in lml.select("client").distinct().collect()} == {1, 2}
