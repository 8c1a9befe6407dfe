"""Hand-made rows for the edge cases of each operator."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.functions import datetimes as dt
from cohortspark.functions import scalars as sc
from cohortspark.functions.fixed import AGE_EDGES, AGE_LABELS
from cohortspark.functions.scalars import Bound, Rule
from cohortspark.operators import aggregates as ag
from cohortspark.operators import cohort as co
from cohortspark.operators import features as ft
from cohortspark.operators import joins as jn
from cohortspark.operators import labels as lb
from cohortspark.operators import metrics as mt
from cohortspark.operators import sampling as sp
from cohortspark.operators import timeseries as ts
from cohortspark.operators import training as tr
from cohortspark.operators import windows as wn
from cohortspark.sources import tables as tb


def frame(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    times = [f.name for f in df.schema.fields if f.name.startswith("t_") or f.name in ("t", "start", "end")]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


def got(df, *order):
    rows = df.orderBy(*order) if order else df
    return [tuple(str(v) if hasattr(v, "isoformat") else v for v in r) for r in rows.collect()]


def test_round_hour_ties_to_even(spark):
    times = ["00:30:00", "01:30:00", "02:30:00.000001", "02:29:59.999"]
    df = frame(spark, [(i, f"2024-01-01 {x}") for i, x in enumerate(times)], "i int, t string")
    out = got(df.select("i", sc.round_hour("t").alias("t")), "i")
    assert [r[1][11:16] for r in out] == ["00:00", "02:00", "03:00", "02:00"]


def test_round_hour_before_1970(spark):
    df = frame(spark, [("1969-12-31 22:30:00",), ("1969-12-31 23:30:00",)], "t string")
    assert [r[0][:16] for r in got(df.select(sc.round_hour("t")))] == ["1969-12-31 22:00", "1970-01-01 00:00"]


def test_times_do_not_depend_on_the_session_zone(spark):
    """02:30 does not exist in New York on that day, but a timestamp without a zone may hold it."""
    df = frame(spark, [("2024-03-10 02:30:00",), ("2024-03-10 02:10:00",)], "t string")
    start = F.lit("2024-03-10 00:00:00").cast("timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = got(df.select(sc.round_hour("t"), dt.datetime_diff(F.col("t"), start, "MINUTE")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [(t[:16], m) for t, m in out] == [("2024-03-10 02:00", 150.0), ("2024-03-10 02:00", 130.0)]


@pytest.mark.parametrize("target", [None, 2])
def test_resample_per_entity_origin(spark, target):
    rows = [(1, "03:00", 1.0), (1, "10:00", None), (1, "20:00", 3.0), (2, "05:00", 4.0), (2, "14:00", 6.0)]
    df = frame(spark, [(k, f"2024-01-01 {x}:00", v) for k, x, v in rows], "k int, t string, v double")
    out = got(ts.resample(df, "k", "t", 8, ["v"], target_rows=target), "k", "t")
    assert [(k, t[11:16], v) for k, t, v in out] == [
        (1, "03:00", 1.0), (1, "11:00", None), (1, "19:00", 3.0), (2, "05:00", 4.0), (2, "13:00", 6.0)
    ]
    filled = got(ts.resample_filled(df, "k", "t", 8, ["v"], target_rows=target), "k", "t")
    assert [r[2] for r in filled] == [1.0, 1.0, 3.0, 4.0, 6.0]


@pytest.mark.parametrize("target", [None, 3])
def test_resample_long_gap_and_median(spark, target):
    rows = [(1, "2024-01-01 00:00:00", 1.0), (1, "2024-01-01 00:00:00", 2.0), (1, "2024-01-01 09:00:00", 8.0),
            (2, "2024-01-01 04:00:00", None)]
    df = frame(spark, rows, "k int, t string, v double")
    out = got(ts.resample(df, "k", "t", 1, ["v"], fill_gaps=True, target_rows=target), "k", "t")
    assert [r[2] for r in out] == [1.5] * 9 + [8.0] + [None]
    rest = got(ts.resample_filled(df, "k", "t", 1, ["v"], rest="median", target_rows=target), "k", "t")
    assert rest[-1][2] == 4.75  # median of the steps that have a value: 1.5 and 8


def test_resample_from_the_end(spark):
    rows = [(1, "2024-01-01 01:00:00", 1.0), (1, "2024-01-01 02:00:00", 2.0), (1, "2024-01-01 10:00:00", 5.0)]
    out = got(ts.resample(frame(spark, rows, "k int, t string, v double"), "k", "t", 8, ["v"], origin="end"), "t")
    assert [(t[:16], v) for _, t, v in out] == [("2024-01-01 02:00", 1.5), ("2024-01-01 10:00", 5.0)]


def test_bins(spark):
    df = spark.createDataFrame([(0.0,), (9.0,), (18.5,), (89.0,), (300.0,), (400.0,)], "a double")
    ages = [r[0] for r in df.select(sc.bin_column("a", AGE_EDGES, AGE_LABELS, right=False)).collect()]
    assert ages == ["0-9", "10-19", "10-19", "90+", "90+", None]
    df = spark.createDataFrame([(8.0,), (15.0,), (15.5,)], "a double")
    assert [r[0] for r in df.select(sc.bin_column("a", [8, 15, 23])).collect()] == [None, 0, 1]


def test_whole_hours_round_down(spark):
    df = spark.createDataFrame([(-5400,), (5399,), (-1,)], "s long")
    assert [r[0] for r in df.select(lb.whole_hours("s")).collect()] == [-2, 1, -1]


def test_interval_join_is_half_open(spark):
    stays = frame(spark, [(1, 10, "2024-01-01 06:00:00", "2024-01-03 06:00:00"),
                          (1, 11, "2024-01-02 00:00:00", "2024-01-02 01:00:00"),
                          (1, 12, "2024-01-05 00:00:00", "2024-01-05 00:00:00")],
                  "k int, stay int, start string, end string")
    points = frame(spark, [(1, "2024-01-01 06:00:00"), (1, "2024-01-03 06:00:00"), (1, "2024-01-02 00:30:00"),
                           (1, "2024-01-05 00:00:00"), (2, "2024-01-02 00:00:00"), (None, "2024-01-02 00:00:00")],
                   "k int, t string")
    for days in (1, 2, 30):
        out = jn.interval_join(points, stays, "k", "t", "start", "end", bucket_days=days)
        assert sorted((str(r["k"]), str(r["t"])[:16], str(r["stay"])) for r in out.collect()) == [
            ("1", "2024-01-01 06:00", "10"), ("1", "2024-01-02 00:30", "10"), ("1", "2024-01-02 00:30", "11"),
            ("1", "2024-01-03 06:00", "None"), ("1", "2024-01-05 00:00", "None"), ("2", "2024-01-02 00:00", "None"),
            ("None", "2024-01-02 00:00", "None"),
        ]


def test_event_in_closed_interval(spark):
    rows = [("2024-01-01 00:00:00",), ("2024-01-02 00:00:00",), ("2024-01-02 00:00:01",), (None,)]
    df = frame(spark, rows, "t string").withColumns(
        {"start": F.lit("2024-01-01").cast("timestamp_ntz"), "end": F.lit("2024-01-02").cast("timestamp_ntz")})
    flag, when = sc.event_in_interval("t", "start", "end")
    assert [r[0] for r in df.select(flag).collect()] == [1, 1, 0, 0]
    assert [r[0] is None for r in df.select(when).collect()] == [False, False, True, True]


def test_fuzzy_bounds_of_neighbours(spark):
    rows = [(1, 1, "2024-01-01 00:00:00", "2024-01-02 00:00:00"), (1, 2, "2024-01-02 10:00:00", "2024-01-03 00:00:00"),
            (1, 3, "2024-01-04 00:00:00", "2024-01-05 00:00:00"), (1, 4, "2024-01-06 06:00:00", "2024-01-07 00:00:00")]
    df = frame(spark, rows, "k int, stay int, start string, end string")
    for target in (None, 1):
        out = got(jn.fuzzy_bounds(df, "k", "start", "end", "stay", target_rows=target), "stay")
        assert [(r[4][:16], r[5][:16]) for r in out] == [
            ("2023-12-31 12:00", "2024-01-02 05:00"),
            ("2024-01-02 05:00", "2024-01-03 12:00"),  # 24 h apart exactly keeps 12 h
            ("2024-01-03 12:00", "2024-01-05 12:00"),
            ("2024-01-05 18:00", "2024-01-07 12:00"),
        ]


@pytest.mark.parametrize("target", [None, 2])
def test_fills(spark, target):
    rows = [(1, i, v) for i, v in enumerate([None, 1.0, None, 2.0, None])]
    df = spark.createDataFrame(rows, "k int, i int, v double")
    assert [r[2] for r in got(wn.ffill_bfill(df, "k", "i", ["v"], target_rows=target), "i")] == [1, 1, 1, 2, 2]
    assert [r[2] for r in got(wn.bfill_ffill(df, "k", "i", ["v"], target_rows=target), "i")] == [1, 1, 2, 2, 2]


def test_medians(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "v double")
    assert df.agg(ag.median_cont("v")).first()[0] == 2.5
    assert ag.column_medians(df, ["v"]).first()[0] == 2.5
    assert ag.column_medians(df, ["v"], target_rows=1).first()[0] == 2.5


def test_flags_zero_or_null(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "h int")
    codes = spark.createDataFrame([(1, "a"), (1, "x"), (2, "x")], "h int, code string")
    assert got(jn.flag_codes(df, codes, "h", "code", {"f": ["a"]}), "h") == [(1, 1), (2, 0), (3, 0)]
    assert got(jn.flag_by_max(df, codes, "h", "code", ["a"], "f"), "h") == [(1, 1), (2, 0), (3, None)]


def test_error_marks(spark):
    df = spark.createDataFrame([(None, 1), (0, 1), (1, 1), (0, None)], "e int, s int")
    assert sc.drop_flagged(df, "e", "s").count() == 2


def test_bounds_keep_their_ends(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 10.1), ("b", 300.0), ("b", 299.0), ("c", 1e9)], "i string, v double")
    bounds = {"a": Bound(high=10), "b": Bound(high=300, high_in=False)}
    assert [r[0] for r in df.select(sc.clip_to_null("i", "v", bounds)).collect()] == [10.0, None, None, 299.0, 1e9]
    heat = [Rule(("f",), Bound(70, 120, False, False), 32, 1.8), Rule(("c",), Bound(10, 50, False, False))]
    df = spark.createDataFrame([("f", 98.6), ("f", 70.0), ("c", 37.0), ("c", 50.0), ("x", 1.0)], "i string, v double")
    out = [r[0] for r in df.select(sc.convert_units("i", "v", heat)).collect()]
    assert out[0] == pytest.approx(37.0) and out[1:] == [None, 37.0, None, None]


def test_label_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.125,), (0.1251,), (1.0,)], "y double")
    assert [r[0] for r in df.select(lb.assign_bin("y", 5)).collect()] == [0, 0, 1, 4]
    assert [r[0] for r in df.select(lb.equal_bin("y", 5)).collect()] == [0, 0, 0, 4]


def test_vote_ties_go_to_class_zero(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5], [0.5, 0.5]), (2, [0.9, 0.1], [0.2, 0.8])],
                               "id int, a array<double>, b array<double>")
    assert [r["prediction"] for r in tr.soft_vote(df, {"a": 1, "b": 1}).orderBy("id").collect()] == [0, 0]
    assert [r["prediction"] for r in tr.soft_vote(df, {"a": 1, "b": 3}).orderBy("id").collect()] == [0, 1]


def test_metrics_without_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0, 0.3), (0, 0, 0.3)], "y int, p int, s double")
    row = mt.binary_metrics(df, "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0, 0, 0, 0.5)
    assert mt.auroc(df, "y", "s").first()[0] == 0.5
    assert mt.auroc(df.filter("y = 1"), "y", "s").first()[0] is None


@pytest.mark.parametrize("target", [None, 15])
def test_areas_against_brute_force(spark, target):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 200), np.round(rng.random(200), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    pos, neg = s[y == 1], s[y == 0]
    want = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert mt.auroc(df, "y", "s", target_rows=target).first()[0] == pytest.approx(want)
    flipped = df.withColumn("s", -F.col("s"))
    assert mt.auroc(flipped, "y", "s", target_rows=target).first()[0] == pytest.approx(1 - want)
    r0, p0, area = 0.0, 1.0, 0.0
    for t in sorted(set(s), reverse=True):
        r, p = (pos >= t).mean(), (y[s >= t] == 1).mean()
        area, r0, p0 = area + (r - r0) * (p + p0) / 2, r, p
    assert mt.auprc(df, "y", "s", target_rows=target).first()[0] == pytest.approx(area)
    grid = mt.auc_grid(df, "y", "s").first()
    assert grid["auroc_grid"] == pytest.approx(want, abs=0.01)


def test_oversample_and_undersample(spark):
    df = spark.createDataFrame([(i, int(i >= 7)) for i in range(10)], "id int, y int")
    out = sp.oversample(df, "y", "id")
    assert got(out.groupBy("y").count(), "y") == [(0, 7), (1, 7)]
    assert {r["count"] for r in out.filter("y = 1").groupBy("id").count().collect()} == {2, 3}
    assert got(sp.undersample(df, "y", "id").groupBy("y").count(), "y") == [(0, 3), (1, 3)]


def test_splits_are_disjoint_and_even(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "id int, y int")
    out = sp.stratified_split(df, "id", "y", 0.25)
    assert got(out.groupBy("y", "split").count(), "y", "split") == [
        r for y in range(3) for r in ((y, "test", 25), (y, "train", 75))
    ]
    again = sp.stratified_split(df.repartition(7), "id", "y", 0.25)
    assert out.exceptAll(again).count() == 0
    folds = sp.kfold(df, "id", "y", 5).groupBy("fold", "y").count().collect()
    assert {r["count"] for r in folds} == {20}
    # ids listed for removal leave the part they fell into; the cut itself does not move
    ordered = sp.ordered_split(df, "id", 0.8, exclude=[250], target_rows=20).groupBy("split").count()
    assert got(ordered, "split") == [("test", 59), ("train", 240)]


@pytest.mark.parametrize("block", [7, 1000])
def test_neighbours_against_brute_force(spark, block):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4))
    x[10:20] = x[0]  # a group of copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    near = sp.nearest_neighbours(df, "id", "v", 5, block_rows=block)
    have = {(r["id"], r["place"]): r["neighbour"] for r in near.collect()}
    assert len(have) == 300
    for i in range(60):
        d = ((x - x[i]) ** 2).sum(axis=1)
        want = [j for j in np.lexsort((np.arange(60), d)) if j != i][:5]
        assert [have[(i, p)] for p in range(1, 6)] == want


def test_neighbours_of_clustered_rows_visit_few_blocks(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 5)) * 100
    x = np.concatenate([c + rng.normal(size=(40, 5)) for c in centres] + [np.repeat(centres[:1], 120, axis=0)])
    df = spark.createDataFrame(
        [(i, v.tolist(), ("a", "b")[i % 2]) for i, v in enumerate(x)], "id long, v array<double>, y string"
    )
    near = sp.nearest_neighbours(df, "id", "v", 4, block_rows=20, by="y")
    have = {(r["id"], r["place"]): r["neighbour"] for r in near.collect()}
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        same = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i and j % 2 == i % 2][:4]
        assert [have[(i, p)] for p in range(1, 5)] == same
    # the rows are sent to a small part of the blocks
    blocks = sp.pivot_blocks(df.select("id", "v", F.col("y").alias("c")), 20, 42)
    visits = sp.neighbour_visits(blocks, 4)
    sent = visits.agg(F.avg(F.size("visits"))).first()[0]
    total = blocks.select("c", "block").distinct().count() / 2
    assert total >= 15 and sent < total / 3
    # a row of its own has nobody to meet
    assert sp.nearest_neighbours(df.limit(1), "id", "v", 4).collect() == []
    assert sp.nearest_neighbours(df.filter("id < 0"), "id", "v", 4, by="y").collect() == []


def test_balanced_bootstrap_against_plain_python(spark):
    from hashlib import md5

    rows = [(i, None if i == 50 else "few" if i % 11 == 0 else "many") for i in range(80)]
    df = spark.createDataFrame(rows, "id long, y string")
    out = sp.balanced_bootstrap(df, "y", "id", 3, seed=9)
    have = sorted((r.tree, r.y, r.draw, r.id) for r in out.collect())

    def drawn(*parts):
        return int(md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2**32

    classes = {}
    for i, y in rows:
        if y:
            classes.setdefault(y, []).append(i)
    for ids in classes.values():
        ids.sort(key=lambda i: (md5(f"9|{i}".encode()).hexdigest(), i))
    n = min(map(len, classes.values()))
    want = [
        (t, y, j, ids[int(drawn("9t", y, t, j) * len(ids))])
        for t in range(3) for y, ids in classes.items() for j in range(1, n + 1)
    ]
    assert have == sorted(want)
    assert sp.balanced_bootstrap(df.filter("id < 0"), "y", "id", 3).collect() == []


def test_balanced_forest_votes_with_the_mean_of_its_trees(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i < 20), (rng.normal(size=3) + (2.5 if i < 20 else 0)).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>")
    model = tr.fit_balanced_forest(df, "v", "y", "id", numTrees=12, maxDepth=4)
    out = tr.predict(model, df, "v", ["id", "y"]).collect()
    assert sum(r.prediction == r.y for r in out) > 260 and sum(r.prediction for r in out if r.y) >= 16
    apart = [{r.id: r.probability for r in tr.predict(t, df, "v", ["id"]).collect()} for t in model.trees[:12]]
    for r in out[:40]:
        assert r.probability == pytest.approx(np.mean([p[r.id] for p in apart], axis=0))
        assert r.prediction == int(np.argmax(r.probability))
    assert sum(model.featureImportances.toArray()) == pytest.approx(1)
    again = tr.fit_balanced_forest(df, "v", "y", "id", numTrees=12, maxDepth=4)
    assert [r.probability for r in tr.predict(again, df, "v", ["id"]).orderBy("id").collect()] == [
        r.probability for r in sorted(out, key=lambda r: r.id)
    ]


def test_smote_fills_up_the_minority(spark):
    rng = np.random.default_rng(6)
    rows = [(i, int(i < 8), rng.normal(size=3).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, y int, v array<double>")
    new = sp.smote(df, "y", 1, "id", "v", k=3, block_rows=4).collect()
    assert len(new) == 32 - 8 and {r["y"] for r in new} == {1}
    few = {i: np.array(v) for i, y, v in rows if y}
    for r in new:
        a, b, p = few[r["id"]], few[r["neighbour"]], np.array(r["v"])
        assert r["id"] != r["neighbour"]
        assert np.linalg.norm(p - a) + np.linalg.norm(p - b) == pytest.approx(np.linalg.norm(a - b))


def test_smote_classes_fills_up_every_class(spark):
    rng = np.random.default_rng(7)
    rows = [(i, "a" if i < 20 else "b" if i < 29 else "c" if i < 33 else None, rng.normal(size=3).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, y string, v array<double>")
    new = sp.smote_classes(df, "y", "id", "v", k=3, block_rows=4).collect()
    label = {i: y for i, y, _ in rows}
    assert sorted(r["y"] for r in new) == ["b"] * 11 + ["c"] * 16
    assert all(label[r["id"]] == label[r["neighbour"]] == r["y"] and r["id"] != r["neighbour"] for r in new)
    one = sp.smote(df.filter("y is not null"), "y", "c", "id", "v", k=3, block_rows=4).collect()
    assert sorted(map(str, one)) == sorted(str(r) for r in new if r["y"] == "c")
    assert sp.smote_classes(df.filter("id < 0"), "y", "id", "v").collect() == []


def test_fix_length(spark):
    rows = [(1, f"2024-01-01 0{i}:00:00", float(i), 1) for i in range(3)]
    rows += [(2, f"2024-01-01 0{i}:00:00", float(i), 0) for i in range(7)]
    df = frame(spark, rows, "k int, t string, v double, y int")
    out = got(ts.fix_length(df, "k", "t", 8, 5, ["v"], "y"), "k", "t")
    assert [(r[1][11:13], r[2], r[3]) for r in out[:5]] == [
        ("00", 1, 0.0), ("01", 1, 1.0), ("02", 1, 2.0), ("10", 1, None), ("18", 1, None)]
    assert [r[3] for r in out[5:]] == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_panels(spark):
    df = spark.createDataFrame([(1, [[1.0, 2.0], [3.0, 4.0]])], "k int, p array<array<double>>")
    assert df.select(ts.pad_panel("p", 3)).first()[0] == [[1, 2, 0], [3, 4, 0]]
    assert df.select(ts.pad_panel("p", 1)).first()[0] == [[1], [3]]
    assert df.select(ts.unflatten_panel(ts.flatten_panel("p"), 2, 2)).first()[0] == [[1, 2], [3, 4]]
    two = df.unionByName(spark.createDataFrame([(2, [[9.0], [8.0]])], "k int, p array<array<double>>"))
    assert [r[1] for r in got(ts.pad_ragged(two, "p"), "k")][1] == [[9.0, -2.0], [8.0, -2.0]]


def test_random_kernels(spark):
    a, b = ft.make_kernels(20, 30, 4, seed=1), ft.make_kernels(20, 30, 4, seed=1)
    assert a == b and len(a) == 20
    rng = np.random.default_rng(0)
    x = rng.normal(size=(5, 4, 30))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(5)], "id int, panel array<array<double>>")
    out = ft.panel_features(df, "panel", a, ["id"]).orderBy("id").collect()
    k, row = a[3], x[2]
    w, dil, pad = np.array(k["weights"]), k["dilation"], k["padding"]
    part = np.pad(row[k["channels"]], ((0, 0), (pad, pad)))
    conv = [
        sum(w[c, j] * part[c, p + j * dil] for c in range(len(w)) for j in range(w.shape[1])) + k["bias"]
        for p in range(part.shape[1] - (w.shape[1] - 1) * dil)
    ]
    assert out[2]["features"][6] == pytest.approx(max(conv))
    assert out[2]["features"][7] == pytest.approx(np.mean(np.array(conv) > 0))


@pytest.mark.parametrize("target", [None, 40])
def test_dictionaries_of_any_size(spark, monkeypatch, target):
    from cohortspark.operators import grouped

    if target:
        monkeypatch.setattr(grouped, "TARGET_ROWS", target)
    train = spark.range(900).select(F.concat(F.lit("v"), F.col("id") % 450).alias("a"), (F.col("id") % 7).alias("b"))
    codes = {c: ft.dictionary(train, c) for c in ("a", "b")}
    values = sorted({f"v{i % 450}" for i in range(900)})
    assert got(codes["a"], "code") == [(v, i) for i, v in enumerate(values)]
    rows = [(1, "v17", 6), (2, "other", 0), (3, None, None), (4, "v9", 99)]
    test = spark.createDataFrame(rows, "k int, a string, b long")
    out = got(ft.encode_joined(test, codes), "k")
    assert out == [(1, values.index("v17"), 6), (2, None, 0), (3, None, None), (4, values.index("v9"), None)]
    hot = [(r.k, r.f.size, r.f.positions) for r in ft.one_hot_sparse(test, codes, "f").orderBy("k").collect()]
    assert hot == [(1, 457, [values.index("v17"), 456]), (2, 457, [450]), (3, 457, []), (4, 457, [values.index("v9")])]
    # equal to the dictionary on the driver where that is allowed
    few = {"b": ft.vocabulary(train, ["b"])["b"]}
    assert got(ft.label_encode(test, few), "k") == got(ft.encode_joined(test, {"b": codes["b"]}), "k")
    none = ft.dictionary(train.filter("a is null"), "a")
    assert got(ft.encode_joined(test, {"a": none}), "k")[0] == (1, None, 6)


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    rows = spark.range(500).select((F.col("id") % 20).alias("e"), F.col("id").alias("t"))
    a = tb.write_bucketed(rows, "bucketed_a", "e", 4, ["t"], f"{tmp_path}/a")
    b = tb.write_bucketed(rows.groupBy("e").count(), "bucketed_b", "e", 4, [], f"{tmp_path}/b")
    try:
        w = wn.Window.partitionBy("e").orderBy("t")
        out = a.join(b.hint("merge"), "e").withColumn("r", F.row_number().over(w))
        plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
        assert "Exchange" not in plan
        assert out.count() == 500 and out.agg(F.max("r")).first()[0] == 25
    finally:
        spark.sql("DROP TABLE bucketed_a")
        spark.sql("DROP TABLE bucketed_b")


def test_large_runs_are_split_over_files(spark, tmp_path):
    from pathlib import Path

    large = spark.range(200_000).select(
        F.lit("bin").alias("label"), F.when(F.col("id") % 10 == 0, "lml").otherwise("fl").alias("model"),
        F.lit(2).alias("n_clients"), F.lit(96).alias("window"), F.lit("test").alias("split"), F.lit("mae").alias("metric"),
        F.lit(0).alias("fold"), F.lit(0).alias("client"), F.col("id").cast("int").alias("epoch"),
        F.rand(3).alias("value"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tb.write_scores(large.repartition(8), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {m: len(list(Path(tmp_path).rglob(f"model={m}/**/*.parquet"))) for m in ("fl", "lml")}
    assert files["fl"] > 2 and files["lml"] >= 1
    assert tb.read_scores(spark, str(tmp_path), model="fl").count() == 180_000


def test_vocabulary_is_shared_and_bounded(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    vocab = ft.vocabulary(train, ["c"])
    test = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    assert got(ft.one_hot(test, vocab)) == [(0, 1), (0, 0), (0, 0)]
    assert [r[0] for r in got(ft.label_encode(test, vocab))] == [1, None, None]
    with pytest.raises(ValueError):
        ft.vocabulary(train, ["c"], max_categories=1)


def test_constant_column_has_no_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (-2.0, 5.0)], "a double, b double")
    out = ft.minmax_scale(df, ag.minmax_bounds(df, ["a", "b"]), ["a", "b"]).collect()
    assert [r["a"] for r in out] == [0.0, 1.0, -1.5] and [r["b"] for r in out] == [None] * 3


def test_learning_curve_and_best_round(spark):
    rows = [(f, e, 1.0 / e + f) for f in (0, 1) for e in range(1, 6 + f)]
    df = spark.createDataFrame(rows, "fold int, epoch int, loss double")
    assert mt.learning_curve(df, [], "epoch", "loss", ["fold"]).count() == 5
    losses = [5.0, 4.0, 3.0, 3.5, 3.6, 1.0]
    run = spark.createDataFrame([(1, i, x) for i, x in enumerate(losses)], "run int, r int, loss double")
    assert got(mt.best_round(run, ["run"], "r", "loss", patience=2)) == [(1, 2, 3.0, 4)]
    assert got(mt.best_round(run, ["run"], "r", "loss", patience=9)) == [(1, 5, 1.0, 5)]


def test_class_weights_count_bounds_twice(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "y double")
    out = [r["weight"] for r in sp.class_weights(df, "y", 2).orderBy("y").collect()]
    assert out == [1.5, 1.5, 1.5]  # 0.5 lies in both closed windows


def test_cohort_flow_is_cumulative(spark):
    df = spark.createDataFrame([(1, 5, 1), (2, 3, 0), (3, 9, 1)], "id int, los int, died int")
    flow = co.cohort_flow(df, {"all": F.lit(True), "long": F.col("los") > 4, "short": F.col("los") < 9}, {"n": "id"}, "died")
    assert got(flow, "step_no") == [(0, "all", 3, 2), (1, "long", 2, 2), (2, "short", 1, 1)]


def test_formats(spark):
    df = spark.createDataFrame([("2024-02-03 04:05:06",)], "x string")
    ts_ = dt.parse_datetime("%Y-%m-%d %H:%M:%S", "x")
    row = df.select(dt.format_datetime("%Y%m%dT%H%M%S", ts_).alias("a"), dt.parse_date("%Y-%m-%d", F.lit("2024-02-03")).alias("b"),
                    dt.datetime_diff(F.col("x"), F.col("x"), "MONTH").alias("c"),
                    dt.regexp_extract_or_null("x", "zz").alias("d"), dt.regexp_extract_or_null("x", "([0-9]+)-02").alias("e")).first()
    assert (row["a"], str(row["b"]), row["c"], row["d"], row["e"]) == ("20240203T040506", "2024-02-03", None, None, "2024")


def test_round_scores_over_a_weights_table(spark):
    from cohortspark.operators.training import round_scores

    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(300, 2)), rng.integers(0, 2, 300)
    rows = [(f"c{i % 3}", [float(v) for v in x[i]], int(y[i])) for i in range(300)]
    rows += [(None, [1.0, 1.0], 1), ("c0", None, 1), ("c0", [0.0, 0.0], None), ("unknown", [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "client string, x array<double>, y int")
    models = {(f"c{c}", r): rng.normal(size=3) for c in range(3) for r in (1, 2)}
    given = [(c, r, [float(v) for v in w]) for (c, r), w in models.items()] + [("empty", 1, [0.0, 0.0, 0.0])]
    weights = spark.createDataFrame(given, "client string, round int, weights array<double>")
    got = {(r["client"], r["round"]): r for r in round_scores(df, weights, "client", "x", "y").collect()}
    assert set(got) == set(models)
    for (c, r), w in models.items():
        mine = np.arange(300) % 3 == int(c[1])
        p, t = 1 / (1 + np.exp(-(x[mine] @ w[:2] + w[2]))), y[mine] == 1
        said, row = p > 0.5, got[c, r]
        assert row["n"] == 100 and abs(row["accuracy"] - np.mean(said == t)) < 1e-12
        assert abs(row["recall"] - np.sum(said & t) / np.sum(t)) < 1e-12
        assert abs(row["precision"] - np.sum(said & t) / max(1, np.sum(said))) < 1e-12
        exact = np.mean([(a > b) + (a == b) / 2 for a in p[t] for b in p[~t]])
        assert abs(row["auroc_grid"] - exact) < 0.02


def test_round_scores_of_many_clients_join_their_weights(spark):
    from cohortspark.operators.training import round_scores

    n = 20_000
    rows = spark.range(2 * n).select(
        (F.col("id") % n).alias("client"), F.array((F.col("id") < n).cast("double") * 2 - 1).alias("x"),
        (F.col("id") < n).cast("int").alias("y"),
    )
    sign = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0)
    weights = spark.range(n).select(F.col("id").alias("client"), F.lit(1).alias("round"), F.array(sign, F.lit(0.0)).alias("weights"))
    out = round_scores(rows, weights, "client", "x", "y")
    right = F.when(F.col("client") % 2 == 0, 1.0).otherwise(0.0)
    assert out.count() == n and out.filter(F.col("accuracy") != right).count() == 0


def test_federated_scores_follow_the_rounds(spark):
    from cohortspark.operators.training import federated_scores

    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 2))
    rows = [(i, i % 2, [float(v) for v in x[i]], int(x[i, 0] + x[i, 1] > 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, client int, x array<double>, y int")
    out = federated_scores(df, "client", "x", "y", "id", rounds=6).collect()
    assert {(r["client"], r["round"], r["part"]) for r in out} == {
        (c, r, p) for c in (0, 1) for r in range(1, 7) for p in ("train", "valid")
    }
    assert all(sum(r["n"] for r in out if r["round"] == k) == 400 for k in range(1, 7))
    assert all(r["auroc_grid"] > 0.95 for r in out if r["round"] == 6)


def test_federated_rounds_learn(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ np.array([2.0, -1.0, 0.0]) > 0).astype(int)
    rows = [(i, int(i % 3 == 0) + 1, int(y[i]), x[i].tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, client int, y int, x array<double>")
    w, history = tr.federated_fit(df, "client", "x", "y", "id", rounds=8, local_steps=3)
    loss = [r["loss"] for r in history.filter("client = 1 AND part = 'valid'").orderBy("round").collect()]
    assert loss[-1] < loss[0] < math.log(2)
    right = df.withColumn("p", (tr.linear_score("x", w) > 0.5).cast("int")).filter("p = y").count()
    assert right > 350
    models, _ = tr.local_fit(df, "client", "x", "y", "id", rounds=5)
    assert sorted(models) == [1, 2] and not np.allclose(models[1], models[2])


def test_one_round_with_one_client_is_plain_descent(spark):
    rows = [(i, 1, i % 2, [float(i % 2), 1.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, client int, y int, x array<double>")
    w, _ = tr.federated_fit(df, "client", "x", "y", "id", rounds=1, learning_rate=1.0, valid_fraction=0.0)
    y = np.array([r[2] for r in rows]); x = np.array([r[3] for r in rows])
    want = -np.concatenate([(0.5 - y) @ x, [(0.5 - y).sum()]]) / 50
    assert np.allclose(w, want)


def test_cross_validation_scores_whole_folds(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i % 5 == 0), (rng.normal(size=2) + (2 if i % 5 == 0 else 0)).tolist()) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, y int, v array<double>")
    out = tr.cross_validate(df, lambda t: tr.fit_logistic(t, "v", "y", maxIter=20), "v", "y", "id", k=2, resampling="over")
    support = {(r["fold"], r["label"]): r["support"] for r in out.collect()}
    assert support[(0, "1")] == 10 and support[(1, "0")] == 40


def test_jdbc_options():
    opts = tb.jdbc_options("jdbc:x", "labevents", "subject_id", (1, 99), 8, {"user": "u"})
    assert opts["partitionColumn"] == "subject_id" and opts["numPartitions"] == "8" and opts["user"] == "u"
    assert "partitionColumn" not in tb.jdbc_options("jdbc:x", "labevents")
    with pytest.raises(ValueError):
        tb.jdbc_options("jdbc:x", "t", "c")


def test_scores_of_other_runs_stay(spark, tmp_path):
    row = "SELECT 'bin' label, '{}' model, 2 n_clients, 48 `window`, 'test' split, 'auc' metric, 0 fold, 0 client, 0 epoch, {}D value"
    for model, value in (("fl", 0.5), ("lml", 0.6), ("fl", 0.7)):
        tb.write_scores(spark.sql(row.format(model, value)), str(tmp_path))
    out = tb.read_scores(spark, str(tmp_path))
    assert got(out.select("model", "value"), "model") == [("fl", 0.7), ("lml", 0.6)]
    assert tb.read_scores(spark, str(tmp_path), "predictions", model="fl").count() == 0


# --- found by the review of round 1 -------------------------------------------------------------------------------


def test_running_sum_with_nulls_when_cut(spark):
    from cohortspark.operators.grouped import running_sum

    rows = [(1, i, None if i % 3 == 1 else float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "g int, o int, v double")
    want = {r.o: r.s for r in running_sum(df, ["g"], "o", {"s": "v"}).collect()}
    got = {r.o: r.s for r in running_sum(df, ["g"], "o", {"s": "v"}, target_rows=5).collect()}
    assert got == want


def test_text_order_when_cut(spark):
    from cohortspark.operators.grouped import number_rows

    names = sorted(f"{'né' if i % 2 else 'na'}{i:04d}" for i in range(60))
    df = spark.createDataFrame([(1, n) for n in names], "g int, o string")
    got = {r.o: r.n for r in number_rows(df, ["g"], "o", "n", target_rows=7).collect()}
    assert got == {n: i + 1 for i, n in enumerate(names)}


def test_constant_histogram(spark):
    from cohortspark.operators.aggregates import equal_width_histogram

    df = spark.createDataFrame([(3.0,)] * 5, "x double")
    assert sorted((r.bin, r.n) for r in equal_width_histogram(df, "x", 4).collect()) == [(0, 0), (1, 0), (2, 5), (3, 0)]


def test_retention_of_nobody(spark):
    from cohortspark.operators.cohort import retention

    df = spark.createDataFrame([], "k int")
    assert [tuple(r) for r in retention(df, df, "k").collect()] == [(0, 0, None)]


def test_java_patterns(spark):
    from cohortspark.functions.datetimes import regexp_extract_or_null

    df = spark.createDataFrame([("12 été 3",)], "t string")
    row = df.select(
        regexp_extract_or_null("t", r"\p{L}+").alias("a"),
        regexp_extract_or_null("t", r"(\d+)\s\p{L}").alias("b"),
        regexp_extract_or_null("t", r"[(]x").alias("c"),
    ).first()
    assert tuple(row) == ("été", "12", None)


def test_lookup_keeps_rows(spark):
    from cohortspark.operators.joins import lookup

    df = spark.createDataFrame([(1, "a"), (None, "b"), (None, "b"), (2, "c")], "k int, x string")
    dim = spark.createDataFrame([(1, 5), (1, 6), (None, 7)], "k int, v int")
    rows = [tuple(r) for r in lookup(df, dim, "k", "v", "w").collect()]
    assert sorted(rows, key=str) == sorted([(1, "a", 5), (None, "b", None), (None, "b", None), (2, "c", None)], key=str)


def test_smote_of_one_row_fails_and_text_ids_work(spark):
    import pytest

    from cohortspark.operators.sampling import smote

    rows = [("a", 1, [0.0]), ("b", 0, [1.0]), ("c", 0, [2.0]), ("d", 0, [3.0])]
    one = spark.createDataFrame(rows, "id string, y int, v array<double>")
    with pytest.raises(Exception, match="at least two rows"):
        smote(one, "y", 1, "id", "v").collect()
    two = spark.createDataFrame([*rows, ("e", 1, [9.0])], "id string, y int, v array<double>")
    (new,) = smote(two, "y", 1, "id", "v").collect()
    assert {new.id, new.neighbour} == {"a", "e"} and 0 <= new.v[0] <= 9


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_smote_keeps_classes_apart(spark, adaptive):
    """Ids that occur in two classes, and a class of one row, with and without adaptive plans."""
    from cohortspark.operators.sampling import smote_classes

    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        rows = [(i, "x", [float(i)]) for i in range(2)] + [(i, "y", [60.0 + i]) for i in range(3)] + [(i, "z", [9.0]) for i in range(6)]
        df = spark.createDataFrame(rows, "id int, y string, v array<double>")
        new = smote_classes(df, "y", "id", "v").collect()
        assert sorted(r.y for r in new) == ["x"] * 4 + ["y"] * 3
        assert all(0 <= r.v[0] <= 1 if r.y == "x" else 60 <= r.v[0] <= 62 for r in new)
        lone = df.unionByName(spark.createDataFrame([(99, "w", [0.0])], df.schema))
        with pytest.raises(Exception, match="at least two rows"):
            smote_classes(lone, "y", "id", "v").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_interval_join_of_long_and_short_intervals(spark):
    """Intervals of 400 days and a few of 40,000: the same pairs as when all are compared."""
    from cohortspark.operators.joins import interval_join

    day = F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")
    i = F.col("id")
    intervals = spark.range(3_000).select(
        (i % 40).alias("k"), i.alias("stay"),
        F.timestamp_add("DAY", (i * 7 % 30_000).cast("int"), day).alias("s"),
        F.timestamp_add("DAY", (i * 7 % 30_000 + F.when(i % 500 == 0, 40_000).otherwise(400)).cast("int"), day).alias("e"),
    )
    points = spark.range(2_000).select((i % 45).alias("k"), i.alias("n"), F.timestamp_add("HOUR", (i * 331).cast("int"), day).alias("t"))
    got = interval_join(points, intervals, "k", "t", "s", "e")
    both = points.alias("p").join(intervals.alias("q"), F.expr("p.k = q.k and p.t >= q.s and p.t < q.e"), "left")
    want = both.selectExpr("p.*", "q.stay", "q.s", "q.e")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_interval_join_refuses_outer(spark):
    import pytest

    from cohortspark.operators.joins import interval_join

    df = spark.createDataFrame([], "k int, t timestamp_ntz, s timestamp_ntz, e timestamp_ntz")
    with pytest.raises(ValueError, match="left and inner"):
        interval_join(df, df, "k", "t", "s", "e", how="full")


def test_votes_of_weight_zero_count_equally(spark):
    from cohortspark.operators.training import soft_vote

    df = spark.createDataFrame([([0.2, 0.8], [0.4, 0.6])], "a array<double>, b array<double>")
    row = soft_vote(df, {"a": 0.0, "b": 0.0}).first()
    assert [round(x, 9) for x in row.vote] == [0.3, 0.7] and row.prediction == 1


def test_sums_per_order_stay_dealt_over_all_partitions(spark, tmp_path):
    """Interval join with fuzzy bounds: the adaptive plan must not merge the tasks that join and sum per order."""
    from datetime import datetime

    from cohortspark.queries.preparation import interval_join_fuzzy, _pivoted

    day = datetime(2020, 1, 5)
    orders = [(1, 7, day, "F", 1.0), (2, 7, datetime(2020, 1, 20), "F", 1.0), (None, 8, day, "F", 1.0), (4, None, day, "O", 1.0)]
    lines = [(1, 1, 10.0, "A", "F", day), (1, 2, 20.0, "A", "F", day), (2, 1, 5.0, "R", "F", datetime(2020, 3, 1)),
             (None, 1, 5.0, "R", "F", day), (4, 1, 8.0, "N", "O", day), (9, 1, 8.0, "N", "O", day)]
    types = "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string, o_totalprice double"
    spark.createDataFrame(orders, types).write.parquet(f"{tmp_path}/orders.parquet")
    types = "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, types).write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _pivoted(spark, str(tmp_path), ["hadm"]).rdd.getNumPartitions() == parts > 1
    out = {(r.subject, r.hadm, r.acid, r.base, r.salt, r.episode) for r in interval_join_fuzzy(spark, str(tmp_path)).collect()}
    assert out == {(7, 1, 15.0, None, None, 1), (7, 2, None, None, 5.0, None), (None, 4, None, 8.0, None, None)}
