"""Queries: model training, cross-validation, searches, federated rounds, and tables written and read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortspark.operators import features as ft
from cohortspark.operators import metrics as mt
from cohortspark.operators import sampling as sp
from cohortspark.operators import training as tr
from cohortspark.queries.base import IMB, SERIES, WEEKLY, imb, query, r6, rounded, series, table, vec, weekly
from cohortspark.session import shared_dir
from cohortspark.sources import tables as tb


def _rows(spark, d):
    """Vectors with an imbalanced class."""
    return vec(spark, d).select("vec_id", (F.col("label") < 2).cast("int").alias("y"), "embedding")


def _parts(spark, d):
    rows = sp.stratified_split(_rows(spark, d), "vec_id", "y", 0.2)
    return rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split")


def _said(model, test):
    out = tr.predict(model, test, "embedding", ["vec_id", "y"])
    return out.select("vec_id", "y", "prediction", r6(F.col("probability")[1], "p1"))


FAST_FOREST = {"numTrees": 20, "maxDepth": 6}


@query("forest_predict")
def forest_predict(spark, d):
    train, test = _parts(spark, d)
    model = tr.fit_forest(sp.undersample(train, "y", "vec_id"), "embedding", "y", **FAST_FOREST)
    return _said(model, test)


@query("gbt_predict")
def gbt_predict(spark, d):
    train, test = _parts(spark, d)
    return _said(tr.fit_gbt(train, "embedding", "y", maxIter=10, maxDepth=4), test)


@query("balanced_forest")
def balanced_forest(spark, d):
    train, test = _parts(spark, d)
    return _said(tr.fit_balanced_forest(train, "embedding", "y", "vec_id", **FAST_FOREST), test)


_HASH = "md5(concat_ws('|', '42', CAST(vec_id AS VARCHAR)))"
_DRAWN = "CAST(('0x' || substr(md5(concat_ws('|', '42t', y, tree, draw)), 1, 8)) AS BIGINT)"


@query("balanced_bootstrap", f"""
WITH r AS (SELECT vec_id, CASE WHEN label < 2 THEN 1 ELSE 0 END AS y FROM embeddings),
 k AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {_HASH}, vec_id) AS place FROM r),
 n AS (SELECT y, count(*) AS n FROM r GROUP BY 1),
 d AS (SELECT y, n, tree, draw FROM n, (SELECT unnest(generate_series(0, 19)) AS tree) t,
  (SELECT unnest(generate_series(1, (SELECT min(n) FROM n))) AS draw) w),
 p AS (SELECT *, floor({_DRAWN} / 4294967296.0::DOUBLE * n) + 1 AS place FROM d)
SELECT tree, y, draw, vec_id FROM p JOIN k USING (y, place)""")
def balanced_bootstrap(spark, d):
    """Which row every tree of the balanced forest draws."""
    return sp.balanced_bootstrap(_rows(spark, d), "y", "vec_id", 20).select("tree", "y", "draw", "vec_id")


@query("logistic_panel")
def logistic_panel(spark, d):
    """Random-convolution features of the panels, logistic regression on them."""
    train, test = _parts(spark, d)
    kernels = ft.make_kernels(50, 64, 1)

    def features(df):
        return ft.panel_features(
            df.withColumn("panel", F.array("embedding")), "panel", kernels, ["vec_id", "y"]
        ).withColumnRenamed("features", "embedding")

    return _said(tr.fit_logistic(features(train), "embedding", "y", maxIter=100, regParam=0.01), features(test))


@query("feature_importance")
def feature_importance(spark, d):
    rows = _rows(spark, d)
    model = tr.fit_forest(rows, "embedding", "y", **FAST_FOREST)
    return rounded(ft.feature_importance(model, [f"v{i}" for i in range(64)], rows), ["importance"])


@query("grid_search")
def grid_search(spark, d):
    grid = {"numTrees": [5, 10], "maxDepth": [3, 5]}
    return tr.grid_search(_rows(spark, d), "embedding", "y", "vec_id", grid, k=3)[1]


@query("random_search")
def random_search(spark, d):
    ranges = {"numTrees": (3, 12), "maxDepth": (2, 6), "impurity": ["gini", "entropy"]}
    return tr.random_search(_rows(spark, d), "embedding", "y", "vec_id", 3, ranges, k=3)[1]


@query("cross_validate")
def cross_validate(spark, d):
    """Folds with the minority filled up by synthetic rows, in the training parts only."""
    return tr.cross_validate(
        _rows(spark, d), lambda t: tr.fit_logistic(t, "embedding", "y", maxIter=50, regParam=0.01),
        "embedding", "y", "vec_id", k=3, resampling="smote",
    )


@query("cross_validate_under")
def cross_validate_under(spark, d):
    return tr.cross_validate(
        _rows(spark, d), lambda t: tr.fit_logistic(t, "embedding", "y", maxIter=50, regParam=0.01),
        "embedding", "y", "vec_id", k=3, resampling="under",
    )


def _clients(spark, d):
    return sp.client_split(_rows(spark, d), "vec_id", 4, "y")


@query("federated_fit")
def federated_fit(spark, d):
    return tr.federated_fit(_clients(spark, d), "client", "embedding", "y", "vec_id", rounds=4, local_steps=2)[1]


@query("federated_scores")
def federated_scores(spark, d):
    """Scores of the averaged model after every round, per client and part."""
    return tr.federated_scores(_clients(spark, d), "client", "embedding", "y", "vec_id", rounds=4, local_steps=2)


_MEANS = """(SELECT client, i, avg(x) FILTER (y = 1) - avg(x) FILTER (y = 0) AS w FROM
 (SELECT vec_id % 3 AS client, CASE WHEN label < 2 THEN 1 ELSE 0 END AS y, unnest(embedding)::DOUBLE AS x,
   generate_subscripts(embedding, 1) AS i FROM embeddings) e GROUP BY client, i)"""


@query("round_scores", f"""
WITH z AS (SELECT vec_id, e.client, y, sum(x * w) AS z FROM
  (SELECT vec_id, vec_id % 3 AS client, CASE WHEN label < 2 THEN 1 ELSE 0 END AS y, unnest(embedding)::DOUBLE AS x,
    generate_subscripts(embedding, 1) AS i FROM embeddings) e JOIN {_MEANS} m ON e.client = m.client AND e.i = m.i
  GROUP BY vec_id, e.client, y),
 x AS (SELECT client, round, y, 1 / (1 + exp(-(round * z - 0.25::DOUBLE))) AS s FROM z, (SELECT unnest([1, 2, 3]) AS round) r),
 t AS (SELECT k, CASE WHEN k = 0 THEN -1e-7 WHEN k = 199 THEN 1 + 1e-7 ELSE k / 199.0::DOUBLE END AS t
  FROM (SELECT unnest(generate_series(0, 199)) AS k) g),
 c AS (SELECT client, round, k, count(*) FILTER (y = 1 AND s > t) AS tp, count(*) FILTER (y = 0 AND s > t) AS fp,
  count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM t, x GROUP BY client, round, k),
 d AS (SELECT *, lead(tp) OVER w AS tp1, lead(fp) OVER w AS fp1 FROM c WINDOW w AS (PARTITION BY client, round ORDER BY k)),
 e AS (SELECT *, tp - tp1 AS dtp, tp + fp AS s0, tp1 + fp1 AS s1 FROM d WHERE tp1 IS NOT NULL),
 g AS (SELECT *, CASE WHEN s0 > s1 THEN dtp / (s0 - s1) ELSE 0 END AS slope FROM e),
 areas AS (SELECT client, round, sum((fp - fp1) / n * (tp + tp1) / p / 2) AS auroc_grid,
  sum(slope * (dtp + (tp1 - slope * s1) * ln(CASE WHEN s0 > 0 AND s1 > 0 THEN s0 / s1 ELSE 1 END)) / p) AS auprc_grid
  FROM g GROUP BY client, round),
 m AS (SELECT client, round, count(*) AS n, count(*) FILTER (y = 1 AND s > 0.5) AS tp, count(*) FILTER (y = 0 AND s > 0.5) AS fp,
  count(*) FILTER (y = 1 AND s <= 0.5) AS fn FROM x GROUP BY client, round)
SELECT client, round, n, round(auroc_grid, 6) AS auroc_grid, round(auprc_grid, 6) AS auprc_grid,
 round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
 round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
 round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1,
 round((n - fp - fn) / n, 6) AS accuracy FROM areas JOIN m USING (client, round)""")
def round_scores(spark, d):
    """Three rounds of a model per client: the difference of its class means, growing with the round."""
    rows = _rows(spark, d).withColumn("client", F.col("vec_id") % 3)
    cells = rows.select("client", "y", F.posexplode(F.col("embedding").cast("array<double>")).alias("i", "x"))
    gap = F.avg(F.when(F.col("y") == 1, F.col("x"))) - F.avg(F.when(F.col("y") == 0, F.col("x")))
    means = cells.groupBy("client", "i").agg(gap.alias("w"))
    vectors = means.groupBy("client").agg(F.sort_array(F.collect_list(F.struct("i", "w")))["w"].alias("w"))
    by_round = vectors.withColumn("round", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    grown = F.concat(F.transform("w", lambda x: x * F.col("round")), F.array(F.lit(-0.25)))
    weights = by_round.select("client", "round", grown.alias("weights"))
    out = tr.round_scores(rows, weights, "client", "embedding", "y")
    return rounded(out, ["auroc_grid", "auprc_grid", "precision", "recall", "f1", "accuracy"])


@query("local_fit")
def local_fit(spark, d):
    return tr.local_fit(_clients(spark, d), "client", "embedding", "y", "vec_id", rounds=4)[1]


@query("central_fit")
def central_fit(spark, d):
    """The local model with a single client."""
    rows = _rows(spark, d).withColumn("client", F.lit(1))
    return tr.local_fit(rows, "client", "embedding", "y", "vec_id", rounds=4)[1]


def _folder(spark) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(spark)}/tables-{uuid4().hex}"


@query("table_roundtrip", "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders")
def table_roundtrip(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return tb.read_snapshot(spark, tb.write_table(rows, _folder(spark), "demographics", 96))


@query("snapshot_roundtrip", f"SELECT entity, t, value, item FROM {SERIES} s")
def snapshot_roundtrip(spark, d):
    path = _folder(spark) + "/series"
    tb.write_snapshot(series(spark, d).select("entity", "t", "value", "item"), path, ["item"])
    return tb.read_snapshot(spark, path).withColumn("item", F.col("item").cast("string"))


def _bucketed(spark, d):
    """Events and weekly stays as tables with the same buckets of entities."""
    folder, run = _folder(spark), uuid4().hex
    rows = series(spark, d).select("entity", "t", "value", "item")
    events = tb.write_bucketed(rows, f"events_{run}", "entity", 8, ["t"], f"{folder}/events")
    stays = tb.write_bucketed(weekly(spark, d), f"stays_{run}", "entity", 8, ["intime"], f"{folder}/stays")
    return events, stays


@query("bucketed_join", f"""
SELECT e.entity, week, t, value, row_number() OVER (PARTITION BY e.entity ORDER BY t, week) AS place
FROM {SERIES} e JOIN {WEEKLY} w ON e.entity = w.entity AND t >= intime AND t <= outtime""")
def bucketed_join(spark, d):
    """Tables bucketed by entity, joined and numbered by entity without a shuffle."""
    events, stays = (rows.hint("merge") for rows in _bucketed(spark, d))
    met = events.join(stays, "entity").filter("t >= intime AND t <= outtime")
    place = F.row_number().over(Window.partitionBy("entity").orderBy("t", "week"))
    return met.select("entity", "week", "t", "value", place.alias("place"))


@query("create_table", "SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders")
def create_table(spark, d):
    """A catalog table sorted inside its files, read back by name."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return tb.create_table(rows, f"orders_{uuid4().hex}", ["o_custkey", "o_orderdate"], path=_folder(spark) + "/orders")


@query("scores_roundtrip", f"""
SELECT 'bin' AS label, 'fl' AS model, CAST(2 AS INTEGER) AS n_clients, CAST(96 AS INTEGER) AS "window", 'test' AS split, 'accuracy' AS metric,
 doc_id % 5 AS fold, CASE WHEN lang = 'en' THEN 1 ELSE 2 END AS client, 0 AS epoch,
 round(avg(CASE WHEN quality = pred THEN 1.0 ELSE 0.0 END), 6) AS value FROM {IMB} x GROUP BY ALL""")
def scores_roundtrip(spark, d):
    """Scores of a run written and read back; the run has no predictions, so they add no rows."""
    cells = mt.binary_metrics(
        imb(spark, d).withColumns({"fold": F.col("doc_id") % 5, "client": F.when(F.col("lang") == "en", 1).otherwise(2)}),
        "quality", "pred", ["fold", "client"],
    )
    scores = cells.select(
        F.lit("bin").alias("label"), F.lit("fl").alias("model"), F.lit(2).alias("n_clients"), F.lit(96).alias("window"),
        F.lit("test").alias("split"), F.lit("accuracy").alias("metric"), F.col("fold").cast("int").alias("fold"),
        F.col("client").cast("int").alias("client"), F.lit(0).alias("epoch"), r6("accuracy", "value"),
    )
    folder = _folder(spark)
    tb.write_scores(scores, folder)
    found = tb.read_scores(spark, folder, label="bin", model="fl")
    none = tb.read_scores(spark, folder, "predictions", label="bin").select(
        "label", "model", "n_clients", "window", F.lit("test").alias("split"), F.lit("pair").alias("metric"), "fold",
        "client", F.lit(0).alias("epoch"), F.col("y_pred").alias("value"),
    )
    return found.unionByName(none)
