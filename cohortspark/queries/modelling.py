"""Queries: features, splits, balancing, metrics and voting."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.operators import aggregates as ag
from cohortspark.operators import features as ft
from cohortspark.operators import metrics as mt
from cohortspark.operators import sampling as sp
from cohortspark.operators import training as tr
from cohortspark.queries.base import (
    IMB, SERIES, SIGNALS, WIDE, imb, query, r6, rounded, series, table, vec, wide,
)

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("one_hot", "SELECT c_custkey, " + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE 0 END AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + " FROM customer")
def one_hot(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return ft.one_hot(rows, ft.vocabulary(rows, ["c_mktsegment"]))


def _codes_sql(column, source):
    return (f"(SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {column} AS v FROM {source}) x"
            " WHERE v IS NOT NULL)")


def _parts(spark, d):
    lines = table(spark, d, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.concat(F.lit("part "), "l_partkey").alias("part"), "l_shipdate")


_PARTS = "(SELECT l_orderkey, l_linenumber, 'part ' || l_partkey AS part, l_shipdate FROM lineitem)"


@query("label_encode_joined", f"""
SELECT l_orderkey, l_linenumber, a.code AS part, b.code AS l_shipdate FROM {_PARTS} p
LEFT JOIN {_codes_sql('part', _PARTS + " t WHERE l_linenumber < 4")} a ON p.part = a.v
LEFT JOIN {_codes_sql('l_shipdate', _PARTS + " t WHERE l_linenumber < 4")} b ON p.l_shipdate = b.v""")
def label_encode_joined(spark, d):
    """Part and day of every line, coded by the dictionaries of the training part (the first lines of an order)."""
    rows = _parts(spark, d)
    train = rows.filter("l_linenumber < 4")
    return ft.encode_joined(rows, {c: ft.dictionary(train, c) for c in ("part", "l_shipdate")})


@query("one_hot_sparse", f"""
WITH a AS {_codes_sql('part', _PARTS + " t WHERE l_linenumber < 4")}, b AS {_codes_sql('l_shipdate', _PARTS + " t WHERE l_linenumber < 4")},
 n AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb)
SELECT l_orderkey, l_linenumber, na + nb AS size, a.code AS position FROM {_PARTS} p JOIN a ON p.part = a.v, n
UNION ALL SELECT l_orderkey, l_linenumber, na + nb, na + b.code FROM {_PARTS} p JOIN b ON p.l_shipdate = b.v, n""")
def one_hot_sparse(spark, d):
    """The same as sparse positions, written out as rows."""
    rows = _parts(spark, d)
    train = rows.filter("l_linenumber < 4")
    hot = ft.one_hot_sparse(rows, {c: ft.dictionary(train, c) for c in ("part", "l_shipdate")}, "features")
    return hot.select("l_orderkey", "l_linenumber", "features.size", F.explode("features.positions").alias("position"))


@query("label_encode", """
SELECT c_custkey, r - 1 AS c_mktsegment FROM customer JOIN
 (SELECT c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) AS r FROM (SELECT DISTINCT c_mktsegment FROM customer) x) y
 USING (c_mktsegment)""")
def label_encode(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return ft.label_encode(rows, ft.vocabulary(rows, ["c_mktsegment"]))


@query("minmax_scale", "SELECT entity, t, " + ", ".join(
    f"round(({s} - (SELECT min({s}) FILTER ({s} >= 0) FROM {WIDE} m)) / ((SELECT max({s}) FROM {WIDE} m) - (SELECT min({s}) FILTER ({s} >= 0) FROM {WIDE} m)), 6) AS {s}"
    for s in ["view", "click"]) + f" FROM {WIDE} w")
def minmax_scale(spark, d):
    rows = wide(spark, d).select("entity", "t", "view", "click")
    bounds = ag.minmax_bounds(rows, ["view", "click"])
    return rounded(ft.minmax_scale(rows, bounds, ["view", "click"]), ["view", "click"])


_AGES = " ".join(
    f"WHEN age >= {lo} AND age < {hi} THEN '{name}'"
    for lo, hi, name in zip([0, 9, 19, 29, 39, 49, 59, 69, 79, 89], [9, 19, 29, 39, 49, 59, 69, 79, 89, 400],
                            ["0-9", "10-19", "20-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80-89", "90+"]))


@query("static_features", f"""
SELECT icustay_id, gender, ethnicity_grouped, label_cor_art, diabetes_mellitus, anemia_flag,
 CASE {_AGES} END AS age_group, ckd FROM
 (SELECT c_custkey AS icustay_id, CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS ethnicity_grouped,
  CASE WHEN c_nationkey < 8 THEN 1 ELSE 0 END AS label_cor_art, CASE WHEN c_nationkey > 15 THEN 1 ELSE 0 END AS diabetes_mellitus,
  CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS anemia_flag, c_acctbal / 100 AS age,
  CASE WHEN c_acctbal > 8000 THEN 1 ELSE 0 END AS ckd FROM customer) x""")
def static_features(spark, d):
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("icustay_id"),
        F.when(F.col("c_nationkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("c_mktsegment").alias("ethnicity_grouped"),
        (F.col("c_nationkey") < 8).cast("int").alias("label_cor_art"),
        (F.col("c_nationkey") > 15).cast("int").alias("diabetes_mellitus"),
        (F.col("c_acctbal") < 0).cast("int").alias("anemia_flag"),
        (F.col("c_acctbal") / 100).alias("age"),
        (F.col("c_acctbal") > 8000).cast("int").alias("ckd"),
    )
    return ft.static_features(rows, "icustay_id", "age")


@query("aggregate_features", f"""
SELECT entity, round(view, 6) AS view, round(click, 6) AS click, round(purchase, 6) AS purchase, c_mktsegment FROM
 (SELECT entity, avg(view) AS view, avg(click) AS click FROM {WIDE} w GROUP BY 1) a
 JOIN (SELECT entity, avg(purchase) AS purchase FROM {WIDE} w GROUP BY 1) b USING (entity)
 JOIN (SELECT c_custkey AS entity, c_mktsegment FROM customer) c USING (entity)""")
def aggregate_features(spark, d):
    rows = wide(spark, d).na.fill(-1.0, SIGNALS)
    people = table(spark, d, "customer").select(F.col("c_custkey").alias("entity"), "c_mktsegment")
    out = ft.aggregate_features([(rows, ["view", "click"]), (rows, ["purchase"])], people, "entity")
    return rounded(out, ["view", "click", "purchase"])


@query("feature_set", f"SELECT entity, t, view, error FROM {WIDE} w")
def feature_set(spark, d):
    sets = {"all": SIGNALS, "ends": ["view", "error"]}
    return ft.feature_set(wide(spark, d), ["entity", "t"], "ends", sets)


# Three literal kernels on one channel, checked against SQL.
KERNELS = [
    {"weights": [[1.0, 0.0, -1.0]], "bias": 0.05, "dilation": 1, "padding": 0, "channels": [0]},
    {"weights": [[0.5, -1.0, 0.5]], "bias": -0.1, "dilation": 4, "padding": 0, "channels": [0]},
    {"weights": [[1.0, 1.0, 1.0]], "bias": 0.0, "dilation": 2, "padding": 2, "channels": [0]},
]


def _kernel_sql(i, k):
    w, dil, pad = k["weights"][0], k["dilation"], k["padding"]
    width = 64 + 2 * pad - 2 * dil
    terms = " + ".join(
        f"{c}::DOUBLE * coalesce(x[p + 1 + {j * dil - pad}]::DOUBLE * (CASE WHEN p + {j * dil - pad} BETWEEN 0 AND 63 THEN 1 ELSE 0 END), 0)"
        for j, c in enumerate(w))
    return f"""SELECT vec_id, {2 * i} AS position, round(max(v), 6) AS value FROM k{i} GROUP BY 1
 UNION ALL SELECT vec_id, {2 * i + 1}, round(avg(CASE WHEN v > 0 THEN 1.0 ELSE 0.0 END), 6) FROM k{i} GROUP BY 1""", f"""
 k{i} AS (SELECT vec_id, {terms} + {k['bias']}::DOUBLE AS v FROM (SELECT vec_id, embedding AS x, unnest(generate_series(0, {width - 1})) AS p FROM embeddings) e)"""


@query("panel_features", "WITH " + ", ".join(_kernel_sql(i, k)[1] for i, k in enumerate(KERNELS)) + " "
       + " UNION ALL ".join(_kernel_sql(i, k)[0] for i, k in enumerate(KERNELS)))
def panel_features(spark, d):
    panels = vec(spark, d).select("vec_id", F.array("embedding").alias("panel"))
    out = ft.panel_features(panels, "panel", KERNELS, ["vec_id"])
    return out.select("vec_id", F.posexplode("features").alias("position", "value")).withColumn("value", F.round("value", 6))


@query("panel_features_random")
def panel_features_random(spark, d):
    panels = vec(spark, d).select("vec_id", F.array("embedding").alias("panel"))
    return ft.panel_features(panels, "panel", ft.make_kernels(100, 64, 1), ["vec_id"])


# --- splits and balancing -----------------------------------------------------------------------------------------

_H = "md5(concat_ws('|', '42', CAST(doc_id AS VARCHAR)))"


def _rank(by):
    part = f"PARTITION BY {by} " if by else ""
    return f"(SELECT *, row_number() OVER ({part}ORDER BY {_H}, doc_id) AS r, count(*) OVER ({part.strip()}) AS n FROM {IMB} x)"


@query("split_stratified", f"SELECT doc_id, quality, CASE WHEN r <= floor(n * 0.25::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS split FROM {_rank('quality')} y")
def split_stratified(spark, d):
    return sp.stratified_split(imb(spark, d), "doc_id", "quality", 0.25).select("doc_id", "quality", "split")


_U = "CAST(('0x' || substr(md5(concat_ws('|', '{0}', {1})), 1, 8)) AS BIGINT)"


@query("split_random", f"SELECT doc_id, CASE WHEN {_U.format(42, 'CAST(doc_id AS VARCHAR)')} / 4294967296.0::DOUBLE < 0.2::DOUBLE THEN 'test' ELSE 'train' END AS split FROM documents")
def split_random(spark, d):
    return sp.random_split(table(spark, d, "documents").select("doc_id"), "doc_id", 0.2)


@query("split_ordered", """
SELECT vec_id, CASE WHEN r <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM
 (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r, count(*) OVER () AS n FROM embeddings) x WHERE vec_id NOT IN (3, 499)""")
def split_ordered(spark, d):
    return sp.ordered_split(vec(spark, d), "vec_id", 0.8, exclude=[3, 499])


@query("kfold", f"SELECT doc_id, quality, (r - 1) % 5 AS fold FROM {_rank('quality')} y")
def kfold(spark, d):
    return sp.kfold(imb(spark, d), "doc_id", "quality", 5).select("doc_id", "quality", "fold")


@query("client_split", f"SELECT doc_id, quality, (r - 1) % 4 + 1 AS client FROM {_rank('quality')} y")
def client_split(spark, d):
    return sp.client_split(imb(spark, d), "doc_id", 4, "quality").select("doc_id", "quality", "client")


@query("client_split_plain", f"SELECT doc_id, (r - 1) % 4 + 1 AS client FROM {_rank('')} y")
def client_split_plain(spark, d):
    return sp.client_split(imb(spark, d), "doc_id", 4).select("doc_id", "client")


@query("valid_split", f"""
SELECT doc_id, client, CASE WHEN r <= floor(n * 0.85::DOUBLE + 0.5) THEN 'train' ELSE 'valid' END AS split FROM
 (SELECT *, row_number() OVER (PARTITION BY client, quality ORDER BY {_H}) AS r, count(*) OVER (PARTITION BY client, quality) AS n
  FROM (SELECT *, (r - 1) % 4 + 1 AS client FROM {_rank('quality')} y) c) z""".replace("SELECT *, (r - 1)", "SELECT doc_id, quality, (r - 1)"))
def valid_split(spark, d):
    clients = sp.client_split(imb(spark, d), "doc_id", 4, "quality")
    return sp.valid_split(clients, "doc_id", "client", "quality").select("doc_id", "client", "split")


@query("undersample", f"SELECT doc_id, quality FROM {_rank('quality')} y WHERE r <= (SELECT min(n) FROM {_rank('quality')} z)")
def undersample(spark, d):
    return sp.undersample(imb(spark, d), "quality", "doc_id").select("doc_id", "quality")


@query("undersample_targets", f"SELECT doc_id, lang FROM {_rank('lang')} y WHERE r <= CASE lang WHEN 'en' THEN 95 WHEN 'de' THEN 11 ELSE n END")
def undersample_targets(spark, d):
    return sp.undersample(imb(spark, d), "lang", "doc_id", {"en": 95, "de": 11}).select("doc_id", "lang")


@query("oversample", f"""
SELECT doc_id, quality, unnest(generate_series(1, CAST(floor(m / n) + CASE WHEN r <= m % n THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM
 (SELECT *, (SELECT max(n) FROM {_rank('quality')} z) AS m FROM {_rank('quality')} y) x""")
def oversample(spark, d):
    return sp.oversample(imb(spark, d), "quality", "doc_id").select("doc_id", "quality", "copy")


_BINS = [(0.0, 0.125), (0.125, 0.375), (0.375, 0.625), (0.625, 0.875), (0.875, 1.0)]


@query("class_weights", f"""
WITH x AS {IMB}, c AS (SELECT count(*) AS n, {', '.join(f'count(*) FILTER (score >= {lo} AND score <= {hi}) AS c{i}' for i, (lo, hi) in enumerate(_BINS))} FROM x)
SELECT doc_id, round(CASE least(floor(score * 5), 4) {' '.join(f'WHEN {i} THEN n / nullif(c{i}, 0)' for i in range(5))} END, 6) AS weight FROM x, c""")
def class_weights(spark, d):
    return rounded(sp.class_weights(imb(spark, d), "score", 5).select("doc_id", "weight"), ["weight"])


@query("batches", f"SELECT doc_id, quality, floor((r - 1) / 32) AS batch FROM {_rank('quality')} y")
def batches(spark, d):
    return sp.assign_batches(imb(spark, d), "doc_id", 32, ["quality"]).select("doc_id", "quality", "batch")


@query("sampling_report", f"""
SELECT quality, count(*) AS n, 'before' AS stage FROM labels WHERE doc_id IN (SELECT doc_id FROM documents) GROUP BY 1
UNION ALL SELECT quality, count(*), 'after' FROM {_rank('quality')} y WHERE r <= (SELECT min(n) FROM {_rank('quality')} z) GROUP BY 1""")
def sampling_report(spark, d):
    rows = imb(spark, d)
    return sp.sampling_report(rows, sp.undersample(rows, "quality", "doc_id"), "quality")


_VH = "md5(concat_ws('|', '42', CAST(vec_id AS VARCHAR)))"
_COPY = "CAST(vec_id AS VARCHAR) || '|' || CAST(copy AS VARCHAR)"


@query("smote", f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CASE WHEN label = 3 THEN 1 ELSE 0 END AS y FROM embeddings),
 f AS (SELECT vec_id, x, row_number() OVER (ORDER BY {_VH}) AS r, count(*) OVER () AS n FROM v WHERE y = 1),
 nn AS (SELECT a.vec_id, b.vec_id AS neighbour,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_sum([(p - q) ** 2 for p, q in zip(a.x, b.x)]), b.vec_id) AS place
  FROM f a JOIN f b ON a.vec_id != b.vec_id),
 m AS (SELECT max(c) AS big FROM (SELECT count(*) AS c FROM v GROUP BY y) z),
 w AS (SELECT vec_id, x, unnest(generate_series(1, CAST(floor((big - n) / n) + CASE WHEN r <= (big - n) % n THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM f, m),
 p AS (SELECT *, {_U.format('42n', _COPY)} % 5 + 1 AS place, {_U.format('42l', _COPY)} / 4294967296.0::DOUBLE AS step FROM w)
SELECT p.vec_id, p.copy, nn.neighbour, i AS position, round(p.x[i + 1] + p.step * (b.x[i + 1] - p.x[i + 1]), 6) AS value
FROM p JOIN nn ON p.vec_id = nn.vec_id AND p.place = nn.place JOIN f b ON b.vec_id = nn.neighbour,
 (SELECT unnest(generate_series(0, 63)) AS i) k""".replace("list_sum([(p - q) ** 2 for p, q in zip(a.x, b.x)])", "list_distance(a.x, b.x)"))
def smote(spark, d):
    rows = vec(spark, d).select("vec_id", "embedding", (F.col("label") == 3).cast("int").alias("y"))
    new = sp.smote(rows, "y", 1, "vec_id", "embedding")
    return new.select("vec_id", "copy", "neighbour", F.posexplode("embedding").alias("position", "value")).withColumn(
        "value", F.round("value", 6)
    )


@query("smote_classes", f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings),
 f AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_VH}) AS r, count(*) OVER (PARTITION BY label) AS n FROM v),
 m AS (SELECT max(n) AS big FROM f),
 nn AS (SELECT a.vec_id, b.vec_id AS neighbour,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS place
  FROM f a JOIN f b ON a.label = b.label AND a.vec_id != b.vec_id),
 w AS (SELECT vec_id, label, x, unnest(generate_series(1, CAST(floor((big - n) / n) + CASE WHEN r <= (big - n) % n THEN 1 ELSE 0 END AS BIGINT))) AS copy
  FROM f, m),
 p AS (SELECT *, {_U.format('42n', _COPY)} % 5 + 1 AS place, {_U.format('42l', _COPY)} / 4294967296.0::DOUBLE AS step FROM w)
SELECT p.vec_id, p.label, p.copy, nn.neighbour, i AS position, round(p.x[i + 1] + p.step * (b.x[i + 1] - p.x[i + 1]), 6) AS value
FROM p JOIN nn ON p.vec_id = nn.vec_id AND p.place = nn.place JOIN f b ON b.vec_id = nn.neighbour,
 (SELECT unnest(generate_series(0, 63)) AS i) k""")
def smote_classes(spark, d):
    """Every class filled up to the largest."""
    new = sp.smote_classes(vec(spark, d).select("vec_id", "embedding", "label"), "label", "vec_id", "embedding")
    cells = F.posexplode("embedding").alias("position", "value")
    return new.select("vec_id", "label", "copy", "neighbour", cells).withColumn("value", F.round("value", 6))


# --- metrics ------------------------------------------------------------------------------------------------------


@query("confusion", f"""
SELECT a AS y_true, b AS y_pred, count(quality) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(a, b)
LEFT JOIN {IMB} x ON quality = a AND pred = b GROUP BY 1, 2""")
def confusion(spark, d):
    return mt.confusion(imb(spark, d), "quality", "pred", [0, 1])


@query("binary_metrics", f"""
SELECT lang, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision,
 round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall,
 round(CASE WHEN tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1, round(acc, 6) AS accuracy FROM
 (SELECT lang, count(*) FILTER (quality = 1 AND pred = 1) AS tp, count(*) FILTER (quality = 0 AND pred = 1) AS fp,
  count(*) FILTER (quality = 1 AND pred = 0) AS fn, avg(CASE WHEN quality = pred THEN 1.0 ELSE 0.0 END) AS acc FROM {IMB} x GROUP BY 1) y""")
def binary_metrics(spark, d):
    out = mt.binary_metrics(imb(spark, d), "quality", "pred", ["lang"])
    return rounded(out, ["precision", "recall", "f1", "accuracy"])


@query("classification_report", f"""
WITH c AS (SELECT l, count(*) FILTER (quality = l AND pred = l) AS tp, count(*) FILTER (pred = l) AS said,
  count(*) FILTER (quality = l) AS support FROM {IMB} x, (VALUES (0), (1)) g(l) GROUP BY 1),
 p AS (SELECT CAST(l AS VARCHAR) AS label, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, CASE WHEN said + support > 0 THEN 2 * tp / (said + support) ELSE 0 END AS f1, support FROM c),
 a AS (SELECT avg(CASE WHEN quality = pred THEN 1.0 ELSE 0.0 END) AS acc, count(*) AS n FROM {IMB} x)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM p
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), n FROM a
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM p
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
 round(sum(f1 * support) / sum(support), 6), sum(support) FROM p""")
def classification_report(spark, d):
    return rounded(mt.classification_report(imb(spark, d), "quality", "pred", [0, 1]), ["precision", "recall", "f1"])


_S = f"(SELECT score, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM {IMB} x GROUP BY 1)"
_C = f"(SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM {_S} s)"


@query("auroc", f"""
SELECT round(avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END), 6) AS auroc
FROM {IMB} a, {IMB} b WHERE a.quality = 1 AND b.quality = 0""")
def auroc(spark, d):
    """The SQL compares every positive with every negative row."""
    return rounded(mt.auroc(imb(spark, d), "quality", "score"), ["auroc"])


@query("auroc_by", f"""
SELECT a.lang, round(avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END), 6) AS auroc
FROM {IMB} a JOIN {IMB} b ON a.lang = b.lang WHERE a.quality = 1 AND b.quality = 0 GROUP BY 1""")
def auroc_by(spark, d):
    out = mt.auroc(imb(spark, d), "quality", "score", ["lang"])
    return rounded(out.filter(F.col("auroc").isNotNull()), ["auroc"])


@query("auprc", f"""
SELECT round(sum((recall - coalesce(prev_r, 0)) * (precision + coalesce(prev_p, 1)) / 2), 6) AS auprc FROM
 (SELECT *, lag(recall) OVER (ORDER BY score DESC) AS prev_r, lag(precision) OVER (ORDER BY score DESC) AS prev_p FROM
  (SELECT score, tp / p AS recall, tp / (tp + fp) AS precision FROM {_C} c) x) y""")
def auprc(spark, d):
    return rounded(mt.auprc(imb(spark, d), "quality", "score"), ["auprc"])


@query("roc_points", f"SELECT score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM {_C} c UNION ALL SELECT NULL, 0, 0")
def roc_points(spark, d):
    return rounded(mt.roc_points(imb(spark, d), "quality", "score"), ["fpr", "tpr"])


@query("pr_points", f"SELECT score AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM {_C} c UNION ALL SELECT NULL, 1, 0")
def pr_points(spark, d):
    return rounded(mt.pr_points(imb(spark, d), "quality", "score"), ["precision", "recall"])


@query("auc_grid", f"""
WITH x AS {IMB}, t AS (SELECT k, CASE WHEN k = 0 THEN -1e-7 WHEN k = 199 THEN 1 + 1e-7 ELSE k / 199.0::DOUBLE END AS t FROM (SELECT unnest(generate_series(0, 199)) AS k) g),
 c AS (SELECT k, count(*) FILTER (quality = 1 AND score > t) AS tp, count(*) FILTER (quality = 0 AND score > t) AS fp,
  count(*) FILTER (quality = 1) AS p, count(*) FILTER (quality = 0) AS n FROM t, x GROUP BY k),
 d AS (SELECT *, lead(tp) OVER w AS tp1, lead(fp) OVER w AS fp1 FROM c WINDOW w AS (ORDER BY k)),
 e AS (SELECT *, tp - tp1 AS dtp, tp + fp AS s0, tp1 + fp1 AS s1 FROM d WHERE tp1 IS NOT NULL),
 g AS (SELECT *, CASE WHEN s0 > s1 THEN dtp / (s0 - s1) ELSE 0 END AS slope FROM e)
SELECT round(sum((fp - fp1) / n * (tp + tp1) / p / 2), 6) AS auroc_grid,
 round(sum(slope * (dtp + (tp1 - slope * s1) * ln(CASE WHEN s0 > 0 AND s1 > 0 THEN s0 / s1 ELSE 1 END)) / p), 6) AS auprc_grid FROM g""")
def auc_grid(spark, d):
    return rounded(mt.auc_grid(imb(spark, d), "quality", "score"), ["auroc_grid", "auprc_grid"])


_PRED = f"(SELECT doc_id, CASE WHEN lang = 'en' THEN 'fl' ELSE 'lml' END AS model, doc_id % 5 AS fold, doc_id % 2 AS client, score AS y, ((doc_id * 37) % 129) / 128.0 AS yhat FROM {IMB} x)"


def _predictions(spark, d):
    return imb(spark, d).select(
        "doc_id",
        F.when(F.col("lang") == "en", "fl").otherwise("lml").alias("model"),
        (F.col("doc_id") % 5).alias("fold"),
        (F.col("doc_id") % 2).alias("client"),
        F.col("score").alias("y"),
        (((F.col("doc_id") * 37) % 129) / 128.0).alias("yhat"),
    )


_BIN5 = "CASE WHEN y > 0.125 AND y <= 0.375 THEN 1 WHEN y > 0.375 AND y <= 0.625 THEN 2 WHEN y > 0.625 AND y <= 0.875 THEN 3 WHEN y > 0.875 AND y <= 1 THEN 4 ELSE 0 END"
_BINNED = f"(SELECT model, fold, client, doc_id, label, CASE WHEN {_BIN5} = label THEN 1 ELSE 0 END AS y_bin, round(1 - least(abs(label - 4.0::DOUBLE * yhat), 1), 6) AS score FROM {_PRED} p, (SELECT unnest(generate_series(0, 4)) AS label) l)"


@query("binned_scores", f"SELECT doc_id, label, y_bin, score FROM {_BINNED} b WHERE label > 0")
def binned_scores(spark, d):
    out = mt.binned_scores(_predictions(spark, d), "y", "yhat", 5, ["doc_id"], drop_first=True)
    return rounded(out, ["score"])


@query("regression_errors", f"SELECT model, round(avg(abs(y - yhat)), 6) AS mae, round(avg((y - yhat) * (y - yhat)), 6) AS mse FROM {_PRED} p GROUP BY 1")
def regression_errors(spark, d):
    return rounded(mt.regression_errors(_predictions(spark, d), "y", "yhat", ["model"]), ["mae", "mse"])


@query("prevalence", "SELECT round(avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END), 6) AS prevalence FROM labels")
def prevalence(spark, d):
    return rounded(mt.prevalence(table(spark, d, "labels"), "toxic"), ["prevalence"])


_CELLS = "model, fold, client, label"
_CUBE = f"""(WITH b AS {_BINNED},
 flat AS (SELECT {_CELLS}, count(*) FILTER (y_bin = 1 AND score > 0.5) AS tp, count(*) FILTER (score > 0.5) AS said, count(*) FILTER (y_bin = 1) AS p, count(*) AS n FROM b GROUP BY {_CELLS}),
 s AS (SELECT {_CELLS}, score, sum(y_bin) AS pos, count(*) - sum(y_bin) AS neg FROM b GROUP BY {_CELLS}, score),
 c AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp FROM s WINDOW w AS (PARTITION BY {_CELLS} ORDER BY score DESC)),
 r AS (SELECT *, tp / nullif(tp + fp, 0) AS pr, lag(tp / nullif(tp + fp, 0)) OVER (PARTITION BY {_CELLS} ORDER BY score DESC) AS pr0 FROM c),
 a AS (SELECT {_CELLS}, sum(neg * (tp - pos + pos / 2)) / nullif(max(tp) * max(fp), 0) AS auroc,
  sum(pos * (pr + coalesce(pr0, 1)) / 2) / nullif(max(tp), 0) AS auprc FROM r GROUP BY {_CELLS}),
 l AS (SELECT {_CELLS}, 'precision' AS metric, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS value FROM flat
  UNION ALL SELECT {_CELLS}, 'recall', CASE WHEN p > 0 THEN tp / p ELSE 0 END FROM flat
  UNION ALL SELECT {_CELLS}, 'auroc', auroc FROM a UNION ALL SELECT {_CELLS}, 'auprc', auprc FROM a
  UNION ALL SELECT model, fold, client, NULL, 'mae', avg(abs(y - yhat)) FROM {_PRED} p GROUP BY 1, 2, 3
  UNION ALL SELECT model, fold, client, NULL, 'mse', avg((y - yhat) * (y - yhat)) FROM {_PRED} p GROUP BY 1, 2, 3)
 SELECT model, fold, label, metric, avg(value) AS value FROM l GROUP BY 1, 2, 3, 4)"""


def _cube(spark, d):
    rows = _predictions(spark, d)
    return mt.score_cube(rows, ["model"], "fold", "client", "y", "yhat", 5)


@query("score_cube", f"SELECT model, fold, label, metric, round(value, 6) AS value FROM {_CUBE} c")
def score_cube(spark, d):
    return rounded(_cube(spark, d), ["value"])


@query("add_f1", f"""
SELECT model, fold, label, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / nullif(p + r, 0), 6) AS f1 FROM
 (SELECT model, fold, label, max(value) FILTER (metric = 'precision') AS p, max(value) FILTER (metric = 'recall') AS r
  FROM {_CUBE} c WHERE label IS NOT NULL GROUP BY 1, 2, 3) x""")
def add_f1(spark, d):
    cells = _cube(spark, d).filter(F.col("label").isNotNull()).groupBy("model", "fold", "label").agg(
        F.max(F.when(F.col("metric") == "precision", F.col("value"))).alias("precision"),
        F.max(F.when(F.col("metric") == "recall", F.col("value"))).alias("recall"),
    )
    return rounded(mt.add_f1(cells), ["precision", "recall", "f1"])


@query("score_table", f"""
SELECT metric, printf('%.2f ± %.2f', avg(value) FILTER (model = 'fl'), stddev_pop(value) FILTER (model = 'fl')) AS fl,
 printf('%.2f ± %.2f', avg(value) FILTER (model = 'lml'), stddev_pop(value) FILTER (model = 'lml')) AS lml
FROM {_CUBE} c WHERE label IS NULL OR label >= 1 GROUP BY 1""")
def score_table(spark, d):
    rows = _cube(spark, d).filter(F.col("label").isNull() | (F.col("label") >= 1))
    return mt.score_table(rows, "metric", "model", "value", ["fl", "lml"])


@query("cv_summary", f"""
SELECT metric, label, round(avg(round(value, 2)), 2) AS mean FROM {_CUBE} c WHERE metric IN ('precision', 'recall') GROUP BY 1, 2""")
def cv_summary(spark, d):
    rows = _cube(spark, d).filter(F.col("metric").isin("precision", "recall"))
    return mt.cv_summary(rows, ["metric", "label"], "value")


@query("overall_scores", f"SELECT model, metric, round(avg(value), 6) AS value FROM {_CUBE} c WHERE label IN (0, 1) GROUP BY 1, 2")
def overall_scores(spark, d):
    rows = _cube(spark, d).filter(F.col("label").isin(0, 1))
    return rounded(mt.overall_scores(rows, ["model", "metric"], ["value"]), ["value"])


@query("cv_scores", f"""
SELECT model, label, metric, fold, round(value, 6) AS value, round(avg(value) OVER (PARTITION BY model, label, metric), 6) AS mean
FROM {_CUBE} c""")
def cv_scores(spark, d):
    """Folds of every model and label side by side; the array of fold scores is written out as rows."""
    metrics = {"precision": 1, "recall": 1, "auroc": 1, "auprc": 1, "mae": 0, "mse": 0}
    wide_rows = _cube(spark, d).groupBy("model", "label", "fold").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(f"c_{m}") for m in metrics]
    )
    out = mt.cv_scores(wide_rows, "fold", {m: f"c_{m}" for m in metrics}, ["model", "label"])
    rows = out.select("model", "label", "metric", "mean", F.posexplode("folds").alias("fold", "value"))
    # errors of the score itself have no label, class scores always have one
    labelled = F.col("label").isNotNull() == F.col("metric").isin(*[m for m, of_class in metrics.items() if of_class])
    return rounded(rows.filter(labelled), ["value", "mean"])


_ROUNDS = f"""(SELECT entity % 3 AS fold, entity % 2 AS client, day(t) AS epoch, avg(value) AS loss FROM {SERIES} s
 GROUP BY 1, 2, 3)"""


def _rounds(spark, d):
    rows = series(spark, d).withColumns({"fold": F.col("entity") % 3, "client": F.col("entity") % 2, "epoch": F.dayofmonth("t")})
    return rows.groupBy("fold", "client", "epoch").agg(F.avg("value").alias("loss"))


@query("learning_curve", f"""
WITH e AS (SELECT epoch, count(loss) AS n, avg(loss) AS a, min(loss) AS lo, max(loss) AS hi FROM {_ROUNDS} r GROUP BY 1),
 k AS (SELECT count(DISTINCT (fold, client)) AS k FROM {_ROUNDS} r)
SELECT epoch, round(CASE WHEN n = k THEN a END, 6) AS avg_value, round(CASE WHEN n = k THEN lo END, 6) AS min_value,
 round(CASE WHEN n = k THEN hi END, 6) AS max_value FROM e, k WHERE epoch <= (SELECT max(epoch) FROM e, k WHERE n = k)""")
def learning_curve(spark, d):
    """The curve ends at the last epoch that every fold and client reached."""
    out = mt.learning_curve(_rounds(spark, d), [], "epoch", "loss", ["fold", "client"])
    return rounded(out, ["avg_value", "min_value", "max_value"])


@query("best_round", f"""
WITH r AS {_ROUNDS},
 b AS (SELECT *, min(loss) OVER (PARTITION BY fold, client ORDER BY epoch) AS lo FROM r),
 c AS (SELECT *, max(CASE WHEN loss = lo THEN epoch END) OVER (PARTITION BY fold, client ORDER BY epoch) AS seen FROM b),
 s AS (SELECT fold, client, coalesce(min(epoch) FILTER (epoch - seen >= 5), max(epoch)) AS stop_round,
  min(epoch) FILTER (epoch - seen >= 5) AS cut FROM c GROUP BY 1, 2)
SELECT fold, client, arg_min(epoch, loss) AS best_round, round(min(loss), 6) AS best_loss, max(stop_round) AS stop_round
FROM r JOIN s USING (fold, client) WHERE cut IS NULL OR epoch < cut GROUP BY 1, 2""")
def best_round(spark, d):
    return rounded(mt.best_round(_rounds(spark, d), ["fold", "client"], "epoch", "loss", 5), ["best_loss"])


@query("pool_predictions", f"SELECT doc_id, y, yhat FROM (SELECT doc_id, y, CASE WHEN y > 0.1 THEN yhat END AS yhat FROM {_PRED} p) x WHERE yhat IS NOT NULL")
def pool_predictions(spark, d):
    rows = _predictions(spark, d).withColumn("yhat", F.when(F.col("y") > 0.1, F.col("yhat")))
    folds = [rows.filter(F.col("fold") == f).select("doc_id", "y", "yhat") for f in range(5)]
    return mt.pool_predictions(folds, "y", "yhat")


# --- voting and averaging -----------------------------------------------------------------------------------------


def _votes(spark, d):
    """Probabilities of three rules; one of them gives none for short documents."""
    rows = imb(spark, d)

    def pair(p):
        return F.array(1 - p, p)

    return {
        "chars": rows.select("doc_id", pair(F.col("score")).alias("proba")),
        "ids": rows.filter(F.col("n_chars") >= 500).select("doc_id", pair((F.col("doc_id") % 100) / 100.0).alias("proba")),
        "lang": rows.select("doc_id", pair(F.when(F.col("lang") == "en", 0.9).otherwise(0.25)).alias("proba")),
    }


_VOTES = f"""(SELECT doc_id, score AS a, (doc_id % 100) / 100.0::DOUBLE AS b, CASE WHEN lang = 'en' THEN 0.9 ELSE 0.25 END::DOUBLE AS c
 FROM {IMB} x WHERE n_chars >= 500)"""


@query("align_predictions", f"SELECT doc_id, round(a, 6) AS chars, round(b, 6) AS ids, round(c, 6) AS lang FROM {_VOTES} v")
def align_predictions(spark, d):
    out = tr.align_predictions(_votes(spark, d), "doc_id", "proba")
    return out.select("doc_id", *[r6(F.col(c)[1], c) for c in ("chars", "ids", "lang")])


@query("soft_vote", f"""
SELECT doc_id, round(p, 6) AS p1, CASE WHEN p > 1 - p THEN 1 ELSE 0 END AS prediction FROM
 (SELECT doc_id, (21 * a + 16 * b + 19 * c) / 56.0::DOUBLE AS p FROM {_VOTES} v) x""")
def soft_vote(spark, d):
    aligned = tr.align_predictions(_votes(spark, d), "doc_id", "proba")
    voted = tr.soft_vote(aligned, {"chars": 21, "ids": 16, "lang": 19})
    return voted.select("doc_id", r6(F.col("vote")[1], "p1"), "prediction")


@query("vote_weight", f"""
SELECT lang, round(ln(acc / (1 - acc)), 6) AS log_odds, round(acc / (1 - acc), 6) AS odds, round(acc, 6) AS fixed FROM
 (SELECT lang, avg(CASE WHEN quality = pred THEN 1.0 ELSE 0.0 END) AS acc FROM {IMB} x GROUP BY 1) y WHERE acc > 0 AND acc < 1""")
def vote_weight(spark, d):
    acc = mt.binary_metrics(imb(spark, d), "quality", "pred", ["lang"])
    out = acc.select("lang", *[r6(tr.vote_weight("accuracy", rule), rule) for rule in ("log_odds", "odds", "fixed")])
    return out.filter(F.col("odds").isNotNull())


@query("federated_average", """
WITH c AS (SELECT greatest(vec_id % 7, 3) AS client, i, avg(embedding[i + 1]) AS w, count(*) AS n FROM embeddings,
  (SELECT unnest(generate_series(0, 63)) AS i) k GROUP BY 1, 2)
SELECT i AS position, round(sum(n * w) / sum(n), 6) AS weight FROM c GROUP BY 1""")
def federated_average(spark, d):
    """Clients of different size, each with the mean vector of its rows as weights."""
    rows = vec(spark, d).withColumn("client", F.greatest(F.col("vec_id") % 7, F.lit(3)))
    v = F.col("embedding").cast("array<double>")
    clients = rows.withColumn("v", v).groupBy("client").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("v")[i]) for i in range(64)]).alias("w")
    )
    return rounded(tr.federated_average(clients, [], "n", "w"), ["weight"])
