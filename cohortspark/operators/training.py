"""Model training and inference on Spark ML, federated averaging, and weighted voting.

Features are an ``array<double>`` column; models read it as a vector.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.operators.metrics import auc_grid, binary_metrics, classification_report
from cohortspark.operators.sampling import balanced_bootstrap, hash_fraction, kfold, oversample, smote_classes, undersample
from cohortspark.session import cut_lineage, shared_dir

VECTOR = "_vector"


def as_vectors(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.withColumns(
        {VECTOR: array_to_vector(F.col(features).cast("array<double>")), label: F.col(label).cast("double")}
    )


# Tuned forest settings (unbounded depth becomes the largest depth Spark allows).
FOREST = {"numTrees": 200, "maxDepth": 30, "minInstancesPerNode": 2, "featureSubsetStrategy": "sqrt", "seed": 42}
LOGISTIC = {"maxIter": 1000, "regParam": 0.0}
BOOSTED = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
           "seed": 42}
# Grid of the forest search, and ranges of the randomised search.
FOREST_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [30, 5, 10],
    "minInstancesPerNode": [1, 2, 4],
    "featureSubsetStrategy": ["sqrt", "log2"],
}
FOREST_RANGES = {
    "numTrees": (50, 500),
    "maxDepth": (1, 10),
    "featureSubsetStrategy": ["auto", "sqrt", "log2"],
    "impurity": ["gini", "entropy"],
}


def forest(label: str, **params) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=VECTOR, labelCol=label, **{**FOREST, **params})


def logistic(label: str, **params) -> LogisticRegression:
    return LogisticRegression(featuresCol=VECTOR, labelCol=label, **{**LOGISTIC, **params})


def boosted(label: str, **params) -> GBTClassifier:
    return GBTClassifier(featuresCol=VECTOR, labelCol=label, **{**BOOSTED, **params})


def fit_forest(df: DataFrame, features: str, label: str, **params):
    return forest(label, **params).fit(as_vectors(df, features, label))


def fit_logistic(df: DataFrame, features: str, label: str, **params):
    return logistic(label, **params).fit(as_vectors(df, features, label))


def fit_gbt(df: DataFrame, features: str, label: str, **params):
    return boosted(label, **params).fit(as_vectors(df, features, label))


class VotingForest:
    """Trees fitted apart, which vote with the mean of their class probabilities."""

    def __init__(self, trees: Sequence):
        self.trees = list(trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean ``probability`` and the class where it is highest, the lower class of equal ones."""
        names = df.columns
        total = None
        out = df
        for i, tree in enumerate(self.trees):
            # only the probability of a tree is written out
            tree = tree.copy().setFeaturesCol(VECTOR).setProbabilityCol(f"_p{i}").setRawPredictionCol("").setPredictionCol("")
            out = tree.transform(out)
            said = vector_to_array(f"_p{i}")
            total = said if total is None else F.zip_with(total, said, lambda a, b: a + b)
            if i % 10 == 9 or i + 1 == len(self.trees):
                out = out.select(*names, total.alias("_total"))
                total = F.col("_total")
        n = float(len(self.trees))
        mean = F.transform("_total", lambda p: p / n)
        out = out.select(*names, mean.alias("_mean"))
        best = (F.array_position("_mean", F.array_max("_mean")) - 1).cast("double")
        return out.select(*names, array_to_vector("_mean").alias("probability"), best.alias("prediction"))

    @property
    def featureImportances(self):
        return Vectors.dense(np.mean([tree.featureImportances.toArray() for tree in self.trees], axis=0))


def fit_balanced_forest(
    df: DataFrame, features: str, label: str, id_column: str, seed: int = 42, parallelism: int = 4, **params
) -> VotingForest:
    """Forest whose every tree is fitted on its own balanced bootstrap sample (see ``balanced_bootstrap``).

    The samples of all trees are drawn in one job and written below the shared folder, a folder per tree; they hold
    trees x classes x rows of the smallest class, not a multiple of the whole table.
    """
    settings = {**FOREST, **params}
    trees = settings.pop("numTrees")
    sample = balanced_bootstrap(df.select(id_column, label, features), label, id_column, trees, seed)
    path = f"{shared_dir(df.sparkSession)}/bootstrap-{uuid4().hex}"
    sample.repartition("tree", label).write.partitionBy("tree").parquet(path)
    drawn = df.sparkSession.read.schema(sample.schema).parquet(path)

    def fit(tree: int):
        rows = as_vectors(drawn.filter(F.col("tree") == tree), features, label)
        single = {**settings, "numTrees": 1, "bootstrap": False, "seed": seed + tree}
        return RandomForestClassifier(featuresCol=VECTOR, labelCol=label, **single).fit(rows)

    with ThreadPool(parallelism) as pool:
        return VotingForest(pool.map(fit, range(trees)))


def predict(model, df: DataFrame, features: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns with the predicted class and the probability of every class as an array."""
    out = model.transform(df.withColumn(VECTOR, array_to_vector(F.col(features).cast("array<double>"))))
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability").alias("probability"))


def resample_training(df: DataFrame, how: str | None, features: str, label: str, id_column: str, seed=42) -> DataFrame:
    """Balance a training part: ``under``, ``over`` (repeat rows), ``smote`` (synthetic rows for
    every class), or leave it."""
    if how is None:
        return df
    if how == "under":
        return undersample(df, label, id_column, seed=seed)
    if how == "over":
        return oversample(df, label, id_column, seed).drop("copy")
    new = smote_classes(df, label, id_column, features, seed=seed)
    rows = df.select(id_column, label, F.col(features).cast("array<double>").alias(features))
    return rows.unionByName(new.select(id_column, F.col(label).cast(df.schema[label].dataType).alias(label), features))


def cross_validate(
    df: DataFrame,
    fit: Callable[[DataFrame], object],
    features: str,
    label: str,
    id_column: str,
    k: int = 5,
    resampling: str | None = None,
    seed=42,
    parallelism: int = 4,
) -> DataFrame:
    """Classification report of every fold: rows (fold, label, precision, recall, f1, support).

    Only the training part of a fold is resampled; the test part is scored as it is.
    """
    rows = kfold(df.select(id_column, label, features), id_column, label, k, seed).persist()

    def one(fold: int) -> DataFrame:
        train = rows.filter(F.col("fold") != fold).drop("fold")
        model = fit(resample_training(train, resampling, features, label, id_column, seed))
        said = predict(model, rows.filter(F.col("fold") == fold), features, [id_column, label])
        return said.select(F.lit(fold).alias("fold"), F.col(label).cast("int").alias("y"), "prediction")

    with ThreadPool(min(parallelism, k)) as pool:
        parts = pool.map(one, range(k))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    labels = [r[0] for r in rows.select(F.col(label).cast("int")).distinct().sort(label).collect()]
    report = classification_report(scored, "y", "prediction", labels, ["fold"])
    # folds x (labels + 3) rows; kept as values so that the cached rows can be released
    out = df.sparkSession.createDataFrame(report.collect(), report.schema)
    rows.unpersist()
    return out


def _search(df, features, label, id_column, maps, k, seed, parallelism) -> tuple[object, DataFrame]:
    """Cross-validated choice among parameter sets by F1 of class 1; (best model, rows of all sets)."""
    rows = as_vectors(kfold(df.select(id_column, label, features), id_column, label, k, seed), features, label)
    est = forest(label)
    grids = [{est.getParam(name): v for name, v in m.items()} for m in maps]
    f1 = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=grids, evaluator=f1, numFolds=k, foldCol="fold", parallelism=parallelism
    )
    model = cv.fit(rows)
    table = [
        (i, ", ".join(f"{name}={v}" for name, v in sorted(m.items())), float(score))
        for i, (m, score) in enumerate(zip(maps, model.avgMetrics))
    ]
    return model.bestModel, df.sparkSession.createDataFrame(table, "set_no int, params string, f1 double")


def grid_search(df: DataFrame, features: str, label: str, id_column: str, grid: Mapping[str, Sequence] = FOREST_GRID,
                k: int = 5, seed=42, parallelism: int = 4):
    maps = [dict(zip(grid, values)) for values in product(*grid.values())]
    return _search(df, features, label, id_column, maps, k, seed, parallelism)


def random_search(df: DataFrame, features: str, label: str, id_column: str, n_iter: int,
                  ranges: Mapping[str, object] = FOREST_RANGES, k: int = 5, seed: int = 42, parallelism: int = 4):
    """As ``grid_search`` over ``n_iter`` drawn sets: a tuple is an integer range (end excluded), a list a choice."""
    rng = np.random.default_rng(seed)
    maps = [
        {
            name: int(rng.integers(*r)) if isinstance(r, tuple) else str(rng.choice(r))
            for name, r in ranges.items()
        }
        for _ in range(n_iter)
    ]
    return _search(df, features, label, id_column, maps, k, seed, parallelism)


# --- voting -----------------------------------------------------------------------------------------------------


def vote_weight(accuracy: Column | str, rule: str = "log_odds") -> Column:
    """Weight of a model by its accuracy; null where the odds are undefined."""
    a = F.col(accuracy) if isinstance(accuracy, str) else accuracy
    odds = F.when((a > 0) & (a < 1), a / (1 - a))
    return {"log_odds": F.log(odds), "odds": odds, "fixed": a}[rule]


def align_predictions(tables: Mapping[str, DataFrame], id_column: str, probability: str) -> DataFrame:
    """Probabilities of all models for the ids that every model scored, one column per model."""
    out = None
    for name, df in tables.items():
        part = df.select(id_column, F.col(probability).alias(name))
        out = part if out is None else out.join(part, id_column)
    return out


def soft_vote(probabilities: DataFrame, weights: Mapping[str, Column | float], classes: int = 2) -> DataFrame:
    """Weighted mean of the models' class probabilities and the first class with the highest mean; weights that sum to
    0 count equally."""
    ws = {m: w if isinstance(w, Column) else F.lit(float(w)) for m, w in weights.items()}
    none = sum(list(ws.values())[1:], list(ws.values())[0]) == 0
    ws = {m: F.when(none, 1.0).otherwise(w) for m, w in ws.items()}
    total = sum(list(ws.values())[1:], list(ws.values())[0])
    parts = []
    for c in range(classes):
        terms = [w * F.col(m)[c] for m, w in ws.items()]
        parts.append(sum(terms[1:], terms[0]) / total)
    voted = probabilities.withColumn("vote", F.array(*parts))
    return voted.withColumn("prediction", (F.array_position("vote", F.array_max("vote")) - 1).cast("int"))


# --- federated averaging -----------------------------------------------------------------------------------------


def federated_average(weights: DataFrame, by: Sequence[str], size: str, vector: str) -> DataFrame:
    """Mean of the clients' weight vectors, weighted by client size: rows (by, position, weight)."""
    cells = weights.select(*by, size, F.posexplode(vector).alias("position", "_w"))
    return cells.groupBy(*by, "position").agg((F.sum(F.col(size) * F.col("_w")) / F.sum(size)).alias("weight"))


def _gradients(df: DataFrame, weights: dict[int, np.ndarray], dim: int) -> DataFrame:
    """Per client and part (training or validation): rows, summed log loss and summed gradient.

    Every batch sends one row per client, so a client with most of the rows is summed by all tasks alike.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple, np.ndarray] = {}
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            client = batch.column(0).to_numpy(zero_copy_only=False)
            valid = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            y = batch.column(2).to_numpy(zero_copy_only=False)
            x = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(n, dim)
            for c in np.unique(client):
                w = weights[int(c)]
                for v in (False, True):
                    rows = (client == c) & (valid == v)
                    if not rows.any():
                        continue
                    z = x[rows] @ w[:-1] + w[-1]
                    loss = np.logaddexp(0, z) - y[rows] * z
                    off = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - y[rows]
                    part = np.concatenate([[rows.sum(), loss.sum()], off @ x[rows], [off.sum()]])
                    at = (int(c), v)
                    totals[at] = totals.get(at, 0) + part
        if totals:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c for c, _ in totals], pa.int32()),
                    pa.array([v for _, v in totals], pa.bool_()),
                    pa.array([t.tolist() for t in totals.values()], pa.list_(pa.float64())),
                ],
                names=["client", "valid", "sums"],
            )

    parts = df.mapInArrow(partial, "client int, valid boolean, sums array<double>")
    totals = ", ".join(f"sum(sums[{i}])" for i in range(dim + 3))
    return parts.groupBy("client", "valid").agg(F.expr(f"array({totals})").alias("s"))


def _train(
    df: DataFrame, client: str, features: str, label: str, id_column: str, rounds: int, local_steps: int,
    learning_rate: float, valid_fraction: float, patience: int, halve_every: int, share: bool, seed, max_clients: int,
) -> tuple[dict[int, np.ndarray], DataFrame, list[tuple[int, list[float]]]]:
    """(best weights by client, loss history, shared weights after every round)."""
    spark = df.sparkSession
    valid = validation_part(id_column, valid_fraction, seed)
    rows = cut_lineage(
        df.select(
            F.col(client).cast("int").alias("client"),
            valid.alias("valid"),
            F.col(label).cast("double").alias("y"),
            F.col(features).cast("array<double>").alias("x"),
        )
    )
    found = rows.groupBy("client").agg(F.max(F.size("x")).alias("dim")).limit(max_clients + 1).collect()
    if len(found) > max_clients:
        raise ValueError(f"more than {max_clients} clients")
    clients, dim = sorted(r["client"] for r in found), max(r["dim"] for r in found)
    weights = {c: np.zeros(dim + 1) for c in clients}
    best = {c: (np.inf, -1, weights[c]) for c in clients}
    running = set(clients)
    history, trail, rate = [], [], learning_rate

    def measured() -> dict[tuple, np.ndarray]:
        return {(x["client"], x["valid"]): np.array(x["s"]) for x in _gradients(rows, weights, dim).collect()}

    # one pass gives the losses at the current weights and the gradient for the next step
    sums = measured()
    sizes = {c: sums[(c, False)][0] for c in clients if (c, False) in sums}
    for r in range(rounds):
        if halve_every and r > 0 and r % halve_every == 0:
            rate *= 0.5
        for step in range(local_steps):
            sums = measured() if step else sums
            for c in running & set(sizes):
                s = sums[(c, False)]
                weights[c] = weights[c] - rate * s[2:] / s[0]
        if share:
            mean = sum(n * weights[c] for c, n in sizes.items()) / sum(sizes.values())
            weights = {c: mean for c in clients}
            trail.append((r + 1, mean.tolist()))
        sums = measured()
        losses = {
            (c, part): (float(sums[(c, v)][1] / sums[(c, v)][0]) if (c, v) in sums else None)
            for c in clients
            for part, v in (("train", False), ("valid", True))
        }
        for c in sorted(running):
            history += [(r + 1, c, part, losses[(c, part)]) for part in ("train", "valid")]
        known = [losses[(c, "valid")] for c in clients if losses[(c, "valid")] is not None]
        for c in sorted(running):
            own = float(np.mean(known)) if share and known else losses[(c, "valid")]
            if own is not None and own < best[c][0]:
                best[c] = (own, r, weights[c])
            elif r - best[c][1] >= patience:
                running.discard(c)
        if not running:
            break
    table = spark.createDataFrame(history, "round int, client int, part string, loss double")
    return {c: b[2] if b[1] >= 0 else weights[c] for c, b in best.items()}, table, trail


def federated_fit(
    df: DataFrame, client: str, features: str, label: str, id_column: str, rounds: int = 50, local_steps: int = 1,
    learning_rate: float = 0.5, valid_fraction: float = 0.15, patience: int = 20, halve_every: int = 5, seed=42,
    max_clients: int = 10_000,
) -> tuple[np.ndarray, DataFrame]:
    """Federated logistic regression: (weights with the bias last, loss history).

    A round: every client takes ``local_steps`` gradient steps on its own rows, then the weights are averaged by
    client size.  The weights of the best mean validation loss are kept; training stops ``patience`` rounds after them.
    The driver holds one weight vector per client and nothing else.
    """
    best, history, _ = _train(df, client, features, label, id_column, rounds, local_steps, learning_rate,
                              valid_fraction, patience, halve_every, True, seed, max_clients)
    return next(iter(best.values())), history


def federated_scores(
    df: DataFrame, client: str, features: str, label: str, id_column: str, rounds: int = 50, local_steps: int = 1,
    learning_rate: float = 0.5, valid_fraction: float = 0.15, patience: int = 20, halve_every: int = 5, seed=42,
    max_clients: int = 10_000,
) -> DataFrame:
    """Scores of the averaged model after every round, per client and part ('train' or 'valid'): see ``round_scores``."""
    _, _, trail = _train(df, client, features, label, id_column, rounds, local_steps, learning_rate,
                         valid_fraction, patience, halve_every, True, seed, max_clients)
    made = [{"round": r, "weights": w} for r, w in trail]
    models = F.from_json(F.lit(json.dumps(made)), "array<struct<round:int,weights:array<double>>>")
    weights = df.select(client).distinct().select(client, F.inline(models))
    part = F.when(validation_part(id_column, valid_fraction, seed), "valid").otherwise("train")
    return round_scores(df.withColumn("part", part), weights, client, features, label, ["part"])


def validation_part(id_column: str, fraction: float, seed=42) -> Column:
    """Does a row belong to the validation part of the federated and local fits?"""
    return hash_fraction(f"{seed}v", id_column) < fraction


def round_scores(
    df: DataFrame, weights: DataFrame, client: str, features: str, label: str, by: Sequence[str] = ()
) -> DataFrame:
    """Scores of logistic models per (client, round, *by): n, auroc_grid, auprc_grid, precision, recall, f1, accuracy.

    ``weights`` holds (client, round, weights with the bias last) as a table of any number of clients: a row meets the
    rounds of its client by one join on the client, and no weight passes through the driver.  Areas are those of
    ``auc_grid``; rows collapse to buckets of scores in the tasks, so a client of any size is counted by all of them.
    The prediction is 1 above a probability of 0.5.  Rows of a client without weights, with a null client, label or
    vector have no score and are left out; clients without rows do not appear.
    """
    rounds = weights.filter(F.col("weights").isNotNull()).groupBy(client)
    rounds = rounds.agg(F.collect_list(F.struct("round", "weights")).alias("_rounds"))
    rows = df.select(client, *by, F.col(label).cast("double").alias("_y"), F.col(features).cast("array<double>").alias("_x"))
    rows = rows.filter(F.col("_y").isNotNull() & F.col("_x").isNotNull()).join(rounds, client)

    def probability(r: Column) -> Column:
        w = r["weights"]
        z = F.aggregate(F.zip_with("_x", F.slice(w, 1, F.size("_x")), lambda a, b: a * b), F.element_at(w, -1), lambda t, x: t + x)
        return F.struct(r["round"].alias("round"), (1.0 / (1.0 + F.exp(-z))).alias("_s"))

    scored = rows.select(client, *by, "_y", F.inline(F.transform("_rounds", probability)))
    scored = scored.withColumn("_p", (F.col("_s") > 0.5).cast("double"))
    keys = [client, "round", *by]
    areas = auc_grid(scored, "_y", "_s", keys)
    said = binary_metrics(scored, "_y", "_p", keys)
    counted = scored.groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.join(areas, keys).join(said, keys)


def local_fit(
    df: DataFrame, client: str, features: str, label: str, id_column: str, rounds: int = 50,
    learning_rate: float = 0.5, valid_fraction: float = 0.15, patience: int = 20, halve_every: int = 5, seed=42,
    max_clients: int = 10_000,
) -> tuple[dict[int, np.ndarray], DataFrame]:
    """One model per client on its own rows only; with a single client this is the central model."""
    return _train(df, client, features, label, id_column, rounds, 1, learning_rate, valid_fraction, patience,
                  halve_every, False, seed, max_clients)[:2]


def linear_score(features: Column | str, weights: np.ndarray) -> Column:
    """Probability of class 1 under logistic weights (bias last)."""
    col = F.col(features) if isinstance(features, str) else features
    w = F.array(*[F.lit(float(x)) for x in weights[:-1]])
    z = F.aggregate(F.zip_with(col.cast("array<double>"), w, lambda a, b: a * b), F.lit(float(weights[-1])),
                    lambda acc, x: acc + x)
    return 1.0 / (1.0 + F.exp(-z))
