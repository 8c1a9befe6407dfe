"""Cross-validated comparison of central, local and federated models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.scalars import case
from cohortspark.operators.sampling import client_split, kfold
from cohortspark.operators.training import federated_fit, linear_score, local_fit


def evaluate(
    df: DataFrame, features: str, label: str, id_column: str, model: str, n_clients: int, k: int = 5, seed=42, **fit
) -> DataFrame:
    """Test predictions (model, n_clients, fold, client, id, y_true, y_pred).

    ``model`` is ``fl`` (one averaged model, client 0 in the result), ``lml`` (a model per client) or ``cml`` (one
    client).  The held-out fold never enters the clients' rows.
    """
    n = 1 if model == "cml" else n_clients
    folds = kfold(df.select(id_column, label, features), id_column, label, k, seed)
    out = None
    for fold in range(k):
        train = client_split(folds.filter(F.col("fold") != fold), id_column, n, label, seed)
        test = folds.filter(F.col("fold") == fold)
        if model == "fl":
            weights, _ = federated_fit(train, "client", features, label, id_column, seed=seed, **fit)
            by_client = {0: weights}
        else:
            by_client, _ = local_fit(train, "client", features, label, id_column, seed=seed, **fit)
        clients = F.explode(F.array(*[F.lit(c) for c in by_client]))
        rows = test.withColumn("client", clients)
        score = case((F.col("client") == c, linear_score(features, w)) for c, w in by_client.items())
        rows = rows.select(
            F.lit(model).alias("model"), F.lit(n).alias("n_clients"), F.lit(fold).alias("fold"), "client",
            id_column, F.col(label).cast("double").alias("y_true"), score.alias("y_pred"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out
