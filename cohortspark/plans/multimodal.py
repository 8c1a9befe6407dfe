"""Three modalities of a stay (static, labs, vitals): features, one model each, and a weighted vote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.fixed import AGGREGATE_LABS, AGGREGATE_VITALS, CKD_LABS, PANEL_VITALS
from cohortspark.operators.features import (
    aggregate_features, make_kernels, one_hot, panel_features, static_features, vocabulary,
)
from cohortspark.operators.metrics import binary_metrics
from cohortspark.operators.sampling import stratified_split
from cohortspark.operators.timeseries import fix_length, to_panel
from cohortspark.operators.training import (
    align_predictions, fit_forest, fit_logistic, predict, resample_training, soft_vote, vote_weight,
)
from cohortspark.operators.windows import bfill_ffill
from cohortspark.plans.preprocess import KEY, T, Cohort

LABEL = "ckd"


def panels(series: DataFrame, step_hours: float, steps: int, signals: Sequence[str]) -> DataFrame:
    """Fixed-length, gap-free panel of every stay (missing signals of a whole stay become 0)."""
    fixed = fix_length(series, KEY, T, step_hours, steps, signals, LABEL)
    filled = bfill_ffill(fixed, KEY, T, list(signals)).na.fill(0.0, list(signals))
    return to_panel(filled, KEY, T, signals, [LABEL])


def lab_panels(cohort: Cohort) -> DataFrame:
    return panels(cohort.labs, 8, 12, CKD_LABS)


def vital_panels(cohort: Cohort) -> DataFrame:
    return panels(cohort.vitals, 1, 96, PANEL_VITALS)


def static_table(cohort: Cohort) -> DataFrame:
    return static_features(cohort.demographics, KEY, "admission_age")


def aggregate_table(cohort: Cohort) -> DataFrame:
    blocks = [(cohort.labs, AGGREGATE_LABS), (cohort.vitals, AGGREGATE_VITALS)]
    return aggregate_features(blocks, cohort.demographics, KEY)


def static_vectors(table: DataFrame, train_ids: DataFrame) -> DataFrame:
    """One-hot features as an array, with the vocabulary of the training part for every part."""
    texts = [c for c, kind in table.dtypes if kind == "string"]
    vocab = vocabulary(table.join(train_ids, KEY, "left_semi"), texts)
    hot = one_hot(table, vocab)
    names = [c for c in hot.columns if c not in (KEY, LABEL)]
    cells = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names]
    return hot.select(KEY, LABEL, F.array(*cells).alias("features"))


def multimodal_vote(
    static: DataFrame, labs: DataFrame, vitals: DataFrame, n_kernels: int = 100, resampling: str | None = "under",
    test_fraction: float = 0.2, seed=42, forest: dict | None = None, logistic: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(votes of the test stays, metrics per modality and of the vote).

    Modalities are combined by id, every model is fitted once on its whole (balanced) training part, and the vote
    weighs a modality by the log odds of its accuracy.
    """
    split = stratified_split(static.select(KEY, LABEL), KEY, LABEL, test_fraction, seed).select(KEY, "split")
    train_ids = split.filter("split = 'train'").select(KEY)
    tables = {"static": static_vectors(static, train_ids)}
    for name, df in (("labs", labs), ("vitals", vitals)):
        first = df.select(F.size("panel").alias("c"), F.size(F.element_at("panel", 1)).alias("s")).first()
        kernels = make_kernels(n_kernels, first["s"], first["c"], seed)
        tables[name] = panel_features(df, "panel", kernels, [KEY, LABEL])
    said, scores = {}, None
    for name, df in tables.items():
        parts = df.join(split, KEY)
        train = resample_training(
            parts.filter("split = 'train'").drop("split"), resampling, "features", LABEL, KEY, seed
        )
        fit = fit_forest(train, "features", LABEL, **(forest or {})) if name == "static" else fit_logistic(
            train, "features", LABEL, **(logistic or {})
        )
        said[name] = predict(fit, parts.filter("split = 'test'"), "features", [KEY, LABEL])
        row = binary_metrics(said[name], LABEL, "prediction").withColumn("model", F.lit(name))
        scores = row if scores is None else scores.unionByName(row)
    # three rows, one per modality
    # a model without (or with only) errors counts as if half a row were wrong (or right), so its odds are defined
    half = 0.5 / max(1, said["static"].count())
    sure = F.least(F.greatest(F.col("accuracy"), F.lit(half)), F.lit(1 - half))
    weights = {r["model"]: r["w"] for r in scores.select("model", vote_weight(sure).alias("w")).collect()}
    votes = soft_vote(align_predictions(said, KEY, "probability"), weights)
    votes = votes.join(static.select(KEY, LABEL), KEY)
    total = binary_metrics(votes, LABEL, "prediction").withColumn("model", F.lit("vote"))
    return votes, scores.unionByName(total)
