"""Metrics as table aggregates: one row per group, with groups of any size.

Ranked metrics first collapse the rows to one row per distinct score, then use running sums over those.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortspark.operators.grouped import match, running_sum
from cohortspark.operators.labels import assign_bin


def ratio(a: Column, b: Column, empty: float | None = 0.0) -> Column:
    """a / b, or ``empty`` when b is 0."""
    return F.when(b != 0, a / b).otherwise(F.lit(empty).cast("double"))


def confusion(df: DataFrame, y: str, p: str, labels: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Counts over the full grid of true and predicted label."""
    cells = F.array(
        *[
            F.struct(
                F.lit(a).alias("y_true"),
                F.lit(b).alias("y_pred"),
                F.count_if((F.col(y) == a) & (F.col(p) == b)).alias("n"),
            )
            for a in labels
            for b in labels
        ]
    )
    return df.groupBy(*by).agg(cells.alias("_c")).select(*by, F.inline("_c"))


def binary_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 of class 1 and accuracy; 0 where a ratio is undefined."""
    yes, said = F.col(y) == 1, F.col(p) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *by,
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "accuracy",
    )


def classification_report(df: DataFrame, y: str, p: str, labels: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Rows per label, then accuracy, macro and weighted average: precision, recall, f1, support."""
    rows = []
    for label in labels:
        yes, said = F.col(y) == label, F.col(p) == label
        rows.append(
            F.struct(
                F.lit(str(label)).alias("label"),
                F.count_if(yes & said).alias("tp"),
                F.count_if(said).alias("said"),
                F.count_if(yes).alias("support"),
            )
        )
    per = (
        df.groupBy(*by)
        .agg(F.array(*rows).alias("_r"), F.avg((F.col(y) == F.col(p)).cast("double")).alias("_acc"))
        .select(*by, "_acc", F.inline("_r"))
        .withColumn("precision", ratio(F.col("tp"), F.col("said")))
        .withColumn("recall", ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", ratio(2 * F.col("tp"), F.col("said") + F.col("support")))
    )
    names = ["precision", "recall", "f1"]
    macro = per.groupBy(*by).agg(
        F.lit("macro avg").alias("label"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support")
    )
    weighted = per.groupBy(*by).agg(
        F.lit("weighted avg").alias("label"),
        *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    accuracy = per.groupBy(*by).agg(
        F.lit("accuracy").alias("label"), *[F.max("_acc").alias(c) for c in names], F.sum("support").alias("support")
    )
    cols = [*by, "label", *names, "support"]
    return per.select(cols).unionByName(accuracy.select(cols)).unionByName(macro.select(cols)).unionByName(
        weighted.select(cols)
    )


def ranked_counts(
    df: DataFrame, y: str, score: str, by: Sequence[str] = (), target_rows: int | None = None
) -> DataFrame:
    """One row per distinct score: positives and negatives at it (``pos``, ``neg``), at or above it (``tp``, ``fp``),
    and in the whole group (``p``, ``n``)."""
    counts = (
        df.filter(F.col(score).isNotNull() & F.col(y).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    )
    return running_sum(
        counts, list(by), "score", {"tp": "pos", "fp": "neg"}, descending=True, totals={"p": "pos", "n": "neg"},
        target_rows=target_rows,
    )


def _roc_area() -> Column:
    """Over ``ranked_counts``: share of (positive, negative) pairs in the right order, ties half."""
    above = F.col("tp") - F.col("pos") + F.col("pos") / 2.0
    return ratio(F.sum(F.col("neg") * above), F.max("p") * F.max("n").cast("double"), None).alias("auroc")


def _pr_area() -> Column:
    """Over ``ranked_counts``: trapezoids between neighbouring scores, from recall 0 and precision 1."""
    tp, fp, pos, neg = F.col("tp"), F.col("fp"), F.col("pos"), F.col("neg")
    here = tp / (tp + fp)
    before = F.when(tp + fp - pos - neg > 0, (tp - pos) / (tp + fp - pos - neg)).otherwise(1.0)
    return ratio(F.sum(pos * (here + before) / 2.0), F.max("p"), None).alias("auprc")


def auroc(df: DataFrame, y: str, score: str, by: Sequence[str] = (), target_rows: int | None = None) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half.  Null when a class is absent."""
    return ranked_counts(df, y, score, by, target_rows).groupBy(*by).agg(_roc_area())


def auprc(df: DataFrame, y: str, score: str, by: Sequence[str] = (), target_rows: int | None = None) -> DataFrame:
    """Exact area under the precision-recall curve by trapezoids, starting at recall 0 with precision 1."""
    return ranked_counts(df, y, score, by, target_rows).groupBy(*by).agg(_pr_area())


def roc_points(df: DataFrame, y: str, score: str, by: Sequence[str] = (), target_rows: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score; the starting point (0, 0) has a null threshold."""
    r = ranked_counts(df, y, score, by, target_rows).select(
        *by,
        F.col("score").alias("threshold"),
        ratio(F.col("fp"), F.col("n"), None).alias("fpr"),
        ratio(F.col("tp"), F.col("p"), None).alias("tpr"),
    )
    start = df.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return r.unionByName(start)


def pr_points(df: DataFrame, y: str, score: str, by: Sequence[str] = (), target_rows: int | None = None) -> DataFrame:
    """(threshold, precision, recall) for every distinct score; the end point (1, 0) has a null threshold."""
    r = ranked_counts(df, y, score, by, target_rows).select(
        *by,
        F.col("score").alias("threshold"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        ratio(F.col("tp"), F.col("p"), None).alias("recall"),
    )
    end = df.groupBy(*by).agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return r.unionByName(end)


def auc_grid(df: DataFrame, y: str, score: str, by: Sequence[str] = (), thresholds: int = 200) -> DataFrame:
    """ROC and interpolated precision-recall areas on an even grid of thresholds, for scores in [0, 1].

    Rows collapse to at most ``thresholds`` buckets per group before anything is ordered.
    """
    top = thresholds - 1
    s = F.col(score)
    bucket = F.least(F.greatest(F.ceil(s * top) - 1, F.lit(0)), F.lit(top - 1)).cast("int")
    found = df.groupBy(*by, bucket.alias("k")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )
    if by:
        grid = found.select(*by).distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(top))))
    else:
        grid = df.sparkSession.range(thresholds).select(F.col("id").cast("int").alias("k"))
    rows = match(grid, found, [*by, "k"]).na.fill(0, ["pos", "neg"])
    down = Window.partitionBy(*by).orderBy(F.desc("k"))
    rows = rows.withColumns(
        {
            "tp": F.sum("pos").over(down.rowsBetween(Window.unboundedPreceding, 0)),
            "fp": F.sum("neg").over(down.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    rows = rows.withColumns({"tp1": F.lag("tp").over(down), "fp1": F.lag("fp").over(down)})
    whole = Window.partitionBy(*by)
    rows = rows.withColumns({"p": F.max("tp").over(whole), "n": F.max("fp").over(whole)})
    # a row holds the counts at its threshold and (…1) at the next higher one
    roc = F.sum(
        (ratio(F.col("fp"), F.col("n")) - ratio(F.col("fp1"), F.col("n")))
        * (ratio(F.col("tp"), F.col("p")) + ratio(F.col("tp1"), F.col("p")))
        / 2.0
    )
    d_tp = F.col("tp") - F.col("tp1")
    said, said1 = F.col("tp") + F.col("fp"), F.col("tp1") + F.col("fp1")
    slope = ratio(d_tp, F.greatest(said - said1, F.lit(0)))
    intercept = F.col("tp1") - slope * said1
    quotient = F.when((said > 0) & (said1 > 0), said / said1).otherwise(1.0)
    pr = F.sum(ratio(slope * (d_tp + intercept * F.log(quotient)), F.col("p")))
    return rows.filter(F.col("tp1").isNotNull()).groupBy(*by).agg(roc.alias("auroc_grid"), pr.alias("auprc_grid"))


def binned_scores(
    df: DataFrame, y: str, yhat: str, n: int, keep: Sequence[str] = (), drop_first: bool = False
) -> DataFrame:
    """One row per label bin: is it the true bin (``y_bin``), and its score ``1 - min(1, |bin - (n-1) * yhat|)``."""
    bins = F.sequence(F.lit(1 if drop_first else 0), F.lit(n - 1))
    out = df.withColumn("label", F.explode(bins))
    off = F.abs(F.col("label") - F.lit(float(n - 1)) * F.col(yhat))
    return out.select(
        *keep,
        "label",
        (assign_bin(y, n) == F.col("label")).cast("int").alias("y_bin"),
        (1.0 - F.least(off, F.lit(1.0))).alias("score"),
    )


def regression_errors(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    e = F.col(y) - F.col(yhat)
    return df.groupBy(*by).agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"))


def prevalence(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.avg((F.col(y) == 1).cast("double")).alias("prevalence"))


def cv_summary(scores: DataFrame, by: Sequence[str], value: str, decimals: int | None = 2) -> DataFrame:
    """Mean over folds; with ``decimals`` the folds are rounded before the mean and the mean again."""
    if decimals is None:
        return scores.groupBy(*by).agg(F.avg(value).alias("mean"))
    return scores.groupBy(*by).agg(F.round(F.avg(F.round(value, decimals)), decimals).alias("mean"))


def score_cube(
    predictions: DataFrame, run: Sequence[str], fold: str, client: str, y: str, yhat: str, n_labels: int,
    target_rows: int | None = None,
) -> DataFrame:
    """Long scores (run, fold, label, metric, value): every metric per client, then averaged over the clients.

    Label metrics come from ``binned_scores``; the error metrics have a null label.
    """
    cell = [*run, fold, client, "label"]
    rows = binned_scores(predictions, y, yhat, n_labels, [*run, fold, client])
    # all four label metrics come from the same counts per distinct score
    said = F.col("score") > 0.5
    tp, fp = F.sum(F.when(said, F.col("pos"))), F.sum(F.when(said, F.col("neg")))
    tp, fp = F.coalesce(tp, F.lit(0)), F.coalesce(fp, F.lit(0))
    per = ranked_counts(rows, "y_bin", "score", cell, target_rows).groupBy(*cell).agg(
        ratio(tp, tp + fp).alias("precision"), ratio(tp, F.max("p")).alias("recall"), _roc_area(), _pr_area()
    )
    long = per.unpivot(cell, ["precision", "recall", "auroc", "auprc"], "metric", "value")
    errors = regression_errors(predictions, y, yhat, [*run, fold, client]).unpivot(
        [*run, fold, client], ["mae", "mse"], "metric", "value"
    )
    long = long.unionByName(errors.withColumn("label", F.lit(None).cast("int")))
    return long.groupBy(*run, fold, "label", "metric").agg(F.avg("value").alias("value"))


def add_f1(df: DataFrame, precision: str = "precision", recall: str = "recall") -> DataFrame:
    p, r = F.col(precision), F.col(recall)
    return df.withColumn("f1", ratio(2 * p * r, p + r, None))


def score_table(scores: DataFrame, metric: str, run: str, value: str, runs: Sequence) -> DataFrame:
    """``mean ± std`` per metric, one column per run; std is that of the whole population."""
    cells = []
    for name in runs:
        v = F.when(F.col(run) == name, F.col(value))
        cells.append(F.format_string("%.2f ± %.2f", F.avg(v), F.stddev_pop(v)).alias(str(name)))
    return scores.groupBy(metric).agg(*cells)


def learning_curve(scores: DataFrame, by: Sequence[str], epoch: str, value: str, series: Sequence[str]) -> DataFrame:
    """Mean, min and max per epoch over all series (folds, clients), up to the last epoch every series reached.

    An epoch that some series lacks gives nulls.
    """
    per = scores.groupBy(*by, epoch).agg(
        F.count(value).alias("_n"), F.avg(value).alias("_avg"), F.min(value).alias("_min"), F.max(value).alias("_max")
    )
    size = scores.groupBy(*by).agg(F.count_distinct(F.struct(*series)).alias("_all"))
    per = match(per, size, by) if by else per.withColumn("_all", size.scalar())
    full = F.col("_n") == F.col("_all")
    last = per.filter(full).groupBy(*by).agg(F.max(epoch).alias("_last"))
    per = match(per, last, by) if by else per.withColumn("_last", last.scalar())
    return per.filter(F.col(epoch) <= F.col("_last")).select(
        *by, epoch, *[F.when(full, F.col(f"_{c}")).alias(f"{c}_value") for c in ("avg", "min", "max")]
    )


def best_round(scores: DataFrame, by: Sequence[str], round_column: str, loss: str, patience: int = 20) -> DataFrame:
    """Per run the first round with the lowest loss before training stops, and the round it stops in.

    Training stops at the first round that is ``patience`` rounds after the best so far without beating it.
    """
    w = Window.partitionBy(*by).orderBy(round_column).rowsBetween(Window.unboundedPreceding, 0)
    run = scores.withColumn("_best", F.min(F.struct(loss, round_column)).over(w))
    late = F.col(round_column) - F.col(f"_best.{round_column}") >= patience
    run = run.withColumn("_late", F.max(late.cast("int")).over(w))
    upto = F.when(F.col("_late") == 0, F.struct(loss, round_column))
    return run.groupBy(*by).agg(
        F.min(upto).alias("_b"),
        F.coalesce(F.min(F.when(F.col("_late") == 1, F.col(round_column))), F.max(round_column)).alias("stop_round"),
    ).select(
        *by,
        F.col(f"_b.{round_column}").alias("best_round"),
        F.col(f"_b.{loss}").alias("best_loss"),
        "stop_round",
    )


def pool_predictions(folds: Sequence[DataFrame], y: str, yhat: str) -> DataFrame:
    """Predictions of all folds; incomplete pairs are dropped."""
    out = folds[0]
    for f in folds[1:]:
        out = out.unionByName(f)
    return out.dropna(subset=[y, yhat])


def overall_scores(scores: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Average of the label scores."""
    return scores.groupBy(*by).agg(*[F.avg(v).alias(v) for v in values])


def cv_scores(folds: DataFrame, fold: str, metrics: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """One row per metric with its value in every fold and the mean; ``metrics`` maps name to column.

    With ``by``, one row per metric and group.
    """
    rows = folds.unpivot([*by, fold], list(metrics.values()), "_c", "value")
    names = F.create_map(*[F.lit(x) for name, c in metrics.items() for x in (c, name)])
    return rows.withColumn("metric", names[F.col("_c")]).groupBy(*by, "metric").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(fold, "value"))), lambda s: s["value"]).alias("folds"),
        F.avg("value").alias("mean"),
    )
