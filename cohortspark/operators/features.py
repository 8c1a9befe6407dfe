"""Feature preparation: encoders, scaling, feature tables and random-convolution panel features."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.functions.fixed import AGE_EDGES, AGE_LABELS, STATIC_FEATURES
from cohortspark.functions.scalars import bin_column, case
from cohortspark.operators.aggregates import aggregate_signals
from cohortspark.operators.grouped import number_rows
from cohortspark.operators.joins import merge_features


def vocabulary(df: DataFrame, columns: Sequence[str], max_categories: int = 1000) -> dict[str, list]:
    """Sorted categories per column.  A column with more than ``max_categories`` is refused, not truncated."""
    out = {}
    for c in columns:
        found = df.select(c).filter(F.col(c).isNotNull()).distinct().limit(max_categories + 1).collect()
        if len(found) > max_categories:
            raise ValueError(f"{c} has more than {max_categories} categories")
        out[c] = sorted(r[0] for r in found)
    return out


def one_hot(df: DataFrame, vocab: Mapping[str, Sequence]) -> DataFrame:
    """0/1 columns ``column_value`` from a vocabulary fitted on the training part; unseen values give zeros."""
    flags = {
        f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, values in vocab.items() for v in values
    }
    return df.withColumns(flags).drop(*vocab)


def label_encode(df: DataFrame, vocab: Mapping[str, Sequence]) -> DataFrame:
    """Position of the value in the sorted vocabulary; unseen values give null."""
    return df.withColumns(
        {c: case((F.col(c) == v, F.lit(i)) for i, v in enumerate(values)) for c, values in vocab.items()}
    )


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(value, code) of every distinct value in sorted order, codes from 0; of any size, ranked in pieces."""
    values = df.select(F.col(column).alias("value")).filter(F.col(column).isNotNull()).distinct()
    return number_rows(values, [], "value", "code").withColumn("code", F.col("code") - 1)


def encode_joined(df: DataFrame, dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """``label_encode`` by join with dictionaries of any size; Spark broadcasts those that are small.

    Unseen and null values give null.  A value that most rows share is split by the adaptive join.
    """
    out = df
    for c, codes in dictionaries.items():
        named = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        out = out.join(named, F.col(c) == F.col("_value"), "left").withColumn(c, F.col("_code")).drop("_value", "_code")
    return out.select(*df.columns)


def one_hot_sparse(df: DataFrame, dictionaries: Mapping[str, DataFrame], features: str) -> DataFrame:
    """One-hot features as (size, positions) in the struct ``features``, for dictionaries of any size.

    The columns stand one after another in the order of ``dictionaries``; unseen and null values set no position.
    """
    out = encode_joined(df, dictionaries)
    sizes = [codes.agg(F.count(F.lit(1))).scalar() for codes in dictionaries.values()]
    out = out.withColumns({f"_size{i}": n for i, n in enumerate(sizes)})
    starts = [sum((F.col(f"_size{j}") for j in range(i)), F.lit(0)) for i in range(len(sizes) + 1)]
    hot = F.array_compact(F.array(*[F.col(c) + start for c, start in zip(dictionaries, starts)]))
    packed = F.struct(starts[-1].cast("bigint").alias("size"), hot.cast("array<bigint>").alias("positions"))
    return out.withColumn(features, packed).drop(*dictionaries, *[f"_size{i}" for i in range(len(sizes))])


def minmax_scale(df: DataFrame, bounds: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale by (signal, lowest, highest) rows of the training part; a constant column gives null."""
    picks = [
        F.struct(
            F.max(F.when(F.col("signal") == c, F.col("lowest"))).alias("lo"),
            F.max(F.when(F.col("signal") == c, F.col("highest"))).alias("hi"),
        ).alias(c)
        for c in columns
    ]
    out = df.withColumn("_b", bounds.agg(F.struct(*picks)).scalar())

    def scaled(c: str) -> Column:
        lo, hi = F.col(f"_b.{c}.lo"), F.col(f"_b.{c}.hi")
        return F.when(hi != lo, (F.col(c) - lo) / (hi - lo))

    return out.withColumns({c: scaled(c) for c in columns}).drop("_b")


def static_features(demographics: DataFrame, key: str, age: str) -> DataFrame:
    """Demographic and comorbidity features with the age group of the same entity."""
    grouped = demographics.withColumn("age_group", bin_column(age, AGE_EDGES, AGE_LABELS, right=False))
    return grouped.select(key, *STATIC_FEATURES)


def aggregate_features(
    blocks: Sequence[tuple[DataFrame, Sequence[str]]], demographics: DataFrame, key: str, sentinel: float = -1
) -> DataFrame:
    """Mean of every signal per entity and source, joined with the demographics."""
    means = [aggregate_signals(df, key, columns, sentinel) for df, columns in blocks]
    return merge_features([*means, demographics], key)


def feature_set(df: DataFrame, keep: Sequence[str], name: str, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Identifiers plus the features of a named set."""
    return df.select(*keep, *sets[name])


def make_kernels(n: int, steps: int, channels: int, seed: int = 42) -> list[dict]:
    """Random convolution kernels, fixed by (n, steps, channels, seed).

    Length 7, 9 or 11; centred normal weights; uniform bias; exponential dilation; random padding and channels.
    """
    rng = np.random.default_rng(seed)
    lengths = [k for k in (7, 9, 11) if k <= steps] or [steps]
    out = []
    for _ in range(n):
        length = int(rng.choice(lengths))
        used = int(2 ** rng.uniform(0, np.log2(min(channels, length) + 1))) if channels > 1 else 1
        picked = np.sort(rng.choice(channels, min(used, channels), replace=False))
        weights = rng.normal(size=(len(picked), length))
        weights -= weights.mean(axis=1, keepdims=True)
        top = np.log2((steps - 1) / (length - 1)) if steps > length else 0
        dilation = int(2 ** rng.uniform(0, max(top, 0)))
        padding = ((length - 1) * dilation) // 2 if rng.integers(2) else 0
        out.append(
            {
                "weights": weights.tolist(),
                "bias": float(rng.uniform(-1, 1)),
                "dilation": dilation,
                "padding": int(padding),
                "channels": [int(c) for c in picked],
            }
        )
    return out


def _convolve(x: np.ndarray, kernel: dict) -> tuple[np.ndarray, np.ndarray]:
    """Max and share of positive values of the convolution, for a batch (rows, channels, steps)."""
    w = np.asarray(kernel["weights"])
    pad, dil = kernel["padding"], kernel["dilation"]
    part = np.pad(x[:, kernel["channels"], :], ((0, 0), (0, 0), (pad, pad)))
    width = part.shape[2] - (w.shape[1] - 1) * dil
    if width <= 0:
        return np.zeros(len(x)), np.zeros(len(x))
    total = np.full((len(x), width), kernel["bias"])
    for j in range(w.shape[1]):
        total += np.einsum("rcs,c->rs", part[:, :, j * dil : j * dil + width], w[:, j])
    return total.max(axis=1), (total > 0).mean(axis=1)


def panel_features(df: DataFrame, panel: str, kernels: Sequence[dict], keep: Sequence[str]) -> DataFrame:
    """Two features per kernel (max, share of positive values) in ``features``; Arrow batches, no shuffle."""
    kernels = list(kernels)
    kept = df.select(*keep, panel)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != panel)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if rows == 0:
                continue
            lists = batch.column(batch.schema.get_field_index(panel))
            channels = len(lists[0])
            x = lists.flatten().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(rows, channels, -1)
            out = np.empty((rows, 2 * len(kernels)))
            for i, kernel in enumerate(kernels):
                out[:, 2 * i], out[:, 2 * i + 1] = _convolve(x, kernel)
            flat = pa.array(out.ravel())
            offsets = pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32))
            arrays = [batch.column(batch.schema.get_field_index(k)) for k in keep]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.ListArray.from_arrays(offsets, flat)], names=[*keep, "features"]
            )

    return kept.mapInArrow(transform, f"{schema}, features array<double>")


def feature_importance(model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """(feature, importance) rows of a fitted tree model, highest first."""
    values = model.featureImportances.toArray()
    rows = sorted(zip(names, map(float, values)), key=lambda r: -r[1])
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")
