"""Splits, folds, class balancing and weights.

Every random choice is an md5 of (seed, id): the same rows are drawn on any partitioning, after a lost executor, and in
any other engine.  Ranks inside a class come from ``hash_rank``, which cuts a class into many even pieces.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortspark.operators.grouped import hash_rank, number_rows, seeded_hash
from cohortspark.operators.labels import equal_bin, label_bins
from cohortspark.session import staged


def hash_fraction(seed: int | str, *ids: Column | str) -> Column:
    """Reproducible uniform number in [0, 1) from the first 8 hex digits."""
    digits = F.substring(seeded_hash(seed, *ids), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**32))


def _ranked(df: DataFrame, id_column: str, by: Sequence[str], seed, keep=None) -> DataFrame:
    hashed = df.withColumn("_h", seeded_hash(seed, id_column))
    return hash_rank(hashed, list(by), "_h", "_rank", total="_size", ties=[id_column], keep=keep).drop("_h")


def stratified_split(
    df: DataFrame, id_column: str, label: str, test_fraction: float, seed=42, by: Sequence[str] = (),
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Exact share of every class to the test part, in ``split``."""
    out = _ranked(df, id_column, [*by, label], seed)
    cut = F.floor(F.col("_size") * F.lit(float(test_fraction)) + 0.5)
    return out.withColumn("split", F.when(F.col("_rank") <= cut, names[1]).otherwise(names[0])).drop("_rank", "_size")


def random_split(df: DataFrame, id_column: str, test_fraction: float, seed=42) -> DataFrame:
    """Each row on its own by its hash; no shuffle."""
    return df.withColumn(
        "split", F.when(hash_fraction(seed, id_column) < test_fraction, "test").otherwise("train")
    )


def ordered_split(
    df: DataFrame, id_column: str, fraction: float, exclude: Sequence = (), target_rows: int | None = None
) -> DataFrame:
    """The first ``fraction`` of the ids in order to the training part, the rest to the test part.

    Ids in ``exclude`` are taken out after the cut.
    """
    ids = df.select(id_column).distinct()
    ranked = number_rows(ids, [], id_column, "_rank", target_rows=target_rows)
    cut = ids.agg(F.floor(F.count(F.lit(1)) * F.lit(float(fraction)))).scalar()
    out = ranked.withColumn("_cut", cut).select(
        id_column, F.when(F.col("_rank") <= F.col("_cut"), "train").otherwise("test").alias("split")
    )
    return out.filter(~F.col(id_column).isin(list(exclude))) if exclude else out


def kfold(df: DataFrame, id_column: str, label: str, k: int, seed=42) -> DataFrame:
    """Stratified fold number 0..k-1 in ``fold``; class counts of the folds differ by at most one."""
    out = _ranked(df, id_column, [label], seed)
    return out.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_size")


def client_split(df: DataFrame, id_column: str, n: int, label: str | None = None, seed=42) -> DataFrame:
    """Equal clients 1..n in ``client``, stratified by the label when one is given."""
    out = _ranked(df, id_column, [label] if label else [], seed)
    return out.withColumn("client", ((F.col("_rank") - 1) % n + 1).cast("int")).drop("_rank", "_size")


def valid_split(
    df: DataFrame, id_column: str, client: str, label: str | None = None, train_fraction: float = 0.85, seed=42
) -> DataFrame:
    """Training and validation part inside every client."""
    by = [client, label] if label else [client]
    out = _ranked(df, id_column, by, seed)
    cut = F.floor(F.col("_size") * F.lit(float(train_fraction)) + 0.5)
    return out.withColumn("split", F.when(F.col("_rank") <= cut, "train").otherwise("valid")).drop("_rank", "_size")


def undersample(
    df: DataFrame, label: str, id_column: str, targets: Mapping | None = None, seed=42
) -> DataFrame:
    """Keep as many rows of every class as the smallest class has, or the given number per class.

    Classes without a given number stay whole.
    """
    if targets:

        def keep(size: Column) -> Column:
            for value, n in targets.items():
                size = F.when(F.col(label) == value, F.lit(int(n))).otherwise(size)
            return size

        return _ranked(df, id_column, [label], seed, keep).drop("_rank", "_size")
    smallest = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg(F.min("_n")).scalar()
    marked = df.withColumn("_keep", smallest)
    return _ranked(marked, id_column, [label], seed, lambda size: F.col("_keep")).drop("_rank", "_size", "_keep")


def balanced_bootstrap(df: DataFrame, label: str, id_column: str, trees: int, seed=42) -> DataFrame:
    """One balanced sample per tree: every class gives as many rows as the smallest class has, drawn with replacement.

    Returns the rows with ``tree`` (from 0) and ``draw`` (from 1 inside tree and class).  The drawn rank is the hash of
    (seed, class, tree, draw) over the rows of the class in hash order, so a sample is the same on any partitioning;
    rows without a label are left out.
    """
    rows = df.filter(F.col(label).isNotNull())
    ranked = _ranked(rows, id_column, [label], seed)
    sizes = rows.groupBy(F.col(label).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    wanted = sizes.withColumn("_copies", sizes.agg(F.min("_n")).scalar())
    wanted = _repeated(wanted.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))))
    drawn = F.floor(hash_fraction(f"{seed}t", "_c", "tree", "copy") * F.col("_n")) + 1
    draws = wanted.select("_c", "tree", F.col("copy").alias("draw"), drawn.alias("_at"))
    met = draws.join(ranked, (F.col("_c") == F.col(label)) & (F.col("_at") == F.col("_rank")))
    return met.select(*df.columns, "tree", "draw")


def oversample(df: DataFrame, label: str, id_column: str, seed=42) -> DataFrame:
    """Repeat rows of every class up to the size of the largest, evenly; ``copy`` numbers the repeats from 1."""
    out = _ranked(df, id_column, [label], seed)
    largest = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).scalar()
    out = out.withColumn("_max", largest)
    extra = (F.col("_rank") <= F.col("_max") % F.col("_size")).cast("bigint")
    copies = F.floor(F.col("_max") / F.col("_size")) + extra
    return _repeated(out.withColumn("_copies", copies)).drop("_rank", "_size", "_max")


COPY_BLOCK = 10_000


def _repeated(df: DataFrame) -> DataFrame:
    """Every row ``_copies`` times, numbered from 1 in ``copy``; listed by blocks, so no array grows with the copies."""
    one = F.lit(1).cast("bigint")
    blocks = F.when(F.col("_copies") > 0, F.sequence(one, F.col("_copies"), F.lit(COPY_BLOCK).cast("bigint")))
    out = df.withColumn("_from", F.explode(blocks))
    upto = F.least(F.col("_copies"), F.col("_from") + (COPY_BLOCK - 1))
    return out.withColumn("copy", F.explode(F.sequence(F.col("_from"), upto))).drop("_copies", "_from")


def plain_id(df: DataFrame, column: str) -> Column:
    """An id of any type; whole numbers of any width as ``bigint``."""
    whole = df.schema[column].dataType.typeName() in ("byte", "short", "integer")
    return F.col(column).cast("bigint") if whole else F.col(column)


def _best(x: np.ndarray, ids: np.ndarray, y: np.ndarray, others: np.ndarray, k: int):
    """Rows, neighbours and squared distances of the k best ``y`` for every ``x``, nearest first, then by id."""
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    places = np.unique(others, return_inverse=True)[1]
    n, out = min(k, len(y)), []
    for i in range(0, len(x), 256):
        part = slice(i, i + 256)
        near = xx[part, None] + yy[None, :] - 2 * x[part] @ y.T
        near[ids[part, None] == others[None, :]] = np.inf
        # the product form is inexact in its last digits: everything within them of the k-th is measured again
        cut = np.partition(near, n - 1, axis=1)[:, n - 1] + 1e-9 * (xx[part] + yy.max())
        row, col = np.nonzero((near <= cut[:, None]) & np.isfinite(near))
        d = np.concatenate(
            [((x[i + row[j : j + 50_000]] - y[col[j : j + 50_000]]) ** 2).sum(axis=1) for j in range(0, len(row), 50_000)]
            or [np.empty(0)]
        )
        order = np.lexsort((places[col], d, row))
        row, col, d = row[order], col[order], d[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        row, col, d = (a[place < k] for a in (row, col, d))
        out.append((i + row, others[col], d))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def pivot_blocks(rows: DataFrame, block_rows: int, seed, max_pivots: int = 256) -> DataFrame:
    """Rows (id, v, c) with the block they belong to and their distance from every pivot of their class ``c``:
    (id, v, c, cell, block, dist).

    Pivots are rows chosen by hash, about one per ``block_rows`` rows of the class and at most about ``max_pivots``; a
    cell is the rows that lie nearest to a pivot.  Cells above ``block_rows`` are dealt into blocks by hash.  Vectors are
    shuffled once, by slices of even size, so a large class or cell is never in one task.
    """
    kind, class_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "c"))
    hashed = rows.withColumn("_h", hash_fraction(f"{seed}p", "id"))
    slices = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)), F.lit(1)).cast("int")
    sizes = hashed.groupBy("c").agg(F.count(F.lit(1)).alias("_n"), slices.alias("_s"), F.min("_h").alias("_first"))
    hashed = hashed.join(sizes, "c")
    # both sides of a cogroup come from the same rows, so the columns of each are named anew
    own = [F.col(c).alias(c) for c in ("id", "v", "c")]
    dealt = hashed.select(*own, F.floor(F.col("_h") * F.col("_s")).cast("int").alias("a"))
    share = F.least(F.col("_s"), F.lit(max_pivots)) / F.col("_n")
    pivots = hashed.filter(F.col("_h") <= F.greatest("_first", share)).select(
        *own, F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("a")
    )

    def measure(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return pd.DataFrame({"id": [], "v": [], "c": [], "cell": [], "dist": []})
        p = np.stack(right.sort_values("id")["v"]).astype(float)
        x = np.stack(left["v"]).astype(float)
        d = np.empty((len(x), len(p)))
        for j in range(len(p)):
            d[:, j] = np.sqrt(((x - p[j]) ** 2).sum(axis=1))
        return pd.DataFrame(
            {"id": left["id"], "v": left["v"], "c": left["c"], "cell": d.argmin(axis=1), "dist": list(d)}
        )

    cells = (
        dealt.groupBy("c", "a")
        .cogroup(pivots.groupBy("c", "a"))
        .applyInPandas(measure, f"id {kind}, v array<double>, c {class_kind}, cell int, dist array<double>")
    )
    parts = cells.groupBy("c", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).alias("_parts"))
    part = F.floor(hash_fraction(f"{seed}b", "id") * F.col("_parts"))
    return cells.join(parts, ["c", "cell"]).select(
        "id", "v", "c", "cell", F.concat_ws(":", "cell", part.cast("bigint")).alias("block"), "dist"
    )


def neighbour_visits(blocks: DataFrame, k: int) -> DataFrame:
    """Best neighbours inside the own block, and the other blocks that may hold better ones:
    (id, v, c, block, near, visits).

    The k-th distance inside the own block bounds the search (no bound with fewer than k others).  A block whose rows
    are between lo and hi away from pivot p holds nothing nearer to a row at distance d from p than d - hi or lo - d,
    by the triangle inequality; only blocks where this beats the bound are visited.
    """
    kind, class_kind = (blocks.schema[c].dataType.simpleString() for c in ("id", "c"))

    def own(rows: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(rows["v"]).astype(float), rows["id"].to_numpy()
        row, other, d = _best(x, ids, x, ids, k)
        first = np.searchsorted(row, np.arange(len(x) + 1))
        near = [[(other[j], d[j]) for j in range(lo, hi)] for lo, hi in zip(first[:-1], first[1:])]
        reach = [np.sqrt(n[-1][1]) if len(n) == k else np.inf for n in near]
        return rows[["id", "v", "c", "block", "dist"]].assign(near=near, reach=reach)

    searched = blocks.groupBy("c", "block").applyInPandas(
        own, f"id {kind}, v array<double>, c {class_kind}, block string, dist array<double>, "
             f"near array<struct<neighbour: {kind}, d: double>>, reach double",
    )
    to_pivot = F.element_at("dist", F.col("cell") + 1)
    bounds = blocks.groupBy("c", "block").agg(
        F.max("cell").alias("cell"), F.min(to_pivot).alias("lo"), F.max(to_pivot).alias("hi")
    )
    tables = bounds.groupBy("c").agg(F.collect_list(F.struct("block", "cell", "lo", "hi")).alias("_table"))

    def may_hold(b: Column) -> Column:
        d = F.element_at("dist", b["cell"] + 1)
        least = F.greatest(d - b["hi"], b["lo"] - d)
        slack = (d + b["hi"]) * 1e-9  # distances are rounded
        return (b["block"] != F.col("block")) & (least <= F.col("reach") + slack)

    visits = F.transform(F.filter("_table", may_hold), lambda b: b["block"])
    return searched.join(tables, "c").select("id", "v", "c", "block", "near", visits.alias("visits"))


def nearest_neighbours(
    df: DataFrame, id_column: str, vector: str, k: int = 5, block_rows: int = 4096, seed=42, by: str | None = None,
    max_pivots: int = 256,
) -> DataFrame:
    """Exact k nearest other rows by Euclidean distance, of the same ``by`` if given: (id, neighbour, place, found, c),
    where ``c`` is the value of ``by`` (0 without).  Ids must differ inside a ``c``; the same id in another is another row.

    Rows lie in blocks around pivots.  A row is compared with its own block, then sent to those other blocks only that
    can hold a nearer one; one task compares one block with the rows of one other, and returns the k best per row.
    Blocks and first results are written to the shared folder, so no comparison is made twice.
    """
    group = F.col(by) if by else F.lit(0)
    vectors = F.col(vector).cast("array<double>")
    rows = df.select(plain_id(df, id_column).alias("id"), vectors.alias("v"), group.alias("c"))
    kind, class_kind = (rows.schema[c].dataType.simpleString() for c in ("id", "c"))
    blocks = staged(pivot_blocks(rows, block_rows, seed, max_pivots))
    searched = staged(neighbour_visits(blocks, k))
    inside = searched.select("id", "c", F.explode("near").alias("_n")).select("id", "_n.neighbour", "_n.d", "c")
    own = [F.col(c).alias(c) for c in ("id", "v", "c")]
    left = searched.select(*own, F.col("block").alias("a"), F.explode("visits").alias("b"))
    met = left.select("c", "a", "b").distinct()
    right = blocks.select(*own, F.col("block").alias("b")).join(met, ["c", "b"])
    right = right.select(*[F.col(c).alias(c) for c in ("id", "v", "c", "a", "b")])

    def other(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(left["v"]).astype(float), np.stack(right["v"]).astype(float)
        row, neighbour, d = _best(x, left["id"].to_numpy(), y, right["id"].to_numpy(), k)
        return pd.DataFrame({"id": left["id"].to_numpy()[row], "neighbour": neighbour, "d": d}).assign(c=left["c"].iloc[0])

    outside = (
        left.groupBy("c", "a", "b")
        .cogroup(right.groupBy("c", "a", "b"))
        .applyInPandas(other, f"id {kind}, neighbour {kind}, d double, c {class_kind}")
    )
    w = Window.partitionBy("c", "id").orderBy("d", "neighbour")
    found = inside.unionByName(outside)
    near = found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k).drop("d")
    return near.withColumn("found", F.count(F.lit(1)).over(Window.partitionBy("c", "id")).cast("int"))


def smote(
    df: DataFrame, label: str, minority, id_column: str, vector: str, k: int = 5, seed=42, block_rows: int = 4096
) -> DataFrame:
    """Synthetic minority rows until the minority is as large as the largest class.

    Every synthetic row lies on the segment from a minority row to one of its k nearest minority rows; which one, and
    how far along, is fixed by the hash of (seed, id, copy).  Returns (base id, copy, neighbour, label, vector).  A
    minority of one row has no neighbour: the job fails and says so.
    """
    few = df.filter(F.col(label) == minority)
    rows = few.select(plain_id(df, id_column).alias("_id"), F.lit(minority).alias("_c"), F.col(vector).alias("_v"))
    near = nearest_neighbours(rows, "_id", "_v", k, block_rows, seed)
    return _synthetic(rows, near, _largest(df, label), seed, []).toDF(id_column, "copy", "neighbour", label, vector)


def smote_classes(
    df: DataFrame, label: str, id_column: str, vector: str, k: int = 5, seed=42, block_rows: int = 4096
) -> DataFrame:
    """Synthetic rows until every class is as large as the largest, as ``smote`` makes them for one class.

    All classes are filled in one job; neighbours are rows of the same class.  Rows without a label are left out.
    """
    known = df.filter(F.col(label).isNotNull())
    rows = known.select(plain_id(df, id_column).alias("_id"), F.col(label).alias("_c"), F.col(vector).alias("_v"))
    largest = _largest(known, label)
    smaller = rows.groupBy("_c").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < largest).select("_c")
    rows = rows.join(smaller, "_c", "left_semi")
    near = nearest_neighbours(rows, "_id", "_v", k, block_rows, seed, by="_c")
    return _synthetic(rows, near, largest, seed, ["_c"]).toDF(id_column, "copy", "neighbour", label, vector)


def _largest(df: DataFrame, label: str) -> Column:
    """Rows of the largest class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).scalar()


def _synthetic(rows: DataFrame, near: DataFrame, largest: Column, seed, by: Sequence[str]) -> DataFrame:
    """(id, copy, neighbour, class, vector) of new rows that fill every class ``_c`` of ``rows`` up to ``largest``;
    ``by`` is empty where there is one class."""
    rows = rows.withColumn("_v", F.col("_v").cast("array<double>"))
    ranked = _ranked(rows, "_id", by, seed).withColumn("_new", largest - F.col("_size"))
    extra = (F.col("_rank") <= F.col("_new") % F.col("_size")).cast("bigint")
    copies = F.floor(F.col("_new") / F.col("_size")) + extra
    wanted = _repeated(ranked.withColumn("_copies", copies)).select("_id", "_c", "_v", "copy")
    near = near.withColumnsRenamed({"id": "_id", "c": "_c"}) if by else near.withColumnRenamed("id", "_id").drop("c")
    draw = F.conv(F.substring(seeded_hash(f"{seed}n", "_id", "copy"), 1, 8), 16, 10).cast("bigint")
    chosen = wanted.withColumn("_draw", draw).join(near, [*by, "_id"])
    chosen = chosen.filter(F.col("place") == F.col("_draw") % F.col("found") + 1)
    other = rows.select(*by, F.col("_id").alias("neighbour"), F.col("_v").alias("_w"))
    step = hash_fraction(f"{seed}l", "_id", "copy")
    made = chosen.join(other, [*by, "neighbour"]).select(
        "_id", "copy", "neighbour", "_c", F.zip_with("_v", "_w", lambda a, b: a + step * (b - a)).alias("_v")
    )
    # a row alone in its class meets no neighbour and would leave no trace in the join, so it is looked for beside it
    alone = (F.col("_size") == 1) & (F.col("_new") > 0)
    refusal = F.raise_error(F.lit("SMOTE needs at least two rows of the minority")).cast("boolean")
    refused = ranked.filter(F.when(alone, refusal).otherwise(F.lit(False)))
    none = F.lit(None).cast("bigint")
    return made.unionByName(refused.select("_id", none.alias("copy"), F.col("_id").alias("neighbour"), "_c", "_v"))


def class_weights(df: DataFrame, y: str, n: int) -> DataFrame:
    """Weight ``rows / rows of the label window`` per row.

    The counting windows include both ends, so a label on a bound counts twice; the row's own window is the
    equal-width bin.  Both are kept as they are defined.
    """
    counts = F.array(
        *[F.count_if((F.col(y) >= lo) & (F.col(y) <= hi)).cast("double") for lo, hi in label_bins(n)]
    )
    row = df.agg(F.struct(F.count(F.lit(1)).alias("n"), counts.alias("c"))).scalar()
    out = df.withColumn("_w", row)
    count = F.element_at("_w.c", equal_bin(y, n) + 1)
    return out.withColumn("weight", F.when(count > 0, F.col("_w.n") / count)).drop("_w")


def assign_batches(df: DataFrame, id_column: str, size: int, by: Sequence[str] = (), seed=42) -> DataFrame:
    """Batch number 0, 1, ... after a shuffle by hash, inside ``by``."""
    out = _ranked(df, id_column, list(by), seed)
    return out.withColumn("batch", F.floor((F.col("_rank") - 1) / F.lit(size)).cast("int")).drop("_rank", "_size")


def sampling_report(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Class counts before and after sampling."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit(name))

    return counts(before, "before").unionByName(counts(after, "after"))
