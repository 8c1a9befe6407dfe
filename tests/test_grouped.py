"""Cut groups must give the same answer as one whole window per group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortspark.operators import grouped as g


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(rng.random(n) < 0.4, 1, rng.integers(2, 60, n))
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "t": rng.integers(0, 700, n),
                        "v": np.where(rng.random(n) < 0.6, None, rng.integers(0, 50, n).astype(float))})
    return spark.createDataFrame(pdf, "id long, k long, t long, v double").cache()


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    x = a.select(cols).toPandas().sort_values(cols).reset_index(drop=True)
    y = b.select(cols).toPandas().sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(x, y, check_dtype=False)


@pytest.mark.parametrize("target", [50, 300, 10_000])
@pytest.mark.parametrize("keys", [["k"], []])
def test_numbers(rows, target, keys):
    w = Window.partitionBy(*keys).orderBy("t", "id")
    wt = Window.partitionBy(*keys).orderBy("t")
    same(g.number_rows(rows, keys, "t", "r", ties=["id"], target_rows=target),
         rows.withColumn("r", F.row_number().over(w)))
    same(g.number_rows(rows, keys, "t", "r", method="dense_rank", target_rows=target),
         rows.withColumn("r", F.dense_rank().over(wt)))


@pytest.mark.parametrize("target", [50, 10_000])
def test_many_pieces(rows, target):
    points = g.split_points(rows, ["k"], "t", target_rows=10)
    assert points.filter("k = 1").selectExpr("size(_cuts) n").first().n > 64
    w = Window.orderBy("t", "id")
    same(g.number_rows(rows, [], "t", "r", ties=["id"], target_rows=20),
         rows.withColumn("r", F.row_number().over(w)))


@pytest.mark.parametrize("target", [50, 10_000])
@pytest.mark.parametrize("directions", [("forward", "backward"), ("backward", "forward"), ("forward",)])
def test_fill(rows, target, directions):
    w = Window.partitionBy("k").orderBy("t", "id")
    f = F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    b = F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing))
    want = F.coalesce(*[{"forward": f, "backward": b}[d] for d in directions])
    same(g.fill(rows, ["k"], "t", ["v"], directions, ties=["id"], target_rows=target), rows.withColumn("v", want))


@pytest.mark.parametrize("target", [50, 10_000])
def test_neighbours_and_sums(rows, target):
    w = Window.partitionBy("k").orderBy("t", "id")
    same(g.previous_next(rows, ["k"], "t", {"p": "v"}, {"f": "id"}, ties=["id"], target_rows=target),
         rows.withColumn("p", F.lag("v").over(w)).withColumn("f", F.lead("id").over(w)))
    per = rows.groupBy("k", "t").agg(F.count("*").alias("n"))
    wk = Window.partitionBy("k").orderBy("t")
    same(g.running_sum(per, ["k"], "t", {"s": "n"}, target_rows=target), per.withColumn("s", F.sum("n").over(wk)))
    same(g.running_sum(per, ["k"], "t", {"s": "n"}, descending=True, target_rows=target),
         per.withColumn("s", F.sum("n").over(Window.partitionBy("k").orderBy(F.desc("t")))))


@pytest.mark.parametrize("target", [20, 10_000])
@pytest.mark.parametrize("keys", [["k"], []])
def test_quantiles(rows, target, keys):
    got = g.quantiles(rows, keys, "v", {"a": 0.25, "m": 0.5, "z": 0.9}, target_rows=target)
    want = rows.groupBy(*keys).agg(*[F.percentile("v", p).alias(n) for n, p in (("a", .25), ("m", .5), ("z", .9))])
    same(got, want.filter("m is not null"))


def test_hash_rank(rows):
    h = rows.withColumn("h", g.seeded_hash(7, "id"))
    w = Window.partitionBy("k").orderBy("h")
    same(g.hash_rank(h, ["k"], "h", "r", total="n"),
         h.withColumn("r", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("k"))))


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one key, and a key of null; times with nulls and ties, and texts."""
    i = F.col("id")
    key = F.when(i % 2 == 0, 7).when(i % 11 == 0, F.lit(None)).otherwise(i % 50)
    return spark.range(40_000).select(
        "id",
        key.cast("int").alias("k"),
        F.when(i % 13 == 0, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(900))).alias("t"),
        F.substring(F.md5(i.cast("string")), 1, 3).alias("s"),
        F.when(i % 3 == 0, F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(100)).cast("double")).alias("v"),
    ).cache()


@pytest.mark.parametrize("order", ["t", "s"])
def test_one_key_with_half_of_the_rows(skewed, order):
    """Large enough that a sample places the cuts."""
    target = 4_000
    g_samples, g.SAMPLES = g.SAMPLES, 400
    try:
        pieces, _ = g.with_pieces(skewed, ["k"], order, ["id"], target_rows=target)
        sizes = sorted(r["count"] for r in pieces.groupBy("k", g.PIECE).count().filter("k = 7").collect())
        assert len(sizes) > 3 and sizes[-1] <= 2 * 20_000 / len(sizes)
        w = Window.partitionBy("k").orderBy(order, "id")
        same(g.number_rows(skewed, ["k"], order, "r", ties=["id"], target_rows=target), skewed.withColumn("r", F.row_number().over(w)))
        want = skewed.withColumns({"p": F.lag("v").over(w), "f": F.lead("id").over(w)})
        same(g.previous_next(skewed, ["k"], order, {"p": "v"}, {"f": "id"}, ties=["id"], target_rows=target), want)
        want = skewed.withColumn("v", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        same(g.fill(skewed, ["k"], order, ["v"], ["forward"], ties=["id"], target_rows=target), want)
        w = Window.partitionBy("k").orderBy(order)
        for method, rank in (("rank", F.rank()), ("dense_rank", F.dense_rank())):
            same(g.number_rows(skewed, ["k"], order, "r", method=method, target_rows=target), skewed.withColumn("r", rank.over(w)))
    finally:
        g.SAMPLES = g_samples


def test_nothing_runs_before_an_action(spark, rows, tmp_path):
    path = str(tmp_path / "rows")
    rows.write.parquet(path)
    small = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("before", "no job may be in this group")
    made = [
        g.number_rows(small, ["k"], "t", "r", ties=["id"]),
        g.fill(small, ["k"], "t", ["v"], ties=["id"]),
        g.previous_next(small, [], "t", {"p": "v"}, ties=["id"]),
        g.quantiles(small, ["k"], "v", {"m": 0.5}),
    ]
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("before")) == []
    spark.sparkContext.setJobGroup("after", "")
    assert g.split_points(rows, ["k"], "t", target_rows=10_000).count() == 0
    w = Window.partitionBy("k").orderBy("t", "id")
    same(made[0], rows.withColumn("r", F.row_number().over(w)))
    same(made[1], g.fill(rows, ["k"], "t", ["v"], ties=["id"], target_rows=40))


def test_hash_rank_of_missing_classes_and_limit(spark):
    df = spark.createDataFrame([(i, None if i % 3 else i % 2) for i in range(90)], "id int, k int")
    h = df.withColumn("h", g.seeded_hash(1, "id"))
    want = h.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("h"))).withColumn(
        "n", F.count("*").over(Window.partitionBy("k")))
    same(g.hash_rank(h, ["k"], "h", "r", total="n", digits=1), want)
    same(g.hash_rank(h, ["k"], "h", "r", total="n", digits=1, keep=lambda n: F.lit(7)), want.filter("r <= 7"))


@pytest.mark.parametrize("target", [None, 40])
@pytest.mark.parametrize("keys", [["k"], []])
def test_totals(rows, target, keys):
    per = rows.groupBy(*keys, "t").agg(F.count("*").alias("n"))
    got = g.running_sum(per, keys, "t", {"s": "n"}, totals={"all": "n"}, target_rows=target)
    want = per.withColumn("s", F.sum("n").over(Window.partitionBy(*keys).orderBy("t")))
    same(got, want.withColumn("all", F.sum("n").over(Window.partitionBy(*keys))))
