"""Registry of the checked queries, and the stand-in tables they read.

The clinical source tables are not public, so the queries run the operators on the given order, event, vector and
document tables in clinical roles: lines of orders are measurements, orders are episodes, events are series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(name)
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column: Column | str, name: str | None = None) -> Column:
    c = F.round(F.col(column) if isinstance(column, str) else column, 6)
    return c.alias(name or column) if name or isinstance(column, str) else c


def rounded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- stand-ins: the DataFrame and the same rows in SQL ------------------------------------------------------------


def meas(spark, d, dealt: bool = False) -> DataFrame:
    """Measurements: lines of an order, for the subject who ordered.

    ``dealt``: lines and orders meet in as many tasks as there are shuffle partitions, none merged by the adaptive plan.
    Sums whose keys hold the order follow in the task of the join, beside its sorted rows; they keep nearly as many
    groups as lines, so merged partitions of a few compressed bytes a line need gigabytes.
    """
    lines = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("hadm"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("t"),
        F.concat("l_returnflag", "l_linestatus").alias("item"),
        F.col("l_quantity").alias("value"),
    )
    subjects = table(spark, d, "orders").select(F.col("o_orderkey").alias("hadm"), F.col("o_custkey").alias("subject"))
    if dealt:
        lines = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "hadm")
    return lines.join(subjects, "hadm")


MEAS = """(SELECT l_orderkey AS hadm, l_linenumber AS line, l_shipdate AS t, l_returnflag || l_linestatus AS item,
 l_quantity AS value, o_custkey AS subject FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def epi(spark, d) -> DataFrame:
    """Episodes: orders as stays of 1 to 9 days."""
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("episode"),
        F.col("o_custkey").alias("subject"),
        F.col("o_orderdate").alias("intime"),
        (F.col("o_orderdate") + F.make_dt_interval((1 + F.col("o_orderkey") % 9).cast("int"))).alias("outtime"),
        F.col("o_orderstatus").alias("unit"),
        F.col("o_totalprice").alias("price"),
    )


EPI = """(SELECT o_orderkey AS episode, o_custkey AS subject, o_orderdate AS intime,
 o_orderdate + (1 + o_orderkey % 9) * INTERVAL 1 DAY AS outtime, o_orderstatus AS unit, o_totalprice AS price
 FROM orders)"""


def series(spark, d) -> DataFrame:
    """Series: events of a user."""
    return table(spark, d, "events").select(
        "event_id",
        F.col("user_id").alias("entity"),
        F.col("ts").alias("t"),
        F.col("event_type").alias("item"),
        "value",
        F.get_json_object("props", "$.k").alias("text"),
    )


SERIES = """(SELECT event_id, user_id AS entity, ts AS t, event_type AS item, value,
 regexp_extract(props, '"k": ?([0-9]+)', 1) AS text FROM events)"""

SIGNALS = ["view", "click", "purchase", "signup", "error"]


def wide(spark, d) -> DataFrame:
    """Wide series: one column per event type (repeats in one instant do not occur)."""
    from cohortspark.operators.aggregates import pivot_mean

    return pivot_mean(series(spark, d), ["entity", "t"], "item", "value", {s: s for s in SIGNALS})


WIDE = (
    "(SELECT user_id AS entity, ts AS t, "
    + ", ".join(f"avg(CASE WHEN event_type = '{s}' THEN value END) AS \"{s}\"" for s in SIGNALS)
    + " FROM events GROUP BY 1, 2)"
)


def weekly(spark, d) -> DataFrame:
    """Weekly episodes of every user."""
    users = table(spark, d, "events").select(F.col("user_id").alias("entity")).distinct()
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    weeks = users.withColumn("week", F.explode(F.sequence(F.lit(0), F.lit(4))))
    return weeks.select(
        "entity",
        "week",
        (start + F.make_dt_interval(7 * F.col("week"))).alias("intime"),
        (start + F.make_dt_interval(7 * F.col("week") + 3 + (F.col("entity") % 4).cast("int"))).alias("outtime"),
    )


WEEKLY = """(SELECT entity, week, TIMESTAMP '2024-01-01' + week * INTERVAL 7 DAY AS intime,
 TIMESTAMP '2024-01-01' + week * INTERVAL 7 DAY + (3 + entity % 4) * INTERVAL 1 DAY AS outtime
 FROM (SELECT DISTINCT user_id AS entity FROM events) u, (SELECT unnest([0, 1, 2, 3, 4]) AS week) w)"""


def codes(spark, d) -> DataFrame:
    """Diagnoses: part type and brand of the lines of an order."""
    parts = table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("code"), F.col("p_brand").alias("brand")
    )
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("hadm"), "l_partkey")
    return lines.join(parts, "l_partkey").drop("l_partkey")


CODES = """(SELECT l_orderkey AS hadm, p_type AS code, p_brand AS brand
 FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def imb(spark, d) -> DataFrame:
    """Imbalanced rows: labelled documents with a rule score and two rule predictions."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = table(spark, d, "labels").join(docs, "doc_id")
    score = F.round(F.col("n_chars") / (F.col("n_chars") + 2000.0), 3)
    return rows.withColumns({"score": score, "pred": (score > 0.6).cast("int")})


IMB = """(SELECT doc_id, quality, toxic, lang, source, n_chars,
 round(n_chars / (n_chars + 2000.0), 3) AS score,
 CASE WHEN round(n_chars / (n_chars + 2000.0), 3) > 0.6 THEN 1 ELSE 0 END AS pred
 FROM labels JOIN documents USING (doc_id))"""


def vec(spark, d) -> DataFrame:
    return table(spark, d, "embeddings")
