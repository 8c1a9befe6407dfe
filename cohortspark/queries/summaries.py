"""Queries: aggregates, distributions, windows and cohort filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.functions import datetimes as dt
from cohortspark.operators import aggregates as ag
from cohortspark.operators import cohort as co
from cohortspark.operators import windows as wn
from cohortspark.queries.base import (
    EPI, MEAS, SERIES, SIGNALS, WIDE, epi, meas, query, r6, rounded, series, table, wide,
)

_SIG = ", ".join(SIGNALS)


@query("aggregate_signals", "SELECT entity, " + ", ".join(f"round(avg(nullif({s}, -1)), 6) AS {s}" for s in SIGNALS)
       + f" FROM (SELECT entity, " + ", ".join(f"coalesce({s}, -1) AS {s}" for s in SIGNALS) + f" FROM {WIDE} w) x GROUP BY 1")
def aggregate_signals(spark, d):
    marked = wide(spark, d).na.fill(-1.0, SIGNALS)
    return rounded(ag.aggregate_signals(marked, "entity", SIGNALS), SIGNALS)


@query("column_medians", "SELECT " + ", ".join(f"round(median({s}), 6) AS {s}" for s in SIGNALS) + f" FROM {WIDE} w")
def column_medians(spark, d):
    return rounded(ag.column_medians(wide(spark, d), SIGNALS), SIGNALS)


@query("time_span", f"SELECT entity, round(epoch_us(max(t) - min(t)) / 1e6, 6) AS span_seconds FROM {SERIES} s GROUP BY 1")
def time_span(spark, d):
    return rounded(ag.time_span(series(spark, d), "entity", "t"), ["span_seconds"])


@query("distinct_counts", f"SELECT count(DISTINCT subject) AS subject, count(DISTINCT hadm) AS hadm, count(DISTINCT item) AS item FROM {MEAS} m")
def distinct_counts(spark, d):
    return ag.count_distinct(meas(spark, d), ["subject", "hadm", "item"])


@query("value_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def value_counts(spark, d):
    return ag.value_counts(table(spark, d, "orders"), "o_orderpriority", ["o_orderstatus"])


@query("crosstab", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "n_F",
 count(*) FILTER (o_orderstatus = 'O') AS "n_O", count(*) FILTER (o_orderstatus = 'P') AS "n_P", count(*) AS total
FROM orders GROUP BY 1""")
def crosstab(spark, d):
    return ag.crosstab(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("distinct_by_group", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def distinct_by_group(spark, d):
    return ag.count_distinct_by(table(spark, d, "orders"), "o_orderpriority", "o_custkey", F.col("o_orderstatus") == "F")


def _describe_sql(by, source, columns):
    parts = [
        f"SELECT {by} '{c}' AS signal, count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(min({c}), 6) AS min, round(max({c}), 6) AS max, round(quantile_cont({c}, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75 FROM {source} x "
        + (f"GROUP BY {by.rstrip(', ')}" if by else "")
        for c in columns
    ]
    return " UNION ALL ".join(parts)


_STATS = ["mean", "std", "min", "max", "q25", "q50", "q75"]


@query("describe", _describe_sql("", WIDE, SIGNALS))
def describe(spark, d):
    return rounded(ag.describe(wide(spark, d), SIGNALS), _STATS)


@query("describe_by", _describe_sql("o_orderstatus, ", "orders", ["o_totalprice"]))
def describe_by(spark, d):
    return rounded(ag.describe(table(spark, d, "orders"), ["o_totalprice"], ["o_orderstatus"]), _STATS)


@query("null_counts", " UNION ALL ".join(f"SELECT '{s}' AS \"column\", count(*) - count({s}) AS nulls FROM {WIDE} w" for s in SIGNALS))
def null_counts(spark, d):
    return ag.null_counts(wide(spark, d), SIGNALS)


@query("quantile_cut", """
SELECT o_orderstatus, count(*) AS n, round(max(threshold), 6) AS threshold FROM
 (SELECT o_orderstatus, o_totalprice, (SELECT quantile_cont(o_totalprice, 0.9) FROM orders) AS threshold FROM orders) x
WHERE o_totalprice > threshold GROUP BY 1""")
def quantile_cut(spark, d):
    rows = ag.quantile_cut(table(spark, d, "orders"), "o_totalprice", 0.9)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), r6(F.max("threshold"), "threshold"))


_HOURS = f"(SELECT unit, episode, epoch_us(outtime - intime) / 3.6e9 AS h FROM {EPI} e)"
_EDGES = [24, 48, 72, 96, 120, 400, 500]


@query("histogram", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT unit, {i} AS bin, {lo}.0::DOUBLE AS low, {hi}.0::DOUBLE AS high, count(*) FILTER (h >= {lo} AND h {'<=' if i == len(_EDGES) - 2 else '<'} {hi}) AS n FROM {_HOURS} x GROUP BY 1"
    for i, (lo, hi) in enumerate(zip(_EDGES[:-1], _EDGES[1:]))) + ") y")
def histogram(spark, d):
    rows = epi(spark, d).select("unit", dt.datetime_diff("outtime", "intime", "HOUR").alias("h"))
    return ag.histogram(rows, "h", _EDGES, ["unit"])


@query("histogram_equal_width", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
 c AS (SELECT least(floor((o_totalprice - lo) / ((hi - lo) / 28)), 27) AS bin, count(*) AS n FROM orders, b GROUP BY 1)
SELECT k AS bin, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(0, 27)) AS k) g LEFT JOIN c ON c.bin = k""")
def histogram_equal_width(spark, d):
    return ag.equal_width_histogram(table(spark, d, "orders"), "o_totalprice", 28)


_CUTS = [8, 16, 24, 32, 40, 48, 72, 120]


@query("threshold_counts", " UNION ALL ".join(
    f"SELECT {c}.0::DOUBLE AS cut, count(*) FILTER (h >= {c} AND unit = 'F') AS \"n_F\", count(*) FILTER (h >= {c} AND unit = 'O') AS \"n_O\", "
    f"count(*) FILTER (h >= {c} AND unit IN ('F', 'O')) AS total FROM {_HOURS} x" for c in _CUTS))
def threshold_counts(spark, d):
    rows = epi(spark, d).select("unit", dt.datetime_diff("outtime", "intime", "HOUR").alias("h"))
    return ag.threshold_counts(rows, "h", _CUTS, "unit", ["F", "O"])


@query("range_counts", """
SELECT '= 0' AS range, count(*) FILTER (d = 0) AS n FROM (SELECT l_discount AS d FROM lineitem) x
UNION ALL SELECT '(0, 0.02]', count(*) FILTER (l_discount > 0 AND l_discount <= 0.02::DOUBLE) FROM lineitem
UNION ALL SELECT '(0.02, 0.05]', count(*) FILTER (l_discount > 0.02::DOUBLE AND l_discount <= 0.05::DOUBLE) FROM lineitem
UNION ALL SELECT '(0.05, 1]', count(*) FILTER (l_discount > 0.05::DOUBLE AND l_discount <= 1) FROM lineitem""")
def range_counts(spark, d):
    return ag.range_counts(table(spark, d, "lineitem"), "l_discount", [0, 0.02, 0.05, 1])


@query("box_stats", f"""
WITH q AS (SELECT item, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
 FROM {SERIES} s GROUP BY 1)
SELECT item, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 min(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
 max(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
 count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
FROM {SERIES} s JOIN q USING (item) GROUP BY item, q1, median, q3""")
def box_stats(spark, d):
    return rounded(ag.box_stats(series(spark, d), "value", ["item"]), ["q1", "median", "q3"])


@query("shares", "SELECT c_mktsegment, count(*) AS n, round(count(*) / (SELECT count(*) FROM customer), 6) AS share FROM customer GROUP BY 1")
def shares(spark, d):
    return rounded(ag.shares(table(spark, d, "customer"), "c_mktsegment"), ["share"])


@query("first_label", f"SELECT entity, arg_min(item, t) AS item FROM {SERIES} s GROUP BY 1")
def first_label(spark, d):
    return ag.first_label(series(spark, d), "entity", "t", "item")


@query("minmax_bounds", """
SELECT 'c_acctbal' AS signal, min(c_acctbal) FILTER (c_acctbal >= 0) AS lowest, max(c_acctbal) AS highest FROM customer""")
def minmax_bounds(spark, d):
    return ag.minmax_bounds(table(spark, d, "customer"), ["c_acctbal"])


@query("duration_stats", f"""
SELECT unit, round(avg(h), 6) AS mean_hours, round(stddev_samp(h), 6) AS std_hours, round(avg(h / 24), 6) AS mean_days,
 round(stddev_samp(h / 24), 6) AS std_days, min(h) AS min_hours, max(h) AS max_hours FROM {_HOURS} x GROUP BY 1""")
def duration_stats(spark, d):
    out = ag.duration_stats(epi(spark, d), dt.datetime_diff("outtime", "intime", "SECOND"), ["unit"])
    return rounded(out, ["mean_hours", "std_hours", "mean_days", "std_days"])


@query("class_counts", "SELECT count(*) FILTER (quality = 0) AS n_0, count(*) FILTER (quality = 1) AS n_1, sum(quality) AS flag_sum, count(*) AS n FROM labels")
def class_counts(spark, d):
    return ag.class_counts(table(spark, d, "labels"), "quality")


# --- windows ------------------------------------------------------------------------------------------------------


def _views_errors(spark, d):
    rows = series(spark, d).select("entity", "t", "item")
    return rows.filter("item = 'view'"), rows.filter("item = 'error'")


@query("first_last_times", f"SELECT entity, min(t) AS first_time, max(t) AS last_time FROM {SERIES} s WHERE item IN ('view', 'error') GROUP BY 1")
def first_last_times(spark, d):
    return wn.first_last_times(_views_errors(spark, d), "entity", "t")


@query("edge_rows", f"""
SELECT 'first' AS edge, entity, t, item FROM (SELECT *, dense_rank() OVER (PARTITION BY entity ORDER BY t) AS r FROM {SERIES} s) x WHERE r = 1
UNION ALL
SELECT 'last', entity, t, item FROM (SELECT *, dense_rank() OVER (PARTITION BY entity ORDER BY t DESC) AS r FROM {SERIES} s) x WHERE r = 1""")
def edge_rows(spark, d):
    rows = series(spark, d).select("entity", "t", "item")
    first, last = wn.edge_rows(rows, "entity", "t"), wn.edge_rows(rows, "entity", "t", last=True)
    columns = ["edge", "entity", "t", "item"]
    return first.withColumn("edge", F.lit("first")).select(columns).unionByName(
        last.withColumn("edge", F.lit("last")).select(columns)
    )


_FWD = "last_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY t ROWS UNBOUNDED PRECEDING)"
_BWD = "first_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query("ffill_bfill", "SELECT entity, t, " + ", ".join(f"round(coalesce({_FWD}, {_BWD}), 6) AS {{0}}".format(s) for s in SIGNALS) + f" FROM {WIDE} w")
def ffill_bfill(spark, d):
    return rounded(wn.ffill_bfill(wide(spark, d), "entity", "t", SIGNALS), SIGNALS)


@query("bfill_ffill", "SELECT entity, t, " + ", ".join(f"round(coalesce({_BWD}, {_FWD}), 6) AS {{0}}".format(s) for s in SIGNALS) + f" FROM {WIDE} w")
def bfill_ffill(spark, d):
    return rounded(wn.bfill_ffill(wide(spark, d), "entity", "t", SIGNALS), SIGNALS)


@query("time_gaps", f"""
SELECT entity, round(sum(gap), 5) AS total_hours, round(max(gap), 5) AS longest FROM
 (SELECT entity, coalesce(epoch_us(t - lag(t) OVER (PARTITION BY entity ORDER BY t)) / 3.6e9, 0.0) AS gap FROM {SERIES} s) x GROUP BY 1""")
def time_gaps(spark, d):
    gaps = wn.time_gaps(series(spark, d).select("entity", "t"), "entity", "t")
    return gaps.groupBy("entity").agg(
        F.round(F.sum("gap_hours"), 5).alias("total_hours"), F.round(F.max("gap_hours"), 5).alias("longest")
    )


@query("head_per_group", f"""
SELECT entity, t, item, value FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY t, event_id) AS r FROM {SERIES} s) x WHERE r <= 48""")
def head_per_group(spark, d):
    return wn.head_per_group(series(spark, d), "entity", "t", 48, ["event_id"]).select("entity", "t", "item", "value")


@query("span_broadcast", f"""
SELECT entity, t, round(epoch_us(max(t) OVER (PARTITION BY entity) - min(t) OVER (PARTITION BY entity)) / 1e6, 6) AS span_seconds FROM {SERIES} s""")
def span_broadcast(spark, d):
    return rounded(wn.transform_span(series(spark, d).select("entity", "t"), "entity", "t"), ["span_seconds"])


@query("suffix_share", f"""
SELECT day, round(s / max(s) OVER (), 6) AS value FROM (SELECT day, sum(v) OVER (ORDER BY day DESC) AS s FROM
 (SELECT CAST(t AS DATE) AS day, sum(value) AS v FROM {SERIES} x GROUP BY 1) y) z""")
def suffix_share(spark, d):
    daily = series(spark, d).groupBy(F.col("t").cast("date").alias("day")).agg(F.sum("value").alias("value"))
    return rounded(wn.suffix_share(daily, "day", ["value"]), ["value"])


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, d):
    return table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


@query("distinct_by", f"""
SELECT entity, item, t, value FROM (SELECT *, row_number() OVER (PARTITION BY entity, item ORDER BY t, event_id) AS r FROM {SERIES} s) x WHERE r = 1""")
def distinct_by(spark, d):
    rows = series(spark, d).select("event_id", "entity", "item", "t", "value")
    return wn.distinct_by(rows, ["entity", "item"], ["t", "event_id"]).drop("event_id")


@query("ordered_series", f"SELECT entity, t, item, value FROM {SERIES} s")
def ordered_series(spark, d):
    return wn.order_series(series(spark, d).select("entity", "t", "item", "value"), "entity", "t")


@query("entity_slice", f"SELECT entity, t, item, value FROM {SERIES} s WHERE entity = 7")
def entity_slice(spark, d):
    return wn.entity_slice(series(spark, d).select("entity", "t", "item", "value"), "entity", 7)


@query("union_times", "SELECT o_orderdate AS t FROM orders UNION ALL SELECT l_shipdate FROM lineitem")
def union_times(spark, d):
    a = table(spark, d, "orders").select(F.col("o_orderdate").alias("t"))
    return wn.union_times([a, table(spark, d, "lineitem").select(F.col("l_shipdate").alias("t"))], ["t"])


# --- cohorts ------------------------------------------------------------------------------------------------------


def _stays(spark, d):
    return epi(spark, d).withColumn("los", dt.datetime_diff("outtime", "intime", "DAY"))


_STAYS = f"(SELECT *, epoch_us(outtime - intime) / 1e6 / 86400 AS los FROM {EPI} e)"


@query("cohort_first_episode", f"""
SELECT episode, subject FROM (SELECT *, dense_rank() OVER (PARTITION BY subject ORDER BY intime) AS r FROM {EPI} e) x WHERE r = 1""")
def cohort_first_episode(spark, d):
    return co.first_episode(epi(spark, d), "subject", "intime").select("episode", "subject")


@query("cohort_filters", f"SELECT episode, subject, los FROM {_STAYS} s WHERE unit NOT IN ('P') AND los >= 48 / 24.0 AND los < (48 + 96) / 24.0")
def cohort_filters(spark, d):
    out = co.exclude(_stays(spark, d), "unit", ["P"])
    out = co.max_stay(co.min_stay(out, "los", 48), "los", 48, 96)
    return out.select("episode", "subject", "los")


@query("coverage_min", f"""
SELECT entity FROM (SELECT entity, epoch_us(max(t) - min(t)) / 1e6 AS s FROM {SERIES} x WHERE item IN ('view', 'error') GROUP BY 1) y
WHERE s >= 672 * 3600""")
def coverage_min(spark, d):
    return co.min_coverage(_views_errors(spark, d), "entity", "t", 672)


def _hourly(item):
    return f"(SELECT entity, epoch_us(max(h) - min(h)) / 1e6 AS s FROM (SELECT entity, date_trunc('day', t) AS h FROM {SERIES} x WHERE item = '{item}') y GROUP BY 1)"


@query("coverage_exact", f"""
SELECT 'exact' AS rule, entity FROM {_hourly('view')} a JOIN {_hourly('error')} b USING (entity) WHERE a.s = 28 * 86400 AND b.s = 28 * 86400
UNION ALL
SELECT 'at_least', entity FROM {_hourly('view')} a JOIN {_hourly('error')} b USING (entity) WHERE a.s >= 28 * 86400 AND b.s >= 28 * 86400""")
def coverage_exact(spark, d):
    a, b = (
        x.withColumn("t", F.date_trunc("day", "t").cast("timestamp_ntz")) for x in _views_errors(spark, d)
    )
    exact = co.coverage_in_both(a, b, "entity", "t", 28 * 24).select(F.lit("exact").alias("rule"), "entity")
    more = co.coverage_in_both(a, b, "entity", "t", 28 * 24, exact=False)
    return exact.unionByName(more.select(F.lit("at_least").alias("rule"), "entity"))


def _flow_sql():
    steps = [("all", "true"), ("unit", "unit NOT IN ('P')"), ("long", "los >= 2"), ("short", "los < 6")]
    parts, so_far = [], []
    for i, (name, cond) in enumerate(steps):
        so_far.append(f"({cond})")
        parts.append(
            f"SELECT {i} AS step_no, '{name}' AS step, count(DISTINCT subject) AS subjects, count(DISTINCT episode) AS stays, "
            f"sum(CASE WHEN price > 400000 THEN 1 ELSE 0 END) AS events FROM {_STAYS} s WHERE {' AND '.join(so_far)}"
        )
    return " UNION ALL ".join(parts)


@query("cohort_flow", _flow_sql())
def cohort_flow(spark, d):
    rows = _stays(spark, d).withColumn("costly", (F.col("price") > 400000).cast("int"))
    steps = {
        "all": F.lit(True),
        "unit": ~F.col("unit").isin("P"),
        "long": F.col("los") >= 2,
        "short": F.col("los") < 6,
    }
    return co.cohort_flow(rows, steps, {"subjects": "subject", "stays": "episode"}, "costly")


@query("retention", f"""
SELECT count(DISTINCT episode) AS n_all, count(DISTINCT episode) FILTER (los < 4) AS n_left,
 round(100.0 * count(DISTINCT episode) FILTER (los < 4) / count(DISTINCT episode), 6) AS percent FROM {_STAYS} s""")
def retention(spark, d):
    stays = _stays(spark, d)
    return rounded(co.retention(stays.filter(F.col("los") < 4), stays, "episode"), ["percent"])
