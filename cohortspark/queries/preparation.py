"""Queries: cleaning, pivots, joins and date functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.functions import datetimes as dt
from cohortspark.functions import scalars as sc
from cohortspark.functions.scalars import Bound, Rule
from cohortspark.operators import aggregates as ag
from cohortspark.operators import joins as jn
from cohortspark.operators import windows as wn
from cohortspark.queries.base import (
    CODES, EPI, MEAS, SERIES, SIGNALS, WEEKLY, WIDE, codes, epi, meas, query, r6, rounded, series, table, weekly, wide,
)
from cohortspark.sources.tables import code_table

ITEMS = {"AF": "acid", "AO": "acid", "NF": "base", "NO": "base", "RF": "salt", "RO": "sugar"}
BOUNDS = {"AF": Bound(high=48), "AO": Bound(high=45), "NF": Bound(low=2), "RO": Bound(3, 40, False, True)}
LABELS = {"acid": "acid", "base": "base", "salt": "salt", "sugar": "sugar"}


def _pivoted(spark, d, extra=()):
    rows = sc.filter_items(meas(spark, d, dealt="hadm" in extra), "item", list(ITEMS), "value")
    rows = rows.withColumns({"label": sc.map_items("item", ITEMS), "clean": sc.clip_to_null("item", "value", BOUNDS)})
    return ag.pivot_mean(rows, ["subject", *extra, "t"], "label", "clean", LABELS)


def _pivoted_sql(extra=""):
    label = "CASE WHEN item IN ('AF','AO') THEN 'acid' WHEN item IN ('NF','NO') THEN 'base' " \
            "WHEN item = 'RF' THEN 'salt' WHEN item = 'RO' THEN 'sugar' END"
    clean = "CASE WHEN item = 'AF' AND value > 48 THEN NULL WHEN item = 'AO' AND value > 45 THEN NULL " \
            "WHEN item = 'NF' AND value < 2 THEN NULL WHEN item = 'RO' AND (value <= 3 OR value > 40) THEN NULL " \
            "ELSE value END"
    cells = ", ".join(f"avg(CASE WHEN label = '{x}' THEN clean END) AS {x}" for x in LABELS)
    return f"""(SELECT subject, {extra} t, {cells} FROM (SELECT *, {label} AS label, {clean} AS clean FROM {MEAS} m
 WHERE item IN ('AF','AO','NF','NO','RF','RO') AND value IS NOT NULL AND value > 0) x GROUP BY subject, {extra} t)"""


_R = ", ".join(f"round({x}, 6) AS {x}" for x in LABELS)


@query("pivot_measurements", f"SELECT subject, t, {_R} FROM {_pivoted_sql()} p")
def pivot_measurements(spark, d):
    return rounded(_pivoted(spark, d), list(LABELS))


@query("interval_join_stay", f"""
SELECT p.subject, t, {_R}, episode FROM {_pivoted_sql()} p
LEFT JOIN {EPI} e ON p.subject = e.subject AND t >= intime AND t < outtime""")
def interval_join_stay(spark, d):
    """Measurements averaged per instant, then assigned to the stay they fall in."""
    stays = epi(spark, d).select("episode", "subject", "intime", "outtime")
    out = jn.interval_join(_pivoted(spark, d), stays, "subject", "t", "intime", "outtime")
    return rounded(out, list(LABELS)).drop("intime", "outtime")


_FUZZY = f"""(SELECT episode, subject,
 CASE WHEN prev IS NOT NULL AND prev > intime - INTERVAL 24 HOUR
  THEN intime - CAST(floor(date_diff('second', prev, intime) / 2.0 + 0.5) AS BIGINT) * INTERVAL 1 SECOND
  ELSE intime - INTERVAL 12 HOUR END AS data_start,
 CASE WHEN nxt IS NOT NULL AND nxt < outtime + INTERVAL 24 HOUR
  THEN outtime + CAST(CASE WHEN nxt < outtime THEN -floor(date_diff('second', nxt, outtime) / 2.0 + 0.5)
       ELSE floor(date_diff('second', outtime, nxt) / 2.0 + 0.5) END AS BIGINT) * INTERVAL 1 SECOND
  ELSE outtime + INTERVAL 12 HOUR END AS data_end
 FROM (SELECT *, lag(outtime) OVER w AS prev, lead(intime) OVER w AS nxt FROM {EPI} e
  WINDOW w AS (PARTITION BY subject ORDER BY intime, episode)) x)"""


@query("fuzzy_bounds", f"SELECT episode, subject, data_start, data_end FROM {_FUZZY} f")
def fuzzy_bounds(spark, d):
    stays = epi(spark, d).select("episode", "subject", "intime", "outtime")
    return jn.fuzzy_bounds(stays, "subject", "intime", "outtime", "episode").drop("intime", "outtime")


@query("interval_join_fuzzy", f"""
SELECT p.subject, p.hadm, t, {_R}, episode FROM {_pivoted_sql("hadm,")} p
LEFT JOIN {_FUZZY} e ON p.subject = e.subject AND t >= data_start AND t < data_end""")
def interval_join_fuzzy(spark, d):
    bounds = fuzzy_bounds(spark, d)
    out = jn.interval_join(_pivoted(spark, d, ["hadm"]), bounds, "subject", "t", "data_start", "data_end")
    return rounded(out, list(LABELS)).drop("data_start", "data_end")


_CORE = _FUZZY.replace(EPI, f"(SELECT episode, subject, intime + INTERVAL 1 DAY AS intime, outtime FROM {EPI} c)")


@query("interval_join_fuzzy_twice", f"""
SELECT p.subject, t, {_R}, a.episode AS admission, s.episode AS stay FROM {_pivoted_sql()} p
LEFT JOIN {_FUZZY} a ON p.subject = a.subject AND t >= a.data_start AND t < a.data_end
LEFT JOIN {_CORE} s ON p.subject = s.subject AND t >= s.data_start AND t < s.data_end""")
def interval_join_fuzzy_twice(spark, d):
    """Measurements with their admission and their stay, which begins a day into the admission; both widened."""
    admissions = epi(spark, d).select("episode", "subject", "intime", "outtime")
    stays = admissions.withColumn("intime", F.col("intime") + F.expr("INTERVAL 1 DAY"))
    out = _pivoted(spark, d)
    for intervals, name in ((admissions, "admission"), (stays, "stay")):
        bounds = jn.fuzzy_bounds(intervals, "subject", "intime", "outtime", "episode").drop("intime", "outtime")
        bounds = bounds.withColumnRenamed("episode", name)
        out = jn.interval_join(out, bounds, "subject", "t", "data_start", "data_end").drop("data_start", "data_end")
    return rounded(out, list(LABELS))


@query("pivot_series_median", f"""
SELECT entity, day, round(avg(CASE WHEN item = 'view' AND value > 0 AND value < 300 THEN value END), 6) AS rate,
 round(avg(CASE WHEN item = 'click' AND value > 70 AND value < 120 THEN (value - 32) / 1.8
  WHEN item = 'signup' AND value > 10 AND value < 50 THEN value END), 6) AS temp,
 round(median(CASE text WHEN '10' THEN 1 WHEN '20' THEN 2 WHEN '30' THEN 3 WHEN '40' THEN 4 END), 6) AS appetite
FROM (SELECT *, date_trunc('day', t)::DATE AS day, CASE WHEN text = '7' THEN 1 WHEN text < '5' THEN 0 END AS error
 FROM {SERIES} s) x WHERE (error IS NULL OR error != 1) AND entity IS NOT NULL GROUP BY 1, 2""")
def pivot_series_median(spark, d):
    """Plausible ranges, unit conversion, ordinal texts, error marks, and a median beside the means."""
    rows = series(spark, d).withColumns(
        {
            "day": F.col("t").cast("date"),
            "error": F.when(F.col("text") == "7", 1).when(F.col("text") < "5", 0),
        }
    )
    rows = sc.drop_flagged(rows, "error", "entity")
    view, click, signup = ("view",), ("click",), ("signup",)
    return rows.groupBy("entity", "day").agg(
        r6(F.avg(sc.convert_units("item", "value", [Rule(view, Bound(0, 300, False, False))])), "rate"),
        r6(
            F.avg(
                sc.convert_units(
                    "item",
                    "value",
                    [Rule(click, Bound(70, 120, False, False), 32, 1.8), Rule(signup, Bound(10, 50, False, False))],
                )
            ),
            "temp",
        ),
        r6(ag.median_cont(sc.ordinal_encode("text", ["10", "20", "30", "40"])), "appetite"),
    )


@query("text_result_code", f"""
SELECT event_id, item, round(CASE WHEN item = 'error' THEN CASE WHEN text IN ('1','2','3') THEN 1.0
 WHEN text IN ('4','5','6','7','8','9') THEN 2.0 END ELSE value END, 6) AS value FROM {SERIES} s""")
def text_result_code(spark, d):
    groups = {1: ["1", "2", "3"], 2: ["4", "5", "6", "7", "8", "9"]}
    value = sc.text_to_code("item", "text", "value", "error", groups)
    return series(spark, d).select("event_id", "item", r6(value, "value"))


@query("category_group", """
SELECT c_custkey, CASE WHEN c_mktsegment IN ('MACHINERY','AUTOMOBILE') THEN 'technical'
 WHEN c_mktsegment IN ('FURNITURE','HOUSEHOLD') THEN 'home' ELSE 'other' END AS grouped
FROM customer WHERE c_mktsegment IS NULL OR c_mktsegment NOT IN ('HOUSEHOLD')""")
def category_group(spark, d):
    rows = sc.exclude_categories(table(spark, d, "customer"), "c_mktsegment", ["HOUSEHOLD"])
    groups = {"technical": ["MACHINERY", "AUTOMOBILE"], "home": ["FURNITURE", "HOUSEHOLD"]}
    return rows.select("c_custkey", sc.group_category("c_mktsegment", groups).alias("grouped"))


@query("episode_detail", f"""
SELECT episode, e.subject, c_name, n_name, unit, intime, outtime,
 round(epoch_us(outtime - intime) / 1e6 / 86400.0, 6) AS los_days,
 round(epoch_us(intime - TIMESTAMP '1940-01-01') / 1e6 / (365.242 * 86400.0), 6) AS age_years,
 CAST(dense_rank() OVER (PARTITION BY e.subject ORDER BY intime) AS INTEGER) AS stay_seq,
 dense_rank() OVER (PARTITION BY e.subject ORDER BY intime) = 1 AS first_stay,
 CAST(dense_rank() OVER (PARTITION BY e.subject, unit ORDER BY intime) AS INTEGER) AS unit_seq,
 CASE WHEN intime <= last_ship AND last_ship <= outtime THEN 1 ELSE 0 END AS label_event,
 CASE WHEN intime <= last_ship AND last_ship <= outtime THEN last_ship END AS event_time
FROM {EPI} e JOIN customer ON e.subject = c_custkey JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) l ON episode = l_orderkey
WHERE price > 1000""")
def episode_detail(spark, d):
    """Stays with their subject, length, age, sequence numbers and in-stay event label."""
    from cohortspark.operators.grouped import number_rows

    subjects = table(spark, d, "customer").select(F.col("c_custkey").alias("subject"), "c_name", "c_nationkey")
    nations = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    events = (
        table(spark, d, "lineitem")
        .groupBy(F.col("l_orderkey").alias("episode"))
        .agg(F.max("l_shipdate").alias("last_ship"))
    )
    rows = jn.star_join(epi(spark, d).filter(F.col("price") > 1000), subjects, nations, "subject", "c_nationkey")
    rows = rows.join(events, "episode", "left")
    rows = wn.sequence_episodes(rows, "subject", "intime", "stay_seq", "first_stay")
    rows = number_rows(rows, ["subject", "unit"], "intime", "unit_seq", method="dense_rank")
    flag, when = sc.event_in_interval("last_ship", "intime", "outtime")
    birth = F.lit("1940-01-01 00:00:00").cast("timestamp_ntz")
    return rows.select(
        "episode", "subject", "c_name", "n_name", "unit", "intime", "outtime",
        r6(dt.datetime_diff("outtime", "intime", "DAY"), "los_days"),
        r6(dt.datetime_diff(F.col("intime"), birth, "YEAR"), "age_years"),
        "stay_seq", "first_stay", F.col("unit_seq").cast("int").alias("unit_seq"),
        flag.alias("label_event"), when.alias("event_time"),
    )


SETS = {"promo": ["PROMO"], "small": ["SMALL", "MEDIUM"], "economy": ["ECONOMY"]}


@query("code_flags_exists", f"""
SELECT episode, CASE WHEN EXISTS (SELECT 1 FROM {CODES} c WHERE c.hadm = episode AND code IN ('PROMO')) THEN 1 ELSE 0 END AS promo,
 CASE WHEN EXISTS (SELECT 1 FROM {CODES} c WHERE c.hadm = episode AND code IN ('SMALL','MEDIUM')) THEN 1 ELSE 0 END AS small,
 CASE WHEN EXISTS (SELECT 1 FROM {CODES} c WHERE c.hadm = episode AND code IN ('ECONOMY')) THEN 1 ELSE 0 END AS economy
FROM {EPI} e""")
def code_flags_exists(spark, d):
    found = codes(spark, d).withColumnRenamed("hadm", "episode")
    return jn.flag_codes(epi(spark, d).select("episode"), found, "episode", "code", SETS)


@query("code_flags_boolean", f"""
SELECT episode, EXISTS (SELECT 1 FROM {CODES} c WHERE c.hadm = episode AND code IN ('PROMO')) AS promo FROM {EPI} e""")
def code_flags_boolean(spark, d):
    found = codes(spark, d).withColumnRenamed("hadm", "episode")
    return jn.flag_codes(epi(spark, d).select("episode"), found, "episode", "code", {"promo": ["PROMO"]}, as_int=False)


@query("code_flag_max", f"""
SELECT episode, m.flag FROM {EPI} e LEFT JOIN
 (SELECT hadm, max(CASE WHEN code IN ('PROMO', 'LARGE') THEN 1 ELSE 0 END) AS flag FROM {CODES} c GROUP BY 1) m
 ON hadm = episode""")
def code_flag_max(spark, d):
    found = codes(spark, d).withColumnRenamed("hadm", "episode")
    return jn.flag_by_max(epi(spark, d).select("episode"), found, "episode", "code", ["PROMO", "LARGE"], "flag")


@query("update_from_join", f"""
SELECT t.hadm, t.line, u.brand FROM {MEAS} t LEFT JOIN
 (SELECT hadm, min(brand) AS brand FROM {CODES} c GROUP BY 1) u USING (hadm)""")
def update_from_join(spark, d):
    """Column added from a table with repeated keys; rows do not multiply."""
    return jn.update_from(meas(spark, d).select("hadm", "line"), codes(spark, d), "hadm", ["brand"])


@query("code_table_join", f"""
SELECT kind, count(*) AS n FROM {CODES} c JOIN (VALUES ('PROMO', 'offer'), ('SMALL', 'size'), ('MEDIUM', 'size'),
 ('LARGE', 'size')) k(code, kind) USING (code) GROUP BY 1""")
def code_table_join(spark, d):
    rows = [("PROMO", "offer"), ("SMALL", "size"), ("MEDIUM", "size"), ("LARGE", "size")]
    kinds = F.broadcast(code_table(spark, rows, "code string, kind string"))
    return codes(spark, d).join(kinds, "code").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("semi_join_ids", f"""
SELECT hadm, line, t, value FROM {MEAS} m WHERE hadm IN
 (SELECT episode FROM {EPI} e WHERE epoch_us(outtime - intime) / 1e6 / 86400.0 >= 4)""")
def semi_join_ids(spark, d):
    long = epi(spark, d).filter(dt.datetime_diff("outtime", "intime", "DAY") >= 4)
    return jn.keep_ids(
        meas(spark, d).select("hadm", "line", "t", "value"), long.select(F.col("episode").alias("hadm")), "hadm"
    )


@query("restrict_ids_keep_missing", f"""
SELECT DISTINCT i.hadm, m.item FROM (SELECT DISTINCT episode AS hadm FROM {EPI} e WHERE unit = 'F') i
LEFT JOIN {MEAS} m ON m.hadm = i.hadm""")
def restrict_ids_keep_missing(spark, d):
    ids = epi(spark, d).filter(F.col("unit") == "F").select(F.col("episode").alias("hadm"))
    return jn.restrict_to_ids(meas(spark, d).select("hadm", "item"), ids, "hadm")


@query("intersect_ids", f"""
SELECT DISTINCT hadm FROM {CODES} c WHERE code = 'PROMO' INTERSECT SELECT hadm FROM {CODES} c WHERE code = 'LARGE'""")
def intersect_ids(spark, d):
    c = codes(spark, d)
    return jn.intersect_ids(c.filter(F.col("code") == "PROMO"), c.filter(F.col("code") == "LARGE"), "hadm")


@query("except_ids", "SELECT o_orderkey AS hadm FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def except_ids(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("hadm"))
    return jn.except_ids(orders, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("hadm")), "hadm")


@query("union_ids", "SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT user_id FROM events")
def union_ids(spark, d):
    return jn.union_ids(
        [
            table(spark, d, "orders").select(F.col("o_custkey").alias("id")),
            table(spark, d, "customer").select(F.col("c_custkey").alias("id")),
            table(spark, d, "events").select(F.col("user_id").alias("id")),
        ],
        "id",
    )


@query("id_set_report", """
WITH a AS (SELECT DISTINCT o_custkey AS id FROM orders), b AS (SELECT DISTINCT c_custkey AS id FROM customer),
 c AS (SELECT DISTINCT user_id AS id FROM events)
SELECT 'orders' AS present_in, 'customer' AS missing_from, id FROM a WHERE id NOT IN (SELECT id FROM b)
UNION ALL SELECT 'orders', 'events', id FROM a WHERE id NOT IN (SELECT id FROM c)
UNION ALL SELECT 'customer', 'orders', id FROM b WHERE id NOT IN (SELECT id FROM a)
UNION ALL SELECT 'customer', 'events', id FROM b WHERE id NOT IN (SELECT id FROM c)
UNION ALL SELECT 'events', 'orders', id FROM c WHERE id NOT IN (SELECT id FROM a)
UNION ALL SELECT 'events', 'customer', id FROM c WHERE id NOT IN (SELECT id FROM b)""")
def id_set_report(spark, d):
    frames = {
        "orders": table(spark, d, "orders").select(F.col("o_custkey").alias("id")),
        "customer": table(spark, d, "customer").select(F.col("c_custkey").alias("id")),
        "events": table(spark, d, "events").select(F.col("user_id").alias("id")),
    }
    return jn.missing_ids(frames, "id")


def _two_sources(spark, d):
    rows = series(spark, d)
    a = ag.pivot_mean(rows.filter(F.col("item").isin("view", "click")), ["entity", "t"], "item", "value",
                      {"view": "view", "click": "click"})
    b = ag.pivot_mean(rows.filter(F.col("item").isin("purchase", "error")), ["entity", "t"], "item", "value",
                      {"purchase": "purchase", "error": "error"})
    return a, b


_A = "(SELECT entity, t, avg(CASE WHEN item='view' THEN value END) AS view, avg(CASE WHEN item='click' THEN value END) AS click " \
     f"FROM {SERIES} s WHERE item IN ('view','click') GROUP BY 1, 2)"
_B = "(SELECT entity, t, avg(CASE WHEN item='purchase' THEN value END) AS purchase, avg(CASE WHEN item='error' THEN value END) AS error " \
     f"FROM {SERIES} s WHERE item IN ('purchase','error') GROUP BY 1, 2)"


@query("align_timelines", f"""
WITH a AS {_A}, b AS {_B}, k AS (SELECT entity, t FROM a UNION SELECT entity, t FROM b)
SELECT 'a' AS source, entity, t, round(view, 6) AS v1, round(click, 6) AS v2 FROM k LEFT JOIN a USING (entity, t)
UNION ALL SELECT 'b', entity, t, round(purchase, 6), round(error, 6) FROM k LEFT JOIN b USING (entity, t)""")
def align_timelines(spark, d):
    a, b = jn.align_timelines(*_two_sources(spark, d), ["entity", "t"])
    left = a.select(F.lit("a").alias("source"), "entity", "t", r6("view", "v1"), r6("click", "v2"))
    return left.unionByName(b.select(F.lit("b").alias("source"), "entity", "t", r6("purchase", "v1"), r6("error", "v2")))


@query("outer_merge_series", f"""
WITH a AS (SELECT entity, t, item, value FROM {SERIES} s WHERE item = 'view'),
 b AS (SELECT entity, t, item, value FROM {SERIES} s WHERE item = 'click')
SELECT entity, t, a.item AS item_x, b.item AS item_y, a.value AS value_x, b.value AS value_y
FROM a FULL JOIN b USING (entity, t)""")
def outer_merge_series(spark, d):
    rows = series(spark, d).select("entity", "t", "item", "value")
    return jn.outer_merge(rows.filter("item = 'view'"), rows.filter("item = 'click'"), ["entity", "t"])


@query("map_lookup", f"SELECT hadm, line, o_orderpriority AS priority FROM {MEAS} m JOIN orders ON hadm = o_orderkey")
def map_lookup(spark, d):
    dim = table(spark, d, "orders").select(F.col("o_orderkey").alias("hadm"), "o_orderpriority")
    return jn.lookup(meas(spark, d).select("hadm", "line"), dim, "hadm", "o_orderpriority", "priority")


@query("feature_merge", """
SELECT c_custkey, n_orders, round(mean_price, 6) AS mean_price, n_lines, c_mktsegment FROM
 (SELECT o_custkey AS c_custkey, count(*) AS n_orders, avg(o_totalprice) AS mean_price FROM orders GROUP BY 1) a
 JOIN (SELECT o_custkey AS c_custkey, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) b
 USING (c_custkey) JOIN (SELECT c_custkey, c_mktsegment FROM customer) c USING (c_custkey)""")
def feature_merge(spark, d):
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), r6(F.avg("o_totalprice"), "mean_price")
    )
    lines = meas(spark, d).groupBy(F.col("subject").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    segments = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return jn.merge_features([orders, lines, segments], "c_custkey")


@query("attach_label", f"""
SELECT i.entity, s.t, s.value, i.late FROM
 (SELECT c_custkey AS entity, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS late FROM customer) i
LEFT JOIN {SERIES} s ON s.entity = i.entity""")
def attach_label(spark, d):
    labels = table(spark, d, "customer").select(
        F.col("c_custkey").alias("entity"), (F.col("c_acctbal") < 0).cast("int").alias("late")
    )
    return jn.attach_label(series(spark, d).select("entity", "t", "value"), labels, "entity", ["late"])


@query("datetime_functions", """
SELECT event_id, epoch_us(ts - TIMESTAMP '2024-01-01') / 1e6 AS secs,
 epoch_us(ts - TIMESTAMP '2024-01-01') / 1e6 / 60 AS mins,
 epoch_us(ts - TIMESTAMP '2024-01-01') / 1e6 / 3600 AS hours,
 epoch_us(ts - TIMESTAMP '2024-01-01') / 1e6 / 86400 AS days,
 epoch_us(ts - TIMESTAMP '2024-01-01') / 1e6 / (CAST(365.242 AS DOUBLE) * 24 * 3600) AS years,
 ts + INTERVAL 12 HOUR AS plus_12h, ts - INTERVAL 90 SECOND AS minus_90s, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS midnight,
 make_timestamp(year(ts), month(ts), day(ts), hour(ts), minute(ts), floor(second(ts))) AS rebuilt
FROM events""")
def datetime_functions(spark, d):
    ts, start = F.col("ts"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    diffs = {"secs": "SECOND", "mins": "MINUTE", "hours": "HOUR", "days": "DAY", "years": "YEAR"}
    parts = [f(ts) for f in (F.year, F.month, F.dayofmonth, F.hour, F.minute, F.second)]
    return table(spark, d, "events").select(
        "event_id",
        *[dt.datetime_diff(ts, start, unit).alias(name) for name, unit in diffs.items()],
        dt.datetime_add("ts", 12, "HOUR").alias("plus_12h"),
        dt.datetime_sub("ts", 90).alias("minus_90s"),
        dt.datetime(ts.cast("date")).alias("midnight"),
        dt.datetime(*parts).alias("rebuilt"),
    )


@query("format_parse", """
SELECT event_id, strftime(ts, '%Y/%m/%d %H-%M-%S') AS stamp, strftime(ts, '%Y%m%d') AS day_text,
 CAST(ts AS DATE) AS day, date_trunc('second', ts) AS parsed FROM events""")
def format_parse(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        dt.format_datetime("%Y/%m/%d %H-%M-%S", "ts").alias("stamp"),
        dt.format_date("%Y%m%d", "ts").alias("day_text"),
    )
    return rows.select(
        "*",
        dt.parse_date("%Y%m%d", "day_text").alias("day"),
        dt.parse_datetime("%Y/%m/%d %H-%M-%S", "stamp").alias("parsed"),
    )


@query("regex_functions", """
SELECT page_id, CASE WHEN regexp_matches(url, 'page=[0-9]+') THEN regexp_extract(url, 'page=([0-9]+)', 1) END AS page_no,
 CASE WHEN regexp_matches(url, 'https?://[a-z0-9.]+') THEN regexp_extract(url, 'https?://[a-z0-9.]+') END AS site,
 regexp_matches(url, '/(en|de)/') AS en_de FROM pages""")
def regex_functions(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        dt.regexp_extract_or_null("url", "page=([0-9]+)").alias("page_no"),
        dt.regexp_extract_or_null("url", "https?://[a-z0-9.]+").alias("site"),
        dt.regexp_contains("url", "/(en|de)/").alias("en_de"),
    )


@query("generate_array", f"""
SELECT episode, unnest(generate_series(1, CAST(1 + episode % 9 AS INTEGER))) AS day_no FROM {EPI} e""")
def generate_array(spark, d):
    days = (1 + F.col("episode") % 9).cast("int")
    rows = epi(spark, d).select("episode", dt.generate_array(1, days).alias("day_no"))
    return rows.withColumn("day_no", F.col("day_no").cast("bigint"))


@query("age_bins", """
SELECT p_partkey, CASE WHEN p_size >= 0 AND p_size < 9 THEN '0-9' WHEN p_size >= 9 AND p_size < 19 THEN '10-19'
 WHEN p_size >= 19 AND p_size < 29 THEN '20-29' WHEN p_size >= 29 AND p_size < 39 THEN '30-39' END AS age_group FROM part""")
def age_bins(spark, d):
    group = sc.bin_column("p_size", [0, 9, 19, 29, 39], ["0-9", "10-19", "20-29", "30-39"], right=False)
    return table(spark, d, "part").select("p_partkey", group.alias("age_group"))


@query("los_bins", f"""
SELECT bin, count(*) AS n FROM (SELECT CASE WHEN h > 24 AND h <= 48 THEN '24-48' WHEN h > 48 AND h <= 72 THEN '48-72'
 WHEN h > 72 AND h <= 120 THEN '72-120' END AS bin FROM (SELECT epoch_us(outtime - intime) / 3.6e9 AS h FROM {EPI} e) x) y
GROUP BY 1""")
def los_bins(spark, d):
    hours = dt.datetime_diff("outtime", "intime", "HOUR")
    rows = epi(spark, d).select(sc.bin_column(hours, [24, 48, 72, 120], ["24-48", "48-72", "72-120"]).alias("bin"))
    return rows.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


ROUND_SQL = "make_timestamp(CAST(round_even(epoch_us({0}) / 3.6e9, 0) AS BIGINT) * 3600000000)"


@query("round_hour", f"""
SELECT event_id, {ROUND_SQL.format("ts")} AS hour,
 {ROUND_SQL.format("date_trunc('hour', ts) + INTERVAL 30 MINUTE")} AS tie FROM events""")
def round_hour(spark, d):
    """Nearest hour of every event, and of the exact half hour after its full hour (a tie)."""
    half = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    return table(spark, d, "events").select(
        "event_id", sc.round_hour("ts").alias("hour"), sc.round_hour(half).alias("tie")
    )


@query("concat_label", "SELECT c_custkey, CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS VARCHAR) || c_mktsegment AS flag_segment FROM customer")
def concat_label(spark, d):
    flag = (F.col("c_acctbal") < 0).cast("int")
    return table(spark, d, "customer").select("c_custkey", sc.concat_label(flag, "c_mktsegment").alias("flag_segment"))


@query("sentinel_roundtrip", f"""
SELECT entity, t, coalesce(view, -1) AS marked, nullif(coalesce(view, -1), -1) AS back FROM {WIDE} w""")
def sentinel_roundtrip(spark, d):
    marked = wide(spark, d).select("entity", "t", sc.null_to_sentinel("view").alias("marked"))
    return marked.withColumn("back", sc.sentinel_to_null("marked"))


@query("sparse_columns", f"SELECT entity, t, click, error FROM {WIDE.replace('value END) AS \"view\"', 'NULL END) AS \"view\"')} w")
def sparse_columns(spark, d):
    """A signal that is almost never recorded is dropped."""
    rows = sc.select_signals(wide(spark, d), ["entity", "t"], ["view", "click", "error"])
    return sc.drop_sparse_columns(rows.withColumn("view", F.when(F.col("view") < 0, F.col("view"))), 0.9)


@query("generated_weeks", f"SELECT entity, week, intime, outtime FROM {WEEKLY} w")
def generated_weeks(spark, d):
    return weekly(spark, d)
