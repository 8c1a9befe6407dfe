"""Queries: regular series, observation windows, panels and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.functions.scalars import round_hour
from cohortspark.operators import labels as lb
from cohortspark.operators import timeseries as ts
from cohortspark.operators.windows import suffix_share
from cohortspark.queries.base import EPI, SERIES, SIGNALS, WIDE, epi, query, r6, rounded, series, wide
from cohortspark.queries.preparation import ROUND_SQL


def _rounded_wide(spark, d):
    return wide(spark, d).withColumn("t", round_hour("t"))


_HOURLY = f"(SELECT entity, {ROUND_SQL.format('t')} AS t, {', '.join(SIGNALS)} FROM {WIDE} w)"


def _grid_sql(step: int, origin: str = "start") -> str:
    """Entity grid with the median per step; steps without rows are null."""
    medians = ", ".join(f"median({s}) AS {s}" for s in SIGNALS)
    if origin == "start":
        edge, step_no, first, last = "min(t)", "floor", "0", "max(b)"
    else:
        edge, step_no, first, last = "max(t)", "ceil", "min(b)", "0"
    return f"""(WITH x AS {_HOURLY}, o AS (SELECT entity, {edge} AS o FROM x GROUP BY 1),
 m AS (SELECT entity, CAST({step_no}(epoch_us(t - o) / ({step} * 3.6e9)) AS BIGINT) AS b, {medians}
  FROM x JOIN o USING (entity) GROUP BY 1, 2),
 g AS (SELECT entity, unnest(generate_series(lo, hi)) AS b FROM
  (SELECT entity, CAST({first} AS BIGINT) AS lo, CAST({last} AS BIGINT) AS hi FROM m GROUP BY entity) y)
 SELECT entity, o + b * INTERVAL {step} HOUR AS t, {', '.join(SIGNALS)}
 FROM g LEFT JOIN m USING (entity, b) JOIN o USING (entity))"""


_FILLED = "coalesce(last_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY t ROWS UNBOUNDED PRECEDING), " \
          "first_value({0} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), {1})"
_ROUNDED = ", ".join(f"round({s}, 6) AS {s}" for s in SIGNALS)


@query("resample_1h", f"SELECT entity, t, {_ROUNDED} FROM {_grid_sql(1)} g")
def resample_1h(spark, d):
    return rounded(ts.resample(_rounded_wide(spark, d), "entity", "t", 1, SIGNALS), SIGNALS)


@query("resample_8h", f"SELECT entity, t, {_ROUNDED} FROM {_grid_sql(8)} g")
def resample_8h(spark, d):
    return rounded(ts.resample(_rounded_wide(spark, d), "entity", "t", 8, SIGNALS), SIGNALS)


@query("resample_end", f"SELECT entity, t, {_ROUNDED} FROM {_grid_sql(8, 'end')} g")
def resample_end(spark, d):
    return rounded(ts.resample(_rounded_wide(spark, d), "entity", "t", 8, SIGNALS, origin="end"), SIGNALS)


@query("resample_fill", f"SELECT entity, t, {', '.join(f'round({_FILLED.format(s, -1)}, 6) AS {s}' for s in SIGNALS)} FROM {_grid_sql(8)} g")
def resample_fill(spark, d):
    """Grid, median, forward and backward fill, then the sentinel."""
    return rounded(ts.resample_filled(_rounded_wide(spark, d), "entity", "t", 8, SIGNALS), SIGNALS)


_GAPPY = "(SELECT entity, t, " + ", ".join(
    f"CASE WHEN entity % 7 = {i} THEN NULL ELSE {s} END AS {s}" for i, s in enumerate(SIGNALS)) + f" FROM {_HOURLY} h)"


@query("resample_fill_median", "WITH g AS (SELECT * FROM " + _grid_sql(8).replace(_HOURLY, _GAPPY) + " q) SELECT entity, t, "
       + ", ".join(f"round({_FILLED.format(s, f'(SELECT median({s}) FROM g)')}, 6) AS {s}" for s in SIGNALS) + " FROM g")
def resample_fill_median(spark, d):
    """As above; a signal an entity never has is filled with its overall median."""
    rows = _rounded_wide(spark, d).withColumns(
        {s: F.when(F.col("entity") % 7 != i, F.col(s)) for i, s in enumerate(SIGNALS)}
    )
    return rounded(ts.resample_filled(rows, "entity", "t", 8, SIGNALS, rest="median"), SIGNALS)


def _series_stays(spark, d):
    return series(spark, d).groupBy("entity").agg(F.min("t").alias("intime"), F.max("t").alias("outtime"))


_STAYS = f"(SELECT entity, min(t) AS intime, max(t) AS outtime FROM {SERIES} s GROUP BY 1)"


@query("observation_window", f"""
SELECT s.entity, t, value, intime + INTERVAL 96 HOUR AS predtime,
 floor(epoch_us(outtime - (intime + INTERVAL 96 HOUR)) / 1e6) AS delta_t_pred
FROM {SERIES} s JOIN {_STAYS} e ON s.entity = e.entity WHERE t < intime + INTERVAL 96 HOUR""")
def observation_window(spark, d):
    rows = series(spark, d).select("entity", "t", "value")
    return ts.observation_window(rows, _series_stays(spark, d), "entity", "t", "intime", 96, "outtime")


@query("horizon", f"""
SELECT episode, intime + INTERVAL 48 HOUR AS predtime, floor(epoch_us(outtime - (intime + INTERVAL 48 HOUR)) / 1e6) AS delta_t_pred
FROM {EPI} e""")
def horizon(spark, d):
    return ts.prediction_time(epi(spark, d), "intime", 48, "outtime").select("episode", "predtime", "delta_t_pred")


@query("restrict_observed", f"""
SELECT entity, intime FROM {_STAYS} e WHERE entity IN (SELECT entity FROM {SERIES} s WHERE value > 250 AND item = 'view')
 OR entity IN (SELECT entity FROM {SERIES} s WHERE value > 250 AND item = 'error')""")
def restrict_observed(spark, d):
    high = series(spark, d).filter(F.col("value") > 250)
    sources = [high.filter("item = 'view'"), high.filter("item = 'error'")]
    return ts.restrict_observed(_series_stays(spark, d), sources, "entity").select("entity", "intime")


def _fixed_sql(n, step):
    cols = ", ".join(SIGNALS)
    nulls = ", ".join(f"NULL AS {s}" for s in SIGNALS)
    return f"""(WITH w AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY t) AS r,
  count(*) OVER (PARTITION BY entity) AS n, max(t) OVER (PARTITION BY entity) AS last FROM {WIDE} x)
 SELECT entity, t, {cols} FROM w WHERE r <= {n}
 UNION ALL SELECT entity, last + i * INTERVAL {step} HOUR, {nulls} FROM
 (SELECT DISTINCT entity, n, last FROM w) y, (SELECT unnest(generate_series(1, {n})) AS i) k WHERE i <= {n} - n)"""


@query("fix_length_series", f"SELECT entity, t, {', '.join(f'round({s}, 6) AS {s}' for s in SIGNALS)} FROM {_fixed_sql(64, 8)} f")
def fix_length_series(spark, d):
    return rounded(ts.fix_length(wide(spark, d), "entity", "t", 8, 64, SIGNALS), SIGNALS)


def _panel(spark, d):
    """Panels of whole series; the longest sets the number of steps."""
    return ts.to_panel(ts.fix_length(wide(spark, d), "entity", "t", 8, None, SIGNALS), "entity", "t", SIGNALS)


def _cells(panels):
    """A panel as rows (entity, channel, step, value)."""
    channels = panels.select("entity", F.posexplode("panel").alias("channel", "_c"))
    return channels.select("entity", "channel", F.posexplode("_c").alias("step", "value")).withColumn(
        "value", F.round("value", 6)
    )


_LONGEST = f"(SELECT max(n) FROM (SELECT count(*) AS n FROM {WIDE} w GROUP BY entity) l)"
_CELLS = f"WITH f AS MATERIALIZED {_fixed_sql(_LONGEST, 8)}, c AS (" + " UNION ALL ".join(
    f"SELECT entity, {i} AS channel, row_number() OVER (PARTITION BY entity ORDER BY t) - 1 AS step, round({s}, 6) AS value FROM f"
    for i, s in enumerate(SIGNALS)) + ")"


@query("panel_arrays", f"{_CELLS} SELECT entity, channel, step, value FROM c")
def panel_arrays(spark, d):
    return _cells(_panel(spark, d))


@query("pad_panel", f"{_CELLS} SELECT entity, channel, step, value FROM c WHERE step < 48")
def pad_panel(spark, d):
    """Panels of whole series cut to the 48 steps of an observation window."""
    return _cells(_panel(spark, d).withColumn("panel", ts.pad_panel("panel", 48)))


@query("pad_panel_longer", f"""
{_CELLS} SELECT entity, channel, k.step, CASE WHEN k.step < {_LONGEST} THEN value ELSE 0.0 END AS value
FROM (SELECT DISTINCT entity, channel FROM c) e CROSS JOIN (SELECT unnest(generate_series(0, 127)) AS step) k
LEFT JOIN c USING (entity, channel, step)""")
def pad_panel_longer(spark, d):
    """Panels of whole series padded with zeros to 128 steps."""
    return _cells(_panel(spark, d).withColumn("panel", ts.pad_panel("panel", 128)))


@query("flatten_panel", f"{_CELLS} SELECT entity, channel * {_LONGEST} + step AS position, value FROM c")
def flatten_panel(spark, d):
    flat = _panel(spark, d).select("entity", ts.flatten_panel("panel").alias("flat"))
    again = flat.withColumn("flat", ts.flatten_panel(ts.unflatten_panel("flat", len(SIGNALS))))
    return again.select("entity", F.posexplode("flat").alias("position", "value")).withColumn("value", F.round("value", 6))


_STEPS = f"(SELECT entity, t, value, row_number() OVER (PARTITION BY entity ORDER BY t) - 1 AS step FROM {SERIES} x)"


@query("pad_ragged", f"""
WITH s AS {_STEPS}, k AS (SELECT unnest(generate_series(0, (SELECT max(step) FROM s))) AS step)
SELECT e.entity, k.step, coalesce(s.value, -2) AS value FROM (SELECT DISTINCT entity FROM s) e CROSS JOIN k
LEFT JOIN s ON s.entity = e.entity AND s.step = k.step""")
def pad_ragged(spark, d):
    """Whole series of different lengths, masked to the longest."""
    panels = ts.to_panel(series(spark, d), "entity", "t", ["value"])
    padded = ts.pad_ragged(panels, "panel")
    return padded.select("entity", F.posexplode(F.element_at("panel", 1)).alias("step", "value"))


_RAGGED = f"""s AS {_STEPS}, n AS (SELECT entity, entity % 4 AS client, count(*) AS n FROM s GROUP BY 1, 2),
 b AS (SELECT *, (row_number() OVER (PARTITION BY client ORDER BY n, entity) - 1) // 16 AS batch FROM n),
 m AS (SELECT *, max(n) OVER (PARTITION BY client, batch) AS longest FROM b)"""


def _ragged(spark, d):
    panels = ts.to_panel(series(spark, d), "entity", "t", ["value"])
    return ts.ragged_batches(panels.withColumn("client", F.col("entity") % 4), "client", "entity", "panel", 16)


@query("ragged_batches", f"""
WITH {_RAGGED} SELECT m.client, m.batch, m.entity, k.step, coalesce(s.value, -2) AS value
FROM m CROSS JOIN (SELECT unnest(generate_series(0, (SELECT max(n) FROM n))) AS step) k
LEFT JOIN s ON s.entity = m.entity AND s.step = k.step WHERE k.step < m.longest""")
def ragged_batches(spark, d):
    """Batches of 16 series of similar length per client, masked to the longest of the batch."""
    return _ragged(spark, d).select(
        "client", "batch", "entity", F.posexplode(F.element_at("panel", 1)).alias("step", "value")
    )


@query("ragged_padding", f"""
WITH {_RAGGED} SELECT client, batch, count(*) AS series, sum(n) AS steps, max(longest) * count(*) AS cells,
 round(1 - sum(n) / (max(longest) * count(*)), 6) AS padding FROM m GROUP BY 1, 2""")
def ragged_padding(spark, d):
    """Share of mask values per batch."""
    return rounded(ts.padding_share(_ragged(spark, d), ["client", "batch"], "panel", "length"), ["padding"])


@query("series_quality", f"""
SELECT count(*) FILTER (n < 64) AS fewer, count(*) FILTER (n = 64) AS exact, count(*) FILTER (n > 64) AS more,
 count(*) FILTER (days > 28) AS long_span, count(*) FILTER (dup > 0) AS with_duplicates, sum(dup) AS duplicate_rows,
 count(DISTINCT n) AS distinct_lengths FROM
 (SELECT entity, count(*) AS n, floor(epoch_us(max(t) - min(t)) / 8.64e10) AS days,
  count(*) - count(DISTINCT (t, item)) AS dup FROM
  (SELECT entity, date_trunc('day', t) AS t, item FROM {SERIES} s) x GROUP BY 1) y""")
def series_quality(spark, d):
    days = series(spark, d).select("entity", F.date_trunc("day", "t").cast("timestamp_ntz").alias("t"), "item")
    return ts.series_quality(days, "entity", "t", 64, 28)


# --- labels -------------------------------------------------------------------------------------------------------

_LABELLED = f"""(SELECT episode, CASE WHEN price > 200000 THEN 1 ELSE 0 END AS positive,
 epoch_us(outtime - (intime + INTERVAL 48 HOUR)) / 1e6 - (episode % 7200) AS secs FROM {EPI} e)"""


def _labelled(spark, d):
    rows = ts.prediction_time(epi(spark, d), "intime", 48, "outtime")
    return rows.select(
        "episode",
        (F.col("price") > 200000).cast("int").alias("positive"),
        (F.col("delta_t_pred") - F.col("episode") % 7200).alias("secs"),
    )


@query("label_continuous", f"""
SELECT episode, round(CASE WHEN positive = 1 THEN
 greatest(0.55 * exp(-0.66 * floor(secs / 3600)) + 0.45 * (1 - floor(secs / 3600) / 48.0), 0) ELSE 0 END, 6) AS label
FROM {_LABELLED} x""")
def label_continuous(spark, d):
    return _labelled(spark, d).select("episode", r6(lb.label_continuous("secs", "positive"), "label"))


_COEF = [0.0000004, -0.00009, 0.002, -0.05, 0.9]


@query("label_poly", f"""
SELECT episode, round(CASE WHEN positive = 1 THEN greatest(0.0000004::DOUBLE * h ** 4 - 0.00009::DOUBLE * h ** 3
 + 0.002::DOUBLE * h ** 2 - 0.05::DOUBLE * h + 0.9::DOUBLE, 0) ELSE 0 END, 6) AS label
FROM (SELECT *, CAST(floor(secs / 3600) AS DOUBLE) AS h FROM {_LABELLED} x) y""")
def label_poly(spark, d):
    return _labelled(spark, d).select("episode", r6(lb.label_poly("secs", "positive", _COEF), "label"))


@query("label_bins", """
SELECT bin, equal_bin, count(*) AS n FROM (SELECT
 CASE WHEN y > 0 AND y <= 0.125 THEN 0 WHEN y > 0.125 AND y <= 0.375 THEN 1 WHEN y > 0.375 AND y <= 0.625 THEN 2
  WHEN y > 0.625 AND y <= 0.875 THEN 3 WHEN y > 0.875 AND y <= 1 THEN 4 ELSE 0 END AS bin,
 least(floor(y * 5), 4) AS equal_bin FROM (SELECT (l_quantity - 1) / 48.0 AS y FROM lineitem) x) z GROUP BY 1, 2""")
def label_bins(spark, d):
    from cohortspark.queries.base import table

    y = table(spark, d, "lineitem").select(((F.col("l_quantity") - 1) / 48.0).alias("y"))
    bins = y.select(lb.assign_bin("y", 5).alias("bin"), lb.equal_bin("y", 5).alias("equal_bin"))
    return bins.groupBy("bin", "equal_bin").agg(F.count(F.lit(1)).alias("n"))


@query("curve_error", f"""
WITH h AS (SELECT CAST(hour(t) AS BIGINT) AS hour, sum(CASE WHEN item = 'view' THEN value END) AS a,
  sum(CASE WHEN item = 'click' THEN value END) AS b FROM {SERIES} s GROUP BY 1),
 c AS (SELECT hour, sum(a) OVER (ORDER BY hour DESC) AS a, sum(b) OVER (ORDER BY hour DESC) AS b FROM h),
 n AS (SELECT hour, a / (SELECT max(a) FROM c) AS a, b / (SELECT max(b) FROM c) AS b FROM c)
SELECT round(avg(abs((a + b) / 2 - (0.97::DOUBLE * exp(-0.66::DOUBLE * hour) + 0.03::DOUBLE))), 6) AS mean_abs_error FROM n""")
def curve_error(spark, d):
    """Hourly totals summed from the end, normalised, against an exponential curve."""
    rows = series(spark, d).groupBy(F.hour("t").cast("bigint").alias("hour")).agg(
        F.sum(F.when(F.col("item") == "view", F.col("value"))).alias("a"),
        F.sum(F.when(F.col("item") == "click", F.col("value"))).alias("b"),
    )
    shares = suffix_share(rows, "hour", ["a", "b"])
    curve = 0.97 * F.exp(-0.66 * F.col("hour")) + 0.03
    return rounded(lb.curve_error(shares, curve, ["a", "b"]), ["mean_abs_error"])
