"""Ordered work inside groups of any size.

A window function sorts a whole group in one task, so one key that holds a third of all rows decides the run time.
The functions here give the same results as the plain window functions, but cut every group above ``TARGET_ROWS``
into pieces along its order:

* the window runs per (group, piece), so no task sorts more than about one piece;
* what a piece needs from the pieces before or after it (a count, a sum, a last value) is one row per piece,
  worked out from pre-aggregated rows and joined back.

There is one plan for all inputs, and nothing runs before an action.  Rows chosen by a hash of their values place the
cuts, so the cuts are a function of the data: they come out the same in every branch of a plan and after a lost
executor.  Groups below the target have no cuts and stay whole; where no group has any, the joins meet an empty side
and the adaptive plan leaves them out.  What remains is one more pass over the input for the chosen rows.

Cut points and carried rows are at most ``2 * rows / TARGET_ROWS`` rows of a few values (a million for 2e12 rows),
which is why they are broadcast.  Callers that know better pass ``split``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TARGET_ROWS = 4_000_000
SAMPLES = 1000  # rows per piece that place its cut
WHOLE = "whole"
PIECE = "_piece"
CUTS = "_cuts"
Split = str | tuple[Column, Column] | None


def epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def elapsed(end: Column | str, start: Column | str) -> Column:
    """Seconds between two timestamps as an exact decimal.  Unlike ``timestampdiff``, which reads timestamps without
    a zone in the session's zone, a subtraction is the same in every session."""
    end, start = (F.col(c) if isinstance(c, str) else c for c in (end, start))
    return (end - start).cast("interval second").cast("decimal(18,6)")


def micros(ts: Column | str) -> Column:
    """Timestamp as microseconds since 1970."""
    return (elapsed(ts, epoch()) * F.lit(1_000_000)).cast("bigint")


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, epoch())


def match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where null meets null; the key columns of ``left`` are kept."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    on = F.lit(True)
    for i, k in enumerate(keys):
        same = left[k].eqNullSafe(renamed[f"_r_{k}"])
        on = same if i == 0 else on & same
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def large_groups(df: DataFrame, keys: Sequence[str], target_rows: int | None = None) -> DataFrame:
    """Groups of more than ``target_rows`` rows: at most ``rows / target_rows``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > (target_rows or TARGET_ROWS)).select(*keys)


def _position(order: str, ties: Sequence[str]) -> Column:
    """Where a row stands; positions compare like the order of a window, nulls first."""
    return F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate([order, *ties])])


def split_points(
    df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (), target_rows: int | None = None
) -> DataFrame:
    """Ascending cut points ``_cuts`` of the groups that hold more than about ``target_rows`` rows; no row for others.

    Every ``stride``-th row by a hash of all its columns is looked at; each time as many of them as stand for a target's
    worth of rows have gone by, there is a cut.
    """
    target = target_rows or TARGET_ROWS
    stride = max(1, target // SAMPLES)
    rows = df
    if stride > 1:
        hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
        rows = df.filter(F.pmod(F.xxhash64(*hashed), F.lit(stride)) == 0)
    rows = rows.select(*keys, _position(order, ties).alias("_o"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_o"))
    chosen = rows.withColumn("_r", number).filter(F.col("_r") % (target // stride) == 0)
    cuts = chosen.groupBy(*keys).agg(F.sort_array(F.collect_set("_o")).alias(CUTS))
    return cuts.filter(F.size(CUTS) > 0)


def _piece(cuts: Column, position: Column) -> Column:
    """How many cuts lie before the position, by halving."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(cuts) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi"))

    def halved(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["lo"] + acc["hi"], 1)
        open_, before = acc["lo"] < acc["hi"], F.get(cuts, middle) < position
        return F.struct(
            F.when(open_ & before, middle + 1).otherwise(acc["lo"]).alias("lo"),
            F.when(open_ & ~before, middle).otherwise(acc["hi"]).alias("hi"),
        )

    return F.aggregate(rounds, start, halved, lambda acc: acc["lo"])


def with_pieces(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    split: Split = None,
    target_rows: int | None = None,
) -> tuple[DataFrame, bool]:
    """(frame with ``_piece``, whether groups may be cut).  ``split``: ``WHOLE``, the columns (piece of a row, whether its
    group is cut) where the order itself tells them, or None to place cuts."""
    if isinstance(split, str):
        return df.withColumn(PIECE, F.lit(0)), False
    if split is not None:
        piece, large = split
        out = df.withColumn(CUTS, F.when(large, F.lit(True)))
        return out.withColumn(PIECE, F.when(large, piece).otherwise(0).cast("int")), True
    split = split_points(df, keys, order, ties, target_rows)
    if keys:
        df = match(df, F.broadcast(split), keys)
    else:
        df = df.withColumn(CUTS, split.select(CUTS).scalar())
    piece = F.when(F.col(CUTS).isNull(), 0).otherwise(_piece(F.col(CUTS), _position(order, ties)))
    return df.withColumn(PIECE, piece.cast("int")), True


def _window(keys: Sequence[str], order: Sequence[Column | str]):
    return Window.partitionBy(*keys, PIECE).orderBy(*order)


def _with_carry(
    out: DataFrame,
    pieces: DataFrame,
    cut: bool,
    keys: Sequence[str],
    sums: dict[str, Column],
    carry: dict[str, Column],
) -> DataFrame:
    """Join to ``out`` what each piece of a large group needs from the others.

    ``sums`` are aggregates per piece, ``carry`` turns them into values over the order of the pieces.  For groups that
    are not cut the carried columns are null.
    """
    if not cut:
        kinds = pieces.groupBy(*keys, PIECE).agg(*[c.alias(n) for n, c in sums.items()]).schema
        return out.withColumns({n: F.lit(None).cast(kinds[n].dataType) for n in carry})
    per_piece = (
        pieces.filter(F.col(CUTS).isNotNull())
        .groupBy(*keys, PIECE)
        .agg(*[c.alias(n) for n, c in sums.items()])
    )
    rows = per_piece.select(*keys, PIECE, *[c.alias(n) for n, c in carry.items()])
    return match(out, F.broadcast(rows), [*keys, PIECE])


def _before(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)


def _after(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(F.desc(PIECE)).rowsBetween(Window.unboundedPreceding, -1)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    ties: Sequence[str] = (),
    method: str = "row_number",
    split: Split = None,
    target_rows: int | None = None,
) -> DataFrame:
    """``row_number``, ``rank`` or ``dense_rank`` by ``order`` (then ``ties``) inside ``keys``."""
    pieces, cut = with_pieces(df, keys, order, ties, split, target_rows)
    w = _window(keys, [order, *ties])
    local = {"row_number": F.row_number(), "rank": F.rank(), "dense_rank": F.dense_rank()}[method].over(w)
    levels = F.count(F.lit(1))
    if method == "dense_rank":
        levels = F.count_distinct(F.struct(order, *ties))
    carry = {"_c": F.sum("_c").over(_before(keys))}
    return (
        _with_carry(pieces.withColumn(name, local), pieces, cut, keys, {"_c": levels}, carry)
        .withColumn(name, (F.col(name) + F.coalesce("_c", F.lit(0))).cast("bigint"))
        .drop("_c", PIECE, CUTS)
    )


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: dict[str, str],
    descending: bool = False,
    totals: dict[str, str] | None = None,
    split: Split = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Running totals up to and including the row; ``sums`` maps new column to summed column.

    ``order`` must be unique inside a group (sum ties up first).  ``totals`` adds sums over the whole group.
    """
    totals = totals or {}
    pieces, cut = with_pieces(df, keys, order, (), split, target_rows)
    by = F.desc(order) if descending else F.asc(order)
    w = Window.partitionBy(*keys, PIECE).orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    over = _after(keys) if descending else _before(keys)
    whole = Window.partitionBy(*keys, PIECE)
    local = {n: F.sum(c).over(w) for n, c in sums.items()} | {n: F.sum(c).over(whole) for n, c in totals.items()}
    all_pieces = Window.partitionBy(*keys)
    out = _with_carry(
        pieces.withColumns(local),
        pieces,
        cut,
        keys,
        {f"_c_{n}": F.sum(c) for n, c in (sums | totals).items()},
        {f"_c_{n}": F.sum(f"_c_{n}").over(over) for n in sums} | {f"_c_{n}": F.sum(f"_c_{n}").over(all_pieces) for n in totals},
    )
    out = out.withColumns(
        {n: F.coalesce(F.col(n) + F.col(f"_c_{n}"), F.col(n), F.col(f"_c_{n}")) for n in sums}
        | {n: F.coalesce(f"_c_{n}", n) for n in totals}
    )
    return out.drop(*[f"_c_{n}" for n in sums | totals], PIECE, CUTS)


def previous_next(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    ties: Sequence[str] = (),
    split: Split = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Value of the row before (``previous``: new column -> source) and after (``following``)."""
    previous, following = previous or {}, following or {}
    pieces, cut = with_pieces(df, keys, order, ties, split, target_rows)
    w = _window(keys, [order, *ties])
    position = F.struct(order, *ties)
    sums, carry, new = {}, {}, {}
    for n, c in previous.items():
        sums[f"_p_{n}"] = F.max_by(F.struct(c), position)
        carry[f"_p_{n}"] = F.lag(f"_p_{n}").over(Window.partitionBy(*keys).orderBy(PIECE))
        new[n] = F.lag(F.struct(c)).over(w)
    for n, c in following.items():
        sums[f"_f_{n}"] = F.min_by(F.struct(c), position)
        carry[f"_f_{n}"] = F.lead(f"_f_{n}").over(Window.partitionBy(*keys).orderBy(PIECE))
        new[n] = F.lead(F.struct(c)).over(w)
    out = _with_carry(pieces.withColumns(new), pieces, cut, keys, sums, carry)
    done = {n: F.coalesce(F.col(n), F.col(f"_p_{n}"))[c] for n, c in previous.items()}
    done |= {n: F.coalesce(F.col(n), F.col(f"_f_{n}"))[c] for n, c in following.items()}
    return out.withColumns(done).drop(*sums, PIECE, CUTS)


def fill(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    directions: Sequence[str] = ("forward", "backward"),
    ties: Sequence[str] = (),
    split: Split = None,
    target_rows: int | None = None,
) -> DataFrame:
    """Fill nulls from the nearest non-null row in each direction, in the order the directions are given.

    Both directions look from the first row of the window to the current one, once ascending and once descending:
    a frame that ends at the last row would be re-read for every row.
    """
    pieces, cut = with_pieces(df, keys, order, ties, split, target_rows)
    position = F.struct(order, *ties)
    up = Window.partitionBy(*keys, PIECE).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    down = (
        Window.partitionBy(*keys, PIECE)
        .orderBy(F.desc(order), *[F.desc(t) for t in ties])
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local, sums, carry = {}, {}, {}
    for c in columns:
        seen = F.when(F.col(c).isNotNull(), position)
        if "forward" in directions:
            local[f"_forward_{c}"] = F.last(c, ignorenulls=True).over(up)
            sums[f"_cf_{c}"] = F.max_by(c, seen)
            carry[f"_cf_{c}"] = F.last(f"_cf_{c}", ignorenulls=True).over(_before(keys))
        if "backward" in directions:
            local[f"_backward_{c}"] = F.last(c, ignorenulls=True).over(down)
            sums[f"_cb_{c}"] = F.min_by(c, seen)
            carry[f"_cb_{c}"] = F.last(f"_cb_{c}", ignorenulls=True).over(_after(keys))
    out = _with_carry(pieces.withColumns(local), pieces, cut, keys, sums, carry)
    filled = {}
    for c in columns:
        parts = []
        for d in directions:
            parts += [F.col(f"_{d}_{c}"), F.col(f"_c{d[0]}_{c}")]
        filled[c] = F.coalesce(*parts)
    return out.withColumns(filled).drop(*local, *sums, PIECE, CUTS)


def quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probabilities: dict[str, float],
    target_rows: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per group, for groups of any size.

    Equal values are counted first, then the counts are summed up in value order; the two values around each
    wanted position are picked from the running counts.  No task holds a whole group.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    run = running_sum(counts, keys, "_v", {"_hi": "_n"}, totals={"_total": "_n"}, target_rows=target_rows)
    picks = []
    for name, p in probabilities.items():
        position = (F.col("_total") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("_hi") - F.col("_n") <= at) & (at < F.col("_hi"))
            picks.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}_{name}"))
    found = run.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)
    out = []
    for name, p in probabilities.items():
        position = (F.col("_total") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    return found.select(*keys, *out)


def seeded_hash(seed: int | str, *ids: Column | str) -> Column:
    """Reproducible hex order key: md5 of seed and ids, the same on any partitioning."""
    parts = [F.lit(str(seed))]
    parts += [(F.col(i) if isinstance(i, str) else i).cast("string") for i in ids]
    return F.md5(F.concat_ws("|", *parts))


def hash_rank(
    df: DataFrame, keys: Sequence[str], hash_column: str, name: str, total: str | None = None,
    ties: Sequence[str] = (), digits: int = 3, keep=None,
) -> DataFrame:
    """Exact 1-based rank by a hash inside ``keys``; with ``total``, also the group size.

    The leading hex digits cut every group into ``16 ** digits`` even pieces, so a class with most of the rows is
    ranked by many tasks; the offsets are one row per (group, piece).  ``keep`` (a function of the group size column)
    limits the ranks that are wanted: pieces that start beyond it are dropped before anything is sorted.
    """
    piece = F.conv(F.substring(hash_column, 1, digits), 16, 10).cast("int")
    # one struct column is the key of join and window alike (null classes are equal), so the rows are shuffled once
    pieces = df.withColumn("_g", F.struct(*keys, piece.alias(PIECE)))
    per_piece = pieces.groupBy("_g").agg(F.count(F.lit(1)).alias("_c"))
    inside = [F.col(f"_g.{k}") for k in keys]
    before = Window.partitionBy(*inside).orderBy(f"_g.{PIECE}").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_piece.select(
        "_g",
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy(*inside)).alias("_total"),
    )
    out = pieces.join(offsets, "_g")
    if keep is not None:
        out = out.filter(F.col("_off") < keep(F.col("_total")))
    w = Window.partitionBy("_g").orderBy(hash_column, *ties)
    out = out.withColumn(name, (F.row_number().over(w) + F.col("_off")).cast("bigint"))
    if keep is not None:
        out = out.filter(F.col(name) <= keep(F.col("_total")))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_g", "_off", "_total")
