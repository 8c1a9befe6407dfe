"""Secret scans: patterns find candidates, and how many repositories and owners share a candidate's value over the
whole corpus separates widely copied examples from credentials that look live.

Everything is DataFrame expressions.  Only candidates are shuffled, as hashes with their place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortspark.llm.common import kept, text_of


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds leftmost matches; a match stays when ``group`` has ``least`` characters.  ``gate`` is a
    cheaper pattern that every text with such a match has.  Kinds that are not ``base`` count only when owned.

    ``gate`` lets a text without a match skip the search; it may let one pass, never stop a match."""

    name: str
    pattern: str
    gate: str
    least: int = 0
    group: int = 0
    base: bool = True
    needs: str | None = None


KINDS = (
    Kind(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
        least=6,
        group=2,
    ),
    # runs are maximal, so asking for the length in the pattern finds the same matches as dropping short ones after
    Kind("access", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    Kind("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
    Kind(
        "opaque",
        r"[A-Za-z0-9_-]{20,}",
        r"[A-Za-z0-9_-]{20}",
        base=False,
        needs=r"^(?=.*[0-9].*[0-9].*[0-9])(?=.*[A-Z])(?=.*[a-z])",
    ),
)
#: A value that more owners or more repositories than this share is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 2, 4

_SPAN = "struct<start:int,kind:int,stop:int,value:binary>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; used inside a function of array elements, an expression is worked
    out again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(numbers: Column, first: Column) -> Column:
    return F.aggregate(
        numbers,
        F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["out"], acc["at"] + n).alias("out")),
        lambda acc: acc["out"],
    )


def _ends(lengths: Column) -> Column:
    """Running sums of an array of whole numbers.  Sums are taken in blocks of about the root of its size, since adding
    one element to an array copies it."""
    size = F.size(lengths)
    block = F.greatest(F.ceil(F.sqrt(size)).cast("int"), F.lit(1))
    # a sequence must not run from 0 down to -1
    starts = F.when(size > 0, F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0)), block)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda i: F.slice(lengths, i + 1, block))

    def summed(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda acc, n: acc + n))
        before = F.concat(F.array(F.lit(0)), _running(totals, F.lit(0)))
        return _let(before, lambda at: F.flatten(F.transform(blocks, lambda b, i: _running(b, F.get(at, i)))))

    return _let(blocks, summed)


def _found(text: Column, number: int, kind: Kind) -> Column:
    """Spans of one kind: the pieces between matches and the matches alternate, so their lengths give the places."""

    def spans(whole: Column) -> Column:
        value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole
        gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(whole))
        lengths = F.zip_with(gaps, whole, lambda g, m: F.length(g) + F.length(m))
        ends = _let(lengths, _ends)
        stays = F.filter(
            F.arrays_zip(ends.alias("stop"), whole.alias("match"), value.alias("value")),
            lambda s: (F.length(s["value"]) >= kind.least) & (s["value"].rlike(kind.needs) if kind.needs else F.lit(True)),
        )
        return F.transform(
            stays,
            lambda s: F.struct(
                (s["stop"] - F.length(s["match"])).alias("start"),
                F.lit(number).alias("kind"),
                s["stop"].alias("stop"),
                F.unhex(F.sha2(s["value"], 256)).alias("value"),
            ),
        )

    made = _let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), spans)
    return F.when(text.rlike(kind.gate), made).otherwise(F.array().cast(f"array<{_SPAN}>"))


_MARKED = "array<struct<start:int,kind:int,stop:int,live:boolean,reach:int>>"


def _marked(places: DataFrame, kinds: Sequence[Kind], max_owners: int, max_repositories: int) -> DataFrame:
    """``key`` and ``found`` of every distinct text in ``places`` (key, owner, repository, all): its spans by start, then
    kind, with ``live`` and ``reach``, where the live spans before it end.  Spans are rows here, so a text with many of
    them is sorted like any other rows."""
    base = F.col("kind").isin([i for i, k in enumerate(kinds) if k.base])
    spans = places.select("key", "all").dropDuplicates(["key"]).select("key", F.explode("all").alias("s")).select("key", "s.*")
    # added kinds stay where they overlap no base span: none that starts before it ends behind its start, and the first
    # that starts behind it starts behind its end
    ahead = Window.partitionBy("key").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("key").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    left, right = F.max(F.when(base, F.col("stop"))).over(ahead), F.min(F.when(base, F.col("start"))).over(behind)
    free = spans.withColumns({"left": left, "right": right})
    clear = (F.coalesce("left", F.col("start")) <= F.col("start")) & (F.coalesce("right", F.col("stop")) >= F.col("stop"))
    free = kept(free.filter(base | clear).drop("left", "right"))
    # a text with more (owner, repository) pairs than this has too many owners or too many repositories, so the pairs
    # beyond decide nothing
    pairs = places.select("key", "owner", "repository").distinct()
    first = Window.partitionBy("key").orderBy("owner", "repository")
    pairs = pairs.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= max_owners * max_repositories + 1)
    shares = (
        free.select("key", "value").distinct()
        .join(pairs.drop("n"), "key")
        .select("value", "owner", "repository")
        .distinct()
        .groupBy("value")
        .agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories"))
    )
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    judged = free.join(shares.select("value", few.alias("live")), "value").filter(base | F.col("live"))
    order = Window.partitionBy("key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.when(F.col("live"), F.col("stop"))).over(order), F.lit(0))
    found = F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "live", "reach")))
    return judged.withColumn("reach", reach).groupBy("key").agg(found.alias("found"))


def _scanned(
    docs: DataFrame,
    id_column: str,
    text_column: str,
    repository: Column | None,
    owner: Column | None,
    kinds: Sequence[Kind],
    max_owners: int,
    max_repositories: int,
    whole_rows: bool,
) -> DataFrame:
    """doc_id, found, and with ``whole_rows`` the text and the row as it came."""
    default = F.col("source") if "source" in docs.columns else F.lit("")
    spans = F.flatten(F.array(*[_found(F.col("text"), i, k) for i, k in enumerate(kinds)]))
    more = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if whole_rows else []
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        text_of(text_column).alias("text"),
        F.coalesce((default if owner is None else owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce((default if repository is None else repository).cast("string"), F.lit("")).alias("repository"),
        *more,
    )
    carried = ["doc_id", *(["text", "row"] if whole_rows else [])]
    # copies of a text are judged once, under its digest
    key = F.unhex(F.sha2("text", 256))
    some = F.lit(False)
    for k in kinds:
        some = some | F.col("text").rlike(k.gate)
    places = kept(rows.filter(some).select(key.alias("key"), "owner", "repository", spans.alias("all")).filter(F.size("all") > 0))
    marked = kept(_marked(places, kinds, max_owners, max_repositories))
    none = F.array().cast(_MARKED)
    hit = rows.filter(some).select(*carried, key.alias("key")).join(marked, "key", "left")
    hit = hit.select(*carried, F.coalesce("found", none).alias("found"))
    return rows.filter(~some).select(*carried, none.alias("found")).unionByName(hit)


def scan_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repository: Column | None = None,
    owner: Column | None = None,
    kinds: Sequence[Kind] = KINDS,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per document: ``doc_id`` and ``found``, all spans by start, then kind: start, kind, stop, live, reach.

    A value shared by at most ``max_owners`` owners and ``max_repositories`` repositories over all documents looks
    live, any other is a copied example.  Base spans are always in ``found``; spans of added kinds only when they look
    live and overlap no base span.  ``repository`` and ``owner`` default to the column ``source`` where there is one;
    nulls count as one owner.  Offsets are code points, ends exclusive.  Null texts are empty; repeated rows come back
    each; other columns are not read; an empty table gives an empty result.  Documents without a candidate are not
    shuffled.  A text may hold any number of spans: each is a row of its own until it is judged.
    """
    return _scanned(
        docs, id_column, text_column, repository, owner, kinds, max_owners, max_repositories, whole_rows=False
    )


def redact_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    mark: str = "[SECRET]",
    **options,
) -> DataFrame:
    """The documents with every span that looks live replaced by ``mark``, spans that overlap by one; all columns stay.

    Copied examples, and documents without a live span, are unchanged; a null text stays null.  Null ids and repeated
    rows come back as they are; an empty table gives an empty result.
    """
    settings = {
        "repository": None,
        "owner": None,
        "kinds": KINDS,
        "max_owners": MAX_OWNERS,
        "max_repositories": MAX_REPOSITORIES,
    }
    rows = _scanned(docs, id_column, text_column, whole_rows=True, **(settings | options))
    # four bytes a character, so a piece is found by its place; the mark of byte order in front is not part of the text
    order = F.unhex(F.lit("0000FEFF"))
    live = F.filter("found", lambda s: s["live"])

    def clean_text(wide: Column) -> Column:
        def piece(start: Column, n: Column) -> Column:
            return F.decode(F.concat(order, F.substring(wide, start * 4 + 1, n * 4)), "UTF-32")

        pieces = F.transform(F.filter(live, lambda s: s["start"] >= s["reach"]), lambda s: piece(s["reach"], s["start"] - s["reach"]))
        end = F.array_max(F.transform(live, lambda s: s["stop"]))
        return F.concat(F.array_join(pieces, mark), F.lit(mark), piece(end, F.length("text") - end))

    same = F.col(f"row.`{text_column}`").cast("string")
    clean = F.when(F.size(live) == 0, same).otherwise(_let(F.encode("text", "UTF-32"), clean_text))
    columns = [clean.alias(c) if c == text_column else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return rows.select(*columns)
