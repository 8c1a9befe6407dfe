"""Conversation prefix trie by van Emde Boas recursion.

Sequences are cut at half depth.  The prefix up to the cut gets a name; it is a leaf of the upper trie and the root of a
lower forest, and both halves are cut again.  All halves of one level are rows of one frame, so the trie of sequences of
length L takes log2(L) steps down, and its subtree totals log2(L) steps up: the totals of a lower forest are grafted
onto its root, and from there onto every node above it in the upper trie.

Rows are (conversation, position): no step holds a whole conversation, and a long or frequent one is many rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import WORD, Scratch, text_of
from cohortspark.operators.grouped import number_rows

ROOT = "00" * 16  # name of the prefix without turns, in hex digits
CHUNK_BITS = 12  # ids whose numbers agree but for these bits are written as one piece of text


def _name(*parts: Column) -> Column:
    """128 bits of a digest."""
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turn_symbols(
    rows: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """``conv_id``, ``pos`` (0, 1, ...), ``symbol`` (a name of role and text) and ``words`` of every turn.

    Turns go by ``turn`` (nulls first), then role and text; repeated rows all stay.  A null role or text is empty.  Rows
    without a conversation id belong to no conversation and are left out.
    """
    turns = rows.select(
        F.col(conv_column).cast("bigint").alias("conv_id"),
        F.col(turn_column).cast("bigint").alias("turn"),
        text_of(role_column).alias("role"),
        text_of(text_column).alias("text"),
    ).filter("conv_id is not null")
    numbered = number_rows(turns, ["conv_id"], "turn", "pos", ties=["role", "text"])
    mark = F.concat(F.length("role").cast("string"), F.lit(":"))
    return numbered.select(
        "conv_id",
        (F.col("pos") - 1).alias("pos"),
        _name(mark, F.col("role"), F.col("text")).alias("symbol"),
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"),
    )


def _halves(units: DataFrame) -> DataFrame:
    """Blocks of two: ``left`` names the first half where there is a second, ``name`` both where they are complete."""
    block = F.shiftright("block", 1)
    first = units.filter("block % 2 = 0").select("conv_id", block.alias("block"), F.col("name").alias("left"))
    second = units.filter("block % 2 = 1").select("conv_id", block.alias("block"), F.col("name").alias("right"), F.lit(True).alias("cut"))
    both = first.join(second, ["conv_id", "block"], "left")
    name = F.when(F.col("right").isNotNull(), _name(F.col("left"), F.col("right")))
    return both.select("conv_id", "block", "left", F.coalesce("cut", F.lit(False)).alias("cut"), name.alias("name"))


def prefix_names(symbols: DataFrame, members: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(``conv_id``, ``depth``, ``name``, ``words``, ``last``) of every prefix of every conversation in ``members``, and
    how often the depth is cut in half.  ``symbols`` has the positions 0, 1, ... of each conversation."""
    lengths = symbols.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    length = F.coalesce("n", F.lit(0)).cast("bigint")
    ends = members.join(lengths, "conv_id", "left").select("conv_id", length.alias("block"), F.lit(None).cast("binary").alias("name"))
    units = scratch.table(symbols.select("conv_id", F.col("pos").alias("block"), F.col("symbol").alias("name")).unionByName(ends))
    deepest = units.agg(F.max("block")).first()[0] or 0
    cuts = int(deepest).bit_length()
    levels = [units]
    for _ in range(cuts):
        levels.append(scratch.table(_halves(levels[-1])))
    named = members.select("conv_id", F.lit(0).cast("bigint").alias("block"), F.unhex(F.lit(ROOT)).alias("root"))
    for level in reversed(levels[1:]):
        # the upper half keeps the root, the lower one hangs below the prefix that ends at the cut
        upper = F.struct((F.col("block") * 2).alias("block"), F.col("root").alias("root"))
        lower = F.struct((F.col("block") * 2 + 1).alias("block"), _name(F.col("root"), F.col("left")).alias("root"))
        halves = F.explode(F.when(F.col("cut"), F.array(upper, lower)).otherwise(F.array(upper)))
        named = scratch.table(
            named.join(level.select("conv_id", "block", "left", "cut"), ["conv_id", "block"])
            .select("conv_id", halves.alias("half"))
            .select("conv_id", "half.block", "half.root")
        )
    words = symbols.select("conv_id", (F.col("pos") + 1).alias("block"), "words")
    last = ends.select("conv_id", "block", F.lit(True).alias("last"))
    prefixes = named.join(words, ["conv_id", "block"], "left").join(last, ["conv_id", "block"], "left")
    return scratch.table(
        prefixes.select(
            "conv_id",
            F.col("block").alias("depth"),
            F.col("root").alias("name"),
            F.coalesce("words", F.lit(0)).cast("bigint").alias("words"),
            F.coalesce("last", F.lit(False)).alias("last"),
        )
    ), cuts


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each name, which come one after the other; nothing but the digest is held."""
    name, digest = None, None
    for batch in batches:
        names, made = [], []
        for this, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if this != name:
                if name is not None:
                    names.append(name)
                    made.append(digest.hexdigest())
                name, digest = this, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(text.as_py().encode())
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.binary()), "ends": pa.array(made, pa.string())})
    if name is not None:
        yield pa.RecordBatch.from_pydict({"name": pa.array([name], pa.binary()), "ends": pa.array([digest.hexdigest()])})


def _ends(prefixes: DataFrame) -> DataFrame:
    """Digest of the ids that end at a node, in ascending order.  A digest can only be taken in order, so one task reads
    the ids of a node, packed into pieces of up to 4,096."""
    chunk = F.shiftright("conv_id", CHUNK_BITS)
    pieces = prefixes.filter("last").groupBy("name", chunk.alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    text = pieces.select("name", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))
    ordered = text.repartition("name").sortWithinPartitions("name", "chunk").select("name", "text")
    return ordered.mapInArrow(_digests, "name binary, ends string")


def prefix_trie(symbols: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per distinct prefix of the sequences in ``symbols`` (``conv_id``, ``pos``, ``symbol``, ``words``) of the
    conversations in ``members`` (distinct ``conv_id``): ``name``, ``parent``, ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    The root (depth 0) has every conversation, also one without turns; without any conversation there is no row.
    ``saved_tokens`` sums ``(n_convs - 1) * words`` over the subtree.  The result reads tables of ``scratch``.
    """
    prefixes, cuts = prefix_names(symbols, members, scratch)
    nodes = prefixes.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
    )
    above = prefixes.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = scratch.table(nodes.join(above, ["conv_id", "depth"], "left"))
    children = nodes.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    count = F.coalesce("n_children", F.lit(0)).cast("bigint")
    nodes = scratch.table(
        nodes.join(children, "name", "left").select(
            "name", "parent", "conv_id", "depth", "n_convs",
            count.alias("n_children"),
            (count == 0).cast("bigint").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
        )
    )
    for level in range(cuts):
        nodes = scratch.table(_grafted(nodes, prefixes, level))
    of_parent = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        nodes.join(of_parent, "parent", "left")
        .join(_ends(prefixes), "name", "left")
        .select(
            "name", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends", nothing).alias("ends_sha256"),
        )
    )


def _grafted(nodes: DataFrame, prefixes: DataFrame, level: int) -> DataFrame:
    """Totals inside blocks of 2 ** (level + 1) depths, from those inside blocks of half the size: what hangs below the
    last depth of an upper half is added to that node and to all nodes above it in the half."""
    size = 1 << level
    first = nodes.filter(F.col("depth") % (2 * size) == size)  # roots of lower forests
    forests = first.groupBy("parent").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
    cut = nodes.select(F.col("name").alias("parent"), "conv_id", F.shiftright("depth", level).alias("half"))
    grafts = forests.join(cut, "parent").select("conv_id", "half", "leaves", "saved")
    path = prefixes.select("conv_id", F.shiftright("depth", level).alias("half"), "name")
    added = path.join(grafts, ["conv_id", "half"]).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    out = nodes.join(added, "name", "left")
    # a node without children counts itself; any other counts the leaves below it
    return out.withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.coalesce("leaves", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("saved", F.lit(0)),
        }
    ).drop("leaves", "saved")
