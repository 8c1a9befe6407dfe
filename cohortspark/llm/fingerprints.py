"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks that close pairs must share, a Hamming check, and the
connected components of the links."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import NULL_ID, Scratch, kept, real_id, runs, text_of
from cohortspark.llm.components import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BITS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of UTF-8 text: words between ASCII white space, A-Z in lower case, shingles of ``shingle`` words with
    repeats.  A text with fewer words is one shingle; without words the fingerprint is 0."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :]
    starts = np.concatenate([[0], ends[: len(stops) - 1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist())], np.uint64, len(stops)
    )
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # 1 MB of bits at a time, for texts of any length
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
        rest = batch.columns[2:]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(values, pa.int64()), *rest], names=["id", "fp", *batch.schema.names[2:]]
        )


def _id(id_column: str) -> Column:
    return F.coalesce(F.col(id_column).cast("bigint"), F.lit(NULL_ID))


def _digest(text_column: str) -> Column:
    return F.md5(text_of(text_column).cast("binary"))


def with_fingerprints(docs: DataFrame, id_column: str, text_column: str, shingle: int, digest: bool = False) -> DataFrame:
    """Rows (id, fp), with ``digest`` also the digest of the text."""
    rows = docs.select(
        _id(id_column).alias("id"),
        text_of(text_column).cast("binary").alias("body"),
        *([_digest(text_column).alias("digest")] if digest else []),
    )
    schema = "id bigint, fp bigint" + (", digest string" if digest else "")
    return rows.mapInArrow(lambda batches: _fingerprints(batches, shingle), schema)


def block_masks(blocks: int, max_bits: int) -> list[int]:
    """Masks of all choices of ``blocks - max_bits`` blocks: two fingerprints that differ in at most ``max_bits`` bits
    agree on all bits of at least one mask."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [sum(choice) for choice in combinations(parts, blocks - max_bits)]


def choose_blocks(n: int, max_bits: int) -> int:
    """The fewest blocks with which ``n`` even fingerprints meet at most ``n`` others by chance over all masks."""
    blocks = max_bits + 1
    while blocks < max_bits + 8:
        agreed = BITS * (blocks - max_bits) / blocks
        if comb(blocks, max_bits) * n / 2**agreed <= 1.0:
            break
        blocks += 1
    return blocks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def linked(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same values as all pairs within ``max_bits`` bits would: a spanning forest, found by
    comparing each value reached with those not reached yet."""
    left = np.arange(len(values))
    a, b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= max_bits
            if near.any():
                found = left[near]
                a.append(np.full(len(found), at))
                b.append(found)
                queue.extend(found.tolist())
                left = left[~near]
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


WIDE = 4096  # values of one block key beyond which they are cut by further blocks


def links_in(values: np.ndarray, mask: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among distinct values that agree on ``mask``.  Many values are cut again by blocks of the other bits."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    blocks = max_bits + 2
    if len(values) <= WIDE or len(free) < 2 * blocks:
        a, b = linked(values, max_bits)
        yield values[a], values[b]
        return
    edges = [round(i * len(free) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << free[j] for j in range(edges[i], edges[i + 1])) for i in range(blocks)]
    for choice in combinations(parts, blocks - max_bits):
        finer = mask | sum(choice)
        keys = values & np.uint64(finer)
        order = np.argsort(keys, kind="stable")
        ordered = values[order]
        for s, e in zip(*runs(keys[order])):
            if e - s > 1:
                yield from links_in(ordered[s:e], finer, max_bits)


def _links(batches: Iterator[pa.RecordBatch], masks: list[int], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links of rows (m, key, fp) that come sorted by (m, key), so every block is one run."""

    def made(m: np.ndarray, keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        out_a, out_b = [], []
        starts, ends = runs(m * np.int64(0x9E3779B97F4A7C1) ^ keys)
        size = ends - starts
        for s in starts[size == 2]:  # most blocks with company hold two
            if np.bitwise_count(values[s] ^ values[s + 1]) <= max_bits:
                out_a.append(values[s : s + 1])
                out_b.append(values[s + 1 : s + 2])
        for s, e in zip(starts[size > 2], ends[size > 2]):
            for a, b in links_in(values[s:e], masks[m[s]], max_bits):
                out_a.append(a)
                out_b.append(b)
        a = np.concatenate([*out_a, np.zeros(0, np.uint64)]).view(np.int64)
        b = np.concatenate([*out_b, np.zeros(0, np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    waiting: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        m, keys, values = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        if not len(m):
            continue
        same = (m == m[-1]) & (keys == keys[-1])
        last = len(m) - int(np.argmin(same[::-1])) if not same.all() else 0
        if last == 0 and waiting and (waiting[0][0][-1], waiting[0][1][-1]) == (m[0], keys[0]):
            waiting.append((m, keys, values))
            continue
        ready = [*waiting, (m[:last], keys[:last], values[:last])]
        yield made(*(np.concatenate(x) if i < 2 else np.concatenate(x).view(np.uint64) for i, x in enumerate(zip(*ready))))
        waiting = [(m[last:], keys[last:], values[last:])]
    if waiting:
        yield made(*(np.concatenate(x) if i < 2 else np.concatenate(x).view(np.uint64) for i, x in enumerate(zip(*waiting))))


def fingerprint_links(prints: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect exactly what all pairs within
    ``max_bits`` bits connect."""
    masks = block_masks(choose_blocks(n, max_bits), max_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(_signed(k)).alias("key")) for i, k in enumerate(masks)])
    rows = prints.select("fp", F.explode(keys).alias("k")).select("k.m", "k.key", "fp")
    dealt = rows.repartition("m", "key").sortWithinPartitions("m", "key", "fp")
    return dealt.mapInArrow(lambda batches: _links(batches, masks, max_bits), "a bigint, b bigint")


def _rooted(rows: DataFrame, first: Column, max_bits: int, scratch: Scratch) -> DataFrame:
    """Every distinct fingerprint of ``rows`` with the smallest ``first`` of its rows and the root of its component."""
    nodes = scratch.table(rows.groupBy("fp").agg(F.min(first).alias("first")))
    links = scratch.table(fingerprint_links(nodes.select("fp"), nodes.count(), max_bits).distinct())
    roots = components(links, scratch)
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicate_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id it reaches).

    Documents link when their fingerprints differ in at most ``max_bits`` bits.  Equal fingerprints are one node, so
    copies are not paired; links of distinct fingerprints are a spanning forest per block.  Null and empty texts have
    fingerprint 0 and link like any other.  Null ids are later than all others and come back null; repeated rows come
    back each; other columns are not read; an empty table gives an empty result.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = kept(with_fingerprints(docs, id_column, text_column, shingle))
        named = _rooted(rows, F.col("id"), max_bits, scratch)
        least = named.groupBy("root").agg(F.min("first").alias("component"))
        groups = kept(named.join(least, "root").select(F.col("fp").alias("print"), "component"))
    return rows.join(groups, F.col("fp") == F.col("print")).select(
        real_id("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        real_id("component").alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One document of each group: the one with the smallest id (a null id is later than all others), all columns
    unchanged.  Of several texts of a group with that id the one with the smallest digest stays, of rows with the same id
    and text any one.  Groups stay apart where they share an id or have only null ids: each keeps a document."""
    with Scratch(docs.sparkSession) as scratch:
        rows = with_fingerprints(docs, id_column, text_column, shingle, digest=True)
        named = _rooted(rows, F.struct("id", "digest"), max_bits, scratch)
        stay = kept(named.groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.digest"))
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        _id(id_column).alias("id"),
        _digest(text_column).alias("digest"),
    )
    return packed.join(stay, ["id", "digest"]).dropDuplicates(["id", "digest"]).select("row.*")
