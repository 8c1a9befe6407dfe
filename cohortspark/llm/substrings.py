"""Removal of repeated passages: every byte covered by a string of ``length`` bytes that also starts in a document with
a smaller id.

Strings are brought together by their minimizer, the smallest hash of ``SEED_BYTES`` bytes inside them, which equal
strings share.  Runs of neighbouring strings with one minimizer stay one segment.  A first count finds the minimizers
that more than one document has; only their segments are sent, once per batch, to the task of their minimizer.  There
a Burrows-Wheeler transform over the distinct segments finds the strings that are equal (``bwt``), and every segment
gets back, for each of its strings, the smallest id that has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.bwt import SEPARATOR, equal_substrings
from cohortspark.llm.common import Scratch, gathered, mixed, partitions, real_id, runs
from cohortspark.llm.counting import (
    REQUEST,
    by_batch,
    decoded,
    levels,
    levels_of,
    marks,
    rows_of,
)

LENGTH = 50
SEED_BYTES = 20
CHUNK = 1 << 17  # windows hashed at a time, so the arrays stay in the processor's cache
HOT = 1 << 15  # a minimizer in more segments, each counted once per batch, has each string dealt by its own hash
BUCKETS_PER_PARTITION = 4
PARTS = 16  # by its hash a minimizer belongs to one part of its bucket; parts are expanded one after the other
PART_BYTES = 1 << 18  # parts are joined up to about this size, so the arrays stay in the processor's cache

_U = np.uint64


def _hashes(body: np.ndarray) -> np.ndarray:
    """Hash of the ``SEED_BYTES`` bytes from each place on."""
    word = np.ndarray(len(body) - 7, "<u8", body.tobytes(), strides=(1,))
    n = len(body) - SEED_BYTES + 1
    h = word[:n] * _U(0x9E3779B97F4A7C15)
    h ^= word[8 : 8 + n] * _U(0xC2B2AE3D27D4EB4F)
    h += word[12 : 12 + n] * _U(0x165667B19E3779F9)
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    more = width - have
    return np.minimum(values[:-more], values[more:]) if more else values


def segments(body: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first, last + 1, minimizer) of the runs of windows that lie inside a document and share a minimizer."""
    n = len(body) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    inside = np.ones(len(body), bool)
    for s, size in zip(starts.tolist(), sizes.tolist()):
        inside[max(s, s + size - length + 1) : s + size] = False
    first, last, value = [], [], []
    for at in range(0, n, CHUNK):
        stop = min(n, at + CHUNK)
        least = _smallest(_hashes(body[at : stop + length - 1]), length - SEED_BYTES + 1)
        valid = inside[at:stop]
        new = valid.copy()
        new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
        head = np.flatnonzero(new)
        # a run ends where the next begins or where a window is not inside
        bounds = np.flatnonzero(np.concatenate([new | ~valid, [True]]))
        first.append(head + at)
        last.append(bounds[np.searchsorted(bounds, head, "right")] + at)
        value.append(least[head])
    return np.concatenate(first), np.concatenate(last), np.concatenate(value)


class _Batch:
    def __init__(self, row: dict[str, pa.Scalar], length: int):
        self.name = row["batch"].as_py()
        self.data = row["body"].as_py()
        self.body = np.frombuffer(self.data, np.uint8)
        self.ids = np.frombuffer(row["ids"].as_py(), np.int64)
        self.sizes = np.frombuffer(row["sizes"].as_py(), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.length = length
        self.first, self.last, values = segments(self.body, self.starts, self.sizes, length)
        self.values, self.value = np.unique(values, return_inverse=True)
        # the last document that begins at or before a place; empty ones hold no window
        self.owner = self.ids[np.searchsorted(self.starts, self.first, "right") - 1]

    def sharing(self) -> np.ndarray:
        """1 for a minimizer that one id of the batch has, else how many different segments it has, at least 2."""
        counts = np.ones(len(self.values), np.int64)
        if not len(counts):
            return counts
        order = np.argsort(self.value, kind="stable")
        at, _ = runs(self.value[order])
        ids = self.owner[order]
        several = np.minimum.reduceat(ids, at) != np.maximum.reduceat(ids, at)
        chosen = np.flatnonzero(several[self.value])
        _, one = np.unique(self._contents(chosen), return_index=True)
        different = np.bincount(self.value[chosen[one]], minlength=len(counts))
        counts[several] = np.maximum(different[several], 2)
        return counts

    def _contents(self, chosen: np.ndarray) -> np.ndarray:
        """Hash of the segments by the words from their begin and from their end on; these cover all ordinary ones."""
        word = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        start, stop = self.first[chosen], self.last[chosen] + self.length - 1
        h = self.values[self.value[chosen]] + (stop - start).astype(_U)
        for step in range(0, min(self.length, 48) - 7, 8):
            for at in (start + step, stop - 8 - step):
                h = (h ^ word[at]) * _U(0x9E3779B97F4A7C15)
                h ^= h >> _U(32)
        return h

    def candidates(
        self, found: dict[int, bytes], buckets: int
    ) -> Iterator[tuple[int, int, int, int, bytes]]:
        """(bucket, part, first, id, content) of the segments whose minimizer several documents may have."""
        hashes = mixed(self.values)
        seen = levels_of(hashes, buckets, found, 2)
        again = mixed(hashes)
        dealt, part = again % _U(buckets), again // _U(buckets) % _U(PARTS)
        chosen = np.flatnonzero(seen[self.value] > 0)
        value = self.value[chosen]
        columns = (dealt[value], part[value], seen[value] > 1, self.first[chosen], self.last[chosen], self.owner[chosen])
        data, length = self.data, self.length
        for bucket, mine, often, a, b, owner in zip(*(c.tolist() for c in columns)):
            if often:
                for p in range(a, b):
                    content = data[p : p + length]
                    h = xxhash.xxh64_intdigest(content)
                    yield h % buckets, h // buckets % PARTS, p, owner, content
            else:
                yield bucket, mine, a, owner, data[a : b + length - 1]


ASKED = "bucket int, batch string, n int, items binary, body binary"
FOUND = "batch string, bucket int, n int, runs int, packed binary"


def _packed(*columns: np.ndarray) -> bytes:
    """The columns byte by byte, all first bytes, then all second ones, compressed."""
    planes = (c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(data: bytes, *columns: tuple[type, int]) -> list[np.ndarray]:
    """Back to columns of the given (type, size)."""
    widths = [np.dtype(kind).itemsize * n for kind, n in columns]
    planes = np.frombuffer(pa.decompress(data, decompressed_size=sum(widths), codec="zstd", asbytes=True), np.uint8)
    ends = accumulate(widths, initial=0)
    return [
        np.ascontiguousarray(planes[a:b].reshape(-1, n).T).view(kind).ravel()
        for (a, b), (kind, n) in zip(pairwise(ends), columns)
    ]


def _first_request(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int32()), ("batch", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])
    for row in rows_of(batches):
        b = _Batch(row, length)
        yield pa.RecordBatch.from_pylist(marks(b.name, mixed(b.values), b.sharing(), buckets), schema=schema)


def _second_request(
    batches: Iterator[pa.RecordBatch], length: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("bucket", pa.int32()), ("batch", pa.string()), ("n", pa.int32()), ("items", pa.binary()), ("body", pa.binary())]
    )
    for row in rows_of(batches):
        b = _Batch(row, length)
        by_bucket: dict[int, dict[bytes, list]] = {}
        for bucket, part, _, owner, content in b.candidates(decoded(row["answers"]), buckets):
            items = by_bucket.setdefault(bucket, {})
            known = items.get(content)
            if known is None:
                items[content] = [owner, 0, part]
            elif owner != known[0]:
                known[:2] = min(owner, known[0]), 1
        rows = [
            {
                "bucket": bucket,
                "batch": b.name,
                "n": len(items),
                "items": _packed(
                    np.fromiter(map(len, items), np.uint32, len(items)),
                    np.diff(np.array([x[0] for x in items.values()], np.int64), prepend=0),
                    np.array([x[1] for x in items.values()], np.uint8),
                    np.array([x[2] for x in items.values()], np.uint8),
                ),
                "body": pa.compress(b"".join(items), codec="zstd", asbytes=True),
            }
            for bucket, items in by_bucket.items()
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def smallest_ids(contents: list[bytes], ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ids): for every string of ``length`` bytes inside a content the smallest id of a content that has it,
    one after the other, and where each content's begin."""
    text = np.frombuffer(bytes([SEPARATOR]).join([*contents, b""]), np.uint8)
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    begin = np.cumsum(sizes + 1) - sizes - 1
    windows = sizes - length + 1
    starts = np.cumsum(windows) - windows
    where = np.repeat(begin - starts, windows) + np.arange(int(windows.sum()))  # place of every window in the text
    order, group = equal_substrings(text, length)
    of_place = np.empty(len(text), np.int64)
    of_place[order] = group
    of_window = of_place[where]
    least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, of_window, np.repeat(ids, windows))
    return starts, least[of_window]


def _expanded(contents: list[bytes], owners: np.ndarray, parts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(from, to, size, id, lower): the smallest ids of each content's strings as runs, where each content's runs begin
    and end, and whether one of them is smaller than the content's own id.  Equal strings are in one part."""
    total = int(np.fromiter(map(len, contents), np.int64, len(contents)).sum())
    group = parts % min(PARTS, 1 + total // PART_BYTES)
    order = np.argsort(group, kind="stable")
    run_from, run_to = np.empty(len(contents), np.int64), np.empty(len(contents), np.int64)
    lower = np.empty(len(contents), bool)
    sizes, found, done = [], [], 0
    for s, e in zip(*runs(group[order])):
        at = order[s:e]
        starts, ids = smallest_ids([contents[i] for i in at.tolist()], owners[at], length)
        ends = np.append(starts[1:], len(ids))
        lower[at] = np.add.reduceat(ids < np.repeat(owners[at], ends - starts), starts) > 0
        cuts = np.concatenate([[True], ids[1:] != ids[:-1]])
        cuts[starts] = True
        heads = np.flatnonzero(cuts)
        first = np.searchsorted(heads, starts)
        run_from[at] = done + first
        run_to[at] = done + np.append(first[1:], len(heads))
        sizes.append(np.diff(np.append(heads, len(ids))))
        found.append(ids[heads])
        done += len(heads)
    return run_from, run_to, np.concatenate(sizes), np.concatenate(found), lower


def _matched(rows: pa.Table, length: int) -> pa.Table:
    """All requests of one bucket: for each content that several documents have, or part of it, the smallest ids."""
    known: dict[bytes, int] = {}
    least: list[int] = []
    shared: list[int] = []
    part_of: list[int] = []
    places = []
    for n, items, body in zip(*(rows.column(c).to_pylist() for c in ("n", "items", "body"))):
        sizes, steps, flags, parts = _unpacked(items, (np.uint32, n), (np.int64, n), (np.uint8, n), (np.uint8, n))
        ends = list(accumulate(sizes.tolist(), initial=0))
        data = pa.decompress(body, decompressed_size=ends[-1], codec="zstd", asbytes=True)
        mine = []
        columns = (pairwise(ends), np.cumsum(steps).tolist(), flags.tolist(), parts.tolist())
        for (a, e), ident, flag, part in zip(*columns):
            content = data[a:e]
            i = known.get(content)
            if i is None:
                i = known[content] = len(least)
                least.append(ident)
                shared.append(flag)
                part_of.append(part)
            elif ident != least[i]:
                shared[i] = 1
                least[i] = min(least[i], ident)
            elif flag:
                shared[i] = 1
            mine.append(i)
        places.append(mine)
    run_from, run_to, run_size, run_id, lower = _expanded(
        list(known), np.array(least, np.int64), np.array(part_of, np.int64), length
    )
    told = lower | (np.array(shared) > 0)
    out = []
    for name, bucket, mine in zip(rows.column("batch").to_pylist(), rows.column("bucket").to_pylist(), places):
        mine = np.array(mine)
        items = np.flatnonzero(told[mine])
        if not len(items):
            continue
        a, b = run_from[mine[items]], run_to[mine[items]]
        at = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange(int((b - a).sum()))
        out.append(
            {
                "batch": name,
                "bucket": bucket,
                "n": len(items),
                "runs": len(at),
                "packed": _packed(
                    np.diff(items, prepend=0).astype(np.uint32),
                    (b - a).astype(np.uint32),
                    run_size[at].astype(np.uint32),
                    run_id[at],
                ),
            }
        )
    schema = pa.schema(
        [("batch", pa.string()), ("bucket", pa.int32()), ("n", pa.int32()), ("runs", pa.int32()), ("packed", pa.binary())]
    )
    return pa.Table.from_pylist(out, schema=schema)


def _hits(b: _Batch, row: dict[str, pa.Scalar], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the bytes of the batch that runs of strings with a smaller id cover."""
    none = np.zeros(0, np.int64)
    matches = row["matches"].values
    if matches is None or not len(matches):
        return none, none
    told: dict[int, dict[int, int]] = {}  # answers by the item's number in its bucket
    counts, sizes, ids, known = [], [], [], 0
    for m in matches.to_pylist():
        n, runs_ = m["n"], m["runs"]
        columns = (np.uint32, n), (np.uint32, n), (np.uint32, runs_), (np.int64, runs_)
        steps, count, size, least = _unpacked(m["packed"], *columns)
        told[m["bucket"]] = dict(zip(np.cumsum(steps).tolist(), range(known, known + n)))
        known += n
        counts.append(count)
        sizes.append(size)
        ids.append(least)
    count = np.concatenate(counts).astype(np.int64)
    size, least = np.concatenate(sizes).astype(np.int64), np.concatenate(ids)
    begin = np.cumsum(count) - count
    numbers: dict[int, dict[bytes, int]] = {bucket: {} for bucket in told}
    firsts, owners, chosen = [], [], []
    for bucket, _, first, owner, content in b.candidates(decoded(row["answers"]), buckets):
        items = numbers.get(bucket)
        if items is None:
            continue
        answer = told[bucket].get(items.setdefault(content, len(items)))
        if answer is not None:
            firsts.append(first)
            owners.append(owner)
            chosen.append(answer)
    if not chosen:
        return none, none
    chosen = np.array(chosen)
    n = count[chosen]
    head = np.cumsum(n) - n
    at = np.arange(int(n.sum())) + np.repeat(begin[chosen] - head, n)
    width = size[at]
    before = np.cumsum(width) - width
    open_ = before + np.repeat(np.array(firsts) - before[head], n)
    lower = least[at] < np.repeat(np.array(owners), n)
    return open_[lower], (open_ + width - 1 + b.length)[lower]


CLEANED = "id bigint, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, kept binary"


def _cleaned(batches: Iterator[pa.RecordBatch], length: int, buckets: int) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        b = _Batch(row, length)
        open_, close = _hits(b, row, buckets)
        change = np.zeros(len(b.data) + 1, np.int32)
        np.add.at(change, open_, 1)
        np.subtract.at(change, close, 1)
        gone = np.cumsum(change[:-1], out=change[:-1]) > 0
        spans, bodies = [], []
        for s, size in zip(b.starts.tolist(), b.sizes.tolist()):
            mine = gone[s : s + size]
            if not mine.any():
                spans.append([])
                bodies.append(b.data[s : s + size])
                continue
            flips = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
            spans.append([{"start": x, "stop": y} for x, y in flips.reshape(-1, 2).tolist()])
            bodies.append(b.body[s : s + size][~mine].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.ids, pa.int64()), pa.array(b.sizes, pa.int64()), pa.array(spans, span), pa.array(bodies, pa.binary())],
            names=["id", "n_bytes", "spans", "kept"],
        )


def remove_repeats(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``spans`` (removed runs of bytes: start, stop) and ``kept`` (the
    remaining bytes).  It reads tables of ``scratch``, which must stay open until the result is stored.

    Texts are UTF-8 bytes; a null text is empty.  A byte goes when a string of ``length`` bytes (at least
    ``SEED_BYTES``) that covers it starts in a document with a smaller id as well; strings overlap, and are judged on
    the texts as they came.  Rows with one id do not remove from each other; a null id is later than all others, and
    rows without id leave each other alone.  Texts shorter than ``length`` stay whole.  Repeated rows come back each;
    other columns are not read; an empty table gives an empty result.
    """
    if length < SEED_BYTES:
        raise ValueError(f"length must be at least {SEED_BYTES}")
    n = partitions(docs.sparkSession)
    buckets = BUCKETS_PER_PARTITION * n
    stored = scratch.bucketed(gathered(docs, id_column, text_column), "batch", n)
    asked = stored.mapInArrow(lambda b: _first_request(b, length, buckets), REQUEST)
    seen = scratch.table(by_batch(levels(asked, (1, hot))))
    known = stored.join(seen, "batch", "left")
    sent = known.mapInArrow(lambda b: _second_request(b, length, buckets), ASKED)
    found = sent.groupBy("bucket").applyInArrow(lambda rows: _matched(rows, length), FOUND)
    matches = found.groupBy("batch").agg(
        F.collect_list(F.struct("bucket", "n", "runs", "packed")).alias("matches")
    )
    out = known.join(scratch.table(matches), "batch", "left")
    cleaned = out.mapInArrow(lambda b: _cleaned(b, length, buckets), CLEANED)
    return cleaned.select(real_id("id").alias("doc_id"), "n_bytes", "spans", "kept")
