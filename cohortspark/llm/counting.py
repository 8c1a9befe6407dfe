"""Counting hashed keys over batches: every batch asks for the total of each of its distinct keys and gets it back.

A batch sends each key once, so a key that is in a third of all rows costs one entry per batch.  Requests go as packed
rows, one per (batch, bucket); a bucket is a range of the hash, so no bucket grows with one key.

Where it is enough to know which of a few limits a total exceeds, and a rare chance meeting of two keys does no harm,
``marks`` and ``levels`` send 32 bits of a key and get back one bit per limit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY_BITS = 48  # of a key inside its bucket; the bucket adds more
BUCKETS_PER_PARTITION = 8
SHORT_BITS = 32  # of a key inside its bucket where chance meetings do no harm
REQUEST = "bucket int, batch string, keys binary, counts binary"
RESPONSE = "batch string, bucket int, totals binary, known bigint"

_U = np.uint64


def dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, bucket, starts): distinct hashes sorted by (bucket, key), and where each bucket begins."""
    bucket = (hashes % _U(buckets)).astype(np.int64)
    order = np.lexsort((hashes, bucket))
    ordered = bucket[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    return order, ordered, starts


def packed_keys(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of each hash, as all 32-bit halves and then all 16-bit ones."""
    top = hashes >> _U(64 - KEY_BITS)
    return (top & _U(0xFFFFFFFF)).astype(np.uint32).tobytes() + (top >> _U(32)).astype(np.uint16).tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    n = len(data) // 6
    low = np.frombuffer(data, np.uint32, n).astype(_U)
    return low | np.frombuffer(data, np.uint16, n, 4 * n).astype(_U) << _U(32)


def requests(batch: str, hashes: np.ndarray, counts: np.ndarray, buckets: int, first: int = 0) -> list[dict]:
    """Request rows of a batch; its distinct hashes must come back in the same order at ``answers``."""
    order, ordered, starts = dealt(hashes, buckets)
    rows = []
    for s, e in zip(starts, [*starts[1:], len(order)]):
        at = order[s:e]
        rows.append(
            {
                "bucket": first + int(ordered[s]),
                "batch": batch,
                "keys": packed_keys(hashes[at]),
                "counts": counts[at].astype(np.uint32).tobytes(),
            }
        )
    return rows


def answers(hashes: np.ndarray, buckets: int, first: int, found: dict[int, bytes]) -> np.ndarray:
    """Totals of the hashes, from the response rows of the batch by bucket."""
    order, ordered, starts = dealt(hashes, buckets)
    totals = np.zeros(len(hashes), np.int64)
    for s, e in zip(starts, [*starts[1:], len(order)]):
        data = found[first + int(ordered[s])]
        totals[order[s:e]] = np.frombuffer(data, np.uint32 if len(data) == 4 * (e - s) else np.uint64)
    return totals


def _summed(rows: pa.Table) -> pa.Table:
    """Totals of one bucket: equal keys of all its batches are added up."""
    keys = [unpacked_keys(x.as_py()) for x in rows.column("keys")]
    counts = [np.frombuffer(x.as_py(), np.uint32) for x in rows.column("counts")]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.uint64)
    if int(totals.max()) < 2**32:
        totals = totals.astype(np.uint32)
    known = int((totals > 0).sum())
    back = np.split(totals[place], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table(
        {
            "batch": rows.column("batch"),
            "bucket": rows.column("bucket"),
            "totals": pa.array([b.tobytes() for b in back], pa.binary()),
            "known": pa.array([known] * len(back), pa.int64()),
        }
    )


def totals(asked: DataFrame) -> DataFrame:
    """Response rows to request rows.  ``known`` is how many keys of the bucket have a total above zero."""
    return asked.groupBy("bucket").applyInArrow(_summed, RESPONSE)


def _split(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, Iterator[tuple[int, int, int]]]:
    """(order, (bucket, start, stop) of each bucket in it)."""
    order, ordered, starts = dealt(hashes, buckets)
    stops = [*starts[1:].tolist(), len(order)]
    return order, zip(ordered[starts].tolist(), starts.tolist(), stops)


def marks(batch: str, hashes: np.ndarray, counts: np.ndarray, buckets: int) -> list[dict]:
    """Request rows like those of ``requests``, counts above 65,535 as that: of the sorted keys the steps go, byte by byte."""
    order, parts = _split(hashes, buckets)
    keys = (hashes >> _U(64 - SHORT_BITS)).astype(np.uint32)[order]
    counts = np.minimum(counts[order], 0xFFFF).astype(np.uint16)
    rows = []
    for bucket, s, e in parts:
        steps = np.diff(keys[s:e], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4)
        rows.append(
            {
                "bucket": bucket,
                "batch": batch,
                "keys": pa.compress(steps.T.tobytes(), codec="zstd", asbytes=True),
                "counts": counts[s:e].tobytes(),
            }
        )
    return rows


def _levelled(rows: pa.Table, limits: Sequence[int]) -> pa.Table:
    """Of one bucket: for each key of each batch, one bit per limit that its total exceeds."""
    counts = [np.frombuffer(x.as_py(), np.uint16) for x in rows.column("counts")]
    keys = []
    for x, c in zip(rows.column("keys").to_pylist(), counts):
        steps = pa.decompress(x, decompressed_size=4 * len(c), codec="zstd", asbytes=True)
        planes = np.frombuffer(steps, np.uint8).reshape(4, -1)
        keys.append(np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32))
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(place, np.concatenate(counts), len(distinct))
    bits = [(totals > x)[place] for x in limits]
    back, at = [], 0
    for k in keys:
        back.append(b"".join(np.packbits(b[at : at + len(k)]).tobytes() for b in bits))
        at += len(k)
    known = pa.array([len(distinct)] * len(back), pa.int64())
    return pa.table({"batch": rows.column("batch"), "bucket": rows.column("bucket"), "totals": pa.array(back, pa.binary()), "known": known})


def levels(asked: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Response rows to the rows of ``marks``, by the ``limits``."""
    return asked.groupBy("bucket").applyInArrow(lambda rows: _levelled(rows, limits), RESPONSE)


def levels_of(hashes: np.ndarray, buckets: int, found: dict[int, bytes], limits: int) -> np.ndarray:
    """How many of the limits the total of each hash exceeds."""
    order, parts = _split(hashes, buckets)
    out = np.zeros(len(hashes), np.uint8)
    for bucket, s, e in parts:
        bits = np.frombuffer(found[bucket], np.uint8).reshape(limits, -1)
        out[order[s:e]] = np.unpackbits(bits, axis=1, count=e - s).sum(0, dtype=np.uint8)
    return out


def by_batch(responses: DataFrame) -> DataFrame:
    """All responses of a batch as one row ``batch, answers``; what they hold is bounded by the batch."""
    return responses.groupBy("batch").agg(F.collect_list(F.struct("bucket", "totals")).alias("answers"))


def decoded(value: pa.Scalar) -> dict[int, bytes]:
    """The column ``answers`` of one row."""
    items = value.values
    if items is None:
        return {}
    return dict(zip(items.field("bucket").to_pylist(), items.field("totals").to_pylist()))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, pa.Scalar]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
