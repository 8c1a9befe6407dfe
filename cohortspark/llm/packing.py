"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents are dealt by hash to groups of bounded size, and each group is packed in one task: pieces in decreasing
length go to the open sequence they fill best; where none has room, the permitted length with the least expected cost
per token is opened; at the end every sequence shrinks to the shortest permitted length that holds its contents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import NULL_ID, SPACE, WORD, text_of

LENGTHS = (512, 1024, 2048, 4096)
#: What a sequence costs besides its length, in tokens: start of a step, padding of its block.
OVERHEAD = 32
GROUP = 2048  # documents per group on average
GROUP_BYTES = 48 << 20  # text that one task packs at once


@dataclass
class Bin:
    size: int
    used: int
    items: list[int]


class _Levels:
    """Numbers below ``top + 1`` with lookup of the nearest present one: one bit each in a long integer."""

    def __init__(self) -> None:
        self.bits = 0

    def add(self, i: int) -> None:
        self.bits |= 1 << i

    def drop(self, i: int) -> None:
        self.bits &= ~(1 << i)

    def at_least(self, i: int) -> int | None:
        rest = self.bits >> i
        return i + (rest & -rest).bit_length() - 1 if rest else None

    def at_most(self, i: int) -> int | None:
        rest = self.bits & ((1 << (i + 1)) - 1)
        return rest.bit_length() - 1 if rest else None


def _shrunk(used: int, lengths: Sequence[int]) -> int:
    return next(s for s in lengths if s >= used)


def _opened(item: int, left: dict[int, int], levels: _Levels, lengths: Sequence[int], overhead: int) -> int:
    """The permitted length with the least cost per token when it is filled with what is left, largest first; the
    length counted is the one the sequence shrinks to.  Of equal costs the shorter."""
    best, price = lengths[-1], None
    for size in lengths:
        if size < item:
            continue
        room, used, taken = size - item, item, {}
        at = levels.at_most(room)
        while at:
            n = min(room // at, left[at] - taken.get(at, 0))
            taken[at] = taken.get(at, 0) + n
            room, used = room - n * at, used + n * at
            at = levels.at_most(min(room, at - 1)) if room and at > 1 else None
        cost = (_shrunk(used, lengths) + overhead) / max(used, 1)
        if price is None or cost < price:
            best, price = size, cost
    return best


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS, overhead: int = OVERHEAD) -> list[Bin]:
    """Bins over the indices of ``sizes``, none of which is above the largest length."""
    lengths = sorted(lengths)
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    left: dict[int, int] = {}
    for s in sizes:
        left[s] = left.get(s, 0) + 1
    levels, rooms = _Levels(), _Levels()
    for s in left:
        levels.add(s)
    open_: dict[int, list[Bin]] = {}
    bins = []
    for i in order:
        size = sizes[i]
        left[size] -= 1
        if not left[size]:
            levels.drop(size)
        room = rooms.at_least(size)
        if room is None:
            found = Bin(_opened(size, left, levels, lengths, overhead), 0, [])
            bins.append(found)
        else:
            found = open_[room].pop()
            if not open_[room]:
                rooms.drop(room)
        found.items.append(i)
        found.used += size
        rest = found.size - found.used
        open_.setdefault(rest, []).append(found)
        rooms.add(rest)
    for b in bins:
        b.size = _shrunk(b.used, lengths)
    return bins


_WORD = re.compile(WORD.encode())
OUTPUT = (
    "bin_group bigint, bin_number int, capacity int, used int, "
    "pieces array<struct<doc_id:bigint,start:int,n_tokens:int>>, text string"
)


def pieces_of(body: bytes | None, tokens: int, longest: int) -> Iterator[tuple[int, int, bytes]]:
    """(first token, tokens, text) of the pieces of a text of ``tokens`` words and end mark; only the last piece of a
    text above ``longest`` may be shorter than that.  A piece runs up to where the next one's first word begins."""
    if tokens <= longest:
        yield 0, tokens, body or b""
        return
    cuts = {}
    if body is not None:
        cuts = {i: m.start() for i, m in enumerate(_WORD.finditer(body)) if i % longest == 0}
        cuts[0] = 0
    for start in range(0, tokens, longest):
        n = min(longest, tokens - start)
        text = body[cuts.get(start, len(body)) : cuts.get(start + longest, len(body))] if body is not None else b""
        yield start, n, text


def _packed(
    batches: Iterator[pa.RecordBatch], lengths: Sequence[int], overhead: int, end: str, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    longest = max(lengths)
    held: list[tuple] = []
    group, size, docs, number = None, 0, 0, 0

    def flush() -> pa.RecordBatch:
        rows = []
        for at, b in enumerate(pack([x[2] for x in held], lengths, overhead)):
            items = [held[i] for i in b.items]
            pieces = [{"doc_id": None if x[0] == NULL_ID else x[0], "start": x[1], "n_tokens": x[2]} for x in items]
            text = b"".join(x[3] + x[4] for x in items) if held[0][3] is not None else None
            rows.append(
                {
                    "bin_group": group,
                    "bin_number": number + at,
                    "capacity": b.size,
                    "used": b.used,
                    "pieces": pieces,
                    "text": text.decode() if text is not None else None,
                }
            )
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    mark = end.encode()
    for batch in batches:
        columns = [batch.column(i) for i in range(4)]
        for i in range(batch.num_rows):
            g, ident, tokens, body = (c[i].as_py() for c in columns)
            if held and (g != group or size > GROUP_BYTES or docs >= 4 * GROUP):
                out = flush()
                yield out
                number = number + out.num_rows if g == group else 0
                held, size, docs = [], 0, 0
            group = g
            docs += 1
            for start, n, text in pieces_of(body, tokens, longest):
                last = start + n == tokens
                held.append((ident, start, n, text if body is not None else None, mark if last else b""))
                size += len(text) + 64
    if held:
        yield flush()


def pack_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lengths: Sequence[int] = LENGTHS,
    overhead: int = OVERHEAD,
    with_text: bool = True,
    end: str = "\n",
) -> DataFrame:
    """One row per sequence: ``bin_group``, ``bin_number``, ``capacity``, ``used``, ``pieces`` (doc_id, start,
    n_tokens) and ``text`` (null unless ``with_text``).

    A document counts its words between ASCII white space and one end mark, written as ``end``.  Longer ones than the
    largest of ``lengths`` are cut into pieces of it; all pieces of all documents are in exactly one sequence.  Null
    and empty texts are one end mark.  Repeated rows are packed each; null ids stay null; other columns are not read;
    an empty table gives no sequence.  Documents are dealt by a hash of id and text, so results do not depend on the
    order of the input; a group that grows too large, of rows alike in both, is packed in parts.
    """
    groups = max(1, -(-docs.count() // GROUP))
    body = text_of(text_column)
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_column).cast("bigint"), body), F.lit(groups)).alias("g"),
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(NULL_ID)).alias("id"),
        token_count(text_column).alias("n"),
        (body.cast("binary") if with_text else F.lit(None).cast("binary")).alias("body"),
        F.xxhash64(body).alias("h"),
    )
    dealt = rows.repartition("g").sortWithinPartitions("g", "id", "h").drop("h")
    piece = pa.struct([("doc_id", pa.int64()), ("start", pa.int32()), ("n_tokens", pa.int32())])
    schema = pa.schema(
        [
            ("bin_group", pa.int64()),
            ("bin_number", pa.int32()),
            ("capacity", pa.int32()),
            ("used", pa.int32()),
            ("pieces", pa.list_(piece)),
            ("text", pa.string()),
        ]
    )
    sizes = tuple(sorted(lengths))
    return dealt.mapInArrow(lambda b: _packed(b, sizes, overhead, end, schema), OUTPUT)


def token_count(column: str = "text") -> Column:
    """Words between ASCII white space and one end mark."""
    words = F.split(F.regexp_replace(text_of(column), rf"^{SPACE}|{SPACE}$", ""), SPACE)
    return F.when(words[0] == "", 1).otherwise(F.size(words) + 1).cast("int")
