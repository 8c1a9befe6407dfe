"""Quality rules: base counts of a text, and a linear-chain conditional random field that marks every line as content
or boilerplate by Viterbi decoding; the share of words in content lines decides whether a document stays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import text_of

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
CONTINUED = bytes(range(0x80, 0xC0))  # all bytes of a UTF-8 text but the first of each code point
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of the words

#: Bounds of the sample that the field is fitted on.  Everything else covers all documents.
TRAIN_DOCS = 600  # of either label, by hash of the id
TRAIN_LINES = 64  # of each
KEEP_SHARE = 0.5

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGITS = b"0123456789"
_NOT_UPPER = bytes(b for b in range(256) if b not in _UPPER)
_NOT_LOWER = bytes(b for b in range(256) if b not in _LOWER)
_NOT_DIGIT = bytes(b for b in range(256) if b not in _DIGITS)
_NOT_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)

# upper bounds of the steps of each feature; a value beyond the last falls in one more step
STEPS = (
    (1, 3, 7, 15, 31),  # words
    (0, 20, 50, 100, 200),  # symbols per 1000 bytes
    (0, 20, 60, 120),  # exclamation marks per 1000 bytes
    (0, 50, 200, 500),  # upper-case among ASCII letters, per 1000
    (0, 30, 100, 300),  # digits per 1000 bytes
    (0, 1),  # last byte: sentence end, other punctuation, anything else
    (0,),  # equal to an earlier line
    (300, 500, 700, 850),  # distinct words per 1000 words
    (3000, 5000, 7000, 9000),  # bytes per 1000 words
)
FEATURES = len(STEPS)
WIDTH = max(len(s) for s in STEPS) + 1


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text, first ones included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter([known.setdefault(w, len(known)) for w in words], np.int64, len(words))
    if len(known) == len(words):
        return 0
    keys, base = ids[:n], len(known)
    for i in range(1, window):
        if int(keys.max()) + 1 >= 2**62 // base:  # number the prefixes anew before the product overflows
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * base + ids[i : i + n]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))
    change = np.zeros(len(words) + 1, np.int64)
    change[at] += 1
    np.subtract.at(change, at + window, 1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def line_features(text: bytes) -> tuple[list[tuple[int, ...]], list[int], int]:
    """Feature values and word counts of the lines that have words, and how many of them equal an earlier line."""
    rows, sizes, seen, repeats = [], [], set(), 0
    for line in text.split(b"\n"):
        words = line.split()
        n = len(words)
        if not n:
            continue
        again = line in seen
        repeats += again
        seen.add(line)
        size = len(line)
        upper, lower = len(line.translate(None, _NOT_UPPER)), len(line.translate(None, _NOT_LOWER))
        last = line.rstrip()[-1]
        rows.append(
            (
                n,
                1000 * len(line.translate(None, _NOT_SYMBOL)) // size,
                1000 * line.count(b"!") // size,
                1000 * upper // (upper + lower + 1),
                1000 * len(line.translate(None, _NOT_DIGIT)) // size,
                0 if last in b".?" else 1 if last < 128 and not chr(last).isalnum() else 2,
                int(again),
                1000 * len(set(words)) // n,
                1000 * size // n,
            )
        )
        sizes.append(n)
    return rows, sizes, repeats


def coded(rows: list[tuple[int, ...]]) -> np.ndarray:
    """Feature values as steps, one row of small numbers per line."""
    values = np.array(rows, np.int64).reshape(-1, FEATURES)
    return np.stack([np.searchsorted(STEPS[f], values[:, f]) for f in range(FEATURES)], axis=1).astype(np.uint8)


@dataclass(frozen=True)
class Field:
    """Weights of a chain with the states boilerplate (0) and content (1)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # feature, step, state

    def scores(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.emit[f, codes[:, f]] for f in range(FEATURES))

    def decode(self, codes: np.ndarray) -> list[int]:
        """Most likely states (Viterbi); of equal paths the one that prefers content."""
        if not len(codes):
            return []
        (m00, m01), (m10, m11) = self.move.tolist()
        each = self.scores(codes).tolist()
        a, b = self.start[0] + each[0][0], self.start[1] + each[0][1]
        back = []
        for e0, e1 in each[1:]:
            from0, from1 = b + m10 >= a + m00, b + m11 >= a + m01
            back.append((from0, from1))
            a, b = (b + m10 if from0 else a + m00) + e0, (b + m11 if from1 else a + m01) + e1
        state = int(b >= a)
        states = [state]
        for from0, from1 in reversed(back):
            state = int(from1 if state else from0)
            states.append(state)
        return states[::-1]


def fit_field(lines: list[np.ndarray], labels: list[int], rounds: int = 120, rate: float = 0.5, shrink: float = 1e-3) -> Field:
    """Field fitted to line codes whose lines all carry the document's label: gradient ascent on the log likelihood
    with forward and backward sums, all documents of one length step at a time."""
    order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
    n, longest = len(order), len(lines[order[0]])
    live = np.array([sum(len(lines[i]) > t for i in order) for t in range(longest)])
    codes = np.zeros((longest, n, FEATURES), np.uint8)
    for j, i in enumerate(order):
        codes[: len(lines[i]), j] = lines[i]
    y = np.array([labels[i] for i in order])
    start, move, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((FEATURES, WIDTH, 2))
    total = live.sum()
    onehot = np.eye(2)[y]
    grads = [np.zeros_like(x) for x in (start, move, emit)]
    for r in range(rounds):
        e = sum(emit[f, codes[:, :, f]] for f in range(FEATURES))
        forward, backward = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
        forward[0] = start + e[0]
        for t in range(1, longest):
            k = live[t]
            forward[t, :k] = np.logaddexp.reduce(forward[t - 1, :k, :, None] + move, axis=1) + e[t, :k]
        for t in range(longest - 2, -1, -1):
            k = live[t + 1]
            backward[t, :k] = np.logaddexp.reduce(move + (e[t + 1, :k] + backward[t + 1, :k])[:, None, :], axis=2)
        z = np.logaddexp.reduce(forward[0] + backward[0], axis=1)
        d_start = onehot.sum(0) - np.exp(forward[0] + backward[0] - z[:, None]).sum(0)
        d_move, d_emit = np.zeros((2, 2)), np.zeros_like(emit)
        for t in range(longest):
            k = live[t]
            rest = onehot[:k] - np.exp(forward[t, :k] + backward[t, :k] - z[:k, None])
            for f in range(FEATURES):
                for s in range(2):
                    d_emit[f, :, s] += np.bincount(codes[t, :k, f], rest[:, s], WIDTH)
            if t:
                pair = forward[t - 1, :k, :, None] + move + (e[t, :k] + backward[t, :k])[:, None, :] - z[:k, None, None]
                d_move += np.einsum("ki,kj->ij", onehot[:k], onehot[:k]) - np.exp(pair).sum(0)
        for x, d, g in zip((start, move, emit), (d_start, d_move, d_emit), grads):
            step = d / total - shrink * x
            g += step * step  # steps shrink per weight with what was gone already
            x += rate * step / np.sqrt(g + 1e-12)
    return Field(start, move, emit)


def _training(batches: Iterator[pa.RecordBatch], most_lines: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [coded(line_features(t.as_py())[0])[:most_lines].tobytes() for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lines, pa.binary())], names=["id", "quality", "lines"]
        )


def train_field(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    most_docs: int = TRAIN_DOCS,
    most_lines: int = TRAIN_LINES,
) -> Field | None:
    """Field fitted to at most ``most_docs`` labelled documents of either label (by hash of the id) and their first
    ``most_lines`` lines; None unless both labels have documents with words."""
    known = (
        labels.select(F.col(id_column).cast("bigint").alias("id"), F.col(label_column).cast("int").alias("quality"))
        .filter("id is not null and quality in (0, 1)")
        .groupBy("id")
        .agg(F.min("quality").alias("quality"))
    )
    some = [known.filter(F.col("quality") == q).orderBy(F.xxhash64("id"), "id").limit(most_docs) for q in (0, 1)]
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), text_of(text_column).cast("binary").alias("body"))
    chosen = rows.join(F.broadcast(some[0].unionByName(some[1])), "id")  # at most 2 * most_docs rows
    # repeated ids could make the sample larger than its bound: one document for each
    chosen = chosen.groupBy("id").agg(F.first("quality").alias("quality"), F.min("body").alias("body"))
    found = chosen.mapInArrow(lambda b: _training(b, most_lines), "id bigint, quality int, lines binary").collect()
    sample = [(r["quality"], np.frombuffer(r["lines"], np.uint8).reshape(-1, FEATURES)) for r in sorted(found)]
    sample = [(q, x) for q, x in sample if len(x)]
    if len({q for q, _ in sample}) < 2:
        return None
    return fit_field([x for _, x in sample], [q for q, _ in sample])


OUTPUT = (
    "id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, content_lines bigint, content_words bigint"
)


def _measured(batches: Iterator[pa.RecordBatch], field: Field | None) -> Iterator[pa.RecordBatch]:
    names = [c.split(" ")[0] for c in OUTPUT.split(", ")]
    for batch in batches:
        rows = []
        features: list[tuple[int, ...]] = []
        spans = []
        for body in batch.column(1):
            text = body.as_py()
            words = text.split()
            lines, sizes, repeats = line_features(text)
            spans.append((len(features), sizes))
            features += lines
            rows.append(
                [
                    len(words),
                    len(text.translate(None, SPACES + CONTINUED)),
                    len(text.translate(None, _NOT_SYMBOL)),
                    repeats,
                    repeated_words(words),
                    len(lines),
                ]
            )
        codes = coded(features)
        for row, (at, sizes) in zip(rows, spans):
            states = field.decode(codes[at : at + len(sizes)]) if field else [1] * len(sizes)
            row += [sum(states), sum(n for n, s in zip(sizes, states) if s)]
        columns = list(zip(*rows)) or [[]] * (len(names) - 1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], names=names
        )


def _verdicts() -> dict:
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    share = F.when(F.col("n_words") > 0, F.col("content_words") / F.col("n_words")).otherwise(0.0)
    return {"base_failed": failed, "content_share": share, "kept": ~failed & (share >= KEEP_SHARE)}


def judge(docs: DataFrame, field: Field | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines,
    content_lines, content_words, base_failed, content_share, kept.

    Lines are cut at newlines; those without words are skipped.  Without a field every line is content.  Null and
    empty texts have no words and fail.  Null ids and repeated rows come back as they are; other columns are not
    read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), text_of(text_column).cast("binary").alias("body"))
    out = rows.mapInArrow(lambda batches: _measured(batches, field), OUTPUT)
    return out.withColumnRenamed("id", "doc_id").withColumns(_verdicts())


def keep_good(docs: DataFrame, field: Field | None, text_column: str = "text") -> DataFrame:
    """The documents that ``judge`` keeps, all columns unchanged, without a shuffle.

    Only the texts go to Python, and a yes or no comes back; the rows stay where they are.  A document with a null or
    empty text goes, null ids and repeated rows are judged like any other, an empty table stays empty.
    """

    @F.arrow_udf("boolean")
    def good(bodies: pa.Array) -> pa.Array:
        out = []
        for part in _parts(bodies):
            ids = pa.nulls(len(part), pa.int64())
            (row,) = _measured([pa.RecordBatch.from_arrays([ids, part], names=["id", "body"])], field)
            n, repeated, content = (row.column(i).to_numpy(zero_copy_only=False) for i in (1, 5, 8))
            out.append((n >= LEAST_WORDS) & (100 * repeated <= MOST_REPEATED * n) & (content >= KEEP_SHARE * n))
        return pa.array(np.concatenate(out) if out else [], pa.bool_())

    return docs.filter(good(text_of(text_column).cast("binary")))


PART_BYTES = 2 << 20  # texts whose features are held at once, but for a single longer one


def _parts(bodies: pa.Array) -> Iterator[pa.Array]:
    """The array in slices of up to ``PART_BYTES``."""
    start, size = 0, 0
    for i, body in enumerate(bodies):
        n = len(body.as_buffer()) if body.is_valid else 0
        if i > start and size + n > PART_BYTES:
            yield bodies.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(bodies) > start:
        yield bodies.slice(start)
