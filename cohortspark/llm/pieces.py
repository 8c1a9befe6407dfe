"""SentencePiece encoding and decoding with the n best segmentations.

Over the lattice of pieces a forward Viterbi pass gives the best score of every prefix; a backward A* search then uses
it as its exact estimate, so segmentations come out best first and nothing is expanded in vain.

No piece runs on from another character into the space mark, so the lattice of a text is a chain of small lattices, one
per word with the marks before it, which share no edge.  Each is searched once and remembered; the n best of the text
are the n best choices along the chain.
"""

from __future__ import annotations

import gc
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import text_of

MARK = "▁"  # stands for a space, as in the vocabulary files
UNIT = 1_000_000  # scores are whole millionths of a nat, so sums are exact in any order
UNKNOWN_NATS = 10
NEVER = 2**62
REMEMBERED = 350_000  # words whose segmentations a task keeps, and as many from before
LONGEST_REMEMBERED = 64  # characters


@dataclass(frozen=True)
class Pieces:
    """A vocabulary.  ``prefixes`` holds every piece with its score and id (as a tuple), and every beginning of a piece
    that is none itself with None; further the ids of the 256 byte pieces, the bytes each id decodes to, and the score
    of a character without a piece."""

    prefixes: dict[str, tuple[int | None, tuple[int, ...]]]
    byte_ids: tuple[int, ...]
    decoded: tuple[bytes, ...]
    unknown: int


def load_pieces(path: str) -> Pieces:
    """Vocabulary of a SentencePiece model file with byte fallback.

    A BPE file has merge ranks in place of log probabilities; they are read by Zipf's law, the piece of rank ``r`` with
    weight ``1 / (r + 2)``.  A unigram file's scores are taken as they are.  A character without a piece costs
    ``UNKNOWN_NATS`` more than the rarest piece and is written as its bytes.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    usable = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    raw = {i: model.get_score(i) for i in usable}
    ranked = all(s <= 0 and s == int(s) for s in raw.values())
    nats = {i: -log(2 - s) if ranked else s for i, s in raw.items()}
    scores = {model.id_to_piece(i): (round(s * UNIT), i) for i, s in nats.items()}
    byte_ids = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
    back = [b""] * n
    for piece, (_, i) in scores.items():
        back[i] = piece.replace(MARK, " ").encode()
    for b, i in enumerate(byte_ids):
        back[i] = bytes([b])
    worst = min(s for s, _ in scores.values())
    prefixes: dict[str, tuple] = {p[:k]: (None, ()) for p in scores for k in range(1, len(p))}
    prefixes |= {p: (s, (i,)) for p, (s, i) in scores.items()}
    return Pieces(prefixes, byte_ids, tuple(back), worst - UNKNOWN_NATS * UNIT)


def _lattice(word: str, pieces: Pieces) -> tuple[list[list[tuple]], list[int], list[int]]:
    """Edges (start, score, ids) into each place, with the forward Viterbi pass over them: the best score of every
    prefix, and the edge that ends it (of equal ones the longest)."""
    get, n = pieces.prefixes.get, len(word)
    into: list[list[tuple]] = [[] for _ in range(n + 1)]
    ahead, edge = [-NEVER] * (n + 1), [-1] * (n + 1)
    ahead[0] = 0
    for i in range(n):
        here = ahead[i]
        j = i + 1
        hit = get(word[i:j])
        if hit is None or hit[0] is None:  # no piece for this character alone
            spelled = (" " if word[i] == MARK else word[i]).encode()
            into[j].append((i, pieces.unknown, tuple([pieces.byte_ids[b] for b in spelled])))
            if here + pieces.unknown > ahead[j]:
                ahead[j], edge[j] = here + pieces.unknown, len(into[j]) - 1
        while hit is not None:
            score, own = hit
            if score is not None:
                ends = into[j]
                if here + score > ahead[j]:
                    ahead[j], edge[j] = here + score, len(ends)
                ends.append((i, score, own))
            j += 1
            if j > n:
                break
            hit = get(word[i:j])
    return into, ahead, edge


def best_segmentations(word: str, pieces: Pieces, n: int) -> list[tuple[int, tuple[int, ...]]]:
    """The ``n`` best (score, ids) of one lattice, best first; equal scores in the order the search meets them.

    The estimate of a partial path is exact, so the best edge into its place continues it at the same estimate and is
    followed at once; only the other edges wait in the heap.
    """
    into, ahead, edge = _lattice(word, pieces)
    out: list[tuple[int, tuple[int, ...]]] = []
    heap: list[tuple] = [(-ahead[-1], 0, len(word), 0, None)]
    turn = 0
    while heap and len(out) < n:
        _, _, j, gone, path = heappop(heap)
        while j:
            here = into[j]
            for k, (i, s, own) in enumerate(here):
                if k != edge[j]:
                    turn -= 1  # of equal estimates the newest
                    heappush(heap, (-(gone + s + ahead[i]), turn, i, gone + s, (own, path)))
            j, s, own = here[edge[j]]
            gone += s
            path = (own, path)
        ids: list[int] = []
        while path:
            ids += path[0]
            path = path[1]
        out.append((gone, tuple(ids)))
    return out


def _tree(prefixes: dict[str, tuple]) -> dict[str, tuple]:
    """The pieces by character: character to (score or None, ids, the next characters)."""
    root: dict[str, tuple] = {}
    nodes = {"": root}
    for text in sorted(prefixes, key=len):
        nodes[text] = {}
        nodes[text[:-1]][text[-1]] = (*prefixes[text], nodes[text])
    return root


class _Words(dict):
    """Words to (score, packed ids, loss of the second best segmentation, do the ids give the word back), worked out when
    first asked for.  Words of more than ``LONGEST_REMEMBERED`` characters are worked out each time, so what is
    remembered is bounded in bytes."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.tree = _tree(pieces.prefixes)
        self.before: dict[str, tuple[int, bytes, int, bool]] = {}

    def age(self) -> None:
        """Start anew, keeping what was known at hand: words that come again are taken over, the others go next time."""
        self.before = dict(self)
        self.clear()

    def __missing__(self, word: str) -> tuple[int, bytes, int, bool]:
        entry = self.before.get(word)
        if entry is None:
            entry = self._viterbi(word)
        if len(word) <= LONGEST_REMEMBERED:
            self[word] = entry
        return entry

    def _viterbi(self, word: str) -> tuple[int, bytes, int, bool]:
        """Forward pass with the best and the second best score of every prefix; of equal paths into a place the one
        with the longest last piece is best."""
        n, tree, unknown, never = len(word), self.tree, self.pieces.unknown, -(1 << 59)
        ahead, second = [never] * (n + 1), [never] * (n + 1)
        start, last = [0] * (n + 1), [()] * (n + 1)
        ahead[0] = 0
        for i in range(n):
            here, after, branch, j = ahead[i], second[i], tree, i
            hit = tree.get(word[i])
            if hit is None or hit[0] is None:  # no piece for this character alone
                branch = {word[i]: (unknown, self._spelled(word[i]), {} if hit is None else hit[2])}
            while j < n:
                hit = branch.get(word[j])
                if hit is None:
                    break
                score, own, branch = hit
                j += 1
                if score is None:
                    continue
                total, best = here + score, ahead[j]
                if total > best:
                    if best > second[j]:
                        second[j] = best
                    ahead[j], start[j], last[j] = total, i, own
                elif total > second[j]:
                    second[j] = total
                if after > never and after + score > second[j]:
                    second[j] = after + score
        parts, j = [], n
        while j:
            parts.append(last[j])
            j = start[j]
        ids = [i for own in reversed(parts) for i in own]
        back = self.pieces.decoded
        whole = b"".join([back[i] for i in ids]) == word.replace(MARK, " ").encode()
        loss = ahead[n] - second[n] if second[n] > never else NEVER
        return ahead[n], struct.pack(f"<{len(ids)}i", *ids), loss, whole

    def _spelled(self, character: str) -> tuple[int, ...]:
        return tuple([self.pieces.byte_ids[b] for b in (" " if character == MARK else character).encode()])


def openers(whole: Sequence[str]) -> set[str]:
    """Characters that stand behind a letter in no piece: between a letter and one of them a new piece begins."""
    behind = {b for p in whole for a, b in zip(p, p[1:]) if a.isalpha()}
    return {c for p in whole for c in p if c != MARK and not c.isalnum()} - behind


class Encoder:
    """Encodes texts, remembering the words it has seen."""

    def __init__(self, pieces: Pieces, n: int):
        self.pieces, self.n = pieces, n
        whole = [p for p, (s, _) in pieces.prefixes.items() if s is not None and len(p) > 1]
        joined = sorted({c for p in whole for c in p if c != MARK})

        def some(chars) -> str:
            return f"[{''.join(map(re.escape, chars))}]"

        letters, others = [c for c in joined if c.isalpha()], [c for c in joined if not c.isalpha()]
        opening = sorted(openers(whole))
        # up to a letter that an opener follows; else all that pieces may join; a character that no longer piece holds
        # is a lattice of its own
        cut = f"{MARK}*{some(others)}*{some(letters)}+(?={some(opening)})|" if letters and others and opening else ""
        self.words = re.compile(f"{cut}{MARK}*{some(joined)}+|{MARK}+|.", re.DOTALL)
        self.known = _Words(pieces)
        literal = tuple(pieces.byte_ids[b] for b in MARK.encode())
        self.literal = (pieces.unknown, struct.pack("<3i", *literal), NEVER, True)

    def _chain(self, text: str) -> tuple[list[str], list[tuple]]:
        known = self.known
        if MARK not in text:
            words = self.words.findall(MARK + text.replace(" ", MARK))
            return words, [known[w] for w in words]
        words, entries = [], []
        for k, part in enumerate(text.split(MARK)):
            part = part.replace(" ", MARK)
            more = self.words.findall(MARK + part if k == 0 else part)
            if k:
                words.append("")
                entries.append(self.literal)
            words += more
            entries += [known[w] for w in more]
        return words, entries

    def encode(self, text: str) -> tuple[int, bytes, list[tuple[int, list[tuple[int, int, list[int]]]]], bool]:
        """(score, ids as 32-bit numbers, alternatives, do the ids give the text back); an alternative is (score, patches)
        and a patch (start, stop, ids) replaces those places of the best ids.

        The bytes of a text are those of its words in turn, so it comes back when each word does.
        """
        if not text:
            return 0, b"", [], True
        if len(self.known) > REMEMBERED:
            self.known.age()
        words, entries = self._chain(text)
        scores, packed, losses, whole = zip(*entries)
        score = sum(scores)
        # of n segmentations, n - 1 differ from the best; they change only words among the n - 1 cheapest to change
        left, places = list(losses), []
        for _ in range(min(self.n - 1, len(left))):
            least = min(left)
            if least == NEVER:
                break
            places.append(left.index(least))
            left[places[-1]] = NEVER
        return score, b"".join(packed), self._alternatives(words, packed, sorted(places), score), all(whole)

    def _alternatives(self, words: list[str], packed: tuple[bytes, ...], places: list[int], best: int) -> list:
        out: list[tuple[int, list[tuple[int, int, list[int]]]]] = []
        options = [best_segmentations(words[at], self.pieces, self.n) for at in places]
        losses = [[o[0][0] - x[0] for x in o] for o in options]
        begin = [sum(map(len, packed[:at])) // 4 for at in places]
        heap = sorted((losses[k][1], tuple(int(x == k) for x in range(len(places)))) for k in range(len(places)))
        seen = {c for _, c in heap}
        while heap and len(out) < self.n - 1:
            loss, choice = heappop(heap)
            patches = [
                (begin[k], begin[k] + len(packed[places[k]]) // 4, list(options[k][c][1]))
                for k, c in enumerate(choice)
                if c
            ]
            out.append((best - loss, patches))
            for k, c in enumerate(choice):
                if c + 1 < len(options[k]):
                    more = (*choice[:k], c + 1, *choice[k + 1 :])
                    if more not in seen:
                        seen.add(more)
                        heappush(heap, (loss - losses[k][c] + losses[k][c + 1], more))
        return out


def decode(ids: Sequence[int], pieces: Pieces) -> str:
    """The text of ids: bytes of the pieces, without the space put in front."""
    data = b"".join([pieces.decoded[i] for i in ids])
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


ENCODED = (
    "id bigint, score double, ids binary, "
    "alternatives array<struct<score:double,patches:array<struct<start:int,stop:int,ids:array<int>>>>>, whole boolean"
)
_PATCH = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("ids", pa.list_(pa.int32()))])
_ALTERNATIVE = pa.struct([("score", pa.float64()), ("patches", pa.list_(_PATCH))])


_LATEST: list[Encoder] = []


def _encoder(pieces: Pieces, n: int) -> Encoder:
    """The worker's encoder from an earlier task with the same vocabulary, with the words it remembers, or a new one."""
    if not (_LATEST and _LATEST[0].pieces is pieces and _LATEST[0].n == n):
        _LATEST[:] = [Encoder(pieces, n)]
        gc.freeze()  # the vocabulary lives as long as the worker; collections need not walk it
    return _LATEST[0]


def _encoded(batches: Iterator[pa.RecordBatch], pieces, n: int) -> Iterator[pa.RecordBatch]:
    vocabulary = pieces.value
    encoder = _encoder(vocabulary, n)
    for batch in batches:
        scores, ids, others, whole = [], [], [], []
        for text in batch.column(1):
            body = text.as_py()
            score, best, more, back = encoder.encode(body)
            scores.append(score / UNIT)
            ids.append(best)
            others.append(
                [
                    {"score": s / UNIT, "patches": [{"start": a, "stop": b, "ids": x} for a, b, x in patches]}
                    for s, patches in more
                ]
            )
            whole.append(back)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(scores, pa.float64()),
                pa.array(ids, pa.binary()),
                pa.array(others, pa.list_(_ALTERNATIVE)),
                pa.array(whole, pa.bool_()),
            ],
            names=["id", "score", "ids", "alternatives", "whole"],
        )


def encode_texts(
    docs: DataFrame, model_path: str, n_best: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, score (nats), ids (32-bit numbers, packed), alternatives, whole.

    ``alternatives`` are the next ``n_best - 1`` segmentations, best first, as patches to ``ids``; fewer where the
    lattice has fewer paths.  ``whole`` tells that decoding the ids gives the text back.  A literal space mark in a
    text is written as bytes.  Null and empty texts have no ids.  Null ids and repeated rows come back as they are;
    other columns are not read; an empty table gives an empty result.  The vocabulary is read on the driver and
    broadcast; its size is that of the model file.
    """
    spark = docs.sparkSession
    pieces = spark.sparkContext.broadcast(load_pieces(model_path))
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), text_of(text_column).alias("body"))
    out = rows.mapInArrow(lambda batches: _encoded(batches, pieces, n_best), ENCODED)
    return out.withColumnRenamed("id", "doc_id")


def decode_texts(encoded: DataFrame, model_path: str, ids_column: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of the packed ids (null for null)."""
    pieces = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids_column))
            made = [
                None if x.as_py() is None else decode(np.frombuffer(x.as_py(), np.int32).tolist(), pieces.value)
                for x in column
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    schema = encoded.drop("decoded").schema.add("decoded", "string")
    return encoded.drop("decoded").mapInArrow(texts, schema)
