"""Language-model scoring by deleted interpolation.

The model mixes the maximum-likelihood estimates of bigrams, unigrams and a uniform word; the mixture weights depend on
how often the context was seen.  They are learned by expectation-maximisation on held-out counts: each training
occurrence is taken out of the counts before it is predicted.

Texts are tokenised once into batches of word numbers, stored as a bucketed table; words and bigrams are counted by
``counting``, and each batch works out its scores from the totals it gets back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import NULL_ID, Scratch, gather, kept, mixed, partitions, real_id, text_of
from cohortspark.llm.counting import (
    BUCKETS_PER_PARTITION,
    REQUEST,
    answers,
    by_batch,
    decoded,
    requests,
    rows_of,
    totals,
)

START, END = 0, 1  # word numbers of every batch; the words themselves follow
FOLDS, HELD_OUT = 7, 2
BINS_PER_OCTAVE = 4
ROUNDS = 60
BUCKETS = 32  # of the context count, by powers of two
ENCODED = "batch string, ids binary, sizes binary, trains binary, words binary, tokens binary"

_U = np.uint64


def training_part(id_column: str = "doc_id") -> Column:
    """Whether a document is learned from: the CRC-32 of its id as text is not 2 modulo 7 (a null id counts as '')."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS != HELD_OUT


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batch rows: word hashes (start, end, then in order of first use) and the texts as word numbers, end included.
    The sign of a row's id column tells nothing; whether it is trained on comes as the first byte of the body."""
    for row in rows_of(gather(batches)):
        body = row["body"].as_py()
        numbers: dict[bytes, int] = {b" ": START, b"\n": END}
        tokens: list[int] = []
        sizes, trains, at = [], [], 0
        for size in np.frombuffer(row["sizes"].as_py(), np.int64).tolist():
            trains.append(body[at])
            words = body[at + 1 : at + size].lower().split()
            tokens += [numbers.setdefault(w, len(numbers)) for w in words]
            tokens.append(END)
            sizes.append(len(words) + 1)
            at += size
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), _U, len(numbers))
        yield pa.RecordBatch.from_pydict(
            {
                "batch": pa.array([row["batch"].as_py()]),
                "ids": pa.array([row["ids"].as_py()], pa.binary()),
                "sizes": pa.array([np.array(sizes, np.int32).tobytes()], pa.binary()),
                "trains": pa.array([bytes(trains)], pa.binary()),
                "words": pa.array([hashes.tobytes()], pa.binary()),
                "tokens": pa.array([np.array(tokens, np.uint32).tobytes()], pa.binary()),
            }
        )


class _Batch:
    """One encoded batch: tokens, their contexts, and the distinct words and bigrams with training counts."""

    def __init__(self, row: dict[str, pa.Scalar]):
        get = {k: v.as_py() for k, v in row.items() if k not in ("answers",)}
        self.name = get["batch"]
        self.ids = np.frombuffer(get["ids"], np.int64)
        self.sizes = np.frombuffer(get["sizes"], np.int32).astype(np.int64)
        self.trains = np.frombuffer(get["trains"], np.uint8) == ord("1")
        self.words = np.frombuffer(get["words"], _U)
        self.tokens = np.frombuffer(get["tokens"], np.uint32).astype(np.int64)
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        self.contexts = np.empty_like(self.tokens)
        self.contexts[1:] = self.tokens[:-1]
        self.contexts[self.starts] = START
        self.trained = np.repeat(self.trains, self.sizes)
        pairs = self.contexts * len(self.words) + self.tokens
        self.pairs, self.pair = np.unique(pairs, return_inverse=True)
        self.first, self.second = np.divmod(self.pairs, len(self.words))

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.trained], minlength=len(self.words))

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.pair[self.trained], minlength=len(self.pairs))

    def pair_hashes(self) -> np.ndarray:
        return mixed(mixed(self.words[self.first] + _U(0x9E3779B97F4A7C15)) ^ self.words[self.second])

    def ask(self, buckets: int) -> list[dict]:
        rows = requests(self.name, self.pair_hashes(), self.pair_counts(), buckets)
        return rows + requests(self.name, mixed(self.words), self.word_counts(), buckets, buckets)

    def totals(self, row: dict[str, pa.Scalar], buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the distinct words and of the distinct bigrams over the whole corpus."""
        found = decoded(row["answers"])
        words = answers(mixed(self.words), buckets, buckets, found)
        return words, answers(self.pair_hashes(), buckets, 0, found)


def _asked(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("bucket", pa.int32()), ("batch", pa.string()), ("keys", pa.binary()), ("counts", pa.binary())])
    for row in rows_of(batches):
        yield pa.RecordBatch.from_pylist(_Batch(row).ask(buckets), schema=schema)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, then one bucket per power of two."""
    return np.minimum(np.frexp(count.astype(np.float64))[1], BUCKETS - 1)


def _level(p: np.ndarray) -> np.ndarray:
    """Probabilities as steps of 1 / BINS_PER_OCTAVE octaves; -1 for 0."""
    with np.errstate(divide="ignore"):
        steps = np.round(-np.log2(p) * BINS_PER_OCTAVE)
    return np.where(p > 0, steps, -1).astype(np.int64)


def _deleted(batches: Iterator[pa.RecordBatch], buckets: int, n_tokens: int, n_texts: int) -> Iterator[pa.RecordBatch]:
    """Held-out counts of the training bigrams by context bucket and both estimates with one occurrence taken out."""
    for row in rows_of(batches):
        b = _Batch(row)
        words, pairs = b.totals(row, buckets)
        weight = b.pair_counts()
        seen = weight > 0
        context = np.where(b.first == START, n_texts, words[b.first])[seen] - 1
        two = (pairs[seen] - 1) / np.maximum(context, 1)
        one = (words[b.second][seen] - 1) / max(n_tokens - 1, 1)
        key = (context_bucket(context) * 4096 + _level(two) + 1) * 4096 + _level(one) + 1
        keys, at = np.unique(key, return_inverse=True)
        sums = np.bincount(at, weight[seen], len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sums, pa.float64())], names=["cell", "n"])


def fit_weights(cells: np.ndarray, counts: np.ndarray, uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights (bucket; bigram, unigram, uniform) by expectation-maximisation over the held-out cells.
    Buckets without held-out counts take the weights of the nearest lower one."""
    bucket, rest = np.divmod(cells, 4096 * 4096)
    levels = np.stack(np.divmod(rest, 4096), axis=1) - 1
    estimates = np.where(levels >= 0, 2.0 ** (-levels / BINS_PER_OCTAVE), 0.0)
    estimates = np.concatenate([estimates, np.full((len(cells), 1), uniform)], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[bucket] * estimates
        share *= (counts / share.sum(axis=1))[:, None]
        new = np.zeros_like(weights)
        np.add.at(new, bucket, share)
        total = new.sum(axis=1, keepdims=True)
        weights = np.where(total > 0, new / np.maximum(total, 1e-300), weights)
    used = set(bucket.tolist())
    for i in range(BUCKETS):
        if i not in used:
            weights[i] = weights[i - 1] if i else (0.0, 0.5, 0.5)
    weights[0, 0] = 0.0  # nothing was seen after an unseen context
    floor = np.maximum(weights, [0.0, 0.0, 1e-9])  # the uniform part keeps every probability above zero
    return floor / floor.sum(axis=1, keepdims=True)


SCORED = (
    "id bigint, trained boolean, n_tokens bigint, n_known bigint, base_score double, score double"
)


def _scored(
    batches: Iterator[pa.RecordBatch], buckets: int, n_tokens: int, n_words: int, n_texts: int, weights: np.ndarray
) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        b = _Batch(row)
        words, pairs = b.totals(row, buckets)
        context = np.where(b.first == START, n_texts, words[b.first])
        w = weights[context_bucket(context)]
        two = pairs / np.maximum(context, 1)
        one = words[b.second] / max(n_tokens, 1)
        log = np.log10(w[:, 0] * two + w[:, 1] * one + w[:, 2] / (n_words + 1))
        base = np.log10((words + 1) / (n_tokens + n_words + 1))
        columns = [
            pa.array(b.ids, pa.int64()),
            pa.array(b.trains),
            pa.array(b.sizes, pa.int64()),
            pa.array(np.add.reduceat((words > 0)[b.tokens].astype(np.int64), b.starts), pa.int64()),
            pa.array(np.add.reduceat(base[b.tokens], b.starts)),
            pa.array(np.add.reduceat(log[b.pair], b.starts)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in SCORED.split(", ")])


def score_texts(
    docs: DataFrame, trained: Column | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, train_words, base_score, score.

    Tokens are the words between ASCII white space, A-Z in lower case, then one end.  ``trained`` says which rows are
    learned from (default ``training_part``).  ``score`` is the model's log10 probability of the tokens in order,
    ``base_score`` that of add-one unigrams.  Null and empty texts are the end alone.  Repeated rows are learned from
    and come back each; null ids stay null; other columns are not read; an empty table gives an empty result, and
    without training rows every word is uniform.  Words and bigrams meet by hashes of 48 bits and the bucket; two that
    collide would share a count.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    buckets = BUCKETS_PER_PARTITION * n
    trained = F.coalesce(training_part(id_column) if trained is None else trained, F.lit(False))
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(NULL_ID)).alias("id"),
        F.concat(F.when(trained, "1").otherwise("0"), text_of(text_column)).cast("binary").alias("body"),
    )
    with Scratch(spark) as scratch:
        encoded = scratch.bucketed(rows.mapInArrow(_encoded, ENCODED), "batch", n)
        found = scratch.table(totals(encoded.mapInArrow(lambda b: _asked(b, buckets), REQUEST)))
        n_words = found.filter(F.col("bucket") >= buckets).groupBy("bucket").agg(F.max("known").alias("k"))
        n_words = n_words.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
        joined = encoded.join(by_batch(found), "batch")
        n_tokens, n_texts = _sizes(encoded)
        cells = joined.mapInArrow(lambda b: _deleted(b, buckets, n_tokens, n_texts), "cell bigint, n double")
        sums = sorted(cells.groupBy("cell").agg(F.sum("n")).collect())  # levels and buckets bound the cells
        weights = fit_weights(
            np.array([c for c, _ in sums], np.int64), np.array([x for _, x in sums]), 1 / (n_words + 1)
        )
        out = kept(joined.mapInArrow(lambda b: _scored(b, buckets, n_tokens, n_words, n_texts, weights), SCORED))
    return out.select(
        real_id("id").alias("doc_id"),
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
        F.lit(n_words).cast("bigint").alias("train_words"),
    )


def _sizes(encoded: DataFrame) -> tuple[int, int]:
    """Training tokens and training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            trains = np.frombuffer(row["trains"].as_py(), np.uint8) == ord("1")
            sizes = np.frombuffer(row["sizes"].as_py(), np.int32)
            pair = [pa.array([int(sizes[trains].sum())]), pa.array([int(trains.sum())])]
            yield pa.RecordBatch.from_arrays(pair, names=["tokens", "texts"])

    each = encoded.select("sizes", "trains").mapInArrow(count, "tokens bigint, texts bigint")
    return tuple(each.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("texts"), F.lit(0))).first())
