"""Language identification, words first: a word that some language's word list holds is scored by its frequency there,
any other word by its character n-grams, the longest length of which any is known.

Word and n-gram counts cover all training documents and are summed up by Spark; the most frequent entries of every
language form the model, whose size is a parameter.  Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain, islice

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortspark.llm.common import Scratch

UNKNOWN = "und"
LENGTHS = (4, 3, 2, 1)  # of the n-grams, tried in this order
PENALTY = 7.0  # log10 cost of a word or n-gram that a language does not have
#: Entries of the model over all languages: of words, and of n-grams of each length.
MODEL_ENTRIES = 400_000
MAX_LANGUAGES = 1_000
UNIT = 1_000_000  # scores are whole millionths, so sums do not depend on their order

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# the same runs where no character lies beyond Latin Extended-A, which has no marks
_BEYOND = re.compile(r"[^\x00-\u017f]")
_LATIN = re.compile(r"[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f]+")
_CHUNK = 50_000  # words of a text that are held at once,
_AT_ONCE = 500_000  # where it has more characters than this
_HELD = 200_000  # distinct entries that a task counts before it passes them on
_CACHE = 200_000  # unseen words that a task remembers
_CACHED_LENGTH = 32  # longer ones are not remembered


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-case runs of letters, in lists of bounded length."""
    lower = text.lower()
    word = _WORD if _BEYOND.search(lower) else _LATIN
    if len(lower) <= _AT_ONCE:
        if part := word.findall(lower):
            yield part
        return
    found = (m.group() for m in word.finditer(lower))
    while part := list(islice(found, _CHUNK)):
        yield part


def grams(word: str, length: int) -> list[str]:
    """n-grams of the word between two spaces; the space alone is none."""
    padded = f" {word} "
    if length == 1:
        return list(word)
    return [padded[i : i + length] for i in range(len(padded) - length + 1)]


@dataclass(frozen=True)
class Model:
    """``words`` and ``grams`` (by length) give (language number, gain) pairs; the gain of an entry is how much less
    than ``PENALTY`` it costs the language.  ``languages`` go by name; ``common`` is the one with most words."""

    languages: tuple[str, ...]
    common: int
    words: dict[str, tuple[tuple[int, int], ...]]
    grams: dict[int, dict[str, tuple[tuple[int, int], ...]]]

    def backoff(self, word: str) -> tuple[tuple[int, int], ...]:
        """Mean gains of the known n-grams of the longest length that has any; empty when no letter is known."""
        for length, known in self.grams.items():
            found = [pairs for pairs in map(known.get, grams(word, length)) if pairs]
            if found:
                total: dict[int, int] = {}
                for pairs in found:
                    for g, gain in pairs:
                        total[g] = total.get(g, 0) + gain
                return tuple((g, gain // len(found)) for g, gain in total.items())
        return ()

    def classify(self, text: str | None, cache: dict[str, tuple]) -> tuple[str, float]:
        """The language and its share of 10 ** (mean gain) over all languages."""
        total = [0] * len(self.languages)
        counted, letters = 0, False
        words, seen = self.words.get, cache.get
        for part in words_of(text or ""):
            letters = True
            for word, n in Counter(part).items():
                pairs = words(word)
                if pairs is None:
                    pairs = seen(word)
                    if pairs is None:
                        pairs = self.backoff(word)
                        if len(word) <= _CACHED_LENGTH:
                            if len(cache) >= _CACHE:
                                cache.clear()
                            cache[word] = pairs
                    if not pairs:
                        continue
                counted += n
                for g, gain in pairs:
                    total[g] += n * gain
        if not letters or not total:
            return UNKNOWN, 0.0
        if not counted:
            return self.languages[self.common], 1 / len(total)
        best = max(range(len(total)), key=lambda g: (total[g], -g))
        share = sum(10.0 ** ((t - total[best]) / (UNIT * counted)) for t in total)
        return self.languages[best], 1 / share


def gain_of(n: int, total: int) -> int:
    return max(1, round(UNIT * (PENALTY + math.log10(n / total))))


_COUNTS = "kind int, lang string, entry string, n bigint"


def _emitted(held: dict[tuple[int, str], Counter]) -> pa.RecordBatch:
    """Counts by (kind, language) as rows."""
    sizes = [len(c) for c in held.values()]
    return pa.RecordBatch.from_pydict(
        {
            "kind": pa.array([kind for (kind, _), n in zip(held, sizes) for _ in range(n)], pa.int32()),
            "lang": pa.array([lang for (_, lang), n in zip(held, sizes) for _ in range(n)], pa.string()),
            "entry": pa.array(list(chain.from_iterable(held.values())), pa.string()),
            "n": pa.array(list(chain.from_iterable(c.values() for c in held.values())), pa.int64()),
        }
    )


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, str], Counter] = defaultdict(Counter)
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts = held[0, lang]
            for part in words_of(text.as_py()):
                size -= len(counts)
                counts.update(part)
                size += len(counts)
                if size >= _HELD:
                    yield _emitted(held)
                    held.clear()
                    counts, size = held[0, lang], 0
    yield _emitted(held)


def _gram_counts(batches: Iterator[pa.RecordBatch], lengths: Sequence[int]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, str], Counter] = defaultdict(Counter)
    size = 0
    for batch in batches:
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            for length in lengths:
                counts = held[length, lang]
                size -= len(counts)
                for gram in grams(word, length):
                    counts[gram] = counts.get(gram, 0) + n
                size += len(counts)
            if size >= _HELD:
                yield _emitted(held)
                held.clear()
                size = 0
    yield _emitted(held)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("kind", "lang", "entry").agg(F.sum("n").alias("n"))


def fit(
    labelled: DataFrame,
    lang_column: str = "lang",
    text_column: str = "text",
    lengths: Sequence[int] = LENGTHS,
    entries: int = MODEL_ENTRIES,
) -> Model:
    """Model of all rows of ``labelled`` that have a language and a text.

    All words and n-grams are counted.  Of every kind (words, n-grams of one length) a language keeps the entries that
    are at least so frequent that no more than ``entries / languages`` are; equally frequent ones stay or go together.
    So what reaches the driver and the tasks is bounded by ``entries * (1 + len(lengths))`` entries, whatever the input.
    More than ``MAX_LANGUAGES`` languages are refused.  A table without languages gives a model that knows none.
    """
    rows = labelled.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null")
    with Scratch(labelled.sparkSession) as scratch:
        words = scratch.table(_summed(rows.mapInArrow(_word_counts, _COUNTS)))
        pieces = words.select("lang", "entry", "n").mapInArrow(lambda b: _gram_counts(b, lengths), _COUNTS)
        counts = scratch.table(words.unionByName(_summed(pieces)))
        totals = counts.groupBy("kind", "lang").agg(F.sum("n").alias("total"))
        # how many entries are so frequent, summed up from the most frequent; one row per distinct frequency
        down = Window.partitionBy("kind", "lang").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
        sizes = counts.groupBy("kind", "lang", "n").agg(F.count(F.lit(1)).alias("size"))
        found = [r["lang"] for r in words.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
        if len(found) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        room = entries // max(len(found), 1)
        least = sizes.withColumn("size", F.sum("size").over(down)).filter(F.col("size") <= room)
        least = least.groupBy("kind", "lang").agg(F.min("n").alias("least"))
        # one row per kind and language: at most MAX_LANGUAGES * (1 + len(lengths))
        kept = counts.join(F.broadcast(least), ["kind", "lang"]).filter(F.col("n") >= F.col("least"))
        total = {(r["kind"], r["lang"]): r["total"] for r in totals.collect()}
        number = {lang: i for i, lang in enumerate(found)}
        known: dict[int, dict[str, list]] = {0: {}} | {n: {} for n in lengths}
        for r in kept.select("kind", "lang", "entry", "n").toLocalIterator():
            gain = gain_of(r["n"], total[r["kind"], r["lang"]])
            known[r["kind"]].setdefault(r["entry"], []).append((number[r["lang"]], gain))
    tables = {kind: {e: tuple(sorted(pairs)) for e, pairs in held.items()} for kind, held in known.items()}
    common = max(range(len(found)), key=lambda i: (total[0, found[i]], -i)) if found else 0
    return Model(tuple(found), common, tables.pop(0), tables)


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", *carried: Column) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the ``carried`` columns, ``lang_pred``, ``score`` (0 to 1).

    Words are runs of letters in lower case, of the whole text.  ``lang_pred`` is ``und`` and ``score`` 0 where the
    text is null, has no letter, or no language was learned; a text whose letters are all unknown gets the language
    with most words and an even share.  Equal languages go by name.  Null ids and repeated rows come back as they are;
    other columns are not read; an empty table gives an empty result.  A text is read in parts of 50,000 words.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"), *carried, F.col(text_column).cast("string").alias("_text")
    )
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema[:-1]]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded, see ``fit``

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cache = shared.value, {}
        for batch in batches:
            made = [known.classify(t.as_py(), cache) for t in batch.column(batch.num_columns - 1)]
            columns = [*batch.columns[:-1], pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return rows.mapInArrow(scored, ", ".join([*fields, "lang_pred string", "score double"]))
