"""Exact duplicates: two passes of Bloom filtering find the texts that may repeat; only their rows are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import SPACE, kept, text_of

WORD_BITS = 64
BITS_PER_ROW = 16
#: A filter of at most so many words of 64 bits (32 MB as a hash table of pairs of longs) is broadcast; a larger one is
#: joined by shuffling the narrow rows (hash, id).
BROADCAST_WORDS = 1 << 20
#: Rows alike in id and text that one task writes out at most.
COPY_BLOCK = 1 << 16


def normalised(column: str = "text") -> Column:
    """Text with every run of ASCII white space replaced by one space; null counts as empty."""
    return F.regexp_replace(text_of(column), SPACE, " ")


def _positions(digest: str, words: int) -> dict[str, Column]:
    """Filter word and the two bits inside it, taken from different parts of the digest."""

    def part(start: int, digits: int):
        return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")

    return {
        "_word": part(1, 12) % words,
        "_one": (part(13, 4) % WORD_BITS).cast("int"),
        "_two": (part(17, 4) % WORD_BITS).cast("int"),
    }


def repeat_filter(digests: DataFrame, words: int) -> DataFrame:
    """The second Bloom filter, one row per used word (``_word``, ``_bits``).

    The first pass sets two bits per digest and counts, with partial sums before the shuffle, how often each bit was
    set.  The second filter holds the bits that were set at least twice, so a repeated digest has both its bits there.
    """
    at = digests.select(*[c.alias(n) for n, c in _positions("digest", words).items()])
    each = at.select("_word", F.explode(F.array_distinct(F.array("_one", "_two"))).alias("_bit"))
    twice = each.groupBy("_word", "_bit").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return twice.groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))


def _split(rows: DataFrame, bloom: DataFrame, words: int) -> DataFrame:
    """``rows`` with ``_maybe``: whether both bits of the digest are in the filter."""
    bloom = F.broadcast(bloom) if words <= BROADCAST_WORDS else bloom
    out = rows.withColumns(_positions("digest", words)).join(bloom, "_word", "left")
    probe = F.expr("shiftleft(1L, _one) | shiftleft(1L, _two)")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(probe) == probe, F.lit(False))
    return out.withColumn("_maybe", maybe).drop("_word", "_one", "_two", "_bits")


def _words(n: int) -> int:
    need = max(1024, n * BITS_PER_ROW // WORD_BITS)
    return 1 << (need - 1).bit_length()


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when equal after normalising white space (compared by SHA-256); of equal texts the smallest id
    stays.  Null texts are empty texts.  A null id is later than any other.  Of rows alike in id and text one is kept;
    all of them come back.  Columns other than the two are not read, whatever they are called.  An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    digests = kept(
        docs.select(
            F.col(id_column).cast("bigint").alias("id"), F.sha2(normalised(text_column), 256).alias("digest")
        )
    )
    words = _words(digests.count())
    rows = _split(digests, repeat_filter(digests, words), words)
    # rows alike in id and text are counted together, so a group of copies is summed up before it is shuffled
    alike = rows.filter("_maybe").groupBy("digest", "id").agg(F.count(F.lit(1)).alias("_n"))
    # stored, so that the join below has plain exchanges on both sides and a digest of many ids is split between tasks
    groups = kept(alike.groupBy("digest").agg(F.min("id").alias("keep_id"), F.sum("_n").alias("group_size")))
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / COPY_BLOCK))).alias("_block")
    blocks = alike.join(groups, "digest").select("*", block).repartition("digest", "id", "_block")
    size = F.least(F.lit(COPY_BLOCK), F.col("_n") - F.col("_block") * COPY_BLOCK)
    copies = blocks.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), size)).alias("_copy")).select(
        "id",
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("_block") == 0) & (F.col("_copy") == 1)).alias("kept"),
        "digest",
    )
    alone = rows.filter("not _maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    return alone.unionByName(copies).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that stay, all columns unchanged.

    Texts that the filter rules out as repeats pass without a shuffle.  Of equal texts the row with the smallest id
    stays (nulls last); among several rows with that id and text, any one.
    """
    digests = kept(docs.select(F.sha2(normalised(text_column), 256).alias("digest")))
    words = _words(digests.count())
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col(id_column).cast("bigint").alias("id"),
        F.sha2(normalised(text_column), 256).alias("digest"),
    )
    rows = _split(packed, repeat_filter(digests, words), words)
    alike = rows.filter("_maybe").groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))
    groups = kept(
        alike.groupBy("digest").agg(
            F.min_by(F.struct("id", "n"), F.struct(F.col("id").isNull(), "id")).alias("first")
        )
    )
    stay = rows.filter("_maybe").join(groups, "digest").filter(F.col("id").eqNullSafe(F.col("first.id")))
    one = stay.filter("first.n = 1").select("row")
    tied = stay.filter("first.n > 1").dropDuplicates(["digest"]).select("row")
    return rows.filter("not _maybe").select("row").unionByName(one).unionByName(tied).select("row.*")
