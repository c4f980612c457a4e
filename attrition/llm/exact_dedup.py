"""Exact duplicates found by two passes over Bloom filters; only possibly repeated rows shuffle.

Pass 1 reads every text once and keeps a 64-bit hash. Each hash stands for two cells (bits) of one 64-bit word of a
counting Bloom filter with ``cells_per_row`` cells a row. The cells are counted as rows, summed before they are
shuffled, so a text held by a third of all rows costs one row per task. Cells met at least twice are folded into a
second Bloom filter of at most ``max_filter_words`` words, which is what gets broadcast: 2**20 words are at most
2**20 rows of two longs.

Pass 2 probes that filter. A row with a cell that was met once only has no equal and passes straight through. The
rest, real repeats and a few false alarms, are grouped by the SHA-256 of the normalised text, pre-aggregated. A
fuller filter means more false alarms, never a different result.

DataFrame functions only. Defined results: null counts as the empty text, and empty texts equal one another; of equal
texts the smallest doc_id stays; a row without id stays only if no equal row has one. ``deduplicate`` keeps one row of
rows that also share the doc_id; ``report`` gives both the same verdict. Extra columns pass through ``deduplicate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import SPACE_RUN, written


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def digest(text: Column) -> Column:
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def _words_for(rows: int, cells_per_row: int) -> int:
    return 1 << max(10, (rows * cells_per_row // 64).bit_length())


def _bits(h: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(h, 48).bitwiseAND(63), F.shiftrightunsigned(h, 54).bitwiseAND(63)


def _mask(h: Column) -> Column:
    first, second = _bits(h)
    one = F.lit(1).cast("long")
    return F.call_function("shiftleft", one, first.cast("int")).bitwiseOR(
        F.call_function("shiftleft", one, second.cast("int")))


def repeated_filter(hashes: DataFrame, h: str = "h", cells_per_row: int = 64,
                    max_filter_words: int = 1 << 20) -> DataFrame:
    """Pass 1: the words (word, bits) of the Bloom filter of cells that at least two rows share."""
    block = F.col(h).bitwiseAND(F.lit(_words_for(hashes.count(), cells_per_row) - 1))
    cells = F.array_distinct(F.array(*[block * 64 + b for b in _bits(F.col(h))]))
    again = (hashes.select(F.explode(cells).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
             .where("n > 1").select("cell"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell").bitwiseAND(63).cast("int"))
    word = F.shiftright("cell", 6).bitwiseAND(F.lit(max_filter_words - 1))
    return written(again.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")), "bloom")


def probe(rows: DataFrame, bloom: DataFrame, n: int, h: str = "h", cells_per_row: int = 64,
          max_filter_words: int = 1 << 20) -> DataFrame:
    """Pass 2: ``rows`` with ``again``, false where no other row can have the same hash."""
    word = F.col(h).bitwiseAND(F.lit(_words_for(n, cells_per_row) - 1)).bitwiseAND(F.lit(max_filter_words - 1))
    mask = _mask(F.col(h))
    met = F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False))
    # at most max_filter_words rows of 16 bytes, whatever the corpus
    return (rows.withColumn("_word", word).join(F.broadcast(bloom), F.col("_word") == F.col("word"), "left")
            .withColumn("again", met).drop("_word", "word", "bits"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document, dropped ones too: the document that stays, the group's size, the digest."""
    seen = written(docs.select("doc_id", digest(F.col("text")).alias("text_sha256"))
                   .withColumn("h", F.xxhash64("text_sha256")), "digests")
    probed = probe(seen, repeated_filter(seen), seen.count()).drop("h")
    groups = written(probed.where("again").groupBy("text_sha256")
                     .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
                     .where("group_size > 1").withColumnRenamed("text_sha256", "sha"), "equal-texts")
    alone = (F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    # `groups` is a written table, so a hot digest is split by Spark's skew join
    checked = (probed.where("again").join(groups, F.col("text_sha256") == F.col("sha"), "left")
               .select("doc_id", F.when(F.col("sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                       F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                       (F.col("sha").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256"))
    straight = probed.where("not again").select("doc_id", *alone, "text_sha256")
    return checked.unionByName(straight)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    sha = digest(F.col("text"))
    seen = written(docs.select(F.xxhash64(sha).alias("h")), "hashes")
    # the row travels as one struct, so its own column names cannot clash with the helper columns
    rows = docs.select(F.struct("*").alias("row"), sha.alias("sha")).withColumn("h", F.xxhash64("sha"))
    rows = probe(rows, repeated_filter(seen), seen.count())
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"))
    kept = rows.where("again").groupBy("sha").agg(F.min_by("row", order).alias("row"))
    return rows.where("not again").select("row.*").unionByName(kept.select("row.*"))
