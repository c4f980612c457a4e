"""Sharding by rendezvous (highest random weight) hashing.

Every shard draws one pseudorandom number per record key; the record goes to the shard with the lowest weighted
draw, ``-ln(u) / weight``. A shard added later only wins records for itself: all other draws stay as they are. The
key and the shard list alone decide, so reruns, other partitionings and lost executors change nothing.

DataFrame functions only. The draw needs no shuffle; ``slots`` (gapless numbers inside each shard) sorts narrow rows
by ranges, never one shard in one task.

Defined results: a null key is a key like any other; a null text has size 1 and crc32 0; rows that repeat a key go to
the same shard and get slots of their own; extra columns pass through ``assign``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import ranked, written


def rendezvous(key: Column, weights: Mapping[int, float] | Sequence[float]) -> Column:
    """The shard (a key of ``weights``, or a position in it) that wins the record."""
    pairs = sorted(weights.items()) if isinstance(weights, Mapping) else list(enumerate(weights))
    if not pairs or any(w <= 0 for _, w in pairs):
        raise ValueError("every shard needs a positive weight")
    shards = F.array(*[F.struct(F.lit(int(s)).alias("s"), F.lit(float(w)).alias("w")) for s, w in pairs])

    def draw(shard: Column) -> Column:
        # 53 random bits as a number strictly between 0 and 1
        u = (F.shiftrightunsigned(F.xxhash64(key, shard["s"]), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        return F.struct((-F.log(u) / shard["w"]).alias("cost"), shard["s"].alias("s"))

    return F.array_min(F.transform(shards, draw))["s"]


def assign(df: DataFrame, key: str, weights, shard_col: str = "shard") -> DataFrame:
    """``df`` with the shard of every row."""
    return df.withColumn(shard_col, rendezvous(F.col(key), weights))


def write_sharded(df: DataFrame, key: str, weights, path: str) -> None:
    """One folder per shard (``shard=0`` ...), written without moving any row between tasks."""
    assign(df, key, weights).write.partitionBy("shard").parquet(path)


def slots(df: DataFrame, shard_col: str, order: list[str]) -> DataFrame:
    """``df`` with ``slot``: 0, 1, ... inside each shard, in the given order."""
    return ranked(df, [shard_col], order, name="shard-slots").withColumnRenamed("rank", "slot")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Shard, slot and sizes of every document, and its shard were there one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    narrow = written(docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"), rendezvous(key, [1.0] * shards).alias("shard"),
        rendezvous(key, [1.0] * (shards + 1)).alias("grown_shard")), "sharded")
    return slots(narrow, "shard", ["doc_id", "size", "text_crc32"]).withColumn("slot", F.col("slot").cast("long"))
