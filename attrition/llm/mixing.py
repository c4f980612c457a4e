"""Mixing sources to target weights, by blocks that are drawn and joined by index.

Each source's documents, in order of their id, are one stream of words cut into blocks of ``block`` words. The mix
has as many slots as the targets come to in blocks, dealt over output shards. Every shard draws how many of its slots
each source gets: the whole part of the expected count is certain, the remaining slots are multinomial draws with
the fractions as probabilities (so totals stay near their targets), seeded by the shard's number. The slots of a
source, numbered through all shards, map to its blocks by a pseudorandom permutation of the block numbers, another
one for each round through the stream, and slots and blocks are joined by index. A source has at most ``ceiling``
rounds, so no block, and no document, is taken more often.

Only the totals per source come to the driver, as arrays: one number for each entry of the mixture's weight table. No
table that grows with the documents is broadcast.

Defined results: a null text has no words and is never taken; a null source is a source of its own, last in order;
rows that repeat a document are documents of their own; without any words all targets are 0. Extra columns pass
through ``mixed_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrition.llm.common import WORD, lookup, ranked, ship_package, shuffled, tasks_for, words, written

WEIGHTS = (5, 2, 1)
CEILING = 3


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], ceiling: float = CEILING) -> np.ndarray:
    """Share the total size by weight; what exceeds ``ceiling`` times a size is reshared among the others."""
    sizes, weights = np.asarray(sizes, np.int64), np.asarray(weights)
    total, open_ = float(sizes.sum()), np.ones(len(sizes), bool)
    out, capped = np.zeros(len(sizes)), 0.0
    while open_.any():
        unit = (total - capped) / sum(weights[open_].tolist())
        over = open_ & (unit * weights > ceiling * sizes)
        if not over.any():
            out[open_] = unit * weights[open_]
            break
        out[over] = ceiling * sizes[over]
        capped = float(np.add.accumulate(np.append(capped, out[over]))[-1])
        open_ &= ~over
    return out


def permuted(position: np.ndarray, n: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A keyed permutation of 0..n-1 applied to ``position``: a Feistel network, walked until inside the range."""
    bits = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    half = (np.uint64(1) << bits) - np.uint64(1)
    out, size, todo = position.astype(np.uint64), n.astype(np.uint64), np.ones(len(position), bool)
    while todo.any():
        left, right = out[todo] >> bits[todo], out[todo] & half[todo]
        for r in range(rounds):
            mixed = (right + key[todo].astype(np.uint64) + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, (left ^ mixed) & half[todo]
        out[todo] = (left << bits[todo]) | right
        todo &= out >= size
    return out.astype(np.int64)


def _draws(spark: SparkSession, expected: np.ndarray, seed: int, slots_per_shard: int) -> DataFrame:
    """(shard, number, n): how many slots of each shard go to each source."""
    slots = int(round(float(expected.sum())))
    # at most 10,000 shards, so that a source's counts can be summed in order
    shards = max(1, -(-slots // max(slots_per_shard, -(-slots // 10_000))))
    p = expected / max(expected.sum(), 1e-300)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k in batch["id"]:
                mine = slots * (int(k) + 1) // shards - slots * int(k) // shards
                mean = mine * p
                sure = np.floor(mean).astype(np.int64)
                rest, odds = mine - int(sure.sum()), mean - sure
                if rest > 0:
                    sure += np.random.default_rng([seed, int(k)]).multinomial(rest, odds / odds.sum())
                number = np.flatnonzero(sure)
                yield pd.DataFrame({"shard": int(k), "number": number, "n": sure[number]})

    tasks = min(shards, 8 * spark.sparkContext.defaultParallelism)
    return spark.range(0, shards, 1, tasks).mapInPandas(draw, "shard long, number long, n long")


class Mix:
    """The tables of one mixture, each written once."""

    def __init__(self, docs: DataFrame, weights: Sequence[float] = WEIGHTS, block: int = 128,
                 ceiling: int = CEILING, seed: int = 17, slots_per_shard: int = 4096):
        """``docs`` has doc_id, source, size (words) and, where rows can repeat an id, columns to order them by."""
        spark = docs.sparkSession
        ship_package(spark)
        totals = (docs.groupBy("source").agg(F.sum("size").alias("source_size"))
                  .orderBy(F.col("source").asc_nulls_last()).toArrow())
        sizes = totals["source_size"].to_numpy().astype(np.int64)
        wanted = targets(sizes, np.resize(weights, len(sizes)), ceiling)
        blocks = -(-sizes // block)
        expected = np.divide(wanted * blocks, sizes, out=np.zeros(len(sizes)), where=sizes > 0)
        self.sources = written(spark.createDataFrame(
            pa.table({"number": np.arange(len(sizes)), "source": totals["source"], "source_size": sizes,
                      "target": wanted, "blocks": blocks}),
            "number long, source string, source_size long, target double, blocks long"), "sources")
        order = [c for c in docs.columns if c != "source"]
        self.rows = ranked(docs, ["source"], order, value="size", name="mix").withColumnRenamed("rank", "place")
        self.rows = written(self.rows.join(lookup(self.sources, len(sizes)), self.rows["source"].eqNullSafe(self.sources["source"]))
                            .drop(self.sources["source"]), "mix-rows")
        first, last = F.col("before"), F.col("before") + F.col("size")
        cut = (self.rows.where("size > 0").select(
            "number", "place", first.alias("first"), last.alias("last"),
            F.explode(F.sequence(F.floor(first / block), F.floor((last - 1) / block))).alias("index")))
        # one row for each block and document that it holds a part of; positions are words of the document
        self.blocks = cut.select(
            "number", "place", "index", (F.greatest(F.col("index") * block, "first") - F.col("first")).alias("word"),
            (F.least((F.col("index") + 1) * block, "last") - F.greatest(F.col("index") * block, "first")).alias("words"))
        self.slots = self._slots(_draws(spark, expected, seed, slots_per_shard), expected, ceiling, seed)

    def _slots(self, draws: DataFrame, expected: np.ndarray, ceiling: int, seed: int) -> DataFrame:
        """(shard, number, slot, index): every slot of the mix and the block that it takes."""
        earlier = Window.partitionBy("number").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        runs = (written(draws, "draws").withColumn("from", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
                .join(lookup(self.sources.select("number", "blocks"), len(expected)), "number")
                .withColumn("to", F.least(F.col("from") + F.col("n"), F.col("blocks") * ceiling)).where("to > from"))
        # a few rows stand for all slots: dealt out by how many these are, not by the rows' bytes
        runs = runs.repartition(tasks_for(self.sources.sparkSession, int(round(float(expected.sum()))), 200_000), "shard")
        slots = runs.select("shard", "number", "blocks", F.explode(F.sequence(F.col("from"), F.col("to") - 1)).alias("slot"))

        @F.pandas_udf("long")
        def index(number: pd.Series, slot: pd.Series, blocks: pd.Series) -> pd.Series:
            n, s, b = number.to_numpy(np.int64), slot.to_numpy(np.int64), blocks.to_numpy(np.int64)
            turn = (s // b).astype(np.uint64)
            with np.errstate(over="ignore"):
                key = (n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + turn * np.uint64(0xA0761D6478BD642F)
                       + np.uint64(seed) * np.uint64(0xE7037ED1A0B428DB))
                return pd.Series(permuted(s % b, b, key))

        return slots.select("shard", "number", "slot", index("number", "slot", "blocks").alias("index"))

    def taken_parts(self) -> DataFrame:
        """``blocks`` with ``times``, how often the mix takes each; blocks never taken are left out."""
        times = self.slots.groupBy("number", "index").agg(F.count("*").alias("times"))
        return shuffled(self.blocks).join(times, ["number", "index"])


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *more)


def mixing_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and the words that the mix takes of every document."""
    mix = Mix(written(_sized(docs), "sized"), **options)
    taken = mix.taken_parts().groupBy("number", "place").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    return (shuffled(mix.rows).join(taken, ["number", "place"], "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a row for each round in which a document is taken, with the words taken in it.

    A document taken whole keeps its text as it is; of one taken in part the taken words are joined by spaces.
    """
    spark = docs.sparkSession
    stored = written(docs.select(F.monotonically_increasing_id().alias("id"), F.struct("*").alias("row")), "mix-docs")
    sized = written(stored.select("row.doc_id", "row.source", n_words(F.col("row.text")).alias("size"), "id"), "sized")
    mix = Mix(sized, **options)
    # a document has one entry per block, as many as its own length needs
    parts = mix.taken_parts().groupBy("number", "place").agg(F.sort_array(F.collect_list(F.struct("word", "words", "times"))).alias("parts"))
    plan = shuffled(mix.rows.select("id", "size", "number", "place")).join(parts, ["number", "place"]).select("id", "size", "parts")
    turns = F.sequence(F.lit(1), F.array_max(F.transform("parts", lambda x: x["times"].cast("int"))))
    plan = plan.withColumn("turn", F.explode(turns))
    plan = plan.withColumn("parts", F.filter("parts", lambda x: x["times"] >= F.col("turn")))
    whole = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["words"]) == F.col("size")
    plan = written(plan.select("id", F.when(~whole, F.col("parts")).alias("parts")), "mix-plan")
    rows = shuffled(plan).join(stored, "id")
    text = F.col("row.text")
    some = F.array_join(F.flatten(F.transform("parts", lambda x: F.slice(
        F.col("ws"), (x["word"] + 1).cast("int"), x["words"].cast("int")))), " ")
    rows = rows.withColumn("ws", F.when(F.col("parts").isNotNull(), words(text)))
    new = F.when(F.col("parts").isNull(), text).otherwise(some)
    kinds = dict(docs.dtypes)
    changed = {"text": new} | ({"n_chars": F.length(new).cast(kinds["n_chars"])} if "n_chars" in kinds else {})
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
