"""Helpers shared by the corpus operators: tables, word patterns, written intermediates, global ranks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrition.session import ensure_checkpoint_dir

# Fixed by the query contracts: a word is a run of characters other than these six.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_written: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, as an array (empty for null)."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * 5)
    return F.array_remove(F.split(spaced, " "), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also where ``body`` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate as Parquet under the shared checkpoint folder and read it back.

    Computed once, column-pruned by its readers, readable after the loss of any executor.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{os.urandom(6).hex()}")
    df.write.option("compression", "zstd").parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, still_read: DataFrame | None = None) -> None:
    """Delete the intermediates written so far, but for those that ``still_read`` reads."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    if not paths:
        return
    inputs = still_read.inputFiles() if still_read is not None else []
    used = [p for p in paths if any(os.path.basename(p) in f for f in inputs)]
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in set(paths) - set(used):
        target = jvm.org.apache.hadoop.fs.Path(p)
        target.getFileSystem(conf).delete(target, True)
    paths[:] = used


#: Rows that a table may have to be broadcast. Spark goes by the size of its files, which says little of its rows: columns
#: that repeat are a few bytes on disk, and the rows of an ``explode`` count as those it is made from.
BROADCAST_ROWS = 100_000


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that is not to broadcast either side: for tables that grow with the documents."""
    return df.hint("merge")


def lookup(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of so many rows, for a join that broadcasts it only if they are few."""
    return df if rows <= BROADCAST_ROWS else shuffled(df)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the driver has imported it from (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = os.path.join(tempfile.mkdtemp(prefix="attrition-py-"), "attrition.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_per_task))


def ranked(df: DataFrame, group: list[str], order: list[str], value: str | None = None,
           rows_per_task: int = 200_000, name: str = "ranked") -> DataFrame:
    """Add ``rank`` (0, 1, ... per group) and, given ``value``, ``before`` (its sum over the lower ranks).

    Ranks without one task per group: rows are range-partitioned and sorted by group and order, numbered inside
    each range, and every (range, group) gets the total of the ranges before it. A group of any size is spread
    over as many ranges as its rows need. Rows equal in all of ``order`` are ranked in an arbitrary order, so
    ``order`` should tell rows apart (or the rows should be alike).
    """
    spark = df.sparkSession
    parts = tasks_for(spark, df.count(), rows_per_task)
    keys = [*group, *order]
    laid = written(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                   .withColumn("_at", F.monotonically_increasing_id()), name)
    laid = laid.withColumn("_part", F.shiftright("_at", 33))
    amount = F.col(value) if value else F.lit(0)
    totals = laid.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.sum(amount).alias("_v"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(totals.select(
        F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_v0")), name + "-offsets")
    inside = Window.partitionBy("_part", *group).orderBy("_at")
    numbered = laid.withColumn("_k", F.row_number().over(inside) - 1)
    if value:
        so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
        numbered = numbered.withColumn("_s", F.coalesce(F.sum(amount).over(so_far), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    out = numbered.join(lookup(offsets, offsets.count()), same).withColumn("rank", F.col("_n0") + F.col("_k"))
    if value:
        out = out.withColumn("before", F.col("_v0") + F.col("_s"))
    return out.drop("_at", "_part", "_p", "_n0", "_v0", "_k", "_s", *[f"_g{i}" for i in range(len(group))])


def keyed_subset(rows: DataFrame, keys: DataFrame, key: str, max_words: int = 1 << 20) -> DataFrame:
    """The rows whose key is among ``keys`` (distinct), without shuffling most of the others.

    A Bloom filter of the keys, at most ``max_words`` rows of two longs, is broadcast; what it lets through meets the
    keys in a join. A full filter lets more rows through, never fewer.
    """
    def place(column):
        h = F.xxhash64(column)
        one = F.lit(1).cast("long")
        bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(h, at).bitwiseAND(63).cast("int")) for at in (40, 46, 52)]
        return h.bitwiseAND(F.lit(max_words - 1)), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])

    word, mask = place(keys[key])
    bloom = written(keys.select(word.alias("_word"), mask.alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits")), "key-bloom")
    word, mask = place(F.col(key))
    met = (rows.withColumns({"_at": word, "_own": mask}).join(F.broadcast(bloom), F.col("_at") == F.col("_word"))
           .where(F.col("_bits").bitwiseAND(F.col("_own")) == F.col("_own")).drop("_at", "_own", "_word", "_bits"))
    # the keys are distinct, so this is a semi-join; a semi-join proper would be pushed below the filter
    return met.join(keys, key)
