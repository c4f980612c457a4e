"""Counting events in intervals without pairing them (JN2).

An interval join on an id pairs every left row with every right row of that id before the time test, which is the square of
a hot id's rows. Counts need no pairs: the events of an id inside (from, to] are those up to `to` less those up to `from`,
and "how many up to here" is a running count. Events and interval ends are laid out together by (id, instant) over range
partitions, so an id of any size is spread over as many ranges as its rows need; each range counts on its own, and
an id that goes on from earlier ranges gets their total on top. At most the first and the last id of a range can do so,
hence the totals are at most two rows a range, and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.session import materialise


def counts_upto(events: DataFrame, ends: DataFrame) -> DataFrame:
    """``ends`` (key, at, and more) with ``n``: how many of the ``events`` (key, at) of the same key are at or before ``at``.

    Events count as often as they are there. Rows of either side with a null key or instant are left out.
    """
    more = [c for c in ends.columns if c not in ("key", "at")]
    carried = F.struct(*more) if more else F.lit(None).cast("struct<_:int>")
    told = lambda df: df.where("key IS NOT NULL AND at IS NOT NULL")
    asked = told(ends).select("key", "at", F.lit(1).alias("kind"), F.lit(0).alias("one"), carried.alias("more"))
    given = told(events).select("key", "at", F.lit(0).alias("kind"), F.lit(1).alias("one"), F.lit(None).cast(asked.schema["more"].dataType).alias("more"))
    spread = F.xxhash64("more")  # many ends at one instant need not share a range
    laid = materialise(asked.unionByName(given).repartitionByRange("key", "at", "kind", spread)
                       .withColumn("part", F.spark_partition_id()), name="interval-ends")
    edges = laid.groupBy("part").agg(F.min("key").alias("a"), F.max("key").alias("b"))
    edges = edges.select(F.explode(F.array("a", "b")).alias("key")).distinct()  # at most two a range
    held = (laid.join(F.broadcast(edges), "key", "left_semi").groupBy("key", "part").agg(F.sum("one").alias("held")))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (held.withColumn("carry", F.sum("held").over(before)).where("carry > 0")
             .select("key", "part", "carry"))
    upto = Window.partitionBy("part", "key").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = laid.withColumn("n", F.sum("one").over(upto)).where("kind = 1").join(F.broadcast(carry), ["key", "part"], "left")
    return counted.select("key", "at", *[F.col(f"more.{c}").alias(c) for c in more],
                          (F.col("n") + F.coalesce("carry", F.lit(0))).alias("n"))


def counts_within(events: DataFrame, intervals: DataFrame, row: str) -> DataFrame:
    """(row, n) for the ``intervals`` (key, after, upto, row) that hold n > 0 of the ``events`` (key, at): after < at <= upto."""
    ends = intervals.where("after < upto").select("key", F.explode(F.array(
        F.struct(F.col("after").alias("at"), F.lit(-1).alias("sign")),
        F.struct(F.col("upto").alias("at"), F.lit(1).alias("sign")))).alias("end"), row)
    ends = ends.select("key", F.col("end.at").alias("at"), F.col("end.sign").alias("sign"), row)
    return (counts_upto(events, ends).groupBy(row).agg(F.sum(F.col("sign") * F.col("n")).alias("n")).where("n > 0"))
