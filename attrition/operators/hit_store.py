"""The hits as a table laid out for the wide join (JN4 / PIP3): by day, in buckets by visitor, with the visitor map by day.

Every job joins the hits of some days with the sampled visitors. Read from the raw table, the hits of those days are
shuffled by visitor each time, and the visitor map is read from whole months of nested hits. Kept by day they are recoded once:

* `<table>`: the lean hits (flat, recoded columns) of one origin, brand and system, a partition a day, in buckets by visitor.
  The join takes the buckets as its partitions, so only the sampled visitors are shuffled to them;
* `<table>_devices`: the distinct (visitor, device) pairs of each day.

A day is replaced in one step (`sink.replace_partitions`), so days can be stored again. Hits without a valid date lie in no
interval and are not stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.config import Params
from attrition.operators import joins as J
from attrition.operators import sink as S
from attrition.sources import tables

DAY = "hit_day"


def store_hits(hits: DataFrame, p: Params, table: str, days: tuple[str, str] | None = None, buckets: int = 200,
               path: str | None = None) -> None:
    """Store the days (first, last; default: all that ``p`` wants) of a raw hit table.

    ``buckets`` should be at least the session's shuffle partitions, or Spark may prefer to shuffle the hits after all.
    """
    days = days or (p.period_start, p.last_hit_day)
    ga = tables.normalised_hits(hits, p, days=days).where(F.col("date").isNotNull())
    day = F.date_format("date", "yyyy-MM-dd").alias(DAY)
    S.replace_partitions(J.lean_hits(ga, p).select("*", day), table, [DAY], path=path, buckets=S.Buckets(buckets, "id_ga"))
    devices = tables.visitor_device_map(ga, "date").select("id_ga", "advertising_id", day)
    S.replace_partitions(devices, f"{table}_devices", [DAY], path=f"{path.rstrip('/')}_devices" if path else None)


def _between(df: DataFrame, first: str, last: str) -> DataFrame:
    return df.where(F.col(DAY).between(first, last))


def sampled_lean_hits(spark: SparkSession, installs: DataFrame, table: str, p: Params) -> DataFrame:
    """JN3 + JN4 from the stored days: the lean hits of the sampled installers, in their interval."""
    devices = _between(spark.table(f"{table}_devices"), p.period_start, p.last_hit_day).select("id_ga", "advertising_id").distinct()
    vim = J.visitor_install_map(devices, J.sampled_installs(installs, p))
    last = J.last_hit_day(p)
    hits = _between(spark.table(table), p.sample_start, last)
    return J.hits_after_install(hits.select(*J.LEAN_COLUMNS), vim, p).select(*J.LEAN_COLUMNS, *J.INSTALL_ATTRS, "uninstall")


def build_joined(spark: SparkSession, installs: DataFrame, table: str, customers: DataFrame, p: Params) -> DataFrame:
    """PIP3 over the stored hits."""
    return J.join_customers(sampled_lean_hits(spark, installs, table, p), customers, p)
