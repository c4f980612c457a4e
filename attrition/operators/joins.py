"""Three-source join (PIP3) and the hit facts it produces (PIP2).

Order of work, chosen for size: the hit rows are reduced (explode, project,
deduplicate with map-side combine) *before* they meet the per-session times
and the customers. Both are functions of a key that stays in the reduced rows
(`session_id`, `idcliente`), so deduplicating first and again at the end gives
exactly the upstream rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.config import Params
from attrition.functions import recodes as R
from attrition.functions import values as V
from attrition.operators import hits as H
from attrition.session import materialise

INSTALL_ATTRS = ["install_manha", "install_tarde", "install_noite", "install_madrugada", "install_grouping",
                 "install_channel", "total_installs_antigos", "recencia_last_install"]
# what the facts need of a hit; everything else stays out of the wide join's shuffle
LEAN_COLUMNS = ["id_ga", "date", "session_id", "visitNumber", "channelGrouping", "isTrueDirect", "regioes", "hits",
                "screenviews", "UniqueScreenviews", "sessionQualityDim", "action_event_v1", "action_event_v2", "dims",
                "timestamp_hit", "idcliente"]
FACT_COLUMNS = ["id_ga", "sexo", "faixa_etaria", "session_id", "hits", "screenviews", "UniqueScreenviews",
                "sessionQualityDim", "visitNumber", "channelGrouping", "SessionVisitTime_minutes", "regioes",
                *INSTALL_ATTRS, "isTrueDirect", "screen_view", "produto_view", "action_event_v1",
                "action_event_v2", "uninstall"]


def visitor_install_map(device_map: DataFrame, sample: DataFrame) -> DataFrame:
    """JN3: visitors of the sampled installs.

    The device map is distinct on (id_ga, advertising_id) and the sample has one
    row per advertising id, so the join output is already distinct.
    """
    return device_map.join(sample.withColumnRenamed("advertising_appsflyer", "advertising_id"),
                           "advertising_id", "inner")


def hits_after_install(ga: DataFrame, vim: DataFrame, p: Params) -> DataFrame:
    """JN4: hits of those visitors from the install day to `hit_days_after_install` later."""
    joined = ga.join(vim, "id_ga", "inner")
    d, start = F.col("date"), F.col("install_date_sm")
    return joined.filter((d >= start) & (d <= F.date_add(start, p.hit_days_after_install)))


def _dimension_pairs(p: Params) -> F.Column:
    """The distinct (screen_view, produto_view) pairs of a hit's custom dimensions."""
    return F.array_distinct(F.transform("hits.customDimensions", lambda x: F.struct(
        R.whitelist(R.dimension_value(x, V.SCREEN_DIMENSION), V.SCREEN_TEMPLATES).alias("screen_view"),
        R.product_class(R.dimension_value(x, V.DEPARTMENT_DIMENSION), p.fix_tail).alias("produto_view"))))


def lean_hits(ga: DataFrame, p: Params) -> DataFrame:
    """The scanned hits as flat, recoded columns (see ``LEAN_COLUMNS``): the nested arrays and structs end here."""
    actions = H.action_columns(p)
    return ga.select(
        "id_ga", "date", H.session_id().alias("session_id"), "visitNumber", "channelGrouping",
        F.col("trafficSource.isTrueDirect").alias("isTrueDirect"),
        R.region_bucket("geoNetwork.region", p.fix_region).alias("regioes"),
        F.col("totals.hits").alias("hits"), F.col("totals.screenviews").alias("screenviews"),
        F.col("totals.UniqueScreenviews").alias("UniqueScreenviews"),
        F.col("totals.sessionQualityDim").alias("sessionQualityDim"),
        actions["action_event_v1"].alias("action_event_v1"), actions["action_event_v2"].alias("action_event_v2"),
        _dimension_pairs(p).alias("dims"), "timestamp_hit",
        R.first_dimension("customDimensions", V.CUSTOMER_DIMENSION).alias("idcliente"))


def _customer_key(idcliente: F.Column, session: F.Column) -> F.Column:
    """The join key of a customer id; hits without one are spread by session and meet no customer."""
    none = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(session), F.lit(1024)).cast("string"))
    return F.coalesce(idcliente, none)


def session_facts(bruto: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """PIP2: distinct session-and-action rows with customer attributes.

    ``bruto`` are the joined ``lean_hits``; ``customers`` has `idcliente, sexo, faixa_etaria`.
    """
    carried = [c for c in LEAN_COLUMNS if c not in ("date", "dims", "timestamp_hit")]
    rows = (bruto.select(*carried, *INSTALL_ATTRS, "uninstall", F.explode("dims").alias("dim"))
            .select("*", "dim.screen_view", "dim.produto_view").drop("dim")
            .dropDuplicates())
    times = H.session_times(bruto).select(F.col("session_id").alias("sid"), "SessionVisitTime_minutes")
    with_times = rows.join(times, rows["session_id"].eqNullSafe(times["sid"]), "inner").drop("sid")
    # no hint: Spark broadcasts the customers only if they are measured to be small,
    # else a shuffle join, in which a hot customer id on the hit side is split
    keyed = with_times.withColumn("customer", _customer_key(F.col("idcliente"), F.col("session_id")))
    cust = customers.where(F.col("idcliente").isNotNull()).select(F.col("idcliente").alias("customer"), "sexo", "faixa_etaria")
    return (keyed.join(cust, "customer", "left")
            .select(*FACT_COLUMNS)
            .dropDuplicates())


def first_visits(rows: DataFrame) -> DataFrame:
    """Per visitor: smallest visit number and whether any visit number is null."""
    return rows.groupBy("id_ga").agg(F.min("visitNumber").alias("_first_visit"),
                                     F.max(F.col("visitNumber").isNull()).alias("_has_null_visit"))


def first_visits_from_hits(bruto: DataFrame) -> DataFrame:
    """The same figures taken from the joined lean hits.

    A hit yields fact rows exactly when its dimension array is non-empty (the
    explode drops the rest, the later joins keep every row), so this equals
    `first_visits(facts)` without reading the facts a second time.
    """
    return first_visits(bruto.filter(F.size("dims") > 0))


def first_visit_flag(facts: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """WIN4 as an aggregate + join: dense_rank(visitNumber) = 1 per visitor.

    Rank 1 is the smallest visit number, or the null visit numbers when a
    visitor has any (ascending order puts nulls first). Unlike a window, the
    grouped minimum is combined map-side and the join can be split when one
    visitor is hot.
    """
    first = first_visits(facts) if first is None else first
    vn = F.col("visitNumber")
    flag = F.when(F.col("_has_null_visit"), vn.isNull()).otherwise(vn == F.col("_first_visit"))
    return (facts.join(first, "id_ga", "inner").withColumn("is_first_visit", flag)
            .drop("_first_visit", "_has_null_visit"))


def with_channel_latency0(facts: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """CND10: latency-0 channel, then drop the columns it consumed."""
    flagged = first_visit_flag(facts, first)
    return (flagged.withColumn("channelGrouping_latencia0",
                               R.channel_latency0(F.col("is_first_visit"), "install_grouping", "isTrueDirect",
                                                  "channelGrouping"))
            .drop("isTrueDirect", "channelGrouping", "install_grouping", "visitNumber", "is_first_visit"))


def _after_install(installs: DataFrame, hits: DataFrame, p: Params, project: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """JN3 + JN4: projected hits of the sampled installers, in their interval.

    The visitor map needs the whole period's hits; the joined side only needs
    hit days from the first sampled install day to `hit_days_after_install`
    after the last (nothing else can pass the interval), so that scan is
    restricted to those days, and projected before the join's shuffle.
    """
    from attrition.sources import tables

    ga = tables.normalised_hits(hits, p)
    vim = visitor_install_map(tables.visitor_device_map(ga), sampled_installs(installs, p))
    ga_days = tables.normalised_hits(hits, p, days=(p.sample_start, last_hit_day(p)))
    return hits_after_install(project(ga_days), vim, p)


def sampled_hits(installs: DataFrame, hits: DataFrame, p: Params) -> DataFrame:
    """JN3 + JN4 + ARR3: whole hits of the sampled installers, with login flag and customer id."""
    return H.with_session_dimensions(_after_install(installs, hits, p, lambda ga: ga))


def sampled_lean_hits(installs: DataFrame, hits: DataFrame, p: Params) -> DataFrame:
    """The same hits as the facts need them."""
    rows = _after_install(installs, hits, p, lambda ga: lean_hits(ga, p))
    return rows.select(*LEAN_COLUMNS, *INSTALL_ATTRS, "uninstall")


def build_joined(installs: DataFrame, hits: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """PIP3: installs x hits x customers -> distinct session-and-action rows.

    ``installs`` is the install definition table (PIP1 output), ``hits`` the raw
    hit table and ``customers`` the raw customer table.
    """
    return join_customers(sampled_lean_hits(installs, hits, p), customers, p)


def join_customers(sampled: DataFrame, customers: DataFrame, p: Params) -> DataFrame:
    """PIP3 from the sampled lean hits on."""
    from attrition.sources import tables

    # the sampled hits feed three aggregates (facts, session times, first
    # visits): written once instead of re-scanning and re-joining the hit table
    bruto = materialise(sampled, p.materialise, "sampled-hits")
    cust = tables.customers_with_age_band(customers, p)
    return with_channel_latency0(session_facts(bruto, cust, p), first_visits_from_hits(bruto))


def last_hit_day(p: Params) -> str:
    """The last day on which a hit can be in the interval of a sampled install."""
    return (dt.date.fromisoformat(p.sample_end) + dt.timedelta(days=p.hit_days_after_install)).isoformat()


def sampled_installs(installs: DataFrame, p: Params) -> DataFrame:
    from attrition.operators.installs import sample_range

    return sample_range(installs, p)
