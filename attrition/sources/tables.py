"""Scans of the three inputs with their filters (SRC1-SRC3).

Each loader takes a DataFrame (so tests can pass adapted tables) and keeps all
filters as plain column predicates, which Catalyst pushes into the Parquet
scan, including the nested `device.operatingSystem` predicate and partition
pruning on the string partition columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.config import Params
from attrition.functions import recodes as R
from attrition.functions import time as TM
from attrition.functions import values as V


def check_contract(df: DataFrame, schema, name: str) -> DataFrame:
    """Fail early, with the missing names, when an input lacks contract columns."""
    from attrition.sources.schemas import missing_columns

    missing = missing_columns(df, schema)
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df


def customers_with_age_band(customers: DataFrame, p: Params) -> DataFrame:
    """SRC1: customers of one origin and brand, with an age band, deduplicated."""
    return (customers
            .filter(F.col("origem") == p.customer_origin)
            .filter(F.col("bandeira") == p.brand)
            .select("idcliente", "sexo",
                    R.age_band("datanascimento", F.current_date() if p.as_of is None else F.lit(p.as_of).cast("date"))
                    .alias("faixa_etaria"))
            .dropDuplicates())


def raw_date_between(hits: DataFrame, first: str, last: str):
    """Predicate on the raw `yyyyMMdd` hit date (int or text), so it reaches the Parquet scan."""
    return F.col("date").between(_raw_date(hits, first), _raw_date(hits, last))


def _raw_date(hits: DataFrame, day: str):
    raw = day.replace("-", "")
    return F.lit(raw if isinstance(hits.schema["date"].dataType, T.StringType) else int(raw))


def in_hit_months(hits: DataFrame, p: Params):
    """Predicate for the hit partitions of the period, each month with its own year; of a month that the period does not
    reach, only the days up to the last one wanted. The partition equalities stay prunable."""
    within = None
    for year, month in p.hit_months:
        part = (F.col("AaParticao") == year) & (F.col("MmParticao") == month)
        if f"{year}-{month}" > p.period_end[:7]:
            part = part & (F.col("date") <= _raw_date(hits, p.last_hit_day))
        within = part if within is None else within | part
    return within


def normalised_hits(hits: DataFrame, p: Params, days: tuple[str, str] | None = None) -> DataFrame:
    """SRC2 (first frame): hits of one origin, period partitions, brand and OS.

    Adds `date` as a DATE, the minute-resolution `timestamp_hit` text and `id_ga`.
    ``days`` (first, last), when given, also keeps only those hit days.
    """
    cond = ((F.col("OrigemParticao") == p.hit_origin)
            & in_hit_months(hits, p)
            & (F.col("BandeiraParticao") == p.brand)
            & (F.col("device.operatingSystem") == p.os))
    if days is not None:
        cond = cond & raw_date_between(hits, *days)
    date = TM.parse_yyyymmdd("date")
    return hits.filter(cond).withColumns({
        "date": date,
        "timestamp_hit": TM.hit_timestamp(date, "hits.hour", "hits.minute", p.timestamp_mode),
        "id_ga": F.col("FullVisitorId")})


def visitor_device_map(ga: DataFrame, *keep: str) -> DataFrame:
    """SRC2 (second frame): distinct (id_ga, advertising_id) from custom dimension 69, for each value of ``keep`` if given.

    Upstream emits one row per hit and deduplicates only after the join with the
    installs; deduplicating here gives the same join result from far fewer rows.
    """
    dims = F.filter(F.col("customDimensions"), lambda x: x["index"] == V.DEVICE_DIMENSION)
    return (ga.select("id_ga", *keep, F.explode(dims).alias("custom"))
            .select("id_ga", F.col("custom.value").alias("advertising_id"), *keep)
            .filter(R.valid_id("advertising_id"))
            .dropDuplicates())


def attribution_events(events: DataFrame, p: Params, dedupe: bool = True) -> DataFrame:
    """SRC3: one brand and device, logins excluded, full-row deduplicated.

    Every consumer in the install build projects and deduplicates again, so the
    build passes ``dedupe=False`` and saves one full shuffle of the event table.
    """
    out = events.filter((F.col("bandeira_partition") == p.brand) & (F.col("device") == p.device)
                        & (F.col("event_name") != V.LOGIN_EVENT))
    return out.dropDuplicates() if dedupe else out
