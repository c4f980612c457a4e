"""Adapter: the driver's synthetic tables -> the three input contracts.

`events` becomes both the attribution event table and the nested hit table,
`customer` becomes the customer table. The mapping rules below are ours (test
data design); they are mirrored one to one by the DuckDB twin in
`attrition.plans.oracle` so both engines see the same inputs.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrition.config import Params
from attrition.functions import values as V
from attrition.sources import schemas

GUID_ZERO = "00000000-0000-0000-0000-000000000000"
AS_OF = "2024-01-31"
BRAND = "BRAND_A"
DELIVERY_ERROR = "desculpe! no momento este produto nao pode ser entregue na regiao informada. (id-1200)"

# The job that the registered queries run: the installs of one whole month, sampled over its first half. The adapter
# spreads each user over 16 devices and moves the events ten days back, so that the hits lie in two years and months.
PARAMS = Params.for_month("2024-01", sample_start="2024-01-01", sample_end="2024-01-15", brand=BRAND, as_of=AS_OF,
                          outliers="exact")

# The one-hot vocabulary of that job: the closed columns' fixed values, and the adapter's channels.
CHANNELS = ("ch0", "ch1", "ch2")
VOCABULARY = (
    [("faixa_etaria", v) for v in (*[label for _, label in V.AGE_BANDS], V.AGE_BAND_ELSE, V.MISSING_LABEL)]
    + [("sexo", v) for v in ("F", "M", V.MISSING_LABEL)]
    + [("screen_view", v) for v in V.SCREEN_TEMPLATES]
    + [("produto_view", v) for v in (V.TAIL_LABEL, V.CORE_LABEL)]
    + [("action_event_v1", v) for v in V.ACTION_EVENTS_V1]
    + [("action_event_v2", v) for v in (*[a for a in V.ACTION_EVENTS_V2 if a not in V.LOGIN_ACTIONS and a != V.DELIVERY_ERROR_EVENT],
                                        V.DELIVERY_ERROR_LABEL, V.LOGIN_ACTION_LABEL)]
    + [("regioes", label) for label, _ in V.REGION_BUCKETS]
    + [("install_channel", v) for v in CHANNELS]
    + [("canais", v) for v in (*V.KEPT_CHANNELS, V.OTHER_CHANNELS_LABEL,
                               *[V.INSTALL_CHANNEL_PREFIX + g for g in ("Organico", "install_aquisicao", V.OTHER_LABEL)])]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _ev(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp") - F.expr("INTERVAL 10 DAYS")
    k = F.regexp_replace("props", "[^0-9]", "").cast("int")
    return events.select("event_id", ts.alias("ts"), "user_id", "event_type", k.alias("k"), ts.cast("date").alias("d"),
                         F.dayofmonth(ts).alias("dom"), (F.col("user_id") * 16 + k % 16).alias("dev"))


def _brand(uid):
    return F.when(uid % 10 == 9, "OTHER").otherwise("BRAND_A")


def _os(uid):
    return F.when(uid % 7 == 6, "iOS").otherwise("Android")


def attribution_events(events: DataFrame) -> DataFrame:
    ev = _ev(events)
    uid, eid, k, et, dev = (F.col(c) for c in ("user_id", "event_id", "k", "event_type", "dev"))
    return ev.select(
        F.when(eid % 97 == 0, "0000-0000").when(eid % 101 == 0, GUID_ZERO)
         .when(eid % 103 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("a"), dev.cast("string"))).alias("advertising_id"),
        F.concat(F.lit("d"), dev.cast("string")).alias("appsflyer_id"),
        F.when((et == "signup") & (eid % 5 == 0), "reinstall").when(et == "signup", "install")
         .when((et == "error") & (eid % 2 == 0), "uninstall").when(et == "error", "af_error")
         .when(et == "view", "af_login").otherwise(et).alias("event_name"),
        F.col("ts").alias("event_time"),
        # now and then the day on record is not the day of the instant
        F.when(eid % 53 == 0, F.date_sub("d", 1)).otherwise(F.col("d")).alias("event_time_sm"),
        F.when(k % 4 == 0, "Organico").when(k % 4 == 1, "Install Aquisicao")
         .when(k % 4 == 2, "Remarketing").alias("atribuicao_canais"),
        F.when(k % 5 == 0, "facebook ads").when(k % 5 == 1, "googleadwords_int")
         .when(k % 5 == 2, "restricted").when(k % 5 == 3, "other_net").alias("media_source"),
        F.concat(F.lit("ch"), (k % 3).cast("string")).alias("channel"),
        _brand(uid).alias("bandeira_partition"),
        _os(uid).alias("device"),
    )


def _dim(index: int, value):
    return F.struct(F.lit(index).cast("int").alias("index"), value.cast("string").alias("value"))


def hits(events: DataFrame) -> DataFrame:
    ev = _ev(events)
    uid, eid, k, dom, et, dev = (F.col(c) for c in ("user_id", "event_id", "k", "dom", "event_type", "dev"))
    hit_no = F.row_number().over(Window.partitionBy("dev", "d").orderBy("ts", "event_id"))
    session_key = dev * 31 + dom
    screen = (F.when(k % 6 == 0, "busca").when(k % 6 == 1, "produto").when(k % 6 == 2, "home")
              .when(k % 6 == 3, "").when(k % 6 == 4, "outra"))
    dept = (F.when(eid % 5 == 0, "moveis").when(eid % 5 == 1, "games").when(eid % 5 == 2, "outro depto")
            .when(eid % 5 == 3, ""))
    hit_dims = F.when(eid % 10 == 9, F.array().cast(schemas.DIMENSIONS)).otherwise(
        F.array(_dim(5, screen), _dim(6, dept)))
    visit_dims = F.filter(F.array(
        _dim(4, F.when(uid % 3 == 0, "deslogado").otherwise("logado")),
        F.when(uid % 3 != 0, _dim(68, uid.cast("string"))),
        _dim(69, F.when(dev % 13 == 0, "0000-0000").otherwise(F.concat(F.lit("a"), dev.cast("string")))),
    ), lambda x: x.isNotNull())
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    day_number = (F.year("d") * 10000 + F.month("d") * 100 + F.col("dom")).cast("int")
    return ev.select(
        F.concat(F.lit("g"), dev.cast("string")).alias("FullVisitorId"),
        day_number.cast("long").alias("visitId"),
        F.when(dev % 29 != 0, F.datediff("d", F.lit("2023-12-01").cast("date"))).cast("int").alias("visitNumber"),
        day_number.alias("date"),
        F.when((uid + dom) % 4 == 0, "SEM - Shopping").when((uid + dom) % 4 == 1, "CRM - Marketing Direto")
         .when((uid + dom) % 4 == 2, "Organic Search").otherwise("Remarketing").alias("channelGrouping"),
        F.struct(_os(uid).alias("operatingSystem")).alias("device"),
        F.struct(F.when(uid % 7 == 0, "State of Sao Paulo").when(uid % 7 == 1, "State of Parana")
                 .when(uid % 7 == 2, "State of Para").when(uid % 7 == 3, "Federal District")
                 .when(uid % 7 == 4, "State of Bahia").when(uid % 7 == 5, "Lisbon")
                 .alias("region")).alias("geoNetwork"),
        F.struct(((uid + dom) % 5 == 0).alias("isTrueDirect")).alias("trafficSource"),
        F.struct((session_key % 40).cast("int").alias("hits"),
                 (session_key % 20).cast("int").alias("screenviews"),
                 (session_key % 11).cast("int").alias("UniqueScreenviews"),
                 F.when(uid % 50 != 0, ((dev * 7 + dom) % 100).cast("int")).alias("sessionQualityDim"),
                 ).alias("totals"),
        visit_dims.alias("customDimensions"),
        F.struct(
            hit_no.cast("int").alias("HitNumber"),
            (seconds * 1000).cast("long").alias("time"),
            # some hours and minutes are malformed or missing
            F.when(eid % 89 == 0, "xx").otherwise(F.hour("ts").cast("string")).alias("hour"),
            F.when(eid % 83 != 0, F.minute("ts").cast("string")).alias("minute"),
            hit_dims.alias("customDimensions"),
            F.struct(
                F.when(et == "view", "produto").when(et == "click", "acesso")
                 .when(et == "purchase", "carrinho").otherwise("erro").alias("eventCategory"),
                F.when(et == "view", "navegou").when(et == "click", "clicou")
                 .when(et == "purchase", "calculou").when(k % 7 == 0, "exibiu").alias("eventAction"),
                F.when((et == "click") & (k % 2 == 0), "senha").when(et == "click", "ativou biometria")
                 .when(et.isin("error", "signup") & (k % 7 == 0), DELIVERY_ERROR).alias("eventLabel"),
            ).alias("eventInfo"),
        ).alias("hits"),
        F.when(uid % 12 == 11, "WEB").otherwise("APP").alias("OrigemParticao"),
        F.date_format("d", "yyyy").alias("AaParticao"),
        F.date_format("d", "MM").alias("MmParticao"),
        _brand(uid).alias("BandeiraParticao"),
    )


def customers(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    # some customers are recorded twice: the same row, or another sex
    copies = F.when(ck % 19 == 0, F.array(F.lit(0), F.lit(0))).when(ck % 31 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = customer.select("c_custkey", F.explode(copies).alias("copy"))
    return rows.select(
        F.when(ck % 11 == 0, "LOJA").otherwise("SITE").alias("origem"),
        F.when(ck % 17 == 0, "OTHER").otherwise("BRAND_A").alias("bandeira"),
        ck.cast("string").alias("idcliente"),
        F.when((ck + F.col("copy")) % 5 == 0, "M").when((ck + F.col("copy")) % 5 == 1, "m")
         .when((ck + F.col("copy")) % 5 == 2, "F").when((ck + F.col("copy")) % 5 == 3, "f").alias("sexo"),
        F.when(ck % 23 != 0, F.date_sub(F.lit(AS_OF).cast("date"), (F.lit(6000) + (ck * 17) % 22000).cast("int")))
         .alias("datanascimento"),
    )


def build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three contract tables as lazy plans over the driver tables in `sf_dir`."""
    events = read_table(spark, sf_dir, "events")
    return {
        "attribution_events": attribution_events(events),
        "hits": hits(events),
        "customers": customers(read_table(spark, sf_dir, "customer")),
    }


_MATERIALISED: dict[tuple, dict[str, tuple]] = {}


def load(spark: SparkSession, sf_dir: str, materialise: bool = True) -> dict[str, DataFrame]:
    """The three contract tables, read as Parquet like the production tables.

    The first call per session and directory writes them once under the
    shared checkpoint folder (the hit table partitioned by its partition
    columns); later calls only read. ``materialise=False`` returns the lazy
    plans instead.
    """
    if not materialise:
        return build(spark, sf_dir)
    from attrition.session import app_key, scratch_path

    key = (app_key(spark), os.path.abspath(sf_dir))
    paths = _MATERIALISED.get(key)
    if paths is None:
        base = scratch_path(spark, "contracts")
        paths = {}
        for name, df in build(spark, sf_dir).items():
            path = os.path.join(base, name)
            w = df.write.mode("overwrite")
            if name == "hits":
                w = w.partitionBy(*PARTITIONS)
            w.parquet(path)
            # read back with the declared schema: partition values stay strings ('01', not 1)
            paths[name] = (path, df.schema)
        _MATERIALISED[key] = paths
        _FRAMES.pop(key, None)
    frames = _FRAMES.get(key)
    if frames is None:
        frames = _FRAMES[key] = {name: spark.read.schema(schema).parquet(path)
                                 for name, (path, schema) in paths.items()}
    return dict(frames)


_FRAMES: dict[tuple, dict[str, DataFrame]] = {}


PARTITIONS = ("OrigemParticao", "AaParticao", "MmParticao", "BandeiraParticao")
