"""Registered queries: key -> (Spark callable, DuckDB twin).

Every callable takes (spark, sf_dir), reads the driver tables through the
adapter and runs the library operators on the whole tables. Dates and
timestamps are rendered as text at the very end (`for_check`) so both engines
hand the comparison the same representation.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.config import ModelConfig
from attrition.functions import recodes as R
from attrition.functions import values as V
from attrition.operators import boosting as BO
from attrition.operators import features as FT
from attrition.operators import hit_store as HS
from attrition.operators import hits as H
from attrition.operators import installs as I
from attrition.operators import joins as J
from attrition.operators import model as M
from attrition.operators import sink as S
from attrition.operators import sketches as SK
from attrition.operators import sparse as SP
from attrition.plans import jobs as JB
from attrition.plans.oracle import (BASE_MODELAGEM, D, EV1, EV2, GROUPING, MODEL_COLS, NUMERIC, ONEHOT_ROWS, SOURCE, TS,
                                    UN_COND, _dayparts, _in, _q, corr_pairs, first_dim, product_sql, region_sql,
                                    valid, with_ctes)
from attrition.session import app_key, materialise, scratch_path
from attrition.sources import tables, testmap

P = testmap.PARAMS
VOCABULARY = testmap.VOCABULARY

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir, fn=fn: for_check(fn(spark, sf_dir))
        ORACLE[name] = sql
        return fn
    return deco


def for_check(df: DataFrame) -> DataFrame:
    fields = df.schema.fields
    if not any(isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) for f in fields):
        return df
    exprs = []
    for f in fields:
        n = FT.sql_name(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            exprs.append(f"date_format({n}, 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS {n}")
        elif isinstance(f.dataType, T.DateType):
            exprs.append(f"CAST({n} AS STRING) AS {n}")
        else:
            exprs.append(n)
    return df.selectExpr(*exprs)


def inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return testmap.load(spark, sf_dir)


def attribution(spark, sf_dir):
    return tables.attribution_events(inputs(spark, sf_dir)["attribution_events"], P)


def events_for_installs(spark, sf_dir):
    return tables.attribution_events(inputs(spark, sf_dir)["attribution_events"], P, dedupe=False)


def ga(spark, sf_dir):
    return tables.normalised_hits(inputs(spark, sf_dir)["hits"], P)


def installs_definitive(spark, sf_dir):
    return I.build_installs(inputs(spark, sf_dir)["attribution_events"], P)


def ga_bruto(spark, sf_dir):
    t = inputs(spark, sf_dir)
    return J.sampled_hits(I.build_installs(t["attribution_events"], P), t["hits"], P)


def session_facts(spark, sf_dir):
    t = inputs(spark, sf_dir)
    bruto = materialise(J.sampled_lean_hits(I.build_installs(t["attribution_events"], P), t["hits"], P))
    return J.session_facts(bruto, tables.customers_with_age_band(t["customers"], P), P)


def joined_facts(spark, sf_dir):
    t = inputs(spark, sf_dir)
    return J.build_joined(I.build_installs(t["attribution_events"], P), t["hits"], t["customers"], P)


def user_aggregates(spark, sf_dir):
    return FT.user_aggregates(joined_facts(spark, sf_dir), P)


# ============================================================ step 1: scans and recodes
@register("attribution_events", with_ctes(
    f"SELECT advertising_id, appsflyer_id, event_name, {TS('event_time', 'event_time')}, "
    f"{D('event_time_sm', 'event_time_sm')}, atribuicao_canais, media_source, channel, bandeira_partition, device "
    "FROM af", "af"))
def q_attribution_events(spark, sf_dir):
    return attribution(spark, sf_dir)


@register("valid_id_filter", with_ctes(
    f"SELECT advertising_id, appsflyer_id, event_name, {TS('event_time', 'event_time')} FROM af "
    f"WHERE {valid('advertising_id')}", "af"))
def q_valid_id_filter(spark, sf_dir):
    return (attribution(spark, sf_dir).filter(R.valid_id("advertising_id"))
            .select("advertising_id", "appsflyer_id", "event_name", "event_time"))


@register("customers_age_band", with_ctes("SELECT idcliente, sexo, faixa_etaria FROM cli", "cli"))
def q_customers_age_band(spark, sf_dir):
    return tables.customers_with_age_band(inputs(spark, sf_dir)["customers"], P)


@register("attribution_recode", with_ctes(
    f"SELECT appsflyer_id, event_name, {TS('event_time', 'event_time')}, atribuicao_canais, media_source, "
    f"{GROUPING} AS install_grouping, {SOURCE} AS install_source FROM af", "af"))
def q_attribution_recode(spark, sf_dir):
    return attribution(spark, sf_dir).select(
        "appsflyer_id", "event_name", "event_time", "atribuicao_canais", "media_source",
        R.attribution_channel("atribuicao_canais").alias("install_grouping"),
        R.media_source("media_source", P.media_sources).alias("install_source"))


@register("install_daypart", with_ctes(
    f"SELECT appsflyer_id, {TS('event_time', 'event_time')}, CAST(hour(event_time) AS INTEGER) AS install_hour, "
    f"{_dayparts('hour(event_time)')} FROM af WHERE event_name IN ('install', 'reinstall')", "af"))
def q_install_daypart(spark, sf_dir):
    ev = attribution(spark, sf_dir).filter(F.col("event_name").isin(*V.INSTALL_EVENTS))
    return (ev.select("appsflyer_id", "event_time", F.hour("event_time").alias("install_hour"))
            .withColumns(R.daypart_flags(F.col("install_hour"))))


@register("dedupe_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem")
def q_dedupe_rows(spark, sf_dir):
    li = testmap.read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").dropDuplicates()


# ============================================================ step 2: installs
@register("installs_single", with_ctes(
    f"SELECT advertising_appsflyer, appsflyer_id, {TS('install_date', 'install_date')}, "
    f"{D('install_date_sm', 'install_date_sm')}, install_manha, install_tarde, install_noite, install_madrugada, "
    "install_grouping, install_channel, install_source FROM inst", "inst"))
def q_installs_single(spark, sf_dir):
    return I.single_installs(events_for_installs(spark, sf_dir), P)


@register("uninstall_within_window", with_ctes(
    f"SELECT i.advertising_appsflyer, i.appsflyer_id, {TS('i.install_date', 'install_date')}, "
    f"{TS('u.uninstall_date', 'uninstall_date')}, COALESCE(u.uninstall, 0) AS uninstall "
    f"FROM inst i LEFT JOIN un u ON {UN_COND}", "inst", "un"))
def q_uninstall_within_window(spark, sf_dir):
    ev = events_for_installs(spark, sf_dir)
    m = I.uninstall_matches(I.single_installs(ev, P), I.uninstalls(ev), P.uninstall_window_days)
    return m.select("advertising_appsflyer", "appsflyer_id", "install_date", "uninstall_date", "uninstall")


@register("install_history", with_ctes(
    f"SELECT advertising_appsflyer, {D('install_date_sm', 'install_date_sm')}, total_installs_antigos, "
    f"{TS('last_install_antigo', 'last_install_antigo')}, "
    "COALESCE(CAST(date_diff('day', CAST(last_install_antigo AS DATE), install_date_sm) AS INTEGER), -1) "
    "AS recencia_last_install FROM ("
    "  SELECT i.advertising_appsflyer, i.install_date_sm, "
    "         CAST(sum(COALESCE(a.install_antigo, 0)) AS BIGINT) AS total_installs_antigos, "
    "         max(a.install_date_antigo) AS last_install_antigo "
    "  FROM inst i LEFT JOIN antigo a "
    "    ON i.advertising_appsflyer = a.advertising_antigo AND i.install_date > a.install_date_antigo "
    "  GROUP BY i.advertising_appsflyer, i.install_date_sm)", "inst", "antigo"))
def q_install_history(spark, sf_dir):
    return I.install_history(events_for_installs(spark, sf_dir), P)


_DEF_COLS = ("advertising_appsflyer, appsflyer_id, {d}, install_manha, install_tarde, install_noite, "
             "install_madrugada, install_grouping, install_channel, install_source, uninstall, "
             "total_installs_antigos, recencia_last_install").format(d=D("install_date_sm", "install_date_sm"))


@register("installs_definitive", with_ctes(f"SELECT {_DEF_COLS} FROM definitivo", "definitivo"))
def q_installs_definitive(spark, sf_dir):
    return installs_definitive(spark, sf_dir)


@register("install_sample_range", with_ctes(f"SELECT {_DEF_COLS} FROM amostra_af", "amostra_af"))
def q_install_sample_range(spark, sf_dir):
    return I.sample_range(installs_definitive(spark, sf_dir), P)


# ============================================================ step 3: nested hits
@register("hits_normalised", with_ctes(
    f"SELECT id_ga, visitId, visitNumber, hits.HitNumber AS hit_number, {D('date', 'date')}, timestamp_hit "
    "FROM ga", "ga"))
def q_hits_normalised(spark, sf_dir):
    return ga(spark, sf_dir).select("id_ga", "visitId", "visitNumber", F.col("hits.HitNumber").alias("hit_number"),
                                    "date", "timestamp_hit")


@register("visitor_device_map", with_ctes("SELECT DISTINCT id_ga, advertising_id FROM ga_amostra", "ga_amostra"))
def q_visitor_device_map(spark, sf_dir):
    return tables.visitor_device_map(ga(spark, sf_dir))


@register("session_dimension_lookup", with_ctes(
    f"SELECT DISTINCT id_ga, visitId, CASE WHEN {first_dim(4)} = 'logado' THEN 1 END AS logado, "
    f"{first_dim(68)} AS idcliente FROM ga", "ga"))
def q_session_dimension_lookup(spark, sf_dir):
    return (H.with_session_dimensions(ga(spark, sf_dir))
            .select("id_ga", "visitId", "logado", "idcliente").dropDuplicates())


@register("hit_dimensions", with_ctes(
    "SELECT id_ga, visitId, hit_number, custom_hit.index AS dim_index, "
    "CASE WHEN custom_hit.index = 5 AND custom_hit.value <> '' THEN custom_hit.value END AS template_screen, "
    "CASE WHEN custom_hit.index = 6 AND custom_hit.value <> '' THEN custom_hit.value END AS depart_pageview "
    "FROM (SELECT id_ga, visitId, hits.HitNumber AS hit_number, unnest(hits.customDimensions) AS custom_hit FROM ga)",
    "ga"))
def q_hit_dimensions(spark, sf_dir):
    g = ga(spark, sf_dir).withColumn("hit_number", F.col("hits.HitNumber"))
    return (H.exploded_dimensions(g, "id_ga", "visitId", "hit_number", "hits")
            .select("id_ga", "visitId", "hit_number", F.col("custom_hit.index").alias("dim_index"),
                    "template_screen", "depart_pageview"))


@register("hit_actions", with_ctes(
    f"SELECT id_ga, visitId, hits.HitNumber AS hit_number, {EV1} AS event_v1, {EV2} AS event_v2, "
    f"CASE WHEN {EV1} IN {_in(V.ACTION_EVENTS_V1)} THEN {EV1} END AS action_event_v1, "
    f"CASE WHEN {EV2} IN {_in(V.ACTION_EVENTS_V2)} THEN {EV2} END AS action_event_v2 FROM ga", "ga"))
def q_hit_actions(spark, sf_dir):
    ev, act = H.event_names(), H.action_columns(P)
    return ga(spark, sf_dir).select("id_ga", "visitId", F.col("hits.HitNumber").alias("hit_number"),
                                    ev["event_v1"].alias("event_v1"), ev["event_v2"].alias("event_v2"),
                                    act["action_event_v1"].alias("action_event_v1"),
                                    act["action_event_v2"].alias("action_event_v2"))


@register("product_class", with_ctes(
    f"SELECT depart_pageview, {product_sql('depart_pageview')} AS produto_view, count(*) AS n FROM ("
    "  SELECT CASE WHEN c.index = 6 AND c.value <> '' THEN c.value END AS depart_pageview "
    "  FROM (SELECT unnest(hits.customDimensions) AS c FROM ga)) GROUP BY ALL", "ga"))
def q_product_class(spark, sf_dir):
    d = H.exploded_dimensions(ga(spark, sf_dir))
    return (d.groupBy("depart_pageview", R.product_class("depart_pageview", P.fix_tail).alias("produto_view"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("region_bucket", with_ctes(
    f"SELECT geoNetwork.region AS region, {region_sql('geoNetwork.region')} AS regioes, count(*) AS n "
    "FROM ga GROUP BY ALL", "ga"))
def q_region_bucket(spark, sf_dir):
    return (ga(spark, sf_dir)
            .groupBy(F.col("geoNetwork.region").alias("region"),
                     R.region_bucket("geoNetwork.region", P.fix_region).alias("regioes"))
            .agg(F.count(F.lit(1)).alias("n")))


_HM = "strptime({c}, '%Y-%m-%d %H:%M')"


@register("session_duration", with_ctes(
    f"SELECT session_id, {TS(_HM.format(c='t_min'), 'visitStartTime')}, {TS(_HM.format(c='t_max'), 'visitEndTime')}, "
    "round((epoch(strptime(t_max, '%Y-%m-%d %H:%M')) - epoch(strptime(t_min, '%Y-%m-%d %H:%M'))) / 60, 2) "
    "AS SessionVisitTime_minutes FROM ("
    "  SELECT id_ga || CAST(visitId AS VARCHAR) AS session_id, min(timestamp_hit) AS t_min, "
    "         max(timestamp_hit) AS t_max FROM ga GROUP BY 1)", "ga"))
def q_session_duration(spark, sf_dir):
    return H.session_times(ga(spark, sf_dir)).select("session_id", "visitStartTime", "visitEndTime",
                                                      "SessionVisitTime_minutes")


@register("hit_rank", with_ctes(
    "SELECT session_id, hit_number, CAST(dense_rank() OVER (PARTITION BY session_id ORDER BY hit_number) AS INTEGER)"
    " AS hit_rank FROM (SELECT id_ga || CAST(visitId AS VARCHAR) AS session_id, hits.HitNumber AS hit_number FROM ga)",
    "ga"))
def q_hit_rank(spark, sf_dir):
    return H.hit_rank(ga(spark, sf_dir))


# ============================================================ step 4: three-way join
_VIM_COLS = ("advertising_id, id_ga, appsflyer_id, {d}, install_manha, install_tarde, install_noite, "
             "install_madrugada, install_grouping, install_channel, install_source, uninstall, "
             "total_installs_antigos, recencia_last_install").format(d=D("install_date_sm", "install_date_sm"))


@register("visitor_install_map", with_ctes(f"SELECT {_VIM_COLS} FROM ga_amostra_af", "ga_amostra_af"))
def q_visitor_install_map(spark, sf_dir):
    t = inputs(spark, sf_dir)
    sample = I.sample_range(I.build_installs(t["attribution_events"], P), P)
    return J.visitor_install_map(tables.visitor_device_map(tables.normalised_hits(t["hits"], P)), sample).select(
        "advertising_id", "id_ga", "appsflyer_id", "install_date_sm", "install_manha", "install_tarde",
        "install_noite", "install_madrugada", "install_grouping", "install_channel", "install_source", "uninstall",
        "total_installs_antigos", "recencia_last_install")


@register("hits_after_install", with_ctes(
    f"SELECT id_ga, visitId, hits.HitNumber AS hit_number, {D('date', 'date')}, advertising_id, "
    f"{D('install_date_sm', 'install_date_sm')}, uninstall FROM ga_definitivo", "ga_definitivo"))
def q_hits_after_install(spark, sf_dir):
    return ga_bruto(spark, sf_dir).select("id_ga", "visitId", F.col("hits.HitNumber").alias("hit_number"), "date",
                                          "advertising_id", "install_date_sm", "uninstall")


@register("hits_with_customer", with_ctes(
    "SELECT g.id_ga, g.visitId, g.hits.HitNumber AS hit_number, g.logado, g.idcliente, c.sexo, c.faixa_etaria "
    "FROM ga_bruto g LEFT JOIN cli c ON g.idcliente = c.idcliente", "ga_bruto", "cli"))
def q_hits_with_customer(spark, sf_dir):
    t = inputs(spark, sf_dir)
    cust = tables.customers_with_age_band(t["customers"], P)
    return (ga_bruto(spark, sf_dir)
            .select("id_ga", "visitId", F.col("hits.HitNumber").alias("hit_number"), "logado", "idcliente")
            .join(cust, "idcliente", "left")
            .select("id_ga", "visitId", "hit_number", "logado", "idcliente", "sexo", "faixa_etaria"))


@register("session_facts", with_ctes("SELECT * FROM facts", "facts"))
def q_session_facts(spark, sf_dir):
    return session_facts(spark, sf_dir)


@register("channel_latency0", with_ctes(
    "SELECT DISTINCT id_ga, session_id, visitNumber, "
    "CASE WHEN dense_rank() OVER (PARTITION BY id_ga ORDER BY visitNumber ASC NULLS FIRST) = 1 "
    "     THEN 'install : ' || install_grouping "
    "     WHEN CAST(isTrueDirect AS VARCHAR) = 'true' THEN 'Direto' ELSE channelGrouping END "
    "AS channelGrouping_latencia0 FROM facts", "facts"))
def q_channel_latency0(spark, sf_dir):
    flagged = J.first_visit_flag(session_facts(spark, sf_dir))
    return flagged.select(
        "id_ga", "session_id", "visitNumber",
        R.channel_latency0(F.col("is_first_visit"), "install_grouping", "isTrueDirect", "channelGrouping")
        .alias("channelGrouping_latencia0")).dropDuplicates()


@register("joined_facts", with_ctes("SELECT * FROM final_tratado", "final_tratado"))
def q_joined_facts(spark, sf_dir):
    return joined_facts(spark, sf_dir)


@register("joined_facts_stored", with_ctes("SELECT * FROM final_tratado", "final_tratado"))
def q_joined_facts_stored(spark, sf_dir):
    """PIP3 from hits stored by day and in buckets by visitor; the days after the 10th are stored a second time."""
    t = inputs(spark, sf_dir)
    table, path = _table(spark, "hits")
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    HS.store_hits(t["hits"], P, table, buckets=min(buckets, 64), path=path)
    HS.store_hits(t["hits"], P, table, days=("2024-01-11", "2024-01-14"), path=path)
    return HS.build_joined(spark, I.build_installs(t["attribution_events"], P), table, t["customers"], P)


# ============================================================ step 5: user features
@register("action_recode", with_ctes(
    f"SELECT action_event_v2 AS action_event_v2_raw, "
    f"CASE WHEN action_event_v2 = {_q(V.DELIVERY_ERROR_EVENT)} THEN 'erro_regiao_nao_entregue' "
    f"WHEN action_event_v2 IN {_in(V.LOGIN_ACTIONS)} THEN 'acesso_login_realizado' ELSE action_event_v2 END "
    f"AS action_event_v2, count(*) AS n FROM (SELECT CASE WHEN {EV2} IN {_in(V.ACTION_EVENTS_V2)} THEN {EV2} END "
    "AS action_event_v2 FROM ga) GROUP BY ALL", "ga"))
def q_action_recode(spark, sf_dir):
    act = H.action_columns(P)["action_event_v2"]
    return (ga(spark, sf_dir).select(act.alias("action_event_v2_raw"))
            .groupBy("action_event_v2_raw", R.action_recode("action_event_v2_raw").alias("action_event_v2"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("sex_normalised", with_ctes(
    "SELECT idcliente, sexo AS sexo_raw, CASE WHEN COALESCE(sexo, 'sem_info') IN ('M', 'm') THEN 'M' "
    "WHEN COALESCE(sexo, 'sem_info') IN ('F', 'f') THEN 'F' ELSE 'sem_info' END AS sexo, "
    "COALESCE(faixa_etaria, 'sem_info') AS faixa_etaria FROM cli", "cli"))
def q_sex_normalised(spark, sf_dir):
    c = tables.customers_with_age_band(inputs(spark, sf_dir)["customers"], P)
    return c.select("idcliente", F.col("sexo").alias("sexo_raw"), R.sex_normalise("sexo").alias("sexo"),
                    F.coalesce("faixa_etaria", F.lit(V.MISSING_LABEL)).alias("faixa_etaria"))


@register("channel_bucket", with_ctes(
    "SELECT channelGrouping_latencia0 AS channel_raw, CASE WHEN channelGrouping_latencia0 LIKE 'install :%' "
    "THEN channelGrouping_latencia0 WHEN channelGrouping_latencia0 IN "
    f"{_in(V.KEPT_CHANNELS)} THEN channelGrouping_latencia0 ELSE 'outros_canais' END AS canal, count(*) AS n "
    "FROM final_tratado GROUP BY ALL", "final_tratado"))
def q_channel_bucket(spark, sf_dir):
    j = joined_facts(spark, sf_dir)
    return (j.groupBy(F.col("channelGrouping_latencia0").alias("channel_raw"),
                      R.channel_bucket("channelGrouping_latencia0").alias("canal"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("visitor_action_sets", with_ctes("SELECT * FROM user_hitinfo", "user_hitinfo"))
def q_visitor_action_sets(spark, sf_dir):
    return FT.visitor_action_sets(FT.recode_sample(joined_facts(spark, sf_dir)))


_OUT_COLS = ["hits", "screenviews", "UniqueScreenviews", "sessionQualityDim", "SessionVisitTime_minutes"]


def _outlier_sql() -> str:
    def q(c, p):
        return f"(SELECT quantile_disc(CAST({c} AS DOUBLE), {p}) FROM user_sessoes)"

    repl = ", ".join(
        f"CASE WHEN {c} > {q(c, 0.95)} THEN {q(c, 0.5)} ELSE CAST({c} AS DOUBLE) END AS {c}" for c in _OUT_COLS)
    return with_ctes(
        f"SELECT u.id_ga, u.session_id, u.faixa_etaria, u.sexo, u.uninstall, u.channelGrouping_latencia0, {repl} "
        f"FROM user_sessoes u", "user_sessoes")


@register("outlier_replace", _outlier_sql())
def q_outlier_replace(spark, sf_dir):
    us = FT.user_sessions(FT.recode_sample(joined_facts(spark, sf_dir)))
    out = FT.replace_outliers(us, FT.OUTLIER_COLUMNS, "exact")
    return out.select("id_ga", "session_id", "faixa_etaria", "sexo", "uninstall", "channelGrouping_latencia0",
                      *FT.OUTLIER_COLUMNS)


def _merged_bounds_sql() -> str:
    def q(c, p):
        return f"(SELECT quantile_disc(CAST({c} AS DOUBLE), {p}) FROM user_sessoes)"

    return with_ctes("SELECT " + ", ".join(f"{q(c, p)} AS {c}__{k}" for c in _OUT_COLS for k, p in (("median", 0.5), ("p95", 0.95))),
                     "user_sessoes")


@register("outlier_bounds_merged", _merged_bounds_sql())
def q_outlier_bounds_merged(spark, sf_dir):
    """OUT1 over a window: the sessions fall into three dates, each stores its sketches, and the window merges them.

    As long as the sessions are no more than a sketch's size the thresholds are exact, as in the twin; beyond it they
    are within the sketch's rank error.
    """
    us = materialise(FT.user_sessions(FT.recode_sample(joined_facts(spark, sf_dir))), name="sessions")
    table, path = _table(spark, "sketches")
    part = F.pmod(F.xxhash64("session_id"), F.lit(3))
    for i, day in enumerate((DAY_A, DAY_B, DAY_C)):
        SK.store(us.where(part == i), table, day, path=path, now=FIXED_NOW)
    return SK.bounds(SK.window(spark, table, DAY_A, DAY_C))


@register("user_sessions_agg", with_ctes("SELECT * FROM user_agg", "user_agg"))
def q_user_sessions_agg(spark, sf_dir):
    return user_aggregates(spark, sf_dir)


@register("explode_sets", with_ctes("SELECT * FROM set_elements", "set_elements"))
def q_explode_sets(spark, sf_dir):
    return FT.set_elements(user_aggregates(spark, sf_dir))


@register("onehot_vocab", with_ctes(
    " UNION ".join(f"SELECT DISTINCT '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM user_agg "
                   f"WHERE {c} IS NOT NULL" for c in ("faixa_etaria", "sexo", "regioes"))
    + " UNION SELECT DISTINCT \"column\", value FROM set_elements WHERE value IS NOT NULL", "user_agg", "set_elements"))
def q_onehot_vocab(spark, sf_dir):
    return FT.fit_vocab(user_aggregates(spark, sf_dir))


@register("onehot_features", with_ctes(ONEHOT_ROWS, "user_agg", "dummy_long"))
def q_onehot_features(spark, sf_dir):
    uagg = user_aggregates(spark, sf_dir)
    return FT.onehot(uagg, VOCABULARY)


@register("feature_table", with_ctes(BASE_MODELAGEM, "user_agg", "dummy_long"))
def q_feature_table(spark, sf_dir):
    return FT.build_features(joined_facts(spark, sf_dir), P, VOCABULARY)


@register("sparse_dummies", with_ctes(
    "SELECT DISTINCT d.id_ga, d.name FROM dummy_long d JOIN user_agg a ON a.id_ga = d.id_ga AND a.faixa_etaria = d.faixa_etaria "
    f"AND a.sexo = d.sexo AND a.uninstall = d.uninstall WHERE d.name LIKE 'install\\_channel\\_%' ESCAPE '\\' "
    f"AND {' AND '.join(f'a.{c.strip()} IS NOT NULL' for c in NUMERIC.split(','))}", "user_agg", "dummy_long"))
def q_sparse_dummies(spark, sf_dir):
    """ML1 + AGG4 for the open column: sparse vectors over an index table, read back as names."""
    closed = [cv for cv in VOCABULARY if cv[0] != "install_channel"]
    kept = {}

    def index(pairs):
        kept["index"] = materialise(SP.numbered(pairs), name="open-index")
        return kept["index"]

    rows = FT.build_features(joined_facts(spark, sf_dir), P, closed, open_index=index)
    return SP.decode(rows, kept["index"], name=FT.OPEN_DUMMIES).distinct()


# ============================================================ step 6: partitioned sinks
DAY_A, DAY_B, DAY_C = "2024-01-04", "2024-01-05", "2024-01-06"
FIXED_NOW = dt.datetime(2024, 1, 31, 0, 0, 0)
_NOW_SQL = "'2024-01-31 00:00:00.000000'"


def feature_rows(spark, sf_dir):
    """The flagship feature table, written once for the keys that read it several times."""
    return materialise(FT.build_features(joined_facts(spark, sf_dir), P, VOCABULARY), name="features")


def _stamp_sql(day: str, where: str = "") -> str:
    y, m, d = day.split("-")
    return (f"SELECT id_ga, uninstall, sessions, '{day}' AS DtRef, '{y}' AS AaParticao, '{m}' AS MmParticao, "
            f"'{d}' AS DdParticao, {_NOW_SQL} AS TsAtualizacao FROM ({BASE_MODELAGEM}) b {where}")


def _table(spark, stem: str) -> tuple[str, str]:
    suffix = os.urandom(5).hex()
    return f"attrition_{stem}_{suffix}", scratch_path(spark, f"table-{stem}")


def _narrow(df):
    return df.select("id_ga", "uninstall", "sessions")


@register("partition_stamp", with_ctes(_stamp_sql(DAY_A), "user_agg", "dummy_long"))
def q_partition_stamp(spark, sf_dir):
    return S.stamp(_narrow(FT.build_features(joined_facts(spark, sf_dir), P, VOCABULARY)), DAY_A, FIXED_NOW)


@register("partition_replace", with_ctes(
    f"{_stamp_sql(DAY_A, 'WHERE uninstall = 1')} UNION ALL {_stamp_sql(DAY_B)}", "user_agg", "dummy_long"))
def q_partition_replace(spark, sf_dir):
    rows = _narrow(feature_rows(spark, sf_dir))
    table, path = _table(spark, "replace")
    S.replace_partitions(S.stamp(rows, DAY_A, FIXED_NOW), table, path=path)
    S.replace_partitions(S.stamp(rows, DAY_B, FIXED_NOW), table)
    # replace day A with other rows, and day C with none: day B must stay as it is
    S.replace_partitions(S.stamp(rows, DAY_C, FIXED_NOW), table)
    S.replace_day(S.stamp(rows.filter(F.col("uninstall") == 1), DAY_A, FIXED_NOW), table, DAY_A)
    S.replace_day(S.stamp(rows.filter("false"), DAY_C, FIXED_NOW), table, DAY_C)
    return spark.table(table)


@register("partition_memo", with_ctes(_stamp_sql(DAY_A), "user_agg", "dummy_long"))
def q_partition_memo(spark, sf_dir):
    rows = _narrow(feature_rows(spark, sf_dir))
    table, path = _table(spark, "memo")
    S.memo_partition(spark, table, DAY_A, lambda: rows, path=path, now=FIXED_NOW)

    def must_not_run():
        raise AssertionError("memoised partition was recomputed")

    return S.memo_partition(spark, table, DAY_A, must_not_run, now=FIXED_NOW)


@register("partition_read", with_ctes(_stamp_sql(DAY_B), "user_agg", "dummy_long"))
def q_partition_read(spark, sf_dir):
    rows = _narrow(feature_rows(spark, sf_dir))
    table, path = _table(spark, "read")
    S.replace_partitions(S.stamp(rows, DAY_A, FIXED_NOW), table, path=path)
    S.replace_partitions(S.stamp(rows, DAY_B, FIXED_NOW), table)
    return S.read_partition(spark, table, DAY_B)


# ============================================================ step 7: modelling and scoring
CFG = ModelConfig()
_FEATS = f"({BASE_MODELAGEM})"


@register("corr_matrix", with_ctes(f"""
SELECT least(col_i, col_j) AS col_a, greatest(col_i, col_j) AS col_b, round(r, 6) + 0.0 AS r FROM {corr_pairs(_FEATS)}""",
                                   "user_agg", "dummy_long"))
def q_corr_matrix(spark, sf_dir):
    m = M.corr_matrix(feature_rows(spark, sf_dir))
    return m.select(F.least("col_i", "col_j").alias("col_a"), F.greatest("col_i", "col_j").alias("col_b"),
                    (F.round("r", 6) + F.lit(0.0)).alias("r"))  # no minus zero


_DROPPED = (f"(SELECT DISTINCT col_j AS column FROM {corr_pairs(_FEATS)} WHERE round(abs(r), 9) >= {CFG.corr_threshold} "
            "AND round(abs(r), 9) < 1.0 AND col_j <> 'uninstall')")


@register("corr_filter", with_ctes(f'SELECT "column" FROM {_DROPPED} dropped', "user_agg", "dummy_long"))
def q_corr_filter(spark, sf_dir):
    feats = feature_rows(spark, sf_dir)
    drops = M.correlated_drops(M.corr_matrix(feats, M.correlation_columns(feats)), CFG.corr_threshold)
    return drops.filter(F.col("column") != M.LABEL).select("column")


_SPLIT_SQL = "(('0x' || substr(md5(id_ga), 1, 8))::BIGINT % 10 < 7)"


@register("train_test_split", with_ctes(f"SELECT id_ga, {_SPLIT_SQL} AS is_train FROM {_FEATS} b",
                                        "user_agg", "dummy_long"))
def q_train_test_split(spark, sf_dir):
    rows = FT.build_features(joined_facts(spark, sf_dir), P, VOCABULARY)
    return rows.select("id_ga", M.split_flag().alias("is_train"))


# the training side of an exact share: by rank of the hash, all but the ceil(0.3 n) last
_EXACT_SQL = (f"(SELECT b.*, rank() OVER (ORDER BY md5(id_ga), id_ga) <= count(*) OVER () - ceil(count(*) OVER () * 3 / 10) "
              f"AS is_train FROM {_FEATS} b)")


@register("train_test_split_exact", with_ctes(f"SELECT id_ga, is_train FROM {_EXACT_SQL} s", "user_agg", "dummy_long"))
def q_train_test_split_exact(spark, sf_dir):
    rows = feature_rows(spark, sf_dir)
    return rows.select("id_ga", M.exact_split_flag(rows).alias("is_train"))


_WEIGHT = ("CASE WHEN count(*) FILTER (WHERE uninstall = 1) = 0 THEN NULL ELSE "
           "CAST(count(*) FILTER (WHERE uninstall = 0) AS DOUBLE) / count(*) FILTER (WHERE uninstall = 1) END")


@register("class_weight", with_ctes(
    "SELECT count(*) FILTER (WHERE uninstall = 0) AS n_negative, count(*) FILTER (WHERE uninstall = 1) AS n_positive, "
    f"{_WEIGHT} AS scale_pos_weight FROM {_FEATS} b WHERE {_SPLIT_SQL}", "user_agg", "dummy_long"))
def q_class_weight(spark, sf_dir):
    feats = FT.build_features(joined_facts(spark, sf_dir), P, VOCABULARY)
    return M.class_weight(feats.filter(M.split_flag()))


_TRAINED: dict[tuple, tuple] = {}


def _trained(spark, sf_dir):
    """Feature table + model fitted with the default (300-tree) config, once per session and directory."""
    key = (app_key(spark), os.path.abspath(sf_dir))
    if key not in _TRAINED:
        feats = feature_rows(spark, sf_dir)
        model, metrics, names = M.train(feats, CFG)
        _TRAINED[key] = (feats, model, materialise(metrics), names)
    return _TRAINED[key]


def _precision(k: int) -> str:
    return f"COALESCE(count(*) FILTER (WHERE p = {k} AND y = {k}) / nullif(count(*) FILTER (WHERE p = {k}), 0), 0)"


@register("classification_metrics", with_ctes(
    "SELECT round(count(*) FILTER (WHERE y = p) / count(*), 2) AS accuracy, "
    f"round(({_precision(0)} * count(*) FILTER (WHERE y = 0) + {_precision(1)} * count(*) FILTER (WHERE y = 1)) "
    f"/ count(*), 2) AS weighted_precision, round({_precision(0)}, 2) AS precision_0, round({_precision(1)}, 2) AS "
    "precision_1, count(*) AS n_evaluated FROM (SELECT uninstall AS y, CASE WHEN totals_installs_antigos > 0 THEN 1 "
    f"ELSE 0 END AS p FROM {_FEATS} b WHERE NOT {_SPLIT_SQL})", "user_agg", "dummy_long"))
def q_classification_metrics(spark, sf_dir):
    """ML7 over a rule as the classifier, so that SQL can follow; the tests evaluate a fitted model."""
    held = FT.build_features(joined_facts(spark, sf_dir), P, VOCABULARY).filter(~M.split_flag())
    return M.metrics(held.select("uninstall", (F.col("totals_installs_antigos") > 0).cast("double").alias("prediction")))


@register("train_model", with_ctes(
    f"SELECT CAST({len(MODEL_COLS) - 1} - (SELECT count(*) FROM {_DROPPED} dropped) AS INTEGER) AS n_features, "
    f"{CFG.max_iter} AS n_trees, {CFG.max_depth} AS max_depth, {_WEIGHT} AS scale_pos_weight "
    f"FROM {_EXACT_SQL} s WHERE is_train", "user_agg", "dummy_long"))
def q_train_model(spark, sf_dir):
    _, model, metrics, names = _trained(spark, sf_dir)
    trees, depth = M.model_size(model)
    return metrics.select(F.lit(len(names)).alias("n_features"), F.lit(trees).alias("n_trees"),
                          F.lit(depth).alias("max_depth"), "scale_pos_weight")


def _first_split_sql() -> str:
    """The root split of the first tree over all rows, from the definition: every cut of every feature, missing rows on either side."""
    k = {"p": "(1 / (1 + exp(0.0)))", "bins": BO.BINS, "l2": 1.0}
    items = ", ".join(f"struct_pack(f := {i}, name := {_q(c)}, v := CAST(\"{c}\" AS DOUBLE))" for i, c in enumerate(MODEL_COLS[1:]))
    side = "({g}) * ({g}) / (({h}) + 1.0)"
    both = []
    for flag in ("false", "true"):
        gl, hl, cl = (f"(l{x} + m{x})" if flag == "true" else f"l{x}" for x in "ghc")
        gr, hr, cr = f"(t{'g'} - {gl})", f"(th - {hl})", f"(tc - {cl})"
        gain = f"{side.format(g=gl, h=hl)} + {side.format(g=gr, h=hr)} - {side.format(g='tg', h='th')}"
        both.append(f"SELECT f, name, v, {flag} AS missing_left, {gain} AS gain, {cl} AS n_left, {cr} AS n_right, "
                    f"-0.2 * {gl} / ({hl} + 1.0) AS w_left, -0.2 * {gr} / ({hr} + 1.0) AS w_right FROM sums "
                    f"WHERE {cl} > 0 AND {cr} > 0 AND {hl} >= 1 AND {hr} >= 1")
    return with_ctes(f"""
SELECT name AS feature, v AS threshold, missing_left, round(gain, 6) AS gain, CAST(n_left AS BIGINT) AS n_left,
       CAST(n_right AS BIGINT) AS n_right, round(w_left, 9) AS w_left, round(w_right, 9) AS w_right FROM (
  WITH base AS MATERIALIZED (SELECT * FROM {_FEATS} b),
  weight AS (SELECT {_WEIGHT} AS w FROM base),
  rows AS (SELECT ({k['p']} - uninstall) * s AS g, {k['p']} * (1 - {k['p']}) * s AS h, unnest([{items}]) AS x
           FROM (SELECT *, CASE WHEN uninstall = 1 THEN coalesce((SELECT w FROM weight), 1.0) ELSE 1.0 END AS s FROM base)),
  total AS (SELECT x.f AS f, sum(g) AS tg, sum(h) AS th, count(*) AS tc, coalesce(sum(g) FILTER (WHERE x.v IS NULL), 0) AS mg,
                   coalesce(sum(h) FILTER (WHERE x.v IS NULL), 0) AS mh, count(*) FILTER (WHERE x.v IS NULL) AS mc,
                   count(x.v) AS n FROM rows GROUP BY x.f),
  vals AS (SELECT x.f AS f, x.name AS name, x.v AS v, count(*) AS c, sum(g) AS g, sum(h) AS h FROM rows WHERE x.v IS NOT NULL GROUP BY ALL),
  run AS (SELECT f, name, v, c, sum(c) OVER u AS lc, sum(g) OVER u AS lg, sum(h) OVER u AS lh FROM vals
          WINDOW u AS (PARTITION BY f ORDER BY v)),
  sums AS (SELECT * FROM run JOIN total USING (f) WHERE {k['bins']} * lc // n > {k['bins']} * (lc - c) // n)
  {' UNION ALL '.join(both)})
ORDER BY gain DESC, f, v, missing_left LIMIT 1""", "user_agg", "dummy_long")


@register("boost_first_split", _first_split_sql())
def q_boost_first_split(spark, sf_dir):
    """ML4 + ML5: the first split of the first tree, with its gain and the values of its two sides (all rows take part)."""
    feats = feature_rows(spark, sf_dir)
    names = M.correlation_columns(feats, include_label=False)
    weight = M.class_weight(feats).first()["scale_pos_weight"]
    one = BO.fit(M.numeric_features(feats, names), names, M.LABEL, M.ID, weight, BO.BoostOptions(trees=1, depth=1, subsample=1.0))
    nodes = one.table(spark)
    left, right = nodes.where("node = 1"), nodes.where("node = 2")
    return (nodes.where("node = 0 AND feature >= 0")
            .join(left.select("tree", F.col("rows").alias("n_left"), F.round("value", 9).alias("w_left")), "tree")
            .join(right.select("tree", F.col("rows").alias("n_right"), F.round("value", 9).alias("w_right")), "tree")
            .select(F.col("name").alias("feature"), "threshold", "missing_left", F.round("gain", 6).alias("gain"),
                    "n_left", "n_right", "w_left", "w_right"))


# a small fixed model: (tree, node, feature, threshold, missing_left, left, right, value)
_FIXED = [(0, 0, "sessions", 2.0, True, 1, 2, 0.0), (0, 1, "media_timesession", 30.0, False, 3, 4, 0.0), (0, 2, None, None, False, -1, -1, -0.4),
          (0, 3, None, None, False, -1, -1, 0.7), (0, 4, None, None, False, -1, -1, -0.1),
          (1, 0, "sexo_F", 0.0, False, 1, 2, 0.0), (1, 1, None, None, False, -1, -1, 0.25), (1, 2, "recencia_last_install", 10.0, True, 3, 4, 0.0),
          (1, 3, None, None, False, -1, -1, -0.6), (1, 4, None, None, False, -1, -1, 0.05)]


def fixed_model() -> BO.BoostedTrees:
    names = sorted({r[2] for r in _FIXED if r[2]})
    rows = [dict(tree=t, node=n, feature=names.index(f) if f else -1, bin=-1, threshold=float("nan") if v is None else v, missing_left=m,
                 left=lo, right=hi, value=x, gain=0.0, cover=0.0, rows=0) for t, n, f, v, m, lo, hi, x in _FIXED]
    return BO.BoostedTrees.of_rows(rows, names)


def _tree_sql(tree: int, node: int = 0) -> str:
    _, _, name, threshold, missing_left, left, right, value = next(r for r in _FIXED if r[:2] == (tree, node))
    if name is None:
        return str(value)
    v = f'CAST("{name}" AS DOUBLE)'
    test = f"{v} IS NULL OR {v} <= {threshold}" if missing_left else f"{v} <= {threshold}"
    return f"CASE WHEN {test} THEN {_tree_sql(tree, left)} ELSE {_tree_sql(tree, right)} END"


@register("score_fixed_trees", with_ctes(
    f"SELECT id_ga, round(1 / (1 + exp(-CAST({_tree_sql(0)} AS DOUBLE) - CAST({_tree_sql(1)} AS DOUBLE))), 9) AS prob_uninstall "
    f"FROM {_FEATS} b", "user_agg", "dummy_long"))
def q_score_fixed_trees(spark, sf_dir):
    """ML6 + SNK5 with the scores themselves: a stored table of trees, loaded and applied to every user."""
    path = scratch_path(spark, "fixed-model")
    M.save_model(fixed_model(), path)
    return M.score(feature_rows(spark, sf_dir), M.load_model(path)).select("id_ga", F.round("prob_uninstall", 9).alias("prob_uninstall"))


# the scores of the fitted model have no SQL form: who is scored, that each has a probability, and the stamps do
def _is_probability():
    return F.col("prob_uninstall").between(0, 1).alias("is_probability")


@register("score_users", with_ctes(f"SELECT id_ga, true AS is_probability FROM {_FEATS} b", "user_agg", "dummy_long"))
def q_score_users(spark, sf_dir):
    feats, model, _, _ = _trained(spark, sf_dir)
    return M.score(feats, model).select("id_ga", _is_probability())


@register("prediction_roundtrip", with_ctes(
    "SELECT id_ga, true AS is_probability, DtRef, AaParticao, MmParticao, DdParticao, TsAtualizacao "
    f"FROM ({_stamp_sql(DAY_A)}) s", "user_agg", "dummy_long"))
def q_prediction_roundtrip(spark, sf_dir):
    feats, model, _, _ = _trained(spark, sf_dir)
    model_path = scratch_path(spark, "model")
    M.save_model(model, model_path)
    table, path = _table(spark, "predictions")
    stored = JB.score_job(feats, model_path, DAY_A, table=table, path=path, now=FIXED_NOW)
    return stored.select("id_ga", _is_probability(), "DtRef", "AaParticao", "MmParticao", "DdParticao", "TsAtualizacao")
