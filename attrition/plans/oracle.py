"""DuckDB twins of the registered queries (the correctness oracle).

Each twin is written from the upstream semantics, not from our Spark plan:
window counts where we aggregate, the literal o x u fan-out join where we
pre-aggregate, explode + max where we use array_contains. The driver tables
(`events`, `customer`, `lineitem`) are mapped to the input contracts by the
same rules as `attrition.sources.testmap`.
"""

from __future__ import annotations

from attrition.functions import values as V
from attrition.sources import testmap

P = testmap.PARAMS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def TS(expr: str, alias: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f') AS {alias}"


def D(expr: str, alias: str) -> str:
    return f"CAST({expr} AS VARCHAR) AS {alias}"


VALID = ("({c} IS NOT NULL AND {c} <> '00000000-0000-0000-0000-000000000000' AND {c} <> '0000-0000')")


def valid(c: str) -> str:
    return VALID.format(c=c)


DIM_T = 'STRUCT("index" INTEGER, "value" VARCHAR)'

_HOUR = "TRY_CAST(hits.hour AS INTEGER)"
_MIN = "TRY_CAST(hits.minute AS INTEGER)"

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (sql, deps)


# ---------------------------------------------------------------- adapter
cte("ev", [], """
SELECT event_id, ts, user_id, event_type, k, CAST(ts AS DATE) AS d, CAST(EXTRACT(day FROM ts) AS INTEGER) AS dom,
       user_id * 16 + k % 16 AS dev
FROM (SELECT event_id, ts - INTERVAL 10 DAY AS ts, user_id, event_type,
             CAST(regexp_replace(props, '[^0-9]', '', 'g') AS INTEGER) AS k FROM events)""")

cte("af_raw", ["ev"], """
SELECT CASE WHEN event_id % 97 = 0 THEN '0000-0000'
            WHEN event_id % 101 = 0 THEN '00000000-0000-0000-0000-000000000000'
            WHEN event_id % 103 = 0 THEN NULL ELSE 'a' || CAST(dev AS VARCHAR) END AS advertising_id,
       'd' || CAST(dev AS VARCHAR) AS appsflyer_id,
       CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'reinstall' WHEN event_type = 'signup' THEN 'install'
            WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'uninstall' WHEN event_type = 'error' THEN 'af_error'
            WHEN event_type = 'view' THEN 'af_login' ELSE event_type END AS event_name,
       ts AS event_time, CASE WHEN event_id % 53 = 0 THEN d - 1 ELSE d END AS event_time_sm,
       CASE k % 4 WHEN 0 THEN 'Organico' WHEN 1 THEN 'Install Aquisicao' WHEN 2 THEN 'Remarketing' END AS atribuicao_canais,
       CASE k % 5 WHEN 0 THEN 'facebook ads' WHEN 1 THEN 'googleadwords_int' WHEN 2 THEN 'restricted'
                  WHEN 3 THEN 'other_net' END AS media_source,
       'ch' || CAST(k % 3 AS VARCHAR) AS channel,
       CASE WHEN user_id % 10 = 9 THEN 'OTHER' ELSE 'BRAND_A' END AS bandeira_partition,
       CASE WHEN user_id % 7 = 6 THEN 'iOS' ELSE 'Android' END AS device
FROM ev""")

cte("hits_raw", ["ev"], f"""
SELECT 'g' || CAST(dev AS VARCHAR) AS FullVisitorId,
       CAST(strftime(d, '%Y%m%d') AS BIGINT) AS visitId,
       CASE WHEN dev % 29 <> 0 THEN CAST(d - DATE '2023-12-01' AS INTEGER) END AS visitNumber,
       CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date,
       CASE (user_id + dom) % 4 WHEN 0 THEN 'SEM - Shopping' WHEN 1 THEN 'CRM - Marketing Direto'
            WHEN 2 THEN 'Organic Search' ELSE 'Remarketing' END AS channelGrouping,
       struct_pack(operatingSystem := CASE WHEN user_id % 7 = 6 THEN 'iOS' ELSE 'Android' END) AS device,
       struct_pack(region := CASE user_id % 7 WHEN 0 THEN 'State of Sao Paulo' WHEN 1 THEN 'State of Parana'
            WHEN 2 THEN 'State of Para' WHEN 3 THEN 'Federal District' WHEN 4 THEN 'State of Bahia'
            WHEN 5 THEN 'Lisbon' END) AS geoNetwork,
       struct_pack(isTrueDirect := (user_id + dom) % 5 = 0) AS trafficSource,
       struct_pack(hits := CAST((dev * 31 + dom) % 40 AS INTEGER),
                   screenviews := CAST((dev * 31 + dom) % 20 AS INTEGER),
                   UniqueScreenviews := CAST((dev * 31 + dom) % 11 AS INTEGER),
                   sessionQualityDim := CASE WHEN user_id % 50 <> 0 THEN CAST((dev * 7 + dom) % 100 AS INTEGER) END
       ) AS totals,
       list_filter([
           struct_pack("index" := 4, "value" := CASE WHEN user_id % 3 = 0 THEN 'deslogado' ELSE 'logado' END),
           CASE WHEN user_id % 3 <> 0 THEN struct_pack("index" := 68, "value" := CAST(user_id AS VARCHAR)) END,
           struct_pack("index" := 69, "value" := CASE WHEN dev % 13 = 0 THEN '0000-0000'
                                                       ELSE 'a' || CAST(dev AS VARCHAR) END)
       ], lambda x: x IS NOT NULL) AS customDimensions,
       struct_pack(
           HitNumber := CAST(row_number() OVER (PARTITION BY dev, d ORDER BY ts, event_id) AS INTEGER),
           time := CAST((hour(ts) * 3600 + minute(ts) * 60 + second(ts)) * 1000 AS BIGINT),
           hour := CASE WHEN event_id % 89 = 0 THEN 'xx' ELSE CAST(hour(ts) AS VARCHAR) END,
           minute := CASE WHEN event_id % 83 <> 0 THEN CAST(minute(ts) AS VARCHAR) END,
           customDimensions := CASE WHEN event_id % 10 = 9 THEN CAST([] AS {DIM_T}[]) ELSE [
               struct_pack("index" := 5, "value" := CASE k % 6 WHEN 0 THEN 'busca' WHEN 1 THEN 'produto'
                   WHEN 2 THEN 'home' WHEN 3 THEN '' WHEN 4 THEN 'outra' END),
               struct_pack("index" := 6, "value" := CASE event_id % 5 WHEN 0 THEN 'moveis' WHEN 1 THEN 'games'
                   WHEN 2 THEN 'outro depto' WHEN 3 THEN '' END)] END,
           eventInfo := struct_pack(
               eventCategory := CASE event_type WHEN 'view' THEN 'produto' WHEN 'click' THEN 'acesso'
                                 WHEN 'purchase' THEN 'carrinho' ELSE 'erro' END,
               eventAction := CASE WHEN event_type = 'view' THEN 'navegou' WHEN event_type = 'click' THEN 'clicou'
                                   WHEN event_type = 'purchase' THEN 'calculou' WHEN k % 7 = 0 THEN 'exibiu' END,
               eventLabel := CASE WHEN event_type = 'click' AND k % 2 = 0 THEN 'senha'
                                  WHEN event_type = 'click' THEN 'ativou biometria'
                                  WHEN event_type IN ('error', 'signup') AND k % 7 = 0 THEN {_q(testmap.DELIVERY_ERROR)} END)
       ) AS hits,
       CASE WHEN user_id % 12 = 11 THEN 'WEB' ELSE 'APP' END AS OrigemParticao,
       strftime(d, '%Y') AS AaParticao, strftime(d, '%m') AS MmParticao,
       CASE WHEN user_id % 10 = 9 THEN 'OTHER' ELSE 'BRAND_A' END AS BandeiraParticao
FROM ev""")

cte("customers_raw", [], """
SELECT CASE WHEN c_custkey % 11 = 0 THEN 'LOJA' ELSE 'SITE' END AS origem,
       CASE WHEN c_custkey % 17 = 0 THEN 'OTHER' ELSE 'BRAND_A' END AS bandeira,
       CAST(c_custkey AS VARCHAR) AS idcliente,
       CASE (c_custkey + copy) % 5 WHEN 0 THEN 'M' WHEN 1 THEN 'm' WHEN 2 THEN 'F' WHEN 3 THEN 'f' END AS sexo,
       CASE WHEN c_custkey % 23 <> 0
            THEN DATE '2024-01-31' - CAST(6000 + (c_custkey * 17) % 22000 AS INTEGER) END AS datanascimento
FROM (SELECT c_custkey, unnest(CASE WHEN c_custkey % 19 = 0 THEN [0, 0] WHEN c_custkey % 31 = 0 THEN [0, 1] ELSE [0] END)
             AS copy FROM customer)""")

# ---------------------------------------------------------------- sources (SRC1-3)
_AGE = "floor(date_diff('day', datanascimento, DATE {asof}) / 365.25)".format(asof=_q(P.as_of))
cte("cli", ["customers_raw"], f"""
SELECT DISTINCT idcliente, sexo,
       CASE WHEN {_AGE} <= 20 THEN 'ATE_20' WHEN {_AGE} <= 30 THEN '21_A_30'
            WHEN {_AGE} <= 50 THEN '31_A_50' ELSE '+_50' END AS faixa_etaria
FROM customers_raw WHERE origem = {_q(P.customer_origin)} AND bandeira = {_q(P.brand)}""")

cte("af", ["af_raw"], f"""
SELECT DISTINCT * FROM af_raw
WHERE bandeira_partition = {_q(P.brand)} AND device = {_q(P.device)} AND event_name <> 'af_login'""")

_GROUPING_STEP1 = "CASE WHEN atribuicao_canais IN ('Organico', 'Install Aquisicao') THEN atribuicao_canais ELSE 'Outros' END"
GROUPING = f"CASE WHEN ({_GROUPING_STEP1}) = 'Install Aquisicao' THEN 'install_aquisicao' ELSE ({_GROUPING_STEP1}) END"
SOURCE = f"CASE WHEN media_source IS NULL THEN 'na' WHEN media_source IN {_in(V.MEDIA_SOURCES)} THEN media_source ELSE 'Outros' END"


def _dayparts(h: str) -> str:
    return (f"CASE WHEN {h} >= 6 AND {h} < 12 THEN 1 ELSE 0 END AS install_manha, "
            f"CASE WHEN {h} >= 12 AND {h} < 19 THEN 1 ELSE 0 END AS install_tarde, "
            f"CASE WHEN {h} >= 19 AND {h} <= 23 THEN 1 ELSE 0 END AS install_noite, "
            f"CASE WHEN {h} >= 0 AND {h} < 6 THEN 1 ELSE 0 END AS install_madrugada")


# ---------------------------------------------------------------- installs (PIP1)
cte("inst_rows", ["af"], f"""
SELECT DISTINCT advertising_id AS advertising_appsflyer, appsflyer_id, event_time AS install_date,
       event_time_sm AS install_date_sm, {GROUPING} AS install_grouping, channel AS install_channel,
       {SOURCE} AS install_source, {_dayparts('hour(event_time)')}
FROM af
WHERE event_time_sm BETWEEN DATE {_q(P.period_start)} AND DATE {_q(P.period_end)}
  AND event_name IN ('install', 'reinstall') AND {valid('advertising_id')}""")

cte("inst", ["inst_rows"], """
SELECT * EXCLUDE (qtd) FROM (
  SELECT *, count(*) OVER (PARTITION BY advertising_appsflyer) AS qtd FROM inst_rows) WHERE qtd = 1""")

cte("antigo", ["af"], f"""
SELECT DISTINCT advertising_id AS advertising_antigo, event_time AS install_date_antigo, 1 AS install_antigo
FROM af WHERE event_name IN ('install', 'reinstall') AND {valid('advertising_id')}""")

cte("un", ["af"], f"""
SELECT DISTINCT appsflyer_id AS appsflyer_id_un, event_time AS uninstall_date, 1 AS uninstall
FROM af WHERE event_name = 'uninstall' AND {valid('advertising_id')}""")

UN_COND = ("i.appsflyer_id = u.appsflyer_id_un AND i.install_date < u.uninstall_date "
           f"AND CAST(CAST(i.install_date AS DATE) + {P.uninstall_window_days} AS TIMESTAMP) >= u.uninstall_date")

INST_KEYS = ("advertising_appsflyer, appsflyer_id, install_date, install_date_sm, install_manha, install_tarde, "
             "install_noite, install_madrugada, install_grouping, install_channel, install_source")

cte("definitivo", ["inst", "antigo", "un"], f"""
SELECT advertising_appsflyer, appsflyer_id, install_date_sm, install_manha, install_tarde, install_noite,
       install_madrugada, install_grouping, install_channel, install_source, uninstall,
       total_installs_antigos,
       COALESCE(CAST(date_diff('day', CAST(last_install_antigo AS DATE), install_date_sm) AS INTEGER), -1)
           AS recencia_last_install
FROM (
  SELECT {INST_KEYS}, COALESCE(u.uninstall, 0) AS uninstall,
         CAST(sum(COALESCE(a.install_antigo, 0)) AS BIGINT) AS total_installs_antigos,
         max(a.install_date_antigo) AS last_install_antigo
  FROM inst i
  LEFT JOIN antigo a ON i.advertising_appsflyer = a.advertising_antigo AND i.install_date > a.install_date_antigo
  LEFT JOIN un u ON {UN_COND}
  GROUP BY {INST_KEYS}, COALESCE(u.uninstall, 0))""")

cte("amostra_af", ["definitivo"], f"""
SELECT * FROM definitivo
WHERE install_date_sm >= DATE {_q(P.sample_start)} AND install_date_sm <= DATE {_q(P.sample_end)}""")

# ---------------------------------------------------------------- hits (PIP2/3)
_HIT_DATE = "strptime(CAST(date AS VARCHAR), '%Y%m%d')"
_COMPAT_TS = (f"CASE WHEN {_HOUR} BETWEEN 0 AND 23 AND {_MIN} BETWEEN 0 AND 59 THEN "
              f"strftime({_HIT_DATE} + to_hours({_HOUR}) + to_minutes({_MIN}), '%Y-%m-%d %I:%M') END")
cte("ga", ["hits_raw"], f"""
SELECT * REPLACE (CAST({_HIT_DATE} AS DATE) AS date),
       {_COMPAT_TS} AS timestamp_hit, FullVisitorId AS id_ga
FROM hits_raw
WHERE OrigemParticao = {_q(P.hit_origin)} AND (AaParticao, MmParticao) IN ({', '.join(map(_in, P.hit_months))})
  AND BandeiraParticao = {_q(P.brand)} AND device.operatingSystem = {_q(P.os)}""")

cte("ga_amostra", ["ga"], """
SELECT id_ga, custom.value AS advertising_id FROM (
  SELECT FullVisitorId AS id_ga, unnest(customDimensions) AS custom FROM ga)
WHERE custom.index = 69 AND custom.value <> '00000000-0000-0000-0000-000000000000' AND custom.value <> '0000-0000'""")

cte("ga_amostra_af", ["ga_amostra", "amostra_af"], """
SELECT DISTINCT m.advertising_id, m.id_ga, s.* EXCLUDE (advertising_appsflyer)
FROM ga_amostra m JOIN amostra_af s ON m.advertising_id = s.advertising_appsflyer""")

cte("ga_definitivo", ["ga", "ga_amostra_af"], f"""
SELECT g.*, v.* EXCLUDE (id_ga)
FROM ga g JOIN ga_amostra_af v ON g.id_ga = v.id_ga
WHERE g.date >= v.install_date_sm AND g.date <= v.install_date_sm + {P.hit_days_after_install}""")


def first_dim(index: int) -> str:
    return f"list_filter(customDimensions, lambda x: x.index = {index})[1].value"


cte("ga_bruto", ["ga_definitivo"], f"""
SELECT *, CASE WHEN {first_dim(4)} = 'logado' THEN 1 END AS logado, {first_dim(68)} AS idcliente
FROM ga_definitivo""")

EV1 = "concat_ws('_', hits.eventInfo.eventCategory, hits.eventInfo.eventAction)"
EV2 = "concat_ws('_', hits.eventInfo.eventCategory, hits.eventInfo.eventAction, hits.eventInfo.eventLabel)"


def region_sql(col: str, fix: bool = False) -> str:
    parts = [f"WHEN {col} IN {_in(states)} THEN {_q(label)}" for label, states in V.REGION_BUCKETS]
    pattern = V.NORDESTE_PATTERN_FIXED if fix else V.NORDESTE_PATTERN
    return "CASE " + " ".join(parts) + f" WHEN {col} LIKE {_q(pattern)} THEN 'nordeste' END"


def product_sql(col: str) -> str:
    return (f"CASE WHEN {col} IN {_in(V.CORE_PRODUCTS)} THEN 'core' "
            f"WHEN NOT ({col} IN {_in(V.TAIL_PRODUCTS)}) THEN 'calda' END")


cte("hit_info", ["ga_bruto"], """
SELECT *, min(timestamp_hit) OVER (PARTITION BY session_id) AS t_min, max(timestamp_hit) OVER (PARTITION BY session_id) AS t_max
FROM (SELECT *, id_ga || CAST(visitId AS VARCHAR) AS session_id FROM ga_bruto)""")

cte("hit_x", ["hit_info"], "SELECT *, unnest(hits.customDimensions) AS custom_hit FROM hit_info")

cte("hit_y", ["hit_x"], f"""
SELECT *,
  CASE WHEN template_screen IN {_in(V.SCREEN_TEMPLATES)} THEN template_screen END AS screen_view,
  {product_sql('depart_pageview')} AS produto_view,
  CASE WHEN event_v1 IN {_in(V.ACTION_EVENTS_V1)} THEN event_v1 END AS action_event_v1,
  CASE WHEN event_v2 IN {_in(V.ACTION_EVENTS_V2)} THEN event_v2 END AS action_event_v2,
  {region_sql('geoNetwork.region')} AS regioes
FROM (SELECT *,
        CASE WHEN custom_hit.index = 5 AND custom_hit.value <> '' THEN custom_hit.value END AS template_screen,
        CASE WHEN custom_hit.index = 6 AND custom_hit.value <> '' THEN custom_hit.value END AS depart_pageview,
        {EV1} AS event_v1, {EV2} AS event_v2
      FROM hit_x)""")

_MINUTES = ("round((epoch(strptime(t_max, '%Y-%m-%d %H:%M')) - epoch(strptime(t_min, '%Y-%m-%d %H:%M'))) / 60, 2)")

FACT_COLS = ("id_ga, sexo, faixa_etaria, session_id, hits, screenviews, UniqueScreenviews, sessionQualityDim, "
             "visitNumber, channelGrouping, SessionVisitTime_minutes, regioes, install_manha, install_tarde, "
             "install_noite, install_madrugada, install_grouping, install_channel, total_installs_antigos, "
             "recencia_last_install, isTrueDirect, screen_view, produto_view, action_event_v1, action_event_v2, "
             "uninstall")

cte("facts", ["hit_y", "cli"], f"""
SELECT DISTINCT h.id_ga, c.sexo, c.faixa_etaria, h.session_id, h.totals.hits AS hits,
       h.totals.screenviews AS screenviews, h.totals.UniqueScreenviews AS UniqueScreenviews,
       h.totals.sessionQualityDim AS sessionQualityDim, h.visitNumber, h.channelGrouping,
       {_MINUTES} AS SessionVisitTime_minutes, h.regioes, h.install_manha, h.install_tarde, h.install_noite,
       h.install_madrugada, h.install_grouping, h.install_channel, h.total_installs_antigos,
       h.recencia_last_install, h.trafficSource.isTrueDirect AS isTrueDirect, h.screen_view, h.produto_view,
       h.action_event_v1, h.action_event_v2, h.uninstall
FROM hit_y h LEFT JOIN cli c ON h.idcliente = c.idcliente""")

cte("final_tratado", ["facts"], """
SELECT * EXCLUDE (isTrueDirect, channelGrouping, install_grouping, visitNumber, rank_install) FROM (
  SELECT *, dense_rank() OVER (PARTITION BY id_ga ORDER BY visitNumber ASC NULLS FIRST) AS rank_install,
         CASE WHEN dense_rank() OVER (PARTITION BY id_ga ORDER BY visitNumber ASC NULLS FIRST) = 1
                   THEN 'install : ' || install_grouping
              WHEN CAST(isTrueDirect AS VARCHAR) = 'true' THEN 'Direto'
              ELSE channelGrouping END AS channelGrouping_latencia0
  FROM facts)""")

# ---------------------------------------------------------------- features (PIP4)
cte("amostra", ["final_tratado"], f"""
SELECT * REPLACE (
  CASE WHEN action_event_v2 = {_q(V.DELIVERY_ERROR_EVENT)} THEN 'erro_regiao_nao_entregue'
       WHEN action_event_v2 IN {_in(V.LOGIN_ACTIONS)} THEN 'acesso_login_realizado'
       ELSE action_event_v2 END AS action_event_v2,
  CASE WHEN COALESCE(sexo, 'sem_info') IN ('M', 'm') THEN 'M'
       WHEN COALESCE(sexo, 'sem_info') IN ('F', 'f') THEN 'F' ELSE 'sem_info' END AS sexo,
  COALESCE(faixa_etaria, 'sem_info') AS faixa_etaria)
FROM final_tratado""")


def set_agg(col: str, alias: str | None = None) -> str:
    return f"list_sort(list_distinct(list({col}))) AS {alias or col}"


cte("user_hitinfo", ["amostra"], f"""
SELECT id_ga, {set_agg('screen_view')}, {set_agg('produto_view')}, {set_agg('action_event_v1')},
       {set_agg('action_event_v2')}
FROM amostra GROUP BY id_ga""")

cte("user_sessoes", ["amostra"], f"""
SELECT * REPLACE (
  CASE WHEN channelGrouping_latencia0 LIKE 'install :%' THEN channelGrouping_latencia0
       WHEN channelGrouping_latencia0 IN {_in(V.KEPT_CHANNELS)} THEN channelGrouping_latencia0
       ELSE 'outros_canais' END AS channelGrouping_latencia0)
FROM (SELECT DISTINCT * EXCLUDE (screen_view, produto_view, action_event_v1, action_event_v2) FROM amostra)""")

OUTLIER_COLS = ["hits", "screenviews", "UniqueScreenviews", "sessionQualityDim", "SessionVisitTime_minutes"]


def _quantile(c: str, q: float) -> str:
    return f"(SELECT quantile_disc(CAST({c} AS DOUBLE), {q}) FROM user_sessoes)"


cte("user_sessoes_outliers", ["user_sessoes"], "SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN {c} > {_quantile(c, 0.95)} THEN {_quantile(c, 0.5)} ELSE CAST({c} AS DOUBLE) END AS {c}"
    for c in OUTLIER_COLS) + ") FROM user_sessoes")

cte("user_agg", ["user_sessoes_outliers", "user_hitinfo"], f"""
SELECT a.*, h.screen_view, h.produto_view, h.action_event_v1, h.action_event_v2 FROM (
  SELECT id_ga, faixa_etaria, sexo, uninstall,
         count(DISTINCT session_id) AS sessions,
         round(avg(hits), 2) AS media_hits,
         round(avg(screenviews), 2) AS media_screenviews,
         round(avg(UniqueScreenviews), 2) AS media_uniquescreens,
         round(avg(sessionQualityDim), 2) AS media_qualitysession,
         round(avg(SessionVisitTime_minutes), 2) AS media_timesession,
         sum(SessionVisitTime_minutes) AS soma_timesession,
         max(install_manha) AS install_manha, max(install_tarde) AS install_tarde,
         max(install_noite) AS install_noite, max(install_madrugada) AS install_madrugada,
         CAST(max(total_installs_antigos) AS BIGINT) AS totals_installs_antigos,
         max(recencia_last_install) AS recencia_last_install,
         max(regioes) AS regioes,
         {set_agg('install_channel')}, {set_agg('channelGrouping_latencia0', 'canais')}
  FROM user_sessoes_outliers GROUP BY id_ga, faixa_etaria, sexo, uninstall) a
JOIN user_hitinfo h ON a.id_ga = h.id_ga""")


SET_COLS = ["install_channel", "canais", "screen_view", "produto_view", "action_event_v1", "action_event_v2"]
AGG_KEYS = "id_ga, faixa_etaria, sexo, uninstall"
NUMERIC = ("sessions, media_hits, media_screenviews, media_uniquescreens, media_qualitysession, media_timesession, "
           "soma_timesession, install_manha, install_tarde, install_noite, install_madrugada, "
           "totals_installs_antigos, recencia_last_install")

# the set elements in long form: one row per (user row, set column, element)
cte("set_elements", ["user_agg"], " UNION ALL ".join(
    f"SELECT {AGG_KEYS}, '{c}' AS column, unnest({c}) AS value FROM user_agg" for c in SET_COLS))

_SCALAR_DUMMIES = ["faixa_etaria", "sexo", "regioes"]

# one (row key, dummy name) per present category value (explode of each set, then max = present)
cte("dummy_long", ["user_agg", "set_elements"], " UNION ALL ".join(
    [f"SELECT {AGG_KEYS}, '{c}_' || CAST({c} AS VARCHAR) AS name FROM user_agg WHERE {c} IS NOT NULL"
     for c in _SCALAR_DUMMIES]
    + [f'SELECT {AGG_KEYS}, "column" || \'_\' || value AS name FROM set_elements WHERE value IS NOT NULL']))

# The vocabulary is a fixed list, so the twin is one plain statement: whether each name occurs among a row's values.
DUMMIES = [f"{c}_{v}" for c, v in testmap.VOCABULARY]


def _ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


ONEHOT_ROWS = f"""
SELECT a.id_ga, a.uninstall, {', '.join('a.' + c.strip() for c in NUMERIC.split(','))},
       {', '.join(f"coalesce(w.{_ident(n)}, false) AS {_ident(n)}" for n in DUMMIES)}
FROM user_agg a
LEFT JOIN (SELECT {AGG_KEYS}, {', '.join(f"bool_or(name = {_q(n)}) AS {_ident(n)}" for n in DUMMIES)}
           FROM dummy_long GROUP BY {AGG_KEYS}) w
  ON a.id_ga = w.id_ga AND a.faixa_etaria = w.faixa_etaria AND a.sexo = w.sexo AND a.uninstall = w.uninstall"""

# groupby over the non-dummy columns as the dataframe library does it: rows with
# a null key drop out, dummies are OR-ed
_KEYS = [c.strip() for c in ("id_ga, uninstall, " + NUMERIC).split(",")]
BASE_MODELAGEM = f"""
SELECT {', '.join(_KEYS)}, {', '.join(f"max({_ident(n)}) AS {_ident(n)}" for n in DUMMIES)} FROM ({ONEHOT_ROWS})
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _KEYS)}
GROUP BY {', '.join(_KEYS)}"""


# the model's candidate columns in frame order: label, numeric features, then the dummies in vocabulary order
MODEL_COLS = ["uninstall", *_KEYS[2:], *[n for n in DUMMIES if "install_channel" not in n]]


def _long(features: str) -> str:
    """(rk, ok, col, val): the model's columns in long form; ok is the column's place."""
    items = ", ".join(f"struct_pack(ok := {i}, col := {_q(c)}, val := CAST({_ident(c)} AS DOUBLE))"
                      for i, c in enumerate(MODEL_COLS))
    return (f"(SELECT rk, x.ok AS ok, x.col AS col, x.val AS val FROM (SELECT row_number() OVER (ORDER BY {', '.join(_KEYS)}) "
            f"AS rk, unnest([{items}]) AS x FROM {features} f) WHERE x.val IS NOT NULL)")


def corr_pairs(features: str) -> str:
    """Pearson r per column pair (earlier, later) over rows where both are present, as a FROM item."""
    return (f"(SELECT x.col AS col_i, y.col AS col_j, "
            f"CASE WHEN isnan(corr(x.val, y.val)) THEN NULL ELSE least(greatest(corr(x.val, y.val), -1.0), 1.0) END AS r "
            f"FROM {_long(features)} x JOIN {_long(features)} y ON x.rk = y.rk AND x.ok < y.ok "
            f"GROUP BY x.col, y.col) pairs")


def with_ctes(final_sql: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    body = ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}" if order else final_sql
