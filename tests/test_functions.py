"""Column expressions: edge rows (FIXTURES.md section 5), upstream default and fixed modes."""

import datetime as dt

from pyspark.sql import functions as F

from attrition.functions import recodes as R
from attrition.functions import time as TM


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


def test_hit_timestamp_compat_collapses_to_12_hour_clock(spark):
    df = spark.createDataFrame([(dt.date(2023, 9, 1), "15", "42"), (dt.date(2023, 9, 1), "0", "5"),
                                (dt.date(2023, 9, 1), "12", "7"), (dt.date(2023, 9, 1), None, "7"),
                                (dt.date(2023, 9, 1), "x", "7")], "d date, h string, m string")
    got = [r[0] for r in df.select(TM.hit_timestamp("d", "h", "m")).collect()]
    assert got == ["2023-09-01 03:42", "2023-09-01 12:05", "2023-09-01 12:07", None, None]
    exact = [r[0] for r in df.select(TM.hit_timestamp("d", "h", "m", "exact")).collect()]
    assert exact == ["2023-09-01 15:42", "2023-09-01 00:05", "2023-09-01 12:07", None, None]


def test_session_crossing_noon_gets_compat_duration(spark):
    from attrition.operators.hits import session_times

    rows = [("g1", 1, dt.date(2023, 9, 1), "11", "50"), ("g1", 1, dt.date(2023, 9, 1), "13", "10")]
    df = spark.createDataFrame(rows, "id_ga string, visitId long, date date, h string, m string")
    compat = df.withColumn("timestamp_hit", TM.hit_timestamp("date", "h", "m"))
    exact = df.withColumn("timestamp_hit", TM.hit_timestamp("date", "h", "m", "exact"))
    assert session_times(compat).first()["SessionVisitTime_minutes"] == 640.0
    assert session_times(exact).first()["SessionVisitTime_minutes"] == 80.0


def test_parse_yyyymmdd_int_and_bad_text(spark):
    df = spark.createDataFrame([(20230901,), (20231341,)], "d int")
    assert [r[0] for r in df.select(TM.parse_yyyymmdd("d")).collect()] == [dt.date(2023, 9, 1), None]


def test_valid_id(spark):
    df = spark.createDataFrame([(None,), ("0000-0000",), ("00000000-0000-0000-0000-000000000000",), ("abc",)],
                               "a string")
    assert [r[0] for r in df.filter(R.valid_id("a")).collect()] == ["abc"]


def test_first_dimension_null_when_missing(spark):
    schema = "a array<struct<index:int,value:string>>"
    df = spark.createDataFrame([([],), ([(4, "x")],), ([(68, "c1"), (68, "c2")],), (None,)], schema)
    assert [r[0] for r in df.select(R.first_dimension("a", 68)).collect()] == [None, None, "c1", None]


def test_age_band_null_birth_is_last_band(spark):
    df = spark.createDataFrame([(None,), (dt.date(2010, 1, 1),), (dt.date(1995, 1, 1),), (dt.date(1980, 1, 1),),
                                (dt.date(1950, 1, 1),)], "b date")
    got = [r[0] for r in df.select(R.age_band("b", F.lit("2024-01-31").cast("date"))).collect()]
    assert got == ["+_50", "ATE_20", "21_A_30", "31_A_50", "+_50"]


def test_media_source_and_grouping(spark):
    df = spark.createDataFrame([(None, None), ("facebook ads", "Organico"), ("other", "Install Aquisicao"),
                                ("shareit_int", "Remarketing")], "s string, g string")
    got = df.select(R.media_source("s"), R.attribution_channel("g")).collect()
    assert [tuple(r) for r in got] == [("na", "Outros"), ("facebook ads", "Organico"),
                                       ("Outros", "install_aquisicao"), ("shareit_int", "Outros")]


def test_dayparts_null_hour_all_zero(spark):
    df = spark.createDataFrame([(None,), (5,), (6,), (12,), (19,), (23,)], "h int")
    got = [tuple(r) for r in df.select(*R.daypart_flags("h").values()).collect()]
    assert got == [(0, 0, 0, 0), (0, 0, 0, 1), (1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 1, 0)]


def test_product_class_default_and_fixed(spark):
    df = spark.createDataFrame([("games",), ("outro depto",), ("moveis",), (None,)], "d string")
    assert [r[0] for r in df.select(R.product_class("d")).collect()] == [None, "calda", "core", None]
    assert [r[0] for r in df.select(R.product_class("d", fix_tail=True)).collect()] == ["calda", None, "core", None]


def test_region_bucket_default_and_fixed(spark):
    df = spark.createDataFrame([("State of Bahia",), ("State of Sao Paulo",), ("Federal District",), (None,)],
                               "r string")
    assert [r[0] for r in df.select(R.region_bucket("r")).collect()] == [None, "sudeste", "centro_oeste", None]
    assert [r[0] for r in df.select(R.region_bucket("r", True)).collect()] == ["nordeste", "sudeste",
                                                                              "centro_oeste", None]


def test_channel_latency0_rules(spark):
    df = spark.createDataFrame([(True, "Organico", False, "Organic Search"), (False, "Organico", True, "X"),
                                (False, "Organico", False, "SEM - Shopping")],
                               "first boolean, g string, td boolean, ch string")
    got = [r[0] for r in df.select(R.channel_latency0(F.col("first"), "g", "td", "ch")).collect()]
    assert got == ["install : Organico", "Direto", "SEM - Shopping"]
    buckets = spark.createDataFrame([(g,) for g in got + ["Organic Search", None]], "c string")
    assert [r[0] for r in buckets.select(R.channel_bucket("c")).collect()] == [
        "install : Organico", "Direto", "SEM - Shopping", "outros_canais", "outros_canais"]


def test_action_and_sex_recodes(spark):
    long_label = ("erro_exibiu_desculpe! no momento este produto nao pode ser entregue na regiao informada. "
                  "(id-1200)")
    df = spark.createDataFrame([(long_label, "m"), ("acesso_clicou_senha", "F"), ("produto_navegou", None),
                                (None, "x")], "a string, s string")
    got = [tuple(r) for r in df.select(R.action_recode("a"), R.sex_normalise("s")).collect()]
    assert got == [("erro_regiao_nao_entregue", "M"), ("acesso_login_realizado", "F"),
                   ("produto_navegou", "sem_info"), (None, "sem_info")]
