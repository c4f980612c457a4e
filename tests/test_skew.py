"""A hot key holding a third of the rows: same results, and the skewed join partition is split."""

import datetime as dt

import pytest

from attrition.config import Params
from attrition.operators import installs as I
from attrition.sources import schemas

# default materialise=True: the written single installs make both sides of the
# range joins shuffle stages, which is what the adaptive skew-join split needs
P = Params.for_month("2023-09", sample_start="2023-09-01", sample_end="2023-09-30", brand="B")
T0 = dt.datetime(2023, 9, 10, 12)


def _events(spark, n_users=300):
    rows = []
    for u in range(n_users):  # ordinary ids: one install in the period, a few earlier ones
        t = T0 + dt.timedelta(minutes=u)
        rows.append((f"a{u}", f"d{u}", "install", t, t.date(), "Organico", None, "c", "B", "Android"))
        for k in range(1, 3):
            old = t - dt.timedelta(days=40 * k)
            rows.append((f"a{u}", f"d{u}", "reinstall", old, old.date(), None, None, "c", "B", "Android"))
    hot = len(rows) // 2  # the hot id ends up with a third of all rows
    rows.append(("hot", "dhot", "install", T0, T0.date(), "Organico", None, "c", "B", "Android"))
    for k in range(hot):
        old = T0 - dt.timedelta(days=40, seconds=k)
        rows.append(("hot", "dhot", "install", old, old.date(), None, None, "c", "B", "Android"))
    return spark.createDataFrame(rows, schemas.ATTRIBUTION_EVENTS)


@pytest.fixture()
def skew_conf(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_advertising_id(spark, skew_conf):
    ev = _events(spark)
    n_hot = ev.filter("advertising_id = 'hot'").count()
    assert n_hot * 3 >= ev.count() - 3
    out = I.build_installs(ev, P)
    rows = {r["advertising_appsflyer"]: r for r in out.collect()}
    assert rows["hot"]["total_installs_antigos"] == n_hot - 1
    assert all(rows[f"a{u}"]["total_installs_antigos"] == 2 for u in range(300))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan.replace(" ", "").lower() or "isskewjoin=true" in plan.replace(" ", "").lower(), plan
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        plain = {r["advertising_appsflyer"]: tuple(r) for r in I.build_installs(ev, P).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert plain == {k: tuple(v) for k, v in rows.items()}


def test_hot_visitor_feature_table_matches_oracle(spark, skew_conf, tmp_path):
    """One visitor with a third of all events inside the sampled hit window; whole feature table vs DuckDB."""
    import os

    from pyspark.sql import functions as F

    import __spark_entry__ as E
    from tests.oracle_check import compare, duck

    src = "/root/testdata/sf0.001"
    if not os.path.isdir(src):
        pytest.skip("driver tables not present")
    events = spark.read.parquet(f"{src}/events.parquet")
    base = E.queries()["feature_table"](spark, src)
    hot = int(sorted(r["id_ga"] for r in base.collect())[0][1:])  # a device: user * 16 + k % 16
    hot_uid, hot_k = hot // 16, hot % 16
    n = events.count() // 2
    top = events.agg(F.max("event_id")).first()[0]
    extra = (spark.range(n)
             .select((F.col("id") + top + 1).alias("event_id"),
                     (F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")
                      + F.make_interval(secs=(F.col("id") * 997 % 1500000).cast("int"))).alias("ts"),
                     F.lit(hot_uid).cast("long").alias("user_id"), F.lit("view").alias("event_type"),
                     F.lit(1.0).alias("value"),
                     F.concat(F.lit('{"k": '), (F.lit(hot_k) + 16 * (F.col("id") % 5)).cast("string"), F.lit("}"))
                     .alias("props")))
    data = tmp_path / "hot"
    events.unionByName(extra.select(*events.columns)).write.parquet(str(data / "events.parquet"))
    spark.read.parquet(f"{src}/customer.parquet").write.parquet(str(data / "customer.parquet"))
    line = compare(spark, duck(str(data)), str(data), "feature_table", E.queries()["feature_table"],
                   E.oracle_sql()["feature_table"])
    assert line.startswith("OK"), line
