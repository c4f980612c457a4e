"""Counts in intervals against all pairs, and a hot id on both sides."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from attrition.config import Params
from attrition.operators import installs as I
from attrition.operators import intervals as N
from attrition.sources import schemas

T0 = dt.datetime(2023, 9, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


@pytest.fixture()
def small_ranges(spark):
    """Many ranges, so that ids go on over several of them."""
    keys = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed", range(3))
def test_counts_equal_all_pairs(spark, small_ranges, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", "c", None])
    events = [(key(), rng.choice([None, *range(60)])) for _ in range(400)]
    spans = [(i, key(), rng.choice([None, *range(60)]), rng.randrange(70)) for i in range(300)]
    ev = spark.createDataFrame([(k, at(m)) for k, m in events], "key string, at timestamp")
    iv = spark.createDataFrame([(i, k, at(m), at(m2)) for i, k, m, m2 in spans], "row int, key string, after timestamp, upto timestamp")
    got = {r.row: r.n for r in N.counts_within(ev, iv, "row").collect()}
    expected = {i: n for i, k, lo, hi in spans if k is not None and lo is not None
                and (n := sum(k == e and m is not None and lo < m <= hi for e, m in events))}
    assert got == expected and len(got) > 50
    upto = N.counts_upto(ev, iv.select("key", F.col("upto").alias("at"), "row"))
    assert {r.row: r.n for r in upto.collect()} == {i: sum(k == e and m is not None and m <= hi for e, m in events)
                                                    for i, k, _, hi in spans if k is not None}


def test_nothing_to_count(spark):
    ev = spark.createDataFrame([], "key string, at timestamp")
    iv = spark.createDataFrame([(1, "a", T0, T0)], "row int, key string, after timestamp, upto timestamp")
    assert N.counts_within(ev, iv, "row").count() == 0 and N.counts_within(ev, iv.where("false"), "row").count() == 0


def test_hot_app_id_on_both_sides(spark, small_ranges):
    """One app id with a third of the installs and of the uninstalls: the right counts, no pairs, and even ranges."""
    rows, hot = [], 1500

    def event(adv, app, name, t):
        rows.append((adv, app, name, t, t.date(), "Organico", None, "c", "B", "Android"))

    rng = random.Random(1)
    installs, uninstalls = {}, []
    for i in range(3 * hot):
        app = "hot" if i < hot else f"d{i}"
        t = T0 + dt.timedelta(seconds=rng.randrange(15 * 86400))
        installs[f"a{i}"] = (app, t)
        event(f"a{i}", app, "install", t)
        gone = T0 + dt.timedelta(seconds=rng.randrange(25 * 86400))
        uninstalls.append((app, gone))
        event("x", app, "uninstall", gone)
    ev = spark.createDataFrame(rows, schemas.ATTRIBUTION_EVENTS).repartition(4)
    p = Params.for_month("2023-09", sample_start="2023-09-01", sample_end="2023-09-30", brand="B")
    single = I.single_installs(ev, p)
    stats = I.uninstall_stats(single, I.uninstalls(ev), 8)
    got = {r.advertising_appsflyer: r.n_uninstall for r in stats.collect()}
    times = {}
    for app, t in sorted(set(uninstalls)):
        times.setdefault(app, []).append(t)
    expected = {}
    for adv, (app, t) in installs.items():
        end = dt.datetime.combine(t.date() + dt.timedelta(days=8), dt.time())
        n = bisect.bisect_right(times[app], end) - bisect.bisect_right(times[app], t)
        if n > 0:
            expected[adv] = n
    assert got == expected
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    assert "uninstall_date" not in [w for line in plan.splitlines() if "Join" in line for w in line.split()]
    out = I.build_installs(ev, p)
    assert sum(r.uninstall for r in out.select("uninstall").collect()) == len(expected)


def test_hot_id_is_spread_over_ranges(spark, small_ranges, monkeypatch):
    kept = {}
    real = N.materialise

    def keep(df, *a, **k):
        kept["laid"] = real(df, *a, **k)
        return kept["laid"]

    monkeypatch.setattr(N, "materialise", keep)
    ev = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"),
                                    F.timestamp_seconds("id").alias("at"))
    iv = ev.select("key", F.col("at").alias("after"), (F.col("at") + F.expr("interval 1 hour")).alias("upto"), F.expr("uuid()").alias("row"))
    assert N.counts_within(ev, iv, "row").agg(F.sum("n")).first()[0] > 0
    sizes = sorted(r["count"] for r in kept["laid"].groupBy("part").count().collect())
    assert len(sizes) == 13 and sizes[-1] < 3 * sizes[len(sizes) // 2]
