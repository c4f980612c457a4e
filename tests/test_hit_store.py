"""Hits stored by day and visitor: the same rows, and no shuffle of the hits in the wide join."""

import os
import uuid

import pytest

from attrition.operators import hit_store as HS
from attrition.operators import installs as I
from attrition.operators import joins as J
from attrition.sources import testmap

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    src, p = testmap.load(spark, SF), testmap.PARAMS
    table = f"hits_{uuid.uuid4().hex}"
    HS.store_hits(src["hits"], p, table, buckets=16, path=str(tmp_path_factory.mktemp("store") / "hits"))
    installs = I.build_installs(src["attribution_events"], p)
    return src, p, table, installs


def rows(df):
    return sorted(map(str, df.collect()))


def test_same_hits_as_from_the_raw_table(spark, stored):
    src, p, table, installs = stored
    got = rows(HS.sampled_lean_hits(spark, installs, table, p))
    assert got == rows(J.sampled_lean_hits(installs, src["hits"], p)) and got


def test_hits_are_not_shuffled(spark, stored):
    _, p, table, installs = stored
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        df = HS.sampled_lean_hits(spark, installs, table, p)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and "session_id" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*0123456789()"))
    above, level = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    join = next(i for i, line in enumerate(above) if "Join" in line)
    assert not [line for line in above[:join] if "Exchange" in line], above
    assert "Bucketed: true" in lines[scan] and "SelectedBucketsCount: 16 out of 16" in lines[scan]
    assert "PartitionFilters: [isnotnull(hit_day" in lines[scan] and "hit_day" in lines[scan]


def test_a_day_can_be_stored_again(spark, stored):
    src, p, table, installs = stored
    before = rows(spark.table(table)), rows(spark.table(f"{table}_devices"))
    day = spark.table(table).agg({"hit_day": "min"}).first()[0]
    HS.store_hits(src["hits"], p, table, days=(day, day))
    assert (rows(spark.table(table)), rows(spark.table(f"{table}_devices"))) == before
    files = {f.rsplit("/", 1)[-1] for f in spark.table(table).where(f"hit_day = '{day}'").inputFiles()}
    assert 0 < len(files) <= 16  # one file a bucket at most
