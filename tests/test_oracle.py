"""Registered queries against their DuckDB twins on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
FAST = ["attribution_events", "customers_age_band", "installs_single", "uninstall_within_window",
        "installs_definitive", "visitor_device_map", "hit_dimensions", "session_duration", "session_facts",
        "joined_facts", "visitor_action_sets", "feature_table", "corr_filter", "partition_replace"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("key", FAST)
def test_matches_duckdb(spark, key):
    line = compare(spark, duck(SF), SF, key, E.queries()[key], E.oracle_sql().get(key))
    assert line.startswith("OK"), line


def test_every_query_has_a_twin():
    from attrition.plans.registry import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_filters_and_joins_have_something_to_do(spark):
    """The adapter's tables are not all of one kind: partitions, origins and days differ, and installs have history."""
    from attrition.plans import registry as RG

    hits = RG.inputs(spark, SF)["hits"]
    assert hits.select("AaParticao", "MmParticao").distinct().count() == 2 and hits.select("OrigemParticao").distinct().count() == 2
    assert RG.ga(spark, SF).count() < hits.count()
    installs = RG.installs_definitive(spark, SF)
    assert installs.count() > 20 and installs.where("total_installs_antigos > 0").count() > 0
    assert installs.select("install_date_sm").distinct().count() > 8
    assert 0 < RG.q_install_sample_range(spark, SF).count() < installs.count()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "id_ga" in df.columns and df.count() >= 0


def test_entry_stands_without_an_optional_library(tmp_path):
    """With the hash library of the corpus operators not installed, the core queries are there, and the cause is named."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['xxhash'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), len([q for q in e.queries() if q.startswith('op')]))")
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    total, corpus = map(int, run.stdout.split())
    assert total >= 48 and corpus == 0
    if os.path.isdir(os.path.join(root, "attrition", "llm")):
        assert "xxhash" in run.stderr
