"""Sparse dummies of an open column."""

import random
import uuid

import pytest
from pyspark.sql import DataFrame

from attrition.operators import sparse as SP


def frame(spark, rows):
    return spark.createDataFrame(rows, "id_ga string, install_channel array<string>, other string")


def names(df, index):
    return sorted(map(tuple, SP.decode(df, index).collect()))


def test_vectors_give_back_the_values(spark):
    rows = [("u1", ["b", "a", "b"], "x"), ("u2", [], None), ("u3", None, "y"), ("u4", ["a", None], "x"), ("u4", ["c"], "x")]
    df = frame(spark, rows)
    index = SP.numbered(SP.value_pairs(df, ["install_channel", "other"]))
    assert [tuple(r) for r in index.orderBy("idx").collect()] == [
        ("install_channel", "a", 0), ("install_channel", "b", 1), ("install_channel", "c", 2), ("other", "x", 3), ("other", "y", 4)]
    out = SP.encode(df, index, ["install_channel", "other"])
    assert sorted((r.id_ga, r.dummies) for r in out.collect()) == [
        ("u1", [0, 1, 3]), ("u2", []), ("u3", [4]), ("u4", [0, 3]), ("u4", [2, 3])]
    assert ("u3", "other_y") in names(out, index)


def test_a_hundred_thousand_channels_stay_off_the_driver(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(f"u{i}", [f"ch{rng.randrange(100_000)}" for _ in range(2)] + ["hot"], None) for i in range(60_000)]
    df = frame(spark, rows)

    def never(*a, **k):
        raise AssertionError("collected to the driver")

    for method in ("collect", "toPandas", "toLocalIterator", "toArrow"):
        monkeypatch.setattr(DataFrame, method, never)
        monkeypatch.setattr(type(df), method, never)
    index = SP.numbered(SP.value_pairs(df, ["install_channel"]))
    out = SP.encode(df, index, ["install_channel"])
    out.createOrReplaceTempView("open_rows")
    index.createOrReplaceTempView("open_index")
    monkeypatch.undo()
    distinct = {v for _, vs, _ in rows for v in vs}
    got = index.agg({"idx": "max", "value": "count"}).first()
    assert (got["max(idx)"] + 1, got["count(value)"]) == (len(distinct), len(distinct)) and index.select("idx").distinct().count() == len(distinct)
    assert names(out, index) == sorted({(u, f"install_channel_{v}") for u, vs, _ in rows for v in vs})


def test_values_keep_their_index_on_later_dates(spark, tmp_path):
    table = f"open_{uuid.uuid4().hex}"
    days = [[("u1", ["b", "d"], None)], [("u2", ["a", "b"], None)], [("u3", ["d"], None)], [("u4", ["c", "e", "a"], None)]]
    seen = {}
    for day in days:
        df = frame(spark, day)
        index = SP.stored_index(spark, table, SP.value_pairs(df, ["install_channel"]), str(tmp_path / "open"))
        now = {r["value"]: r["idx"] for r in index.collect()}
        assert seen.items() <= now.items() and sorted(now.values()) == list(range(len(now)))
        seen = now
        assert names(SP.encode(df, index, ["install_channel"]), index) == sorted((u, f"install_channel_{v}") for u, vs, _ in day for v in vs)
    assert seen == {"b": 0, "d": 1, "a": 2, "c": 3, "e": 4}


def test_no_rows_and_unknown_values(spark):
    none = frame(spark, [])
    index = SP.numbered(SP.value_pairs(none, ["install_channel"]))
    assert index.count() == 0 and SP.encode(none, index, ["install_channel"]).count() == 0
    out = SP.encode(frame(spark, [("u", ["new"], None)]), index, ["install_channel"])
    assert out.first().dummies == []
    assert SP.unseen(SP.value_pairs(none, ["install_channel"]), index).count() == 0
