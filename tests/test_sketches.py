"""Merged quantile sketches: rank error, windows of dates, columns without values; correlation in tiles."""

import bisect
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.operators import features as FT
from attrition.operators import model as M
from attrition.operators import sketches as SK


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_rank_error_of_merged_sketches(spark, parts):
    size, n = 256, 60_000
    df = spark.range(n).select((F.pow(F.pmod(F.xxhash64("id"), F.lit(100_000)), 2) / 7).alias("v"), (F.col("id") % 5).alias("day"))
    values = sorted(r.v for r in df.collect())
    days = [SK.sketch(df.where(f"day = {d}").repartition(parts), ["v"], size) for d in range(5)]
    every = days[0]
    for d in days[1:]:
        every = every.union(d)
    one = SK.merged(every, size)
    assert one.first()["n"] == n
    for q in (0.05, 0.5, 0.95):
        got = one.select(F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("q")).first()["q"]
        at = bisect.bisect_right(values, got) / n
        assert abs(at - q) <= SK.rank_error(size)
    assert SK.rank_error() < 0.001


def test_window_of_dates_and_columns_without_values(spark, tmp_path):
    table = f"sk_{uuid.uuid4().hex}"
    days = ["2023-12-30", "2023-12-31", "2024-01-01", "2024-01-02"]
    for i, day in enumerate(days):
        df = spark.createDataFrame([(float(10 * i + k), None) for k in range(10)], "a double, b double")
        SK.store(df, table, day, ["a", "b"], path=str(tmp_path / "sk"))
    SK.store(spark.createDataFrame([(1000.0, None)] * 3, "a double, b double"), table, days[0], ["a", "b"])  # stored again
    row = SK.bounds(SK.window(spark, table, days[1], days[2]), ["a", "b"]).first()
    assert (row["a__median"], row["a__p95"], row["b__median"], row["b__p95"]) == (19.0, 28.0, None, None)
    assert SK.bounds(SK.window(spark, table, days[0], days[0]), ["a", "b"]).first()["a__p95"] == 1000.0
    sessions = spark.createDataFrame([(5.0, 1.0), (99.0, 2.0), (None, None)], "a double, b double")
    out = FT.replace_outliers(sessions, ["a", "b"], bounds=SK.bounds(SK.window(spark, table, days[1], days[2]), ["a", "b"]))
    assert sorted(map(str, out.collect())) == sorted(["Row(a=5.0, b=1.0)", "Row(a=19.0, b=2.0)", "Row(a=None, b=None)"])


def wide(spark, path, n, k, seed=0):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k)) + 1e6
    x[:, 1] = 5.0
    x[:, 2] = x[:, 0] * 2
    x[rng.random((n, k)) < 0.1] = np.nan
    pq.write_table(pa.Table.from_pandas(pd.DataFrame(x, columns=[f"x{i}" for i in range(k)]), preserve_index=False), path)
    return x, spark.read.parquet(str(path)).select(*[F.when(~F.isnan(f"x{i}"), F.col(f"x{i}")).alias(f"x{i}") for i in range(k)])


def test_tiles_give_the_same_r(spark, tmp_path):
    x, df = wide(spark, tmp_path / "w.parquet", 300, 23)
    cols = df.columns
    plain = {(r.col_i, r.col_j): r.r for r in M.corr_matrix(df, cols).collect()}
    for block in (5, 8, 23):
        tiles = {(r.col_i, r.col_j): r.r for r in M.corr_tiles(df, cols, block).collect()}
        assert tiles.keys() == plain.keys()
        assert all((a is None and tiles[k] is None) or abs(a - tiles[k]) < 1e-12 for k, a in plain.items())


def test_many_columns_in_small_tiles(spark, tmp_path, monkeypatch):
    x, df = wide(spark, tmp_path / "w.parquet", 60, 1100)
    got = M.corr_matrix(df, df.columns)
    assert got.count() == 1100 * 1099 // 2
    some = {(r.i, r.j): r.r for r in got.where("i % 97 = 3 AND j % 89 = 5").collect()}
    assert len(some) > 50
    for (i, j), r in some.items():
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert abs(np.corrcoef(x[both, i], x[both, j])[0, 1] - r) < 1e-9
