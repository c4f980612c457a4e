"""Replacing a date in one step: failures, readers, versions."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from attrition.operators import sink as S

DAY = "2023-09-15"


@pytest.fixture(params=["managed", "external"])
def table(request, tmp_path):
    return f"t_{request.param}_{uuid.uuid4().hex}", (str(tmp_path / "t") if request.param == "external" else None)


def rows(spark, n, day=DAY, name="u"):
    return S.stamp(spark.range(n).select(F.concat(F.lit(name), "id").alias("id_ga"), F.rand(1).alias("p")), day)


def failing(df):
    """The same rows, with a plan that fails at the last of them."""
    return df.withColumn("p", F.when(F.col("id_ga").endswith("4"), F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("p")))


def ids(spark, name, day=DAY):
    return sorted(r.id_ga for r in S.read_partition(spark, name, day).collect())


def base(spark, name):
    return S._described(spark, name)["Location"].replace("file:", "")


def files(folder):
    return [os.path.join(d, f) for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")]


def test_a_failed_write_leaves_the_old_rows(spark, table):
    name, path = table
    S.replace_day(rows(spark, 5), name, DAY, path=path)
    before, held = ids(spark, name), sorted(files(base(spark, name)))
    with pytest.raises(Exception, match="lost"):
        S.replace_day(failing(rows(spark, 5, name="new")), name, DAY)
    with pytest.raises(Exception, match="lost"):
        S.replace_partitions(failing(rows(spark, 5, name="new")), name)
    assert ids(spark, name) == before and sorted(files(base(spark, name))) == held


def test_a_failed_first_write_leaves_an_empty_table(spark, table):
    name, path = table
    with pytest.raises(Exception, match="lost"):
        S.replace_day(failing(rows(spark, 5)), name, DAY, path=path)
    assert spark.table(name).count() == 0
    S.replace_day(rows(spark, 2), name, DAY)
    assert ids(spark, name) == ["u0", "u1"]


def test_a_reader_planned_before_the_swap_ends_and_one_after_sees_the_new_rows(spark, table):
    name, path = table
    S.replace_day(rows(spark, 5), name, DAY, path=path)
    reader = S.read_partition(spark, name, DAY)
    reader._jdf.queryExecution().executedPlan()  # planned: its files are listed
    S.replace_day(rows(spark, 3, name="new"), name, DAY)
    assert sorted(r.id_ga for r in reader.collect()) == [f"u{i}" for i in range(5)]
    assert ids(spark, name) == ["new0", "new1", "new2"]


def test_rows_may_come_from_the_table_that_they_replace(spark, table):
    name, path = table
    S.replace_day(rows(spark, 5), name, DAY, path=path)
    kept = S.read_partition(spark, name, DAY).where("id_ga > 'u2'")
    S.replace_day(kept, name, DAY)
    assert ids(spark, name) == ["u3", "u4"]


def test_replaced_versions_are_deleted_later(spark, table):
    name, path = table
    for n in range(1, 6):
        S.replace_day(rows(spark, n), name, DAY, path=path)
        S.replace_day(rows(spark, 1, "2023-09-16"), name, "2023-09-16", path=path)
    held = os.listdir(os.path.join(base(spark, name), S.VERSIONS))
    assert len(held) == 2  # one folder a date
    assert all(len(os.listdir(os.path.join(base(spark, name), S.VERSIONS, h))) == 1 + S.KEPT_VERSIONS for h in held)
    assert len(ids(spark, name)) == 5 and len(ids(spark, name, "2023-09-16")) == 1


def test_an_empty_rebuild_clears_the_date_alone(spark, table):
    name, path = table
    S.replace_partitions(rows(spark, 3).union(rows(spark, 2, "2023-09-16")), name, path=path)
    S.replace_day(rows(spark, 0), name, DAY)
    assert ids(spark, name) == [] and len(ids(spark, name, "2023-09-16")) == 2


def test_rows_of_another_date_are_an_error(spark, table):
    name, path = table
    S.replace_day(rows(spark, 2), name, DAY, path=path)
    with pytest.raises(Exception, match="not of 2023-09-15"):
        S.replace_day(rows(spark, 3, "2023-09-16"), name, DAY)
    assert len(ids(spark, name)) == 2


def test_any_text_can_be_a_partition(spark, tmp_path):
    name = f"t_any_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(1, "a/b's"), (2, "ü=1"), (3, None), (4, "x")], "v int, part string")
    S.replace_partitions(df, name, ["part"], path=str(tmp_path / "t"))
    S.replace_partitions(df.where("part = 'x'").withColumn("v", F.lit(9)), name, ["part"])
    S.replace_partitions(df.where("part like 'a%'").withColumn("v", F.lit(8)), name, ["part"])
    assert {(r.v, r.part) for r in spark.table(name).collect()} == {(8, "a/b's"), (2, "ü=1"), (3, None), (9, "x")}


def test_a_table_written_by_others_is_taken_over(spark, tmp_path):
    """Partitions in their usual folders stay readable and can be replaced."""
    name = f"t_plain_{uuid.uuid4().hex}"
    (rows(spark, 4).union(rows(spark, 2, "2023-09-16")).write.partitionBy(*S.PARTITION_COLUMNS)
     .option("path", str(tmp_path / "t")).saveAsTable(name))
    S.replace_day(rows(spark, 1, name="n"), name, DAY)
    assert ids(spark, name) == ["n0"] and len(ids(spark, name, "2023-09-16")) == 2


def test_new_columns_in_old_and_new_dates(spark, table):
    name, path = table
    S.replace_day(rows(spark, 1), name, DAY, path=path)
    S.replace_day(rows(spark, 1, "2023-09-16").withColumn("more", F.lit(7)), name, "2023-09-16")
    assert {(r.DdParticao, r.more) for r in spark.table(name).collect()} == {("15", None), ("16", 7)}


def test_a_killed_write_leaves_nothing_visible(spark, table):
    """Files of a version that was never published are not read, and the next replacement deletes them."""
    name, path = table
    S.replace_day(rows(spark, 2), name, DAY, path=path)
    v = S._Versions(spark, name)
    stray = f"{v.folder(dict(zip(S.PARTITION_COLUMNS, S.day_parts(DAY))))}/v000000000000001-dead"
    spark.range(50).write.parquet(stray)
    assert len(ids(spark, name)) == 2
    S.replace_day(rows(spark, 3), name, DAY)
    assert len(ids(spark, name)) == 3 and not os.path.exists(stray.replace("file:", ""))
