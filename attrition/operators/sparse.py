"""Dummies of open columns as sparse vectors (ML1 / AGG4 without a column per value).

The values of a free-text column such as `install_channel` can be many, so they get neither a column nor a row on the
driver. A table maps each (column, value) to an index; a row's dummies are the sorted indexes of its values, the places
of the ones in a sparse 0/1 vector. The table only grows: a value keeps its index, values first seen on a later date
are appended. Numbering is a rank over range partitions; encoding is one join on (column, value), in which Spark
broadcasts the table only if it measures it to be small, and splits a hot value otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.operators.features import qcol, tagged_with
from attrition.session import materialise

INDEX = "column string, value string, idx int"


def value_pairs(df: DataFrame, columns) -> DataFrame:
    """Distinct (column, value) of set or scalar columns; nulls have no dummy."""
    return _long(df, columns, []).distinct()


def _long(df: DataFrame, columns, keep: list[str]) -> DataFrame:
    parts = []
    for c in columns:
        values = qcol(c).cast("array<string>") if isinstance(df.schema[c].dataType, T.ArrayType) else F.array(qcol(c).cast("string"))
        parts.append(F.transform(F.coalesce(values, F.array().cast("array<string>")), tagged_with(c)))
    return (df.select(*keep, F.explode(F.concat(*parts)).alias("_p"))
            .select(*keep, "_p.column", "_p.value").where("value IS NOT NULL"))


def numbered(pairs: DataFrame, first: int = 0) -> DataFrame:
    """(column, value, idx) of distinct pairs, numbered by column and value from ``first`` on.

    The pairs are range-partitioned; a pair's number is its place in its range plus the sizes of the ranges before.
    """
    ranged = materialise(pairs.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()), name="value-pairs")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy("column", "value"))
    return (ranged.withColumn("k", inside).join(offsets, "part")
            .select("column", "value", (F.col("offset") + F.col("k") - 1 + F.lit(first)).cast("int").alias("idx")))


def unseen(pairs: DataFrame, index: DataFrame | None) -> DataFrame:
    """The index rows to append for pairs that the index does not have yet."""
    if index is None:
        return numbered(pairs)
    top = index.agg(F.max("idx").alias("top")).first()["top"]
    return numbered(pairs.join(index, ["column", "value"], "left_anti"), 0 if top is None else top + 1)


def encode(df: DataFrame, index: DataFrame, columns, name: str = "dummies") -> DataFrame:
    """``df`` with ``name``: the sorted indexes of the row's values in the columns. Values without an index set no dummy."""
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), name="open-rows")
    ones = (_long(rows, columns, ["_row"]).join(index.select("column", "value", "idx"), ["column", "value"])
            .groupBy("_row").agg(F.array_sort(F.collect_set("idx")).alias(name)))
    return (rows.join(ones, "_row", "left").drop("_row")
            .withColumn(name, F.coalesce(qcol(name), F.array().cast("array<int>"))))


def decode(df: DataFrame, index: DataFrame, key: str = "id_ga", name: str = "dummies") -> DataFrame:
    """Long form (key, dummy name) of the vectors."""
    return (df.select(qcol(key), F.explode(qcol(name)).alias("idx")).join(index, "idx")
            .select(qcol(key), F.concat_ws("_", "column", "value").alias("name")))


def stored_index(spark: SparkSession, table: str, pairs: DataFrame, path: str | None = None) -> DataFrame:
    """The index table with all of the pairs in it: the new ones are appended first."""
    known = spark.table(table) if spark.catalog.tableExists(table) else None
    new = materialise(unseen(pairs, known), name="new-values")
    if known is None or not new.isEmpty():
        w = new.write.mode("append")
        (w.option("path", path) if path else w).saveAsTable(table)
    return spark.table(table)
