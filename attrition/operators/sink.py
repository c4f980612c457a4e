"""Date-partitioned tables: stamp, replace one partition, memoise, read (SNK1-4, SRC4, SRC7).

Upstream deletes the rows of the date and then appends (two steps on a Delta
table). Here the new rows of a date go into a folder of their own first, under
``_versions`` in the table's folder, and then the catalog's location of that
partition is changed to it, in one step:

* a write that fails changes nothing, and its folder is deleted;
* a reader sees the old rows or the new ones, never a part of either; the
  folder that was replaced stays until the date has been replaced
  ``KEPT_VERSIONS`` more times, so a reader that has listed its files ends;
* new data without rows clears the date; other dates stay untouched; a re-run
  is idempotent.

Data that spans dates is written once, and then published date by date. The
partitions of such a table are where the catalog says, so it is read through the
catalog (as everything here does), not by its path.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.sources.schemas import PARTITION_COLUMNS


def stamp(df: DataFrame, day: str, now: dt.datetime | None = None) -> DataFrame:
    """SNK4: DtRef and the year/month/day partition strings from 'yyyy-mm-dd', plus TsAtualizacao.

    The parts are the pieces of the given string (as upstream splits it), which
    must be zero-padded, as the partitions are read by; TsAtualizacao is the
    query time unless a fixed ``now`` is given.
    """
    year, month, dom = day_parts(day)
    ts = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return df.withColumns({"DtRef": F.lit(day), "AaParticao": F.lit(year), "MmParticao": F.lit(month),
                           "DdParticao": F.lit(dom), "TsAtualizacao": ts})


def day_parts(day: str) -> tuple[str, str, str]:
    """('2023', '09', '05') of '2023-09-05'; any other spelling of a date is an error."""
    if dt.date.fromisoformat(day).isoformat() != day:
        raise ValueError(f"not a yyyy-mm-dd date: {day!r}")
    year, month, dom = day.split("-")
    return year, month, dom


def table_exists(spark: SparkSession, name: str) -> bool:
    """SRC7: false also when the database does not exist; an unreachable catalog is an error, not a missing table."""
    return spark.catalog.tableExists(name)


def partition_filter(day: str, columns=PARTITION_COLUMNS) -> F.Column:
    """Equality on the zero-padded partition strings (prunable), from 'yyyy-mm-dd'."""
    cond = None
    for c, v in zip(columns, day_parts(day)):
        term = F.col(c) == F.lit(v)
        cond = term if cond is None else cond & term
    return cond


def read_partition(spark: SparkSession, table: str, day: str) -> DataFrame:
    """SRC4: the rows of one date partition, read through the catalog (partition types stay strings)."""
    return spark.table(table).filter(partition_filter(day))


def _add_missing_columns(spark: SparkSession, table: str, df: DataFrame) -> None:
    have = {f.name.lower() for f in spark.table(table).schema.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")


def _aligned(df: DataFrame, table: str) -> DataFrame:
    """`df` with the table's columns, in its order; new columns are added to the table first."""
    spark = df.sparkSession
    _add_missing_columns(spark, table, df)
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        F.col(f"`{have[f.name.lower()]}`").cast(f.dataType).alias(f.name) if f.name.lower() in have
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema.fields])


VERSIONS = "_versions"
#: Replaced folders of a date that are kept for readers that are still at them.
KEPT_VERSIONS = 1
#: The catalog's name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _described(spark: SparkSession, table: str, part: str = "") -> dict[str, str]:
    """The catalog's details of a table, or of one of its partitions; the first entry of a name counts."""
    out: dict[str, str] = {}
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table} {part}").collect():
        out.setdefault(r["col_name"], r["data_type"])
    return out


def _spec(values: dict[str, str]) -> str:
    return ", ".join(f"`{c}` = {_text(v)}" for c, v in values.items())


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Buckets:
    """Rows of every partition in ``n`` files by the hash of ``column``, sorted by it: joins on it need no shuffle of the table."""

    n: int
    column: str


def _create(df: DataFrame, table: str, partition_columns, path: str | None, fmt: str, buckets: Buckets | None = None) -> None:
    """An empty table with the columns of `df`."""
    w = df.limit(0).write.format(fmt).partitionBy(*partition_columns).mode("ignore")
    if buckets:
        w = w.bucketBy(buckets.n, buckets.column).sortBy(buckets.column)
    (w.option("path", path) if path else w).saveAsTable(table)


class _Versions:
    """The folders of a partitioned table, through the file system that holds it."""

    def __init__(self, spark: SparkSession, table: str):
        details = _described(spark, table)
        self.spark, self.table = spark, table
        self.base, self.fmt = details["Location"].rstrip("/"), details["Provider"]
        n = int(details.get("Num Buckets", 0))
        self.buckets = Buckets(n, details["Bucket Columns"].strip("[]`")) if n > 0 else None
        self.name = f"v{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:12]}"

    def _fs(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def delete(self, folder: str) -> None:
        path, fs = self._fs(folder)
        fs.delete(path, True)

    def names(self, folder: str) -> list[str]:
        path, fs = self._fs(folder)
        return sorted(f.getPath().getName() for f in fs.listStatus(path)) if fs.exists(path) else []

    def folder(self, values: dict[str, str]) -> str:
        """Where the versions of one partition lie; its values are hashed, so that any text is a folder name."""
        key = hashlib.sha256("\0".join(f"{c}={v}" for c, v in values.items()).encode()).hexdigest()[:24]
        return f"{self.base}/{VERSIONS}/{key}"

    def write(self, rows: DataFrame, folder: str, partition_columns=()) -> None:
        """Files of the table's format, in its buckets, in a folder that nothing refers to yet."""
        if self.buckets is None:
            w = rows.write.format(self.fmt).mode("errorifexists")
            (w.partitionBy(*partition_columns) if partition_columns else w).save(folder)
            return
        # one task a bucket, so one file a bucket and partition; a table over the folder is needed only for the write
        n, column = self.buckets.n, self.buckets.column
        name = f"bucketed_{uuid.uuid4().hex}"
        w = rows.repartition(n, _quoted(column)).write.format(self.fmt).bucketBy(n, column).sortBy(column).option("path", folder)
        try:
            (w.partitionBy(*partition_columns) if partition_columns else w).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay

    def publish(self, rows: DataFrame, values: dict[str, str]) -> None:
        """Write the rows (without the partition columns) as the new version of one partition, then point the catalog to it."""
        folder = f"{self.folder(values)}/{self.name}"
        try:
            self.write(rows, folder)
        except BaseException:
            self.delete(folder)
            raise
        self.point(values, folder)

    def take(self, file: str, values: dict[str, str]) -> None:
        """Publish the folder that holds a written file (of one partition) as the new version of that partition."""
        jvm = self.spark._jvm
        written = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).getParent()
        folder, fs = self._fs(f"{self.folder(values)}/{self.name}")
        fs.mkdirs(folder.getParent())
        if not fs.rename(written, folder):
            raise OSError(f"cannot move {written} to {folder}")
        self.point(values, f"{self.folder(values)}/{self.name}")

    def point(self, values: dict[str, str], folder: str) -> None:
        spec = _spec(values)
        self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION {_text(folder)}")
        self.spark.sql(f"ALTER TABLE {self.table} PARTITION ({spec}) SET LOCATION {_text(folder)}")
        self.clean(values)

    def clean(self, values: dict[str, str]) -> None:
        """Delete the versions that no reader is at any more: all but the current one and the last before it."""
        held = self.folder(values)
        current = _described(self.spark, self.table, f"PARTITION ({_spec(values)})")["Location"].rstrip("/").rsplit("/", 1)[-1]
        old = [n for n in self.names(held) if n < current]
        for n in old[:max(0, len(old) - KEPT_VERSIONS)]:
            self.delete(f"{held}/{n}")


def replace_day(df: DataFrame, table: str, day: str, path: str | None = None, fmt: str = "parquet") -> None:
    """SNK1 + SNK2 for one date: afterwards the partition of `day` holds exactly the rows of `df`, which may be none.

    Rows of `df` with another date are an error, found before anything is published.
    """
    spark = df.sparkSession
    values = dict(zip(PARTITION_COLUMNS, day_parts(day)))
    if not table_exists(spark, table):
        _create(df, table, PARTITION_COLUMNS, path, fmt)
    aligned = _aligned(df, table)
    other = F.concat_ws("-", *values) != F.lit("-".join(values.values()))
    wrong = F.raise_error(F.concat(F.lit(f"not of {day}: "), F.concat_ws("-", *values)))
    kept = [c for c in aligned.columns if c not in values]
    checked = aligned.where(F.when(F.coalesce(other, F.lit(True)), wrong.cast("boolean")).otherwise(True))
    _Versions(spark, table).publish(checked.select(*[_quoted(c) for c in kept]), values)


def _quoted(name: str) -> F.Column:
    return F.col("`" + name.replace("`", "``") + "`")


def replace_partitions(df: DataFrame, table: str, partition_columns=PARTITION_COLUMNS, path: str | None = None,
                       fmt: str = "parquet", buckets: Buckets | None = None) -> None:
    """SNK1 + SNK2: write `df`, replacing only the partitions it contains.

    Creates the table (partitioned, optionally at ``path``) on first use. New
    columns are added to the table first (the upstream `mergeSchema`); columns
    the data lacks are written as nulls. Everything is written before the first
    partition is published; each partition changes in one step, one after another.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        _create(df, table, partition_columns, path, fmt, buckets)
    aligned = _aligned(df, table)
    versions = _Versions(spark, table)
    staged = f"{versions.base}/{VERSIONS}/_staged-{versions.name}"
    try:
        versions.write(aligned, staged, partition_columns)
        rows = spark.read.format(versions.fmt).schema(aligned.schema).load(staged)
        # one row a partition: its values, and one of its files
        found = rows.groupBy(*partition_columns).agg(F.min("_metadata.file_path").alias("_file")).collect()
        for r in sorted(found, key=lambda r: r["_file"]):
            versions.take(r["_file"], {c: NULL_PARTITION if r[c] is None else str(r[c]) for c in partition_columns})
    finally:
        versions.delete(staged)


def memo_partition(spark: SparkSession, table: str, day: str, compute: Callable[[], DataFrame],
                   path: str | None = None, now: dt.datetime | None = None) -> DataFrame:
    """SNK3: the stored rows of `day` if there are any, else compute, stamp, store and read them back.

    The emptiness test is `isEmpty()` on the pruned partition (reads at most
    one row), not a full count.
    """
    if table_exists(spark, table):
        stored = read_partition(spark, table, day)
        if not stored.isEmpty():
            return stored
    replace_day(stamp(compute(), day, now), table, day, path=path)
    return read_partition(spark, table, day)
