"""Outlier thresholds from stored quantile sketches (OUT1 over a window of dates).

The thresholds of a window of dates need not read its sessions again: each date stores a KLL sketch per column (a few
dozen kilobytes), and a window merges those of its dates. A sketch of size k answers a quantile with a rank error of
about 2.3 / k^0.9 whatever the number of rows and merges: 0.07 % for the default, inside the upstream's 0.1 %. Up to k values it is
exact. Sketches are built map-side and merged per column; no session leaves its task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators import sink as S
from attrition.operators.features import OUTLIER_COLUMNS, qcol

SIZE = 8192


def rank_error(size: int = SIZE) -> float:
    """The rank error, as a share of the rows, that a sketch of this size keeps to with 99 % confidence."""
    return 2.296 / size ** 0.9021


def sketch(df: DataFrame, columns=OUTLIER_COLUMNS, size: int = SIZE) -> DataFrame:
    """One row per column: column, n (values that are not null) and their sketch."""
    one = df.agg(*[F.kll_sketch_agg_double(qcol(c).cast("double"), F.lit(size)).alias(f"s{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)])
    return (one.select(F.explode(rows).alias("r"))
            .select("r.column", F.kll_sketch_get_n_double("r.sketch").alias("n"), "r.sketch"))


def merged(sketches: DataFrame, size: int = SIZE) -> DataFrame:
    """One row per column over any number of stored sketches."""
    return (sketches.where("n > 0").groupBy("column")
            .agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch")))


def bounds(sketches: DataFrame, columns=OUTLIER_COLUMNS) -> DataFrame:
    """One-row frame as of ``features.outlier_bounds``: median and 95th percentile of each column, null without values."""
    found = merged(sketches).select(
        "column", F.kll_sketch_get_quantile_double("sketch", F.lit(0.5)).alias("median"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.95)).alias("p95"))
    return found.agg(*[F.max(F.when(F.col("column") == c, F.col(k))).alias(f"{c}__{k}") for c in columns for k in ("median", "p95")])


def store(sessions: DataFrame, table: str, day: str, columns=OUTLIER_COLUMNS, path: str | None = None,
          now: dt.datetime | None = None) -> None:
    """Store the sketches of a date's sessions, in place of those it had."""
    S.replace_day(S.stamp(sketch(sessions, columns), day, now), table, day, path=path)


def window(spark: SparkSession, table: str, first: str, last: str) -> DataFrame:
    """The stored sketches of the dates from ``first`` to ``last``."""
    days = (dt.date.fromisoformat(last) - dt.date.fromisoformat(first)).days
    wanted = F.lit(False)
    for i in range(days + 1):
        wanted = wanted | S.partition_filter((dt.date.fromisoformat(first) + dt.timedelta(days=i)).isoformat())
    return spark.table(table).where(wanted)
