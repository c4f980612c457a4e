"""User feature table (PIP4): recodes, per-user aggregates, outliers, one-hot.

The upstream design explodes six sets per user (a cross product), one-hot
encodes the rows and max-collapses them again. Since every dummy is max-ed,
`array_contains(set, value)` on the single aggregated row gives the same
table, so the cross product is never built (`set_elements` gives the
elements in long form instead).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.config import Params
from attrition.functions import recodes as R
from attrition.functions import values as V
from attrition.session import materialise

ACTION_SET_COLUMNS = ["screen_view", "produto_view", "action_event_v1", "action_event_v2"]
GROUP_KEYS = ["id_ga", "faixa_etaria", "sexo", "uninstall"]
OUTLIER_COLUMNS = ["hits", "screenviews", "UniqueScreenviews", "sessionQualityDim", "SessionVisitTime_minutes"]
NUMERIC_FEATURES = ["sessions", "media_hits", "media_screenviews", "media_uniquescreens", "media_qualitysession",
                    "media_timesession", "soma_timesession", "install_manha", "install_tarde", "install_noite",
                    "install_madrugada", "totals_installs_antigos", "recencia_last_install"]
BASE_COLUMNS = ["id_ga", "uninstall", *NUMERIC_FEATURES]
SET_COLUMNS = ["install_channel", "canais", *ACTION_SET_COLUMNS]


def qcol(name: str) -> F.Column:
    """Column by exact name (names built from data may hold dots or spaces)."""
    return F.col("`" + name.replace("`", "``") + "`")


def recode_sample(joined: DataFrame) -> DataFrame:
    """CND11 + CND12: action recode, missing sex/age band -> 'sem_info', sex normalised."""
    return (joined
            .withColumn("action_event_v2", R.action_recode("action_event_v2"))
            .withColumn("faixa_etaria", F.coalesce(F.col("faixa_etaria"), F.lit(V.MISSING_LABEL)))
            .withColumn("sexo", R.sex_normalise("sexo")))


def visitor_action_sets(amostra: DataFrame) -> DataFrame:
    """AGG2: four sets per visitor (nulls skipped; sorted so results are stable).

    Sets are bounded by the whitelists, and collect_set combines map-side, so a
    hot visitor costs one small row per map task.
    """
    return amostra.groupBy("id_ga").agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in ACTION_SET_COLUMNS])


def user_sessions(amostra: DataFrame) -> DataFrame:
    """Distinct session rows without the action columns, channel bucketed (CND13)."""
    return (amostra.drop(*ACTION_SET_COLUMNS).dropDuplicates()
            .withColumn("channelGrouping_latencia0", R.channel_bucket("channelGrouping_latencia0")))


def outlier_bounds(df: DataFrame, columns=OUTLIER_COLUMNS, mode: str = "exact",
                   median_rel_err: float = 0.05, upper_rel_err: float = 0.001) -> DataFrame:
    """One-row frame: median and 95th percentile of each column.

    ``exact`` uses the discrete percentile (a value of the column, as an exact
    quantile summary returns), from value counts; ``approx`` uses the quantile
    sketch with the upstream relative errors, in one aggregate pass.
    """
    if mode == "exact":
        return _exact_bounds(df, columns)
    if mode != "approx":
        raise ValueError(f"unknown outlier mode {mode!r}")
    aggs = []
    for c in columns:
        q = qcol(c).cast("double")
        aggs += [F.percentile_approx(q, 0.5, int(round(1 / median_rel_err))).alias(f"{c}__median"),
                 F.percentile_approx(q, 0.95, int(round(1 / upper_rel_err))).alias(f"{c}__p95")]
    return df.agg(*aggs)


def value_ranks(df: DataFrame, columns) -> DataFrame:
    """c (place of the column), v, n (rows with it), r (rows up to it) and total of every distinct value that is not null.

    No task has a buffer of all distinct values: values are counted (combined
    map-side) and range-partitioned; each range adds up its own counts on top of
    the total of the ranges before it.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("c"), qcol(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    counts = (df.select(F.explode(pairs).alias("x")).select("x.c", "x.v").where("v IS NOT NULL")
              .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    ranged = materialise(counts.repartitionByRange("c", "v").withColumn("part", F.spark_partition_id()), name="value-counts")
    totals = ranged.groupBy("c", "part").agg(F.sum("n").alias("held"))
    before = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = (totals.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
              .withColumn("total", F.sum("held").over(Window.partitionBy("c"))))
    upto = Window.partitionBy("c", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    return (ranged.withColumn("r", F.sum("n").over(upto)).join(totals, ["c", "part"])
            .withColumn("r", F.col("r") + F.col("before")).select("c", "v", "n", "r", "total"))


def _exact_bounds(df: DataFrame, columns) -> DataFrame:
    """Discrete percentiles: the smallest value that reaches the wanted rank."""
    ranks = value_ranks(df, columns)

    def percentile(i: int, q: float) -> F.Column:
        rank = F.greatest(F.lit(1), F.col("total") - F.floor(F.col("total") - F.lit(q) * F.col("total")))
        return F.min(F.when((F.col("c") == i) & (F.col("r") >= rank), F.col("v")))

    return ranks.agg(*[percentile(i, q).alias(f"{c}__{k}") for i, c in enumerate(columns)
                       for k, q in (("median", 0.5), ("p95", 0.95))])


def replace_outliers(df: DataFrame, columns=OUTLIER_COLUMNS, mode: str = "exact", bounds: DataFrame | None = None) -> DataFrame:
    """OUT1: values strictly above the 95th percentile become the median; nulls stay.

    The two thresholds per column are small scalars fetched with one aggregate
    job (or given as ``bounds``, for example of a window of dates, see
    `sketches.py`); the replacement itself is a projection. A column with no
    values keeps its values (upstream would fail).
    """
    row = (outlier_bounds(df, columns, mode) if bounds is None else bounds).first()
    out = df
    for c in columns:
        med, top = row[f"{c}__median"], row[f"{c}__p95"]
        if top is None:
            continue
        out = out.withColumn(c, F.when(qcol(c) > F.lit(top), F.lit(float(med))).otherwise(qcol(c).cast("double")))
    return out


def user_sessions_agg(sessions: DataFrame, action_sets: DataFrame) -> DataFrame:
    """AGG3 + JN6: per (visitor, age band, sex, label) aggregates joined with the action sets."""
    agg = sessions.groupBy(*GROUP_KEYS).agg(
        F.count_distinct("session_id").alias("sessions"),
        F.round(F.avg("hits"), 2).alias("media_hits"),
        F.round(F.avg("screenviews"), 2).alias("media_screenviews"),
        F.round(F.avg("UniqueScreenviews"), 2).alias("media_uniquescreens"),
        F.round(F.avg("sessionQualityDim"), 2).alias("media_qualitysession"),
        F.round(F.avg("SessionVisitTime_minutes"), 2).alias("media_timesession"),
        F.sum("SessionVisitTime_minutes").alias("soma_timesession"),
        F.max("install_manha").alias("install_manha"),
        F.max("install_tarde").alias("install_tarde"),
        F.max("install_noite").alias("install_noite"),
        F.max("install_madrugada").alias("install_madrugada"),
        F.max("total_installs_antigos").alias("totals_installs_antigos"),
        F.max("recencia_last_install").alias("recencia_last_install"),
        F.max("regioes").alias("regioes"),
        F.array_sort(F.collect_set("install_channel")).alias("install_channel"),
        F.array_sort(F.collect_set("channelGrouping_latencia0")).alias("canais"),
    )
    return agg.join(action_sets, "id_ga", "inner")


def set_elements(uagg: DataFrame, columns=SET_COLUMNS) -> DataFrame:
    """ARR6, re-aimed: the set elements in long form, one row per (user row, set column, element).

    Upstream chains six explode_outer, i.e. every combination of a user's set
    elements; the one-hot only needs which elements are present, so this
    emits each element once (linear in the data, no per-user product).
    """
    return (uagg.select(*GROUP_KEYS, F.explode(_pairs(uagg, columns)).alias("p"))
            .select(*GROUP_KEYS, "p.column", "p.value"))


def tagged_with(column: str):
    return lambda v: F.struct(F.lit(column).alias("column"), v.cast("string").alias("value"))


def _pairs(df: DataFrame, columns) -> F.Column:
    """array<struct<column,value>> of every (one-hot column, value) in a row."""
    parts = []
    for c in columns:
        if isinstance(df.schema[c].dataType, T.ArrayType):
            parts.append(F.transform(c, tagged_with(c)))
        else:
            parts.append(F.array(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))))
    return F.concat(*parts)


def fit_vocab(uagg: DataFrame, columns=V.ONEHOT_COLUMNS) -> DataFrame:
    """ML1 vocabulary: distinct (column, value) pairs, one pass and one small shuffle."""
    return (uagg.select(F.explode(_pairs(uagg, columns)).alias("p"))
            .select("p.column", "p.value").filter(F.col("value").isNotNull()).distinct())


# The columns whose values come from fixed lists. The other one, `install_channel`, is free text: its values are kept
# as an array, and become sparse dummies, or columns for a vocabulary that names them.
CLOSED_COLUMNS = tuple(c for c in V.ONEHOT_COLUMNS if c != "install_channel")
#: The open column's dummies, as sorted indexes (see `sparse.py`).
OPEN_DUMMIES = "install_channel_idx"


def vocab_list(vocab: DataFrame, columns=V.ONEHOT_COLUMNS) -> list[tuple[str, str]]:
    """The vocabulary on the driver, in dummy-column order (bounded by the fixed lists for the closed columns)."""
    order = {c: i for i, c in enumerate(columns)}
    rows = [(r["column"], r["value"]) for r in vocab.collect()]
    return sorted(rows, key=lambda cv: (order.get(cv[0], len(order)), cv[1]))


def dummy_name(column: str, value: str) -> str:
    return f"{column}_{value}"


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def onehot(df: DataFrame, vocab: list[tuple[str, str]], keep=()) -> DataFrame:
    """ML1: one boolean per vocabulary entry; a null category sets no dummy. ``keep``: encoded columns kept as well.

    Built as one projection of SQL expressions (the vocabulary can be wide;
    one parsed expression per dummy keeps plan construction cheap).
    """
    exprs = [sql_name(c) for c in df.columns if c not in V.ONEHOT_COLUMNS or c in keep]
    for c, v in vocab:
        if isinstance(df.schema[c].dataType, T.ArrayType):
            hit = f"array_contains({sql_name(c)}, {sql_string(v)})"
        else:
            hit = f"CAST({sql_name(c)} AS STRING) = {sql_string(v)}"
        exprs.append(f"coalesce({hit}, false) AS {sql_name(dummy_name(c, v))}")
    return df.selectExpr(*exprs)


def collapse_sets(uagg: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """AGG4 before the one-hot: group by every column that is not encoded, each encoded column a set of its values.

    Grouping the dummies and OR-ing them gives the same, but would shuffle every
    boolean; the sets are small. The grouping drops rows with a null key (as the
    upstream dataframe library does), unless ``drop_null_keys`` is False.
    """
    encoded = [c for c in uagg.columns if c in V.ONEHOT_COLUMNS]
    keys = [c for c in uagg.columns if c not in encoded]
    src = uagg.na.drop(subset=keys) if drop_null_keys else uagg

    def values(c: str) -> F.Column:
        if isinstance(uagg.schema[c].dataType, T.ArrayType):
            return F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
        return F.array_sort(F.collect_set(qcol(c).cast("string")))

    if not encoded:
        return src.select(*[qcol(c) for c in keys]).distinct()
    return src.groupBy(*[qcol(c) for c in keys]).agg(*[values(c).alias(c) for c in encoded])


def feature_rows(uagg: DataFrame, vocab: list[tuple[str, str]], drop_null_keys: bool = True) -> DataFrame:
    """The collapsed rows with one boolean per vocabulary entry; a column without any entry stays as a set."""
    rows = collapse_sets(uagg, drop_null_keys)
    named = {c for c, _ in vocab}
    kept = [c for c in rows.columns if c in V.ONEHOT_COLUMNS and c not in named and c not in CLOSED_COLUMNS]
    encoded = onehot(rows, vocab, keep=kept)
    return encoded


def user_aggregates(joined: DataFrame, p: Params, window_bounds: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Everything up to the one-hot: one row per (visitor, age band, sex, label).

    ``window_bounds``, if given, gets the sessions and returns the outlier thresholds to use.
    """
    # two consumers (sessions and action sets): compute the joined rows once
    amostra = recode_sample(materialise(joined, p.materialise, "joined-rows"))
    sessions = user_sessions(amostra)
    if p.outliers != "off":
        # read for the thresholds and again for the replacement
        sessions = materialise(sessions, p.materialise, "sessions")
        sessions = replace_outliers(sessions, OUTLIER_COLUMNS, p.outliers, window_bounds(sessions) if window_bounds else None)
    return user_sessions_agg(sessions, visitor_action_sets(amostra))


def build_features(joined: DataFrame, p: Params, vocab: list[tuple[str, str]] | None = None,
                   save_vocab: Callable[[DataFrame], None] | None = None,
                   open_index: Callable[[DataFrame], DataFrame] | None = None,
                   window_bounds: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """PIP4: the feature table, one row per user (see AGG3/AGG4 for when a user has more).

    With no frozen ``vocab`` the vocabulary of the closed columns is fitted on
    this data, and handed to ``save_vocab``. The user aggregate is then written
    first, so fitting and encoding read it once instead of recomputing the joins.
    ``open_index`` gets the open column's (column, value) pairs and returns their
    index table; the rows then have `install_channel_idx`, its sparse dummies.
    """
    uagg = user_aggregates(joined, p, window_bounds)
    if vocab is None:
        uagg = materialise(uagg, p.materialise, "user-aggregates")
        fitted = fit_vocab(uagg, CLOSED_COLUMNS)
        if save_vocab is not None:
            save_vocab(fitted)
        vocab = vocab_list(fitted)
    rows = feature_rows(uagg, vocab, p.drop_null_keys)
    left = [c for c in rows.columns if c in V.ONEHOT_COLUMNS]
    if open_index is None or not left:
        return rows
    from attrition.operators import sparse

    rows = materialise(rows, p.materialise, "feature-rows")
    return sparse.encode(rows, open_index(sparse.value_pairs(rows, left)), left, OPEN_DUMMIES)
