"""Correlation filter, split, class weight, boosted trees, metrics, scoring (ML2-ML9).

Everything stays distributed: the correlation matrix is a sum of per-partition
moment matrices, the split follows a hash of the id, metrics come from one grouped
confusion count, and training/scoring are passes over the rows: the histogram
booster of `boosting.py`, or `pyspark.ml`'s trees (``ModelConfig.engine``). Only small,
bounded things reach the driver: column means, the k x k moments, the kept
column list, the trees and the metrics.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.config import ModelConfig
from attrition.functions import values as V
from attrition.operators import boosting
from attrition.operators.boosting import BoostedTrees, BoostOptions

ID = "id_ga"
LABEL = "uninstall"
NUMERIC_TYPES = (T.NumericType, T.BooleanType)


def _q(name: str) -> F.Column:
    return F.col("`" + name.replace("`", "``") + "`")


def correlation_columns(df: DataFrame, include_label: bool = True) -> list[str]:
    """Numeric/boolean columns in frame order, without the id and the `install_channel` dummies."""
    out = []
    for f in df.schema.fields:
        if f.name == ID or V.CORR_EXCLUDED_SUBSTRING in f.name:
            continue
        if f.name == LABEL and not include_label:
            continue
        if isinstance(f.dataType, NUMERIC_TYPES):
            out.append(f.name)
    return out


def _moments(columns: list[str], means: list[float]):
    k = len(columns)
    mu = np.array([0.0 if m is None else m for m in means])

    def run(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan) - mu
            m = (~np.isnan(x)).astype("float64")
            x0 = np.nan_to_num(x, nan=0.0)
            part = np.stack([m.T @ m, x0.T @ m, (x0 * x0).T @ m, x0.T @ x0])
            acc = part if acc is None else acc + part
        if acc is None:
            return
        i, j = np.triu_indices(k, 1)
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"),
                            "n": acc[0][i, j], "sx": acc[1][i, j], "sy": acc[1][j, i],
                            "sxx": acc[2][i, j], "syy": acc[2][j, i], "sxy": acc[3][i, j]})

    return run


def corr_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """ML2 / AGG7: Pearson r for every column pair, each over rows where both are non-null.

    Two passes: column means (one aggregate), then per-partition moment
    matrices of the centred values in `mapInPandas` (numpy), summed by pair
    with a grouped aggregate. Undefined r (fewer than two rows, a constant
    column) is null. Output: `col_i, col_j, i, j, r` for i < j. More than
    ``CORR_BLOCK`` columns are done in tiles, see `corr_tiles`.
    """
    columns = columns or correlation_columns(df)
    if len(columns) > CORR_BLOCK:
        return corr_tiles(df, columns)
    num = df.select(*[_as_number(df, c).alias(f"c{n}") for n, c in enumerate(columns)])
    means = list(num.agg(*[F.avg(c) for c in num.columns]).first())
    names = F.create_map(*itertools.chain.from_iterable((F.lit(k), F.lit(c)) for k, c in enumerate(columns)))
    return _pearson(num.mapInPandas(_moments(columns, means), MOMENTS)).select(
        names[F.col("i")].alias("col_i"), names[F.col("j")].alias("col_j"), "i", "j", "r")


MOMENTS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pearson(parts: DataFrame) -> DataFrame:
    """(i, j, r) from the partial moments of every pair."""
    sums = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy"))
    cov = n * sxy - sx * sy
    var = (n * sxx - sx * sx) * (n * syy - sy * sy)
    # clamp rounding noise; greatest/least skip nulls, so clamp inside the when
    r = F.when((n >= 2) & (var > 0), F.least(F.greatest(cov / F.sqrt(var), F.lit(-1.0)), F.lit(1.0)))
    return sums.select("i", "j", r.alias("r"))


#: Columns whose moment matrices (four of this width squared) one task holds at a time.
CORR_BLOCK = 512


def corr_tiles(df: DataFrame, columns: list[str], block: int = CORR_BLOCK // 2) -> DataFrame:
    """AGG7 at large width: the same r, a tile of two column blocks at a time.

    Every pair of blocks is a scan of its own that reads just the columns of
    the two (of a columnar table), and holds four block x block matrices, so
    memory does not grow with the number of columns; a column is read once
    per block. The tiles run side by side in one job.
    """
    blocks = [list(range(at, min(at + block, len(columns)))) for at in range(0, len(columns), block)]
    means: list = []
    for b in blocks:
        means += list(df.agg(*[F.avg(_as_number(df, columns[n])).alias(f"c{n}") for n in b]).first())
    parts = None
    for x, rows in enumerate(blocks):
        for y in range(x, len(blocks)):
            both = rows + blocks[y] if y > x else rows
            num = df.select(*[_as_number(df, columns[n]).alias(f"c{n}") for n in both])
            tile = num.mapInPandas(_tile_moments([means[n] for n in both], rows, blocks[y]), MOMENTS)
            parts = tile if parts is None else parts.unionAll(tile)
    names = F.array(*[F.lit(c) for c in columns])
    return _pearson(parts).select(F.get(names, "i").alias("col_i"), F.get(names, "j").alias("col_j"), "i", "j", "r")


def _tile_moments(means: list, rows: list[int], cols: list[int]):
    """Moments of the pairs i < j between two column blocks (equal ones: inside the block)."""
    mu, a = np.array([0.0 if m is None else m for m in means]), len(rows)
    same = rows == cols

    def run(batches):
        held = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64", na_value=np.nan) - mu
            m = (~np.isnan(x)).astype("float64")
            x = np.nan_to_num(x, nan=0.0)
            xi, mi = x[:, :a], m[:, :a]
            xj, mj = (xi, mi) if same else (x[:, a:], m[:, a:])
            part = np.stack([mi.T @ mj, xi.T @ mj, mi.T @ xj, (xi * xi).T @ mj, mi.T @ (xj * xj), xi.T @ xj])
            held = part if held is None else held + part
        if held is None:
            return
        i, j = np.triu_indices(a, 1) if same else map(np.ravel, np.indices((a, len(cols))))
        at = np.array(rows, "int32"), np.array(cols, "int32")
        yield pd.DataFrame({"i": at[0][i], "j": at[1][j], **dict(zip(("n", "sx", "sy", "sxx", "syy", "sxy"), held[:, i, j]))})

    return run


def correlated_drops(matrix: DataFrame, threshold: float = V.CORR_THRESHOLD) -> DataFrame:
    """Columns to drop: `col_j` (later) where some earlier column has threshold <= |r| < 1.

    An earlier column counts even if it is itself dropped; exact duplicates
    (|r| = 1 after rounding to 9 decimals) and undefined r are kept.
    """
    a = F.round(F.abs(F.col("r")), 9)
    return (matrix.filter((a >= threshold) & (a < 1.0))
            .groupBy("col_j").agg(F.min("j").alias("j")).select(F.col("col_j").alias("column"), "j"))


def corr_filter(df: DataFrame, cfg: ModelConfig = ModelConfig()) -> tuple[DataFrame, list[str]]:
    """ML2: drop `install_channel*` and the highly correlated later columns; returns (frame, features).

    The label takes part in the matrix (as upstream) but is never dropped.
    """
    cols = correlation_columns(df, cfg.include_label_in_corr)
    drops = {r["column"] for r in correlated_drops(corr_matrix(df, cols), cfg.corr_threshold).collect()}
    drops.discard(LABEL)
    # features: the numeric/boolean candidates that survive (text columns such as
    # partition stamps never reach the assembler)
    features = [c for c in correlation_columns(df, include_label=False) if c not in drops]
    out = df.select(_q(ID), F.col(LABEL).cast("int").alias(LABEL), *[_q(c) for c in features])
    return out, features


def split_flag(id_col: str = ID, tenths: int = V.TRAIN_FRACTION_TENTHS) -> F.Column:
    """ML3: True for the training side; a hash of the id, stable under repartitioning."""
    bucket = F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 8), 16, 10).cast("long") % 10
    return bucket < tenths


def exact_split_flag(df: DataFrame, id_col: str = ID, tenths: int = V.TRAIN_FRACTION_TENTHS, bucket: int = 100_000) -> F.Column:
    """ML3 with an exact share: True for the n - ceil((1 - share) * n) first rows in the order of (md5(id), id).

    A distributed selection: rows are counted by the first three digits of the hash, then, inside the bucket that the
    boundary falls into, by three digits more, until that bucket has at most ``bucket`` rows; those alone
    are sorted for the last training row, which is all that is kept. Rows that share an id stay together, so
    a repeated id at the boundary can add a few rows to the training side.
    """
    keyed = df.select(F.md5(F.col(id_col).cast("string")).alias("h"), F.col(id_col).cast("string").alias("i")).where("i IS NOT NULL")
    prefix, left = "", None
    while True:
        at = len(prefix) + 3
        counts = keyed.where(F.col("h").startswith(prefix)).groupBy(F.substring("h", 1, at).alias("p")).count().orderBy("p").collect()
        if left is None:
            n = sum(r["count"] for r in counts)
            left = n - -(-n * (10 - tenths) // 10)
        if left <= 0:
            return F.lit(False)
        for r in counts:  # the bucket that holds the boundary
            if left <= r["count"]:
                break
            left -= r["count"]
        prefix = r["p"]
        if r["count"] <= bucket or at >= 30:
            break
    last = keyed.where(F.col("h").startswith(prefix)).orderBy("h", "i").limit(left).agg(F.max(F.struct("h", "i")).alias("x")).first()["x"]
    own = F.struct(F.md5(F.col(id_col).cast("string")).alias("h"), F.col(id_col).cast("string").alias("i"))
    upto = own <= F.struct(F.lit(last["h"]).alias("h"), F.lit(last["i"]).alias("i"))
    return F.when(F.col(id_col).isNull(), F.lit(False)).otherwise(upto)


def class_weight(train: DataFrame, label: str = LABEL) -> DataFrame:
    """AGG6: one row, negatives / positives (null when there are no positives)."""
    y = F.col(label).cast("int")
    return train.agg(F.count_if(y == 0).alias("n_negative"), F.count_if(y == 1).alias("n_positive")).select(
        "n_negative", "n_positive",
        F.try_divide(F.col("n_negative").cast("double"), F.col("n_positive").cast("double")).alias("scale_pos_weight"))


def build_pipeline(features: list[str], cfg: ModelConfig = ModelConfig()) -> Pipeline:
    """ML4: assembler + gradient-boosted trees with a per-row class weight column `w`."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=LABEL, weightCol="w", stepSize=cfg.step_size,
                        maxDepth=cfg.max_depth, maxIter=cfg.max_iter, subsamplingRate=cfg.subsampling_rate,
                        seed=cfg.seed)
    return Pipeline(stages=[assembler, gbt])


def with_weight(df: DataFrame, scale_pos_weight: float | None) -> DataFrame:
    w = 1.0 if scale_pos_weight is None else float(scale_pos_weight)
    return df.withColumn("w", F.when(F.col(LABEL).cast("int") == 1, F.lit(w)).otherwise(F.lit(1.0)))


def numeric_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Booleans and ints as doubles for the assembler."""
    return df.withColumns({c: _as_number(df, c) for c in features})


def _as_number(df: DataFrame, c: str) -> F.Column:
    """A dummy that a date partition was written without is null there: the category did not occur, so 0.0."""
    if isinstance(df.schema[c].dataType, T.BooleanType):
        return F.coalesce(_q(c), F.lit(False)).cast("double")
    return _q(c).cast("double")


def metrics(predictions: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """ML7: accuracy, per-class precision and support-weighted precision from one confusion count.

    Upstream reports the weighted-average line under the name of accuracy; both
    figures are given here, rounded to 2 decimals like the text report.
    """
    cm = predictions.groupBy(F.col(label).cast("int").alias("y"), F.col(prediction).cast("int").alias("p")).count()
    agg = cm.agg(
        F.sum("count").alias("n"),
        F.sum(F.when(F.col("y") == F.col("p"), F.col("count"))).alias("correct"),
        *[F.sum(F.when((F.col("p") == k) & (F.col("y") == k), F.col("count"))).alias(f"tp{k}") for k in (0, 1)],
        *[F.sum(F.when(F.col("p") == k, F.col("count"))).alias(f"pred{k}") for k in (0, 1)],
        *[F.sum(F.when(F.col("y") == k, F.col("count"))).alias(f"sup{k}") for k in (0, 1)])
    prec = {k: F.coalesce(F.try_divide(F.coalesce(F.col(f"tp{k}"), F.lit(0)).cast("double"), F.col(f"pred{k}")),
                          F.lit(0.0)) for k in (0, 1)}
    sup = {k: F.coalesce(F.col(f"sup{k}"), F.lit(0)) for k in (0, 1)}
    weighted = F.try_divide(prec[0] * sup[0] + prec[1] * sup[1], F.col("n").cast("double"))
    return agg.select(
        F.round(F.try_divide(F.coalesce(F.col("correct"), F.lit(0)).cast("double"), F.col("n")), 2).alias("accuracy"),
        F.round(weighted, 2).alias("weighted_precision"),
        F.round(prec[0], 2).alias("precision_0"),
        F.round(prec[1], 2).alias("precision_1"),
        F.col("n").alias("n_evaluated"))


def boost_options(cfg: ModelConfig) -> BoostOptions:
    return BoostOptions(trees=cfg.max_iter, depth=cfg.max_depth, step=cfg.step_size, subsample=cfg.subsampling_rate, seed=cfg.seed)


def split(data: DataFrame, cfg: ModelConfig) -> tuple[DataFrame, DataFrame]:
    """ML3: the training and the test side."""
    if cfg.split == "random":
        share = cfg.train_tenths / 10
        return tuple(data.randomSplit([share, 1 - share], seed=cfg.seed))
    if cfg.split not in ("exact", "hash"):
        raise ValueError(f"unknown split {cfg.split!r}")
    is_train = exact_split_flag(data, ID, cfg.train_tenths) if cfg.split == "exact" else split_flag(ID, cfg.train_tenths)
    return data.filter(is_train), data.filter(~is_train)


def train(features_df: DataFrame, cfg: ModelConfig = ModelConfig()) -> tuple[BoostedTrees | PipelineModel, DataFrame, list[str]]:
    """ML8: corr filter -> split -> class weight -> fit -> metrics on the test side.

    Returns the fitted model, a one-row metrics frame and the feature list.
    """
    data, feats = corr_filter(features_df, cfg)
    data = numeric_features(data, feats)
    train_df, test_df = split(data, cfg)
    if train_df.isEmpty():
        raise ValueError("no training rows: the feature table (or its training side) is empty")
    spw = class_weight(train_df).first()["scale_pos_weight"]
    if cfg.engine == "histogram":
        model = boosting.fit(train_df, feats, LABEL, ID, spw, boost_options(cfg))
        scored = model.score(test_df, [LABEL])
    elif cfg.engine == "spark":
        model = build_pipeline(feats, cfg).fit(with_weight(train_df, spw))
        scored = model.transform(with_weight(test_df, spw))
    else:
        raise ValueError(f"unknown engine {cfg.engine!r}")
    m = metrics(scored).withColumn("scale_pos_weight", F.lit(spw).cast("double")) \
                       .withColumn("n_features", F.lit(len(feats)))
    return model, m, feats


def model_features(model: BoostedTrees | PipelineModel) -> list[str]:
    return list(model.features) if isinstance(model, BoostedTrees) else list(model.stages[0].getInputCols())


def model_size(model: BoostedTrees | PipelineModel) -> tuple[int, int]:
    """Number of trees and greatest depth asked for."""
    if isinstance(model, BoostedTrees):
        return len(model.trees), model.options.depth
    return model.stages[-1].getNumTrees, model.stages[-1].getOrDefault("maxDepth")


def align_features(df: DataFrame, features: list[str]) -> DataFrame:
    """The model's feature columns; a dummy the scoring data lacks, or has as null, is false (0.0)."""
    have = set(df.columns)
    cols = [_as_number(df, c).alias(c) if c in have else F.lit(0.0).alias(c) for c in features]
    return df.select(_q(ID), *cols)


def score(features_df: DataFrame, model: BoostedTrees | PipelineModel, refit_columns: bool = False,
          cfg: ModelConfig = ModelConfig()) -> DataFrame:
    """ML6 + ML9 + SNK5: `id_ga, prob_uninstall` (probability of class 1) for every row.

    The feature list stored with the model is used, so training and scoring
    columns always agree. ``refit_columns=True`` repeats the upstream step of
    re-running the correlation filter on the scoring data, and fails when that
    selects other columns than the model was trained on (as upstream would).
    """
    feats = model_features(model)
    if refit_columns:
        refit = corr_filter(features_df, cfg)[1]
        if refit != feats:
            raise ValueError(f"correlation filter on the scoring data keeps {refit}, the model expects {feats}")
    rows = align_features(features_df, feats)
    if isinstance(model, BoostedTrees):
        return model.score(rows, [ID]).select(ID, F.col("probability").alias("prob_uninstall"))
    return model.transform(rows).select(ID, vector_to_array("probability")[1].alias("prob_uninstall"))


def save_model(model: BoostedTrees | PipelineModel, path: str) -> None:
    """SNK7."""
    if isinstance(model, BoostedTrees):
        model.save(SparkSession.getActiveSession(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> BoostedTrees | PipelineModel:
    """SRC8."""
    spark = SparkSession.getActiveSession()
    return BoostedTrees.load(spark, path) if boosting.is_saved(spark, path) else PipelineModel.load(path)
