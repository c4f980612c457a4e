"""The three batch jobs: feature build (E1), training (E2), scoring (E3).

Each takes and returns DataFrames (plus the fitted model); table names are
parameters. Nothing is collected except the vocabulary, column lists, a few
scalars and the metrics row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from attrition.config import ModelConfig, Params
from attrition.operators import features as FT
from attrition.operators import installs as I
from attrition.operators import joins as J
from attrition.operators import model as M
from attrition.operators import sink as S
from attrition.operators import sketches as SK
from attrition.operators import sparse as SP
from attrition.session import materialise, scratch_scope


def load_sources(spark: SparkSession, attribution_table: str, hits_table: str, customers_table: str) -> dict:
    """Catalog tables by two-part name, read lazily (SRC1-3 apply their filters downstream).

    Each is checked against its input contract, so a missing column fails
    here with its name rather than deep inside a plan.
    """
    from attrition.sources import schemas
    from attrition.sources.tables import check_contract

    return {"attribution_events": check_contract(spark.table(attribution_table), schemas.ATTRIBUTION_EVENTS,
                                                 attribution_table),
            "hits": check_contract(spark.table(hits_table), schemas.HITS, hits_table),
            "customers": check_contract(spark.table(customers_table), schemas.CUSTOMERS, customers_table)}


def build_feature_table(sources: dict, p: Params, vocab=None, save_vocab=None, open_index=None, window_bounds=None) -> DataFrame:
    """PIP1 -> PIP3 -> PIP4."""
    installs = I.build_installs(sources["attribution_events"], p)
    joined = J.build_joined(installs, sources["hits"], sources["customers"], p)
    return FT.build_features(joined, p, vocab, save_vocab, open_index, window_bounds)


def frozen_vocab(spark: SparkSession, table: str | None):
    """The stored vocabulary (None before the first build)."""
    if table is None or not S.table_exists(spark, table):
        return None
    return FT.vocab_list(spark.table(table)) or None


def data_preparation(spark: SparkSession, sources: dict, p: Params, table: str | None = None,
                     day: str | None = None, path: str | None = None,
                     now: dt.datetime | None = None, vocab_table: str | None = None,
                     sketch_table: str | None = None, sketch_days: int = 30) -> DataFrame:
    """E1 / PIP5: the feature rows of `day` (default: end of the sample range).

    With a table name the partition is memoised: stored rows are returned
    as they are, otherwise the build runs and replaces the date partition. The
    first build stores the one-hot vocabulary in `vocab_table`; later ones read
    it, so that every date has the same columns. Beside it, `<vocab_table>_open`
    maps the values of the open column to the indexes of their sparse dummies;
    later dates add the values they see first. With a `sketch_table`, each build
    stores quantile sketches of its sessions there, and outliers are judged by
    the sessions of the last `sketch_days` dates, this one included.
    """
    stored_day = day or p.sample_end

    def save(vocab: DataFrame) -> None:
        if vocab_table is not None and not vocab.isEmpty():
            w = vocab.coalesce(1).write.mode("overwrite")
            if path:  # beside the feature table
                w = w.option("path", f"{path.rstrip('/')}_vocab")
            w.saveAsTable(vocab_table)

    def open_index(pairs: DataFrame) -> DataFrame:
        return SP.stored_index(spark, f"{vocab_table}_open", pairs, f"{path.rstrip('/')}_open" if path else None)

    def window_bounds(sessions: DataFrame) -> DataFrame:
        SK.store(sessions, sketch_table, stored_day, path=f"{path.rstrip('/')}_sketches" if path else None, now=now)
        first = (dt.date.fromisoformat(stored_day) - dt.timedelta(days=sketch_days - 1)).isoformat()
        return SK.bounds(SK.window(spark, sketch_table, first, stored_day))

    def build() -> DataFrame:
        return build_feature_table(sources, p, frozen_vocab(spark, vocab_table), save, open_index if vocab_table else None,
                                   window_bounds if sketch_table else None)

    if table is None:
        return build()
    with scratch_scope(spark):
        return S.memo_partition(spark, table, stored_day, build, path=path, now=now)


def train_job(features: DataFrame, cfg: ModelConfig = ModelConfig(), model_path: str | None = None):
    """E2 / ML8: returns (model, metrics row)."""
    feats = materialise(features, name="training-rows")
    model, metrics, _ = M.train(feats, cfg)
    if model_path:
        M.save_model(model, model_path)
    return model, metrics


def score_job(features: DataFrame, model: M.BoostedTrees | M.PipelineModel | str, day: str, table: str | None = None,
              path: str | None = None, now: dt.datetime | None = None) -> DataFrame:
    """E3 / ML9: score, stamp, replace the date partition of the prediction table, read it back."""
    if isinstance(model, str):
        model = M.load_model(model)
    stamped = S.stamp(M.score(features, model), day, now)
    if table is None:
        return stamped
    S.replace_day(stamped, table, day, path=path)
    return S.read_partition(features.sparkSession, table, day)
