"""The three jobs end to end through catalog tables: features -> train -> score -> read back."""

import datetime as dt
import os

import pytest

from attrition.config import ModelConfig, Params
from attrition.plans import jobs
from attrition.sources import testmap

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_jobs_through_catalog_tables(spark, tmp_path):
    tag = tmp_path.name.replace("-", "_")
    names = {}
    for name, df in testmap.load(spark, SF).items():
        names[name] = f"src_{name}_{tag}"
        df.write.option("path", str(tmp_path / name)).saveAsTable(names[name])
    src = jobs.load_sources(spark, names["attribution_events"], names["hits"], names["customers"])
    p = testmap.PARAMS
    now = dt.datetime(2024, 1, 31)
    feats = jobs.data_preparation(spark, src, p, table=f"features_{tag}", path=str(tmp_path / "features"), now=now,
                                  vocab_table=f"vocab_{tag}")
    assert {"id_ga", "uninstall", "DtRef", "AaParticao", "MmParticao", "DdParticao"} <= set(feats.columns)
    n = feats.count()
    assert n > 0
    again = jobs.data_preparation(spark, src, p, table=f"features_{tag}", now=now)  # memoised
    assert again.count() == n
    model_path = str(tmp_path / "model")
    model, metrics = jobs.train_job(feats, ModelConfig(max_iter=3), model_path=model_path)
    assert metrics.count() == 1
    preds = jobs.score_job(feats, model_path, day="2024-01-04", table=f"predictions_{tag}",
                           path=str(tmp_path / "predictions"), now=now)
    rows = preds.collect()
    assert len(rows) == n and all(0.0 <= r["prob_uninstall"] <= 1.0 for r in rows)
    assert {r["MmParticao"] for r in rows} == {"01"} and feats.schema["install_channel"].dataType.simpleString() == "array<string>"
    assert [c for c in feats.columns if c.startswith("install_channel_")] == ["install_channel_idx"]
    index = {r["idx"]: r["value"] for r in spark.table(f"vocab_{tag}_open").collect()}
    assert all([index[i] for i in r["install_channel_idx"]] == sorted(r["install_channel"]) for r in feats.collect())
    from attrition.sources import schemas

    assert {f.name: f.dataType for f in preds.schema.fields} == {f.name: f.dataType for f in schemas.PREDICTION.fields}


def test_missing_contract_column_is_reported(spark):
    from attrition.sources import schemas
    from attrition.sources.tables import check_contract

    df = spark.createDataFrame([("x",)], "advertising_id string")
    with pytest.raises(ValueError, match="appsflyer_id"):
        check_contract(df, schemas.ATTRIBUTION_EVENTS, "t")


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_command_line(spark, tmp_path, capsys):
    from attrition.__main__ import main

    tag = "cli_" + tmp_path.name.replace("-", "_")
    for name, df in testmap.load(spark, SF).items():
        df.write.option("path", str(tmp_path / name)).saveAsTable(f"{name}_{tag}")
    main(["prepare", "--attribution", f"attribution_events_{tag}", "--hits", f"hits_{tag}",
          "--customers", f"customers_{tag}", "--trailing-days", "9", "--end", "2024-01-10", "--as-of", "2024-01-31",
          "--brand", "BRAND_A", "--table", f"features_{tag}", "--path", str(tmp_path / "features")], spark)
    main(["train", "--features", f"features_{tag}", "--model", str(tmp_path / "model"), "--trees", "2"], spark)
    main(["score", "--features", f"features_{tag}", "--model", str(tmp_path / "model"), "--day", "2024-01-04",
          "--table", f"predictions_{tag}", "--path", str(tmp_path / "predictions")], spark)
    out = capsys.readouterr().out
    assert "feature rows for 2024-01-10" in out and "scores for 2024-01-04" in out
    assert spark.table(f"features_{tag}_vocab").count() > 5
    assert spark.table(f"predictions_{tag}").count() == spark.table(f"features_{tag}").count()


def test_empty_vocabulary_gives_empty_feature_rows(spark):
    from attrition.operators import features as FT

    df = spark.createDataFrame([], "id_ga string, uninstall int, sessions long")
    assert FT.feature_rows(df, []).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_pipeline_with_outlier_replacement(spark, mode):
    src = testmap.load(spark, SF)
    base = jobs.build_feature_table(src, testmap.PARAMS.with_(outliers="off"))
    out = jobs.build_feature_table(src, testmap.PARAMS.with_(outliers=mode))
    assert sorted(r["id_ga"] for r in out.collect()) == sorted(r["id_ga"] for r in base.collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_two_days_share_the_first_days_vocabulary(spark, tmp_path):
    """A channel that is missing on the second day: the columns stay, the dummy is false, and the model can score."""
    from pyspark.sql import functions as F

    from attrition.operators import model as M

    tag = "days_" + tmp_path.name.replace("-", "_")
    src, p = testmap.load(spark, SF), testmap.PARAMS
    kw = {"table": f"features_{tag}", "path": str(tmp_path / "features"), "vocab_table": f"vocab_{tag}"}
    first = jobs.data_preparation(spark, src, p, day="2024-01-15", **kw)
    columns = first.columns
    other = {**src, "hits": src["hits"].withColumn("channelGrouping", F.lit("SEM - Shopping"))
             .withColumn("trafficSource", F.struct(F.lit(False).alias("isTrueDirect")))}
    second = jobs.data_preparation(spark, other, p, day="2024-01-16", **kw)
    assert second.columns == columns and second.count() == first.count() > 0
    assert second.where("`canais_Direto`").count() == 0 and first.where("`canais_Direto`").count() > 0
    model, _ = jobs.train_job(first, ModelConfig(max_iter=2))
    # a partition written without a dummy has it as null: scored as false
    without = M.model_features(model)[-1]
    a = M.score(second.withColumn(without, F.lit(None).cast(second.schema[without].dataType)), model)
    b = M.score(second.drop(without), model)
    if second.schema[without].dataType.simpleString() == "boolean":
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_age_band_follows_the_run_date(spark):
    from attrition.config import trailing_days
    from attrition.sources.tables import customers_with_age_band

    born = dt.date.today() - dt.timedelta(days=int(20.5 * 365.25))
    c = spark.createDataFrame([("SITE", "B", "1", "M", born)], "origem string, bandeira string, idcliente string, sexo string, "
                                                              "datanascimento date")
    first, last = trailing_days()
    band = lambda as_of: customers_with_age_band(c, Params.for_month("2026-11", first, last, "B", as_of=as_of)).first()["faixa_etaria"]
    assert band(None) == "ATE_20" and band((born + dt.timedelta(days=9000)).isoformat()) == "21_A_30"


def test_trailing_days_across_months():
    p = Params.for_trailing_days("2024-01-01", 2, brand="B")
    assert (p.sample_start, p.sample_end, p.period_start, p.period_end) == ("2023-12-30", "2024-01-01", "2023-12-01", "2024-01-31")
    assert p.hit_months == (("2023", "12"), ("2024", "01"))
    p = Params.for_trailing_days("2024-01-31", 2, brand="B")
    assert p.hit_months == (("2024", "01"), ("2024", "02")) and p.last_hit_day == "2024-02-01"
    assert Params.for_trailing_days("2024-01-20", 40, brand="B").hit_months == (("2023", "12"), ("2024", "01"))
    assert Params.for_month("2023-12", "2023-12-01", "2023-12-31", "B").hit_months == (("2023", "12"), ("2024", "01"))
    assert Params.for_month("2023-12", "2023-12-01", "2023-12-31", "B", hit_days_after_install=0).hit_months == (("2023", "12"),)


def test_shared_folder_is_required_away_from_a_local_master():
    from attrition.session import is_local

    assert is_local("local[4]") and is_local("local") and not is_local("local-cluster[2,1,1024]") and not is_local("yarn")

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    from attrition.session import ensure_checkpoint_dir

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_intermediates_of_a_job_are_deleted(spark):
    from attrition.session import materialise, scratch_scope

    with scratch_scope(spark):
        df = materialise(spark.range(5))
        assert df.count() == 5
    kept = materialise(spark.range(6))
    with pytest.raises(Exception):
        df.count()
    assert kept.count() == 6


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_outliers_by_the_sketches_of_a_window_of_dates(spark, tmp_path):
    """A date that is judged by its own sketches gives the exact thresholds; an earlier date's sketches take part when in the window."""
    from pyspark.sql import functions as F

    from attrition.operators import features as FT
    from attrition.operators import sketches as SK

    tag = "sk_" + tmp_path.name.replace("-", "_")
    src, p = testmap.load(spark, SF), testmap.PARAMS
    exact = jobs.build_feature_table(src, p)
    kw = {"path": str(tmp_path / "f"), "sketch_table": f"sketches_{tag}", "day": "2024-01-15"}
    alone = jobs.data_preparation(spark, src, p, table=f"a_{tag}", sketch_days=1, **kw)
    number = [c for c in FT.NUMERIC_FEATURES if c in exact.columns]
    rows = lambda df: sorted(map(str, df.select("id_ga", *number).collect()))
    assert rows(alone) == rows(exact)
    low = spark.range(20_000).select(*[F.lit(0.0).alias(c) for c in FT.OUTLIER_COLUMNS])
    SK.store(low, f"sketches_{tag}", "2024-01-10")
    joint = jobs.data_preparation(spark, src, p, table=f"b_{tag}", sketch_days=30, **{**kw, "path": str(tmp_path / "g")})
    assert joint.agg(F.max("media_hits")).first()[0] == 0.0  # the earlier date's zeros are the median and the 95th percentile
