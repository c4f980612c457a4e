
import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from attrition.config import ModelConfig, Params
from attrition.operators import features as FT
from attrition.operators import installs as I
from attrition.operators import model as M
from attrition.operators import sink as S
from attrition.sources import schemas

T0 = dt.datetime(2023, 9, 5, 10, 0, 0)
P = Params.for_month("2023-09", sample_start="2023-09-01", sample_end="2023-09-30", brand="B", materialise=False)


def ev(adv, af, name, ts, grouping="Organico", source="facebook ads", channel="c1"):
    return (adv, af, name, ts, ts.date(), grouping, source, channel, "B", "Android")


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.ATTRIBUTION_EVENTS)


def test_fan_out_of_old_installs_times_uninstalls(spark):
    rows = [ev("a1", "d1", "install", T0),
            ev("a1", "d1", "install", dt.datetime(2023, 7, 1, 8)),
            ev("a1", "d1", "reinstall", dt.datetime(2023, 6, 1, 8)),
            ev("x", "d1", "uninstall", T0 + dt.timedelta(days=1)),
            ev("x", "d1", "uninstall", T0 + dt.timedelta(days=2)),
            ev("x", "d1", "uninstall", T0 + dt.timedelta(days=3))]
    # the July/June installs are outside the period, so a1 has one install in it
    out = I.build_installs(events(spark, rows), P).first()
    assert (out["uninstall"], out["total_installs_antigos"]) == (1, 6)
    assert out["recencia_last_install"] == (T0.date() - dt.date(2023, 7, 1)).days
    fixed = I.build_installs(events(spark, rows), P.with_(dedupe_uninstalls=True)).first()
    assert fixed["total_installs_antigos"] == 2


def test_no_history_gives_zero_and_minus_one(spark):
    out = I.build_installs(events(spark, [ev("a1", "d1", "install", T0)]), P).first()
    assert (out["uninstall"], out["total_installs_antigos"], out["recencia_last_install"]) == (0, 0, -1)


def test_uninstall_window_boundary_is_midnight(spark):
    base = dt.datetime(2023, 9, 1, 10)
    inside = [ev("a1", "d1", "install", base), ev("z", "d1", "uninstall", dt.datetime(2023, 9, 9, 0, 0, 0))]
    outside = [ev("a1", "d1", "install", base), ev("z", "d1", "uninstall", dt.datetime(2023, 9, 9, 0, 0, 1))]
    assert I.build_installs(events(spark, inside), P).first()["uninstall"] == 1
    assert I.build_installs(events(spark, outside), P).first()["uninstall"] == 0


def test_advertising_id_seen_twice_is_not_single(spark):
    rows = [ev("a1", "d1", "install", T0), ev("a1", "d1", "reinstall", T0 + dt.timedelta(hours=1)),
            ev("a2", "d2", "install", T0), ev("a2", "d2", "install", T0),  # exact duplicate: still single
            ev("0000-0000", "d3", "install", T0), ev(None, "d4", "install", T0)]
    got = sorted(r["advertising_appsflyer"] for r in I.build_installs(events(spark, rows), P).collect())
    assert got == ["a2"]


def test_explode_drops_hits_without_dimensions(spark):
    from attrition.operators.hits import exploded_dimensions

    schema = "id string, hits struct<customDimensions:array<struct<index:int,value:string>>>"
    df = spark.createDataFrame([("h1", ([(5, "busca")],)), ("h2", ([],)), ("h3", (None,))], schema)
    assert [r["id"] for r in exploded_dimensions(df, "id").collect()] == ["h1"]


def _uagg(spark, rows):
    schema = ("id_ga string, uninstall int, sessions long, media_qualitysession double, faixa_etaria string, "
              "sexo string, regioes string, screen_view array<string>, canais array<string>")
    return spark.createDataFrame(rows, schema)


def test_onehot_null_category_sets_no_dummy_and_null_key_row_drops(spark):
    df = _uagg(spark, [("u1", 0, 2, 1.5, "ATE_20", "M", None, ["busca"], []),
                       ("u2", 1, 1, None, "+_50", "F", "sul", [], ["Direto"])])
    vocab = [("faixa_etaria", "+_50"), ("faixa_etaria", "ATE_20"), ("sexo", "F"), ("sexo", "M"),
             ("regioes", "sul"), ("screen_view", "busca"), ("canais", "Direto")]
    cols = ["faixa_etaria", "sexo", "regioes", "screen_view", "canais"]
    enc = FT.onehot(df, vocab)
    u1 = enc.filter("id_ga = 'u1'").first().asDict()
    assert u1["regioes_sul"] is False and u1["screen_view_busca"] is True and u1["canais_Direto"] is False
    out = FT.feature_rows(df, vocab)
    assert [r["id_ga"] for r in out.collect()] == ["u1"]  # u2 has a null mean: dropped like a null group key
    assert FT.feature_rows(df, vocab, drop_null_keys=False).count() == 2
    assert set(FT.vocab_list(FT.fit_vocab(df, cols), cols)) == {
        ("faixa_etaria", "+_50"), ("faixa_etaria", "ATE_20"), ("sexo", "F"), ("sexo", "M"), ("regioes", "sul"),
        ("screen_view", "busca"), ("canais", "Direto")}


def test_onehot_equals_explode_then_max(spark):
    df = _uagg(spark, [("u1", 0, 2, 1.5, "ATE_20", "M", "sul", ["busca", "home"], ["Direto", "x"]),
                       ("u2", 1, 1, 2.0, "+_50", "F", None, [], [])])
    cols = ["faixa_etaria", "sexo", "regioes", "screen_view", "canais"]
    vocab = FT.vocab_list(FT.fit_vocab(df, cols), cols)
    ours = FT.onehot(df, vocab)
    from tests.conftest import literal_onehot

    literal = literal_onehot(df, vocab)
    names = [FT.dummy_name(c, v) for c, v in vocab]
    a = sorted(tuple(r) for r in ours.select("id_ga", *[FT.qcol(n) for n in names]).collect())
    b = sorted(tuple(r) for r in literal.select("id_ga", *[FT.qcol(n) for n in names]).collect())
    assert a == b


def test_outliers_exact_mode(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "v double")
    row = FT.outlier_bounds(df, ["v"], "exact").first()
    assert (row["v__median"], row["v__p95"]) == (50.0, 95.0)
    out = sorted(r[0] for r in FT.replace_outliers(df, ["v"], "exact").collect())
    assert out.count(50.0) == 6 and max(out) == 95.0


def test_corr_filter_rules(spark):
    rows = [(f"u{i}", i % 2, float(i), 2.0 * i, float(i) + (0.5 if i % 3 else -0.5), 7.0) for i in range(30)]
    df = spark.createDataFrame(rows, "id_ga string, uninstall int, a double, b double, c double, k double")
    m = {(r["col_i"], r["col_j"]): r["r"] for r in M.corr_matrix(df).collect()}
    assert m[("a", "k")] is None                       # constant column: undefined, no exception
    assert abs(m[("a", "b")] - 1.0) < 1e-12 and m[("a", "c")] > 0.98
    out, feats = M.corr_filter(df, ModelConfig())
    assert feats == ["a", "b", "k"]                    # c dropped; exact duplicate b kept; first column kept


def test_split_is_stable_and_about_70_percent(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("id_ga"))
    a = {r[0] for r in df.filter(M.split_flag()).collect()}
    b = {r[0] for r in df.repartition(7).filter(M.split_flag()).collect()}
    assert a == b and 0.65 < len(a) / 2000 < 0.75


def test_metrics_from_confusion_counts(spark):
    rows = [(0, 0.0)] * 6 + [(0, 1.0)] * 2 + [(1, 1.0)] * 3 + [(1, 0.0)] * 1
    m = M.metrics(spark.createDataFrame(rows, "uninstall int, prediction double")).first()
    assert m["accuracy"] == round(9 / 12, 2)
    assert (m["precision_0"], m["precision_1"]) == (round(6 / 7, 2), round(3 / 5, 2))
    assert m["weighted_precision"] == round((6 / 7 * 8 + 3 / 5 * 4) / 12, 2)


def test_replace_partition_keeps_other_days_and_string_parts(spark, tmp_path):
    df = spark.createDataFrame([("u1", 0.1), ("u2", 0.2)], "id_ga string, prob_uninstall double")
    table = "t_replace_" + tmp_path.name.replace("-", "_")
    S.replace_partitions(S.stamp(df, "2023-09-15"), table, path=str(tmp_path / "t"))
    S.replace_partitions(S.stamp(df, "2023-09-16"), table)
    S.replace_partitions(S.stamp(df.limit(1), "2023-09-15"), table)
    S.replace_partitions(S.stamp(df.limit(1), "2023-09-15"), table)  # idempotent
    assert S.read_partition(spark, table, "2023-09-16").count() == 2
    assert S.read_partition(spark, table, "2023-09-15").count() == 1
    assert {r["MmParticao"] for r in spark.table(table).collect()} == {"09"}
    # new column added on the way in
    S.replace_partitions(S.stamp(df.withColumn("extra", F.lit(1)), "2023-09-17"), table)
    assert "extra" in spark.table(table).columns and S.read_partition(spark, table, "2023-09-16").count() == 2


def test_memo_partition_computes_once(spark, tmp_path):
    df = spark.createDataFrame([("u1", 1)], "id_ga string, x int")
    table = "t_memo_" + tmp_path.name.replace("-", "_")
    calls = []

    def compute():
        calls.append(1)
        return df

    S.memo_partition(spark, table, "2023-09-15", compute, path=str(tmp_path / "t"))
    got = S.memo_partition(spark, table, "2023-09-15", compute)
    assert len(calls) == 1 and got.count() == 1


@pytest.mark.slow
def test_small_model_scores_every_row(spark):
    rows = [(f"u{i}", i % 2, float(i % 7), float((i * 3) % 5), bool(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "id_ga string, uninstall int, a double, b double, f boolean")
    model, metrics, feats = M.train(df, ModelConfig(max_iter=3))
    scored = M.score(df, model)
    probs = [r["prob_uninstall"] for r in scored.collect()]
    assert len(probs) == 60 and all(0.0 <= p <= 1.0 for p in probs)
    assert metrics.first()["n_evaluated"] == df.filter(~M.split_flag()).count()


def test_replacing_a_day_with_nothing_clears_it(spark, tmp_path):
    df = spark.createDataFrame([("u1", 0.1), ("u2", 0.2)], "id_ga string, prob_uninstall double")
    for path in (None, str(tmp_path / "t")):
        table = "t_clear_" + uuid.uuid4().hex  # a managed table's folder outlives the session
        S.replace_day(S.stamp(df, "2023-09-15"), table, "2023-09-15", path=path)
        S.replace_day(S.stamp(df, "2023-09-16"), table, "2023-09-16")
        S.replace_day(S.stamp(df.limit(0), "2023-09-15"), table, "2023-09-15")
        assert S.read_partition(spark, table, "2023-09-15").count() == 0
        assert S.read_partition(spark, table, "2023-09-16").count() == 2
        S.replace_day(S.stamp(df.limit(1).withColumn("more", F.lit(1)), "2023-09-16"), table, "2023-09-16")
        assert [tuple(r) for r in S.read_partition(spark, table, "2023-09-16").select("id_ga", "more").collect()] == [("u1", 1)]


def test_stamp_needs_a_padded_date(spark):
    df = spark.createDataFrame([("u1",)], "id_ga string")
    for day in ("2023-9-5", "20230905", "x"):
        with pytest.raises(ValueError):
            S.stamp(df, day)


def test_recorded_day_and_instant_may_differ(spark):
    """An install of the period by its recorded day, made after the period ends: its history still counts."""
    late = dt.datetime(2023, 10, 1, 2, 30)
    rows = [("a1", "d1", "install", late, dt.date(2023, 9, 30), "Organico", None, "c", "B", "Android"),
            ev("a1", "d1", "reinstall", dt.datetime(2023, 10, 1, 1, 0))[:4] + (dt.date(2023, 10, 1), None, None, "c", "B", "Android"),
            ("z", "d1", "uninstall", dt.datetime(2023, 10, 8, 12), dt.date(2023, 10, 8), None, None, None, "B", "Android")]
    for materialise in (False, True):
        out = I.build_installs(events(spark, rows), P.with_(materialise=materialise)).collect()
        assert [(r["total_installs_antigos"], r["uninstall"]) for r in out] == [(1, 1)]


def test_no_installs_at_all(spark):
    assert I.build_installs(events(spark, []), P.with_(materialise=True)).count() == 0


def test_table_exists_passes_on_catalog_errors():
    class Broken:
        class catalog:
            @staticmethod
            def tableExists(name):
                raise ConnectionError("catalog is down")

    with pytest.raises(ConnectionError):
        S.table_exists(Broken(), "db.t")


def test_hits_without_customer_id_stay_and_spread(spark):
    """Half of the hits have no customer id: same facts as a plain left join, and no partition holds them all."""
    from attrition.operators import joins as J

    customers = spark.createDataFrame([("1", "M", "ATE_20"), (None, "F", "+_50")], "idcliente string, sexo string, faixa_etaria string")
    base = {c: None for c in (*J.LEAN_COLUMNS, *J.INSTALL_ATTRS, "uninstall")}
    rows = [{**base, "id_ga": f"g{i}", "session_id": f"g{i}1", "idcliente": "1" if i % 2 else None, "uninstall": 0,
             "timestamp_hit": "2023-09-01 03:42", "dims": [("busca", None), ("busca", None)]} for i in range(200)]
    kinds = {"date": "date", "visitNumber": "int", "isTrueDirect": "boolean", "hits": "int", "screenviews": "int", "UniqueScreenviews": "int",
             "sessionQualityDim": "int", "dims": "array<struct<screen_view:string,produto_view:string>>", "uninstall": "int",
             "total_installs_antigos": "bigint", "recencia_last_install": "int",
             **{f"install_{x}": "int" for x in ("manha", "tarde", "noite", "madrugada")}}
    bruto = spark.createDataFrame([tuple(r[c] for c in base) for r in rows], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in base))
    out = J.session_facts(bruto, customers, P).collect()
    assert len(out) == 200 and {r["sexo"] for r in out} == {"M", None}
    assert sum(r["sexo"] is None for r in out) == 100
    keys = bruto.where("idcliente IS NULL").select(J._customer_key(F.col("idcliente"), F.col("session_id")).alias("k"))
    assert keys.distinct().count() > 50


def test_nested_columns_stay_out_of_the_hit_join(spark):
    import os

    from attrition.operators import joins as J
    from attrition.sources import testmap

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("driver tables not present")
    t, p = testmap.load(spark, "/root/testdata/sf0.001"), testmap.PARAMS
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lean = J.sampled_lean_hits(I.build_installs(t["attribution_events"], p), t["hits"], p)
        plan = spark._jvm.PythonSQLUtils.explainString(lean._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanged = [block for block in plan.split("\n\n") if ") Exchange" in block]
    assert exchanged and not any("customDimensions" in b or "geoNetwork" in b or "totals" in b for b in exchanged)


def test_table_exists_false_for_missing_database(spark):
    assert S.table_exists(spark, "no_such_db_xyz.no_table") is False
    assert S.table_exists(spark, "no_such_table_xyz") is False


def test_trailing_days_window():
    from attrition.config import trailing_days

    assert trailing_days("2023-09-03", 2) == ("2023-09-01", "2023-09-03")


def test_hit_rank_matches_dense_rank_across_buckets(spark):
    from pyspark.sql import Window

    from attrition.operators.hits import hit_rank

    rows = [("g1", 1, n) for n in [5, 1, 3, 3, None, 12, 7, 40, 2]] + [("g2", 1, n) for n in [9, 9, 4]]
    df = spark.createDataFrame(rows, "id_ga string, visitId long, n int").selectExpr(
        "id_ga", "visitId", "named_struct('HitNumber', n) AS hits")
    key = lambda t: (t[0], -1 if t[1] is None else t[1], t[2])
    got = sorted(((r["session_id"], r["hit_number"], r["hit_rank"]) for r in hit_rank(df, bucket_size=3).collect()),
                 key=key)
    flat = df.selectExpr("concat(id_ga, CAST(visitId AS STRING)) AS session_id", "hits.HitNumber AS hit_number")
    ref = flat.withColumn("r", F.dense_rank().over(Window.partitionBy("session_id").orderBy("hit_number")))
    assert got == sorted(((r["session_id"], r["hit_number"], r["r"]) for r in ref.collect()), key=key)


def test_replace_partition_dynamic_even_when_session_is_static(spark, tmp_path):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        df = spark.createDataFrame([("u1", 0.1), ("u2", 0.2)], "id_ga string, prob_uninstall double")
        table = "t_static_" + tmp_path.name.replace("-", "_")
        S.replace_partitions(S.stamp(df, "2023-09-15"), table, path=str(tmp_path / "t"))
        S.replace_partitions(S.stamp(df, "2023-09-16"), table)
        S.replace_partitions(S.stamp(df.limit(1), "2023-09-15"), table)
        assert S.read_partition(spark, table, "2023-09-16").count() == 2
        assert S.read_partition(spark, table, "2023-09-15").count() == 1
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)


def test_outliers_approx_mode_is_close(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)], "v double")
    row = FT.outlier_bounds(df, ["v"], "approx").first()
    assert abs(row["v__median"] - 500) <= 50 and abs(row["v__p95"] - 950) <= 2


@pytest.mark.slow
def test_random_split_and_refit_columns(spark):
    rows = [(f"u{i}", i % 2, float(i % 7), float((i * 3) % 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "id_ga string, uninstall int, a double, b double")
    model, metrics, feats = M.train(df, ModelConfig(max_iter=2, split="random"))
    assert metrics.first()["n_evaluated"] > 0
    assert M.score(df, model, refit_columns=True).count() == 60
    with pytest.raises(ValueError):
        M.score(df.withColumn("a2", F.col("a") * 2 + 1), model, refit_columns=True)


def test_cluster_conf_sizes_shuffle_partitions():
    from attrition.session import cluster_conf

    conf = cluster_conf(1 << 40)
    assert conf["spark.sql.shuffle.partitions"] == "8192"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert cluster_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"


def test_month_period_range_equals_month_format_test(spark):
    from attrition.config import month_period
    from attrition.operators.installs import _in_period

    assert month_period("2024-02") == ("2024-02-01", "2024-02-29")
    days = [dt.date(2024, 1, 31) + dt.timedelta(days=i) for i in range(0, 62)]
    df = spark.createDataFrame([(d,) for d in days], "event_time_sm date")
    for month in ("2024-02", "2024-03"):
        p = Params.for_month(month, sample_start=month + "-01", sample_end=month + "-01", brand="B")
        ours = {r[0] for r in df.filter(_in_period(p)).collect()}
        upstream = {r[0] for r in df.filter(F.date_format("event_time_sm", "yyyy-MM") == month).collect()}
        assert ours == upstream and p.hit_months == (tuple(month.split("-")),)


def test_training_on_no_rows_says_so(spark):
    df = spark.createDataFrame([], "id_ga string, uninstall int, a double")
    with pytest.raises(ValueError, match="no training rows"):
        M.train(df, ModelConfig(max_iter=2))


def test_read_partition_prunes_on_string_equality(spark, tmp_path):
    df = spark.createDataFrame([("u1", 0.1)], "id_ga string, prob_uninstall double")
    table = "t_prune_" + tmp_path.name.replace("-", "_")
    S.replace_partitions(S.stamp(df, "2023-09-05"), table, path=str(tmp_path / "t"))
    S.replace_partitions(S.stamp(df, "2023-10-05"), table)
    df_read = S.read_partition(spark, table, "2023-09-05")
    plan = spark._jvm.PythonSQLUtils.explainString(df_read._jdf.queryExecution(), "formatted")
    scan = [line for line in plan.splitlines() if line.startswith("PartitionFilters")][0]
    assert "(MmParticao" in scan and "= 09)" in scan and "cast(" not in scan.lower()


def _hit(day, visitor="v1", device="a1", visit=1):
    """A hit of one day, in that day's partition."""
    y, m, _ = day.split("-")
    return (visitor, visit, 1, int(day.replace("-", "")), "ch", ("Android",), ("SP",), (False,), (1, 1, 1, 1),
            [(69, device)], (1, 0, "10", "05", [(5, "home")], ("c", "a", "l")), "APP", y, m, "B")


@pytest.mark.parametrize("end,other", [("2024-01-31", "2024-02-20"), ("2023-12-31", "2024-01-20")])
def test_hits_of_the_day_after_the_months_last_install(spark, end, other, tmp_path):
    """An install on the last day of a month or year meets its hits of the day after; the rest of that month is not read."""
    from attrition.operators import joins as J

    after = (dt.date.fromisoformat(end) + dt.timedelta(days=1)).isoformat()
    p = Params.for_month(end[:7], sample_start=end[:7] + "-01", sample_end=end, brand="B", materialise=False)
    wrong = [f"{int(after[:4]) - (after[:4] != end[:4])}-{after[5:]}", f"{after[:4]}-{end[5:]}"] if after[:4] != end[:4] else []
    hits = spark.createDataFrame([_hit(end), _hit(after, visit=2), _hit(other, "v2", "a2")] + [_hit(w, "v3", "a3") for w in wrong],
                                 schemas.HITS)
    path = str(tmp_path / "hits")
    hits.write.partitionBy("OrigemParticao", "AaParticao", "MmParticao", "BandeiraParticao").parquet(path)
    stored = spark.read.schema(hits.schema).parquet(path)
    rows = [ev(f"a{i}", f"d{i}", "install", dt.datetime.fromisoformat(end + "T10:00:00")) for i in (1, 2, 3)]
    installs = I.build_installs(events(spark, rows), p)
    got = J.sampled_hits(installs, stored, p)
    assert sorted((r.id_ga, str(r.date)) for r in got.collect()) == [("v1", end), ("v1", after)]
    from attrition.sources import tables

    ga = tables.normalised_hits(stored, p)
    assert {(r.id_ga, str(r.date)) for r in ga.collect()} == {("v1", end), ("v1", after)}
    plan = spark._jvm.PythonSQLUtils.explainString(ga._jdf.queryExecution(), "formatted")
    scan = next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    assert f"= {after[:4]})" in scan and f"= {after[5:7]})" in scan and f"= {end[5:7]})" in scan


def test_history_bound_in_a_driver_zone_with_summer_time(spark, monkeypatch):
    """Instants in the hour that New York repeats are not moved by an hour on their way through the driver."""
    import time as clock

    first = dt.datetime(2023, 11, 5, 6, 30, tzinfo=dt.timezone.utc)
    stamps = [("a1", "d1", "install", first), ("a1", "d1", "reinstall", first - dt.timedelta(minutes=20)),
              ("a1", "d1", "reinstall", first - dt.timedelta(minutes=70)), ("x", "d1", "uninstall", first + dt.timedelta(minutes=10))]
    micros = [(a, d, n, int(t.timestamp()) * 1_000_000) for a, d, n, t in stamps]
    df = (spark.createDataFrame(micros, "advertising_id string, appsflyer_id string, event_name string, m long")
          .select("advertising_id", "appsflyer_id", "event_name", F.timestamp_micros("m").alias("event_time"),
                  F.when(F.col("event_name") == "install", F.lit("2023-11-05")).otherwise("2023-10-01").cast("date").alias("event_time_sm"),
                  F.lit("Organico").alias("atribuicao_canais"), F.lit("s").alias("media_source"), F.lit("c").alias("channel"),
                  F.lit("B").alias("bandeira_partition"), F.lit("Android").alias("device")))
    p = Params.for_month("2023-11", sample_start="2023-11-01", sample_end="2023-11-30", brand="B", dedupe_uninstalls=True)
    monkeypatch.setenv("TZ", "America/New_York")
    clock.tzset()
    try:
        out = I.build_installs(df, p).first()
    finally:
        monkeypatch.undo()
        clock.tzset()
    assert (out["total_installs_antigos"], out["uninstall"]) == (2, 1)
