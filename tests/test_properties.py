
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from attrition.config import Params
from attrition.operators import features as FT
from attrition.operators import installs as I
from attrition.sources import schemas

P = Params.for_month("2023-09", sample_start="2023-09-01", sample_end="2023-09-30", brand="B", materialise=False)
SCREENS = ["busca", "produto", "home"]
CHANNELS = ["Direto", "outros_canais", "install : Organico"]

users = st.lists(st.tuples(st.sampled_from(["ATE_20", "+_50"]), st.sampled_from(["M", "F", None]),
                           st.lists(st.sampled_from(SCREENS), unique=True, max_size=3),
                           st.lists(st.sampled_from(CHANNELS), unique=True, max_size=3)),
                 min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(users)
def test_onehot_by_array_contains_equals_explode_then_max(spark, rows):
    data = [(f"u{i}", fx, sx, sv, ca) for i, (fx, sx, sv, ca) in enumerate(rows)]
    df = spark.createDataFrame(data, "id_ga string, faixa_etaria string, sexo string, screen_view array<string>, "
                                     "canais array<string>")
    cols = ["faixa_etaria", "sexo", "screen_view", "canais"]
    vocab = FT.vocab_list(FT.fit_vocab(df, cols), cols)
    names = [FT.dummy_name(c, v) for c, v in vocab]
    ours = sorted(tuple(r) for r in FT.onehot(df, vocab).select("id_ga", *[FT.qcol(n) for n in names]).collect())
    from tests.conftest import literal_onehot

    literal = literal_onehot(df, vocab)
    assert ours == sorted(tuple(r) for r in literal.select("id_ga", *[FT.qcol(n) for n in names]).collect())


def test_install_build_invariant_under_repartition(spark):
    t0 = dt.datetime(2023, 9, 5, 10)
    rows = []
    for u in range(40):
        for k in range(u % 4):
            rows.append((f"a{u}", f"d{u}", "install" if k % 2 else "reinstall", t0 + dt.timedelta(days=k * 9, hours=u),
                         (t0 + dt.timedelta(days=k * 9, hours=u)).date(), "Organico", None, "c", "B", "Android"))
        rows.append((f"z{u}", f"d{u}", "uninstall", t0 + dt.timedelta(days=u % 10), (t0 + dt.timedelta(days=u % 10)).date(),
                     None, None, None, "B", "Android"))
    ev = spark.createDataFrame(rows, schemas.ATTRIBUTION_EVENTS)
    base = sorted(tuple(r) for r in I.build_installs(ev, P).collect())
    for k in (1, 3, 7):
        assert sorted(tuple(r) for r in I.build_installs(ev.repartition(k), P).collect()) == base


def test_feature_table_invariant_under_input_partitioning(spark):
    import os

    from attrition.plans import jobs
    from attrition.sources import testmap

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        return
    src = testmap.load(spark, sf)
    p = testmap.PARAMS

    def rows(frames):
        out = jobs.build_feature_table(frames, p)
        cols = sorted(out.columns)
        return sorted(tuple(r) for r in out.select(*[FT.qcol(c) for c in cols]).collect())

    base = rows(src)
    assert base
    for k in (1, 13):
        assert rows({name: df.repartition(k) for name, df in src.items()}) == base
