"""Histogram boosting against a plain search over the same bins, and its rules for missing values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.config import ModelConfig
from attrition.operators import boosting as B
from attrition.operators import model as M
from attrition.operators.boosting import BoostOptions


def table(spark, n=240, seed=1, parts=3):
    """Labels that depend on a few features; missing values that matter; more than 255 distinct values in one."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.random(), rng.randint(0, 6), rng.choice([0.0, 1.0])
        z = a + 0.3 * c - 0.1 * b + (0.6 if i % 7 == 0 else 0)
        rows.append((f"u{i}", int(z + rng.gauss(0, 0.2) > 0.4), a, None if i % 7 == 0 else float(b), c,
                     math.nan if i % 5 == 0 else rng.choice([1.0, 2.0]), 3.0, None))
    return spark.createDataFrame(rows, "id string, y int, a double, b double, c double, d double, same double, none double").repartition(parts)


FEATURES = ["a", "b", "c", "d", "same", "none"]


def plain_cuts(values, bins):
    ordered = sorted(v for v in values if v is not None and not math.isnan(v))
    n, out = len(ordered), []
    for v in sorted(set(ordered)):
        upto, before = sum(x <= v for x in ordered), sum(x < v for x in ordered)
        if bins * upto // n > bins * before // n:
            out.append(v)
    return out


def plain_fit(rows, keys, cuts, weight, o):
    """Trees as nested (feature, bin, missing_left, gain, left, right) or ('leaf', value), by trying every split of every node."""
    scale = B.scale_for(len(rows), weight)
    bins = [[None if r[2 + f] is None or math.isnan(r[2 + f]) else min(sum(c < r[2 + f] for c in cuts[f]), len(cuts[f]) - 1)
             for f in range(len(FEATURES))] for r in rows]
    y = np.array([float(r[1]) for r in rows])
    w = np.where(y == 1, weight, 1.0)
    margin, trees = np.zeros(len(rows)), []

    def sums(some, g, h):
        return sum(int(g[i]) for i in some) / scale, sum(int(h[i]) for i in some) / scale

    def grow(some, g, h, depth):
        tg, th = sums(some, g, h)
        best = None
        for f in range(len(FEATURES)):
            for b in range(len(cuts[f])):
                for missing_left in (False, True):
                    left = [i for i in some if (missing_left if bins[i][f] is None else bins[i][f] <= b)]
                    right = [i for i in some if i not in set(left)]
                    (gl, hl), (gr, hr) = sums(left, g, h), sums(right, g, h)
                    if not left or not right or hl < o.least_child or hr < o.least_child:
                        continue
                    gain = gl * gl / (hl + o.l2) + gr * gr / (hr + o.l2) - tg * tg / (th + o.l2)
                    if gain > o.least_gain and (best is None or gain > best[3]):
                        best = (f, b, missing_left, gain, left, right)
        if best is None or depth == 0:
            return ("leaf", -o.step * tg / (th + o.l2))
        return (*best[:4], grow(best[4], g, h, depth - 1), grow(best[5], g, h, depth - 1))

    def value(t, i):
        while t[0] != "leaf":
            f, b, missing_left = t[:3]
            t = t[4] if (missing_left if bins[i][f] is None else bins[i][f] <= b) else t[5]
        return t[1]

    for number in range(o.trees):
        g, h = B.gradients(margin, y, w, scale)
        some = np.flatnonzero(B.sampled(keys, number, o)).tolist()
        trees.append(grow(some, g, h, o.depth))
        margin = margin + np.array([value(trees[-1], i) for i in range(len(rows))])
    return trees, margin


def nested(t, n=0):
    if t.feature[n] < 0:
        return ("leaf", t.value[n])
    return (t.feature[n], t.bin[n], t.missing_left[n], t.gain[n], nested(t, t.left[n]), nested(t, t.right[n]))


def same(a, b):
    if a[0] == "leaf" or b[0] == "leaf":
        return a[0] == b[0] == "leaf" and a[1] == pytest.approx(b[1], rel=1e-12, abs=1e-15)
    return a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9) and same(a[4], b[4]) and same(a[5], b[5])


@pytest.mark.parametrize("options", [dict(depth=3, rewrite_every=2), dict(depth=2, subsample=1.0, l2=0.5, least_child=3.0)])
def test_five_trees_equal_a_plain_search(spark, options):
    o = BoostOptions(trees=5, **options)
    df = table(spark)
    rows = sorted(map(tuple, df.collect()))
    keys = np.array([r.k for r in spark.createDataFrame([(r[0],) for r in rows], "id string")
                     .select(F.xxhash64("id").alias("k")).collect()], np.int64)
    model = B.fit(df, FEATURES, "y", "id", 1.5, o)
    cuts = [plain_cuts([r[2 + f] for r in rows], B.BINS) if f < 5 else [] for f in range(6)]
    trees, margin = plain_fit(rows, keys, cuts, 1.5, o)
    assert all(same(nested(t), p) for t, p in zip(model.trees, trees))
    used = {t.feature[n] for t in model.trees for n in range(len(t.feature))}
    assert {0, 1} <= used and any(any(t.missing_left) for t in model.trees)
    got = sorted((r.id, r.margin, r.probability, r.prediction) for r in model.score(df, ["id"]).collect())
    for (i, m, p, c), e in zip(got, margin):
        assert m == pytest.approx(e, abs=1e-12) and p == pytest.approx(1 / (1 + math.exp(-e))) and c == float(e >= 0)


def test_cuts_of_many_values(spark):
    """More values than bins: the quantile grid of the counts, also with a very frequent value."""
    values = [float(i * i % 7919) for i in range(3000)] + [5.0] * 2000 + [None, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    for bins in (255, 16):
        got = B.find_cuts(df, ["v"], bins)[0].tolist()
        assert got == plain_cuts(values, bins) and len(got) <= bins


def test_trees_do_not_depend_on_partitions_or_passes(spark, monkeypatch):
    o = BoostOptions(trees=4, depth=4)
    one = B.fit(table(spark, parts=1), FEATURES, "y", "id", 2.0, o)
    many = B.fit(table(spark, parts=7), FEATURES, "y", "id", 2.0, BoostOptions(trees=4, depth=4, rows_per_task=50, rewrite_every=1))
    monkeypatch.setattr(B, "HISTOGRAM_BYTES", 1)  # a pass per node
    monkeypatch.setattr(B, "BLOCK", 2)
    lots = B.fit(table(spark, parts=2), FEATURES, "y", "id", 2.0, o)
    shape = lambda m: [(r[:7], r[7:9], r[10:]) for r in (tuple(map(str, x)) for x in m.rows())]
    assert shape(one) == shape(many) == shape(lots)


def test_a_small_tree_takes_one_job(spark):
    """A node of few rows is grown to the end by one task, not by a job for each level."""
    sc = spark.sparkContext
    jobs = []
    for trees in (2, 8):
        sc.setJobGroup(f"boost-{trees}", "test")
        B.fit(table(spark), FEATURES, "y", "id", 2.0, BoostOptions(trees=trees, depth=4))
        sc.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"boost-{trees}")))
    assert jobs[1] - jobs[0] == 6


def test_subtrees_equal_passes_by_level(spark, monkeypatch):
    """Nodes that are grown in one task, by levels, or by levels at first: the same trees to the last bit, also with many tasks."""
    got = []
    for cells, task in ((1 << 21, 1 << 18), (0, 100), (600, 300), (300, 1 << 18)):
        monkeypatch.setattr(B, "SUBTREE_CELLS", cells)
        monkeypatch.setattr(B, "TASK_CELLS", task)
        got.append(B.fit(table(spark, n=400, seed=3), FEATURES, "y", "id", 1.5, BoostOptions(trees=5, depth=5, rewrite_every=2)))
    assert all(list(map(repr, m.rows())) == list(map(repr, got[0].rows())) for m in got[1:])
    assert max(len(t.feature) for t in got[0].trees) > 15


def test_a_wide_table_is_learned(spark):
    df = table(spark, n=3000, seed=4)
    model = B.fit(df, FEATURES, "y", "id", None, BoostOptions(trees=15, depth=4))
    held = table(spark, n=1000, seed=99)
    right = model.score(held, ["y"]).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert right > 0.8


def test_rows_without_label_and_single_class(spark):
    df = spark.createDataFrame([(str(i), None if i % 3 else 0, float(i)) for i in range(30)], "id string, y int, a double")
    model = B.fit(df, ["a"], "y", "id", None, BoostOptions(trees=2))
    assert [r.prediction for r in model.score(df, ["id"]).collect()] == [0.0] * 30
    empty = B.fit(df.where("false"), ["a"], "y", "id", None, BoostOptions(trees=2))
    assert [t.value for t in empty.trees] == [[0.0], [0.0]]


def test_saved_model_scores_alike(spark, tmp_path):
    df = table(spark).withColumnRenamed("id", "id_ga").withColumnRenamed("y", "uninstall")
    for engine in ("histogram", "spark"):
        model, metrics, feats = M.train(df.drop("none").na.fill(0.0), ModelConfig(max_iter=3, max_depth=3, engine=engine))
        path = str(tmp_path / engine)
        M.save_model(model, path)
        M.save_model(model, path)  # overwrites
        again = M.load_model(path)
        assert M.model_features(again) == feats and M.model_size(again) == (3, 3)
        a, b = (sorted(map(tuple, M.score(df.na.fill(0.0), m).collect())) for m in (model, again))
        assert a == b and len(a) == 240


def test_exact_split_takes_the_exact_share(spark):
    for n in (1, 2, 9, 10, 11, 997):
        df = spark.range(n).select(F.col("id").cast("string").alias("id_ga"))
        flag = M.exact_split_flag(df, bucket=3)
        assert df.filter(flag).count() == n - math.ceil(n * 0.3 - 1e-9)
        whole = {r.id_ga for r in df.filter(M.exact_split_flag(df)).collect()}
        assert whole == {r.id_ga for r in df.repartition(5).filter(flag).collect()}
    assert spark.range(0).select(F.col("id").cast("string").alias("id_ga")).filter(
        M.exact_split_flag(spark.range(0).select(F.col("id").cast("string").alias("id_ga")))).count() == 0


def test_exact_split_keeps_equal_ids_together(spark):
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50 + [(None,)], "id_ga string")
    got = {(r.id_ga, r.t) for r in df.withColumn("t", M.exact_split_flag(df)).collect()}
    assert len([x for x in got if x[0] in ("a", "b")]) == 2 and (None, False) in got
