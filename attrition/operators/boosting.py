"""Boosted trees by second-order boosting on histograms (ML4-ML6).

The upstream classifier (logistic loss, L2 term 1, smallest child weight 1, depth-wise growth, a learned direction for
missing values) as Spark jobs:

* Cuts. Per feature at most 255 values that bound its bins: those at which the cumulative count passes a multiple of n / 255, from
  value counts over range partitions. Up to 255 different values get a bin each. Exact, so independent of partitioning.
* Bins. The training rows are packed once into blocks, a byte per feature (255: missing), with label, weight and margin so
  far. After a tree the margin is brought up to date in new blocks; they are cached, and written to the shared checkpoint
  folder after every ``rewrite_every`` trees.
* Histograms. One pass per tree level: every partition sums gradients, hessians and rows per (node, feature, bin) and emits
  them as arrays, a row per node and block of features; a step by key adds them up and finds the block's best split.
  Gradients are rounded to fixed-point integers, so sums, splits and scores do not depend on the order of addition.
* Subtrees. A node whose rows times features are at most ``SUBTREE_CELLS`` gives its rows, not its histogram: one task gets
  them and grows what is left below the node. So a tree takes as many passes as it has levels with larger nodes, and one more.
* Missing values are tried on both sides of every cut; the better side is stored with the split.
* Of equal gains the first feature, the lowest cut, and missing values to the right are taken.

A row's share in a tree (subsampling) is a hash of its id and the tree. What reaches the driver: the cuts, one row per node
and block of features, and the trees; none of it grows with the rows. A task holds one block of rows, the rows of a
bounded node, and histograms of at most ``HISTOGRAM_BYTES``; levels with more nodes take several passes.
"""

from __future__ import annotations

import json
import math
import operator
import pickle
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators.features import qcol, value_ranks
from attrition.session import delete_path, ensure_checkpoint_dir, ship_package

BINS = 255
MISSING = 255
HISTOGRAM_BYTES = 1 << 28
#: features whose histograms travel in one row
BLOCK = 256
#: rows of a block, and of one sum of gradients in doubles
SLICE = 1 << 14
#: rows times features of a node whose subtree one task grows
SUBTREE_CELLS = 1 << 21
#: rows times features from which on a pass takes another task, up to the number of cores
TASK_CELLS = 1 << 18


@dataclass(frozen=True)
class BoostOptions:
    trees: int = 300
    depth: int = 6
    step: float = 0.2
    subsample: float = 0.8
    l2: float = 1.0
    #: least sum of hessians (times weights) in a child
    least_child: float = 1.0
    #: a split must gain more than this
    least_gain: float = 1e-6
    seed: int = 42
    rewrite_every: int = 20
    #: rows of a partition of the binned table
    rows_per_task: int = 250_000


@dataclass
class Tree:
    """Nodes in the order of growth; feature -1 marks a leaf. ``bin`` and ``threshold`` say the same: up to it, left."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def add(self, value: float, cover: float, rows: int) -> int:
        for name, x in (("feature", -1), ("bin", -1), ("threshold", math.nan), ("missing_left", False), ("left", -1),
                        ("right", -1), ("value", value), ("gain", 0.0), ("cover", cover), ("rows", rows)):
            getattr(self, name).append(x)
        return len(self.feature) - 1

    def arrays(self) -> dict[str, np.ndarray]:
        return {k: np.array(getattr(self, k)) for k in ("feature", "bin", "threshold", "missing_left", "left", "right", "value")}


def _walk(tree: dict[str, np.ndarray], x: np.ndarray, missing: np.ndarray, bound: str) -> np.ndarray:
    """The node of each row of x, following the splits on ``bound`` ('bin' or 'threshold')."""
    node, row = np.zeros(len(x), np.int64), np.arange(len(x))
    while True:
        f = tree["feature"][node]
        inner = f >= 0
        if not inner.any():
            return node
        at = np.maximum(f, 0)
        with np.errstate(invalid="ignore"):
            left = np.where(missing[row, at], tree["missing_left"][node], x[row, at] <= tree[bound][node])
        node = np.where(inner, np.where(left, tree["left"][node], tree["right"][node]), node)


# --- cuts and bins

def find_cuts(df: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Per feature the ascending upper bounds of its bins: values at which bins * (rows up to it) / n passes a whole number."""
    renamed = df.select(*[F.when(~F.isnan(qcol(c)), qcol(c)).alias(f"f{i}") for i, c in enumerate(features)])
    ranks = value_ranks(renamed, renamed.columns)
    crosses = F.floor(bins * F.col("r") / F.col("total")) > F.floor(bins * (F.col("r") - F.col("n")) / F.col("total"))
    out: list[list[float]] = [[] for _ in features]
    for r in ranks.where(crosses).select("c", "v").collect():  # at most bins rows a feature
        out[r["c"]].append(r["v"])
    return [np.sort(np.array(v, float)) for v in out]


def _bytes_matrix(column: pa.Array, k: int) -> np.ndarray:
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.empty(0, np.uint8)
    return data[column.offset * k:(column.offset + len(column)) * k].reshape(len(column), k)


def _bytes_column(x: np.ndarray) -> pa.Array:
    n, k = x.shape
    at = np.arange(n + 1, dtype=np.int32) * k
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


BINNED = "key long, y double, w double, margin double, bins binary"
_NAMES = ["key", "y", "w", "margin", "bins"]


def _binned(df: DataFrame, features: list[str], cuts: list[np.ndarray]) -> DataFrame:
    """``df`` has key, y, w and the features as doubles."""
    def scan(batches):
        for batch in batches:
            x = np.empty((batch.num_rows, len(features)), np.uint8)
            for i, bounds in enumerate(cuts):
                v = batch.column(3 + i).to_numpy(zero_copy_only=False).astype(float)
                none = np.isnan(v)
                x[:, i] = np.where(none, MISSING, np.minimum(np.searchsorted(bounds, v), max(len(bounds) - 1, 0)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array(np.zeros(batch.num_rows)),
                                              _bytes_column(x)], names=_NAMES)

    return df.select("key", "y", "w", *[qcol(c) for c in features]).mapInArrow(scan, BINNED)


def _blocks(table: DataFrame, k: int) -> RDD:
    """The binned rows as blocks: arrays of key, y, w, margin and bins."""
    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                block = (*(part.column(c).to_numpy() for c in range(4)), _bytes_matrix(part.column(4), k))
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary())], names=["block"])

    return table.mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r["block"]))


def _with_margin(blocks: RDD, tree: dict) -> RDD:
    """The blocks after one more tree."""
    def add(block):
        *head, margin, bins = block
        return *head, margin + tree["value"][_walk(tree, bins, bins == MISSING, "bin")], bins

    return blocks.map(add)


# --- one level

def sampled(key: np.ndarray, tree: int, o: BoostOptions) -> np.ndarray:
    """Whether a row takes part in a tree."""
    with np.errstate(over="ignore"):
        h = key.view(np.uint64) ^ (np.uint64(tree + 1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(o.seed))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return (h >> np.uint64(11)) < np.uint64(int(o.subsample * (1 << 53)))


def gradients(margin: np.ndarray, y: np.ndarray, w: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the weighted logistic loss, as whole multiples of 1 / scale."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint((p - y) * w * scale), np.rint(np.maximum(p * (1 - p), 1e-16) * w * scale)


def _spots(bins: np.ndarray, counts: list[int]) -> np.ndarray:
    """Where each value counts in a histogram: the bins of all features one after another, the last of each for missing values."""
    start = np.r_[0, np.cumsum(np.array(counts) + 1)]
    return np.add(np.minimum(bins, np.array(counts, np.uint8)), start[:-1], dtype=np.int32, casting="unsafe")  # no count is above MISSING


def _sums(spot: np.ndarray, g: np.ndarray, h: np.ndarray, size: int) -> np.ndarray:
    """Gradients, hessians and rows of every place of a histogram."""
    held = np.zeros((3, size), np.int64)
    lot = SLICE // 4  # small arrays, whose memory is used again
    for at in range(0, len(spot), lot):
        part = spot[at:at + lot].ravel().astype(np.intp)
        for i, weight in enumerate((g, h, None)):
            flat = None if weight is None else np.repeat(weight[at:at + lot], spot.shape[1])
            held[i] += np.rint(np.bincount(part, flat, size)).astype(np.int64)
    return held


def best_split(g: np.ndarray, h: np.ndarray, c: np.ndarray, cuts: list[int], scale: float, o: BoostOptions) -> dict:
    """The best split of a node by some features whose bins (the last of each: missing) lie one after another."""
    width = np.array(cuts) + 1
    start = np.r_[0, np.cumsum(width)]
    total = [int(x[:start[1]].sum()) for x in (g, h, c)]
    feature = np.repeat(np.arange(len(cuts)), cuts)
    at = np.arange(len(feature)) + feature  # the bins without the last of each feature
    lone = at - start[feature]
    gains, lefts = [], []
    for missing_left in (False, True):
        left = []
        for x in (g, h, c):
            run = np.r_[0, np.cumsum(x)]
            left.append(run[at + 1] - run[start[feature]] + (x[start[feature] + width[feature] - 1] if missing_left else 0))
        right = [t - x for t, x in zip(total, left)]
        gl, hl, gr, hr = (x / scale for x in (left[0], left[1], right[0], right[1]))
        gain = gl * gl / (hl + o.l2) + gr * gr / (hr + o.l2) - (total[0] / scale) * (total[0] / scale) / (total[1] / scale + o.l2)
        fine = (left[2] > 0) & (right[2] > 0) & (hl >= o.least_child) & (hr >= o.least_child) & (gain > o.least_gain)
        gains.append(np.where(fine, gain, -np.inf))
        lefts.append(left)
    out = {"gain": None, "feature": None, "bin": None, "missing_left": None, "gl": None, "hl": None, "cl": None,
           "g": total[0], "h": total[1], "c": total[2]}
    both = np.stack(gains, axis=1).ravel() if len(feature) else np.empty(0)  # by feature, cut, then side of the missing
    if len(both) and np.isfinite(top := both.max()):
        i, side = divmod(int(np.argmax(both)), 2)
        gl, hl, cl = (int(x[i]) for x in lefts[side])
        out |= {"gain": float(top), "feature": int(feature[i]), "bin": int(lone[i]), "missing_left": bool(side), "gl": gl, "hl": hl, "cl": cl}
    return out


def _best(found: list[dict]) -> dict:
    """The best of the splits found in a node's blocks of features."""
    return min(found, key=lambda s: (-(s["gain"] if s["gain"] is not None else -math.inf), s["feature"] or 0))


def _block_split(held: np.ndarray, counts: list[int], at: int, block: int, scale: float, o: BoostOptions) -> dict:
    """The best split over the features from ``at`` on, a block of them."""
    best = best_split(*held, counts[at:at + block], scale, o)
    return best if best["feature"] is None else best | {"feature": best["feature"] + at}


def _subtree(spot: np.ndarray, g: np.ndarray, h: np.ndarray, held: np.ndarray, depth: int, counts: list[int], block: int,
             scale: float, o: BoostOptions) -> tuple:
    """The best split of a node that ``spot`` has all rows of, and its children in the same form (None below ``depth`` levels)."""
    start = np.r_[0, np.cumsum(np.array(counts) + 1)]
    best = _best([_block_split(held[:, start[at]:start[min(at + block, len(counts))]], counts, at, block, scale, o)
                  for at in range(0, len(counts), block)])
    if best["gain"] is None or depth == 1:
        return best, None, None
    f = best["feature"]
    v = spot[:, f] - start[f]
    left = (v <= best["bin"]) | (best["missing_left"] & (v == counts[f]))
    sides = [np.flatnonzero(left), np.flatnonzero(~left)]
    few = int(len(sides[1]) < len(sides[0]))  # the smaller side is summed, the other one is what is left
    sums = _sums(spot[sides[few]], g[sides[few]], h[sides[few]], held.shape[1])
    both = (sums, held - sums) if few == 0 else (held - sums, sums)
    return best, *[_subtree(spot[i], g[i], h[i], x, depth - 1, counts, block, scale, o) for i, x in zip(sides, both)]


def _pass(rows: RDD, now: dict, number: int, wide: list[int], small: list[int], depth: int, counts: list[int],
          scale: float, o: BoostOptions) -> dict[int, tuple]:
    """The best splits of open nodes: of the wide ones from histograms, of the small ones with the ``depth`` levels below."""
    k, block, start = len(counts), BLOCK, np.r_[0, np.cumsum(np.array(counts) + 1)]
    size, lots = int(start[-1]), range(0, k, block)
    first = len(wide) * len(lots)  # keys: of each wide node one for each block of features, then the small nodes

    def scan(blocks):
        held, rest = np.zeros((3, len(wide) * size), np.int64), [[] for _ in small]
        place = np.full(max(len(now["feature"]), *wide, *small, 0) + 1, -1)
        place[wide + small] = np.arange(len(wide) + len(small))
        for key, y, w, margin, bins in blocks:
            at = place[_walk(now, bins, bins == MISSING, "bin")]
            use = np.flatnonzero((at >= 0) & sampled(key, number, o))
            at, bins = at[use], bins[use]
            g, h = gradients(margin[use], y[use], w[use], scale)
            if wide:
                mine = np.flatnonzero(at < len(wide))
                held += _sums(_spots(bins[mine], counts) + (at[mine, None] * size).astype(np.int32), g[mine], h[mine], held.shape[1])
            for i, some in enumerate(rest):
                mine = np.flatnonzero(at == len(wide) + i)
                if len(mine):
                    some.append((g[mine], h[mine], bins[mine]))
        for i in range(len(wide)):
            own = held[:, i * size:(i + 1) * size]
            if own[2].any():
                for b, lo in enumerate(lots):
                    yield i * len(lots) + b, own[:, start[lo]:start[min(lo + block, k)]].copy()
        for i, some in enumerate(rest):
            if some:
                yield first + i, some

    def find(item):
        key, value = item  # sums of histograms, or a list of rows
        if key < first:
            node, b = divmod(key, len(lots))
            return wide[node], (_block_split(value, counts, lots[b], block, scale, o), None, None)
        g, h, bins = (np.concatenate(x) for x in zip(*value))
        spot = _spots(bins, counts)
        return small[key - first], _subtree(spot, g, h, _sums(spot, g, h, size), depth, counts, block, scale, o)

    tasks = min(first + len(small), rows.getNumPartitions())
    found: dict[int, list] = {}
    for node, s in rows.mapPartitions(scan).reduceByKey(operator.add, tasks, int).map(find).collect():
        found.setdefault(node, []).append(s)
    return {n: s[0] if len(s) == 1 else (_best([x[0] for x in s]), None, None) for n, s in found.items()}


def _grow(rows: RDD, n: int, number: int, cuts: list[np.ndarray], scale: float, o: BoostOptions) -> Tree:
    """One tree, a pass over the ``n`` rows for every level with wide nodes (or more, if the histograms of a level are too many)."""
    counts = [len(c) for c in cuts]
    width = 24 * (sum(counts) + len(counts))
    lot = max(1, HISTOGRAM_BYTES // width)
    # a subtree holds two histograms a level
    most = SUBTREE_CELLS // len(counts) if 2 * o.depth * width <= HISTOGRAM_BYTES else -1
    tree = Tree()
    leaf = lambda g, h: -o.step * (g / scale) / (h / scale + o.l2)
    open_, found = [0], {}
    for level in range(o.depth):
        now = tree.arrays() if tree.feature else {**Tree().arrays(), "feature": np.array([-1])}
        todo = [i for i in open_ if i not in found]
        small = [i for i in todo if (tree.rows[i] if tree.feature else n) <= most]
        wide = [i for i in todo if i not in set(small)]
        for at in range(0, max(len(wide), min(len(small), 1)), lot):
            found |= _pass(rows, now, number, wide[at:at + lot], small if at == 0 else [], o.depth - level, counts, scale, o)
        split, open_ = [i for i in open_ if i in found], []
        for i in split:
            s, *below = found.pop(i)
            if not tree.feature:
                tree.add(leaf(s["g"], s["h"]), s["h"] / scale, s["c"])
            if s["gain"] is None:
                continue
            tree.feature[i], tree.bin[i], tree.threshold[i] = s["feature"], s["bin"], float(cuts[s["feature"]][s["bin"]])
            tree.missing_left[i], tree.gain[i] = s["missing_left"], s["gain"]
            tree.left[i] = tree.add(leaf(s["gl"], s["hl"]), s["hl"] / scale, s["cl"])
            tree.right[i] = tree.add(leaf(s["g"] - s["gl"], s["h"] - s["hl"]), (s["h"] - s["hl"]) / scale, s["c"] - s["cl"])
            open_ += [tree.left[i], tree.right[i]]
            found |= {child: x for child, x in zip(open_[-2:], below) if x is not None}
        if not open_:
            break
    if not tree.feature:  # no row took part
        tree.add(0.0, 0.0, 0)
    return tree


# --- model

@dataclass
class BoostedTrees:
    """The fitted trees, with the features they were fitted on."""

    features: list[str]
    trees: list[Tree]
    options: BoostOptions

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep``, ``margin``, ``probability`` and ``prediction`` (1 from a half on); ``df`` has the features as doubles."""
        ship_package(df.sparkSession)
        trees, k = [t.arrays() for t in self.trees], len(self.features)
        kept = df.select(*[qcol(c) for c in keep], *[qcol(c).alias(f"_f{i}") for i, c in enumerate(self.features)])
        names = [*keep, "margin", "probability", "prediction"]

        def scan(batches):
            for batch in batches:
                first = batch.num_columns - k
                x = (np.stack([batch.column(first + i).to_numpy(zero_copy_only=False).astype(float) for i in range(k)], axis=1)
                     if k else np.empty((batch.num_rows, 0)))
                none = np.isnan(x)
                margin = np.zeros(batch.num_rows)
                for t in trees:
                    margin += t["value"][_walk(t, x, none, "threshold")] if k else t["value"][0]
                p = 1 / (1 + np.exp(-margin))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(first)), pa.array(margin), pa.array(p),
                                                  pa.array((p >= 0.5).astype(float))], names=names)

        fields = [f"{_sql(f.name)} {f.dataType.simpleString()}" for f in kept.schema.fields[:len(keep)]]
        return kept.mapInArrow(scan, ", ".join([*fields, "margin double", "probability double", "prediction double"]))

    def rows(self) -> list[tuple]:
        return [(i, n, t.feature[n], self.features[t.feature[n]] if t.feature[n] >= 0 else None, t.bin[n], t.threshold[n],
                 t.missing_left[n], t.left[n], t.right[n], t.value[n], t.gain[n], t.cover[n], t.rows[n])
                for i, t in enumerate(self.trees) for n in range(len(t.feature))]

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node."""
        return spark.createDataFrame(self.rows(), NODES)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        about = json.dumps({"features": self.features, "options": asdict(self.options), "trees": len(self.trees)})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> BoostedTrees:
        about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        return BoostedTrees.of_rows(spark.read.parquet(f"{path}/trees").collect(), about["features"], BoostOptions(**about["options"]))

    @staticmethod
    def of_rows(rows: list, features: list[str], o: BoostOptions = BoostOptions()) -> BoostedTrees:
        trees: dict[int, Tree] = {}
        for r in sorted(rows, key=lambda r: (r["tree"], r["node"])):
            t = trees.setdefault(r["tree"], Tree())
            for c in ("feature", "bin", "threshold", "missing_left", "left", "right", "value", "gain", "cover", "rows"):
                getattr(t, c).append(r[c])
        return BoostedTrees(features, [trees[i] for i in sorted(trees)], o)


NODES = ("tree int, node int, feature int, name string, bin int, threshold double, missing_left boolean, left int, right int, "
         "value double, gain double, cover double, rows long")


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_saved(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/about")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def scale_for(rows: int, weight: float) -> float:
    """The power of two that gradients are multiplied by: sums of all rows fit 62 bits, those of a slice of rows a double."""
    most = max(1.0, weight)
    return 2.0 ** min(32, math.floor(62 - math.log2(max(rows, 1) * most)), math.floor(52 - math.log2((1 << 14) * most)))


def fit(df: DataFrame, features: list[str], label: str, identity: str, weight: float | None = None,
        o: BoostOptions = BoostOptions()) -> BoostedTrees:
    """Boosted trees for a 0/1 label; ``weight`` is that of the positive rows. Features are doubles, null or NaN where missing."""
    spark = df.sparkSession
    ship_package(spark)
    positive = 1.0 if weight is None else float(weight)
    y = qcol(label).cast("double")
    rows = df.where(y.isNotNull()).select(
        F.xxhash64(qcol(identity).cast("string")).alias("key"), y.alias("y"),
        F.when(y == 1, positive).otherwise(1.0).alias("w"), *[qcol(c).cast("double").alias(c) for c in features])
    n = rows.count()
    cuts = find_cuts(rows, features)
    ensure_checkpoint_dir(spark)
    # a task for each lot of rows; of fewer rows, each core has some
    k = len(features)
    tasks = max(1, -(-n // o.rows_per_task), min(spark.sparkContext.defaultParallelism, n * k // TASK_CELLS))
    blocks = _blocks(_binned(rows, features, cuts).repartition(tasks, "key"), k)
    scale, grown, held = scale_for(n, positive), [], []

    def drop(old: list[RDD]) -> None:
        for x in old:
            x.unpersist()
            if file := x.getCheckpointFile():
                delete_path(spark, file)

    try:
        for number in range(o.trees):
            if number:
                blocks = _with_margin(blocks, grown[-1].arrays())
            held.append(blocks.persist(StorageLevel.MEMORY_AND_DISK))
            if number % o.rewrite_every == 0:
                blocks.checkpoint()
                blocks.count()
                drop(held[:-1])
                held = [blocks]
            grown.append(_grow(blocks, n, number, cuts, scale, o))
            for old in held[:-1]:  # the first stays in the checkpoint folder
                old.unpersist()
            held = [*held[:1], *held[1:][-1:]]
    finally:
        drop(held)
    return BoostedTrees(list(features), grown, replace(o))
