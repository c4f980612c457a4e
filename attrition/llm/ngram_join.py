"""Similarity self-join of documents on word n-grams by Jaccard, with vertical partitioning.

A document is the set of its distinct n-grams (64-bit hashes); documents with the same set are one class. All n-grams
have one global order: rare ones by hash, then the frequent ones (in at least ``frequent`` of the documents, found by
counting locally frequent ones over all documents) from the least to the most frequent. Any order gives the same
links; this one keeps shared passages out of the search for candidates. The order is cut into ``fragments`` vertical
fragments at fixed hashes, with the frequent n-grams as one more.

1. Classes that can link at all. N-grams are counted, range of hashes by range: one that a single class has is shared
   with nobody. The number of these lone n-grams bounds the overlap of a class with any other; a class whose bound is
   below the threshold links with nothing and is not looked at again. This is done over the lowest quarter of hashes
   for all classes, then over all hashes for those that are left.
2. Candidates. Lone n-grams come first in the global order, which keeps them out of the search. The first part of
   each set, its prefix, must hold an n-gram of every set it can link with, so candidate pairs come from prefixes only.
   A pair shares at most the n-grams that are lone in neither, and no more in any of 64 strips of the hash space than
   the smaller of the two has there: these counts must be able to reach the threshold.
3. Overlaps. The overlap of a candidate pair is counted fragment by fragment and summed per pair. After the first
   fragment, pairs that cannot reach the threshold any more, even if all the rest were shared, are dropped.

All three bounds are exact: no link is lost.

Links serve to find components, so pairs inside one component need not all be compared. The classes sharing a prefix
n-gram are first compared with one leader, the one with the fewest lone n-grams, then linked classes are merged, and only n-grams whose classes are still in
different components go on: small ones with all their remaining pairs, larger ones with more leaders in every round.
A pair is left uncompared only if it is in one component already. Components are found by passing on the smallest
label, round by round, in tables.

Skew: equal sets are one class, whatever their number; an n-gram that several classes of a task share leaves that task
once; leaders are found by pre-aggregation; the classes of an n-gram that many have are dealt over salts, each of which gets the
leaders; the other tables joined on hot keys are written first, so Spark can split them. Slices and ranges are cut by the
number of n-grams they hold, not by documents.

Rows are told apart by a hash of id and text, so an id is only a label: rows that share one are documents of their own, and
rows without one take part like any other.

Defined results: a text with fewer than n words is one n-gram (all its words); without words it links with nothing
and is a component of its own; a component is named by the smallest id in it, or has no name if no row of it has an id.
``keep_one`` keeps one row of a component, that with the smallest id (rows without an id come last) and, of several, the
smallest hash, and one of equal rows; rows without words all stay. Extra columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import keyed_subset, ship_package, written


@dataclass(frozen=True)
class JoinOptions:
    n: int = 5
    #: link when 100 * intersection >= percent * union
    percent: int = 80
    fragments: int = 8
    frequent: float = 1 / 2000
    #: tokens with at most so many classes left compare all their pairs
    small: int = 64


class _WordHashes(dict):
    """Word -> 64-bit hash; forgets everything now and then, to bound its memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
            0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def ngram_set(text: str | None, n: int, hashes: dict) -> np.ndarray:
    """The sorted distinct n-gram hashes of a text; only A-Z are lower-cased, words end at ASCII white space."""
    ws = (text or "").encode("utf-8").lower().split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.array(list(map(hashes.__getitem__, ws)), dtype=np.uint64)
    width = min(n, len(h))
    with np.errstate(over="ignore"):
        total = np.full(len(h) - width + 1, width, np.uint64)
        for i in range(width):
            total += h[i:len(h) - width + 1 + i] * np.uint64(_FACTORS[i % 8] + 2 * (i // 8))
            if i % 8 == 7:
                total = _mixed(total)
        return np.unique(_mixed(total))


def set_class(grams: np.ndarray) -> int | None:
    """A 64-bit name of the set; none for the empty set."""
    if not len(grams):
        return None
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


#: A slice of documents: at most so many, and no further text once they have so many characters (about 2 million words).
SLICE_ROWS, SLICE_CHARS = 5000, 12_000_000


def _slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_CHARS) -> Iterator[list[list]]:
    """The columns of a slice as lists; the last column is the text."""
    for batch in batches:
        held, chars, first = [], 0, 0
        for at, text in enumerate(batch.column(batch.num_columns - 1)):
            held.append(text.as_py())
            chars += len(held[-1] or "")
            if len(held) >= rows or chars >= size or at == batch.num_rows - 1:
                part = batch.slice(first, len(held))
                yield [*(part.column(i).to_pylist() for i in range(batch.num_columns - 1)), held]
                held, chars, first = [], 0, at + 1


ROW = "_ngram_row"


def _rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): the row's hash tells rows apart, on every reading alike."""
    return docs.select(_row_hash().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _row_hash() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), F.col("text").cast("string"), F.col("text").isNull())


#: The n-grams counted to find the classes that can link: hashes below this, a quarter of all.
COUNTED = 1 << 62
SCAN = ("row long, doc_id long, cls long, size long, gram long, docs long, range int, hashes array<long>, owners array<short>, "
        "classes array<long>")


def _scan(docs: DataFrame, ranges: int, o: JoinOptions) -> DataFrame:
    """One pass over all texts. Three kinds of rows: per document (row, doc_id, cls, size); per slice its locally frequent
    n-grams (gram, docs); per slice and range of hashes the counted n-grams (hashes, owners, classes)."""
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int16()), pa.list_(pa.int64())]
    names = ["row", "doc_id", "cls", "size", "gram", "docs", "range", "hashes", "owners", "classes"]
    edges = np.array([COUNTED * i // ranges for i in range(1, ranges)], dtype=np.uint64)

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k)
                                           for c, k in zip(names, kinds)], names=names)

    def scan(batches):
        hashes = _WordHashes()
        for keys, ids, texts in _slices(batches):
            sets = [ngram_set(text, o.n, hashes) for text in texts]
            classes = [set_class(g) for g in sets]
            yield rows(row=keys, doc_id=ids, cls=classes, size=[len(g) for g in sets])
            found, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = counts >= max(2, o.frequent * len(ids))
            yield rows(gram=found[often].view(np.int64), docs=counts[often])
            first = {c: i for i, c in enumerate(classes) if c is not None}
            if first:
                yield _counted(rows, list(first), [sets[i] for i in first.values()], edges)

    return _rows(docs).mapInArrow(scan, SCAN)


def _counted(rows, classes: list[int], sets: list[np.ndarray], edges: np.ndarray, below: int = COUNTED) -> pa.RecordBatch:
    """The counted n-grams of a slice, by range: each with the class that has it, or -1 where several have it."""
    parts = [g if below >> 64 else g[:np.searchsorted(g, np.uint64(below))] for g in sets]
    grams = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    first = np.r_[True, grams[1:] != grams[:-1]] if len(grams) else np.zeros(0, bool)
    alone = first & np.r_[first[1:], True] if len(grams) else first
    owner = np.where(alone, owner, -1)[first]
    grams = grams[first]
    out: dict[str, list] = {"range": [], "hashes": [], "owners": [], "classes": []}
    names = np.array(classes, dtype=np.int64)
    bounds = [0, *np.searchsorted(grams, edges), len(grams)]
    for r, (start, end) in enumerate(zip(bounds, bounds[1:])):
        if end > start:
            used, local = np.unique(owner[start:end], return_inverse=True)
            shift = int(used[0] == -1)  # -1 sorts first and stays -1
            out["range"].append(r)
            out["hashes"].append(grams[start:end].view(np.int64))
            out["owners"].append((local - shift).astype(np.int16))
            out["classes"].append(names[used[shift:]])
    return rows(**out)


def _lone(counted: DataFrame) -> DataFrame:
    """(cls, lone): the counted n-grams that no other class has, range by range."""
    def find(table: pa.Table) -> pa.Table:
        hashes, owners, classes = (table.column(c).combine_chunks() for c in ("hashes", "owners", "classes"))
        gram, own = hashes.flatten().to_numpy(), owners.flatten().to_numpy().astype(np.int64)
        held = [np.diff(x.offsets.to_numpy()) for x in (hashes, classes)]
        names = np.append(classes.flatten().to_numpy(), 0)
        several = own < 0
        owner = names[np.where(several, -1, own + np.repeat(np.cumsum(held[1]) - held[1], held[0]))]
        # met in several classes of a slice: entered under two names, so that it counts as shared
        gram, owner = np.append(gram, gram[several]), np.append(owner, np.ones(several.sum(), np.int64))
        order = np.lexsort((owner, gram))
        gram, owner = gram[order], owner[order]
        same = gram[1:] == gram[:-1]
        group = np.cumsum(np.r_[True, ~same]) - 1
        shared = np.zeros(group[-1] + 1, bool)
        shared[group[1:][same & (owner[1:] != owner[:-1])]] = True
        lone = np.flatnonzero(np.r_[True, ~same])[~shared]
        lone = lone[np.argsort(owner[lone], kind="stable")]
        cls, start = np.unique(owner[lone], return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(lone)), pa.int32()), pa.array(gram[lone], pa.int64()))
        return pa.table({"cls": pa.array(cls, pa.int64()), "lone": lists})

    return (counted.select("range", "hashes", "owners", "classes")
            .groupBy("range").applyInArrow(find, "cls long, lone array<long>"))


def _ranges(grams: int) -> int:
    """How many ranges of hashes, so that each has about a million of the n-grams counted."""
    return min(max(64, grams // 1_000_000), 1 << 16)


def _recount(sets: DataFrame, grams: int) -> DataFrame:
    """All n-grams of the written sets (``grams`` of them) as counted rows."""
    ranges = _ranges(grams)
    edges = np.array([(1 << 64) * i // ranges for i in range(1, ranges)], dtype=np.uint64)
    kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int16()), pa.list_(pa.int64())]
    names = ["range", "hashes", "owners", "classes"]

    def rows(**columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[c], k) for c, k in zip(names, kinds)], names=names)

    def scan(batches):
        for batch in batches:
            classes, held, size = [], [], 0
            for at, (cls, x) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                classes.append(cls)
                held.append(np.sort(x.values.flatten().to_numpy().view(np.uint64)))
                size += len(held[-1])
                if len(held) >= SLICE_ROWS or size >= SLICE_CHARS // 6 or at == batch.num_rows - 1:
                    yield _counted(rows, classes, held, edges, 1 << 64)
                    classes, held, size = [], [], 0

    return sets.select("cls", "fragments").mapInArrow(scan, "range int, hashes array<long>, owners array<short>, classes array<long>")


def _order(found: DataFrame, docs: int, o: JoinOptions):
    """The frequent n-grams by hash, and the place of each in the global order, on every worker.

    Each has at least ``frequent * docs / 2`` of the n-grams counted, so there are at most
    2 / frequent * (n-grams per document) of them, however many documents there are.
    """
    rows = (found.where("gram is not null").groupBy("gram").agg(F.sum("docs").alias("docs"))
            .where(F.col("docs") >= max(2, o.frequent * docs / 2)).toPandas())
    rows = rows.sort_values(["docs", "gram"])
    gram, place = rows["gram"].to_numpy(np.int64).view(np.uint64), np.arange(len(rows))
    by_hash = np.argsort(gram)
    return found.sparkSession.sparkContext.broadcast((gram[by_hash], place[by_hash]))


def _in_order(grams: np.ndarray, order) -> tuple[np.ndarray, int]:
    """The set in the global order, and how many of it are not frequent."""
    often, place = order
    if not len(often) or not len(grams):
        return grams, len(grams)
    at = np.minimum(np.searchsorted(often, grams), len(often) - 1)
    is_often = often[at] == grams
    last = grams[is_often][np.argsort(place[at[is_often]], kind="stable")]
    return np.concatenate([grams[~is_often], last]), int((~is_often).sum())


def _ordered_sets(texts: DataFrame, order, o: JoinOptions) -> DataFrame:
    """One row per class of the texts: its size, and its set in the global order cut into fragments."""
    cuts = np.array([(1 << 64) * i // o.fragments for i in range(1, o.fragments)], dtype=np.uint64)

    def scan(batches):
        hashes = _WordHashes()
        for (some,) in _slices(batches, 500, SLICE_CHARS // 4):
            classes, sizes, cut = [], [], []
            for text in some:
                g, rare = _in_order(ngram_set(text, o.n, hashes), order.value)
                classes.append(set_class(np.sort(g)))
                sizes.append(len(g))
                # the rare part is cut at fixed hashes, the frequent part is the last fragment
                cut.append([x.view(np.int64) for x in np.split(g, [*np.searchsorted(g[:rare], cuts), rare])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(cut, pa.list_(pa.list_(pa.int64())))],
                names=["cls", "size", "fragments"])

    return texts.select("text").mapInArrow(scan, "cls long, size long, fragments array<array<long>>").dropDuplicates(["cls"])


STRIPS = 64


def _summaries(sets: DataFrame, o: JoinOptions) -> DataFrame:
    """The classes that can still link: their number of lone n-grams, the rest of the prefix, and the counts by strip."""
    def scan(batches):
        for batch in batches:
            rows = []
            for cls, size, fragments, alone in zip(*(batch.column(c) for c in ("cls", "size", "fragments", "alone"))):
                grams = fragments.values.flatten().to_numpy()
                rest = grams[~np.isin(grams, alone.values.to_numpy())] if alone.is_valid else grams
                lone, size = len(grams) - len(rest), size.as_py()
                spare = size - -(-o.percent * size // 100)
                if lone <= spare:  # the lone n-grams take the first places of the prefix
                    strips = np.bincount(rest & (STRIPS - 1), minlength=STRIPS)
                    strips = strips.astype(np.int8) if strips.max() < 128 else None  # very long texts do without
                    rows.append((cls.as_py(), size, lone, rest[:spare + 1 - lone], strips, fragments))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int8()), pa.list_(pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["cls", "size", "lone", "prefix", "strips", "fragments"])

    return sets.select("cls", "size", "fragments", "alone").mapInArrow(
        scan, "cls long, size long, lone int, prefix array<long>, strips array<tinyint>, fragments array<array<long>>")


def _linked(pairs: DataFrame, segments: DataFrame, o: JoinOptions) -> DataFrame:
    """The pairs (a, b, with their sizes) that reach the threshold."""
    def partial(some: DataFrame, which) -> DataFrame:
        """Overlap counted in each of the fragments, and how much of either set those hold, summed per pair."""
        mine = segments.where(which)
        left = mine.select(F.col("cls").alias("a"), "fragment", F.col("segment").alias("left"))
        right = mine.select(F.col("cls").alias("b"), "fragment", F.col("segment").alias("right"))
        both = some.join(left, "a").join(right, ["b", "fragment"])
        return both.groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("left", "right"))).alias("shared"))

    sizes = segments.where("fragment = 0").select("cls", F.size("segment").cast("long").alias("held"))
    least = lambda x: F.expr(f"100 * ({x}) >= {o.percent} * (size_a + size_b - ({x}))")
    first = written(partial(pairs, F.col("fragment") == 0), "first-overlaps")
    a, b = (sizes.select(F.col("cls").alias(k), F.col("held").alias(f"held_{k}")) for k in "ab")
    open_ = (pairs.join(first, ["a", "b"], "left").join(a, "a", "left").join(b, "b", "left")
             .na.fill(0, ["shared", "held_a", "held_b"])
             .where(least("shared + least(size_a - held_a, size_b - held_b)")))
    open_ = written(open_.select("a", "b", "size_a", "size_b", F.col("shared").alias("before")), "open-pairs")
    rest = partial(open_.select("a", "b"), F.col("fragment") > 0)
    return (open_.join(rest, ["a", "b"], "left").withColumn("all", F.col("before") + F.coalesce("shared", F.lit(0)))
            .where(least("all")).select("a", "b"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) by passing on the smallest label over links (a, b) until nothing changes."""
    labels = nodes.select("node", F.col("node").alias("component"))
    edges = links
    while True:
        edges = written(edges.where("a <> b").distinct(), "edges")
        if edges.isEmpty():
            return labels
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("old"), F.least("a", "least").alias("new"))
        to = written(to, "labels")
        # follow the new labels a few steps at once, then rename the edges and the nodes
        for _ in range(2):
            on = to.select(F.col("old").alias("new"), F.col("new").alias("next"))
            to = to.join(on, "new", "left").select("old", F.coalesce("next", "new").alias("new"))
        to = written(to, "labels")
        labels = written(labels.join(to, F.col("component") == F.col("old"), "left")
                         .select("node", F.coalesce("new", "component").alias("component")), "components")
        for end in "ab":
            moved = to.select(F.col("old").alias(end), "new")
            edges = edges.join(moved, end, "left").withColumn(end, F.coalesce("new", end)).drop("new")


def _scanned(docs: DataFrame, o: JoinOptions) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, cls, size) of every document, and (cls, component, component_id) of every class."""
    ship_package(docs.sparkSession)
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("text").cast("string"))).alias("bytes")).first()
    # a word and its space are about six bytes; a quarter of the n-grams is counted
    found = written(_scan(docs, _ranges((total["bytes"] or 0) // 24), o), "sets")
    sets = found.where("size IS NOT NULL").select("row", "doc_id", "cls", "size")
    return sets, written(class_labels(docs, found, sets, _order(found, total["n"], o), o), "class-labels")


def linked_components(docs: DataFrame, o: JoinOptions = JoinOptions()) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    sets, label = _scanned(docs, o)
    return (sets.withColumnRenamed("cls", "own").join(label, F.col("own") == F.col("cls"), "left")
            .select("doc_id", F.col("size").alias("n_shingles"),
                    F.when(F.col("own").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def class_labels(docs: DataFrame, found: DataFrame, sets: DataFrame, order, o: JoinOptions) -> DataFrame:
    """(cls, component, component_id): the component of each class, and the smallest document id in it."""
    lone = (_lone(found.where("range IS NOT NULL")).groupBy("cls").agg(F.sum(F.size("lone")).alias("lone")))
    firsts = (sets.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.first("size").alias("size"))
              .join(lone, "cls", "left"))
    # a link needs at least percent/100 of the set shared
    spare = F.col("size") - F.ceil(F.col("size") * o.percent / 100)
    firsts = written(firsts.withColumn("can_link", F.coalesce("lone", F.lit(0)) <= spare), "classes")
    wanted = firsts.where("can_link").select("row").distinct()
    # one row of each class that can link, read again for its whole set
    chosen = _ordered_sets(keyed_subset(_rows(docs), wanted, "row"), order, o)
    chosen = written(chosen.join(firsts.where("can_link").select("cls"), "cls", "left_semi"), "whole-sets")
    held = chosen.agg(F.sum("size").alias("n")).first()["n"] or 0
    lone = _lone(_recount(chosen, held)).groupBy("cls").agg(F.flatten(F.collect_list("lone")).alias("alone"))
    chosen = written(_summaries(chosen.join(written(lone, "lone"), "cls", "left"), o), "ordered-sets")
    segments = chosen.select("cls", F.posexplode("fragments").alias("fragment", "segment")).where(F.size("segment") > 0)
    grams = chosen.select(F.explode("prefix").alias("gram"), "cls", "size", "lone", "strips")
    shared = written(grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
                     .select("gram", F.ceil(F.col("n") / SALTED).cast("int").alias("salts")), "shared-grams")
    buckets = written(grams.join(shared, "gram").withColumn("component", F.col("cls")), "buckets")
    nodes = written(buckets.select(F.col("cls").alias("node")).distinct(), "nodes")
    label = nodes.select("node", F.col("node").alias("component"))
    leaders, least = 1, 2
    while True:
        lead = written(_leaders(buckets, leaders), "leaders")
        pairs = written(_candidates(buckets, lead, o, least), "pairs")
        links = written(_linked(pairs, segments, o), "links")
        step = components(label.select(F.col("component").alias("node")).distinct(), _renamed(links, label))
        step = step.select(F.col("node").alias("component"), F.col("component").alias("now"))
        label = written(label.join(step, "component").select("node", F.col("now").alias("component")), "label")
        buckets = _still_open(buckets, lead, label, o, least)
        if buckets.isEmpty():
            break
        leaders, least = min(leaders * 16, 512), o.small if leaders == 1 else 8 * o.small
    named = firsts.join(label, F.col("cls") == F.col("node"), "left").select(
        "cls", "least", F.coalesce("component", "cls").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "component").select("cls", "component", "component_id")


def _renamed(links: DataFrame, label: DataFrame) -> DataFrame:
    for end in "ab":
        own = label.select(F.col("node").alias(end), "component")
        links = links.join(own, end).drop(end).withColumnRenamed("component", end)
    return links.select("a", "b")


#: Classes with the same n-gram that one salt gets, on average.
SALTED = 256


def _leaders(buckets: DataFrame, leaders: int) -> DataFrame:
    """Up to ``leaders`` classes of each n-gram, of each lot the one with the fewest lone n-grams. Pre-aggregated."""
    lead = F.min(F.struct("lone", "cls", "size", "component", "strips"))
    if leaders == 1:
        return buckets.groupBy("gram").agg(F.count("*").alias("n"), F.min("size").alias("low"), F.max("salts").alias("salts"),
                                           F.array(lead).alias("lead"))
    lot = F.pmod(F.xxhash64("cls"), F.lit(leaders)).alias("lot")
    lots = buckets.groupBy("gram", lot).agg(F.count("*").alias("n"), F.min("size").alias("low"), F.max("salts").alias("salts"),
                                            lead.alias("lead"))
    return lots.groupBy("gram").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("salts").alias("salts"),
                                    F.collect_list("lead").alias("lead"))


def _dealt(buckets: DataFrame) -> DataFrame:
    """The classes of each n-gram dealt over its salts."""
    return buckets.withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("salts")).cast("int"))


def _salted(grams: DataFrame, salts: str) -> DataFrame:
    """A row per n-gram for each of its salts."""
    return grams.withColumn("salt2", F.explode(F.sequence(F.lit(0), F.col(salts) - 1)))


def _candidates(buckets: DataFrame, lead: DataFrame, o: JoinOptions, least: int) -> DataFrame:
    """Distinct pairs (a < b) to compare in this round: in different components, and able to reach the threshold."""
    reach = lambda shared: f"{100 + o.percent} * {shared} >= {o.percent} * (size + size2)"
    by_strip = "aggregate(zip_with(strips, strips2, (x, y) -> least(x, y)), 0, (a, x) -> a + x)"
    able = F.expr(f"component <> component2 AND {reach('least(size - lone, size2 - lone2)')} "
                  f"AND coalesce({reach(by_strip)}, true)")
    second = [F.col(f"x.{c}").alias(f"{c}2") for c in ("cls", "size", "lone", "component", "strips")]
    # the classes of an n-gram are dealt over its salts, its leaders go to each of them
    star = (_salted(lead.where(F.col("n") > least), "salts")
            .select(F.col("gram").alias("gram2"), "salt2", F.explode("lead").alias("x")).select("gram2", "salt2", *second))
    dealt = _dealt(buckets)
    few = lead.where(F.col("n") <= least).select(F.col("gram").alias("gram2"), F.col("salts").alias("salts2"))
    same, same_salt = F.col("gram") == F.col("gram2"), F.col("salt") == F.col("salt2")
    both = [c for k in ("cls", "size") for c in (k, f"{k}2")]

    def among(rows: DataFrame) -> DataFrame:
        """All pairs of the classes of n-grams that few have."""
        other = rows.select(F.col("gram").alias("gram2"), F.struct("cls", "size", "lone", "component", "strips").alias("x")).select("gram2", *second)
        return rows.join(other, same & able & F.expr("cls < cls2")).select(*both)

    # an n-gram that many classes had at first is looked up by salt, so that they do not meet in one task to be dropped there
    usual = buckets.where("salts = 1").join(few, same, "left_semi")
    many = dealt.where("salts > 1").join(_salted(few.where("salts2 > 1"), "salts2"), same & same_salt, "left_semi")
    pairs = dealt.join(star, same & same_salt & able).select(*both).unionByName(among(usual)).unionByName(among(many.drop("salt")))
    ordered = F.col("cls") < F.col("cls2")
    swap = lambda x, y: F.when(ordered, F.col(x)).otherwise(F.col(y))
    return pairs.select(swap("cls", "cls2").alias("a"), swap("cls2", "cls").alias("b"),
                        swap("size", "size2").alias("size_a"), swap("size2", "size").alias("size_b")).distinct()


def _still_open(buckets: DataFrame, lead: DataFrame, label: DataFrame, o: JoinOptions, least: int) -> DataFrame:
    """What is left to compare: n-grams whose classes are in different components, without what was just compared,
    and without classes that could not reach the threshold with a set of any size in question."""
    open_ = lead.where(F.col("n") > least)
    used = open_.select("gram", F.explode("lead").alias("x")).select("gram", F.col("x.cls").alias("cls"))
    able = F.expr(f"{100 + o.percent} * (size - lone) >= {o.percent} * (size + greatest(low, size - lone))")
    lows = _salted(open_.select(F.col("gram").alias("gram2"), "salts", "low"), "salts").drop("salts")
    left = (_dealt(buckets.drop("component")).join(lows, (F.col("gram") == F.col("gram2")) & (F.col("salt") == F.col("salt2")))
            .where(able).join(used, ["gram", "cls"], "left_anti"))
    left = left.join(label, F.col("cls") == F.col("node")).select("gram", "cls", "size", "lone", "strips", "salts", "component")
    left = written(left, "left")
    mixed = left.groupBy("gram").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return written(left.join(written(mixed.select("gram"), "mixed"), "gram", "left_semi"), "buckets")


def keep_one(docs: DataFrame, o: JoinOptions = JoinOptions()) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest (id, hash)."""
    sets, label = _scanned(docs, o)
    rows = (sets.where("cls IS NOT NULL").groupBy("row", "doc_id", "cls").agg(F.count(F.lit(1)).alias("times"))
            .join(label.select("cls", "component"), "cls"))
    rows = written(rows.withColumn("rank", F.struct(F.col("doc_id").isNull(), "doc_id", "row")), "labelled-rows")
    stays = rows.groupBy("component").agg(F.min("rank").alias("first"))
    rows = rows.join(stays, "component").withColumn("stays", F.col("row") == F.col("first.row"))
    dropped = written(rows.where("NOT stays").select(F.col("row").alias("dropped_row")).distinct(), "near-duplicates")
    repeated = written(rows.where("stays AND times > 1").select(F.col("row").alias("repeated_row")).distinct(), "repeated-rows")
    left = docs.withColumn(ROW, _row_hash()).join(dropped, F.col(ROW) == F.col("dropped_row"), "left_anti")
    if not repeated.isEmpty():  # equal rows: one of them
        again = F.col(ROW) == F.col("repeated_row")
        left = left.join(repeated, again, "left_anti").unionByName(left.join(repeated, again, "left_semi").dropDuplicates([ROW]))
    return left.drop(ROW)
