"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared tile by tile with exclusive-or and bit counts.

1. Fingerprints. A-Z are lower-cased, words are runs without ASCII white space, shingles are ``n`` words in a row joined
   by spaces, repeats included (fewer words: all of them as one). A fingerprint bit is set if more than half of the
   shingles' XXH64 hashes have it. A text of any length is hashed and counted in blocks, so memory does not follow it.
2. Tiles. Equal fingerprints are one row from here on, whatever the number of documents. The 64 bits are cut into
   ``parts``; the population counts of the parts are a tile's key (at most 17^4 keys), and a key's fingerprints are
   dealt by hash over tiles of about ``tile`` rows. Two fingerprints differ in at least as many bits as the sum of the
   differences of their population counts, so a pair of tiles whose keys are further apart than the radius is
   skipped, exactly. More parts skip more pairs but make smaller tiles: one, two or four by the number of
   fingerprints. The links do not depend on it.
3. Comparison. A unit of work is a home tile with the tiles at or after it that are near enough, at most ``lot`` tiles
   of a key; it is compared in blocks with numpy. Everything within the radius is found, there is no limit on partners.
   A unit emits not its pairs but a forest that joins what they join, so a group of many near copies costs
   as many links as it has members.
4. Components by passing on the smallest label, in tables.

The comparisons grow with the square of the number of different fingerprints, as the method does; with four parts about a
tenth of the pairs is left (measured figures are in the README). Shuffled are 8 bytes per fingerprint and near tile.

Defined results: null and empty texts and texts without words have fingerprint zero, which is linked like any other;
rows that share a doc_id are documents of their own; rows without an id have their fingerprint, join others together
like any row and get the smallest id that they reach, or none; repeated rows are returned as often as they are there;
other columns are left out, an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import ship_package, written
from attrition.llm.ngram_join import components

#: Seed of XXH64, fixed by the query contract (and what Spark's xxhash64 uses).
SEED = 42


@dataclass(frozen=True)
class SimHashOptions:
    n: int = 5
    #: fingerprints link at so many differing bits or fewer
    radius: int = 4
    tile: int = 1024
    #: tiles of a neighbouring key that one unit of work takes
    lot: int = 16
    #: population counts per fingerprint (1, 2 or 4); None: by the number of fingerprints
    parts: int | None = None


# --- fingerprints

BLOCK = 1 << 16


def _shingle_blocks(text: str | None, n: int):
    """The XXH64 hashes of a text's shingles, in arrays of at most ``BLOCK``."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    del words
    width = min(n, len(ends))
    starts = np.r_[0, ends[:-1] + 1][:len(ends) - width + 1].tolist()
    stops = ends[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        yield np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:at + BLOCK], stops[at:at + BLOCK])], np.uint64)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """One row per hash and one column per bit, from the least significant."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(texts: list[str | None], n: int) -> np.ndarray:
    """The fingerprints of some texts as unsigned 64-bit numbers."""
    votes, shingles = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held, owners, waiting = [], [], 0

    def count():
        nonlocal held, owners, waiting
        if held:
            starts = np.cumsum([0, *map(len, held[:-1])])
            sums = np.add.reduceat(_bits(np.concatenate(held)), starts, axis=0, dtype=np.int64)
            np.add.at(votes, owners, sums)
        held, owners, waiting = [], [], 0

    for i, text in enumerate(texts):
        for block in _shingle_blocks(text, n):
            shingles[i] += len(block)
            held.append(block)
            owners.append(i)
            waiting += len(block)
            if waiting >= BLOCK:
                count()
    count()
    return np.packbits(2 * votes > shingles[:, None], axis=1, bitorder="little").view("<u8").ravel()


def with_fingerprint(docs: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, fp) of every document; ``fp`` holds the fingerprint's 64 bits as a long."""
    ship_package(docs.sparkSession)

    def scan(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                fp = fingerprints(part.column(1).to_pylist(), n)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(scan, "doc_id long, fp long")


# --- tiles

def parts_for(rows: int) -> int:
    """So that an ordinary key has some hundred to some thousand fingerprints."""
    return 1 if rows < 40_000 else 2 if rows < 1_000_000 else 4


def _key(parts: int):
    """The population counts of the parts as one number, a byte each."""
    bits = 64 // parts
    mask = F.lit((1 << bits) - 1 if bits < 64 else -1).cast("long")
    counts = [F.bit_count(F.shiftrightunsigned("fp", bits * i).bitwiseAND(mask)).cast("long") for i in range(parts)]
    key = counts[0]
    for i, c in enumerate(counts[1:], 1):
        key = key + F.shiftleft(c, 8 * i)
    return key


def _steps(parts: int, radius: int) -> list[int]:
    """What to add to a key for every key that is not before it and not further away than the radius."""
    near = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    return sorted(step for d in near if (step := sum(x << (8 * i) for i, x in enumerate(d))) >= 0)


def tiles(prints: DataFrame, rows: int, o: SimHashOptions) -> DataFrame:
    """(key, tile, fps): the distinct fingerprints ``fp`` in tiles of about ``o.tile`` rows with the same key."""
    keyed = prints.withColumn("key", _key(o.parts or parts_for(rows)))
    sizes = keyed.groupBy("key").agg(F.ceil(F.count("*") / o.tile).cast("int").alias("n"))  # at most 17^4 rows
    tile = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    return keyed.join(F.broadcast(sizes), "key").groupBy("key", tile.alias("tile")).agg(F.collect_list("fp").alias("fps"))


def tile_pairs(names: DataFrame, rows: int, o: SimHashOptions) -> DataFrame:
    """Members of the units of work: (home_key, home_tile, lot, key, tile). The home tile itself is in every lot."""
    steps = F.array(*[F.lit(s).cast("long") for s in _steps(o.parts or parts_for(rows), o.radius)])
    home = names.select(F.col("key").alias("home_key"), F.col("tile").alias("home_tile"), F.explode(steps).alias("step"))
    near = home.withColumn("key", F.col("home_key") + F.col("step")).drop("step").join(names, "key")
    near = near.where("key <> home_key OR tile >= home_tile").withColumn("lot", F.expr(f"tile div {o.lot}"))
    unit = ["home_key", "home_tile", "lot"]
    homes = near.select(*unit).distinct().select(*unit, F.col("home_key").alias("key"), F.col("home_tile").alias("tile"))
    return near.select(*unit, "key", "tile").where("key <> home_key OR tile <> home_tile").unionByName(homes)


# --- comparison

def _join(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of ``a`` and ``b``; ``root`` holds the root of every member, in place."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(up := root[root], root):
            root[:] = up


def forest(home: np.ndarray, others: np.ndarray, radius: int, cells: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, root) that join whatever is linked within ``home`` or between ``home`` and ``others``."""
    every = np.concatenate([home, others])
    root = np.arange(len(every))
    rows = max(1, cells // max(1, len(every)))
    for at in range(0, len(home), rows):
        some = home[at:at + rows]
        for first in range(at, len(every), cells):  # what is before ``at`` has met these rows already
            near = np.bitwise_count(some[:, None] ^ every[None, first:first + cells]) <= radius
            # every row is near itself, once; anything more is a link
            if np.count_nonzero(near) > (len(some) if first == at else 0):
                r, c = np.nonzero(near)
                _join(root, r + at, c + first)
    joined = np.flatnonzero(root != np.arange(len(every)))
    return every[joined], every[root[joined]]


def links(prints: DataFrame, o: SimHashOptions = SimHashOptions()) -> DataFrame:
    """(a, b): links that join all distinct fingerprints ``fp`` within the radius of each other."""
    spark = prints.sparkSession
    rows = prints.count()
    laid = written(tiles(prints, rows, o), "simhash-tiles")
    members = written(tile_pairs(laid.select("key", "tile"), rows, o), "simhash-units")
    radius = o.radius

    def compare(key, table):
        fps = table.column("fps").combine_chunks()
        lens = np.diff(fps.offsets.to_numpy())
        flat = fps.flatten().to_numpy().view(np.uint64)
        mine = np.repeat((table.column("key").to_numpy() == key[0].as_py()) & (table.column("tile").to_numpy() == key[1].as_py()), lens)
        a, b = forest(flat[mine], flat[~mine], radius)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    unit = ["home_key", "home_tile", "lot"]
    # the work of a unit does not follow its size in bytes, so the number of partitions is set
    parts = max(4 * spark.sparkContext.defaultParallelism, min(members.count() // 256, 1 << 16))
    sent = members.join(laid, ["key", "tile"]).repartition(parts, *unit)
    found = sent.groupBy(*unit).applyInArrow(compare, "a long, b long")
    return written(found.distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, o: SimHashOptions = SimHashOptions()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest id reachable by links, of every document."""
    marked = written(with_fingerprint(docs, o.n), "fingerprints")
    prints = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = links(prints.select("fp"), o)
    nodes = found.select(F.col("a").alias("node")).union(found.select(F.col("b").alias("node"))).distinct()
    label = written(components(written(nodes, "simhash-nodes"), found), "simhash-components")
    named = prints.join(label, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = written(named.join(smallest, "component").select("fp", "component_id"), "simhash-labels")
    return (marked.join(of_print, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
