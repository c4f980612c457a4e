"""Periodic runs in word sequences, by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and a length of at least ``exponent`` * q that no
neighbouring word extends keeping the period: boilerplate that a text repeats back to back. ``periodic_runs`` returns
every run of every document and the text collapsed to the first period of each.

Method, for many documents at once (separated by marks that occur once, which no repetition can cross). For the scales
t = 1, 2, 4 ...:

* The name of position i is a 64-bit hash of the t words from i on, made from two names of the scale before.
* Highly periodic regions: positions whose t words have a period of at most t/4. They lie in runs that smaller
  scales have found, and are left out of the choice of positions.
* Synchronising set: the positions i for which the least name among i ... i+t, regions left out, is that of i or of
  i+t. Whether i is in the set depends on the 2t words from i on alone, its context; and every t positions
  hold one, unless all 3t words there lie in a highly periodic region.
* Neighbouring positions of the set with equal contexts at a distance d, t <= d < 2t, propose the period d. It is tested on the
  words themselves and extended to both sides as far as it holds.

No run is missed: let q be its period, t <= q < 2t, and its length 4q or more. A position of the set is among its first
t, as its first 3t words have no period of t/4 or less (with q they would have a smaller common one); q
words on the context is the same, so that position is in the set too, and no equal context is between them (that
would make q not the smallest). Periods up to t/4, omitted at scale t, were proposed at their own scales, which is where the
regions come from. Equal contexts are equal hashes; a collision of 64 bits could only hide a proposal, never report a
wrong run. Stretches proposed with a multiple of their smallest period are reported once, with the smallest.

Work is O(n log n) sliding minima per document plus the sort of about 2n/t positions a scale; documents too short for a
scale leave it. There is no shuffle. A task holds some megabytes of texts, or one text, at a time.

Defined results: null and empty texts have no runs and collapse to an empty text; rows stand for themselves, so repeated ids
and rows and null ids change nothing; other columns are left out; a text of any length is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import let, ship_package, words


@dataclass(frozen=True)
class RunOptions:
    least_length: int = 6
    #: length over period; the method finds all runs from four periods on
    exponent: int = 4
    #: bytes of text handled at a time (or a single text)
    chunk: int = 4 << 20

    def __post_init__(self):
        if self.exponent < 4:
            raise ValueError("runs of fewer than four periods are not all found")


RUNS = "array<struct<start:long,length:long,period:long>>"
LAST = np.uint64((1 << 64) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _ahead(x: np.ndarray, k: int, beyond) -> np.ndarray:
    """x[i + k], and ``beyond`` past the end."""
    out = np.full_like(x, beyond)
    out[:max(0, len(x) - k)] = x[k:]
    return out


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i] ... x[i + width - 1]; width is a power of two plus one."""
    low, have = x, 1
    while 2 * have < width:
        low = np.minimum(low, _ahead(low, have, LAST))
        have *= 2
    return np.minimum(low, _ahead(x, width - 1, LAST))


def _proposals(names: np.ndarray, regions: np.ndarray, contexts: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods that equal contexts of the synchronising set propose at scale t, by period and position."""
    shown = np.where(regions, LAST, names >> np.uint64(1))
    low = _least(shown, t + 1)
    chosen = (low != LAST) & ((shown == low) | (_ahead(shown, t, LAST) == low))
    if t <= 4:  # nearly all positions are in the set: compare at each distance, without sorting
        at = [np.flatnonzero(chosen[:-d] & chosen[d:] & (contexts[:-d] == contexts[d:])) for d in range(t, 2 * t)]
        return np.concatenate(at), np.repeat(np.arange(t, 2 * t), list(map(len, at)))
    place = np.flatnonzero(chosen)
    context = contexts[place]
    order = np.argsort(context, kind="stable")
    place, context = place[order], context[order]
    apart = place[1:] - place[:-1]
    near = np.flatnonzero((context[1:] == context[:-1]) & (apart >= t) & (apart < 2 * t))
    near = near[np.lexsort((place[near], apart[near]))]
    return place[near], apart[near]


def _reach(same, most: int) -> int:
    """How many steps 0, 1, ... hold, where ``same(a, b)`` tells of steps a ... b - 1; ``most`` at most."""
    done, width = 0, 16
    while done < most:
        part = same(done, min(most, done + width))
        if not part.all():
            return done + int(np.argmin(part))
        done += len(part)
        width = min(2 * width, 1 << 16)
    return done


def _stretch(w: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The longest stretch around i with period d, as start and end."""
    forth = _reach(lambda a, b: w[i + a:i + b] == w[i + d + a:i + d + b], len(w) - d - i)
    back = _reach(lambda a, b: w[i - b:i - a][::-1] == w[i + d - b:i + d - a][::-1], i)
    return i - back, i + d + forth


def find_runs(codes: np.ndarray, lengths: np.ndarray, o: RunOptions = RunOptions()) -> np.ndarray:
    """Rows (start, end, period) of all runs in some documents, by start and period.

    ``codes`` holds the documents one after another, each followed by a mark that occurs only once.
    """
    found = np.empty((0, 3), np.int64)
    w, kept = codes, lengths
    place = np.arange(len(codes))
    with np.errstate(over="ignore"):
        names = _mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        t = 1
        while True:
            stay = kept >= 4 * t
            if not stay.any():
                break
            if not stay.all():
                mask = np.repeat(stay, kept + 1)
                w, names, place, kept = w[mask], names[mask], place[mask], kept[stay]
            contexts = _mixed(names * np.uint64(0x9E3779B97F4A7C15) + _ahead(names, t, 0))
            covering = found[(found[:, 2] <= t // 4) & (found[:, 1] - found[:, 0] >= t)]
            at = np.searchsorted(place, covering[:, 0])
            inside = (at < len(place)) & (place[np.minimum(at, len(place) - 1)] == covering[:, 0])
            at, covering = at[inside], covering[inside]
            edge = np.zeros(len(w) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + (covering[:, 1] - covering[:, 0]) - t + 1, -1)
            rows, last = [], (0, -1)  # period and end of the stretch before
            for i, d in zip(*(x.tolist() for x in _proposals(names, np.cumsum(edge[:-1]) > 0, contexts, t))):
                if d == last[0] and i + d < last[1]:
                    continue
                start, end = _stretch(w, i, d)
                last = d, end
                if end - start >= 4 * d:
                    rows.append((place[start], place[start] + end - start, d))
            if rows:
                found = np.concatenate([found, np.array(rows, np.int64)])
            names, t = contexts, 2 * t
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    if len(found):  # of several periods of one stretch, the smallest
        found = found[np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)]]
    length = found[:, 1] - found[:, 0]
    found = found[(length >= o.least_length) & (length >= o.exponent * found[:, 2])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


class _Codes(dict):
    """Word -> number, in the order of appearance."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def _collapsed(texts: list[str | None], o: RunOptions) -> tuple[list, list, list]:
    """Number of words, runs, and collapsed text of each text."""
    split = [(text or "").encode("utf-8").split() for text in texts]
    lengths = np.array(list(map(len, split)), np.int64)
    code, parts = _Codes(), []
    for i, ws in enumerate(split):
        parts.append(np.fromiter(map(code.__getitem__, ws), np.int64, len(ws)))
        parts.append(np.array([-1 - i]))
    codes = np.concatenate(parts)
    found = find_runs(codes, lengths, o)
    begin = np.cumsum(lengths + 1) - lengths - 1
    owner = np.searchsorted(begin, found[:, 0], side="right") - 1
    runs: list[list] = [[] for _ in texts]
    kept = [b" ".join(ws).decode("utf-8") for ws in split]
    for i in np.unique(owner).tolist():
        mine = found[owner == i] if len(owner) < 64 else found[slice(*np.searchsorted(owner, [i, i + 1]))]
        drop = np.zeros(lengths[i] + 1, np.int64)
        start, end, period = (mine[:, 0] - begin[i], mine[:, 1] - begin[i], mine[:, 2])
        np.add.at(drop, start + period, 1)
        np.add.at(drop, end, -1)
        runs[i] = [{"start": s, "length": n, "period": p} for s, n, p in zip(start.tolist(), (end - start).tolist(), period.tolist())]
        kept[i] = b" ".join([split[i][k] for k in np.flatnonzero(np.cumsum(drop[:-1]) == 0)]).decode("utf-8")
    return lengths.tolist(), runs, kept


def periodic_runs(docs: DataFrame, o: RunOptions = RunOptions()) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words; by start, then period) and collapsed text of every row."""
    ship_package(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def result(ids, texts):
        n, runs, kept = _collapsed(texts, o)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(runs, kind),
                                           pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    def scan(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= o.chunk:
                    yield result(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield result(ids, texts)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(scan, f"doc_id long, n_words long, runs {RUNS}, collapsed string"))


def planted(doc_id: Column, text: Column) -> Column:
    """The text with a periodic tail if crc32(doc_id) is divisible by ten: from a word a on, the p words there over and over."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def tail(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.when(n > 0, g % n)
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return let(F.struct(w.alias("w"), a.alias("a"), p.alias("p"), n.alias("n")), lambda x: F.concat_ws(" ", F.concat(
            F.slice(x["w"], F.lit(1), x["a"].cast("int")),
            F.transform(F.sequence(x["a"], x["n"] - 1), lambda i: F.get(x["w"], (x["a"] + (i - x["a"]) % x["p"]).cast("int"))))))

    return F.when((h % 10 == 0) & F.rlike(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]")), let(words(text), tail)).otherwise(text)


def run_report(docs: DataFrame, o: RunOptions = RunOptions()) -> DataFrame:
    """Number of runs, the longest run, and digests of all runs and of the collapsed text of every document."""
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")), o)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    found = found.withColumn("top", longest)
    start, length, period = -F.col("top.back"), F.col("top.length"), -F.col("top.less")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
