"""Language-model scores from a probabilistic suffix tree over words.

Symbols are the words seen at least ``least_symbol`` times and the end of a document; all other words keep their
unigram probabilities. The root is the smoothed unigram distribution. A longer context (up to ``depth`` symbols) is a
candidate if it occurs at least ``least_context`` times and its suffix is in the tree; it is retained if its
next-symbol distribution diverges from its suffix's: the log-likelihood that it gains over its own occurrences must
exceed half its number of entries times the log of its occurrences. Entries are next symbols seen at least
``least_entry`` times. Next-symbol distributions are smoothed towards the suffix's, which also gets the mass of the
entries too rare to keep, so every distribution sums to 1. A text is scored symbol by symbol from the longest
retained suffix of what stands before; the end of the document before it stands before its first word.

The tests are numbers of occurrences, so the tree grows with the corpus, and it is never in one place: sequences of
symbols are 64-bit hashes, their counts, the contexts and the entries are tables joined and summed by hash, level by
level. Seen that way a text's score is a sum: each sequence in it adds the log probability that its entry gains over
the suffix's, and the log of the backoff of its context. Workers hold two things of bounded size, which spare rows and change no result: a
Bloom filter of at most ``FILTER_WORDS`` words, and the weights of the most frequent sequences, at most ``NEAR_ROWS``.

The texts are cut into words once: a slice of documents, of about ``SLICE_TOKENS`` tokens, is written as the hashes of
its distinct words and the place of every token among them, and all passes read that. What a pass sends on is summed by
slice first and goes in blocks, one per slice and range of the hash space, not in a row per sequence; a range has
about ``RANGE_ROWS`` sequences or fewer, so their number grows with the corpus. A worker looks sequences up ``PIECE``
positions at a time and sorts what it sends one part of the hash space after the other, so that beside a slice it holds
little more than the requests themselves.

The shares in ``TreeOptions`` raise the thresholds with the corpus. They are 0 unless given.

Defined results: a null or empty text is the end alone; only A-Z are lower-cased; a null id is split like the empty
text; rows that repeat an id are documents of their own; without training documents N is 0 and every token unknown.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import ship_package, written
from attrition.llm.ngram_join import _mixed, _WordHashes

END = xxhash.xxh3_64_intdigest(b" ")  # no word contains a space
END_LONG = int(np.array([END], np.uint64).view(np.int64)[0])
RARE, FIRST = 0, 1  # the class of other words; the end of a document
FILTER_WORDS = 1 << 21
NEAR_ROWS = 3 << 19
SLICE_TOKENS = 2_000_000
RANGE_ROWS = 2_000_000
PIECE = 1 << 17
PART_BITS = 4


@dataclass(frozen=True)
class TreeOptions:
    depth: int = 3
    symbol_share: float = 0.0
    context_share: float = 0.0
    next_share: float = 0.0
    entry_share: float = 0.0
    least_symbol: int = 2
    least_context: int = 16
    least_entry: int = 2
    backoff: float = 2.0


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _tokens(text: str | None, hashes: dict) -> np.ndarray:
    ws = (text or "").encode("utf-8").lower().split()
    out = np.fromiter(map(hashes.__getitem__, ws), dtype=np.uint64, count=len(ws))
    return np.append(out, np.uint64(END))


class _Places(dict):
    """Word -> its place among the distinct words met; the end of a document has place 0."""

    def __init__(self):
        super().__init__({b" ": 0})

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


@dataclass
class Slice:
    """Some documents, one after the other in ``places``, each with its end."""

    first: int            # row number of the first; the others follow
    ids: list
    lengths: np.ndarray   # tokens by document
    places: np.ndarray    # of each token in ``words``
    words: np.ndarray     # hashes of the distinct words, the end first

    def training(self) -> Slice:
        kept = np.array([not held_out(i) for i in self.ids], bool)
        return Slice(self.first, [i for i, k in zip(self.ids, kept) if k], self.lengths[kept],
                     self.places[np.repeat(kept, self.lengths)], self.words)

    def between_ends(self) -> tuple[np.ndarray, np.ndarray]:
        """The places with an end before each document too, and the number of the document at each."""
        doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths + 1)
        own = np.append(False, doc[1:] == doc[:-1]) if len(doc) else np.zeros(0, bool)
        out = np.zeros(len(doc), self.places.dtype)
        out[own] = self.places
        return out, doc


SLICES = "first long, ids array<long>, lengths binary, places binary, words binary"


def encoded(docs: DataFrame) -> DataFrame:
    """The written slices of all documents."""
    ship_package(docs.sparkSession)
    names = ["first", "ids", "lengths", "places", "words"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, ids, tokens, size, places = None, [], [], 0, _Places()

        def slice_():
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, places), np.uint64, len(places))
            lengths = np.array([len(t) for t in tokens], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 *[pa.array([_packed(x)], pa.binary()) for x in (lengths, np.concatenate(tokens), words)]], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for row, doc_id, text in zip(*(batch.slice(at, 500).column(i).to_pylist() for i in range(3))):
                    if size >= SLICE_TOKENS:
                        yield slice_()
                        first, ids, tokens, size, places = None, [], [], 0, _Places()
                    ws = (text or "").encode("utf-8").lower().split()
                    tokens.append(np.fromiter(map(places.__getitem__, [*ws, b" "]), np.uint32, len(ws) + 1))
                    first = row if first is None else first
                    ids.append(doc_id)
                    size += len(ws) + 1
        if tokens:
            yield slice_()

    # the row numbers of a partition follow each other
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return written(keyed.mapInArrow(cut, SLICES), "slices")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    for batch in batches:
        first, ids, *packed = (batch.column(n) for n in ("first", "ids", "lengths", "places", "words"))
        for i in range(batch.num_rows):
            lengths, places, words = (_unpacked(c[i].as_buffer(), t) for c, t in zip(packed, (np.int64, np.uint32, np.uint64)))
            yield Slice(first[i].as_py(), ids[i].as_py(), lengths, places, words)


def _range_bits(rows: int) -> int:
    """So many leading bits of a hash name its range that a range has about RANGE_ROWS of the rows."""
    return min(max(rows // RANGE_ROWS, 0).bit_length(), 15)


def _packed(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second ones and so on: small numbers compress to little."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def _unpacked(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def _by_range(h: np.ndarray, bits: int, columns: dict[str, np.ndarray]) -> dict[str, list]:
    """The columns cut into one block per range of the hashes, each block as bytes."""
    ranges = (h >> np.uint64(1) >> np.uint64(63 - bits)).astype(np.uint16)
    order = np.argsort(ranges, kind="stable")
    ranges = ranges[order]
    starts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])) if len(h) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(h))
    out = {"range": ranges[starts].tolist()}
    for name, column in columns.items():
        column = column[order]
        out[name] = [_packed(column[s:e]) for s, e in zip(starts, ends)]
    return out


def _joined(blocks: pa.ChunkedArray, kind) -> np.ndarray:
    packed, size, at = [b.as_buffer() for b in blocks], np.dtype(kind).itemsize, 0
    out = np.empty(sum(b.size for b in packed) // size, kind)
    each = out.view(np.uint8).reshape(-1, size)
    for b in packed:
        own = np.frombuffer(b, np.uint8).reshape(size, -1).T
        each[at:at + len(own)] = own
        at += len(own)
    return out


def _added(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct hash stands first, and the sum of its n."""
    order = np.argsort(h, kind="stable")
    h = h[order]
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return order[starts], np.add.reduceat(n[order].astype(np.int64), starts) if len(h) else np.zeros(0, np.int64)


def word_counts(slices: DataFrame) -> DataFrame:
    """(h, n): how often each token occurs in the training documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in map(Slice.training, _slices(batches)):
            n = np.bincount(s.places, minlength=len(s.words))
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict(_by_range(s.words[met], bits, {"h": s.words[met], "n": n[met].astype(np.uint32)}), schema)

    def add(blocks: pa.Table) -> pa.Table:
        h, n = _joined(blocks["h"], np.uint64), _joined(blocks["n"], np.uint32)
        first, sums = _added(h, n)
        return pa.table({"h": _signed(h[first]), "n": sums})

    schema = pa.schema([("range", pa.int32()), ("h", pa.binary()), ("n", pa.binary())])
    bits = _range_bits(int(slices.agg(F.coalesce(F.sum(F.length("words")), F.lit(0))).first()[0]) // 8)
    return slices.mapInArrow(count, "range int, h binary, n binary").groupBy("range").applyInArrow(add, "h long, n long")


@dataclass
class Level:
    """The contexts of one length: (symbol, state of the suffix) -> state, and each state's distribution."""

    keys: np.ndarray      # symbol * (states of the level above + 1) + suffix state, sorted
    above: int            # states of the level above, and 1
    entries: np.ndarray   # state * symbols + next symbol, sorted
    counts: np.ndarray
    backoff: np.ndarray   # by state, 0 unused: weight of the suffix's distribution
    total: np.ndarray     # by state: sum of counts and backoff


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each wanted key, -1 where absent."""
    if not len(sorted_):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_, wanted), len(sorted_) - 1)
    return np.where(sorted_[at] == wanted, at, -1)


@dataclass
class Tree:
    hashes: np.ndarray    # of the symbols from FIRST on, sorted
    symbols: np.ndarray   # symbol of each hash
    log_root: np.ndarray  # log10 root probability by symbol
    levels: list[Level]

    def states(self, x: np.ndarray, upto: int) -> list[np.ndarray]:
        """Per position of a document's symbols, the state of each length (0: none)."""
        out, suffix = [], np.zeros(len(x), np.int64)
        for length, level in enumerate(self.levels[:upto], 1):
            before = np.zeros(len(x), np.int64)
            before[length:] = x[:-length]
            known = np.arange(len(x)) >= length
            if length == 1 and len(x):  # what stands before the first word is the end of a document
                before[0], known = FIRST, np.ones(len(x), bool)
            if length > 1:
                known = known & (suffix > 0)
                # the second-last symbol of the second word is the end of the document before, and so on
                if len(x) >= length:
                    before[length - 1], known[length - 1] = FIRST, suffix[length - 1] > 0
            state = np.zeros(len(x), np.int64)
            where = np.flatnonzero(known)
            state[where] = _find(level.keys, before[where] * level.above + suffix[where]) + 1
            out.append(state)
            suffix = state
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """The probability of every symbol of a document, given those before."""
        p, size = 10.0 ** self.log_root[x], len(self.log_root)
        for state, level in zip(self.states(x, len(self.levels)), self.levels):
            where = np.flatnonzero(state)
            s = state[where]
            at = _find(level.entries, s * size + x[where])
            n = np.where(at >= 0, level.counts[at] if len(level.counts) else 0, 0)
            p[where] = (n + level.backoff[s] * p[where]) / level.total[s]
        return p


def _sequence(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The hash of a sequence from those of all but its last and all but its first symbol, which tell it."""
    return _mixed(context * np.uint64(0x9E3779B97F4A7C15) + _mixed(suffix))


def _pieces(n: int) -> Iterator[slice]:
    return (slice(at, min(at + PIECE, n)) for at in range(0, n, PIECE))


def _lengthened(grams: np.ndarray) -> np.ndarray:
    """The hashes of the sequences one symbol longer, in the place of those given."""
    out = grams[:-1]
    for p in _pieces(len(out)):
        out[p] = _sequence(grams[p], grams[p.start + 1:p.stop + 1])  # the next piece's are not yet overwritten
    return out


def _grams(symbols: np.ndarray, doc: np.ndarray, longest: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """By length, the hash of the sequence that starts at each position and whether it ends inside the document."""
    grams, inside = [symbols], [np.ones(len(symbols), bool)]
    for k in range(1, longest):
        whole = np.zeros(len(symbols), np.uint64)
        upto = max(len(symbols) - k, 0)
        whole[:upto] = _sequence(grams[-1][:upto], grams[-1][1:upto + 1])
        fits = np.zeros(len(symbols), bool)
        fits[:upto] = doc[:upto] == doc[k:]
        grams.append(whole)
        inside.append(fits)
    return grams, inside


def _sequences(texts: list, hashes: dict, longest: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Of each position of the texts, an end before and after each: the text, and by length the hash of the sequence
    that starts there and whether it ends inside the text."""
    parts = [_tokens(t, hashes) for t in texts]
    ends = np.array([END], np.uint64)
    symbols = np.concatenate([x for p in parts for x in (ends, p)])
    doc = np.repeat(np.arange(len(parts)), [len(p) + 1 for p in parts])
    return doc, *_grams(symbols, doc, longest)


@dataclass
class Bloom:
    """Three bits of one word for each key; a full filter lets more through, never less."""

    bits: np.ndarray

    @staticmethod
    def of(keys: DataFrame) -> Bloom:
        """From the column h. At most FILTER_WORDS rows of two longs are collected."""
        size = 1 << min(max(keys.count() // 6, 1).bit_length(), FILTER_WORDS.bit_length() - 1)
        one = F.lit(1).cast("long")
        bit = [F.call_function("shiftleft", one, F.shiftrightunsigned("h", at).bitwiseAND(63).cast("int")) for at in (40, 46, 52)]
        words = keys.groupBy(F.col("h").bitwiseAND(F.lit(size - 1)).alias("word")).agg(
            F.bit_or(bit[0].bitwiseOR(bit[1]).bitwiseOR(bit[2])).alias("bits")).toArrow()
        bits = np.zeros(size, np.uint64)
        bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
        return Bloom(bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        one, low = np.uint64(1), np.uint64(63)
        out = np.empty(len(h), bool)
        for p in _pieces(len(h)):
            own, mask = h[p], np.zeros(p.stop - p.start, np.uint64)
            for at in (40, 46, 52):
                mask |= one << ((own >> np.uint64(at)) & low)
            out[p] = self.bits[(own & np.uint64(len(self.bits) - 1)).astype(np.int64)] & mask == mask
        return out


def _longer_counts(slices: DataFrame, length: int, often: DataFrame, ends: DataFrame, least: float, n_tokens: int) -> DataFrame:
    """(h, context, suffix, n), written, of the sequences of ``length`` + 1 symbols that go on from those in ``often`` (h).

    Sequences whose suffix is not in ``ends`` (h) may be left out.
    """
    shared = slices.sparkSession.sparkContext.broadcast((Bloom.of(often), Bloom.of(ends)))
    bits = _range_bits(n_tokens)
    schema = pa.schema([("range", pa.int32()), ("context", pa.binary()), ("suffix", pa.binary()), ("n", pa.binary())])

    def pairs(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each distinct pair of words, and how often it occurs."""
        goes_on, may_end = (f.has(s.words) for f in shared.value)
        places, doc = s.between_ends()
        where = np.flatnonzero((doc[:-1] == doc[1:]) & goes_on[places[:-1]] & may_end[places[1:]])
        pair = np.sort(places[where].astype(np.int64) * len(s.words) + places[where + 1])
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, np.int64)
        context, suffix = np.divmod(pair[starts], len(s.words))
        return s.words[context], s.words[suffix], np.diff(np.append(starts, len(pair)))

    def longer(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        goes_on, may_end = shared.value
        places, doc = s.between_ends()
        gram = s.words[places]
        for _ in range(1, length):
            gram = _lengthened(gram)
        where = np.flatnonzero(doc[:max(len(doc) - length, 0)] == doc[length:])
        where = where[goes_on.has(gram[where])]
        where = where[may_end.has(gram[where + 1])]
        context, suffix = gram[where], gram[where + 1]
        del places, doc, gram, where
        _, first, n = np.unique(_sequence(context, suffix), return_index=True, return_counts=True)
        return context[first], suffix[first], n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in map(Slice.training, _slices(batches)):
            if len(s.lengths):
                context, suffix, n = pairs(s) if length == 1 else longer(s)
                yield pa.RecordBatch.from_pydict(_by_range(_sequence(context, suffix), bits, {
                    "context": context, "suffix": suffix, "n": n.astype(np.uint32)}), schema)

    def add(blocks: pa.Table) -> pa.Table:
        context, suffix, n = (_joined(blocks[c], t) for c, t in (("context", np.uint64), ("suffix", np.uint64), ("n", np.uint32)))
        h = _sequence(context, suffix)
        first, sums = _added(h, n)
        first, sums = first[sums >= least], sums[sums >= least]
        return pa.table({**{name: _signed(c[first]) for name, c in (("h", h), ("context", context), ("suffix", suffix))}, "n": sums})

    rows = slices.mapInArrow(count, "range int, context binary, suffix binary, n binary")
    counts = written(rows.groupBy("range").applyInArrow(add, "h long, context long, suffix long, n long"), "next-counts")
    shared.destroy()
    return counts


def _discard(spark, *done: DataFrame) -> None:
    """Delete written tables that nothing reads any more; shuffle files go with the plans that are collected."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for files in (df.inputFiles() for df in done):
        if files:
            folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            folder.getFileSystem(conf).delete(folder, True)
    jvm.System.gc()


@dataclass
class Model:
    options: TreeOptions
    words: DataFrame   # (h, n) of all training tokens
    levels: list[tuple[DataFrame, DataFrame, DataFrame]]  # frequent sequences one longer; contexts (h, backoff, total); entries (h, n, p, gain)
    n_tokens: int
    distinct: int

    def log_unigram(self, n):
        return F.log10((n + F.lit(0.5)) / F.lit(self.n_tokens + 0.5 * (self.distinct + 1)))

    @property
    def unknown(self) -> float:
        return math.log10(0.5 / (self.n_tokens + 0.5 * (self.distinct + 1)))

    def weights(self) -> DataFrame:
        """(h, n, known, base, own): what each sequence adds to a text's scores, above that of unknown words.

        A sequence may have two rows with the same n, as an entry and as a context; both add.
        """
        none, zero = F.lit(0.0), F.lit(0).cast("long")
        out = self.words.select("h", "n", F.lit(1).cast("long").alias("known"),
                                (self.log_unigram(F.col("n")) - self.unknown).alias("base"), none.alias("own"))
        for _, contexts, entries in self.levels:
            out = out.union(contexts.select("h", "n", zero, none, F.log10(F.col("backoff") / F.col("total"))))
            out = out.union(entries.select("h", "n", zero, none, "gain"))
        return out

    @property
    def tree(self) -> Tree:
        """The whole tree in the driver, to look at small ones; nothing else collects it."""
        o = self.options
        words = _symbols(self.words, self.n_tokens, o).toPandas().sort_values(["n", "h"], ascending=False)
        words = words[words["h"] != END_LONG]
        ends = self.words.where(F.col("h") == END_LONG).first()
        h = np.concatenate([[END_LONG], words["h"].to_numpy(np.int64)]).astype(np.int64).view(np.uint64)
        n = np.concatenate([[ends["n"] if ends else 0], words["n"].to_numpy(np.int64)])
        root = (n + 0.5) / (self.n_tokens + 0.5 * (self.distinct + 1))
        log_root = np.log10(np.concatenate([[max(1.0 - root.sum(), 1e-300)], root]))
        by_hash = np.argsort(h)
        tree = Tree(h[by_hash], (by_hash + FIRST).astype(np.int64), log_root, [])
        spelled = {x: (i + FIRST,) for i, x in enumerate(_signed(h).tolist())}
        state_of, above = {(): 0}, 1
        after = {(): h}  # of each context the hashes of it and one more symbol
        for often, contexts, entries in self.levels:
            held = {r.h: (r.backoff, r.total) for r in contexts.collect()}
            keyed = sorted((spelled[c][0] * above + state_of[spelled[c][1:]], c) for c in held)
            state_of = {spelled[c]: i for i, (_, c) in enumerate(keyed, 1)}
            after = {spelled[c]: _sequence(np.array([c]).view(np.uint64), after[spelled[c][1:]]) for _, c in keyed}
            met = {r.h: r.n for r in entries.collect()}
            kept = sorted((state_of[c] * len(log_root) + FIRST + i, met[x]) for c, longer in after.items()
                          for i, x in enumerate(_signed(longer).tolist()) if x in met)
            for r in often.collect():
                if r.context in spelled and r.suffix in spelled:
                    spelled[r.h] = (*spelled[r.context], spelled[r.suffix][-1])
            backoff, total = (np.array([0.0] + [held[c][i] for _, c in keyed]) for i in (0, 1))
            keys = np.array([k for k, _ in keyed], np.int64)
            tree.levels.append(Level(keys, above, np.array([k for k, _ in kept], np.int64),
                                     np.array([c for _, c in kept], np.float64), backoff, total))
            above = len(keyed) + 1
        return tree


def _symbols(words: DataFrame, n_tokens: int, o: TreeOptions) -> DataFrame:
    return words.where((F.col("n") >= max(o.least_symbol, o.symbol_share * n_tokens)) | (F.col("h") == END_LONG))


def _grown(counts: DataFrame, candidates: DataFrame, below: DataFrame, o: TreeOptions) -> tuple[DataFrame, DataFrame]:
    """The retained contexts among the candidates (h, n), and their entries; ``below`` has the suffixes' (h, p).

    The counts are deleted.
    """
    entries = written(counts.join(candidates.select(F.col("h").alias("context")), "context")
                      .join(below.select(F.col("h").alias("suffix"), F.col("p").alias("lower")), "suffix")
                      .select("h", "context", "n", "lower"), "candidate-entries")
    _discard(counts.sparkSession, counts)
    sums = written(entries.groupBy("context").agg(F.sum("n").alias("held"), F.count("*").alias("size"), F.sum("lower").alias("lower_share"))
                   .join(candidates.select(F.col("h").alias("context"), F.col("n").alias("of")), "context").select(
        "context", "of", "size", "lower_share", "held", (F.col("of") - F.col("held")).alias("rest"),
        (F.col("of") - F.col("held") + o.backoff).alias("backoff"), (F.col("of") + o.backoff).alias("total")), "context-sums")
    own = (F.col("n") + F.col("backoff") * F.col("lower")) / F.col("total")
    gains = (entries.join(sums.select("context", "backoff", "total"), "context")
             .groupBy("context").agg(F.sum(F.col("n") * F.log(own / F.col("lower"))).alias("gain")))
    share = (F.col("held") + F.col("backoff") * F.col("lower_share")) / F.col("total")
    left = lambda x: F.greatest(1 - x, F.lit(1e-12))
    rest = F.when(F.col("rest") > 0, F.col("rest") * F.log(left(share) / left(F.col("lower_share")))).otherwise(0.0)
    price = 0.5 * F.col("size") * F.log(F.greatest(F.col("of"), F.lit(2)))
    contexts = written(sums.join(gains, "context").where(F.col("gain") + rest > price)
                       .select(F.col("context").alias("h"), F.col("of").alias("n"), "backoff", "total"), "contexts")
    gain = F.log10("p") - F.log10("lower") - F.log10(F.col("backoff") / F.col("total"))
    kept = written(entries.join(contexts.select(F.col("h").alias("context"), "backoff", "total"), "context")
                   .withColumn("p", own).select("h", "n", "p", gain.alias("gain")), "kept-entries")
    _discard(counts.sparkSession, entries, sums)
    return contexts, kept


def _fit(slices: DataFrame, o: TreeOptions) -> Model:
    """The model of the training documents among the slices."""
    words = written(word_counts(slices), "words")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    model = Model(o, words, [], int(size["n"]), int(size["v"]))
    symbols = _symbols(words, model.n_tokens, o)
    below = symbols.where(F.col("n") >= max(o.least_entry, o.next_share * model.n_tokens)).select(
        "h", F.pow(F.lit(10.0), model.log_unigram(F.col("n"))).alias("p"))
    enough = max(o.least_context, o.context_share * model.n_tokens)
    often = symbols.where(F.col("n") >= enough).select("h", "n")
    candidates, ends = often, below.select("h")
    least = max(o.least_entry, o.entry_share * model.n_tokens)
    for length in range(1, o.depth + 1):
        if candidates.isEmpty():
            break
        counts = _longer_counts(slices, length, often.select("h"), ends, least, model.n_tokens)
        _discard(slices.sparkSession)
        often = written(counts.where(F.col("n") >= enough), "often")
        contexts, entries = _grown(counts, candidates, below, o)
        if contexts.isEmpty():
            _discard(slices.sparkSession, often, contexts, entries)
            break
        model.levels.append((often, contexts, entries))
        below = entries
        # every frequent sequence one symbol longer was counted; the tree needs its suffix
        ends = entries.select("h").union(often.select("h"))
        candidates = often.join(contexts.select(F.col("h").alias("suffix")), "suffix").select("h", "n")
    return model


def train(docs: DataFrame, o: TreeOptions = TreeOptions()) -> tuple[Model, DataFrame]:
    """The model of the training documents, and the documents."""
    return _fit(encoded(docs), o), docs


def _near_from(weights: DataFrame) -> float:
    """The least n such that at most NEAR_ROWS rows have it."""
    step = F.floor(F.log2("n") * 8)
    rows, found = 0, math.inf
    for r in weights.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.min("n").alias("n")).sort(F.desc("step")).collect():
        rows += r["rows"]
        if rows > NEAR_ROWS:
            break
        found = r["n"]
    return found


SUMS = ("known", "base", "own")


def _summed(h: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct hashes, and the sums of their weights."""
    held, at = np.unique(h, return_inverse=True)
    return held, *(np.bincount(at, weights=c, minlength=len(held)) for c in columns)


def _looked_up(s: Slice, near: tuple, maybe: Bloom, longest: int) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """By document the sums of the weights in ``near``; piece by piece the hashes of the other sequences, sorted, and their documents."""
    (words, bases), (held, weight) = near
    docs = len(s.lengths)
    doc = np.repeat(np.arange(docs, dtype=np.int32), s.lengths)
    at, own = _find(words, _signed(s.words)), _find(held, _signed(s.words))
    value = [(at >= 0).astype(np.float64), np.zeros(len(at)), np.zeros(len(at))]
    value[1][at >= 0] = bases[at[at >= 0]]
    value[2][own >= 0] = weight[own[own >= 0]]
    sums, asked = [np.bincount(doc, weights=v[s.places], minlength=docs) for v in value], []
    for p in _pieces(len(doc)):
        miss = np.flatnonzero((at < 0)[s.places[p]])
        h = s.words[s.places[p][miss]]
        order = np.argsort(h, kind="stable")
        asked.append((h[order], doc[p][miss[order]]))
    places, doc = s.between_ends()
    gram, ends = s.words[places], np.ones(len(doc) + 1, bool)
    del places
    for k in range(1, longest):
        gram, before, ends = _lengthened(gram), ends, np.zeros(len(gram), bool)
        for p in _pieces(max(len(doc) - k, 0)):
            # a sequence in the tree has its suffix there
            where = p.start + np.flatnonzero((doc[p] == doc[p.start + k:p.stop + k]) & before[p.start + 1:p.stop + 1])
            where = where[maybe.has(gram[where])]
            ends[where] = True
            h = gram[where]
            order = np.argsort(h, kind="stable")
            h, of = h[order], doc[where[order]]
            at = _find(held, _signed(h))
            sums[2] += np.bincount(of[at >= 0], weights=weight[at[at >= 0]], minlength=docs)
            asked.append((h[at < 0], of[at < 0]))
    return sums, asked


def _asked_blocks(asked: list[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[dict[str, list]]:
    """Blocks of the hashes and their documents, one part of the hash space after the other."""
    starts = np.arange(1 << PART_BITS, dtype=np.uint64) << np.uint64(64 - PART_BITS)
    cuts = [np.append(np.searchsorted(h, starts), len(h)) for h, _ in asked]
    for part in range(1 << PART_BITS):
        h, of = (np.concatenate([x[i][c[part]:c[part + 1]] for x, c in zip(asked, cuts)]) for i in (0, 1))
        order = np.argsort(h, kind="stable")
        h, of = h[order], of[order]
        # ranges follow each other in order, so that only the first step of a block is large
        steps = np.diff(h, prepend=np.uint64(0))
        leading = h >> np.uint64(1) >> np.uint64(63 - bits)
        new = np.append(True, leading[1:] != leading[:-1])[:len(h)]
        steps[new] = h[new]
        yield _by_range(h, bits, {"h": steps, "doc": of.astype(np.uint32)})


ANSWERS = "first long, doc binary, known binary, base binary, own binary"


def _answered(blocks: pa.Table, far: pa.Table) -> pa.Table:
    """Of one range, for each block with anything known its documents and their sums, as one row."""
    held, *values = _summed(*(far[c].to_numpy() for c in ("h", *SUMS)))
    out = {c: [] for c in ("first", "doc", *SUMS)}
    for first, *packed in zip(*(blocks[c] for c in ("first", "h", "doc", *SUMS))):
        h, doc, *known = (x.as_buffer() for x in packed)
        if h is None:
            sums = [_unpacked(x, np.float64) for x in known]
            met = np.arange(len(sums[0]), dtype=np.uint32)
        else:
            found = _find(held, _signed(np.cumsum(_unpacked(h, np.uint64), dtype=np.uint64)))
            hit = found >= 0
            at, found = _unpacked(doc, np.uint32)[hit], found[hit]
            met = np.flatnonzero(np.bincount(at)).astype(np.uint32)
            sums = [np.bincount(at, weights=column[found])[met] for column in values]
        if len(met):
            for c, x in zip(out, (first.as_py(), _packed(met), *map(_packed, sums))):
                out[c].append(x)
    return pa.table(out, pa.schema([("first", pa.int64()), *[(c, pa.binary()) for c in ("doc", *SUMS)]]))


def _added_up(answers: pa.Table) -> pa.Table:
    """The sums of each document of one slice."""
    sums, size = np.zeros((len(SUMS), 0)), 0
    for doc, *known in zip(*(answers[c] for c in ("doc", *SUMS))):
        met = _unpacked(doc.as_buffer(), np.uint32)
        if met[-1] >= size:
            sums, size = np.pad(sums, ((0, 0), (0, int(met[-1]) + 1 - size))), int(met[-1]) + 1
        for own, x in zip(sums, known):
            own[met] += _unpacked(x.as_buffer(), np.float64)
    return pa.table({"row": answers["first"][0].as_py() + np.arange(size), **dict(zip(SUMS, sums))})


def _scores(model: Model, slices: DataFrame) -> DataFrame:
    """The unigram and the suffix-tree score (log10) of every document of the slices."""
    spark, weights = slices.sparkSession, model.weights()
    _discard(spark)
    near_from = _near_from(weights)
    near = weights.where(F.col("n") >= near_from).drop("n").toArrow()
    h, known, base, own = (near[c].to_numpy() for c in ("h", *SUMS))
    near = _summed(h[known > 0], base[known > 0]), _summed(h[known == 0], own[known == 0])
    longer = [d.select("h") for i, (_, contexts, entries) in enumerate(model.levels) for d in (contexts, entries)[not i:]]
    longer = functools.reduce(DataFrame.union, longer, model.words.select("h").limit(0))
    shared = spark.sparkContext.broadcast((near, Bloom.of(longer)))
    _discard(spark)
    longest, unknown, bits = len(model.levels) + 1, model.unknown, _range_bits(model.n_tokens)
    block = pa.schema([("range", pa.int32()), ("first", pa.int64()), *[(c, pa.binary()) for c in ("h", "doc", *SUMS)]])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One block of the sums that the worker knows, and blocks of the other sequences, each with its document."""
        near, maybe = shared.value
        for s in _slices(batches):
            sums, asked = _looked_up(s, near, maybe, longest)
            for blocks in _asked_blocks(asked, bits):
                rows = len(blocks["range"])
                yield pa.RecordBatch.from_pydict(blocks | {"first": [s.first] * rows, **{c: [None] * rows for c in SUMS}}, block)
            own = zlib.crc32(str(s.first).encode()) % (1 << bits)
            yield pa.RecordBatch.from_pydict({"range": [own], "first": [s.first], "h": [None], "doc": [None],
                                              **{c: [_packed(x)] for c, x in zip(SUMS, sums)}}, block)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, lengths in zip(*(batch.column(i).to_pylist() for i in range(3))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first + np.arange(len(ids))), pa.array(ids, pa.int64()), pa.array([held_out(i) for i in ids], pa.bool_()),
                     pa.array(_unpacked(lengths, np.int64))], names=["row", "doc_id", "held_out", "n_tokens"])

    asked = slices.mapInArrow(ask, "range int, first long, h binary, doc binary, known binary, base binary, own binary")
    # the leading bits of the hash, as in _by_range
    leading = F.shiftrightunsigned(F.shiftrightunsigned("h", 1), 63 - bits).cast("int")
    far = weights.where(F.col("n") < near_from).select(leading.alias("range"), "h", *SUMS)
    sums = (asked.groupBy("range").cogroup(far.groupBy("range"))
            .applyInArrow(_answered, ANSWERS)
            .groupBy("first").applyInArrow(_added_up, "row long, known double, base double, own double"))
    docs = slices.select("first", "ids", "lengths").mapInArrow(listed, "row long, doc_id long, held_out boolean, n_tokens long")
    base = F.col("base") + F.col("n_tokens") * F.lit(unknown)
    out = written(docs.join(sums, "row").select(
        "doc_id", "held_out", "n_tokens", F.round("known").cast("long").alias("n_known"),
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("own")).alias("score")), "scored")
    shared.destroy()
    return out


def score(model: Model, docs: DataFrame) -> DataFrame:
    """The unigram and the suffix-tree score (log10) of every document."""
    return _scores(model, encoded(docs))


def lm_report(docs: DataFrame, o: TreeOptions = TreeOptions()) -> DataFrame:
    """Scores of all documents by the tree of those that are not held out."""
    slices = encoded(docs)
    model = _fit(slices, o)
    out = _scores(model, slices)
    _discard(docs.sparkSession, slices, model.words, *[d for level in model.levels for d in level])
    return out
