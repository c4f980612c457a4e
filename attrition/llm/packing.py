"""Packing by vector bin packing with the dot-product heuristic.

Every item is a vector (tokens, segments, loss-bearing tokens) and every sequence has a limit in each dimension. One
sequence at a time is open; of the items that still fit in all dimensions, the one with the largest weighted dot
product with the remaining capacities is placed next, until none fits. A dimension weighs as much as the group's
total demand for it, in units of its limit.

Loss mask: the first line of a text with several lines is its prompt and bears no loss, nor does the first token of a piece, which
nothing predicts. The other tokens do, the end included. All three limits can bind: the loss limit is below the token
limit, so pieces of a text's body fill a sequence's loss before its tokens, and short texts fill its segments
(``usage`` counts how often).

Documents are cut into the longest pieces that keep the token and the loss limit, and a remainder. Pieces that reach one of
the two are sequences of their own; remainders are dealt evenly, by row number, into groups of at most
``rows_per_group``, and every group is packed in one task. So no task grows with the data, and at most the last
few sequences of a group stay open. Items with the same vector are counted, not listed, in the search.

Defined results: null and empty texts are one token (the end); an item beyond a limit gets a sequence of its own;
repeated rows are packed each; an empty table gives no rows. ``pack`` passes extra columns through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm import tokens
from attrition.llm.common import ship_package, written

END = 0


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 8
    loss: int = 1016

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.int64)


def fill(vectors: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the place in it of every item (a row of ``vectors``)."""
    kinds, kind_of = np.unique(vectors, axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    by_kind = np.argsort(kind_of, kind="stable")
    left = np.bincount(kind_of, minlength=len(kinds))
    following = np.concatenate([[0], np.cumsum(left)[:-1]])
    share = kinds / limits
    weight = share.T @ left
    weighted = share * (weight / max(weight.sum(), 1e-12))
    bins, places = np.empty(len(vectors), np.int64), np.empty(len(vectors), np.int64)

    def put(kind: int, bin_: int, place: int) -> None:
        item = by_kind[following[kind]]
        following[kind] += 1
        left[kind] -= 1
        bins[item], places[item] = bin_, place

    current = 0
    for kind in np.flatnonzero((kinds > limits).any(axis=1)):
        while left[kind]:
            put(kind, current, 0)
            current += 1
    while left.any():
        live = np.flatnonzero(left)  # kinds only leave while a bin is open
        free, place = limits.copy(), 0
        while True:
            live = live[(kinds[live] <= free).all(axis=1) & (left[live] > 0)]
            if not len(live):
                break
            kind = live[np.argmax(weighted[live] @ (free / limits))]
            put(kind, current, place)
            free -= kinds[kind]
            place += 1
        current += 1
    return bins, places


def pack(items: DataFrame, limits: Limits = Limits(), rows_per_group: int = 10_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to items with columns ``tokens`` and ``loss`` (both long).

    ``items`` should be a written table: the groups go by row number, which a recomputed input could change.
    """
    ship_package(items.sparkSession)
    groups = -(-items.count() // rows_per_group)
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    if not groups:
        return items.sparkSession.createDataFrame([], schema)
    capacity = limits.vector()
    names = items.columns

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["_group"].iloc[0])
        length = group["tokens"].to_numpy(np.int64)
        vectors = np.stack([length, np.ones_like(length), group["loss"].to_numpy(np.int64)], axis=1)
        bins, places = fill(vectors, capacity)
        out = group[names].copy()
        order = np.lexsort((places, bins))
        total = np.cumsum(length[order]) - length[order]
        first = np.r_[True, np.diff(bins[order]) != 0]
        offset = np.empty(len(length), np.int64)
        offset[order] = total - np.maximum.accumulate(np.where(first, total, 0))
        out["sequence_id"] = ((number << 32) + bins) * 2
        out["offset"] = offset
        return out

    dealt = items.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(packed, schema)


PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("loss", T.LongType())])
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def prompt_tokens(text: str, ids: np.ndarray, widths: np.ndarray) -> int:
    """How many ids end inside the first line (its line feed included) of a text with more than one."""
    at = text.find("\n")
    if at < 0:
        return 0
    upto = len(text[:at + 1].encode("utf-8"))
    return int(np.searchsorted(np.cumsum(widths[ids[:upto]]), upto, side="right"))


def cut_lengths(n: int, prompt: int, limits: Limits) -> Iterator[tuple[int, int, int]]:
    """(start, length, loss) of the pieces of a text of n tokens, each as long as the token and the loss limit allow."""
    start = 0
    while start < n:
        free = max(prompt - start, 1)  # without loss: the rest of the prompt, or the first token
        length = min(n - start, limits.tokens, free + limits.loss)
        yield start, length, max(0, length - free)
        start += length


def pieces(docs: DataFrame, limits: Limits, path: str, keep_ids: bool = False) -> DataFrame:
    """The documents' tokens, each text ended by id 0, cut into pieces within the token and the loss limit."""
    ship_package(docs.sparkSession)
    fields = T.StructType([*PIECE.fields, IDS]) if keep_ids else PIECE

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows: list[list] = [[] for _ in fields.fields]
                part = batch.slice(at, 500)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    text = text or ""
                    ids = np.append(enc.ids(text), np.uint32(END)).astype("<u4")
                    raw = memoryview(ids.tobytes())
                    for start, length, loss in cut_lengths(len(ids), prompt_tokens(text, ids[:-1], enc.widths), limits):
                        values = (doc_id, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), len(ids), loss)
                        for column, value in zip(rows, values):
                            column.append(value)
                        if keep_ids:
                            rows[-1].append(ids[start:start + length])
                kinds = [pa.int64()] * 6 + ([pa.list_(pa.int32())] if keep_ids else [])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=fields.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, fields)


def pack_pieces(cut: DataFrame, limits: Limits = Limits(), rows_per_group: int = 10_000) -> DataFrame:
    """``pieces`` (a written table with ``piece_id``) with ``sequence_id`` and ``offset``."""
    whole = (F.col("length") >= limits.tokens) | (F.col("loss") >= limits.loss)
    alone = (cut.where(whole).withColumn("sequence_id", F.col("piece_id") * 2 + 1)
             .withColumn("offset", F.lit(0).cast("long")))
    rest = written(cut.where(~whole).withColumn("tokens", F.col("length")), "remainders")
    return alone.unionByName(pack(rest, limits, rows_per_group).drop("tokens"))


def pack_documents(docs: DataFrame, limits: Limits = Limits(), path: str | None = None,
                   rows_per_group: int = 10_000) -> DataFrame:
    """Where every piece of every document goes: doc_id, start, length, crc, tokens, loss, sequence_id, offset."""
    cut = written(pieces(docs, limits, path or tokens.default_path())
                  .withColumn("piece_id", F.monotonically_increasing_id()), "pieces")
    return pack_pieces(cut, limits, rows_per_group).drop("piece_id")


def usage(packed: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row: the number of sequences, how many are at each limit, and the padding to the token limit (none at a power of two)."""
    load = packed.groupBy("sequence_id").agg(F.sum("length").alias("t"), F.count(F.lit(1)).alias("s"), F.sum("loss").alias("l"))
    padded = F.when(F.bit_count("t") > 1, F.lit(limits.tokens) - F.col("t")).otherwise(0)
    return load.agg(F.count(F.lit(1)).alias("sequences"), F.count_if(F.col("t") >= limits.tokens).alias("at_tokens"),
                    F.count_if(F.col("s") >= limits.segments).alias("at_segments"), F.count_if(F.col("l") >= limits.loss).alias("at_loss"),
                    F.coalesce(F.sum(padded), F.lit(0)).alias("padding"))


def sequences(docs: DataFrame, limits: Limits = Limits(), path: str | None = None,
              rows_per_group: int = 10_000) -> DataFrame:
    """The packed sequences themselves: sequence_id, input_ids and the segments (doc_id, offset, length)."""
    cut = written(pieces(docs, limits, path or tokens.default_path(), keep_ids=True)
                  .withColumn("piece_id", F.monotonically_increasing_id()), "pieces")
    placed = pack_pieces(cut.drop("ids"), limits, rows_per_group).select("piece_id", "sequence_id", "offset")
    held = placed.join(cut.select("piece_id", "doc_id", "length", "ids"), "piece_id")
    # at most limits.tokens ids and limits.segments pieces in a group
    full = held.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("p"))
    return full.select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("input_ids"),
                       F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["offset"].alias("offset"),
                                                           x["length"].alias("length"))).alias("segments"))
