r"""Chat formatting over a prefix tree: turns that conversations share at their start are emitted once.

Template: each turn is ``<s>role``, a newline, the text and ``</s>``. Inside roles and texts ``<``, ``[`` and the
backslash are followed by a backslash, so no control string of the template, and no special token of the vocabulary,
can come from a text; in roles newlines are written ``[n``. Both are undone exactly by ``unescaped``. Header, text and
end of a turn are tokenized apart, so equal turns have equal tokens and the loss mask falls on whole tokens.

A node of the tree is a turn with all turns before it (a chained 128-bit hash). Conversations of one tree, those with
the same first turn, are sorted by their paths, which is depth-first order. Every node belongs to the first
conversation in that order that passes through it, and each conversation emits the tokens of its own nodes, its run,
right after the runs before it. Per run the result has its place in the tree's sequence, the position id of its
first token (the tokens of its ancestors, whoever emitted them), and the intervals of the sequence that hold those
ancestors; a token attends to these and to its own run up to itself. Runs that are empty repeat a conversation.

All tables: runs, places and intervals come from sorts by range, pre-aggregated owners, and joins on written tables,
so a first turn that a third of all conversations share is spread over tasks. Only the turns of one conversation are
together in a task, read in order, as its digest needs them anyway.

Defined results: a null role or text is empty; turns are ordered by turn, then role and text, and repeated rows are
turns of their own; rows without conv_id form one conversation; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import tokens
from attrition.llm.common import ranked, ship_package, written

# The template.
TURN, AFTER_ROLE, END = "<s>", "\n", "</s>"
LOSS_ROLE = "assistant"


def escaped(text: str) -> str:
    return re.sub(r"([<\[\\])", r"\1\\", text)


def unescaped(text: str) -> str:
    return re.sub(r"([<\[\\])\\", r"\1", text)


def escaped_role(role: str) -> str:
    return escaped(role).replace("\n", "[n")


def unescaped_role(role: str) -> str:
    return unescaped(role.replace("[n", "\n"))


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for turn in text.split(END)[:-1]:
        header, _, body = turn.partition(AFTER_ROLE)
        turns.append((unescaped_role(header.removeprefix(TURN)), unescaped(body)))
    return turns


def _turns(conversations: DataFrame, path: str) -> DataFrame:
    """Per turn: its conversation and number, node, tokens, the tokens before it and the mask; ``path`` on the last turn."""
    names = ["key", "conv_id", "k", "node", "position", "length", "ids", "loss_from", "loss_to", "path"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(),
             pa.int64(), pa.list_(pa.binary())]

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        rows: list[list] = []
        key, node, k, position, nodes = None, b"", 0, 0, []

        def batch_of(some: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), kinds)], names=names)

        for batch in batches:
            for k_, conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "conv_id", "role", "text"))):
                if k_ != key:
                    if rows:
                        rows[-1][-1] = nodes
                    key, node, k, position, nodes = k_, b"", 0, 0, []
                if len(rows) >= 500:
                    yield batch_of(rows)
                    rows = []
                head = enc.ids(TURN + escaped_role(role) + AFTER_ROLE)
                body, tail = enc.ids(escaped(text)), enc.ids(END)
                ids = np.concatenate([head, body, tail]).astype(np.int32)
                said = f"{len(role.encode())}:{role}{text}".encode()
                node = hashlib.blake2b(node + said, digest_size=16).digest()
                nodes.append(node)
                at = (len(head), len(head) + len(body)) if role == LOSS_ROLE else (0, 0)
                rows.append([key, conv_id, k, node, position, len(ids), ids, *at, None])
                k, position = k + 1, position + len(ids)
        if rows:
            rows[-1][-1] = nodes
            yield batch_of(rows)

    said = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("key"), F.col("conv_id").cast("long"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = said.repartition("key").sortWithinPartitions("key", "turn", "role", "text")
    return ordered.mapInArrow(chain, "key string, conv_id long, k long, node binary, position long, length long, "
                                     "ids array<int>, loss_from long, loss_to long, path array<binary>")


def prefix_tree(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """One row per conversation, its run in the sequence of its tree.

    ``tree``, ``run`` (the conversation's key), ``conv_id``, ``start`` and ``length`` in the tree's sequence,
    ``position`` of its first token, ``input_ids``, ``loss`` (intervals of the sequence), ``ancestors`` (intervals of
    the sequence that the run attends to besides itself, in order, with the run that holds them).
    """
    ship_package(conversations.sparkSession)
    turns = written(_turns(conversations, path or tokens.default_path()), "turns")
    convs = turns.where("path is not null").select("key", "conv_id", F.get("path", F.lit(0)).alias("tree"), "path")
    order = written(ranked(convs, ["tree"], ["path", "key"], name="paths").drop("path"), "order")
    steps = turns.select("key", "k", "node", "position", "length").join(order.select("key", "tree", "rank"), "key")
    steps = written(steps, "steps")
    owners = written(steps.groupBy("node").agg(F.min(F.struct("rank", F.col("key").alias("owner"))).alias("first"))
                     .select("node", "first.owner"), "owners")
    # one row for each conversation and run that its path goes through
    through = written(steps.join(owners, "node").groupBy("key", "owner").agg(
        F.min("position").alias("from"), F.max(F.col("position") + F.col("length")).alias("to")), "through")
    own = through.where(F.col("key") == F.col("owner")).select(
        F.col("key").alias("own"), F.col("from").alias("own_from"), F.col("to").alias("own_to"))
    runs = (order.join(own, F.col("key") == F.col("own"), "left")
            .withColumn("length", F.coalesce(F.col("own_to") - F.col("own_from"), F.lit(0)))
            .withColumnRenamed("rank", "place").select("key", "conv_id", "tree", "place", "length", "own_from"))
    runs = written(ranked(runs, ["tree"], ["place"], value="length", name="runs").withColumnRenamed("before", "start")
                   .drop("rank", "place"), "runs")
    holds = runs.select(F.col("key").alias("owner"), (F.col("start") - F.col("own_from")).alias("shift"))
    held = (through.join(holds, "owner").groupBy("key").agg(
        F.max("to").alias("total"), F.sort_array(F.collect_list(F.struct(
            "from", (F.col("from") + F.col("shift")).alias("start"), (F.col("to") + F.col("shift")).alias("end"),
            F.col("owner").alias("run")))).alias("intervals")))
    mine = (turns.join(owners, "node").where(F.col("key") == F.col("owner")).groupBy("key")
            .agg(F.sort_array(F.collect_list(F.struct("k", "position", "ids", "loss_from", "loss_to"))).alias("nodes")))
    mine = mine.withColumnRenamed("key", "own")
    shift = F.col("start") - F.col("own_from")
    loss = F.transform(F.filter("nodes", lambda x: x["loss_to"] > x["loss_from"]), lambda x: F.struct(
        (x["position"] + x["loss_from"] + shift).alias("start"), (x["position"] + x["loss_to"] + shift).alias("end")))
    joined = runs.join(held, "key").join(mine, F.col("key") == F.col("own"), "left")
    none = F.array().cast("array<int>")
    return joined.select(
        F.lower(F.hex("tree")).alias("tree"), F.col("key").alias("run"), "conv_id", "start", "length",
        F.coalesce(F.col("own_from"), F.col("total")).alias("position"),
        F.coalesce(F.flatten(F.transform("nodes", lambda x: x["ids"])), none).alias("input_ids"),
        F.coalesce(loss, F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("loss"),
        F.transform(F.filter("intervals", lambda x: x["run"] != F.col("key")), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), x["run"].alias("run"))).alias("ancestors"))


def read_back(runs: DataFrame, path: str | None = None) -> DataFrame:
    """The conversations, decoded from a written ``prefix_tree``: digests of their turns and of the text under the mask."""
    ship_package(runs.sparkSession)
    file = path or tokens.default_path()
    whole = F.array(F.struct(F.col("start"), (F.col("start") + F.col("length")).alias("end"), F.col("run").alias("run")))
    needed = runs.select("run", "conv_id", F.posexplode(F.concat("ancestors", whole)).alias("i", "x")).select(
        F.col("run").alias("reader"), "conv_id", "i", F.col("x.start").alias("from"), F.col("x.end").alias("to"), F.col("x.run").alias("run"))
    parts = needed.join(runs.select("run", "start", "input_ids", "loss"), "run").select(
        "reader", "conv_id", "i",
        F.slice("input_ids", (F.col("from") - F.col("start") + 1).cast("int"), (F.col("to") - F.col("from")).cast("int")).alias("ids"),
        F.transform(F.filter("loss", lambda x: (x["start"] >= F.col("from")) & (x["end"] <= F.col("to"))), lambda x: F.struct(
            (x["start"] - F.col("from")).alias("from"), (x["end"] - F.col("from")).alias("to"))).alias("loss"))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(file)
        reader, conv, formatted, under = None, None, [], []
        rows: list[tuple] = []

        def finished() -> tuple:
            text, masked = "".join(formatted), "".join(under)
            turns = parsed(text)
            said = "".join(f"{role}\n{body}\n" for role, body in turns)
            return (conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(masked),
                    hashlib.sha256(masked.encode()).hexdigest(), len(text))

        def out() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        started = False
        for batch in batches:
            for r, c, ids, loss in zip(*(batch.column(n).to_pylist() for n in ("reader", "conv_id", "ids", "loss"))):
                if started and r != reader:
                    rows.append(finished())
                    formatted, under = [], []
                    if len(rows) >= 1000:
                        yield out()
                        rows = []
                reader, conv, started = r, c, True
                formatted.append(enc.text(ids))
                under += [unescaped(enc.text(ids[x["from"]:x["to"]])) for x in loss]
        if started:
            rows.append(finished())
            yield out()

    ordered = parts.repartition("reader").sortWithinPartitions("reader", "i").select("reader", "conv_id", "ids", "loss")
    return ordered.mapInArrow(decode, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
