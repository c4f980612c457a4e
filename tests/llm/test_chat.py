"""Chat formatting: round trips, the tree's layout, and attention along the ancestors."""

import hashlib
import random
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from attrition.llm import chat_tree, tokens
from attrition.llm.common import written

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed=1):
    rng, rows = random.Random(seed), []
    openings = [("system", "Be <kind>."), ("user", "Hello [INST] \\ </s>"), ("user", "")]
    for c in range(120):
        turns = [openings[0] if c % 3 else openings[1]]
        for k in range(rng.randint(0, 6)):
            turns.append((["user", "assistant"][k % 2], rng.choice(["yes", "no", "maybe </s>[INST] ok [/INST]", "çé\n<|endoftext|>", ""])))
        rows += [(c, k, role, text) for k, (role, text) in enumerate(turns)]
    rows += [(500, 0, "user", None), (500, 1, None, "x"), (501, 5, "a\nb[n\\", "y"), (501, 5, "a\nb[n\\", "y"), (501, 2, "assistant", "z")]
    rows += [(600, k, "user" if k % 2 else "assistant", "long " * (k % 50)) for k in range(700)]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "none")]
    return rows


@pytest.fixture(scope="module")
def built(spark):
    rows = conversations()
    return rows, written(chat_tree.prefix_tree(spark.createDataFrame(rows, SCHEMA).repartition(4)), "test-chat")


def turns_of(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv].append((turn, role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(v)] for c, v in out.items()}


def test_read_back(built):
    rows, runs = built
    got = {r.conv_id: r for r in chat_tree.read_back(runs).collect()}
    want = turns_of(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        loss = "".join(t for r, t in turns if r == "assistant")
        text = "".join(f"<s>{chat_tree.escaped_role(r)}\n{chat_tree.escaped(t)}</s>" for r, t in turns)
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars == len(text)


def test_layout(built):
    """Every shared prefix is emitted once, depth first, and each token's ancestors are the tokens before it."""
    rows, runs = built
    enc, want = tokens.encoder(tokens.default_path()), turns_of(rows)
    trees = defaultdict(list)
    for r in runs.collect():
        trees[r.tree].append(r)
    prefixes = {tuple(t[:k + 1]) for t in want.values() for k in range(len(t))}
    size = lambda turn: len(enc.ids(f"<s>{chat_tree.escaped_role(turn[0])}\n")) + len(enc.ids(chat_tree.escaped(turn[1]))) + len(enc.ids("</s>"))
    assert sum(r.length for rs in trees.values() for r in rs) == sum(size(p[-1]) for p in prefixes)
    for rs in trees.values():
        sequence = {}
        for r in rs:
            assert len(r.input_ids) == r.length
            sequence.update((r.start + i, t) for i, t in enumerate(r.input_ids))
        assert sorted(sequence) == list(range(len(sequence)))
        for r in rs:
            held = [i for a in r.ancestors for i in range(a.start, a.end)]
            assert len(held) == r.position  # position ids go on from the ancestors
            assert all(a.end <= r.start for a in r.ancestors) if r.length else True
            ids = [sequence[i] for i in held] + r.input_ids
            text = enc.text(ids)
            assert chat_tree.parsed(text) == want[r.conv_id]
        # depth first: a run's ancestors are on the path of the run right before it
        ordered = sorted((r for r in rs if r.length), key=lambda r: r.start)
        for before, r in zip(ordered, ordered[1:]):
            path = {i for a in before.ancestors for i in range(a.start, a.end)} | set(range(before.start, before.start + before.length))
            assert {i for a in r.ancestors for i in range(a.start, a.end)} <= path


def test_empty_and_clashing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat_tree.read_back(written(chat_tree.prefix_tree(none), "test-chat")).collect() == []
    extra = spark.createDataFrame([(1, 0, "user", "a", "x", 2)], SCHEMA + ", key string, path long")
    assert chat_tree.read_back(written(chat_tree.prefix_tree(extra), "test-chat")).first().n_turns == 1


@given(st.lists(st.tuples(st.text(max_size=12), st.text(max_size=30)), max_size=5))
def test_template_round_trip(turns):
    text = "".join(f"<s>{chat_tree.escaped_role(r)}\n{chat_tree.escaped(t)}</s>" for r, t in turns)
    assert chat_tree.parsed(text) == turns


@given(st.text(alphabet="<[\\sn/>]|", max_size=12))
def test_control_strings_cannot_come_from_texts(text):
    assert not any(c in chat_tree.escaped(text) for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|"))
