"""Token ids, packing and mixing."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attrition.llm import mixing, packing, tokens
from tests.llm import brute


@pytest.fixture(scope="module")
def enc():
    return tokens.encoder(tokens.default_path())


def reference_ids(enc, text):
    return enc.exact.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(enc, rows):
    more = ["<|endoftext|>", "a<|endoftext|> b", "İ ſ K ½ ² ٣ 　  x", "\x00\x1f\x85 ", "don't I'LL 'S", "🙂👩‍👩‍👧", "a" * 3000, " " * 3000 + "x"]
    for text in [r[1] for r in rows] + more:
        assert enc.ids(text or "").tolist() == reference_ids(enc, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60))
def test_ids_equal_the_library_on_any_text(text):
    enc = tokens.encoder(tokens.default_path())
    assert enc.ids(text).tolist() == reference_ids(enc, text)
    assert enc.text(enc.ids(text)) == text


def check_pieces(out, texts, enc, size=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sorted(by_doc) == sorted(texts)
    for doc_id, text in texts.items():
        ids, at = [*reference_ids(enc, text), 0], 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
            assert (r.start, r.ids_crc32, r.doc_tokens) == (at, zlib.crc32(part), len(ids))
            at += r.length
        assert at == len(ids)
    padding = 0
    for rs in by_sequence.values():
        rs, at = sorted(rs, key=lambda r: r.offset), 0
        for r in rs:
            assert r.offset == at
            at += r.length
        assert at <= size and len(rs) <= 8 and sum(r.loss for r in rs) <= 1016
        padding += size - at if at & (at - 1) else 0
    return padding, len(by_sequence)


def test_pack_documents(docs, rows, enc):
    out = packing.pack_documents(docs, rows_per_group=100).collect()
    padding, n = check_pieces(out, {r[0]: r[1] for r in rows}, enc)
    total = sum(r.length for r in out)
    assert padding < 0.1 * total


def loads(out):
    per = defaultdict(lambda: np.zeros(3, int))
    for r in out:
        per[r.sequence_id] += (r.length, 1, r.loss)
    return np.array(list(per.values()))


def test_every_limit_binds_and_packing_by_tokens_alone_breaks_the_others(docs, spark):
    """Many short texts, long bodies and prompts: what one dimension allows, the other two forbid."""
    short = spark.createDataFrame([(20_000 + i, f"say {i}") for i in range(150)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionByName(short)
    limits = packing.Limits()
    vector = limits.vector()
    out = packing.pack_documents(both, limits).collect()
    own, plain = loads(out), loads(packing.pack_documents(both, packing.Limits(segments=10 ** 6, loss=10 ** 6)).collect())
    assert (own <= vector).all() and ((own == vector).any(axis=0)).all()
    assert (plain[:, 0] <= 1024).all() and (plain[:, 1] > 8).any() and (plain[:, 2] > 1016).any()
    row = packing.usage(packing.pack_documents(both, limits), limits).first()
    assert (row.sequences, row.at_tokens, row.at_segments, row.at_loss) == (len(own), *(own >= vector).sum(axis=0))
    power = own[:, 0] & (own[:, 0] - 1) == 0
    assert row.padding == (1024 - own[:, 0])[~power].sum()


@given(st.integers(1, 5000), st.integers(0, 5000), st.integers(2, 300), st.integers(1, 300))
def test_cuts_are_whole_and_within_the_limits(n, prompt, size, loss):
    limits = packing.Limits(tokens=size, loss=loss)
    cuts, at = list(packing.cut_lengths(n, min(prompt, n), limits)), 0
    for start, length, lost in cuts:
        bears = [i >= min(prompt, n) and i > start for i in range(start, start + length)]
        assert start == at and 0 < length <= size and lost == sum(bears) <= loss
        at += length
    assert at == n
    assert all(length == size or lost == loss for _, length, lost in cuts[:-1])


def test_prompt_is_the_first_line(enc):
    for text in ("Title line\nbody text here", "no line end", "\n\nx", "", "é ü\nß\n", "a\n"):
        ids = enc.ids(text)
        p = packing.prompt_tokens(text, ids, enc.widths)
        assert enc.widths[ids].sum() == len(text.encode())
        first = text[:text.find("\n") + 1]
        assert first.startswith(enc.text(ids[:p].tolist())) if p else True
        # the next token, if any, ends after the first line
        if first and p < len(ids):
            assert enc.widths[ids[:p + 1]].sum() > len(first.encode())
        assert p == 0 or first


def test_sequences_round_trip(docs, rows, enc):
    texts, got = {r[0]: r[1] for r in rows}, defaultdict(list)
    for r in packing.sequences(docs).collect():
        assert len(r.input_ids) <= 1024 and len(r.segments) <= 8
        for s in r.segments:
            got[s.doc_id] += r.input_ids[s.offset:s.offset + s.length]
    assert {d: len(v) for d, v in got.items()} == {d: len(reference_ids(enc, t)) + 1 for d, t in texts.items()}


def test_fill_keeps_every_limit():
    rng = np.random.default_rng(5)
    items = np.stack([rng.integers(1, 900, 800), np.ones(800, int), rng.integers(0, 400, 800)], axis=1)
    items[0], items[1] = (2000, 1, 5), (10, 1, 700)  # beyond a limit: alone
    limits = np.array([1024, 3, 500])
    bins, places = packing.fill(items, limits)
    load = np.zeros((bins.max() + 1, 3), int)
    np.add.at(load, bins, items)
    over = (load > limits).any(axis=1)
    assert over.sum() == 2 and all((bins == bins[i]).sum() == 1 for i in (0, 1))
    for b in range(bins.max() + 1):
        assert sorted(places[bins == b]) == list(range((bins == b).sum()))
    # no item of an open bin would fit into the one before together with it: bins are filled in turn
    assert load[:-1].sum(axis=0).max() <= len(load) * 1024


def test_dot_product_prefers_what_fits_the_free_space():
    # tokens are scarce, loss is not: the long item goes first, then what completes it
    bins, _ = packing.fill(np.array([[600, 1, 0], [500, 1, 0], [424, 1, 0], [400, 1, 0]]), np.array([1024, 10, 1024]))
    assert bins[0] == bins[2] and bins[1] == bins[3]


def test_packing_odd_rows(odd_docs, no_docs):
    out = packing.pack_documents(odd_docs).collect()
    per = defaultdict(int)
    for r in out:
        per[r.sequence_id] += r.length
    assert sum(r.start == 0 for r in out) == odd_docs.count() and max(per.values()) <= 1024
    assert packing.pack_documents(no_docs).collect() == []
    assert packing.sequences(no_docs).collect() == []


# ---------------------------------------------------------------- mixing
@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from([5, 2, 1])), min_size=1, max_size=12))
def test_targets(pairs):
    sizes, weights = [s for s, _ in pairs], [w for _, w in pairs]
    got = mixing.targets(sizes, weights)
    assert got == pytest.approx(brute.targets(sizes, weights, 3), rel=1e-6, abs=1e-3)
    assert sum(got) == pytest.approx(sum(sizes))


def test_targets_of_many_sources():
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 1000, 2000)
    got, wanted = mixing.targets(sizes, np.resize((5, 2, 1), 2000)), brute.targets(sizes.tolist(), [(5, 2, 1)[i % 3] for i in range(2000)], 3)
    assert got == pytest.approx(wanted, rel=1e-6, abs=1e-3)


@given(st.integers(1, 5000), st.integers(0, 2 ** 63))
@settings(max_examples=60, deadline=None)
def test_permutation(n, key):
    with np.errstate(over="ignore"):
        out = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
    assert sorted(out) == list(range(n))


def mixture(docs, **options):
    return sorted((tuple(r) for r in mixing.mixing_report(docs, **options).collect()), key=str)


def test_mixing_report(docs, rows):
    out = mixture(docs, block=16)
    sizes = {r[0]: len(brute.words(r[1])) for r in rows}
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None]
    totals = [sum(sizes[r[0]] for r in rows if r[3] == s) for s in names]
    wanted = brute.targets(totals, [(5, 2, 1)[i % 3] for i in range(len(names))], 3)
    source = {r[0]: names.index(r[3]) for r in rows}
    taken = [0] * len(names)
    assert len(out) == len(rows)
    for doc_id, size, source_size, target, got in out:
        s = source[doc_id]
        assert (size, source_size) == (sizes[doc_id], totals[s]) and target == pytest.approx(wanted[s], rel=1e-6)
        assert 0 <= got <= 3 * size
        taken[s] += got
    for t, w in zip(taken, wanted):
        assert abs(t - w) <= 0.03 * w + 64
    assert mixture(docs.repartition(3), block=16) == out
    assert mixture(docs, block=16, seed=4) != out


def test_slots_cover_blocks_evenly(docs):
    from attrition.llm.common import written
    from pyspark.sql import functions as F
    mix = mixing.Mix(written(mixing._sized(docs), "sized"), block=16, slots_per_shard=64)
    assert mix.slots.select("shard").distinct().count() > 10
    # a source's blocks are taken equally often, give or take one
    per = mix.slots.groupBy("number", "index").count().groupBy("number").agg(
        F.min("count").alias("a"), F.max("count").alias("b"), F.count("*").alias("n"))
    for r in per.join(mix.sources, "number").collect():
        assert r.b - (r.a if r.n == r.blocks else 0) <= 1 and r.b <= 3


def seen_plans(monkeypatch):
    """The plans of what mixing writes, from now on."""
    plans, write = [], mixing.written

    def written(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(mixing, "written", written)
    return plans


def broadcast_keys(plans):
    return [m for p in plans for m in re.findall(r"Broadcast\w*Join \[(.*?)\], \[", p)]


@pytest.mark.parametrize("made", [mixing.mixing_report, mixing.mixed_documents])
def test_mixing_broadcasts_only_totals(docs, monkeypatch, made):
    """An exploded table counts as no larger than the file that it is made from; broadcast, it fills the driver."""
    plans = seen_plans(monkeypatch)
    plans.append(made(docs, block=16)._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans)
    assert not [k for k in broadcast_keys(plans) if re.search(r"\b(index|place|id)#", k)]


def test_mixing_broadcasts_no_long_list_of_sources(docs, monkeypatch):
    from attrition.llm import common
    out = mixture(docs, block=16)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 2)
    plans = seen_plans(monkeypatch)
    assert mixture(docs, block=16) == out
    assert broadcast_keys([*plans, mixing.Mix(mixing._sized(docs), block=16).slots._jdf.queryExecution().executedPlan().toString()]) == []


def test_slots_are_dealt_over_tasks(docs):
    """A row of the shards' counts stands for many slots; by their bytes, all of them are one task's."""
    from attrition.llm.common import written
    from pyspark.sql import functions as F
    mix = mixing.Mix(written(mixing._sized(docs), "sized"), block=16, slots_per_shard=64)
    assert mix.slots.select(F.spark_partition_id().alias("p")).distinct().count() > 4


def test_mixed_documents(docs, rows):
    report = {r[0]: r[4] for r in mixture(docs, block=16)}
    out = mixing.mixed_documents(docs, block=16)
    assert out.columns == docs.columns
    words, texts = defaultdict(int), {r[0]: r[1] for r in rows}
    for r in out.collect():
        words[r.doc_id] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
        if len(brute.words(r.text)) == len(brute.words(texts[r.doc_id])):
            assert r.text == texts[r.doc_id]
    assert dict(words) == {d: n for d, n in report.items() if n}


def test_mixing_odd_rows(odd_docs, no_docs):
    assert len(mixture(odd_docs.select("doc_id", "text", "source"))) == odd_docs.count()
    assert mixing.mixing_report(odd_docs).count() == odd_docs.count()
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    assert mixture(no_docs) == [] and mixing.mixed_documents(no_docs).collect() == []
