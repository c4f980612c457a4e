"""The suffix tree against the same tree over dicts, and as a probability distribution."""

import dataclasses
import math
import os
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from attrition.llm import common
from attrition.llm import lm_scoring as lm
from tests.llm import brute


def prose(seed, n=140):
    """Two languages with their own words, and phrases of three words: contexts of one and two words tell."""
    rng, out = random.Random(seed), []
    phrases = [["zip", "zap", "zop"], ["zip", "zup", "zep"], ["bla", "zap", "zup"]]
    for i in range(n):
        lang, ws = "ab"[i % 2], []
        while len(ws) < rng.randint(5, 120):
            ws += rng.choice(phrases) if rng.random() < 0.3 else [f"{lang}{int(rng.paretovariate(0.8)) % 300}"]
        out.append((i, " ".join(ws)))
    return out + [(n, None), (n + 1, ""), (n + 2, "never seen words here"), (n + 3, "Zip ZAP zop")]


OPTIONS = lm.TreeOptions(symbol_share=1e-3, context_share=5e-3, next_share=2e-3, entry_share=3e-4)


@pytest.fixture(scope="module")
def scored(spark):
    rows = prose(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return rows, {r.doc_id: r for r in lm.lm_report(docs, OPTIONS).collect()}


def test_scores_equal_the_plain_tree(scored):
    rows, got = scored
    tree = brute.SuffixTree(rows, OPTIONS)
    assert {len(c) for c in tree.states} >= {0, 1, 2}
    for doc_id, text in rows:
        n, known, base, score = tree.score(text, OPTIONS.depth)
        r = got[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, tree.n, zlib.crc32(str(doc_id).encode()) % 5 == 1)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-7)


def compare(spark, rows, options):
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in
                 lm.lm_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), options).collect())
    tree = brute.SuffixTree(rows, options)
    for (doc_id, text), r in zip(sorted(rows, key=lambda r: r[0]), got):
        n, known, base, score = tree.score(text, options.depth)
        assert r[:3] == (doc_id, n, known)
        assert r[3] == pytest.approx(base, rel=1e-9) and r[4] == pytest.approx(score, rel=1e-7)
    return tree


def test_registered_defaults_equal_the_plain_tree(spark):
    """Also a very long text."""
    rng, rows = random.Random(8), prose(5, 220)
    for i in range(8):
        ws = []
        while len(ws) < 400:
            ws.append(rng.choice("abcdefgw"))
            if rng.random() < 0.25:
                ws += ["s", "t" if ws[-1] == "w" else "u"]
        rows.append((1000 + i, " ".join(ws)))
    rows.append((2000, " ".join(rng.choice([f"a{rng.randrange(300)}", "zip zap zop", "w s t"]) for _ in range(30_000))))
    tree = compare(spark, rows, lm.TreeOptions())
    assert {len(c) for c in tree.states} >= {0, 1, 2}


@pytest.mark.parametrize("options", [dict(least_context=4), dict(least_context=3, least_entry=3, least_symbol=4, backoff=0.5), dict(depth=1)])
def test_other_counts_equal_the_plain_tree(spark, options):
    compare(spark, prose(11, 120), lm.TreeOptions(**options))


def test_better_than_unigrams_on_held_out(scored):
    _, got = scored
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_every_distribution_sums_to_one(spark):
    docs = spark.createDataFrame(prose(7), "doc_id long, text string")
    model, _ = lm.train(docs, OPTIONS)
    tree, size = model.tree, len(model.tree.log_root)
    assert sum(10.0 ** tree.log_root) == pytest.approx(1)
    assert len(tree.levels) >= 2
    rng = np.random.default_rng(1)
    for _ in range(30):
        before = rng.integers(1, size, 4)
        p = [tree.probabilities(np.append(before, s))[-1] for s in range(size)]
        assert sum(p) == pytest.approx(1)


def test_few_or_no_training_documents(spark, no_docs, odd_docs):
    assert lm.lm_report(no_docs).collect() == []
    only = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    r = lm.lm_report(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (3, 0, 0, True)
    assert r.base_score == pytest.approx(3 * math.log10(0.5 / 0.5)) and not math.isnan(r.score)
    assert lm.lm_report(odd_docs).count() == odd_docs.count()


def test_depth_zero_is_the_unigram_model(spark):
    docs = spark.createDataFrame(prose(3), "doc_id long, text string")
    for r in lm.lm_report(docs, dataclasses.replace(OPTIONS, depth=0)).collect():
        assert r.score == pytest.approx(r.base_score)


def context_hashes(model, length):
    return {r.h for r in model.levels[length - 1][1].collect()}


def hash_of(text):
    words = len(text.split())
    return int(lm._sequences([text], lm._WordHashes(), words)[1][words - 1].view("int64")[1])


def test_contexts_are_kept_by_their_own_count_whatever_the_corpus_size(spark):
    filler = [(i, " ".join(f"f{j % 997}" for j in range(i, i + 20_000))) for i in range(30)]
    some = [(1000 + i, "zip zap zop") for i in range(400)]
    some = [r for r in some if not lm.held_out(r[0])][:20]  # 20 times among more than 400,000 tokens
    held = next(i for i in range(2000, 2100) if lm.held_out(i))
    docs = spark.createDataFrame(filler + some + [(held, "zip zap zop")], "doc_id long, text string").repartition(4)
    model, _ = lm.train(docs)
    assert model.n_tokens > 400_000
    assert hash_of("zip") in context_hashes(model, 1)
    r = lm.score(model, docs).where(f"doc_id = {held}").first()
    assert r.score > r.base_score + 5


def test_scores_do_not_depend_on_what_the_workers_hold(spark, scored, monkeypatch):
    rows, got = scored
    monkeypatch.setattr(lm, "NEAR_ROWS", 0)  # all weights meet the texts in the join
    monkeypatch.setattr(lm, "FILTER_WORDS", 1)  # a full filter
    for r in lm.lm_report(spark.createDataFrame(rows, "doc_id long, text string"), OPTIONS).collect():
        assert r.n_known == got[r.doc_id].n_known
        assert (r.base_score, r.score) == pytest.approx((got[r.doc_id].base_score, got[r.doc_id].score), rel=1e-9)


def test_a_context_needs_its_suffix_only(spark):
    rng, rows = random.Random(3), []
    for i in range(6):
        ws = []
        while len(ws) < 150:
            ws.append(rng.choice("abcdefgw"))
            if rng.random() < 0.25:
                ws += ["s", "t" if ws[-1] == "w" else "u"]
        rows.append((i, " ".join(ws)))
    model, _ = lm.train(spark.createDataFrame(rows, "doc_id long, text string"), lm.TreeOptions(least_context=4))
    one, two = context_hashes(model, 1), context_hashes(model, 2)
    assert hash_of("s") in one and hash_of("w") not in one  # what follows w is as after any word, but for w s
    assert hash_of("w s") in two


def test_scores_do_not_depend_on_slices_and_ranges(spark, scored, monkeypatch):
    rows, got = scored
    monkeypatch.setattr(lm, "SLICE_TOKENS", 200)
    monkeypatch.setattr(lm, "RANGE_ROWS", 300)
    monkeypatch.setattr(lm, "NEAR_ROWS", 50)  # some weights with the workers, some not
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert lm.encoded(docs).count() > 10
    for r in lm.lm_report(docs, OPTIONS).collect():
        assert r.n_known == got[r.doc_id].n_known
        assert (r.base_score, r.score) == pytest.approx((got[r.doc_id].base_score, got[r.doc_id].score), rel=1e-9)


def test_a_report_leaves_no_other_table_on_disk(spark, monkeypatch):
    paths = []

    def written(df, name):
        out = common.written(df, name)
        paths.extend({os.path.dirname(f.removeprefix("file:").replace("//", "")) for f in out.inputFiles()})
        return out

    monkeypatch.setattr(lm, "written", written)
    out = lm.lm_report(spark.createDataFrame(prose(4), "doc_id long, text string"), OPTIONS)
    assert [os.path.basename(p).split("-")[0] for p in paths if os.path.exists(p)] == ["scored"]
    assert out.count() == len(prose(4))


@pytest.mark.parametrize("bits", [0, 3, 7])
def test_a_slice_is_asked_in_little_more_memory_than_its_requests(bits):
    rng, docs, longest = np.random.default_rng(4), 700, 4
    words = np.append(np.uint64(lm.END), rng.integers(0, 1 << 63, 40_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    lengths = rng.integers(1, 1500, docs)
    places = rng.integers(1, len(words), lengths.sum()).astype(np.uint32)
    places[np.cumsum(lengths) - 1] = 0
    s = lm.Slice(0, list(range(docs)), lengths, places, words)
    some = np.sort(words[:100].view(np.int64))
    near = (some, np.ones(100)), (some[:0], np.zeros(0))
    maybe = lm.Bloom(np.full(64, ~np.uint64(0)))  # lets all through

    tracemalloc.start()
    sums, asked = lm._looked_up(s, near, maybe, longest)
    for _ in lm._asked_blocks(asked, bits):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 * len(places)  # a request is 12 bytes; there are nearly 4 for each token

    symbols, doc = s.between_ends()
    grams, inside = lm._grams(words[symbols], doc, longest)
    known = np.isin(words[places].view(np.int64), some)
    want = [(words[places][~known], np.repeat(np.arange(docs), lengths)[~known]), *[(g[i], doc[i]) for g, i in zip(grams[1:], inside[1:])]]
    h, of = (np.concatenate(c) for c in zip(*want))
    got = [[], []]
    for blocks in lm._asked_blocks(asked, bits):
        for r, steps, at in zip(blocks["range"], blocks["h"], blocks["doc"]):
            own = np.cumsum(lm._unpacked(steps, np.uint64), dtype=np.uint64)
            assert set((own >> np.uint64(1) >> np.uint64(63 - bits)).tolist()) == {r}
            got[0].append(own)
            got[1].append(lm._unpacked(at, np.uint32))
    got = [np.concatenate(c) for c in got]
    assert all((a[np.lexsort((got[1], got[0]))] == b[np.lexsort((of, h))]).all() for a, b in zip(got, (h, of)))
    assert sums[0].tolist() == np.bincount(np.repeat(np.arange(docs), lengths)[known], minlength=docs).tolist()


def test_a_range_answers_a_row_for_each_block_and_not_for_each_document():
    far = pa.table({"h": [5, 9, 9, 40], "known": [1.0, 0.0, 0.0, 1.0], "base": [2.0, 0.0, 0.0, 3.0], "own": [0.0, 0.25, 0.5, 0.0]})

    def asked(first, pairs):
        h, doc = (np.array(x, np.uint64) for x in zip(*sorted(pairs)))
        return {"first": first, "h": lm._packed(np.diff(h, prepend=np.uint64(0))), "doc": lm._packed(doc.astype(np.uint32)), **dict.fromkeys(lm.SUMS)}

    own = [lm._packed(np.array(x, np.float64)) for x in ([4] * 500, [-1] * 500, [0] * 500)]
    rows = [asked(1000, [(9, d) for d in range(500)] + [(5, 3), (5, 3), (40, 499), (41, 7)]), asked(7000, [(6, 0), (8, 1)]),
            {"first": 1000, "h": None, "doc": None, **dict(zip(lm.SUMS, own))}, asked(1000, [(40, 3)])]
    types = pa.schema([("first", pa.int64()), *[(c, pa.binary()) for c in ("h", "doc", *lm.SUMS)]])
    got = lm._answered(pa.Table.from_pylist(rows, types), far)
    assert got["first"].to_pylist() == [1000, 1000, 1000]  # nothing is known of the other slice's
    sums = lm._added_up(got).to_pylist()
    assert [r["row"] for r in sums] == list(range(1000, 1500))
    assert sums[3] == {"row": 1003, "known": 7.0, "base": 6.0, "own": 0.75}
    assert sums[499] == {"row": 1499, "known": 5.0, "base": 2.0, "own": 0.75}
    assert sums[0] == {"row": 1000, "known": 4.0, "base": -1.0, "own": 0.75}
