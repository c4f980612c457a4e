"""The n-gram join against comparing every pair."""

import random
from itertools import combinations

import pytest
from pyspark.sql import Row

from attrition.llm import ngram_join
from tests.llm import brute


def joined(docs, o):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked_components(docs, o).collect())


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
def test_components(docs, rows, n, percent):
    some = [(d, t) for d, t, *_ in rows]
    want = [(d, *c) for (d, _), c in zip(some, brute.components(some, n, percent))]
    assert joined(docs, ngram_join.JoinOptions(n=n, percent=percent)) == want
    assert len({c for *_, c in want}) < len(want) - 60


def edited(rng, ws, k):
    ws = list(ws)
    for _ in range(k):
        ws[rng.randrange(len(ws))] = f"e{rng.randrange(10 ** 6)}"
    return ws


@pytest.mark.parametrize("seed", [1, 2])
def test_links_near_the_threshold_and_many_rounds(spark, seed):
    """Chains, stars and large buckets of texts that share passages without being similar."""
    rng = random.Random(seed)
    texts, passage = [], [f"p{i}" for i in range(40)]
    for _ in range(12):
        ws = [f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randint(20, 120))]
        for _ in range(6):
            texts.append(ws)
            ws = edited(rng, ws, rng.randint(0, 2))
    for _ in range(90):  # mostly a shared passage
        texts.append(passage + [f"x{rng.randrange(10 ** 6)}" for _ in range(rng.randint(2, 30))])
    for _ in range(80):  # one large group
        texts.append(edited(rng, [f"g{i}" for i in range(100)], rng.randint(0, 3)))
    rng.shuffle(texts)
    some = [(i, " ".join(ws)) for i, ws in enumerate(texts)]
    docs = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
    want = [(d, *c) for (d, _), c in zip(some, brute.components(some, 4, 85))]
    for options in ({}, {"small": 3, "fragments": 3}, {"frequent": 0.5}, {"frequent": 0.001, "small": 5}):
        assert joined(docs, ngram_join.JoinOptions(n=4, percent=85, **options)) == want


def test_exactly_on_the_threshold(spark):
    # 17 of 20 shingles in common: 100 * 17 = 85 * 20; then one word fewer in common
    base = [f"w{i}" for i in range(23)]
    other = base[:20] + ["a", "b", "c"]
    for a, b, linked in ((base, base[:20], True), (base, other, False)):
        docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
        inter, union = len(brute.shingles(" ".join(a), 4) & brute.shingles(" ".join(b), 4)), len(
            brute.shingles(" ".join(a), 4) | brute.shingles(" ".join(b), 4))
        assert (100 * inter >= 85 * union) == linked
        got = joined(docs, ngram_join.JoinOptions(n=4, percent=85))
        assert (got[1][2] == 1) == linked


def test_ngram_sets_equal_word_tuples():
    rng = random.Random(4)
    hashes = ngram_join._WordHashes()
    for n in (1, 4, 5, 9):
        for _ in range(60):
            text = " ".join(rng.choice(["a", "B", "ç", "d"]) for _ in range(rng.randint(0, 30)))
            assert len(ngram_join.ngram_set(text, n, hashes)) == len(brute.shingles(text, n))
    sets = [ngram_join.ngram_set(t, 4, hashes) for t in ("a b", "a b c", "a b c d", "b a")]
    assert all(set(x.tolist()).isdisjoint(y.tolist()) for x, y in combinations(sets, 2))


@pytest.mark.parametrize("n,percent", [(4, 85), (3, 50)])
def test_join_odd_rows(odd_docs, no_docs, n, percent):
    o = ngram_join.JoinOptions(n=n, percent=percent)
    rows = [tuple(r)[:2] for r in odd_docs.collect()]
    want = [(d, *c) for (d, _), c in zip(rows, brute.components(rows, n, percent))]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.linked_components(odd_docs, o).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = ngram_join.keep_one(odd_docs, o)
    assert kept.columns == odd_docs.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, one_of_each(odd_docs, n, percent)))
    assert ngram_join.linked_components(no_docs).collect() == [] and ngram_join.keep_one(no_docs).collect() == []


def one_of_each(df, n, percent):
    """The (doc_id, text) rows that stay: of each component the row with the smallest id; texts without words all."""
    rows = df.select("doc_id", "text", ngram_join._row_hash().alias("h")).collect()
    numbered = [(i, r.text) for i, r in enumerate(rows)]
    first, out = {}, []
    for (i, text), (size, c) in zip(numbered, brute.components(numbered, n, percent)):
        r = rows[i]
        if not size:
            out.append(r)
        elif c not in first or rank(r) < rank(first[c]):
            first[c] = r
    return [Row(doc_id=r.doc_id, text=r.text) for r in out + list(first.values())]


def rank(r):
    return (r.doc_id is None, r.doc_id or 0, r.h)


def texts_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_an_unrelated_row_with_a_dropped_id_stays(spark):
    base = [f"w{i}" for i in range(60)]
    near = " ".join(base[:59] + ["other"])
    other = " ".join(f"u{i}" for i in range(60))
    kept = ngram_join.keep_one(texts_of(spark, [(1, " ".join(base)), (2, near), (2, other)]))
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(1, " ".join(base)), (2, other)}


def test_a_text_without_id_links_two_others(spark):
    ws = [f"w{i}" for i in range(104)]
    a, b, c = (" ".join(ws[k:k + 80]) for k in (0, 10, 20))  # 67 and 57 of 87 and 97 five-word shingles
    o = ngram_join.JoinOptions(n=5, percent=75)
    for bridge in (None, 4):
        out = ngram_join.linked_components(texts_of(spark, [(7, a), (bridge, b), (9, c)]), o).collect()
        name = 7 if bridge is None else 4
        assert {(r.doc_id, r.component_id) for r in out} == {(7, name), (bridge, name), (9, name)}
        assert [r.doc_id for r in ngram_join.keep_one(texts_of(spark, [(7, a), (bridge, b), (9, c)]), o).collect()] == [name]
    none = ngram_join.linked_components(texts_of(spark, [(None, a), (None, b), (3, "x y")]), o).collect()
    assert {(r.doc_id, r.component_id) for r in none} == {(None, None), (3, 3)}
    assert ngram_join.keep_one(texts_of(spark, [(None, a), (None, b), (None, a), (3, None), (3, None)]), o).count() == 3


def test_equal_rows_leave_one(spark):
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(5, base)] * 4 + [(8, base)] * 2 + [(5, "alone in its component, twice with the same id")] * 2 + [(6, "")] * 2
    kept = ngram_join.keep_one(texts_of(spark, rows).repartition(3)).collect()
    assert sorted(map(tuple, kept)) == sorted([(5, base), (5, rows[6][1]), (6, ""), (6, "")])


def test_slices_by_length_and_salts_change_nothing(spark, docs, rows, monkeypatch):
    some = [(d, t) for d, t, *_ in rows]
    want = [(d, *c) for (d, _), c in zip(some, brute.components(some, 4, 85))]
    monkeypatch.setattr(ngram_join, "SALTED", 3)
    real = ngram_join._slices
    monkeypatch.setattr(ngram_join, "_slices", lambda batches, rows=7, size=2000: real(batches, 7, 2000))
    assert joined(docs, ngram_join.JoinOptions(n=4, percent=85)) == want


def test_keep_one(docs, rows):
    some = [(d, t) for d, t, *_ in rows]
    want = {d for (d, _), (_, c) in zip(some, brute.components(some, 5, 80)) if d == c}
    assert {r.doc_id for r in ngram_join.keep_one(docs).select("doc_id").collect()} == want
