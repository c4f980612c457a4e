"""Periodic runs against a brute-force version that tries every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from attrition.llm import periodic_runs as pr
from attrition.llm.periodic_runs import RunOptions
from tests.llm.conftest import DOCS


def plain_runs(ws, least=6, exponent=4):
    """(start, length, period): maximal stretches of every period, without those that have a smaller one."""
    n, seen = len(ws), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, exponent * q):
                seen.setdefault((i, length), q)
            i = j
    return sorted((s, n, q) for (s, n), q in seen.items())


def found_in(texts, **o):
    n, runs, kept = pr._collapsed(texts, RunOptions(**o))
    return [[(r["start"], r["length"], r["period"]) for r in rs] for rs in runs], kept


def plain_collapse(ws, runs):
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(ws) if k not in drop)


def periodic_text(rng):
    """Repetitions inside repetitions, with errors, over few words."""
    ws = []
    for _ in range(rng.randint(1, 6)):
        block = [rng.choice("abcde"[:rng.randint(1, 5)]) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.5:
            inner = [rng.choice("ab") for _ in range(rng.randint(1, 3))] * rng.randint(2, 9)
            block = block[:rng.randint(0, len(block))] + inner
        ws += (block * rng.randint(1, 9))[:rng.randint(1, 260)]
        if rng.random() < 0.3:
            ws[rng.randrange(len(ws))] = "z"
    return " ".join(ws)


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [periodic_text(rng) for _ in range(60)] + [None, "", " \n", "a", "a a a a a", "a a a a a a", "ab " * 8]
    texts += ["x " * rng.randint(1, 400), "a b " * rng.randint(1, 100)]
    runs, kept = found_in(texts)
    for text, mine, left in zip(texts, runs, kept):
        ws = (text or "").split()
        assert mine == plain_runs(ws)
        assert left == plain_collapse(ws, mine)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=4))
def test_runs_of_any_two_letter_sequence(letters):
    texts = [" ".join(x) for x in letters]
    assert found_in(texts)[0] == [plain_runs(t.split()) for t in texts]


def test_structured_sequences():
    """Sequences on which weak hashes collide and which are dense in repetitions."""
    thue = "".join("01"[bin(i).count("1") % 2] for i in range(1024))
    fib = ["a", "ab"]
    while len(fib[-1]) < 1000:
        fib.append(fib[-1] + fib[-2])
    period = "abaababa"
    texts = [" ".join(x) for x in (thue, fib[-1], period * 40, "a" * 500 + "b" + "a" * 500, ("a" * 30 + "b") * 12, (period * 5 + "c") * 6)]
    assert found_in(texts)[0] == [plain_runs(t.split()) for t in texts]


def test_other_thresholds_and_one_text_at_a_time():
    rng = random.Random(9)
    texts = [periodic_text(rng) for _ in range(20)]
    assert found_in(texts, least_length=12, exponent=6)[0] == [plain_runs(t.split(), 12, 6) for t in texts]
    assert found_in(texts)[0] == [found_in([t])[0][0] for t in texts]
    with pytest.raises(ValueError):
        RunOptions(exponent=3)


def test_long_text_with_a_long_period():
    rng = np.random.default_rng(4)
    block = [f"w{x}" for x in rng.integers(0, 5000, 9000)]
    ws = [f"h{i}" for i in range(777)] + (block * 5)[:40_000] + ["end"]
    runs, _ = found_in([" ".join(ws)])
    assert runs == [[(777, 40_000, 9000)]]


def plain_report(doc_id, text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(ws)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(ws)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(plain_collapse(ws, runs)))


def report(df):
    out = pr.run_report(df)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_report_equals_brute_force(spark, docs, rows):
    short = [r for r in rows if len((r[1] or "").split()) < 2000]
    rng = random.Random(3)
    more = [(10_000 + i, periodic_text(rng), None, None, 0) for i in range(150)]
    df = docs.where("size(split(coalesce(text, ''), '[\\\\s]+')) < 1900").unionByName(spark.createDataFrame(more, DOCS))
    kept = {r.doc_id for r in df.select("doc_id").collect()}
    expected = sorted((plain_report(r[0], r[1]) for r in short + more if r[0] in kept), key=str)
    assert len(kept) > 300 and report(df) == expected


def test_whole_long_texts(spark, docs, rows):
    """The very long texts of the fixture: the results are those of the whole text."""
    long = [r for r in rows if len((r[1] or "").split()) >= 2000]
    got = {r.doc_id: r.n_words for r in pr.periodic_runs(docs).collect()}
    assert long and all(got[r[0]] == len(r[1].split()) for r in long)
    found = {r.doc_id: r.runs for r in pr.periodic_runs(docs).collect()}
    ab = next(r for r in long if r[1].startswith("xx"))
    assert [tuple(x) for x in found[ab[0]]] == [(1, 5000, 1)]


def test_odd_rows(odd_docs):
    rows = [tuple(r)[:2] for r in odd_docs.collect()]
    assert report(odd_docs) == sorted((plain_report(*r) for r in rows), key=str)


def test_empty_table(no_docs):
    assert pr.run_report(no_docs).count() == 0
