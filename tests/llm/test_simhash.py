"""SimHash near-duplicates against a brute-force version over all pairs of documents."""

import random

import numpy as np
import pytest
import xxhash

from attrition.llm import simhash
from attrition.llm.simhash import SimHashOptions
from tests.llm.conftest import DOCS


def plain_print(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(n, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Position of the first member of every document's component, by search over all pairs."""
    label = [None] * len(prints)
    for i in range(len(prints)):
        if label[i] is None:
            label[i], todo = i, [i]
            while todo:
                at = todo.pop()
                for j in range(len(prints)):
                    if label[j] is None and bin(prints[at] ^ prints[j]).count("1") <= radius:
                        label[j] = i
                        todo.append(j)
    return label


def expected(rows, n=4, radius=4):
    prints = [plain_print(r[1], n) for r in rows]
    label = plain_components(prints, radius)
    least = {}
    for r, c in zip(rows, label):
        if r[0] is not None:
            least[c] = min(r[0], least.get(c, r[0]))
    return sorted(((r[0], f"{p:016x}", least.get(c)) for r, p, c in zip(rows, prints, label)), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def near_rows():
    """Long texts with one to three words changed, whose fingerprints differ in a few bits."""
    rng = random.Random(5)
    base = [[f"t{rng.randrange(9000)}" for _ in range(300)] for _ in range(6)]
    rows = []
    for i in range(150):
        ws = list(base[i % 6])
        for _ in range(i % 4):
            ws[rng.randrange(300)] = f"e{i}"
        rows.append((1000 - i, " ".join(ws), "en", "a", 0))
    return rows


@pytest.mark.parametrize("options", [dict(), dict(parts=2, tile=8, lot=2), dict(parts=4, tile=4, lot=1)])
def test_components_equal_brute_force(spark, docs, rows, near_rows, options):
    every = rows + [(r[0] + 10_000, *r[1:]) for r in near_rows]
    df = docs.unionByName(spark.createDataFrame([(r[0] + 10_000, *r[1:]) for r in near_rows], DOCS))
    assert got(simhash.near_duplicates(df, SimHashOptions(n=4, **options))) == expected(every)


def test_some_links_are_neither_copies_nor_far(near_rows):
    prints = {plain_print(r[1], 4) for r in near_rows}
    apart = [bin(a ^ b).count("1") for a in prints for b in prints if a < b]
    assert any(0 < d <= 4 for d in apart) and any(4 < d < 10 for d in apart)


def test_fingerprint_of_a_long_text_is_counted_in_blocks(spark, monkeypatch):
    text = " ".join(f"w{i * i % 977}" for i in range(5000))
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert [int(x) for x in simhash.fingerprints([text, None, "a B", text], 4)] == [plain_print(t, 4) for t in (text, "", "a b", text)]


def test_spark_hashes_alike(spark):
    from pyspark.sql import functions as F

    text = "über die Brücke 東京"
    assert spark.range(1).select(F.xxhash64(F.lit(text)).alias("h")).first().h % (1 << 64) == xxhash.xxh64_intdigest(text, 42)


def test_exact_radius_between_tiles(spark):
    """Fingerprints 4 and 5 bits apart, in tiles of different keys and with bits spread over the parts."""
    rng = random.Random(2)
    prints = set()
    for _ in range(40):
        x = rng.getrandbits(64)
        prints |= {x, *(x ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 3, 4, 5, 6))}
    prints |= {0, (1 << 64) - 1, 15, 31 << 59}
    prints = sorted(prints)
    label = plain_components(prints, 4)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for parts in (1, 2, 4):
        found = simhash.links(df, SimHashOptions(parts=parts, tile=16, lot=2)).collect()
        root = {p: p for p in prints}

        def up(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in found:
            root[up(a % (1 << 64))] = up(b % (1 << 64))
        groups = {}
        for p, c in zip(prints, label):
            groups.setdefault(c, set()).add(p)
        mine = {}
        for p in prints:
            mine.setdefault(up(p), set()).add(p)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))


def test_a_large_group_gives_a_forest_not_all_pairs():
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    group = np.array(sorted({centre ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}), np.uint64)
    a, b = simhash.forest(group[:700], group[700:], 4)
    assert len(a) == len(group) - 1 and len(np.unique(np.concatenate([a, b]))) == len(group)


def test_odd_rows(spark, odd_docs):
    rows = [tuple(r)[:5] for r in odd_docs.collect()]
    assert got(simhash.near_duplicates(odd_docs, SimHashOptions(n=4))) == expected(rows)


def test_rows_without_an_id_join_others(spark):
    """A and C are linked only through a text without an id."""
    found = {}
    for i in range(4000):
        ws = [f"q{i}x{j}" for j in range(60)]
        a, b, c = (plain_print(" ".join(ws[k:k + 50]), 4) for k in (0, 2, 4))
        if max(bin(a ^ b).count("1"), bin(b ^ c).count("1")) <= 12 < bin(a ^ c).count("1"):
            found = {k: " ".join(ws[k:k + 50]) for k in (0, 2, 4)}
            break
    rows = [(5, found[0], None, None, None), (None, found[2], None, None, None), (9, found[4], None, None, None)]
    result = simhash.near_duplicates(spark.createDataFrame(rows, DOCS), SimHashOptions(n=4, radius=12))
    assert {(r.doc_id, r.component_id) for r in result.collect()} == {(5, 5), (None, 5), (9, 5)}


def test_empty_table(no_docs):
    out = simhash.near_duplicates(no_docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0
