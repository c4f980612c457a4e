"""The whole pipeline, stage by stage, and the registered queries."""

from collections import defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from attrition.llm import mixing, quality
from attrition.llm.common import drop_written, written
from tests.llm import brute
from tests.llm.test_packing import check_pieces
from attrition.llm import tokens


@pytest.fixture(scope="module")
def small(spark, rows, tmp_path_factory):
    """A folder with the pipeline's tables."""
    path = str(tmp_path_factory.mktemp("tables"))
    from tests.llm.conftest import DOCS
    long = [(d, t if not t or len(t.split()) < 50 else t + "\n" + " ".join(f"tail{d}x{i}" for i in range(60)), *r)
            if d % 7 == 4 else (d, t, *r) for d, t, *r in rows]
    spark.createDataFrame(long, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(d, 1 if len(brute.words(t)) > 50 else 0, 0) for d, t, *_ in rows if d % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, long, [(d, q) for d, q, _ in labels]


def test_stages(spark, small):
    path, rows, labels = small
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {r[0]: r for r in rows}
    grids = {r: g for r, (_, g) in quality.RULES.items()}
    verdict = brute.quality([(d, t, lang) for d, t, lang, *_ in rows], labels, grids)
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_duplicates", "near_duplicates", "source_mixing", "sequence_packing"]
    tables = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, path), f"test-{name}")
        tables.append(docs)
        if name != "sequence_packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality_rules":
            kept = {d: r for d, r in kept.items() if verdict[d]}
            assert ids(docs) == sorted(kept) and 0 < len(kept) < len(rows)
        elif name == "exact_duplicates":
            first = {}
            for d in sorted(kept):
                first.setdefault(brute.normalised(kept[d][1]), d)
            kept = {d: kept[d] for d in first.values()}
            assert ids(docs) == sorted(kept)
        elif name == "near_duplicates":
            some = [(d, kept[d][1]) for d in sorted(kept)]
            kept = {d: kept[d] for (d, _), (_, c) in zip(some, brute.components(some, 5, 80)) if c == d}
            assert ids(docs) == sorted(kept)
        elif name == "source_mixing":
            report = {r.doc_id: r.taken for r in mixing.mixing_report(tables[-2]).collect()}
            got = defaultdict(int)
            for r in docs.collect():
                got[r.doc_id] += len(brute.words(r.text))
            assert dict(got) == {d: n for d, n in report.items() if n}
        else:
            enc = tokens.encoder(tokens.default_path())
            total = sum(len(enc.ids(r.text)) + 1 for r in tables[-2].collect())
            out = docs.collect()
            assert sum(r.length for r in out) == total and all(0 <= r.offset < 1024 for r in out)


def test_run(spark, small):
    path, rows, _ = small
    out = corpus_pipeline.run(spark, path).collect()
    again = corpus_pipeline.run(spark, path).collect()
    key = lambda rs: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rs)
    assert key(out) == key(again) and len(out) > 20


def test_one_query_per_operator():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


def test_packed_whole(spark, small):
    from attrition.llm import packing
    path, rows, _ = small
    out = packing.pack_documents(spark.read.parquet(f"{path}/documents.parquet")).collect()
    check_pieces(out, {r[0]: r[1] for r in rows}, tokens.encoder(tokens.default_path()))


def test_intermediates_are_deleted_but_for_what_is_read(spark, tmp_path):
    a, b = written(spark.range(5), "one"), written(spark.range(6), "two")
    drop_written(spark, b)
    assert b.count() == 6
    with pytest.raises(Exception):
        a.count()


def stages_over(spark, docs, path):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, path), f"edge-{name}")
        out.append((docs.columns, docs.collect()))  # the next stage deletes what is read here
    return out


def test_pipeline_without_documents(spark, small, no_docs):
    path, _, _ = small
    assert [rows for _, rows in stages_over(spark, no_docs, path)] == [[]] * 5


def test_pipeline_with_odd_rows_and_extra_columns(spark, small, rows):
    """Null and repeated ids, repeated rows, and columns named like those that the stages add."""
    from pyspark.sql import functions as F

    path, _, _ = small
    body = lambda tag: " ".join(f"{tag}{j}" for j in range(80))
    some = [(1, body("a")), (1, body("a")), (2, body("b")), (2, body("c")), (None, body("d")), (None, body("d")), (None, body("e")),
            (3, body("a") + " more"), (None, None), (4, "short"), (5, body("d") + " x y")]
    docs = spark.createDataFrame(some, "doc_id long, text string").select(
        "*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"),
        *[F.lit("q").alias(c) for c in ("row", "kept", "size", "rank", "component_id", "sequence_id", "_at")])
    quality_, exact, near, mixed, packed = stages_over(spark, docs, path)
    key = lambda out: sorted(((r.doc_id, r.text) for r in out[1]), key=str)
    assert all(columns == docs.columns for columns, _ in (quality_, exact, near, mixed))
    long = [(d, t) for d, t in some if t and len(t.split()) >= 50]
    assert key(quality_) == sorted(long, key=str)  # the base checks alone
    assert key(exact) == sorted({(d, t): (d, t) for d, t in long}.values(), key=str)
    # a 1 stands for its near copy 3; of d (no id) and 5 the one with an id; 2 has two unrelated texts
    assert key(near) == sorted([(1, body("a")), (2, body("b")), (2, body("c")), (None, body("e")), (5, body("d") + " x y")], key=str)
    assert mixed[1] and {r.doc_id for r in packed[1]} == {r.doc_id for r in mixed[1]}
    assert sum(r.start == 0 for r in packed[1]) == len(mixed[1])
