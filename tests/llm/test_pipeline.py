"""The pipeline's stages on a small corpus, each against its definition."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from tests.llm.fixtures import SCHEMA, documents, sentence
from tests.llm.test_dedup import brute_components, brute_lines
from tests.llm.test_models import labelled


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    docs, labels = labelled(600, 2)
    items = [(i, sentence(rng, 40)) for i in range(5)]
    leaks = [(3000 + i, f"{sentence(rng, 30)} {t} {sentence(rng, 30)}", "en", "s", 0, "x") for i, t in items]
    rows = docs + [(r[0] if r[0] is None else r[0] + 2000, *r[1:]) for r in documents()] + leaks
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    table = [(i, 1 - low, toxic) for i, low, toxic, _ in labels[:500]]
    spark.createDataFrame(table, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, labels


def test_stages(spark, folder):
    path, rows, labels = folder
    key = lambda table: sorted(((r["doc_id"], r["text"]) for r in table), key=str)
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = stages["toxicity"](spark, docs, path)
    assert kept.columns == docs.columns
    toxic = {i for i, _, t, _ in labels if t}
    gone = {r[0] for r in rows} - {r["doc_id"] for r in kept.collect()}
    assert len(gone ^ toxic) <= 8 and not {i for i in gone if i is None or i >= 600}

    before = [tuple(r) for r in kept.collect()]
    kept = stages["line dedup"](spark, kept, path)
    assert kept.columns == docs.columns
    want, cut = brute_lines(before, 3)
    left = [(r[0], want[(r[0], r[1])]) for r in before if not r[1] or len(cut[(r[0], r[1])]) < len(r[1].split("\n"))]
    assert key(kept.collect()) == sorted(left, key=str)

    before = sorted({tuple(r) for r in kept.collect()}, key=str)
    kept = stages["n-gram jaccard join"](spark, kept, path)
    assert kept.columns == docs.columns
    stay = {i for i, n, c in brute_components(before, 5, 80) if i == c}
    assert {r["doc_id"] for r in kept.collect()} == stay and kept.count() < len(before)

    before = kept.collect()
    kept = stages["benchmark decontamination"](spark, kept, path)
    assert kept.columns == docs.columns
    assert key(kept.collect()) == key(r for r in before if r["doc_id"] is None or r["doc_id"] < 3000)

    packed = stages["packing"](spark, kept, path).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in kept.collect()}


def test_one_document_stays_where_ids_do_not_tell_them_apart(spark):
    rng = random.Random(3)
    drop = dict(corpus_pipeline.STAGES)["n-gram jaccard join"]
    base = [sentence(rng, 80) for _ in range(4)]
    rows = [(None, base[0]), (None, base[0] + " more"), (7, base[1]), (7, base[1] + " more"), (7, base[1])]
    rows += [(None, base[2]), (9, base[2] + " more"), (None, base[3]), (None, None), (None, None), (7, ""), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in drop(spark, docs, "").collect()]
    of = lambda text: [(i, t) for i, t in kept if t and t.startswith(text)]
    assert [len(of(b)) for b in base] == [1, 1, 1, 1]
    assert of(base[0])[0][0] is None and of(base[1])[0][0] == 7 and of(base[2]) == [(9, base[2] + " more")]
    assert kept.count((None, None)) == 2 and kept.count((7, "")) == 2 and len(kept) == 8
    assert drop(spark, docs.limit(0), "").collect() == []


def test_run(spark, folder):
    path, rows, _ = folder
    got = corpus_pipeline.run(spark, path).collect()
    ids = {r["doc_id"] for r in got}
    assert ids and not {i for i in ids if i is not None and i >= 3000}
