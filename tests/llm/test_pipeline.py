"""The pipeline against brute-force versions of its stages on the small tables."""

from __future__ import annotations

from tests.conftest import SMALL
from tests.llm import brute

import corpus_pipeline
from stressframe.llm import quality


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE",
    ]
    left = {r.doc_id: r.text for r in docs.collect()}
    frame = docs
    want = {r.doc_id for r in quality.rate(docs, labels).where("predicted = 1").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        frame = stage(spark, frame, SMALL)
        assert frame.columns == docs.columns
        frame = spark.createDataFrame(frame.collect(), docs.schema)
        if k == 0:
            left = {i: t for i, t in left.items() if i in want}
        elif k == 1:
            left = {i: t for i, (_, _, t) in brute.line_dedup(list(left.items())).items()}
        elif k == 2:
            left = {i: left[i] for i, (_, c) in brute.near_components(list(left.items())).items() if c == i}
        else:
            exact = {i for i, t in left.items() if any(x.lower() in t.lower() for x in bench)}
            gone = set(left) - {r.doc_id for r in frame.collect()}
            assert exact <= gone
            for i in gone - exact:
                assert any(brute.edit_distance_within(left[i].lower(), x.lower()) <= 0.08 * len(x.encode()) for x in bench)
            left = {i: t for i, t in left.items() if i not in gone}
        assert {r.doc_id: r.text for r in frame.collect()} == left, name
        assert all(r.n_chars == len(r.text) for r in frame.collect())
    tokens = corpus_pipeline.STAGES[-1][1](spark, frame, SMALL).collect()
    assert {r.doc_id: r.decoded_sha256 for r in tokens} == {i: brute.sha(t.encode()) for i, t in left.items()}
    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.ids_sha256) for r in tokens)
