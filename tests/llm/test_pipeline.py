"""The pipeline's stages against plain versions of what they decide."""

from __future__ import annotations

import brute
from compare import TINY
from test_operators import JSON, check_packing, expected_pieces

import corpus_pipeline
from tidewick.llm import packing


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{TINY}/labels.parquet").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, TINY).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.columns == columns, name
        left = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality_classifier":
            gone = set(rows) - set(left)
            assert gone and sum(labels.get(i) == 1 for i in gone) <= 0.02 * len(rows)
        elif name == "exact_dedup":
            best = {}
            for i, t in rows.items():
                best[t] = max(best.get(t, -1), i)
            assert set(left) == set(best.values())
        elif name == "jaccard_join":
            assert set(left) == set(brute.components(list(rows.items()), 5, 80).values())
        else:
            assert set(left) == set(rows)
            assert not any(brute.pii_spans(t) for t in left.values())
            assert all(left[i] == t for i, t in rows.items() if not brute.pii_spans(t))
        rows = left
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, TINY).collect()
    sequences = check_packing(pieces, list(expected_pieces(rows.items())))
    assert sequences <= -(-sum(p["length"] for p in pieces) // packing.LENGTH) + 1
    whole = corpus_pipeline.run(spark, TINY).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted(map(tuple, whole)) == sorted((p["doc_id"], p["piece"], p["ids_crc32"]) for p in pieces)


def test_stages_on_odd_rows(spark, odd, none):
    """Nulls, empty, long and repeated rows and further columns go through all stages."""
    for frame in (odd, none):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, TINY).checkpoint()
            assert docs.columns == frame.columns, name
        rows = docs.select("doc_id", "text").collect()
        assert len({r["text"] or "" for r in rows}) == len(rows) and not any(brute.pii_spans(r["text"]) for r in rows)
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, TINY).collect()
        check_packing(pieces, list(expected_pieces([tuple(r) for r in rows])))
