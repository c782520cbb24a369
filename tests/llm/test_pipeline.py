"""The corpus pipeline, stage by stage, against brute force on the smallest tables."""

from __future__ import annotations

import corpus_pipeline
from telemetry_lake.llm import decontaminate, quality, queries, toxicity

from .conftest import SF_DIR
from .test_format_operators import check_packed
from .test_text_operators import brute_classes, edit_distance_inside


def test_stages(spark, documents):
    docs, columns = documents, documents.columns
    outputs = {}
    for name, step in corpus_pipeline.STAGES:
        outputs[name] = (docs, docs := corpus_pipeline.stage(step(spark, docs, SF_DIR), name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    before, after = outputs["quality_rules"]
    kept = {r.doc_id for r in quality.apply_policy(quality.ledger(before)).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == kept

    before, after = outputs["toxicity"]
    scored = toxicity.score(before, queries.toxicity_lexicon(spark, SF_DIR, before))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scored.where("predicted = 0").collect()}

    before, after = outputs["near_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    _, roots = brute_classes([t for _, t in rows], 5)
    assert {r.doc_id for r in after.collect()} == {rows[i][0] for i, root in enumerate(roots) if i == root}

    before, after = outputs["decontamination"]
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    for row in before.collect():
        text = decontaminate.normal(row.text)
        assert not any(item in text for item in items) or row.doc_id in gone
        if row.doc_id in gone:
            assert any(edit_distance_inside(item, text) <= len(item) * decontaminate.EDIT_RATE for item in items)

    before, after = outputs["packing"]
    check_packed(after.collect(), {r.doc_id: r.text for r in before.collect()})


def test_run_returns_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert corpus_pipeline.ORACLE_SQL is None
