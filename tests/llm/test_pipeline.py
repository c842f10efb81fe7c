"""Stages on their own input: columns, what goes and what stays, and the whole run."""

from collections import Counter

import pytest

import corpus_pipeline
from heatgrid.llm import line_dedup, near_dedup, quality, stages

SF_DIR = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [f for _, f in corpus_pipeline.STAGES] == [
        stages.quality_rules, stages.line_dedup_stage, stages.near_dedup_stage, stages.mixing_stage, stages.byte_bpe,
    ]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_columns_of_documents_stay(spark, odd, empty, name, stage):
    for docs in (odd, empty):
        out = stage(spark, docs, SF_DIR)
        assert out.schema.simpleString() == docs.schema.simpleString()
        out.collect()


def test_decisions_take_effect(spark, odd, odd_rows):
    kept = {r.doc_id for r in quality.judged(quality.text_counts(odd, "doc_id")).collect() if r.kept}
    assert {r.doc_id for r in stages.quality_rules(spark, odd, SF_DIR).collect()} == kept
    left = stages.near_dedup_stage(spark, odd, SF_DIR).collect()
    classes = {r.class_id for r in near_dedup.near_duplicates(odd).collect()}
    assert Counter(r.doc_id for r in left) == Counter(classes)
    cleaned = stages.line_dedup_stage(spark, odd, SF_DIR).collect()
    assert Counter(r.text for r in cleaned) == Counter(r.clean_text for r in line_dedup.clean(odd).collect())
    mixed = stages.mixing_stage(spark, odd, SF_DIR).collect()
    assert {r.source for r in mixed} <= {s for *_, s in odd_rows}


def test_run_equals_the_stages_one_by_one(spark):
    docs = corpus_pipeline.documents(spark, SF_DIR)
    ids = {r.doc_id: r.text for r in docs.collect()}
    result = corpus_pipeline.run(spark, SF_DIR).collect()
    step = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, SF_DIR)
    again = corpus_pipeline.STAGES[-1][1](spark, step, SF_DIR).collect()
    assert sorted(map(tuple, result)) == sorted(map(tuple, again)) and result
    assert {r.doc_id for r in result} <= set(ids)
