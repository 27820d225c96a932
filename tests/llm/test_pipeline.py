from __future__ import annotations

import corpus_pipeline
from chartmart.llm import mixing, near_duplicates, quality_rules, secrets
from chartmart.llm.common import documents, settle
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_another(spark):
    docs, counts = documents(spark, SF), []
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF), "test")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    assert near_duplicates.classified(docs).where("doc_id <> component_id").count() == 0
    again = secrets.find(docs).where("size(_base) > 0")
    assert again.count() == 0
    assert quality_rules.cascade(documents(spark, SF)).count() == counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[-1]


def test_run_is_the_stages(spark):
    found = corpus_pipeline.run(spark, SF)
    docs = documents(spark, SF)
    kept = mixing.sample(
        settle(secrets.mask(settle(near_duplicates.kept(quality_rules.cascade(docs)), "a")), "b")
    )
    assert {r[0] for r in found.select("doc_id").collect()} == {
        r[0] for r in kept.select("doc_id").collect()
    }


def test_dedup_takes_near_copies_of_similarity_080(spark):
    # Two edits in 120 words spoil 10 of 116 shingles: 106 / 126 is 0.841, under the 0.85 of op8.
    words = prose(3, 120)
    changed = [f"new{i}" if i in (40, 80) else w for i, w in enumerate(words)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed))], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.dedup(spark, docs, SF).collect()] == [1]
    assert {r["component_id"] for r in near_duplicates.classified(docs).collect()} == {1, 2}


def test_no_rows(empty, spark):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), "test")
    assert docs.count() == 0
