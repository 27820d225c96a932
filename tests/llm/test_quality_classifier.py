from __future__ import annotations

import random
import zlib

import numpy as np

from chartmart.llm import quality_classifier as q
from tests.llm.conftest import prose


def data(spark, n: int = 240):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = prose(i, 80)
        docs.append((i, " ".join(words if good else [w.upper() + "!!" for w in words])))
        labels.append((i, int(good), 0))
    labels += [(n - 1, None, 0), (None, 1, 0), (n + 5, 1, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: y for i, y, _ in labels[:n]},
    )


def test_held_out_documents_are_told_apart(spark):
    docs, labels, truth = data(spark)
    found = q.classified(docs, labels).collect()
    assert len(found) == 240
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95


def test_labels_of_the_fold_are_never_learnt(spark):
    docs, labels, _ = data(spark, 80)
    flipped = labels.withColumn("quality", (1 - labels.quality))
    kept = labels.where(~q.held_out(labels.doc_id)).union(flipped.where(q.held_out(labels.doc_id)))
    a = {r["doc_id"]: r["score"] for r in q.classified(docs, labels).collect()}
    assert a == {r["doc_id"]: r["score"] for r in q.classified(docs, kept).collect()}


def test_a_long_run_of_one_character_leaves_the_model_finite(spark):
    docs, labels, truth = data(spark, 80)
    docs = docs.union(spark.createDataFrame([(1000, "=" * 100_000)], docs.schema))
    labels = labels.union(spark.createDataFrame([(1000, 0, 0)], labels.schema))
    model = q.train(docs, labels)
    assert np.isfinite(model.axes).all() and np.isfinite(model.vectors).all()
    scores = {r["doc_id"]: r["score"] for r in q.scored(docs, model).collect()}
    assert np.mean([(scores[i] >= q.THRESHOLD) == y for i, y in truth.items()]) >= 0.95


def test_votes_match_brute_force():
    rng = np.random.default_rng(1)
    rows = np.array([q.counts(" ".join(prose(i, 40))) for i in range(60)])
    labels = rng.integers(0, 2, 60).astype(float)
    model = q.fit(rows[:50], labels[:50])
    unit = model.project(rows)
    for k in range(50, 60):
        cosine = unit[:50] @ unit[k]
        near = np.argsort(-cosine)[: q.NEIGHBOURS]
        weight = np.maximum(cosine[near], 0) ** q.SHARPEN
        want = (weight * labels[near]).sum() / weight.sum()
        assert abs(model.score(rows[k : k + 1])[0] - want) < 1e-4


def test_odd_rows(clash, odd_rows, empty, spark):
    labels = spark.createDataFrame([(4, 1), (3, 0), (7, 1)], "doc_id long, quality int")
    found = q.classified(clash, labels).collect()
    assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    assert q.classified(empty, labels).collect() == []
    none = q.classified(clash, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
