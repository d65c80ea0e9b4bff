import zlib

import numpy as np

from tidemark.llm import quality
from tidemark.llm.queries import all_queries

LABELS = "doc_id bigint, quality int, toxic int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = all_queries()["op2_pu_quality"](spark, sf).collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    good = np.array([s for s, q in held if q == 1])
    bad = np.array([s for s, q in held if q == 0])
    ahead = (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()
    assert ahead > 0.99
    assert (good >= 0.3).mean() > 0.99
    assert (bad < 0.3).mean() > 0.9


def test_odd_rows(spark, documents, odd):
    docs = documents(odd)
    labels = spark.createDataFrame([(7, 1, 0), (7, 1, 0), (5, 1, 0), (5, 0, 0), (1, None, 0), (None, 1, 0), (4, 0, 0)], LABELS)
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(odd) and all(0 <= r.score <= 1 for r in rows)
    assert {r.held_out for r in rows if r.doc_id is None} == {True}
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)
    assert quality.score(docs.limit(0), model).count() == 0
    nothing = quality.fit(docs, labels.limit(0))
    assert nothing is None and {r.score for r in quality.score(docs, nothing).collect()} == {0.5}


def test_risk_does_not_go_below_zero():
    draw = np.random.default_rng(1)
    truth = draw.random(4000) < 0.8
    x = draw.normal(size=(4000, 3)) + np.where(truth, 1.5, -1.5)[:, None]
    model = quality.minimise(x[truth][:1000].astype(np.float32), x.astype(np.float32), 0.8)
    assert ((model.scores(x) > 0.5) == truth).mean() > 0.95


def test_features_of_slices(monkeypatch):
    text = "Some words, repeated words! | and\nlines é " * 50
    whole = quality.features(text)
    monkeypatch.setattr(quality, "_SLICE", 7)
    assert np.allclose(whole, quality.features(text))
