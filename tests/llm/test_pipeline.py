"""Each stage against brute force on the rows that the stage before it kept."""

from collections import Counter

import duckdb
from test_packing import _check
from test_simhash import _components, _print

import corpus_pipeline
from tidemark.llm import expected, quality, secret_scan

SF = "/root/testdata/sf0.001"


def _rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_and_run(spark, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["pu_quality", "golay_simhash", "secret_scan", "source_mix", "best_two_fit"]
    inputs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, inputs[-1], SF).write.parquet(str(tmp_path / name))
        inputs.append(spark.read.parquet(str(tmp_path / name)))
    docs, good, single, clean, mixed, packed = inputs
    for df in (good, single, clean, mixed):
        assert df.columns == docs.columns

    model = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    taken = {r.doc_id for r in quality.score(docs, model).collect() if r.predicted}
    assert _rows(good) == Counter(r for r in map(tuple, docs.collect()) if r[0] in taken)

    stay = {w[2] for w in _components([(r.doc_id, _print(r.text)) for r in good.collect()])}
    assert _rows(single) == Counter(r for r in map(tuple, good.collect()) if r[0] in stay)

    def redacted(r):
        text = secret_scan.redacted(r.text)
        return (r.doc_id, text, r.lang, r.source, r.n_chars if text == r.text else len(text))

    assert _rows(clean) == Counter(map(redacted, single.collect()))

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/secret_scan/*.parquet'")
    times = {i: taken // size for i, size, taken in db.sql(f"SELECT doc_id, size, taken FROM ({expected.MIX}) WHERE size > 0").fetchall()}
    words = {r.doc_id for r in clean.collect() if r.text and r.text.split()}
    assert Counter(r.doc_id for r in mixed.collect() if r.doc_id in words) == Counter({k: v for k, v in times.items() if v})

    n, total = _check(packed.collect(), [(r.doc_id, r.text) for r in mixed.collect()])
    assert n <= -(-total // 4096) + 1

    whole = corpus_pipeline.run(spark, SF)
    assert whole.columns == packed.columns and _rows(whole.drop("sequence_id", "offset")) == _rows(packed.drop("sequence_id", "offset"))


def test_empty_and_odd_documents(spark, documents, odd):
    for rows in (documents(odd), documents(odd).limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        docs.collect()
