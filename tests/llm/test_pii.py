import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import pii, trees
from tidemark.llm.queries import all_queries

KINDS = ["email", "ip", "card", "phone"]


def _luhn(digits):
    values = [int(c) for c in digits][::-1]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


def _base(text):
    """The patterns as stated, then their checks."""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m)) <= 19 and _luhn(digits(m)):
            out.append(("card", m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m)) <= 15:
            out.append(("phone", m.span()))
    out.sort(key=lambda s: (s[1][0], KINDS.index(s[0])))
    return [f"{k}:{a}:{b}" for k, (a, b) in out]


def _check(row, text):
    base = _base(text)
    assert tuple(row)[1:5] == tuple(sum(s.startswith(k) for s in base) for k in KINDS)
    assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    spans = row.spans.split(",") if row.spans else []
    assert set(base) <= set(spans)
    keys = [(int(s.split(":")[1]), KINDS.index(s.split(":")[0])) for s in spans]
    assert keys == sorted(keys)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = all_queries()["op7_boosted_pii"](spark, sf).collect()
    assert len(rows) == len(texts) and any(r.n_phone for r in rows)
    for r in rows:
        _check(r, texts[r.doc_id])
    model = pii.fit(docs)
    hidden = [
        ("phone", "please phone me at (487) 555-7209 tomorrow"),
        ("email", "write to ana.lopez (at) mail7.example (dot) com today"),
        ("ip", "the host is 161[.]17[.]88[.]162 now"),
    ]
    for kind, text in hidden:
        found = pii.added([text], [pii.base_spans(text)], model)[0]
        assert kind in {k for k, _, _ in found}, (kind, model.thresholds)
    for text in ("in 2019 we counted 980791 of 1234567 words", "meet at the house. Dot by dot"):
        assert pii.added([text], [pii.base_spans(text)], model)[0] == []


def test_odd_rows(spark, documents, odd):
    docs = documents(odd + [(8, "a@b.c " * 3, "a"), (9, "1" * 50_000 + "@" + "." * 9, "a")])
    model = pii.fit(docs)
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    rows = pii.find(docs, model).collect()
    assert len(rows) == len(odd) + 2
    for r in rows:
        if r.doc_id is not None:
            _check(r, texts[r.doc_id])
    assert pii.fit(docs.limit(0)) is None and pii.find(docs.limit(0), None).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_base_of_tangled_texts(seed):
    draw = random.Random(seed)
    text = "".join(draw.choice(list("a1@.+- ()259\n") + ["b.c@", "1.2.3.4", "+12 345 678 9", "4111 1111-1111 1111"]) for _ in range(400))
    assert [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text)] == _base(text)


@pytest.mark.parametrize("seed", range(30))
def test_texts_without_signs_have_nothing(seed):
    """Of short tangled texts, all with a base span or candidate show a sign; plain words and numbers show none."""
    draw = random.Random(seed)
    pieces = [*"a1@.+- ()[]{}25\n-–＠\u3000\xa0", " at ", "(at)", "[ @ ]", " dot ", "[.]", " . ", "[dot]", "(dot)", " DOT ", "AT", "at", "b.c", "x", "é"]
    texts = ["".join(draw.choices(pieces, k=draw.randint(0, 12))) for _ in range(3000)]
    texts += ["".join(draw.choices("129", k=3)).join(draw.choices(pieces, k=draw.randint(2, 8))) for _ in range(1000)]
    shown = pii.signed(pa.array(texts)).to_pylist()
    held = [bool(pii.base_spans(t) or pii.candidates(t)) for t in texts]
    assert sum(held) > 100 and not any(h and not s for h, s in zip(held, shown))
    plain = ["in 219 we met at the house. Dot by dot", "look at it", "1 or 2 at most", "", None]
    assert pii.signed(pa.array(plain)).to_pylist() == [False, False, False, False, False]
    assert pii.signed(pa.array([], pa.string())).to_pylist() == []


def test_signs_are_not_sought_row_by_row(spark, monkeypatch):
    """No pass filters its rows by a pattern of the JVM, which goes back and forth at each character."""
    docs = spark.createDataFrame([(i, f"write to a{i}@b.c or call +12 345 678 {i}") for i in range(60)], "doc_id bigint, text string")
    plans, keep = [], type(docs).mapInArrow

    def noted(df, *args, **kwargs):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, *args, **kwargs)

    monkeypatch.setattr(type(docs), "mapInArrow", noted)
    rows = pii.find(docs, pii.fit(docs, sample=50)).collect()
    assert len(plans) == 4 and not any("RLIKE" in p for p in plans), plans
    assert all(r.n_email == 1 for r in rows)


def test_trees_learn_and_thresholds_hold():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = trees.boosted(x[:1500], y[:1500])
    p = model.probability(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.95
    cut = pii.calibrated(p, y[1500:], 0.98)
    assert y[1500:][p >= cut].mean() >= 0.98
    assert pii.calibrated(np.array([0.9] * 20), np.zeros(20)) is None


def test_redaction():
    assert pii.redact("mail a@b.c now", "email:5:10") == "mail [EMAIL] now"


def test_rare_kinds_are_calibrated_on_all_documents(spark):
    """Few documents have a card or address of a machine; most are full of plain numbers."""
    draw, rows = random.Random(6), []
    for i in range(3000):
        text = f"in {draw.randint(1900, 2020)} we counted {draw.randint(10**7, 10**9)} words and {draw.randint(10**6, 10**8)} lines"
        if i % 20 == 0:
            text += f" the host is {'.'.join(str(draw.randint(1, 254)) for _ in range(4))} now"
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    model = pii.fit(docs, sample=200)
    text = "the host is 161[.]17[.]88[.]162 now"
    assert [k for k, _, _ in pii.added([text], [[]], model)[0]] == ["ip"], model.thresholds
    # The counts behind the thresholds grow with the table, not with the sample.
    seen = []
    keep = pii.calibrated
    try:
        pii.calibrated = lambda s, y, **k: seen.append(k["counts"].sum()) or keep(s, y, **k)
        pii.fit(docs, sample=200)
    finally:
        pii.calibrated = keep
    assert sum(seen) > 3000


def test_counts_stand_for_rows():
    draw = np.random.default_rng(8)
    s = draw.integers(0, 9, 400) / 9
    y = (draw.random(400) < s).astype(float)
    rows, n = np.unique(np.column_stack([s, y]), axis=0, return_counts=True)
    for precision in (0.5, 0.8, 0.95, 0.98):
        assert pii.calibrated(rows[:, 0], rows[:, 1], precision, counts=n) == pii.calibrated(s, y, precision)
