import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import losertree, suffix_dedup
from tidemark.llm.queries import all_queries


def _brute(rows):
    """(doc_id, bytes) -> result rows, by a table of all strings."""
    keys = [(i is None, i or 0, t) for i, t in rows]
    first = {}
    for k in sorted(set(keys)):
        for s in range(len(k[2]) - 99):
            first.setdefault(k[2][s : s + 100], (k, s))
    out = []
    for (i, text), k in zip(rows, keys):
        gone = np.zeros(len(text), bool)
        for s in range(len(text) - 99):
            if first[text[s : s + 100]] != (k, s):
                gone[s : s + 100] = True
        spans = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        out.append((i, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = _brute([(r.doc_id, r.text.encode()) for r in docs])
    assert _found(all_queries()["op4_suffix_dedup"](spark, sf)) == want
    assert sum(w[2] for w in want)


def test_query_larger(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert _found(all_queries()["op4_suffix_dedup"](spark, sf)) == _brute([(r.doc_id, r.text.encode()) for r in docs])


def test_odd_rows(spark, documents, odd):
    rows = [*odd, (20, "é" * 300, "a"), (21, "ab" * 90 + "é" * 60, "a"), (None, "é" * 80, "a")]
    docs = documents([r for r in rows if r[0] != 5])
    want = _brute([(i, (t or "").encode()) for i, t, _ in rows if i != 5])
    assert _found(suffix_dedup.deduplicated(docs)) == want
    assert suffix_dedup.deduplicated(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_tangled_passages(spark, monkeypatch, seed):
    """Shared, nested, shifted and periodic passages; small slices and runs."""
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 50)
    draw = random.Random(seed)
    pool = ["".join(draw.choice("abcé \0") for _ in range(draw.randint(80, 260))) for _ in range(6)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(draw.randint(1, 6)):
            p = draw.choice(pool)
            a = draw.randint(0, 40)
            text += draw.choice([p, p[a:], p[:-a or None], "xy" * draw.randint(1, 120), draw.choice("qrs") * 5])
        rows.append((draw.randint(0, 50), text))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = _found(suffix_dedup.deduplicated(docs))
    want = _brute([(i, t.encode()) for i, t in rows])
    by_id = {i for i, _ in rows if sum(j == i for j, _ in rows) == 1}
    # Rows of one doc_id are ordered by a hash, so only totals can be stated for all.
    assert [g[:2] for g in got] == [w[:2] for w in want]
    if len(by_id) == len(rows):
        assert got == want


def test_tangled_passages_with_own_ids(spark):
    draw = random.Random(9)
    pool = ["".join(draw.choice("abcé \0") for _ in range(draw.randint(80, 260))) for _ in range(6)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(draw.randint(1, 6)):
            p, a = draw.choice(pool), draw.randint(0, 40)
            parts.append(draw.choice([p, p[a:], p[: -a or None], "xy" * draw.randint(1, 120), draw.choice("qrs") * 5]))
        rows.append((i, "".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    assert _found(suffix_dedup.deduplicated(docs)) == _brute([(i, t.encode()) for i, t in rows])


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_SLICE", 300)
    texts = [bytes([1, 2, 3]) * 500, b"q" * 99, b"r" * 100]
    starts = []
    for rows, offsets, pieces in suffix_dedup._pieces([0, 1, 2], texts):
        at, first, last, _, _ = suffix_dedup.stretches(pieces)
        for p, a, b in zip(at, first, last):
            starts += [(rows[p], offsets[p] + s) for s in range(a, b + 1)]
    assert sorted(starts) == [(0, s) for s in range(1401)] + [(2, 0)]


@pytest.mark.parametrize("k", [1, 2, 3, 5, 8])
def test_merge(k):
    draw = random.Random(k)
    runs, strings = [], []
    for _ in range(k):
        own = sorted({bytes(draw.choice(b"ab") for _ in range(12)) for _ in range(draw.randint(1, 60))})
        rows = np.frombuffer(b"".join(own), np.uint8).reshape(-1, 12)
        shared = losertree.common_prefixes(rows)
        tails = rows[np.arange(12) >= shared[:, None]].tobytes()
        runs.append(losertree.Run(shared.tolist(), tails, 12))
        strings.append(own)
    out = [(strings[r][i], shared) for r, i, shared in losertree.merged(runs)]
    assert [s for s, _ in out] == sorted(s for own in strings for s in own)
    for (a, _), (b, shared) in zip(out, out[1:]):
        assert shared == next((i for i in range(12) if a[i] != b[i]), 12)
