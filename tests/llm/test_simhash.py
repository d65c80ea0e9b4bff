import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.queries import all_queries


def _print(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = [w for w in lowered.replace("\n", " ").replace("\t", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def _components(rows):
    """By brute force: (doc_id, print) -> smallest id reached."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= 3:
                root[top(a)] = top(b)
    least = {}
    for i, p in rows:
        if i is not None:
            least[top(p)] = min(i, least.get(top(p), i))
    return sorted(((i, f"{p:016x}", least.get(top(p))) for i, p in rows), key=repr)


def _found(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=repr)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = _components([(r.doc_id, _print(r.text)) for r in docs])
    assert _found(all_queries()["op10_golay_simhash"](spark, sf)) == want
    assert any(int(c) != int(i) for i, _, c in want)


def test_odd_rows(spark, documents, odd):
    docs = documents(odd)
    want = _components([(i, _print(t)) for i, t, _ in odd])
    assert _found(simhash.near_duplicates(docs)) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert len({w[2] for w in want}) == kept.count()
    assert {r.doc_id for r in kept.collect()} == {w[2] for w in want}


def test_words_one_bit_apart_share_a_key():
    draw = np.random.default_rng(3)
    words = draw.integers(0, 1 << 23, 3000)
    for bit in range(23):
        a, b = simhash.segment_keys(words), simhash.segment_keys(words ^ (1 << bit))
        for k in range(len(words)):
            assert set(a[0][k][a[1][k]]) & set(b[0][k][b[1][k]])


@pytest.mark.parametrize("block", [4, 20_000])
def test_dense_groups_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    draw = random.Random(5)
    rows = []
    for center in [draw.getrandbits(64) for _ in range(5)]:
        for _ in range(120):
            near = center
            for _ in range(draw.randint(0, 4)):
                near ^= 1 << draw.randrange(64)
            rows.append((len(rows), near))
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in rows]
    prints = spark.createDataFrame(signed, "doc_id bigint, print bigint")
    component = {r.print % (1 << 64): r.component_id for r in simhash.grouped_prints(prints).collect()}
    assert sorted((i, f"{p:016x}", component[p]) for i, p in rows) == sorted(_components(rows))
