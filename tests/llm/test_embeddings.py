import numpy as np
import pytest

from tidemark.llm import embeddings
from tidemark.llm.queries import all_queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, part string"


def _links(rows):
    """All links by brute force: sets of positions."""
    out = [set() for _ in rows]
    usable = [
        v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) and k is not None
        for _, v, k in rows
    ]
    for label, size in {(k, len(v)) for (_, v, k), ok in zip(rows, usable) if ok}:
        at = [i for i, (_, v, k) in enumerate(rows) if usable[i] and k == label and len(v) == size]
        x = np.array([rows[i][1] for i in at], np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in np.argwhere(x @ x.T >= 0.93):
            if a != b:
                out[at[a]].add(at[b])
    return out


def _expected(rows):
    links = _links(rows)
    component = [r[0] for r in rows]
    for start in range(len(rows)):
        group, stack = {start}, [start]
        while stack:
            for j in links[stack.pop()] - group:
                group.add(j)
                stack.append(j)
        component[start] = min(rows[i][0] for i in group)
    return {(r[0], len(n), c, r[0] == c) for r, n, c in zip(rows, links, component)}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = {r[0]: r for r in _expected(rows)}
    found = {r.vec_id: r for r in all_queries()["op5_itq_embeddings"](spark, path).collect()}
    assert found.keys() == want.keys()
    links = sum(w[1] for w in want.values())
    assert all(found[i].n_links <= want[i][1] for i in want)
    assert sum(r.n_links for r in found.values()) >= 0.98 * links
    assert sum(found[i].component_id == want[i][2] for i in want) >= 0.98 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


@pytest.mark.parametrize("length", [2, 8, 12, 16, 24])
def test_short_vectors(spark, length):
    """Codes are as long as those of long vectors, so recall is too."""
    draw = np.random.default_rng(length)
    rows = []
    for i in range(300):
        a = draw.normal(size=length)
        a /= np.linalg.norm(a)
        b = draw.normal(size=length)
        b -= a * (a @ b)
        c = draw.uniform(0.931, 0.95)
        near = c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)
        rows += [(2 * i, a.tolist(), i), (2 * i + 1, near.tolist(), i)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    want = {r[0]: r for r in _expected([(i, np.float32(v).tolist(), k) for i, v, k in rows])}
    found = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    assert all(found[i].n_links <= want[i][1] for i in want)
    assert sum(r.n_links for r in found.values()) >= (0.9 if length == 2 else 0.95) * sum(w[1] for w in want.values()) > 0


def test_at_the_least_cosine(spark):
    """Recall where it is hardest: pairs just above the threshold."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(400):
        a = draw.normal(size=64)
        a /= np.linalg.norm(a)
        off = draw.normal(size=64)
        off -= a * (a @ off)
        off /= np.linalg.norm(off)
        angle = np.arccos(draw.uniform(0.931, 0.95))
        rows += [(2 * i, a.tolist(), 1, "x"), (2 * i + 1, (np.cos(angle) * a + np.sin(angle) * off).tolist(), 1, "x")]
    found = embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.n_links > 0 for r in found) >= 0.95 * len(rows)


@pytest.mark.parametrize("block", [3, 8_000])
def test_odd_rows_and_dense_groups(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    draw = np.random.default_rng(5)
    near = [(draw.normal(size=8) * 0.01 + 1).tolist() for _ in range(90)]
    rows = [(100 + i, v, 1) for i, v in enumerate(near)]
    rows += [(10, [1.0] * 8, 1), (11, [1.0] * 8, 1), (12, [1.0] * 8, 2), (13, [1.0] * 8, None), (14, None, 1)]
    rows += [(15, [], 1), (16, [0.0] * 8, 1), (17, [1.0, None] * 4, 1), (18, [1.0, float("nan")] * 4, 1)]
    rows += [(19, [float("inf")] * 8, 1), (20, [1.0] * 4, 1), (21, [2.0] * 4, 1), (22, [-1.0] * 8, 1), (23, [1e30] * 8, 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    found = {tuple(r) for r in embeddings.near_duplicates(df).collect()}
    assert found == _expected([(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], k) for i, v, k in rows])
    assert embeddings.near_duplicates(df.limit(0)).count() == 0
    twice = embeddings.near_duplicates(df.filter("vec_id in (10, 14)").unionByName(df.filter("vec_id in (10, 14)")))
    assert sorted(map(tuple, twice.collect())) == [(10, 1, 10, True)] * 2 + [(14, 0, 14, True)] * 2
