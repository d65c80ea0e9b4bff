import hashlib
import math

import numpy as np
import pytest

from tidemark.llm import vector_codes
from tidemark.llm.queries import all_queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def _brute(rows, parts=4, entries=256, rounds=4):
    """All distances, in Python's whole numbers."""
    fine = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max((len(r[1]) for r in fine), default=0) // parts) * parts
    numbers = [[*(math.floor(1024 * x) for x in r[1]), *[0] * (width - len(r[1]))] for r in fine]
    first = sorted(range(len(fine)), key=lambda i: (fine[i][0] is None, fine[i][0] or 0, list(fine[i][1])))[:entries]
    step = width // parts
    cut = [[v[p * step : (p + 1) * step] for v in numbers] for p in range(parts)]
    books = [[cut[p][i] for i in first] for p in range(parts)]

    def nearest(part, book):
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in book] for v in part]
        return [(d.index(min(d)), min(d)) for d in far]

    for _ in range(rounds):
        for p in range(parts):
            own = [i for i, _ in nearest(cut[p], books[p])]
            for e in range(len(books[p])):
                mine = [v for v, i in zip(cut[p], own) if i == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    final = [nearest(cut[p], books[p]) for p in range(parts)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(f[i][1] for f in final) for i in range(len(fine))]
    per_label = {}
    for r, e in zip(fine, errors):
        per_label[r[2]] = per_label.get(r[2], 0) + e
    most = 2**63 - 1
    return sorted(
        (
            (r[0], "".join(f"{f[i][0]:02x}" for f in final), min(errors[i], most), min(per_label[r[2]], most), sha)
            for i, r in enumerate(fine)
        ),
        key=repr,
    )


def _same(df, rows):
    assert df.columns == COLUMNS
    assert sorted(map(tuple, df.collect()), key=repr) == _brute(rows)


def _frame(spark, rows, kind="float"):
    full = [(*r, "x") for r in rows]
    return spark.createDataFrame(full, f"vec_id bigint, embedding array<{kind}>, label int, n string").repartition(3)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    _same(all_queries()["op11_anchor_codes"](spark, SF), [tuple(r) for r in rows])


def test_odd_rows(spark):
    draw = np.random.default_rng(1)
    some = draw.normal(size=(60, 6)).astype(np.float32).tolist()
    rows = [(i % 50, v, i % 3) for i, v in enumerate(some)]
    rows += [(100, None, 1), (101, [1.0, None, 0.0], 1), (102, [float("nan")], 1), (103, [float("inf"), 1.0], None)]
    rows += [(None, [0.5, 0.25], None), (None, None, None), (7, [], 2), (8, some[0], None), (8, some[0], None), (9, [0.0] * 6, 1)]
    _same(vector_codes.compressed(_frame(spark, rows)), rows)
    assert vector_codes.compressed(_frame(spark, rows).limit(0)).count() == 0
    assert vector_codes.compressed(_frame(spark, rows).filter("vec_id = 100")).count() == 0
    only = [(1, [], 1), (2, [], 1)]
    _same(vector_codes.compressed(_frame(spark, only)), only)


def test_huge_components(spark):
    draw = np.random.default_rng(2)
    rows = [(i, (draw.normal(size=8) * 10.0 ** draw.integers(0, 38)).astype(np.float32).tolist(), i % 2) for i in range(40)]
    _same(vector_codes.compressed(_frame(spark, rows)), rows)


def _points(kind, n):
    draw = np.random.default_rng(n)
    if kind == "copies":
        return np.repeat(draw.normal(size=(9, 16)), n // 9, axis=0)
    if kind == "families":
        return (draw.normal(size=(20, 1, 16)) + 0.02 * draw.normal(size=(20, n // 20, 16))).reshape(-1, 16)
    return draw.normal(size=(n, 16))


@pytest.mark.parametrize("kind", ["spread", "copies", "families"])
def test_walk_finds_the_owners(kind):
    numbers = vector_codes.whole(_points(kind, 1800))
    tree = vector_codes.balls(numbers)
    assert sorted(tree.order.tolist()) == list(range(len(numbers)))
    for node in range(len(tree.start)):
        rows = tree.order[tree.start[node] : tree.end[node]]
        assert (tree.sums[node] == numbers[rows].sum(axis=0)).all()
    book = numbers[:256].astype(object)
    code, counts, sums = vector_codes.owners(tree, numbers, book)
    want = ((numbers[:, None, :] - numbers[None, :256, :]) ** 2).sum(axis=2).argmin(axis=1)
    assert (code == want).all() and (counts == np.bincount(want, minlength=256)).all()
    assert all((sums[e] == numbers[want == e].sum(axis=0)).all() for e in range(256) if counts[e])


def test_balls_are_owned_as_a_whole(monkeypatch):
    """Tight families are settled above the leaves: no leaf is compared point by point."""
    numbers = vector_codes.whole(_points("families", 2000))
    tree = vector_codes.balls(numbers)
    book = numbers[::100].astype(object)
    stack = []
    real = np.concatenate
    monkeypatch.setattr(vector_codes.np, "concatenate", lambda x, *a, **k: stack.append(sum(map(len, x))) or real(x, *a, **k))
    vector_codes.owners(tree, numbers, book)
    assert sum(stack) < len(numbers)


def test_blocks_do_not_matter(spark):
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(_points("spread", 700))]
    df = _frame(spark, rows)
    small, books = vector_codes.trained(df, block=100)
    assert vector_codes.digest(books) == vector_codes.digest(vector_codes.trained(df)[1]) and small.count() >= 7
