from collections import Counter, defaultdict

import pytest

from tidemark.llm import mixing
from tidemark.llm.queries import all_queries


def _targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Shares by handing out again what does not fit, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget = share * sum(sizes.values())
    full = set()
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in sizes if s not in full)
        level = rest / total if total else 0
        over = {s for s in sizes if s not in full and level * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else level * weight[s] for s in sizes}
        full |= over


def _check(rows, docs):
    words = lambda t: len([w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w])
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, words(t)) for i, t, _ in docs)
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, t, s in docs:
        sizes[s] += words(t)
        largest[s] = max(largest[s], words(t))
    want = _targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * max(largest.values()), s
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())


def test_query_is_near_its_targets_and_repeats(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()
    first = all_queries()["op1_source_mix"](spark, sf).collect()
    _check(first, [tuple(d) for d in docs])
    assert sorted(first) == sorted(all_queries()["op1_source_mix"](spark, sf).collect())


def test_odd_rows(spark, documents, odd):
    rows = odd + [(30 + i, "w " * (i % 7), s) for i, s in enumerate([None, "a", "b", "zz"] * 20)]
    docs = documents(rows)
    _check(mixing.taken_words(docs).collect(), rows)
    mixed = mixing.mix(docs, placed=True)
    assert mixed.columns == [*docs.columns, "place"]
    times = Counter((r.doc_id, r.source) for r in mixed.collect() if r.text and r.text.split())
    want = {(r.doc_id, r.source): r.taken // r.size for r in mixing.taken_words(docs).collect() if r.size and r.taken}
    doubled = Counter((i, s) for i, t, s in rows if t and t.split())
    assert times == {k: n * doubled[k] for k, n in want.items()}
    assert mixing.taken_words(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0


def test_copies_are_taken_one_by_one(spark, documents):
    """A source of rows alike in id comes as near to its target as any."""
    rows = [(7, "w " * 50, "a")] * 400 + [(100 + i, "w " * 50, "b") for i in range(100)]
    found = mixing.taken_words(documents(rows)).collect()
    _check(found, rows)
    assert sum(r.taken for r in found if r.source == "a") == 27_500 and sum(r.taken for r in found) == 37_500
    mixed = Counter(r.source for r in mixing.mix(documents(rows)).collect())
    assert mixed == {"a": 550, "b": 200}


def test_copies_with_different_texts(spark, documents):
    """Which of them the budget leaves out does not change from run to run."""
    rows = [(None, f"{i} " + "w " * 9, "a") for i in range(90)] + [(i, "w " * 10, "b") for i in range(40)]
    runs = [Counter(r.text for r in mixing.mix(documents(rows)).collect()) for _ in range(2)]
    assert runs[0] == runs[1] and sum(runs[0].values()) == 195
    assert sum(r.taken for r in mixing.taken_words(documents(rows)).collect()) == 1950


def test_sources_are_interleaved(spark, documents):
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(400)]
    placed = mixing.mix(documents(rows), weights=(3.0, 1.0), share=1.0, placed=True).orderBy("place").collect()
    for k in range(0, 300, 50):
        share = sum(r.source == "a" for r in placed[: k + 50]) / (k + 50)
        assert share == pytest.approx(0.75, abs=0.03)
