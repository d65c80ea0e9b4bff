import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing
from tidemark.llm.queries import all_queries


def _ids(text):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def _expected(rows):
    out = Counter()
    for doc_id, text in rows:
        ids = _ids(text)
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            out[doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def _check(placed, rows):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed) == _expected(rows)
    by_sequence = defaultdict(list)
    for r in placed:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by_sequence), sum(r.length for r in placed)


def test_query_is_whole_and_tight(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    n, total = _check(all_queries()["op3_best_two_fit"](spark, sf).collect(), docs)
    assert n <= -(-total // 4096) + 1


def test_odd_rows(spark, documents, odd):
    docs = documents(odd)
    _check(packing.pack(docs).collect(), [(i, t) for i, t, _ in odd])
    assert packing.pack(docs.limit(0)).count() == 0
    whole = packing.sequences(docs).collect()
    assert Counter(i for r in whole for i in r.ids) == Counter(i for _, t, _ in odd for i in _ids(t))
    assert all(sum(r.lengths) == len(r.ids) <= 4096 for r in whole)


def test_two_replace_the_smallest():
    plan = list(packing.patterns({60: 1, 30: 1, 22: 1, 17: 1}, 100))
    assert sorted(plan[0][0]) == [17, 22, 60] and plan[0][1] == 1


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece(seed):
    draw = random.Random(seed)
    counts = Counter(draw.choice([draw.randint(1, 100), 7, 64]) for _ in range(5000))
    used, bins = Counter(), 0
    for chosen, times in packing.patterns(counts, 100):
        assert sum(chosen) <= 100
        bins += times
        for length in chosen:
            used[length] += times
    assert used == counts
    bound = max(sum(k * n for k, n in counts.items()) / 100, sum(n for k, n in counts.items() if k > 50))
    assert bins <= bound * 1.02 + 2


def test_ranks_come_from_the_sorted_ranges(spark, documents):
    """Many ranges, of which several hold one length: pieces are placed where they lie, without another shuffle."""
    rows = [(i, "word " * (i % 3 if i % 4 else 4100), "a") for i in range(120)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = packing.pack(documents(rows))
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert not any(step in plan for step in ("Exchange", "Window", "Join"))
        _check(placed.collect(), [(i, t) for i, t, _ in rows])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
