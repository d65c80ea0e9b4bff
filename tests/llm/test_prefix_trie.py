import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie
from tidemark.llm.queries import all_queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _lanes(salt, role, text):
    whole = hashlib.sha256(f"{salt}:{len(role)}:{role}{text}".encode()).hexdigest()
    lanes = [int(whole[8 * i : 8 * i + 8], 16) % prefix_trie.PRIME for i in range(4)]
    return lanes[0] << 31 | lanes[1], lanes[2] << 31 | lanes[3]


def _brute(rows):
    """The trie of tuples of turns."""
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            original[conv].append((turn is not None, turn or 0, _lanes(0, role or "", text or ""), role or "", text or ""))
    for turns in original.values():
        turns.sort()
    rebuilt = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        source = original.get(c - int(math.fmod(c, 20)), [])
        rebuilt[c] = tuple(t[3:] for t in source[:h] + turns[h:])
    members, children, ending = defaultdict(set), defaultdict(set), defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
            if d:
                children[path[: d - 1]].add(path[:d])
        ending[path].append(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[c] for c in children[node])
    sha = lambda n: hashlib.sha256(",".join(map(str, sorted(ending.get(n, [])))).encode()).hexdigest()
    return sorted(
        (
            (min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children[n]), leaves[n], saved[n], sha(n))
            for n, m in members.items()
        ),
        key=repr,
    )


def _same(df, rows):
    assert df.columns == COLUMNS
    assert sorted(map(tuple, df.collect()), key=repr) == _brute(rows)


def _frame(spark, rows, parts=3):
    full = [(*r, "x") for r in rows]
    return spark.createDataFrame(full, "conv_id bigint, turn bigint, role string, text string, node string").repartition(parts)


def _rows(seed, convs=120, hot=0):
    """Conversations that share beginnings, some alike, with gaps in their numbers."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-60, 3 * convs), convs):
        common = draw.random() < hot
        for t in range(draw.randint(1, 7)):
            text = "one two" if common and t < 2 else draw.choice(["a", "b b", "c  c\nc", ""])
            rows.append((c, t, draw.choice(["user", "assistant"]) if not common else "user", text))
    return rows


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    _same(all_queries()["op13_prefix_trie"](spark, SF), [tuple(r) for r in rows])


@pytest.mark.parametrize("shard", [None, 7])
def test_common_beginnings(spark, shard):
    """With small shards most of the upper trie is heavy and goes the other way."""
    rows = _rows(3, hot=0.5)
    _same(prefix_trie.trie(_frame(spark, rows), shard), rows)


def test_long_conversation_over_many_tasks(spark):
    rows = [(40, t, "user", f"{t % 3}") for t in range(900)] + [(41, t, "user", f"{t % 3}") for t in range(700)] + _rows(4, 20)
    rows = [r for r in rows if r[0] in (40, 41) or r[0] is None or r[0] > 60]
    _same(prefix_trie.trie(_frame(spark, rows, 8), 100), rows)


def test_odd_rows(spark):
    rows = [
        (0, 0, "user", "x y"), (0, None, "user", "first"), (0, 0, "user", "x y"), (0, 0, "tool", None), (1, 0, None, None),
        (2, 1, "", ""), (3, 5, "user", " "), (3, 5, "user", "same"), (3, 5, "user", "same"), (None, 0, "user", "nobody"),
        (25, 0, "a", "b"), (26, 0, "ab", ""), (27, 0, "", "ab"), (2**62, 0, "user", "long " * 50_000), (-7, 1, "user", "x y"),
        (45, 0, "user", "é中\U0001f600"), (46, None, None, None),
    ]
    df = _frame(spark, rows)
    _same(prefix_trie.trie(df), rows)
    _same(prefix_trie.trie(df, 2), rows)
    assert prefix_trie.trie(df.limit(0)).count() == 0
    assert prefix_trie.trie(df.filter("conv_id IS NULL")).count() == 0


def test_many_members_end_in_one_node(spark):
    """More members than a chunk of numbers or a shard holds."""
    rows = [(20 * c, 0, "user", "hello there") for c in range(9000)]
    _same(prefix_trie.trie(_frame(spark, rows), 1000), rows)


def test_slots_are_minimal_and_verified():
    draw = np.random.default_rng(0)
    for n in (1, 2, 100, 5000):
        a, b = draw.integers(0, 2**62, n), draw.integers(0, 2**62, n)
        table = prefix_trie.Slots(a, b)
        assert sorted(table.find(a, b).tolist()) == list(range(n))
        assert (table.find(a, b + 1) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.Slots(np.array([1, 1]), np.array([2, 2]))


def test_collision_is_found_and_hashed_anew(spark, monkeypatch):
    """Digests of two values only: nodes disagree, and other numbers are tried."""
    rows = [(c, t, role, text) for (c, t, role, text) in _rows(5, 30)]
    real, tried = prefix_trie.turns, []

    def weak(df, salt):
        tried.append(salt)
        out = real(df, salt)
        return out.withColumns({"a": F.col("a") % 2, "b": F.lit(0).cast("bigint")}) if salt == 0 else out

    monkeypatch.setattr(prefix_trie, "turns", weak)
    _same(prefix_trie.trie(_frame(spark, rows)), rows)
    assert tried == [0, 1]
