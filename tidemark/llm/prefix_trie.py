"""Conversations as a trie of their common beginnings, counted in hash tables with exactly one slot a node.

Every node is a distinct sequence of first turns. A turn is a digest of its role and text; a sequence
is the sum of its turns' digests, each times a power of a fixed number for its place, modulo a prime,
in four independent lanes. Sums of that form can be taken piecewise: turns are dealt out by range of
conversation and place, every task sums what it has, and conversations that go over a border between
tasks get the sums before it from a table with at most two rows a task. So a conversation of any
length is spread, and one that begins with turns of another has its nodes' digests by arithmetic.

Rows of (conversation, depth) are folded to nodes. Digests are checked: a node whose rows do not agree
in the node above it, the depth or the words is a collision, and all is done anew with other numbers.

Subtrees are summed in shards. A node below which at most ``SHARD`` rows lie is light. A light node
below a heavy one is the top of a piece, whole pieces go to tasks, and a task works on as many
as make a shard: a minimal perfect hash function gives each digest a slot - cells that one digest has for
itself are its slot, the other digests are hashed anew, until none is left - which is verified by
the digest kept there; counts are scattered to flat arrays by slot, and sums go up through the array
of parent slots, deepest nodes first. Heavy nodes, few by their definition, get the sums of the pieces
below them, and among themselves are summed by doubling: in each round a node adds what lies twice as
far below it. No task holds more than a shard and a batch, however common a first turn is.

Members that end in a node are joined in chunks of at most 4,096 numbers and hashed chunk by chunk.

Defined cases: turns are ordered by number, null first, and such alike in number by the digest of role
and text; null roles and texts are empty; rows without conv_id belong to no conversation and are left
out; repeated rows are turns of their own; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import join_per_key
from tidemark.llm.common import n_words, stored

#: Most nodes of a piece, and rows that a task gathers before it works on them.
SHARD = 10_000

#: Turns at most that a conversation takes over, and numbers that share a source.
TAKEN = 3
SOURCE = 20

PRIME = 2**31 - 1
LANES = 4
CHUNK_BITS = 12
EMPTY = hashlib.sha256(b"").hexdigest()


# ---- digests of sequences ------------------------------------------------------------------------


def bases(salt: int) -> list[int]:
    """The number of each lane whose powers weigh the places."""
    return [2 + int(hashlib.sha256(f"{salt}-{i}".encode()).hexdigest(), 16) % (PRIME - 2) for i in range(LANES)]


def _lanes(a: Column, b: Column) -> list[Column]:
    return [F.shiftright(a, 31), a.bitwiseAND(F.lit(PRIME)), F.shiftright(b, 31), b.bitwiseAND(F.lit(PRIME))]


def _packed(lanes: list[Column]) -> list[Column]:
    return [F.shiftleft(lanes[i], 31).bitwiseOR(lanes[i + 1]) for i in (0, 2)]


def _split(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([a >> 31, a & PRIME, b >> 31, b & PRIME])


def _joined(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return lanes[0] << 31 | lanes[1], lanes[2] << 31 | lanes[3]


def powers(base: int, exponents: np.ndarray) -> np.ndarray:
    """base ** exponents modulo the prime."""
    out, square = np.ones(len(exponents), np.int64), base
    for bit in range(int(exponents.max(initial=0)).bit_length()):
        out = np.where(exponents >> bit & 1, out * square % PRIME, out)
        square = square * square % PRIME
    return out


def turns(conversations: DataFrame, salt: int) -> DataFrame:
    """conv_id, turn, the digest of role and text, and the words of the text."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.lit(f"{salt}:"), F.length(role).cast("string"), F.lit(":"), role, text)
    shares = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.sha2(whole, 256).alias("hex"), n_words(text).alias("words")
    )
    lanes = [F.conv(F.substring("hex", 1 + 8 * i, 8), 16, 10).cast("bigint") % PRIME for i in range(LANES)]
    a, b = _packed(lanes)
    return shares.select("conv_id", "turn", a.alias("a"), b.alias("b"), "words")


def positions(found: DataFrame, salt: int) -> DataFrame:
    """Turns dealt out in order, with place and sum of digests within part and conversation, and the sum before."""
    r = bases(salt)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b")]
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    names = ["conv_id", "part", "place", "ta", "tb", "pa", "pb", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, total = None, 0, np.zeros(LANES, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, part, a, b, words = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            group = np.cumsum(np.r_[True, conv[1:] != conv[:-1]]) - 1
            goes_on = group == 0 if conv[0] == last else np.zeros(len(conv), bool)
            place = np.arange(len(conv)) - first[group] + 1 + np.where(goes_on, n, 0)
            terms = np.stack([x * powers(r[i], place) % PRIME for i, x in enumerate(_split(a, b))])
            run_ = np.cumsum(terms, axis=1)
            before = (run_[:, first] - terms[:, first])[:, group]
            sums = (run_ - before + np.where(goes_on, total[:, None], 0)) % PRIME
            last, n, total = conv[-1], int(place[-1]), sums[:, -1].copy()
            columns = [conv, part, place, *_joined(sums), *_joined((sums - terms) % PRIME), words]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)

    ddl = ", ".join(f"{c} bigint" for c in names)
    return dealt.select("conv_id", "part", "a", "b", "words").mapInArrow(run, ddl)


def carried(placed: DataFrame, salt: int) -> DataFrame:
    """``placed`` with places and sums over whole conversations."""
    spark, r = placed.sparkSession, bases(salt)
    parts = placed.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    parts = sorted(parts.collect(), key=lambda x: x.part)
    over = sorted({b.low for a, b in zip(parts, parts[1:]) if a.high == b.low})
    if not over:
        return placed.drop("part")
    crossing = spark.createDataFrame([(c,) for c in over], "conv_id bigint")
    ends = placed.join(F.broadcast(crossing), "conv_id").groupBy("conv_id", "part")
    ends = ends.agg(F.max(F.struct("place", "ta", "tb")).alias("end")).collect()
    rows, n, sums, now = [], 0, [0] * LANES, None
    for x in sorted(ends, key=lambda x: (x.conv_id, x.part)):
        if x.conv_id != now:
            now, n, sums = x.conv_id, 0, [0] * LANES
        weights = [pow(base, n, PRIME) for base in r]
        rows.append((x.conv_id, x.part, n, *sums, *weights))
        own = [x.end.ta >> 31, x.end.ta & PRIME, x.end.tb >> 31, x.end.tb & PRIME]
        n, sums = n + x.end.place, [(s + t * w) % PRIME for s, t, w in zip(sums, own, weights)]
    kinds = ", ".join(f"s{i} bigint" for i in range(LANES)) + ", " + ", ".join(f"w{i} bigint" for i in range(LANES))
    carry = spark.createDataFrame(rows, f"conv_id bigint, part bigint, n bigint, {kinds}")
    met = placed.join(F.broadcast(carry), ["conv_id", "part"], "left")

    def moved(a: str, b: str) -> list[Column]:
        lanes = _lanes(F.col(a), F.col(b))
        return _packed([
            (F.coalesce(f"s{i}", F.lit(0)) + x * F.coalesce(f"w{i}", F.lit(1))) % PRIME for i, x in enumerate(lanes)
        ])

    (ta, tb), (pa_, pb) = moved("ta", "tb"), moved("pa", "pb")
    place = (F.col("place") + F.coalesce("n", F.lit(0))).alias("place")
    return met.select("conv_id", place, ta.alias("ta"), tb.alias("tb"), pa_.alias("pa"), pb.alias("pb"), "words")


# ---- rebuilt conversations -----------------------------------------------------------------------


def heads(placed: DataFrame) -> DataFrame:
    """Per conversation: its turns, how many it takes over and has of these, and what its digests start from."""
    first = [F.max(F.when(F.col("place") == i + 1, F.struct("ta", "tb", "pa", "pb", "words"))) for i in range(TAKEN)]
    own = placed.groupBy("conv_id").agg(F.max("place").alias("n"), *[c.alias(f"t{i + 1}") for i, c in enumerate(first)])
    own = own.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % (TAKEN + 1))
    own = stored(own.withColumn("source", F.col("conv_id") - F.col("conv_id") % SOURCE), "heads")
    source = own.select(F.col("conv_id").alias("source"), *[F.col(f"t{i}").alias(f"b{i}") for i in range(1, TAKEN + 1)])
    met = own.join(source, "source", "left")
    has = sum((F.col(f"b{i}").isNotNull().cast("bigint") for i in range(1, TAKEN + 1)), F.lit(0))
    met = met.withColumn("k", F.least("h", has))

    def at(kind: str, count: str, field: str) -> Column:
        found = F.lit(0).cast("bigint")
        for i in range(1, TAKEN + 1):
            found = F.when(F.col(count) == i, F.col(f"{kind}{i}.{field}")).otherwise(found)
        return F.coalesce(found, F.lit(0))

    return met.select(
        "conv_id", "n", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"),
        at("t", "h", "ta").alias("oa"), at("t", "h", "tb").alias("ob"),
        at("b", "k", "ta").alias("ba"), at("b", "k", "tb").alias("bb"),
        *[f"b{i}" for i in range(1, TAKEN + 1)],
    )


def _root() -> Column:
    """The digest of no turns."""
    return F.struct(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))


def paths(placed: DataFrame, found: DataFrame, salt: int) -> DataFrame:
    """A row for each node that each rebuilt conversation passes; ``rest`` turns come after it."""
    inverse = [[pow(base, -s, PRIME) for s in range(TAKEN + 1)] for base in bases(salt)]
    per_conv = found.select("conv_id", "n", "h", "k", "total", "oa", "ob", "ba", "bb")
    tail = join_per_key(placed, per_conv, "conv_id", "n").filter(F.col("place") > F.col("h"))

    def rebuilt(a: str, b: str) -> list[Column]:
        own, base = _lanes(F.col("oa"), F.col("ob")), _lanes(F.col("ba"), F.col("bb"))
        out = []
        for i, lane in enumerate(_lanes(F.col(a), F.col(b))):
            weight = F.lit(inverse[i][0])
            for s in range(1, TAKEN + 1):
                weight = F.when(F.col("h") - F.col("k") == s, F.lit(inverse[i][s])).otherwise(weight)
            out.append(F.pmod(base[i] + (lane - own[i]) * weight % PRIME, F.lit(PRIME)))
        return _packed(out)

    depth = F.col("place") - F.col("h") + F.col("k")
    (da, db), (ua, ub) = rebuilt("ta", "tb"), rebuilt("pa", "pb")
    rows = tail.select("conv_id", depth.alias("depth"), F.struct(da.alias("a"), db.alias("b")).alias("node"),
                       F.struct(ua.alias("a"), ub.alias("b")).alias("above"), "words",
                       (F.col("total") - depth).alias("rest"))
    missing = F.lit(None).cast("struct<a:bigint,b:bigint>")
    begun = [F.struct(F.lit(0).cast("bigint").alias("depth"), _root().alias("node"), missing.alias("above"), F.lit(0).cast("bigint").alias("words"))]
    for i in range(1, TAKEN + 1):
        turn = F.col(f"b{i}")
        step = F.struct(F.lit(i).cast("bigint").alias("depth"), F.struct(turn.ta.alias("a"), turn.tb.alias("b")).alias("node"),
                        F.struct(turn.pa.alias("a"), turn.pb.alias("b")).alias("above"), turn.words.alias("words"))
        begun.append(F.when(F.col("k") >= i, step))
    top = found.select("conv_id", "total", F.explode(F.filter(F.array(*begun), lambda x: x.isNotNull())).alias("x"))
    top = top.select("conv_id", "x.depth", "x.node", "x.above", "x.words", (F.col("total") - F.col("x.depth")).alias("rest"))
    return rows.unionByName(top)


def folded(rows: DataFrame) -> DataFrame:
    """One row per node; ``weight`` is the number of rows at and below it."""
    same = F.struct("above", "depth", "words")
    return rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.min(same).alias("low"), F.max(same).alias("high"), F.sum(F.col("rest") + 1).alias("weight"),
    )


def ends(rows: DataFrame) -> DataFrame:
    """Per node in which conversations end: the digest of their numbers, in order."""
    chunks = rows.filter("rest = 0").groupBy("node", F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
    chunks = chunks.agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    chunks = chunks.select("node.a", "node.b", "chunk", "ids").repartition("a", "b").sortWithinPartitions("a", "b", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for batch in batches:
            rows: list[tuple] = []
            for a, b, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) == now:
                    state.update(b"," + ids.encode())
                    continue
                if now is not None:
                    rows.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(ids.encode())
            if rows:
                yield _ended(rows)
        if now is not None:
            yield _ended([(*now, state.hexdigest())])

    found = chunks.select("a", "b", "ids").mapInArrow(run, "a bigint, b bigint, ends_sha256 string")
    return found.select(F.struct("a", "b").alias("node"), "ends_sha256")


def _ended(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["a", "b", "ends_sha256"])


# ---- node tables ---------------------------------------------------------------------------------


class Slots:
    """A minimal perfect hash function over distinct pairs of numbers: a slot from 0 on for each.

    A level hashes the pairs to twice as many cells. A pair alone in its cell has its slot there, in the order
    of the cells; all others go to the next level. The pair of each slot is kept, so that others are told.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        rest, used = np.arange(len(a)), 0
        while rest.size:
            if len(self.levels) == 64:
                raise ValueError("digests are not distinct")
            cells = 2 * len(rest) + 1
            cell = self._cell(a[rest], b[rest], len(self.levels), cells)
            alone = np.bincount(cell, minlength=cells) == 1
            ranks = used + np.cumsum(alone) - 1
            self.levels.append((alone, ranks))
            own = alone[cell]
            self.a[ranks[cell[own]]], self.b[ranks[cell[own]]] = a[rest[own]], b[rest[own]]
            used += int(own.sum())
            rest = rest[~own]

    @staticmethod
    def _cell(a: np.ndarray, b: np.ndarray, level: int, cells: int) -> np.ndarray:
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64)
        x += np.uint64((level + 1) * 0xD1342543DE82EF95 % 2**64)
        for _ in range(2):
            x = (x ^ x >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ x >> np.uint64(32)) % np.uint64(cells)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each pair, -1 for pairs that have none."""
        slot, rest = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (alone, ranks) in enumerate(self.levels):
            cell = self._cell(a[rest], b[rest], level, len(alone))
            here = alone[cell]
            slot[rest[here]] = ranks[cell[here]]
            rest = rest[~here]
        found = slot >= 0
        found[found] = (self.a[slot[found]] == a[found]) & (self.b[slot[found]] == b[found])
        return np.where(found, slot, -1)


def summed(shard: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What each node of a shard has below it; a node whose parent lies outside has no parent_conv_id."""
    table = Slots(shard["a"], shard["b"])
    slot, parent = table.find(shard["a"], shard["b"]), np.full(len(shard["a"]), -1, np.int64)
    has = shard["has"]
    parent[slot[has]] = table.find(shard["ua"][has], shard["ub"][has])
    by_slot = {}
    for name in ("conv_id", "depth", "n_convs", "words"):
        by_slot[name] = np.empty(len(slot), np.int64)
        by_slot[name][slot] = shard[name]
    children = np.bincount(parent[parent >= 0], minlength=len(slot))
    leaves = (children == 0).astype(np.int64)
    saved = (by_slot["n_convs"] - 1) * by_slot["words"]
    order = np.argsort(-by_slot["depth"], kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(by_slot["depth"][order])) + 1)
    for nodes in levels:
        nodes = nodes[parent[nodes] >= 0]
        np.add.at(leaves, parent[nodes], leaves[nodes])
        np.add.at(saved, parent[nodes], saved[nodes])
    above = parent[slot]
    return {
        "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot],
        "inside": above >= 0, "parent_conv_id": by_slot["conv_id"][np.maximum(above, 0)],
    }


_SHARD_COLUMNS = ["ta", "tb", "a", "b", "has", "ua", "ub", "conv_id", "depth", "n_convs", "words"]


def in_shards(nodes: DataFrame, shard: int | None = None) -> DataFrame:
    """Nodes with their ``top``, summed shard by shard; a shard holds whole pieces."""
    most = shard or SHARD
    flat = nodes.select(
        F.col("top.a").alias("ta"), F.col("top.b").alias("tb"), "node.a", "node.b", F.col("above").isNotNull().alias("has"),
        F.coalesce("above.a", F.lit(0)).alias("ua"), F.coalesce("above.b", F.lit(0)).alias("ub"),
        "conv_id", "depth", "n_convs", "words",
    )
    dealt = flat.repartition("ta", "tb").sortWithinPartitions("ta", "tb")
    given = ["a", "b", "has", "ua", "ub", "conv_id", "depth", "n_convs"]
    made = ["n_children", "n_leaves", "saved_tokens", "inside", "parent_conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict[str, np.ndarray]] = []

        def work(last: bool) -> Iterator[pa.RecordBatch]:
            rows = {c: np.concatenate([w[c] for w in waiting]) for c in _SHARD_COLUMNS}
            waiting.clear()
            n = len(rows["ta"])
            edge = np.flatnonzero((rows["ta"][1:] != rows["ta"][:-1]) | (rows["tb"][1:] != rows["tb"][:-1])) + 1
            end = n if last else int(edge[-1]) if edge.size else 0
            if end < n:
                waiting.append({c: v[end:] for c, v in rows.items()})
            if end:
                rows = {c: v[:end] for c, v in rows.items()}
                out = {c: rows[c] for c in given} | summed(rows)
                arrays = [pa.array(out[c]) for c in given + made]
                yield pa.RecordBatch.from_arrays(arrays, names=given + made)

        for batch in batches:
            columns = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            waiting.append(dict(zip(_SHARD_COLUMNS, columns)))
            if sum(len(w["ta"]) for w in waiting) >= most:
                yield from work(last=False)
        if waiting:
            yield from work(last=True)

    kinds = {"has": "boolean", "inside": "boolean"}
    found = dealt.mapInArrow(run, ", ".join(f"{c} {kinds.get(c, 'bigint')}" for c in given + made))
    return found.select(
        F.struct("a", "b").alias("node"), F.when(F.col("has"), F.struct(F.col("ua").alias("a"), F.col("ub").alias("b"))).alias("above"),
        "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "inside",
        F.when(F.col("inside"), F.col("parent_conv_id")).alias("parent_conv_id"),
    )


def tops(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Per conversation the first light node on its path, and how many rows it has from there on."""
    passed = join_per_key(rows, heavy.select("node", "n_convs"), "node", "n_convs")
    cut = passed.groupBy("conv_id").agg(F.max("depth").alias("cut"), F.max(F.col("rest") + F.col("depth") + 1).alias("n"))
    met = join_per_key(rows, cut, "conv_id", "n").filter(F.col("depth") == F.col("cut") + 1)
    return met.select("conv_id", F.col("node").alias("top"), (F.col("rest") + 1).alias("below"))


def doubled(heavy: DataFrame) -> DataFrame:
    """Sums of n_leaves and saved_tokens over the subtrees of a table of nodes (node, above, …)."""
    now = stored(heavy.withColumn("up", F.col("above")), "heavy")
    while not now.filter("up IS NOT NULL").isEmpty():
        far = now.filter("up IS NOT NULL").groupBy("up")
        far = far.agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved"), F.count(F.lit(1)).alias("n"))
        far = stored(far, "heavy-sums")
        with_sums = now.join(far.drop("n").withColumnRenamed("up", "node"), "node", "left")
        jumps = far.select(F.col("up").alias("node"), "n").join(now.select("node", F.col("up").alias("next")), "node")
        further = now.filter("up IS NOT NULL").select("node", "up")
        further = join_per_key(further, jumps.withColumnRenamed("node", "up"), "up", "n").select("node", "next")
        now = with_sums.drop("up").join(further.withColumnRenamed("next", "up"), "node", "left")
        plus = {"n_leaves": "more_leaves", "saved_tokens": "more_saved"}
        now = now.withColumns({c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in plus.items()}).drop(*plus.values())
        now = stored(now, "heavy")
    return now.drop("up")


def _heavy_summed(heavy: DataFrame, light: DataFrame | None) -> DataFrame:
    """Heavy nodes with the sums of the pieces and heavy nodes below them, and n_children."""
    below = heavy.filter("above IS NOT NULL").select("above", F.lit(0).alias("n_leaves"), F.lit(0).alias("saved_tokens"))
    if light is not None:
        below = below.unionByName(light.filter("NOT inside").select("above", "n_leaves", "saved_tokens"))
    given = below.groupBy(F.col("above").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    met = heavy.join(given, "node", "left")
    none = F.lit(0).cast("bigint")
    own = (F.col("n_convs") - 1) * F.col("words")
    met = met.select(
        "node", "above", "conv_id", "depth", "n_convs", F.coalesce("n_children", none).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.coalesce("n_leaves", none)).cast("bigint").alias("n_leaves"),
        (own + F.coalesce("saved_tokens", none)).cast("bigint").alias("saved_tokens"),
    )
    return doubled(met)


def trie(conversations: DataFrame, shard: int | None = None) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    most, salt = shard or SHARD, 0
    while True:
        placed = stored(positions(stored(turns(conversations, salt), "turns"), salt), "places")
        placed = carried(placed, salt)
        found = stored(heads(placed), "conversations")
        rows = stored(paths(placed, found, salt), "paths")
        nodes = stored(folded(rows), "nodes")
        if nodes.filter("NOT low <=> high").isEmpty():
            break
        salt += 1
    nodes = nodes.select("node", "low.above", "low.depth", "low.words", "conv_id", "n_convs", "weight")
    heavy = nodes.filter(F.col("weight") > most)
    if heavy.isEmpty():
        out = in_shards(nodes.withColumn("top", _root()), most)
    else:
        top = tops(rows, heavy)
        light = nodes.filter(F.col("weight") <= most)
        light = stored(in_shards(join_per_key(light, top, "conv_id", "below"), most), "light")
        spine = _heavy_summed(heavy, light)
        lone = spine.unionByName(light.filter("NOT inside").select(*spine.columns))
        parents = spine.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children"))
        parents = parents.withColumnRenamed("n_children", "fan")
        joined = join_per_key(lone.filter("above IS NOT NULL"), parents, "above", "fan").drop("fan")
        root = lone.filter("above IS NULL").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
        out = joined.unionByName(root).unionByName(light.filter("inside").select(*joined.columns))
    out = out.join(ends(rows), "node", "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
