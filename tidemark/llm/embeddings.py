"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation learned by iterative quantisation turns unit vectors into balanced binary codes. It leaves the
origin in place, from which cosine is measured; centring would cut a dense group apart. The code is cut into substrings of about 16 bits, a table each. A vector enters a table under its substring and
under every substring one bit off, so two vectors meet where their substrings differ in at most two
bits. Pairs that meet are counted in one place only: in the first table and under the smallest key they
share. There the codes tell which members have a candidate, and only these are sent with their original
vectors and compared by cosine in double precision.

Copies - equal vectors of one label - are one row throughout; links are counted where they are found and
leave a task as counts and a forest, never as all pairs. Buckets of more than ``BLOCK`` members are dealt out
as pairs of blocks. The rotation is fit on a bounded sample (``SAMPLE`` distinct vectors, those of the
smallest hash); every vector is indexed.

Recall: two vectors at the least cosine of 0.93 differ in a bit with probability 0.12, so a substring of
16 bits differs in more than two with probability 0.3, and all four do with 0.01. Codes have 64 bits at any
length of vector: shorter ones are turned in several ways. The tests measure recall against brute
force, also at 8 to 24 components.

Defined cases: vectors that are null, empty or zero, hold null or non-finite components, or have no
label or no vec_id link with nothing; vectors of different length never link; rows that repeat a vec_id are vectors
of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import join_per_key
from tidemark.llm.common import cut_lineage, stored
from tidemark.llm.components import components

LEAST_COSINE = 0.93
MOST_BITS_OFF = 18
BITS = 64
TABLE_BITS = 16
SAMPLE = 20_000
ROUNDS = 40
BLOCK = 8_000

_ROWS = 100_000
_TILE = 1_024


# ---- codes -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Quantiser:
    """A rotation; ``length`` is that of the longest vectors, shorter ones are padded."""

    length: int
    rotation: np.ndarray

    @property
    def widths(self) -> list[int]:
        bits = self.rotation.shape[1]
        n = -(-bits // TABLE_BITS)
        return [bits // n + (i < bits % n) for i in range(n)]

    def codes(self, vectors: list[np.ndarray]) -> np.ndarray:
        x = unit(vectors, self.length)
        bits = (x @ self.rotation > 0).astype(np.uint64)
        return bits @ (np.uint64(1) << np.arange(bits.shape[1], dtype=np.uint64))


def unit(vectors: list[np.ndarray], length: int) -> np.ndarray:
    out = np.zeros((len(vectors), length))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    scale = np.abs(out).max(axis=1, keepdims=True)
    out /= np.where(scale > 0, scale, 1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def learned(x: np.ndarray, bits: int = BITS) -> Quantiser:
    """Principal axes, then the rotation that brings their values closest to their signs.

    Vectors of fewer components than bits are turned further, each time by a fixed rotation behind the
    learned one, until their codes are as long as any.
    """
    axes = np.linalg.svd(x.T @ x)[0][:, :bits]
    v = x @ axes
    spun = [np.linalg.qr(np.random.default_rng(7 + i).normal(size=(v.shape[1],) * 2))[0] for i in range(-(-bits // v.shape[1]))]
    turn = spun[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(v.T @ np.where(v @ turn > 0, 1.0, -1.0))
        turn = left @ right
    turns = [axes @ turn, *(axes @ turn @ further for further in spun[1:])]
    return Quantiser(x.shape[1], np.concatenate(turns, axis=1)[:, :bits])


def substrings(codes: np.ndarray, widths: list[int]) -> list[np.ndarray]:
    out, at = [], 0
    for w in widths:
        out.append((codes >> np.uint64(at)).astype(np.int64) & ((1 << w) - 1))
        at += w
    return out


def table_keys(codes: np.ndarray, widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys (table, substring) of every entry."""
    rows, keys = [], []
    for t, (part, w) in enumerate(zip(substrings(codes, widths), widths)):
        flips = np.r_[0, 1 << np.arange(w)]
        keys.append((t << 32 | part[:, None] ^ flips).ravel())
        rows.append(np.repeat(np.arange(len(codes)), len(flips)))
    return np.concatenate(rows), np.concatenate(keys)


def _first_met(a: np.ndarray, b: np.ndarray, widths: list[int]) -> np.ndarray:
    """The key at which each pair of codes is counted; -1 where the tables never show it."""
    found = np.full(np.broadcast(a, b).shape, -1, np.int64)
    for t in range(len(widths) - 1, -1, -1):
        x, y = substrings(a, widths)[t], substrings(b, widths)[t]
        x, off = np.broadcast_arrays(x, x ^ y)
        n = np.bitwise_count(off.view(np.uint64) if off.flags.c_contiguous else off.astype(np.uint64))
        top = x.copy()
        for shift in (1, 2, 4, 8, 16):
            top |= top >> shift
        low = off & -off
        one_off = np.minimum(x ^ low, x ^ (off ^ low))
        key = np.where(n == 0, x & (top >> 1), one_off)
        found = np.where(n <= 2, t << 32 | key, found)
    return found


# ---- buckets ---------------------------------------------------------------------------------


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with ``pair`` (and their block in ``own``): buckets of more than BLOCK members as pairs of blocks.

    ``rows`` has ``bucket`` and ``id``. The table of large buckets has at most one row per BLOCK rows.
    """
    large = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    large = cut_lineage(large.select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    if large.isEmpty():
        return rows.withColumns({"pair": F.lit(0), "own": F.lit(0)})
    met = rows.join(large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    met = met.withColumn("own", own).withColumn("other", other)
    pair = F.least("own", "other") * F.lit(1 << 15) + F.greatest("own", "other")
    return met.withColumn("pair", pair.cast("int")).drop("blocks", "other")


def _by_bucket(rows: DataFrame, work: Callable[[pa.Table], pa.RecordBatch | None], ddl: str) -> DataFrame:
    """``work`` on slices of whole buckets: about _ROWS rows or one pair of blocks, if that is more."""
    dealt = _dealt(rows)
    columns = [c for c in dealt.columns if c not in ("bucket", "pair")]
    sorted_ = dealt.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < _ROWS:
                continue
            table = pa.Table.from_batches(held)
            ends = _starts(table)[-1]
            held = table.slice(ends).combine_chunks().to_batches()
            if ends and (out := work(table.slice(0, ends))) is not None:
                yield out
        if held and (out := work(pa.Table.from_batches(held))) is not None:
            yield out

    return sorted_.select("bucket", "pair", *columns).mapInArrow(run, ddl)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _starts(table: pa.Table) -> np.ndarray:
    bucket, pair = table.column("bucket"), _numbers(table, "pair")
    code = bucket.combine_chunks().dictionary_encode()
    code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy()
    return np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (pair[1:] != pair[:-1])])


def _pairs(table: pa.Table, codes: np.ndarray, widths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of pairs that are counted in their bucket, tile by tile.

    Within a pair of different blocks, only members of different blocks are paired.
    """
    starts = _starts(table)
    ends = np.r_[starts[1:], table.num_rows]
    own, pair = _numbers(table, "own"), _numbers(table, "pair")
    key = np.array([int(b.rpartition("/")[2]) for b in table.column("bucket").to_pylist()])
    sizes = np.repeat(ends - starts, ends - starts)
    number = np.repeat(np.arange(len(starts)), ends - starts)
    crossing = (pair >> 15) != (pair & ((1 << 15) - 1))

    def counted(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (~crossing[i] | (own[i] != own[j])) & (_first_met(codes[i], codes[j], widths) == key[i])
        return i[ok], j[ok]

    small = np.flatnonzero((sizes > 1) & (sizes <= 64))
    group = number[small]
    for step in range(1, int(sizes[small].max(initial=1))):
        at = np.flatnonzero(group[step:] == group[:-step])
        if at.size:
            yield counted(small[at], small[at + step])
    for s, e in zip(starts[ends - starts > 64], ends[ends - starts > 64]):
        for i0 in range(s, e, _TILE):
            for j0 in range(i0, e, _TILE):
                i, j = np.meshgrid(np.arange(i0, min(e, i0 + _TILE)), np.arange(j0, min(e, j0 + _TILE)), indexing="ij")
                upper = i < j
                yield counted(i[upper], j[upper])


# ---- the operator ----------------------------------------------------------------------------


def _usable() -> Column:
    """Whether a row has an id, a label and a vector with a direction; never null."""
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    some = F.exists("embedding", lambda c: c != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & some, F.lit(False))


def fit(reps: DataFrame, sample: int = SAMPLE) -> Quantiser | None:
    """The quantiser of a bounded sample of distinct vectors."""
    length = reps.agg(F.max(F.size("embedding"))).first()[0]
    if length is None:
        return None
    got = reps.select(F.xxhash64("form").alias("h"), "form", "embedding").orderBy("h", "form").limit(sample)
    vectors = [np.array(r["embedding"], dtype=np.float64) for r in got.collect()]
    return learned(unit(vectors, length))


def _indexed(reps: DataFrame, quantiser: Quantiser) -> DataFrame:
    """Each distinct vector's code under each of its keys, per label and vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4_096):
                batch = whole.slice(at, 4_096)
                ids = batch.column(0).to_numpy()
                labels = batch.column(1).to_pylist()
                vectors = [np.array(v, np.float64) for v in batch.column(2).to_pylist()]
                codes = quantiser.codes(vectors)
                row, key = table_keys(codes, quantiser.widths)
                heads = [f"{k}/{len(v)}/" for k, v in zip(labels, vectors)]
                bucket = [heads[r] + str(k) for r, k in zip(row.tolist(), key.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array(ids[row]), pa.array(codes[row].view(np.int64))],
                    names=["bucket", "id", "code"],
                )

    return reps.select("id", F.col("label").cast("string"), "embedding").mapInArrow(
        run, "bucket string, id bigint, code bigint"
    )


def _candidates(index: DataFrame, widths: list[int]) -> DataFrame:
    """Members of buckets that have a candidate counted there."""

    def work(table: pa.Table) -> pa.RecordBatch | None:
        codes = _numbers(table, "code").view(np.uint64)
        hit = np.zeros(table.num_rows, bool)
        for i, j in _pairs(table, codes, widths):
            near = np.bitwise_count(codes[i] ^ codes[j]) <= MOST_BITS_OFF
            hit[i[near]] = hit[j[near]] = True
        kept = table.filter(pa.array(hit)).select(["bucket", "id", "code"]).combine_chunks()
        return kept.to_batches()[0] if kept.num_rows else None

    return _by_bucket(index, work, "bucket string, id bigint, code bigint")


def _links(members: DataFrame, reps: DataFrame, quantiser: Quantiser, least: float) -> DataFrame:
    """Per bucket and member: how many vectors it links with, and one linked member each (a forest)."""
    widths = quantiser.widths
    rows = members.distinct().join(reps.select("id", "alike", "embedding"), "id")

    def work(table: pa.Table) -> pa.RecordBatch | None:
        ids, alike = _numbers(table, "id"), _numbers(table, "alike")
        codes = _numbers(table, "code").view(np.uint64)
        vectors = [np.array(v, np.float64) for v in table.column("embedding").to_pylist()]
        x = unit(vectors, max(map(len, vectors)))
        n = np.zeros(len(ids), np.int64)
        root = np.arange(len(ids))
        for i, j in _pairs(table, codes, widths):
            for at in range(0, len(i), 1 << 17):
                a, b = i[at : at + (1 << 17)], j[at : at + (1 << 17)]
                linked = np.einsum("ij,ij->i", x[a], x[b]) >= least
                a, b = a[linked], b[linked]
                np.add.at(n, a, alike[b])
                np.add.at(n, b, alike[a])
                root = _joined(root, a, b)
        hit = np.flatnonzero(n)
        if not hit.size:
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[hit]), pa.array(n[hit]), pa.array(ids[root[hit]])], names=["id", "n", "near"]
        )

    return _by_bucket(rows, work, "id bigint, n bigint, near bigint")


def _joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` after joining a - b: each position's smallest reached one, by repeated halving."""
    while a.size:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for side in (root[a], root[b], a, b):
            np.minimum.at(new, side, low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


def near_duplicates(rows: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Per vector: its number of links, its component's smallest vec_id, and whether it is that one."""
    rows = rows.select("vec_id", "embedding", "label")
    # Equal for copies only.
    form = F.md5(F.concat_ws("|", F.col("label").cast("string"), F.to_json(F.col("embedding"))))
    usable = stored(rows.filter(_usable()).withColumn("form", form), "vectors")
    per_form = usable.groupBy("form").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("alike"))
    firsts = usable.join(per_form, ["form", "vec_id"]).dropDuplicates(["form"])
    reps = firsts.select(F.col("vec_id").alias("id"), "form", "label", "embedding", "alike")
    reps = stored(reps, "distinct-vectors")
    quantiser = fit(reps)
    if quantiser is None:
        links = reps.select("id", F.lit(0).cast("bigint").alias("n"), F.col("id").alias("near")).limit(0)
    else:
        members = stored(_candidates(_indexed(reps, quantiser), quantiser.widths), "candidates")
        links = stored(_links(members, reps, quantiser, least), "vector-links")
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(links.select(F.col("id").alias("u"), F.col("near").alias("v"))).withColumnRenamed("u", "id")
    per_rep = reps.select("id", "form", "alike").join(counts, "id", "left").join(roots, "id", "left")
    per_rep = per_rep.select(
        "form",
        "alike",
        (F.coalesce("n", F.lit(0)) + F.col("alike") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
    )
    linked = join_per_key(usable.select("vec_id", "form"), per_rep, "form", "alike")
    apart = rows.filter(~_usable()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    found = linked.select("vec_id", "n_links", "component_id").unionByName(apart)
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))

