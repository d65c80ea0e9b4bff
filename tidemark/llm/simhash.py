"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of at most 23 bits. Two fingerprints that differ
in at most three bits differ in at most one bit in at least two of the segments. Each segment is read
as a word of the perfect (23, 12, 7) Golay code: it lies within distance 3 of exactly one codeword.
Words at distance 3 of theirs have five more codewords at distance 4. If two words differ in one
bit and decode to different codewords, each lies at distance 4 of the other's; so a word that is
keyed by its own codeword, and by those at distance 4 with a smaller index, shares a key with
every word one bit away. A pair of segments gives the product of their keys; fingerprints that share one
are compared bit by bit.

Equal fingerprints are one row throughout. Keys of more than ``BLOCK`` fingerprints are dealt out as pairs
of blocks, so no task holds more than two blocks. Links leave a task as a forest, never as all pairs.

Defined cases: null, empty and blank texts have fingerprint zero, linked like any other; one or two words
are one shingle; repeated rows get equal results; a null doc_id is never a component's id unless no
row of it has one; an empty table gives no rows; other columns are ignored or carried by ``deduplicated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.skew import join_per_key
from tidemark.llm.common import cut_lineage, stored
from tidemark.llm.components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCK = 20_000

# Generator polynomial of the binary Golay code, its length and dimension.
GENERATOR = 0b110001110101
LENGTH, DIMENSION = 23, 12
CHECKS = LENGTH - DIMENSION

#: Bits of a fingerprint per segment, from the lowest.
SEGMENTS = (22, 21, 21)

_SLICE = 1 << 16
_SMALL = 48
_ROWS = 200_000


# ---- fingerprints ----------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """Majority of the bits of all shingle hashes of the lower-cased words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(SHINGLE, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for i in range(0, len(first), _SLICE):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(first[i : i + _SLICE], last[i : i + _SLICE])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > len(first)).tobytes(), "big")


@F.pandas_udf(T.LongType())
def print_of(texts: pd.Series) -> pd.Series:
    """Fingerprints as signed 64-bit numbers."""
    found = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
    return pd.Series(found.view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and its fingerprint."""
    return docs.select("doc_id", print_of("text").alias("print"))


# ---- Golay keys ------------------------------------------------------------------------------


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each word by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECKS)), rest)
    return rest


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per syndrome: the error of least weight, its weight, and the five errors of weight 4 if that is 3."""
    error, weight = np.zeros(1 << CHECKS, np.int64), np.zeros(1 << CHECKS, np.int64)
    for w in (1, 2, 3, 4):
        words = np.array([sum(1 << i for i in c) for c in combinations(range(LENGTH), w)])
        found = _syndromes(words)
        if w < 4:
            error[found], weight[found] = words, w
            continue
        by_syndrome = words[np.argsort(found, kind="stable")].reshape(-1, 5)
        four = np.zeros((1 << CHECKS, 5), np.int64)
        four[np.sort(found)[::5]] = by_syndrome
    return error, weight, four


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of 23-bit words, six columns, and which of them are keys."""
    error, weight, four = _tables()
    found = _syndromes(words)
    own = (words ^ error[found]) >> CHECKS
    others = (words[:, None] ^ four[found]) >> CHECKS
    used = (weight[found] == 3)[:, None] & (others < own[:, None])
    return np.column_stack([own, others]), np.column_stack([np.ones(len(words), bool), used])


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: pair of segments and one codeword index of each."""
    parts, at = [], 0
    for width in SEGMENTS:
        parts.append(segment_keys((prints >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1)))
        at += width
    rows, found = [], []
    for pair, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        both = parts[i][1][:, :, None] & parts[j][1][:, None, :]
        row, a, b = np.nonzero(both)
        rows.append(row)
        found.append((pair << 2 * DIMENSION) | (parts[i][0][row, a] << DIMENSION) | parts[j][0][row, b])
    return np.concatenate(rows), np.concatenate(found)


def keyed(prints: DataFrame) -> DataFrame:
    """Each distinct fingerprint under each of its keys."""
    schema = pa.schema([("key", pa.int32()), ("print", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            row, key = keys(values.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array(values[row])], schema=schema)

    return prints.select("print").mapInArrow(run, "key int, print bigint")


# ---- links -----------------------------------------------------------------------------------


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= DISTANCE


def _forest(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node number that each node reaches by links a - b."""
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _linked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links of one large group: each node is compared with those not yet reached."""
    rest, out_a, out_b = values, [], []
    while rest.size:
        wave, rest = rest[:1], rest[1:]
        while wave.size and rest.size:
            node, wave = wave[0], wave[1:]
            hit = _near(rest, node)
            if hit.any():
                out_a.append(rest[hit])
                out_b.append(np.full(int(hit.sum()), node))
                wave, rest = np.concatenate([wave, rest[hit]]), rest[~hit]
    none = [np.zeros(0, values.dtype)]
    return np.concatenate(out_a or none), np.concatenate(out_b or none)


def links_of(group: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (larger, smaller) that connect whatever is near within the groups, as a forest.

    ``group`` is sorted. Small groups are compared all at once by their distance in the table.
    """
    edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[edges, len(group)])
    size_at = np.repeat(sizes, sizes)
    found_a, found_b = [], []
    small = np.flatnonzero((size_at > 1) & (size_at <= _SMALL))
    g, v = group[small], values[small]
    for step in range(1, int(sizes[sizes <= _SMALL].max(initial=1))):
        at = np.flatnonzero(g[step:] == g[:-step])
        if not at.size:
            break
        at = at[_near(v[at], v[at + step])]
        found_a.append(v[at])
        found_b.append(v[at + step])
    for i in np.flatnonzero(sizes > _SMALL):
        a, b = _linked(np.unique(values[edges[i] : edges[i] + sizes[i]]))
        found_a.append(a)
        found_b.append(b)
    if not found_a:
        return values[:0], values[:0]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    nodes, number = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = _forest(nodes, number[: len(a)], number[len(a) :])
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def near_links(prints: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints: as connected as all pairs within DISTANCE bits."""
    rows = keyed(prints)
    hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    hot = cut_lineage(hot.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    whole = rows.withColumn("blocks", F.lit(0)) if hot.isEmpty() else _in_blocks(rows, hot)
    grouped = whole.repartition("key", "blocks").sortWithinPartitions("key", "blocks")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole groups in slices of about _ROWS rows; a group is at most two blocks."""
        keys_, values = [], []

        def done(last: bool) -> pa.RecordBatch | None:
            if not keys_:
                return None
            group, value = np.concatenate(keys_), np.concatenate(values)
            keys_.clear()
            values.clear()
            end = len(group) if last else int(np.flatnonzero(group != group[-1])[-1:].max(initial=-1)) + 1
            if end < len(group):
                keys_.append(group[end:])
                values.append(value[end:])
            a, b = links_of(group[:end], value[:end]) if end else (value[:0], value[:0])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)

        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            block = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            keys_.append(key << 32 | block)
            values.append(batch.column(2).to_numpy(zero_copy_only=False))
            if sum(map(len, keys_)) >= _ROWS:
                yield done(last=False)
        if (out := done(last=True)) is not None:
            yield out

    return grouped.select("key", "blocks", "print").mapInArrow(run, "u bigint, v bigint")


def _in_blocks(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """Rows of hot keys once for each pair of blocks that holds their own block."""
    own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    met = rows.join(hot, "key", "left").withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", other)
    pair = F.least("own", "other") * F.lit(1 << 15) + F.greatest("own", "other")
    return met.select("key", pair.cast("int").alias("blocks"), "print")


def grouped_prints(prints: DataFrame) -> DataFrame:
    """Per distinct fingerprint: how many rows have it, its smallest doc_id and its component's."""
    per_print = cut_lineage(
        prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("alike"))
    )
    roots = components(near_links(per_print)).withColumnRenamed("u", "print")
    rooted = per_print.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    per_root = rooted.groupBy("root").agg(
        F.min("first").alias("component_id"),
        F.min(F.struct(F.col("first").isNull(), "first", "print")).alias("best"),
        F.count(F.lit(1)).alias("n"),
    )
    stays = (F.col("print") == F.col("best.print")).alias("stays")
    return join_per_key(rooted, per_root, "root", "n").select("print", "alike", "first", "component_id", stays)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint and the smallest doc_id that links reach."""
    prints = stored(fingerprints(docs), "prints")
    per_print = grouped_prints(prints).select("print", "alike", "component_id")
    found = join_per_key(prints, per_print, "print", "alike")
    text = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", text.alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest doc_id; of rows alike in that, one.

    Everything is decided on narrow rows; the documents themselves are stored with a row number and
    moved once, to meet the numbers that stay.
    """
    packed = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", print_of("text").alias("print"))
    rows = stored(packed.withColumn("row", F.monotonically_increasing_id()), "printed")
    stay = grouped_prints(rows.select("doc_id", "print")).filter("stays")
    stay = stay.select(F.col("print").alias("stay"), F.col("first").alias("stay_id"))
    alike = (F.col("print") == F.col("stay")) & F.col("doc_id").eqNullSafe(F.col("stay_id"))
    kept = rows.select("row", "doc_id", "print").join(stay, alike).groupBy("stay").agg(F.min("row").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")
