"""Vectors compressed to one code byte per part, codebooks learnt exactly over metric trees.

Components become whole numbers, vectors are cut into equal parts, and each part position has a
codebook, learnt in a fixed number of rounds: every part goes to its nearest entry, every entry
becomes the rounded-down mean of its parts.

What a round needs of the parts is their number and sum per entry. Tasks cut the vectors into blocks
and build, once, a metric tree for each part of a block by the anchors hierarchy: about sqrt(n)
anchors take the points nearest to them - a point nearer to its anchor than half way to a new one is
not looked at - and are then merged upwards, the pair with the smallest common ball first, and split
downwards in the same way. Each ball keeps the sum and number of its points. A round walks down the
balls with a list of the entries that may own a point of it. An entry goes from the list if the
whole ball lies on the other side of the plane half way between it and the entry nearest to the
centre; children inherit the list. A ball left with one entry is counted by its sum; in leaves the
points are compared with the entries left on the list. Sums are of whole numbers, so the result does
not depend on how rows are dealt out.

Distances are exact: numbers whose squares would not fit a double are worked on as whole numbers of
any size. A codebook has at most 256 entries, and a task sends one row per entry and component; no
vector leaves its task while learning.

Defined cases: vectors that are null or hold a null, infinite or not-a-number component are dropped;
shorter vectors end in zeros, up to the longest and to a whole number of parts; with fewer vectors
than entries there are as many entries as vectors; a null vec_id comes after all others, and rows
alike in vec_id are ordered by their components; repeated rows count each for itself; an empty table
gives no rows; errors beyond 63 bits are given as the largest long; other columns are ignored.
Doubles of 2^128 and more, which no 32-bit float holds, count as infinite.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.skew import join_per_key
from tidemark.llm.common import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

#: Vectors of one block, whose trees are built together, and points of a leaf.
BLOCK = 4096
LEAF = 24

_EXACT = 2**53
_LIMB = 48
_LONGEST = 2**63 - 1


# ---- numbers -------------------------------------------------------------------------------------


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers: doubles if no sum of squares can be inexact, else Python's own."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    return scaled if exact(scaled) else np.frompyfunc(int, 1, 1)(scaled)


def exact(numbers: np.ndarray) -> bool:
    """Whether doubles hold every squared distance between such rows exactly."""
    if not numbers.size:
        return True
    most = max(abs(int(numbers.max())), abs(int(numbers.min())))
    return 4 * numbers.shape[1] * most * most < _EXACT


def alike(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if that is exact for the two together, else both as Python's whole numbers."""
    if points.dtype != object and exact(book) and exact(points):
        return points, book.astype(np.float64)
    return (points if points.dtype == object else np.frompyfunc(int, 1, 1)(points)), book.astype(object)


# ---- metric trees --------------------------------------------------------------------------------


class Balls(NamedTuple):
    """Nodes of a metric tree, the first one the root; ``order`` holds the rows of each side by side."""

    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray
    sums: np.ndarray
    radius: np.ndarray


def anchored(points: np.ndarray, n: int) -> np.ndarray:
    """Number of the anchor, of at most ``n``, that owns each point."""
    owner, anchors = np.zeros(len(points), np.int64), [0]
    near = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(anchors) < n:
        reach = np.zeros(len(anchors))
        np.maximum.at(reach, owner, near)
        widest = int(reach.argmax())
        if reach[widest] == 0:
            break
        own = np.flatnonzero(owner == widest)
        new = int(own[near[own].argmax()])
        gap = np.sqrt(((points[anchors] - points[new]) ** 2).sum(axis=1))
        asked = np.flatnonzero(near > gap[owner] / 2)
        found = np.sqrt(((points[asked] - points[new]) ** 2).sum(axis=1))
        taken = found < near[asked]
        owner[asked[taken]], near[asked[taken]] = len(anchors), found[taken]
        owner[new], near[new] = len(anchors), 0
        anchors.append(new)
    return owner


def _merged(groups: list, points: np.ndarray) -> tuple:
    """Binary tree over subtrees (rows, left, right): the two with the smallest common ball first."""
    centres = np.array([points[g[0]].mean(axis=0) for g in groups])
    radii = np.array([np.sqrt(((points[g[0]] - c) ** 2).sum(axis=1)).max() for g, c in zip(groups, centres)])
    counts = np.array([len(g[0]) for g in groups], np.float64)

    def common(i: int) -> np.ndarray:
        gap = np.sqrt(((centres - centres[i]) ** 2).sum(axis=1))
        return np.maximum((gap + radii + radii[i]) / 2, np.maximum(radii, radii[i]))

    cost = np.array([common(i) for i in range(len(groups))])
    np.fill_diagonal(cost, np.inf)
    nodes = list(groups)
    for _ in range(len(nodes) - 1):
        a, b = divmod(int(cost.argmin()), len(nodes))
        nodes[a] = (np.concatenate([nodes[a][0], nodes[b][0]]), nodes[a], nodes[b])
        radii[a] = cost[a, b]
        centres[a] = (counts[a] * centres[a] + counts[b] * centres[b]) / (counts[a] + counts[b])
        counts[a] += counts[b]
        nodes[b] = None
        gone = np.isinf(cost[a]) & (np.arange(len(nodes)) != a)
        cost[a] = common(a)
        cost[a, gone] = cost[a, a] = np.inf
        cost[a, b] = np.inf
        cost[:, a] = cost[a]
        cost[b] = cost[:, b] = np.inf
    return next(n for n in nodes if n is not None)


def _grown(points: np.ndarray, rows: np.ndarray) -> tuple:
    if len(rows) <= LEAF:
        return rows, None, None
    owner = anchored(points[rows], int(np.ceil(np.sqrt(len(rows)))))
    if not owner.any():
        return rows, None, None
    groups = [_grown(points, rows[owner == i]) for i in range(int(owner.max()) + 1) if (owner == i).any()]
    return _merged(groups, points)


def balls(numbers: np.ndarray) -> Balls:
    """The metric tree of some rows, with the sum of each ball's rows and the reach from their mean."""
    points = numbers.astype(np.float64)
    nodes, order, start, left, right = [_grown(points, np.arange(len(points)))], [], [], [], []
    at, places = 0, [0]
    while at < len(nodes):
        rows, a, b = nodes[at]
        start.append(places[at])
        left.append(len(nodes) if a else -1)
        right.append(len(nodes) + 1 if a else -1)
        if a:
            nodes += [a, b]
            places += [places[at], places[at] + len(a[0])]
        at += 1
    order = nodes[0][0]
    sums = np.array([numbers[n[0]].sum(axis=0) for n in nodes], dtype=numbers.dtype)
    counts = np.array([len(n[0]) for n in nodes])
    centres = sums.astype(np.float64) / counts[:, None]
    radius = [np.sqrt(((points[n[0]] - c) ** 2).sum(axis=1)).max() for n, c in zip(nodes, centres)]
    start = np.array(start)
    return Balls(order, start, start + counts, np.array(left), np.array(right), sums, np.array(radius))


def owners(tree: Balls, numbers: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entry of each row, the lower one at ties; number and sum of the rows of each entry."""
    points, entries = alike(numbers, book)
    plain = book.astype(np.float64)
    code = np.empty(len(points), np.int64)
    counts, sums = np.zeros(len(book), np.int64), np.zeros(book.shape, object)
    apart = np.sqrt(((plain[:, None, :] - plain[None, :, :]) ** 2).sum(axis=2))
    lengths = (plain**2).sum(axis=1)
    own_lengths = (entries**2).sum(axis=1)
    nodes, listed, compared = np.array([0]), np.ones((1, len(book)), bool), []
    while nodes.size:
        centre = tree.sums[nodes].astype(np.float64) / (tree.end - tree.start)[nodes, None]
        size = (centre**2).sum(axis=1)[:, None]
        gap = np.where(listed, size + lengths - 2 * centre @ plain.T, np.inf)
        best = gap.argmin(axis=1)
        here = np.arange(len(nodes))
        # Rounding of doubles must never take an entry off the list that may own a point.
        slack = 1e-9 * (size + lengths.max(initial=0))
        listed &= gap - gap[here, best][:, None] <= 2 * tree.radius[nodes, None] * (1 + 1e-9) * apart[best] + slack
        wholly = listed.sum(axis=1) == 1
        for node, entry in zip(nodes[wholly].tolist(), best[wholly].tolist()):
            code[tree.order[tree.start[node] : tree.end[node]]] = entry
            counts[entry] += tree.end[node] - tree.start[node]
            sums[entry] += _ints(tree.sums[node])
        leaf = ~wholly & (tree.left[nodes] < 0)
        for node, may in zip(nodes[leaf].tolist(), listed[leaf]):
            rows, may = tree.order[tree.start[node] : tree.end[node]], np.flatnonzero(may)
            code[rows] = may[(own_lengths[may] - 2 * points[rows] @ entries[may].T).argmin(axis=1)]
            compared.append(rows)
        rest = ~wholly & ~leaf
        nodes = np.concatenate([tree.left[nodes[rest]], tree.right[nodes[rest]]])
        listed = np.concatenate([listed[rest], listed[rest]])
    if compared:
        rows = np.concatenate(compared)
        rows = rows[np.argsort(code[rows], kind="stable")]
        found, first, n = np.unique(code[rows], return_index=True, return_counts=True)
        counts[found] += n
        sums[found] += _ints(np.add.reduceat(numbers[rows], first, axis=0))
    return code, counts, sums


def _ints(numbers: np.ndarray) -> np.ndarray:
    return numbers if numbers.dtype == object else numbers.astype(np.int64).astype(object)


# ---- tables --------------------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and label of the vectors that take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(2.0**128)))
    return vectors.filter(F.col("embedding").isNotNull() & fine).select("vec_id", "embedding", "label")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    lengths = np.diff(column.offsets.to_numpy())
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _cut(numbers: np.ndarray) -> list[np.ndarray]:
    step = numbers.shape[1] // PARTS
    return [numbers[:, i * step : (i + 1) * step] for i in range(PARTS)]


def planted(kept: DataFrame, width: int, block: int = BLOCK) -> DataFrame:
    """Blocks of vectors with a metric tree for each of their parts, stored in the shared folder."""
    kinds = {c: kept.schema[c].dataType for c in ("vec_id", "label")}
    schema = T.StructType([T.StructField(c, T.ArrayType(k)) for c, k in kinds.items()]).add("block", T.BinaryType())
    arrow = to_arrow_schema(schema)

    def made(columns: list[pa.Array]) -> pa.RecordBatch:
        raw = _matrix(columns[1], width)
        trees = [balls(part) for part in _cut(whole(raw))]
        data = pickle.dumps((raw.astype(np.float32) if (raw.astype(np.float32) == raw).all() else raw, trees))
        cells = [columns[0].to_pylist(), columns[2].to_pylist(), data]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            while waiting.num_rows >= block:
                yield made([c.combine_chunks() for c in waiting.slice(0, block).combine_chunks().columns])
                waiting = waiting.slice(block)
        if waiting is not None and waiting.num_rows:
            yield made([c.combine_chunks() for c in waiting.combine_chunks().columns])

    return stored(kept.mapInArrow(run, schema), "metric-trees")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, data = (c[i] for c in batch.columns)
            raw, trees = pickle.loads(data.as_py())
            yield ids.as_py(), labels.as_py(), _cut(whole(raw)), trees


def _round(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one more round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for _, _, parts, made in _blocks(batches):
            for p, (part, tree) in enumerate(zip(parts, made)):
                _, n, s = owners(tree, part, books[p])
                counts[p] += n
                sums[p] += s
        low = (1 << _LIMB) - 1
        for p, (n, s) in enumerate(zip(counts, sums)):
            entry, place = np.nonzero(np.repeat(n[:, None] > 0, s.shape[1], axis=1))
            total = s[entry, place]
            columns = [np.full(len(entry), p), entry, place, n[entry], total & low, total >> _LIMB & low, total >> 2 * _LIMB]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], names=["part", "entry", "place", "n", "a", "b", "c"]
            )

    found = trees.mapInArrow(run, "part bigint, entry bigint, place bigint, n bigint, a bigint, b bigint, c bigint")
    sums = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "a", "b", "c")]
    out = [b.copy() for b in books]
    for r in found.groupBy("part", "entry", "place").agg(*sums).collect():
        total = int(r.a) + (int(r.b) << _LIMB) + (int(r.c) << 2 * _LIMB)
        out[r.part][r.entry, r.place] = total // int(r.n)
    return out


def first_books(kept: DataFrame, width: int, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids."""
    chosen = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding")
    raw = np.zeros((0, width))
    rows = [r[0] for r in chosen.collect()]
    if rows:
        raw = np.array([[*map(float, r), *[0.0] * (width - len(r))] for r in rows]).reshape(len(rows), width)
    return [_ints(b) for b in _cut(whole(raw))]


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()


def trained(
    vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK
) -> tuple[DataFrame, list[np.ndarray]]:
    """Stored blocks of the usable vectors, and the codebooks learnt from all of them."""
    kept = usable(vectors)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    books = first_books(kept, width, entries)
    trees = planted(kept, width, block)
    for _ in range(rounds if len(books[0]) else 0):
        books = _round(trees, books)
    return trees, books


def coded(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code and error of each vector of the blocks."""
    kinds = {c: trees.schema[c].dataType.elementType for c in ("vec_id", "label")}
    schema = T.StructType([T.StructField(c, k) for c, k in kinds.items()]).add("code", T.StringType()).add("error", T.LongType())
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, parts, made in _blocks(batches):
            codes = np.empty((len(ids), PARTS), np.uint8)
            errors = np.zeros(len(ids), object)
            for p, (part, tree) in enumerate(zip(parts, made)):
                codes[:, p], _, _ = owners(tree, part, books[p])
                points, entries = alike(part, books[p])
                errors += _ints(((points - entries[codes[:, p]]) ** 2).sum(axis=1))
            text = codes.tobytes().hex()
            step = 2 * PARTS
            cells = [ids, labels, [text[i : i + step] for i in range(0, len(text), step)], [min(e, _LONGEST) for e in errors]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, arrow)], schema=arrow)

    return trees.mapInArrow(run, schema)


def compressed(vectors: DataFrame) -> DataFrame:
    """Per vector its code and error, the error of its label, and the digest of the codebooks."""
    trees, books = trained(vectors)
    found = stored(coded(trees, books), "codes").withColumn("same", F.struct("label"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONGEST).cast("decimal(38,0)"))
    per_label = found.groupBy("same").agg(total.cast("bigint").alias("label_error"), F.count(F.lit(1)).alias("n"))
    out = join_per_key(found, per_label, "same", "n")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
