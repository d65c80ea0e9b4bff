"""Packing tokenised documents into sequences of a fixed length by best-two-fit.

A sequence is opened by the longest document left and filled greedily with the longest that still
fits. Then its smallest document is tried against two unpacked ones: if two of them fill the gap that
appears without it more tightly, they take its place.

Only lengths matter for that, and there are at most ``CAPACITY`` of them. So the plan is made from the
number of pieces per length - a table of bounded size, whatever the number of documents - as a list
of patterns, each for as many sequences as its lengths allow at once. Pieces are then ranked within
their length by one range sort, counted on from what lies in earlier ranges, and take the places of that rank. The whole collection is packed as one,
with no loss at task borders, and no task holds more than its range of narrow rows.

Defined cases: a null text is an empty one, whose only token is the end mark; repeated rows are packed
each for itself; an empty table packs to nothing; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Encoder, encodings
from tidemark.llm.common import ranged

CAPACITY = 4096
END = 1


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Documents as token pieces; only longer ones are cut. ``with_ids`` adds the tokens themselves."""

    def row(_: Encoder, ids: np.ndarray) -> Iterator[tuple]:
        ids = np.append(ids, np.uint32(END))
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out = (piece, at, len(part), zlib.crc32(part.astype("<u4").tobytes()))
            yield (*out, part.tolist()) if with_ids else out

    ddl = "piece int, start bigint, length bigint, ids_crc32 bigint"
    return encodings(docs, row, ddl + (", ids array<int>" if with_ids else ""), path)


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> Iterator[tuple[list[int], int]]:
    """Lengths of a sequence and how many sequences get them, until ``counts`` is used up.

    Every pattern uses up a length or all but fewer of it than the pattern holds, so there are few
    more patterns than lengths.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    total = int(left.sum())
    while total:
        chosen = _filled(left, capacity)
        lengths, uses = np.unique(chosen, return_counts=True)
        times = int((left[lengths] // uses).min())
        left[lengths] -= uses * times
        total -= len(chosen) * times
        yield chosen, times


def _filled(left: np.ndarray, capacity: int) -> list[int]:
    free = left.copy()
    chosen: list[int] = []
    gap = capacity
    while (fitting := np.flatnonzero(free[: gap + 1])).size:
        length = int(fitting[-1])
        n = min(int(free[length]), gap // length)
        chosen += [length] * n
        free[length] -= n
        gap -= n * length
    if gap and len(chosen) > 1:
        smallest = chosen[-1]
        pair = _best_two(free, gap + smallest)
        if pair and sum(pair) > smallest:
            chosen = [*chosen[:-1], *pair]
    return chosen


def _best_two(free: np.ndarray, gap: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum comes closest to ``gap`` from below."""
    have = np.flatnonzero(free[: gap + 1])
    if not have.size:
        return None
    at = np.searchsorted(have, gap - have, side="right") - 1
    alone = (at >= 0) & (have[np.maximum(at, 0)] == have) & (free[have] < 2)
    at = np.where(alone, at - 1, at)
    sums = np.where(at >= 0, have + have[np.maximum(at, 0)], 0)
    best = int(sums.argmax())
    return (int(have[best]), int(have[at[best]])) if sums[best] else None


def places(plan: Iterator[tuple[list[int], int]]) -> dict[int, tuple[list[int], list[tuple[int, int]]]]:
    """Per length: first rank of each run of places, and (first sequence, offset) of the run."""
    out: dict[int, tuple[list[int], list[tuple[int, int]]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for chosen, times in plan:
        offset = 0
        for length in chosen:
            ranks, runs = out.setdefault(length, ([], []))
            ranks.append(used.get(length, 0))
            runs.append((sequence, offset))
            used[length] = ranks[-1] + times
            offset += length
        sequence += times
    return out


def _starts(counts: Iterable[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
    """Per (part, length): how many pieces of that length lie in earlier parts; from (part, length, pieces)."""
    seen: dict[int, int] = {}
    out: dict[tuple[int, int], int] = {}
    for part, length, n in sorted(counts):
        out[part, length] = seen.get(length, 0)
        seen[length] = out[part, length] + n
    return out


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``; needs the columns of ``pieces``.

    A range begins with the length at which the one before ends, so there are fewer pairs of part and
    length than parts and lengths together, and a piece's rank follows from its place in its sorted range.
    """
    order = ["length", "doc_id", "piece", "ids_crc32"]
    columns = parts.columns
    cut = ranged(parts, *order)
    counts = [tuple(r) for r in cut.groupBy("part", "length").agg(F.count(F.lit(1))).collect()]
    pieces_of: dict[int, int] = {}
    for _, length, n in counts:
        pieces_of[length] = pieces_of.get(length, 0) + n
    shared = parts.sparkSession.sparkContext.broadcast((places(patterns(pieces_of, capacity)), _starts(counts)))
    kinds = ", ".join(f"{n} {t}" for n, t in parts.dtypes)

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts = shared.value
        now, rank = None, 0
        for batch in batches:
            names = batch.schema.names
            part, length = (batch.column(names.index(c)).to_numpy() for c in ("part", "length"))
            ends = [*(np.flatnonzero((np.diff(length) != 0) | (np.diff(part) != 0)) + 1).tolist(), len(length)]
            sequences, offsets = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            at = 0
            for end in ends if len(length) else []:
                here = int(part[at]), int(length[at])
                if here != now:
                    now, rank = here, starts[here]
                ranks, runs = (np.array(x, np.int64) for x in table[here[1]])
                found = np.arange(rank, rank + end - at)
                run = np.searchsorted(ranks, found, side="right") - 1
                sequences[at:end] = runs[run, 0] + found - ranks[run]
                offsets[at:end] = runs[run, 1]
                rank, at = rank + end - at, end
            kept = [batch.column(names.index(c)) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequences), pa.array(offsets)], names=[*columns, "sequence_id", "offset"]
            )

    return cut.sortWithinPartitions(*order).mapInArrow(seat, f"{kinds}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Where each piece of each document goes."""
    return place(pieces(docs, capacity, path), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """The packed sequences: token ids, and the lengths of the pieces one after another."""
    placed = place(pieces(docs, capacity, path, with_ids=True), capacity)
    part = F.struct("offset", "length", "ids")
    rows = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return rows.select(
        "sequence_id",
        F.flatten(F.col("parts.ids")).alias("ids"),
        F.col("parts.length").alias("lengths"),
    )
