"""Removal of repeated byte strings by a distributed merge sort of suffixes.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts earlier: in a document of
smaller id, or further ahead in its own. So of all starts with equal strings only the first stays.

*Anchors.* Each start belongs to an anchor: of the ``GRAM``-byte strings within its string, the place of
the one with the smallest hash. Equal strings have their anchors at equal places, so starts whose
anchor's bytes occur nowhere else need no further look; starts next to each other mostly share an
anchor, and a stretch of them is told by one hash of its bytes. A stretch whose bytes stand earlier as a
whole is a repetition at once. What remains are stretches whose anchor's bytes occur in different
surroundings - the ends of repeated passages, and their first occurrences.

*Suffixes.* The starts of these are sorted as suffixes, each compared up to ``LENGTH`` bytes. A task sorts
its own into a run and drops repetitions within it, so however many documents share a passage, a run
has each suffix once. Runs are cut at common splitters, front-coded - only what differs from the suffix
before is sent - and exchanged. Loser trees merge the runs of a range by the prefix lengths that the
front coding already knows; a suffix that equals the one before is a repetition.

*Spans.* Repetitions are gathered per document and cut out of the whole text.

Anchors travel as packed columns. An anchor's bytes that occur in several surroundings already within
one batch are sent by the hash of their stretch, with one note for all of them, so not even the edge of
a passage that a third of all documents share meets in one task; a repetition missed thereby is found
among the suffixes.

Defined cases: a null text is empty; a null doc_id is larger than any other; rows of one doc_id are ordered by
a hash of their text, and rows equal in both are one document; texts shorter than ``LENGTH`` bytes stay
whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, stored
from tidemark.llm.losertree import Run, common_prefixes, merged

LENGTH = 100
GRAM = 60
#: Suffixes that splitters are taken from, those of the smallest hash.
SAMPLE = 20_000

_LAST = (1 << 63) - 1
_WORD = (1 << 64) - 1
_SLICE = 1 << 21
_PLACE = 26
_RUN = 250_000
#: Documents whose anchors are sorted together.
_TOGETHER = 4_096
_SAMPLED = 40

_BLOBS = "part int, kind int, blob binary"
_STRETCHES = "doc bigint, tie bigint, first bigint, last bigint, kind int"
_ANCHORS = ("gram", "u8"), ("whole", "u8"), ("doc", "i8"), ("tie", "i8"), ("first", "i8"), ("size", "u2")
REPEATED, UNSETTLED, SUFFIX = 0, 1, 2
_NOTE = 3


# ---- packed columns --------------------------------------------------------------------------


def _packed(arrays: list[np.ndarray]) -> bytes:
    data = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(len(arrays[0]).to_bytes(8, "little") + data)


def _unpacked(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        size = n * np.dtype(kind).itemsize
        out.append(np.frombuffer(data, kind, n, at))
        at += size
    return [*out, np.frombuffer(data, np.uint8, offset=at)]


# ---- anchors ---------------------------------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """A hash of the ``width`` bytes from each place, put together from halves of doubling width."""
    power, size, done = np.uint64(0x9E3779B97F4A7C15), 1, 0
    h = data.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(12345)
    total: np.ndarray | None = None
    while True:
        if width & size:
            if total is None:
                total = h
            else:
                n = len(total) - size
                total = total[:n] * power + h[done : done + n]
            done += size
        if size * 2 > width:
            return _mixed(total)
        h = h[:-size] * power + h[size:]
        power, size = np.uint64(int(power) ** 2 & _WORD), size * 2


def _window_least(v: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    rest = width - size
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


def stretches(pieces: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of the pieces laid end to end: piece, first and last start, gram hash and stretch hash.

    The leftmost of equal smallest grams is the anchor, which depends on the bytes alone.
    """
    sizes = np.array([len(p) for p in pieces])
    offsets = np.r_[0, np.cumsum(sizes)]
    data = b"".join(pieces)
    h = gram_hashes(np.frombuffer(data, np.uint8))
    place = np.uint64((1 << _PLACE) - 1)
    least = _window_least((h & ~place) | np.arange(len(h), dtype=np.uint64), LENGTH - GRAM + 1)
    anchor = (least & place).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), sizes)[: len(anchor)]
    begins = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])])
    ends = np.r_[begins[1:], len(anchor)]
    ends = np.minimum(ends, offsets[piece[begins] + 1] - LENGTH + 1)
    whole = ends > begins
    begins, ends = begins[whole], ends[whole]
    digest = xxhash.xxh3_64_intdigest
    bounds = zip(begins.tolist(), (ends + LENGTH - 1).tolist())
    wholes = np.fromiter((digest(data[a:b]) for a, b in bounds), np.uint64, len(begins))
    at = piece[begins]
    return at, begins - offsets[at], ends - 1 - offsets[at], h[anchor[begins]], wholes


def _pieces(docs: list[int], texts: list[bytes]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Slices of about _SLICE bytes: row, offset and bytes of pieces; long texts in overlapping pieces."""
    rows, offsets, parts, size = [], [], [], 0
    for row, text in zip(docs, texts):
        for at in range(0, max(0, len(text) - LENGTH + 1), _SLICE):
            rows.append(row)
            offsets.append(at)
            parts.append(text[at : at + _SLICE + LENGTH - 1])
            size += len(parts[-1])
            if size >= _SLICE:
                yield rows, offsets, parts
                rows, offsets, parts, size = [], [], [], 0
    if parts:
        yield rows, offsets, parts


def _order(*keys: np.ndarray) -> np.ndarray:
    """Row numbers in order of ``keys``, the first one leading."""
    return np.lexsort(keys[::-1])


def _changes(*keys: np.ndarray) -> np.ndarray:
    """True where any of the sorted ``keys`` differs from the row before."""
    if not len(keys[0]):
        return np.zeros(0, bool)
    out = np.zeros(len(keys[0]), bool)
    out[0] = True
    for k in keys:
        out[1:] |= k[1:] != k[:-1]
    return out


def _several(gram: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """For rows sorted by both: whether the row's gram has more than one stretch hash."""
    new = _changes(gram)
    group = np.cumsum(new) - 1
    kinds = np.bincount(group, weights=_changes(gram, whole)) if len(gram) else np.zeros(0)
    return kinds[group] > 1 if len(gram) else np.zeros(0, bool)


def _repeated(columns: list[np.ndarray]) -> np.ndarray:
    """For rows sorted by (gram, whole, doc, tie, first): whether an equal stretch starts earlier."""
    gram, whole, doc, tie, first = columns[:5]
    head = np.flatnonzero(_changes(gram, whole))
    lead = np.repeat(head, np.diff(np.r_[head, len(gram)]))
    return (doc != doc[lead]) | (tie != tie[lead]) | (first != first[lead])


def _anchored(texts: DataFrame, parts: int) -> DataFrame:
    """Packed anchors of all texts, by the part of the hash that has to meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, _TOGETHER):
            doc, tie = (batch.column(i).to_numpy() for i in (0, 1))
            found: list[list[np.ndarray]] = []
            for rows, offsets, pieces in _pieces(range(batch.num_rows), batch.column(2).to_pylist()):
                at, first, last, gram, whole = stretches(pieces)
                row, offset = np.array(rows)[at], np.array(offsets)[at]
                found.append([gram, whole, doc[row], tie[row], first + offset, (last - first).astype(np.uint16)])
            if not found:
                continue
            columns = [np.concatenate(c) for c in zip(*found)]
            order = _order(columns[0], columns[1], columns[2], columns[3], columns[4])
            columns = [c[order] for c in columns]
            yield from _sent(columns, parts)

    return texts.mapInArrow(run, _BLOBS)


def _sent(columns: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    gram, whole = columns[0], columns[1]
    repeated, several = _repeated(columns), _several(gram, whole)
    by_gram = (gram % np.uint64(parts)).astype(np.int64)
    part = np.where(several, ((gram ^ _mixed(whole)) % np.uint64(parts)).astype(np.int64), by_gram)
    part = np.where(repeated, (columns[2] + columns[4]) % parts, part)
    kind = np.where(repeated, REPEATED, np.where(several, UNSETTLED, SUFFIX))
    notes = np.flatnonzero(several & _changes(gram))
    rows: list[tuple[int, int, bytes]] = []
    order = np.lexsort((kind, part))
    new = np.flatnonzero(_changes(part[order], kind[order]))
    for some in np.split(order, new[1:]) if len(order) else []:
        rows.append((int(part[some[0]]), int(kind[some[0]]), _packed([c[some] for c in columns])))
    order = notes[np.argsort(by_gram[notes], kind="stable")]
    new = np.flatnonzero(_changes(by_gram[order]))
    for some in np.split(order, new[1:]) if len(order) else []:
        rows.append((int(by_gram[some[0]]), _NOTE, _packed([gram[some]])))
    if rows:
        yield _blobs(rows)


def _blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, kind, blob = zip(*rows)
    arrays = [pa.array(part, pa.int32()), pa.array(kind, pa.int32()), pa.array(blob, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["part", "kind", "blob"])


def _per_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[int, bytes]]]]:
    """Blobs of one part after another, from batches sorted by part."""
    current, held = None, []
    for batch in batches:
        for part, kind, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if part != current and held:
                yield current, held
                held = []
            current = part
            held.append((kind, blob))
    if held:
        yield current, held


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches that are repetitions as a whole, and those that only their suffixes can settle."""
    kinds = [k for _, k in _ANCHORS]
    for _, blobs in _per_part(batches):
        notes = [_unpacked(b, ["u8"])[0] for k, b in blobs if k == _NOTE]
        rows = [(k, _unpacked(b, kinds)[:-1]) for k, b in blobs if k != _NOTE]
        if not rows:
            continue
        done = [c for k, c in rows if k == REPEATED]
        if done:
            _, _, doc, tie, first, size = (np.concatenate(c) for c in zip(*done))
            yield _stretch_rows(doc, tie, first, size, np.full(len(doc), REPEATED))
        open_ = [(k, c) for k, c in rows if k != REPEATED]
        if not open_:
            continue
        columns = [np.concatenate(c) for c in zip(*(c for _, c in open_))]
        several = np.concatenate([np.full(len(c[0]), k == UNSETTLED) for k, c in open_])
        order = _order(*columns[:5])
        columns, several = [c[order] for c in columns], several[order]
        gram, whole, doc, tie, first, size = columns
        several |= _several(gram, whole)
        if notes:
            several |= np.isin(gram, np.concatenate(notes))
        repeated = _repeated(columns)
        kind = np.where(repeated, REPEATED, UNSETTLED)
        kept = repeated | several
        yield _stretch_rows(doc[kept], tie[kept], first[kept], size[kept], kind[kept])


def _stretch_rows(doc, tie, first, size, kind) -> pa.RecordBatch:
    arrays = [doc, tie, first, first + size, kind.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["doc", "tie", "first", "last", "kind"])


# ---- suffixes --------------------------------------------------------------------------------


def _suffixes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """doc, tie, start and bytes of the unsettled starts, about _RUN at a time."""
    doc, tie = (batch.column(i).to_numpy() for i in (0, 1))
    texts, lists = batch.column(2), batch.column(3)
    bounds = lists.offsets.to_numpy()
    flat = lists.values
    firsts, lasts = flat.field(0).to_numpy(), flat.field(1).to_numpy()
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for row in range(batch.num_rows):
        data = np.frombuffer(texts[row].as_py(), np.uint8)
        windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
        for i in range(bounds[row], bounds[row + 1]):
            starts = np.arange(firsts[i], lasts[i] + 1)
            held.append((np.full(len(starts), doc[row]), np.full(len(starts), tie[row]), starts, windows[starts]))
            size += len(starts)
            if size >= _RUN:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _as_strings(rows: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rows).view(f"S{LENGTH}").ravel()


def _run_of(doc: np.ndarray, tie: np.ndarray, start: np.ndarray, rows: np.ndarray):
    """A sorted run without its own repetitions, the prefixes shared with the row before, and these."""
    order = np.lexsort((start, tie, doc))
    order = order[np.argsort(_as_strings(rows)[order], kind="stable")]
    doc, tie, start, rows = doc[order], tie[order], start[order], rows[order]
    prefix = common_prefixes(rows)
    same = prefix == LENGTH
    lead = np.flatnonzero(~same)
    head = np.repeat(lead, np.diff(np.r_[lead, len(rows)]))
    again = same & ((doc != doc[head]) | (tie != tie[head]) | (start != start[head]))
    once = ~same
    return [doc[once], tie[once], start[once]], rows[once], prefix[once], [doc[again], tie[again], start[again]]


def _runs(unsettled: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Front-coded runs by range, and repetitions found within a run (kind REPEATED, by no range)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = np.array(splitters, f"S{LENGTH}")
        for batch in batches:
            for suffixes in _suffixes(batch):
                places, rows, prefix, again = _run_of(*suffixes)
                out = []
                ends = np.searchsorted(_as_strings(rows), cuts) if len(cuts) else np.zeros(0, int)
                ends = [0, *ends.tolist(), len(rows)]
                for part, (a, b) in enumerate(zip(ends, ends[1:])):
                    if a == b:
                        continue
                    shared = prefix[a:b].copy()
                    shared[0] = 0
                    tails = rows[a:b][np.arange(LENGTH) >= shared[:, None]]
                    columns = [c[a:b] for c in places]
                    out.append((part, SUFFIX, _packed([shared.astype(np.uint8), *columns, tails])))
                if len(again[0]):
                    out.append((int(again[2][0]) % (len(cuts) + 1), REPEATED, _packed(again)))
                if out:
                    yield _blobs(out)

    return unsettled.mapInArrow(run, _BLOBS)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts whose suffix is not the first of its kind in the range."""
    for _, blobs in _per_part(batches):
        for kind, blob in blobs:
            if kind == REPEATED:
                doc, tie, start, _ = _unpacked(blob, ["i8", "i8", "i8"])
                yield _stretch_rows(doc, tie, start, np.zeros(len(doc), np.int64), np.full(len(doc), REPEATED))
        packed = [_unpacked(blob, ["u1", "i8", "i8", "i8"]) for kind, blob in blobs if kind == SUFFIX]
        if not packed:
            continue
        at = np.r_[0, np.cumsum([len(p[0]) for p in packed])].tolist()
        doc, tie, start = (np.concatenate([p[i] for p in packed]) for i in (1, 2, 3))
        runs = [Run(p[0].tolist(), p[4].tobytes(), LENGTH) for p in packed]
        order, shared = np.empty(at[-1], np.int64), np.empty(at[-1], np.int64)
        for i, (r, position, prefix) in enumerate(merged(runs)):
            order[i] = at[r] + position
            shared[i] = prefix
        doc, tie, start = doc[order], tie[order], start[order]
        group = np.cumsum(shared < LENGTH) - 1
        inner = np.lexsort((start, tie, doc, group))
        doc, tie, start, group = doc[inner], tie[inner], start[inner], group[inner]
        head = np.flatnonzero(_changes(group))
        lead = np.repeat(head, np.diff(np.r_[head, len(group)]))
        again = (doc != doc[lead]) | (tie != tie[lead]) | (start != start[lead])
        if again.any():
            n = int(again.sum())
            yield _stretch_rows(doc[again], tie[again], start[again], np.zeros(n, np.int64), np.full(n, REPEATED))


# ---- the operator ----------------------------------------------------------------------------


def _keyed(docs: DataFrame) -> DataFrame:
    text: Column = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST))
    rows = docs.select("doc_id", doc.alias("doc"), text.alias("bytes"))
    return rows.withColumn("tie", F.xxhash64("bytes"))


def _lists(stretch: DataFrame, name: str) -> DataFrame:
    return stretch.groupBy("doc", "tie").agg(F.collect_list(F.struct("first", "last")).alias(name))


def splitters_of(unsettled: DataFrame, ranges: int) -> list[bytes]:
    """Strings that cut a bounded sample of the unsettled suffixes in ranges of equal size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, start, rows in _suffixes(batch):
                some = np.unique(np.linspace(0, len(rows) - 1, _SAMPLED).astype(int))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows[some]], pa.binary())], names=["s"])

    sampled = unsettled.mapInArrow(run, "s binary").orderBy(F.xxhash64("s"), "s").limit(SAMPLE)
    strings = sorted(r["s"] for r in sampled.collect())
    if not strings:
        return []
    return sorted({strings[len(strings) * i // ranges] for i in range(1, ranges)})


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per document: bytes, bytes and stretches removed, and the SHA-256 of what is left."""
    spark = docs.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _keyed(docs)
    texts = keyed.select("doc", "tie", "bytes")
    anchored = _anchored(texts, parts).repartition("part").sortWithinPartitions("part")
    stretch = stored(anchored.mapInArrow(_settled, _STRETCHES), "stretches")
    unsettled = _lists(stretch.filter(F.col("kind") == UNSETTLED), "open")
    some = unsettled.orderBy(F.xxhash64("doc", "tie"), "doc", "tie").limit(1_000)
    few = texts.join(F.broadcast(some), ["doc", "tie"]).select("doc", "tie", "bytes", "open")
    splitters = splitters_of(few, parts)
    whole = texts.join(unsettled.hint("shuffle_hash"), ["doc", "tie"]).select("doc", "tie", "bytes", "open")
    runs = _runs(whole, splitters).repartition("part").sortWithinPartitions("part")
    singles = stored(runs.mapInArrow(_merged, _STRETCHES), "repeated-suffixes")
    repeated = _lists(stretch.filter(F.col("kind") == REPEATED).unionByName(singles), "spans")
    rows = keyed.join(repeated.hint("shuffle_hash"), ["doc", "tie"], "left").select("doc_id", "bytes", "spans")
    return rows.mapInArrow(_cut, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_RESULT}")


_RESULT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def covered(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches [start, end) covered by the strings that start in the given stretches."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
    new = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    return start[new], end[np.r_[new[1:] - 1, len(end) - 1]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        bounds, flat = lists.offsets.to_numpy(), lists.values
        firsts, lasts = flat.field(0).to_numpy(), flat.field(1).to_numpy()
        rows = []
        for i, text in enumerate(batch.column(1).to_pylist()):
            a, b = bounds[i], bounds[i + 1]
            if a == b or not lists[i].is_valid:
                rows.append((len(text), 0, 0, hashlib.sha256(text).hexdigest()))
                continue
            start, end = covered(firsts[a:b], lasts[a:b])
            kept, at = hashlib.sha256(), 0
            for s, e in zip(start.tolist(), end.tolist()):
                kept.update(text[at:s])
                at = e
            kept.update(text[at:])
            rows.append((len(text), int((end - start).sum()), len(start), kept.hexdigest()))
        columns = [pa.array(c) for c in zip(*rows)] if rows else [pa.array([], t) for t in (pa.int64(),) * 3 + (pa.string(),)]
        names = ["doc_id", *(c.split()[0] for c in _RESULT.split(", "))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)
