"""Encoding and decoding with a byte-pair vocabulary whose words carry an end mark.

A text is cut into words as the vocabulary's file says: special tokens first, then normalised text,
split by its pattern. The merges of a word are found with a segment tree. Leaf i holds the rank of the pair of
symbol i and its successor, joined with i, and every node the least of its two children; so the root
is the leftmost of the lowest-ranked pairs. A merge writes three leaves - its own, its predecessor's
and the one that vanishes - and the nodes above them, until the root says that no pair merges.

Short words of a batch are worked on together: their trees lie side by side in one array for each
size, and each step does one merge in every word that still has one. Long words have a tree of their
own, so a word of n symbols costs n log n steps however long it is. Words are remembered in each
Python worker, up to a bounded number, beyond which the half asked for last is kept; so common words
stay. Parts of text between blanks, distinct ones of a batch, are split into words all at once and get
their ids from those of their words; only parts that the library has to split are remembered themselves.

Defined cases: a null text is an empty one and has no tokens; a null doc_id is kept; repeated rows are
encoded each for itself; an empty table gives no rows; other columns are ignored. Lone surrogates,
which no UTF-8 text has, become replacement characters. A null array of ids decodes to null.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import in_slices, mapped

VOCABULARY = "word_bpe_49k.json"

#: Symbols up to which words share a forest of trees; longer ones have a tree each.
FOREST = 64

#: Bounds of what one Python worker remembers: words, odd parts of text, and the characters of either.
CACHE_WORDS = 200_000
CACHE_PARTS = 100_000
CACHE_CHARS = 48

#: Documents, and bytes of them, whose new words are merged together; a longer text is alone.
TEXTS_AT_ONCE = 2048
BYTES_AT_ONCE = 1 << 21

_NONE = np.iinfo(np.int32).max
_AT_ONCE = 1 << 14
_BETWEEN = b"\xff" * 4  # no run of ids below 2**24 has it

# The normaliser and word pattern under which texts of Latin-1 letters need no library -
# they are in composed form already and have these words.
SIMPLE = (
    ["NFC", r"\s+", " ", "Lowercase"],
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
)
_LETTERS, _DIGITS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_LETTER, _OTHER = 1, 3
_KINDS = np.full(256, _OTHER, np.uint8)
for _kind_of, _chars in enumerate((" ", _LETTERS, _DIGITS)):
    _KINDS[[c for c in range(256) if re.match(f"[{_chars}]", chr(c))]] = _kind_of


def _described(spec: dict) -> tuple:
    """What a vocabulary file says of normalising and splitting, in the form of SIMPLE."""
    steps: list[str] = []
    for step in (spec["normalizer"] or {}).get("normalizers", []):
        steps += [step["pattern"]["Regex"], step["content"]] if step["type"] == "Replace" else [step["type"]]
    return steps, spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]


def _alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from code point 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]



class Encoder:
    """Token ids of texts, from a vocabulary file of the tokenizers library."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        for option in ("dropout", "continuing_subword_prefix", "unk_token", "ignore_merges", "byte_fallback"):
            if model.get(option):
                raise ValueError(f"a vocabulary with {option} is not supported")
        library = Tokenizer.from_file(path)
        self._normal, self._split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        self.numbers = list(map(str, range(len(self.tokens))))
        self._single = np.array([vocab[c] for c in _alphabet()], np.int32)
        self._last = np.array([vocab[c + end] for c in _alphabet()], np.int32)
        self._simple = _described(spec) == SIMPLE
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._width = len(self.tokens)
        keys = np.array([vocab[a] * self._width + vocab[b] for a, b in pairs], np.int64)
        self._merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self._rank_order = np.argsort(keys, kind="stable").astype(np.int32)
        self._pair_keys = keys[self._rank_order]
        self._rank_of = dict(zip(keys.tolist(), range(len(keys))))
        letters, ends = self._single.astype(np.int64), np.concatenate([self._single, self._last]).astype(np.int64)
        self._first = self._ranks(np.repeat(letters, 512), np.tile(ends, 256)).astype(np.int32)
        self.parts: dict[str, bytes] = {"": b""}
        # Remembered words, of which the first is a blank without ids: their ids one after another, where each
        # word's begin, how many it has, and the number of the batch that asked for it last.
        self.words = pa.array([b" "], pa.large_binary())
        self._numbers = np.zeros(0, "<u4")
        self._starts, self._counts, self._asked = np.zeros((3, 1), np.int64)
        self._batch = 0

    @classmethod
    def of(cls, path: str | None) -> Encoder:
        """One per Python worker; without a path the installed vocabulary."""
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    # ---- texts to words ----------------------------------------------------------------------

    def encode(self, text: str | None) -> list[int]:
        """Ids of one text."""
        return self.encode_all([(text or "").encode("utf-8", "replace").decode()])[0].tolist()

    def encode_all(self, texts: pa.Array | Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin and end."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        ids, bounds = _gathered(*self._parts(_listed(coded.dictionary, " ")), coded.indices.to_numpy())
        return ids, bounds[split.offsets.to_numpy() - split.offsets[0].as_py()]

    def _remembered(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, where those of each of the distinct ``words`` begin and how many it has.

        Only words that are not remembered are merged.
        """
        self._batch += 1
        found = pc.index_in(words, value_set=self.words)
        at = pc.fill_null(found, -1).to_numpy().astype(np.int64)
        if found.null_count:
            new = words.filter(pc.is_null(found))
            pieces = self._merged_words(_listed(new, b"\n").decode("latin-1").split("\n"))
            counts = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
            at[at < 0] = len(self.words) + np.arange(len(new))
            self.words = pa.concat_arrays([self.words, new])
            self._starts = np.concatenate([self._starts, len(self._numbers) + np.cumsum(counts) - counts])
            self._counts = np.concatenate([self._counts, counts])
            self._asked = np.concatenate([self._asked, np.zeros(len(new), np.int64)])
            self._numbers = np.concatenate([self._numbers, np.frombuffer(b"".join(pieces), "<u4")])
        self._asked[at] = self._batch
        out = self._numbers, self._starts[at], self._counts[at]
        self._forget()
        return out

    def _forget(self) -> None:
        """Drops words that are too long, and of too many those not asked for lately; never the blank."""
        keep = pc.binary_length(self.words).to_numpy() <= CACHE_CHARS
        if len(keep) > CACHE_WORDS:
            keep[np.argsort(-self._asked, kind="stable")[CACHE_WORDS // 2 :]] = False
        keep[0] = True
        if not keep.all():
            at = np.flatnonzero(keep)
            self.words = self.words.take(pa.array(at))
            self._numbers, bounds = _gathered(self._numbers, self._starts, self._counts, at)
            self._starts, self._counts, self._asked = bounds[:-1], self._counts[at], self._asked[at]

    def _parts(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers, and for each of the distinct parts that ``text`` holds between blanks its first one and how many.

        Parts with special tokens or white space of another kind are split one by one, and such with
        other letters than those of Western Europe by the library.
        """
        if self._latin(text):
            return self._latin_parts(text)
        parts = text.split(" ")
        latin = [p if self._latin(p) else "" for p in parts]
        numbers, starts, counts = self._latin_parts(" ".join(latin))
        odd = [i for i, (p, found) in enumerate(zip(parts, latin)) if p != found]
        more = self._odd_parts([parts[i] for i in odd])
        counts[odd] = np.fromiter(map(len, more), np.int64, len(more)) // 4
        starts[odd] = len(numbers) + np.cumsum(counts[odd]) - counts[odd]
        return np.concatenate([numbers, np.frombuffer(b"".join(more), "<u4")]), starts, counts

    def _latin(self, text: str) -> bool:
        """Whether words can be found without the library: all of Latin-1, and nothing strange."""
        if not self._simple or "<|" in text or not text.isprintable():
            return False
        try:
            return text.isascii() or bool(text.encode("latin-1"))
        except UnicodeEncodeError:
            return False

    def _latin_parts(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_parts``; words are found in the whole text and looked up once each. A blank is a word without ids."""
        data = text.lower().encode("latin-1")
        letters = np.frombuffer(data, np.uint8)
        begins = _word_starts(letters)
        buffers = [None, pa.py_buffer(np.append(begins, len(letters))), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(begins), buffers).dictionary_encode()
        ids, bounds = _gathered(*self._remembered(coded.dictionary), coded.indices.to_numpy())
        edges = np.concatenate([[0], bounds[np.flatnonzero(letters[begins] == 32)], bounds[-1:]])
        return ids, edges[:-1], np.diff(edges)

    def _odd_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts, made only of those that are not remembered."""
        known = list(map(self.parts.get, parts))
        new = self._split_by_library([p for p, ids in zip(parts, known) if ids is None])
        if len(self.parts) + len(new) > CACHE_PARTS:
            self.parts.clear()
            self.parts[""] = b""
        self.parts.update(islice(((p, ids) for p, ids in new.items() if len(p) <= CACHE_CHARS), CACHE_PARTS))
        return [new[p] if ids is None else ids for p, ids in zip(parts, known)]

    def _split_by_library(self, parts: list[str]) -> dict[str, bytes]:
        out = {p: self._alone(p) for p in parts if self._strange(p)}
        plain = [p for p in parts if p not in out]
        text = self._normal(" ".join(plain))
        if plain and text.count(" ") != len(plain) - 1:
            return out | {p: self._alone(p) for p in plain}
        words, at = [], 0
        for _, (start, end) in self._split(text):
            words += [" "] * (start - at)
            words.append(text[start:end])
            at = end
        words += [" "] * (len(text) - at)
        distinct = [w for w in dict.fromkeys(words) if w != " "]
        return out | self._regrouped(plain, words, dict(zip(distinct, self._merged_words(distinct))) | {" ": _BETWEEN})

    @staticmethod
    def _regrouped(parts: list[str], words: list[str], ids: dict[str, bytes]) -> dict[str, bytes]:
        """Ids of each part from the words of all, which blanks separate by parts."""
        return dict(zip(parts, b"".join(map(ids.__getitem__, words)).split(_BETWEEN))) if parts else {}

    @staticmethod
    def _strange(part: str) -> bool:
        return "<|" in part or not part.isprintable() or len(part.split()) != 1

    def _alone(self, part: str) -> bytes:
        words = self._words(part)
        strings = [w for w in words if isinstance(w, str)]
        ids = iter(self._merged_words(strings))
        return b"".join([next(ids) if isinstance(w, str) else w.to_bytes(4, "little") for w in words])

    def _words(self, part: str) -> list[str | int]:
        """Normalised words of a part; ids stand for special tokens."""
        out: list[str | int] = []
        at = 0
        for found in [*self._marks.finditer(part), None]:
            text = self._normal(part[at : found.start() if found else len(part)])
            out += [text[a:b] for _, (a, b) in self._split(text)]
            if found:
                out.append(self.special[found[0]])
                at = found.end()
        return out

    # ---- words to ids ------------------------------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, or _NONE."""
        keys = left.astype(np.int64) * self._width + right
        at = np.minimum(np.searchsorted(self._pair_keys, keys), len(self._pair_keys) - 1)
        hit = (self._pair_keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self._rank_order[at], _NONE)

    def _merged_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, in order."""
        if not words:
            return []
        letters = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
        ends = np.flatnonzero(letters == 10)
        lengths = np.diff(ends, prepend=-1) - 1
        symbols = self._single[letters]
        symbols[ends - 1] = self._last[letters[ends - 1]]
        pairs = letters.astype(np.int64)
        pairs[:-1] = pairs[:-1] * 512 + pairs[1:]
        pairs[np.maximum(ends - 2, 0)] += 256
        ranks = self._first[np.minimum(pairs, len(self._first) - 1)]
        out: list[bytes] = [b""] * len(words)
        sizes = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            if size > FOREST:
                for i in rows.tolist():
                    ids = self.merge_long(symbols[ends[i] - lengths[i] : ends[i]].tolist())
                    out[i] = np.array(ids, "<u4").tobytes()
                continue
            for at in range(0, len(rows), _AT_ONCE):
                some = rows[at : at + _AT_ONCE]
                places = np.arange(size)
                inside = places < lengths[some, None]
                at_letter = ((ends - lengths)[some, None] + places)[inside]
                table, leaves = np.full((len(some), size + 1), -1, np.int32), np.full((len(some), size), _NONE, np.int32)
                table[:, :size][inside] = symbols[at_letter]
                leaves[inside] = ranks[at_letter]
                leaves[np.arange(len(some)), lengths[some] - 1] = _NONE
                for i, ids in zip(some.tolist(), self.merge_forest(table, leaves)):
                    out[i] = ids
        return out

    def merge_forest(self, symbol: np.ndarray, ranks: np.ndarray) -> list[bytes]:
        """Merges all words, one a row, step by step together; rows hold a power of two symbols and one more -1,
        ``ranks`` those of each symbol and the next.
        """
        n, size = len(symbol), symbol.shape[1] - 1
        follower = np.minimum(np.arange(1, size + 2), size)[None, :].repeat(n, 0)
        leader = np.arange(-1, size)[None, :].repeat(n, 0)
        tree = np.full((n, 2 * size), _NONE, np.int32)
        places = np.arange(size)

        def leaf(ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(ranks == _NONE, _NONE, ranks * size + at)

        tree[:, size:] = leaf(ranks, places[None, :])
        level = size
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while rows.size:
            rank, at = np.divmod(tree[rows, 1], size)
            gone = follower[rows, at]
            after, before = follower[rows, gone], leader[rows, at]
            symbol[rows, at] = self._merged[rank]
            symbol[rows, gone] = -1
            follower[rows, at] = after
            inside = after < size
            leader[rows[inside], after[inside]] = at[inside]
            has = before >= 0
            ahead = np.where(has, before, at)
            tree[rows, size + gone] = _NONE
            tree[rows, size + ahead] = leaf(self._ranks(symbol[rows, ahead], symbol[rows, follower[rows, ahead]]), ahead)
            tree[rows, size + at] = leaf(self._ranks(symbol[rows, at], symbol[rows, after]), at)
            touched = np.stack([size + ahead, size + at, size + gone])
            while touched[0, 0] > 1:
                touched >>= 1
                tree[rows, touched] = np.minimum(tree[rows, 2 * touched], tree[rows, 2 * touched + 1])
            rows = rows[tree[rows, 1] != _NONE]
        kept = symbol[:, :size] >= 0
        ends = np.concatenate([[0], np.cumsum(kept.sum(axis=1))]) * 4
        data = symbol[:, :size][kept].astype("<u4").tobytes()
        bounds = ends.tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def merge_long(self, symbol: list[int]) -> list[int]:
        """Merges one word, with a segment tree of its own."""
        n, width, rank_of = len(symbol), self._width, self._rank_of
        size = 1 << max(1, (n - 1).bit_length())
        symbol = [*symbol, -1]
        follower = [*range(1, n + 1), n]
        leader = [*range(-1, n)]
        none = len(rank_of) * size

        def leaf(i: int) -> int:
            rank = rank_of.get(symbol[i] * width + symbol[follower[i]]) if follower[i] < n else None
            return none if rank is None else rank * size + i

        tree = [none] * (2 * size)
        tree[size : size + n] = map(leaf, range(n))
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        while tree[1] != none:
            rank, at = divmod(tree[1], size)
            gone = follower[at]
            symbol[at], symbol[gone] = int(self._merged[rank]), -1
            follower[at] = after = follower[gone]
            leader[after] = at
            tree[size + gone] = none
            tree[size + at] = leaf(at)
            changed = [gone, at]
            if leader[at] >= 0:
                tree[size + leader[at]] = leaf(leader[at])
                changed.append(leader[at])
            for place in changed:
                node = (size + place) >> 1
                while node:
                    a, b = tree[2 * node], tree[2 * node + 1]
                    low = a if a < b else b
                    if tree[node] == low:
                        break
                    tree[node] = low
                    node >>= 1
        return [s for s in symbol if s >= 0]

    # ---- ids to texts ------------------------------------------------------------------------

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by blanks, as the library does for a file that names no decoder.

        Ids that the vocabulary has not are passed over, as the library does.
        """
        tokens, n = self.tokens, len(self.tokens)
        return " ".join([tokens[i] for i in ids if 0 <= i < n and tokens[i]])


def _listed(strings: pa.Array, between: str | bytes) -> str | bytes:
    """All strings as one, with ``between`` between them: far sooner made than a string of each."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(strings)], pa.int64()), strings)
    return pc.binary_join(whole, pa.scalar(between, strings.type))[0].as_py()


def _word_starts(letters: np.ndarray) -> np.ndarray:
    """Where the words of lower-case Latin-1 text begin, by the pattern of SIMPLE; each blank counts as one."""
    kind = _KINDS[letters]
    begin = np.ones(len(letters), bool)
    begin[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] != _LETTER) & (kind[1:] != _OTHER))
    # An apostrophe that begins a word takes these endings with it.
    quotes = np.flatnonzero((letters == ord("'")) & begin)
    after = np.concatenate([letters, np.full(2, 32, np.uint8)])
    a, b = after[quotes + 1], after[quotes + 2]
    two = (((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    taken = np.where(np.isin(a, np.frombuffer(b"stmd", np.uint8)), 1, 2 * two)
    quotes, taken = quotes[taken > 0], taken[taken > 0]
    begin[quotes + 1] = False
    ends = quotes + 1 + taken
    begin[ends[ends < len(letters)]] = True
    return np.flatnonzero(begin)


def _gathered(numbers: np.ndarray, starts: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of numbers that ``codes`` names one after another, and where each begins and ends."""
    taken = counts[codes]
    bounds = np.concatenate([[0], np.cumsum(taken)])
    return numbers[np.repeat(starts[codes] - bounds[:-1], taken) + np.arange(bounds[-1])], bounds


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (doc_id, text) cut so that few of their texts go beyond BYTES_AT_ONCE."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
        slot = np.cumsum(sizes) // BYTES_AT_ONCE
        edges = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a)


def encodings(docs: DataFrame, fn: Callable[[Encoder, np.ndarray], Iterable[tuple]], ddl: str, path: str | None = None) -> DataFrame:
    """Rows ``(doc_id, *row)`` for each row of ``fn(encoder, ids)``, where ids are those of a document."""
    schema = T._parse_datatype_string(f"doc_id {_kind(docs, 'doc_id')}, {ddl}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for batch in _bounded(in_slices(batches, TEXTS_AT_ONCE)):
            ids, bounds = encoder.encode_all(batch.column(1))
            rows: list[tuple] = []
            for doc_id, a, b in zip(batch.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                rows.extend((doc_id, *row) for row in fn(encoder, ids[a:b]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the token ids of its text."""
    return encodings(docs, lambda _, ids: [(ids.tolist(),)], "ids array<bigint>", path)


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text that its ``ids`` stand for."""

    def rows(doc_id, ids) -> Iterator[tuple]:
        yield doc_id, None if ids is None else Encoder.of(path).decode(i for i in ids if i is not None)

    return mapped(tokens, ["doc_id", "ids"], rows, f"doc_id {_kind(tokens, 'doc_id')}, text string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document the number of tokens, the digest of its ids and that of their decoded text."""

    def row(encoder: Encoder, ids: np.ndarray) -> Iterator[tuple]:
        found = ids.tolist()
        listed = " ".join(map(encoder.numbers.__getitem__, found))
        yield len(found), _sha256(listed), _sha256(encoder.decode(found))

    return encodings(docs, row, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", path)


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
