import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, packing
from tidemark.llm.queries import all_queries

SF = "/root/testdata/sf0.001"

#: Marks that join when lower-cased, composed and decomposed letters, ligatures, joiners, odd blanks, special tokens.
PIECES = [
    *("İ", "ﬁ", "Σ", "ς", "é", "é", "́", "‍", "中", "한", "가", "\U0001f600", "ß", "ẞ", "ǅ", "Å"),
    *("\t", "\n", " ", "\r", "\x0b", "\x85", "\xa0", " ", "　", "᠎", "​", "﻿", "\x00", "\x1c"),
    *("'s", "'LL", "'Re", "İ.", "the", "ing", "A", "z", "1", "٣", "Ⅷ", "²", "\xad", "_", "...", "!!"),
    *("<|endoftext|>", "<|startoftext|>", "<|", "|>"),
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


def _same(library, texts):
    encoder = bpe.Encoder.of(None)
    ids, bounds = encoder.encode_all(texts)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, text
        assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_strings_of_odd_pieces(library):
    draw = random.Random(7)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 14))) * draw.choice([1, 1, 1, 9]) for _ in range(6000)]
    _same(library, texts)


def test_any_characters(library):
    draw = random.Random(8)
    spans = [(0, 0x7F), (0, 0xFF), (0, 0x2FF), (0, 0xD7FF), (0xE000, 0x10FFFF)]
    texts = ["".join(chr(draw.randint(*draw.choice(spans))) for _ in range(200)) for _ in range(300)]
    _same(library, texts)


def test_upper_case_with_marks(library):
    _same(library, ["YENİ.", "SERİ, YENİ.", "İ,", "İ."])


@pytest.mark.parametrize("n", [2, 3, 63, 64, 65, 66, 500, 5000])
def test_lone_words_of_any_length(library, n):
    draw = random.Random(n)
    _same(library, ["a" * n, "é" * n, "".join(draw.choices("etaoinshrdlu", k=n)), "".join(draw.choices("thein", k=n))])


def test_root_is_leftmost_of_lowest_rank():
    """Merges one at a time by their definition, over all pairs."""
    encoder = bpe.Encoder.of(None)
    draw = random.Random(3)
    for _ in range(300):
        word = [*encoder._single[[ord(c) for c in draw.choices("aeinrst", k=draw.randint(1, 90))]].tolist(), int(encoder._last[101])]
        want = list(word)
        while True:
            ranks = [encoder._rank_of.get(a * encoder._width + b, 1 << 60) for a, b in zip(want, want[1:])]
            if not ranks or min(ranks) == 1 << 60:
                break
            at = ranks.index(min(ranks))
            want[at : at + 2] = [int(encoder._merged[ranks[at]])]
        assert encoder.merge_long(word) == want


def test_small_memory_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PARTS", 3)
    encoder = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY))
    for text in ["one two three four", "two three five six", "one", "", "three\nseven, eight"] * 2:
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert len(encoder.parts) <= 7


@pytest.mark.parametrize("words", [3, 200_000])
def test_latin_words_and_endings(library, monkeypatch, words):
    """Words found in bulk, with apostrophes of any surroundings, beside parts that the library has to split."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", words, raising=False)
    draw = random.Random(9)
    signs = ["'", "'", "s", "T", "re", "ve", "m", "LL", "l", "d", "a", "É", "ß", "1", "²", "!", "<", " ", " ", "\n"]
    texts = ["".join(draw.choices(signs, k=draw.randint(0, 12))) for _ in range(4000)]
    _same(library, texts)
    _same(library, [t + draw.choice(["", "", " 中", "<|"]) for t in texts])
    _same(library, ["", "", ""])


def test_common_words_stay_in_a_full_memory(monkeypatch):
    """A word of every batch is merged once, however many others come and go, and in whatever part it stands."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 200, raising=False)
    monkeypatch.setattr(bpe, "CACHE_PARTS", 200)
    encoder = bpe.Encoder(public_tokenizers.path(bpe.VOCABULARY))
    draw, merged, merge = random.Random(4), Counter(), encoder._merged_words
    monkeypatch.setattr(encoder, "_merged_words", lambda words: merged.update(words) or merge(words))
    common = ["".join(draw.choices("aeinrst", k=9)) for _ in range(40)]
    for batch in range(20):
        rare = ["".join(draw.choices("aeinrst", k=12)) for _ in range(40)]
        encoder.encode_all([" ".join(draw.choice([w, w + ",", w.title()]) for w in common + rare)])
    assert [merged[w] for w in common] == [1] * 40
    assert len(encoder.words) <= 200


def _expected(library, rows):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


def test_query(spark, library):
    got = all_queries()["op12_bpe_round_trip"](spark, SF)
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == _expected(library, rows)


def test_odd_rows(spark, documents, odd, library):
    docs = documents(odd)
    assert sorted(map(tuple, bpe.round_trip(docs).collect()), key=repr) == _expected(library, [(i, t) for i, t, _ in odd])
    assert bpe.round_trip(docs.limit(0)).count() == 0
    ids = bpe.encoded(docs)
    back = {(r.doc_id, r.text) for r in bpe.decoded(ids).collect()}
    assert back == {(i, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t, _ in odd}
    none = spark.createDataFrame([(1, None), (2, []), (3, [5, None, 10**6])], "doc_id bigint, ids array<bigint>")
    assert {tuple(r) for r in bpe.decoded(none).collect()} == {(1, None), (2, ""), (3, bpe.Encoder.of(None).tokens[5])}


def test_packing_uses_the_same_ids(spark, documents, library):
    texts = ["YENİ.", "SERİ, YENİ.", "x‍́ ﬁ ß 한"]
    docs = documents([(i, t, "a") for i, t in enumerate(texts)])
    got = {r.doc_id: r.ids for r in packing.pieces(docs, with_ids=True).collect()}
    assert got == {i: [*library.encode(t, add_special_tokens=False).ids, packing.END] for i, t in enumerate(texts)}
