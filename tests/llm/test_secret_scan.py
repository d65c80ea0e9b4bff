import base64
import gzip
import hashlib
import re
import zlib
from urllib.parse import quote

import pytest

from tidemark.llm import secret_scan
from tidemark.llm.queries import all_queries

SECRET = "password = hunter2hunter2"
KEY = "AKIA" + "ABCDEFGH12345678"


def _b64(data):
    return base64.b64encode(data).decode()


def _base(text):
    """The base by brute force: each pattern as stated, then its check."""
    text = text or ""
    word = "".join
    either = lambda w: word(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join(map(either, ("password", "passwd", "secret", "token"))) + f"|{either('api')}_?{either('key')}"
    assign = rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = [("assign", m) for m in re.finditer(assign, text) if len(m.group(2)) >= 6]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(((m.start(), ["assign", "access", "hex"].index(k), f"{k}:{m.start()}:{m.end()}") for k, m in found))


def _row(text):
    found = _base(text)
    digest = hashlib.sha256(",".join(f[2] for f in found).encode()).hexdigest()
    return tuple(sum(f[1] == k for f in found) for k in range(3)), digest, [f[2] for f in found]


def test_query_has_the_base(spark):
    sf = "/root/testdata/sf0.01"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = all_queries()["op8_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        counts, digest, spans = _row(texts[r.doc_id])
        assert ((r.n_assign, r.n_access, r.n_hex), r.base_sha256) == (counts, digest)
        assert set(spans) <= set(r.spans.split(","))
    assert any(r.n_assign for r in rows)


def test_odd_rows(spark, documents, odd):
    docs = documents(odd)
    got = sorted((r.doc_id or -1, r.base_sha256) for r in secret_scan.scan(docs).collect())
    assert got == sorted((i or -1, _row(t)[1]) for i, t, _ in odd)
    assert secret_scan.redact(docs).collect() and secret_scan.redact(docs).columns == docs.columns
    assert sorted(map(repr, secret_scan.redact(docs).collect())) == sorted(map(repr, docs.collect()))
    assert secret_scan.scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize(
    "hidden",
    [
        quote(SECRET, safe=""),
        "".join(f"%{b:02X}" for b in SECRET.encode()),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        _b64(SECRET.encode()),
        _b64(zlib.compress(SECRET.encode())),
        _b64(gzip.compress(SECRET.encode())),
        _b64(quote(_b64(gzip.compress(_b64(SECRET.encode()).encode()))).encode()),
        "".join(f"%{b:02X}" for b in _b64(SECRET.encode()).encode()),
    ],
)
def test_layers_map_to_the_input(hidden):
    text = f"some words {hidden} and é more"
    base, spans, layers, cut = secret_scan.find(text)
    a, b = text.index(hidden), text.index(hidden) + len(hidden)
    assert not base and layers > 1 and not cut
    assert spans and all(a <= s and e <= b for _, s, e in spans)
    cleaned = secret_scan.redacted(text)
    assert "hunter2" not in cleaned and secret_scan.find(cleaned)[1] == []
    assert cleaned.startswith("some words ") and cleaned.endswith(" and é more")


def test_spans_keep_kinds_and_order():
    text = f"x {KEY} y {SECRET} z " + "0123456789abcdef" * 2
    base, spans, _, _ = secret_scan.find(text)
    assert [k for k, _, _ in base] == ["access", "assign", "hex"] and spans == base
    assert secret_scan.redacted(text) == "x [SECRET] y [SECRET] z [SECRET]"


def test_cycles_and_plain_text_end():
    assert secret_scan.find("%2525252525 \\u005cu0041 plain")[1] == []
    assert secret_scan.find("z" * 100_000 + " " + "%41" * 50_000)[1] == []


def test_pressed_layer_is_cut_and_says_so(monkeypatch):
    monkeypatch.setattr(secret_scan, "MAX_LAYER", 1000)
    text = _b64(zlib.compress(b"x" * 5000))
    assert secret_scan.find(text)[3] >= 1


@pytest.mark.parametrize("pack", [zlib.compress, gzip.compress])
@pytest.mark.parametrize("where", [0, 900, 1000, 3000, 20_000])
def test_long_layers_are_searched_whole(monkeypatch, pack, where):
    monkeypatch.setattr(secret_scan, "MAX_LAYER", 1000)
    monkeypatch.setattr(secret_scan, "_PIECE", 300)
    words = ("plain words, " * 4000)[:where]
    nested = _b64(gzip.compress(b"more text; " * 300 + SECRET.encode()))
    for inner in (SECRET, KEY, nested):
        hidden = _b64(pack(f"{words} {inner} {'last words, ' * 900}".encode()))
        text = f"some words {hidden} and more"
        _, spans, _, cut = secret_scan.find(text)
        assert cut and spans and {(a, b) for _, a, b in spans} == {(11, 11 + len(hidden))}
        assert secret_scan.redacted(text) == "some words [SECRET] and more"


def test_equal_windows_in_two_tokens(monkeypatch):
    monkeypatch.setattr(secret_scan, "MAX_LAYER", 1000)
    monkeypatch.setattr(secret_scan, "_PIECE", 300)
    plain = f"{'plain words, ' * 400}{_b64(SECRET.encode())} {'last words, ' * 400}".encode()
    text = f"one {_b64(zlib.compress(plain))} two {_b64(zlib.compress(plain))} end"
    assert secret_scan.redacted(text) == "one [SECRET] two [SECRET] end"


def test_later_members_and_what_follows_them():
    first, second = gzip.compress(b"nothing here"), gzip.compress(f" but {SECRET}".encode())
    for data in (first + second, first + b"\0" * 8 + second, first + f" {SECRET}".encode(), gzip.compress(b"") + second):
        assert "[SECRET]" in secret_scan.redacted(f"x {_b64(data)} y")


SECRETS = "password = hunter22x and " + "filler words here, " * 30 + "token: abcdef123456 end"


@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("pack", [str.encode, lambda t: gzip.compress(t.encode()), lambda t: zlib.compress(t.encode())])
@pytest.mark.parametrize("newline", ["\n", "\r\n", "\n    "])
@pytest.mark.parametrize("around", [("", ""), ("data: ", " rest"), ("see\n", "\nDone\n"), ("x\n", "\nDone with it all")])
def test_wrapped_base64(width, pack, newline, around):
    code = base64.b64encode(pack(SECRETS)).decode()
    body = newline.join(code[i : i + width] for i in range(0, len(code), width))
    text = around[0] + body + around[1]
    _, spans, _, _ = secret_scan.find(text)
    start, end = len(around[0]), len(around[0]) + len(body)
    assert {k for k, a, b in spans if a <= start and b >= end} >= {"assign"}
    assert "[SECRET]" in secret_scan.redacted(text) and code[:60] not in secret_scan.redacted(text)


def test_wrapped_in_full_lines_before_other_text():
    """Data that fills its last line, before a line that could be one more."""
    text = "x" * 2 + " password = hunter22x and so on, and more of the like here"
    code = base64.b64encode(text[:57].encode() * 2).decode()
    body = f"{code[:76]}\n{code[76:]}"
    assert len(code) == 152
    for after in ("\nDone\n", "\nDone with it", "\n", ""):
        _, spans, _, _ = secret_scan.find(body + after)
        assert any(a == 0 and b >= len(body) for _, a, b in spans), after


@pytest.mark.parametrize("form", ["\\u{%x}", "\\U%08x", "\\u%04x", "\\x%02x"])
def test_escapes_of_all_forms(form):
    text = "see " + "".join(form % ord(c) for c in "password=hunter22x") + " end"
    _, spans, _, _ = secret_scan.find(text)
    assert [k for k, _, _ in spans] == ["assign"] and spans[0][1] == 4 and spans[0][2] == len(text) - 4
    wide = "\\U0001f600\\U99999999" + "".join(form % ord(c) for c in "password=hunter22x")
    assert [k for k, _, _ in secret_scan.find(wide)[1]] == ["assign"]


def test_prose_over_lines_is_left_alone():
    text = "internationalization\nof averylongwordindeed\nand\nmore"
    assert secret_scan.redacted(text) == text
