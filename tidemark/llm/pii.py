"""Personal data: high-recall candidates judged by boosted trees.

The base finds well-formed addresses and numbers. Beyond it, generators propose overlapping spans
that may be personal data in other forms: addresses with a written-out or bracketed "at" and "dot", phone
numbers without an international prefix, addresses of machines with bracketed dots, cards with other
separators. Boosted trees judge each candidate by its format and by the words around it; what reaches the
threshold of its kind and touches no base span is added, the most likely of overlapping ones first.

The trees learn from the corpus itself, from a bounded sample of at most ``SAMPLE`` documents: a fifth for
each kind, of documents with a base span of it, and a fifth of documents with candidates but no base span;
of each those of the smallest hash, a third of all documents never being taken. Base spans, rewritten
into the other forms where they stand, are examples; counter-examples are base spans damaged so that they
fail their check, and candidates that are no base span.

The thresholds come from all documents that are not in the sample: their examples are scored where they
lie and counted by kind, score and label. The threshold of a kind is the smallest score from which on at
least ``PRECISION`` of them are examples. A kind that has none, or fewer than ten from there on in the
whole table, adds nothing.

Each pass over the texts first asks, in one linear run over an Arrow batch, which of them hold a sign that
every base span and candidate has; only those are searched by the patterns of the kinds.

Defined cases: a null text is empty; repeated rows get equal results; a table without a base span
gives the base alone; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, in_slices
from tidemark.llm.trees import Trees, boosted

# Kinds and patterns of the base.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits fails from its first digit exactly if it fails from any, so later starts are not tried.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

SAMPLE = 4_000
PRECISION = 0.98
CONTEXT = 32
#: Most candidates of one sampled document that are learned from.
PER_DOCUMENT = 40
#: Scores are told apart in steps of 1 / STEPS, within LARGEST.
STEPS, LARGEST = 50, 30

Found = tuple[str, int, int]


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each domain backwards: linear also in texts of one long word."""
    end = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
            end = m.end()


def base_spans(text: str) -> list[Found]:
    found = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    found += [("ip", *m.span()) for m in IP.finditer(text) if _small_parts(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return in_order(found)


def in_order(spans: list[Found]) -> list[Found]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Found]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ---- candidates ------------------------------------------------------------------------------

_AT = re.compile(r"\s?[(\[{]\s?(?:at|@)\s?[)\]}]\s?|\s(?:at|AT)\s|\s@\s|＠")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:(?:\s?[(\[{]\s?(?:dot|\.)\s?[)\]}]\s?|\s(?:dot|DOT)\s|\.)[A-Za-z0-9-]+)+")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().\-/‐-― ]{0,2}[0-9]){6,18}(?![0-9])")
_MACHINE = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\s?[(\[]\.[)\]]\s?|\s\.\s|\[dot\])[0-9]{1,3}){3}(?![0-9])")
_CONTEXT_WORDS = {
    "email": re.compile(r"mail|contact|write|reach", re.IGNORECASE),
    "ip": re.compile(r"\bip\b|host|server|address|addr", re.IGNORECASE),
    "card": re.compile(r"card|visa|credit|payment|master", re.IGNORECASE),
    "phone": re.compile(r"phone|\btel|call|fax|mobile|cell|contact|reach", re.IGNORECASE),
}


def candidates(text: str) -> list[Found]:
    """Spans that may be personal data; they overlap, and most of them are not."""
    found: list[Found] = []
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end())
        start = m.start()
        while start and text[start - 1] in LOCAL:
            start -= 1
        spelled = host and (m.group().strip() not in ("at", "AT", "@") or not host.group().isalnum())
        if spelled and start < m.start() and ("ot" in host.group() or m.group().strip().lower() != "at"):
            found.append(("email", start, host.end()))
    for m in _NUMBER.finditer(text):
        n = len(_digits(m.group()))
        if 7 <= n <= 15:
            found.append(("phone", *m.span()))
        if 12 <= n <= 19:
            found.append(("card", *m.span()))
    found += [("ip", *m.span()) for m in _MACHINE.finditer(text)]
    return found


#: What a text with a base span or candidate must hold: a mark, four digits with little between them, or
#: a written-out "at" before words that a dot, or what may stand for one, joins.
_SIGNS = (
    r"@|＠|\+[0-9]|[0-9](?:[^0-9]{0,5}[0-9]){3}|[^A-Za-z0-9](?:at|AT)[^A-Za-z0-9-]{1,3}[A-Za-z0-9-]+"
    r"(?:\.|[^A-Za-z0-9-]{1,3}(?:dot|DOT|\.)[^A-Za-z0-9-]{1,3})[A-Za-z0-9-]"
)


def signed(texts: pa.Array) -> pa.Array:
    """Whether each text holds a sign; one without has no base span and no candidate. False for null."""
    return pc.fill_null(pc.match_substring_regex(texts, _SIGNS), False)


N_FEATURES = 28


def described(text: str, kind: str, a: int, b: int) -> list[float]:
    """Format and context of one candidate."""
    span, left, right = text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    digits = _digits(span)
    groups = [g for g in re.split(r"[^0-9]+", span) if g]
    lower = span.lower()
    before, after = left[-1:], right[:1]
    near = _CONTEXT_WORDS[kind]
    return [
        *(float(kind == k) for k in KINDS),
        len(span),
        len(digits),
        sum(c.isalpha() for c in span),
        sum(c in " -./()" for c in span),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        float(span[:1] == "+"),
        float(span[:1] == "("),
        float(digits[:1] == "0"),
        float(bool(digits) and luhn(digits)),
        float(all(int(g) <= 255 for g in groups if len(g) < 6) and len(groups) == 4),
        float(len(groups) > 0 and all(len(g) == 4 for g in groups)),
        float("dot" in lower),
        float("(" in span or "[" in span or "{" in span),
        float("@" in span or "＠" in span),
        lower.count("."),
        len(re.split(r"[^a-z0-9]+", lower)[-1]),
        float(before.isalnum()),
        float(after.isalnum()),
        float(before in ("-", ".", "/", ":", "_", "#", "=")),
        float(bool(near.search(left))),
        float(bool(near.search(right))),
        len(set(digits)),
    ]


def _touches(spans: list[Found], a: int, b: int) -> bool:
    return any(a < e and s < b for _, s, e in spans)


# ---- learning --------------------------------------------------------------------------------


def _other_forms(kind: str, span: str, pick: int) -> tuple[list[str], list[str]]:
    """The same datum in other forms, and damaged ones that are no such datum."""
    if kind == "email":
        local, _, host = span.partition("@")
        at, dot = ((" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "."))[pick % 4]
        return [local + at + host.replace(".", dot)], [f"{local} at {host.split('.')[0]}"]
    digits = _digits(span)
    if kind == "ip":
        dot = ("[.]", "(.)", " . ", "[dot]")[pick % 4]
        parts = span.split(".")
        return [dot.join(parts)], [dot.join([*parts[:3], str(256 + pick % 700)])]
    if kind == "card":
        sep = (".", "–", "  ", "/")[pick % 4]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + pick % 9) % 10)
        cut = lambda d: sep.join(d[i : i + 4] for i in range(0, len(d), 4))
        return [cut(digits)], [cut(wrong), wrong]
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    forms = (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}")
    return [forms[pick % 4]], [digits[-9:], digits[-8:-4] + "-" + digits[-4:-2] + "-" + digits[-2:]]


def examples(text: str, most: int | None = None) -> list[tuple[float, list[float]]]:
    """(1 or 0, features) of what one document teaches; all of it, or of ``most`` spans of either sort."""
    base = base_spans(text)
    out = []
    for kind, a, b in base[:most]:
        pick = int.from_bytes(hashlib.blake2b(text[a:b].encode(), digest_size=4).digest(), "big")
        left, right = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
        good, bad = _other_forms(kind, text[a:b], pick)
        for label, forms in ((1.0, good), (0.0, bad)):
            for form in forms:
                out.append((label, described(left + form + right, kind, len(left), len(left) + len(form))))
    others = [c for c in candidates(text) if not _touches(base, c[1], c[2])]
    out += [(0.0, described(text, *c)) for c in others[:most]]
    return out


@dataclass(frozen=True)
class Model:
    trees: Trees
    thresholds: dict[str, float]


def stepped(margin: np.ndarray) -> np.ndarray:
    """Scores as multiples of 1 / STEPS."""
    return np.floor(np.clip(margin, -LARGEST, LARGEST) * STEPS) / STEPS


def _sampled(hashed: DataFrame, sample: int) -> list[int]:
    """Hashes of the documents to train on: the smallest for each kind, and of those without a base span."""

    def sorts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            hs, masks = [], []
            for h, text in zip(*(c.to_pylist() for c in batch.filter(signed(batch.column(1))).columns)):
                kinds = {kind for kind, _, _ in base_spans(text)}
                mask = sum(1 << k for k, kind in enumerate(KINDS) if kind in kinds)
                if not mask and candidates(text):
                    mask = 1 << len(KINDS)
                if mask:
                    hs.append(h)
                    masks.append(mask)
            yield pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(masks, pa.int32())], names=["h", "mask"])

    pool = hashed.filter(F.pmod("h", F.lit(3)) != 0)
    found = cut_lineage(pool.mapInArrow(sorts, "h bigint, mask int"))
    chosen: set[int] = set()
    for k in range(len(KINDS) + 1):
        of = found.filter(F.col("mask").bitwiseAND(1 << k) != 0).select("h").distinct()
        chosen |= {r.h for r in of.orderBy("h").limit(max(1, sample // (len(KINDS) + 1))).collect()}
    return sorted(chosen)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Trees from the sample, thresholds from all other documents; None where no base span is sampled."""
    h = F.xxhash64(F.col("doc_id").cast("string"), F.col("text")).alias("h")
    hashed = docs.filter(F.col("text").isNotNull()).select(h, "text")
    chosen = _sampled(hashed, sample)
    if not chosen:
        return None
    ids = F.broadcast(docs.sparkSession.createDataFrame(pa.table({"h": pa.array(chosen, pa.int64())})))

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            h, texts = (c.to_pylist() for c in batch.columns)
            found = [(k, y, x) for k, t in zip(h, texts) for y, x in examples(t, PER_DOCUMENT)]
            if found:
                ks, ys, xs = zip(*found)
                rows = [np.array(x).tobytes() for x in xs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ks, pa.int64()), pa.array(ys, pa.float64()), pa.array(rows, pa.binary())], names=["h", "y", "x"]
                )

    got = hashed.join(ids, "h", "left_semi").mapInArrow(teach, "h bigint, y double, x binary").collect()
    got.sort(key=lambda r: (r["h"], r["y"], r["x"]))
    y = np.array([r["y"] for r in got])
    if not got or y.min() == y.max():
        return None
    trees = boosted(np.stack([np.frombuffer(r["x"]) for r in got]), y)
    return Model(trees, _thresholds(hashed, trees, np.array(chosen)))


def _thresholds(hashed: DataFrame, trees: Trees, chosen: np.ndarray) -> dict[str, float]:
    """Per kind, from the examples of every document outside the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, int] = {}
        for batch in in_slices(batches):
            back = ~np.isin(batch.column(0).to_numpy(zero_copy_only=False), chosen)
            texts = batch.column(1).filter(pc.and_(pa.array(back), signed(batch.column(1)))).to_pylist()
            found = [e for t in texts for e in examples(t)]
            if not found:
                continue
            x = np.array([f for _, f in found])
            score = np.rint(stepped(trees.margin(x)) * STEPS).astype(np.int64)
            kind = x[:, : len(KINDS)].argmax(axis=1)
            for key, n in zip(*np.unique(np.column_stack([kind, score, [y for y, _ in found]]).astype(np.int64), axis=0, return_counts=True)):
                counts[tuple(key.tolist())] = counts.get(tuple(key.tolist()), 0) + int(n)
        if counts:
            columns = [*zip(*counts), counts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names=["kind", "score", "y", "n"])

    counted = hashed.mapInArrow(count, "kind bigint, score bigint, y bigint, n bigint")
    rows = counted.groupBy("kind", "score", "y").agg(F.sum("n").alias("n")).collect()
    out = {}
    for k, kind in enumerate(KINDS):
        score, y, n = (np.array([r[c] for r in rows if r["kind"] == k], float) for c in ("score", "y", "n"))
        if (cut := calibrated(score / STEPS, y, counts=n)) is not None:
            out[kind] = cut
    return out


def calibrated(
    scores: np.ndarray, truth: np.ndarray, precision: float = PRECISION, least: int = 10, counts: np.ndarray | None = None
) -> float | None:
    """The smallest score from which on examples are this frequent; ``counts`` says how many each row stands for."""
    order = np.argsort(-scores, kind="stable")
    n = np.ones(len(order)) if counts is None else counts[order]
    total = np.cumsum(n)
    right = np.cumsum(truth[order] * n) / total
    ends = np.flatnonzero(np.r_[np.diff(scores[order]) < 0, True]) if len(order) else np.zeros(0, int)
    good = ends[(right[ends] >= precision) & (total[ends] >= least)]
    return float(scores[order][good[-1]]) if good.size else None


# ---- finding ---------------------------------------------------------------------------------


def added(texts: list[str], bases: list[list[Found]], model: Model | None) -> list[list[Found]]:
    """Per text, the accepted candidates that touch no base span and no better candidate."""
    out: list[list[Found]] = [[] for _ in texts]
    if model is None or not model.thresholds:
        return out
    where, spans, x = [], [], []
    for i, text in enumerate(texts):
        for kind, a, b in candidates(text):
            if kind in model.thresholds and not _touches(bases[i], a, b):
                where.append(i)
                spans.append((kind, a, b))
                x.append(described(text, kind, a, b))
    if not x:
        return out
    margin = model.trees.margin(np.array(x))
    scores = stepped(margin)
    for j in np.argsort(-margin, kind="stable"):
        kind, a, b = spans[j]
        if scores[j] >= model.thresholds[kind] and not _touches(out[where[j]], a, b):
            out[where[j]].append((kind, a, b))
    return out


def find(docs: DataFrame, model: Model | None) -> DataFrame:
    """Per document: counts and digest of the base, and all spans."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {doc_id}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            column = batch.column(1)
            texts = pc.if_else(signed(column), column, pa.scalar("", column.type)).to_pylist()
            bases = [base_spans(t) for t in texts]
            more = added(texts, bases, model)
            columns: list[pa.Array] = [batch.column(0)]
            for kind in KINDS:
                columns.append(pa.array([sum(s[0] == kind for s in b) for b in bases], pa.int64()))
            columns.append(pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in bases], pa.string()))
            columns.append(pa.array([written(in_order([*b, *m])) for b, m in zip(bases, more)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ddl.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, ddl)


def redact(text: str, spans: str, mark: str = "[{}]") -> str:
    """``text`` with the written spans replaced by the name of their kind; overlapping ones as one."""
    pieces, at = [], 0
    for kind, a, b in (s.split(":") for s in spans.split(",") if s):
        if int(a) >= at:
            pieces += [text[at : int(a)], mark.format(kind.upper())]
        at = max(at, int(b))
    return "".join([*pieces, text[at:]])
