import re
from collections import Counter
from itertools import product
from math import comb

import numpy as np
import pytest

from tidemark.llm import rules
from tidemark.llm.queries import all_queries

LABELS = "doc_id bigint, quality int, toxic int"


def _counts(text):
    """The base by brute force."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, repeated = len(words), len(covered)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        repeated,
        n < 50 or 100 * repeated > 50 * n,
    )


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = all_queries()["op6_risk_controlled_rules"](spark, sf).collect()
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    docs, lang = {r.doc_id: r.text for r in table}, {r.doc_id: r.lang for r in table}
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[1:7] == _counts(docs[r.doc_id])
        assert not (r.base_failed and r.kept)
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rated = [(r.kept, truth[r.doc_id]) for r in rows if r.doc_id in truth and not r.base_failed]
    good = [k for k, q in rated if q == 1]
    assert sum(good) / len(good) > 1 - rules.ALPHA
    # Every language has labels enough for a verdict.
    for wanted in set(lang.values()):
        bad = [r.kept for r in rows if lang[r.doc_id] == wanted and truth.get(r.doc_id) == 0]
        assert sum(bad) / len(bad) < 0.1, wanted


def test_odd_rows(spark, documents, odd):
    docs = documents(odd)
    labels = spark.createDataFrame([(7, 1, 0), (5, 1, 0), (5, 0, 0), (None, 1, 0), (1, None, 0)], LABELS)
    for known in (labels, labels.limit(0)):
        rows = rules.judged(docs, known).collect()
        want = sorted(((i, *_counts(t)) for i, t, _ in odd), key=repr)
        assert sorted((tuple(r)[:7] for r in rows), key=repr) == want
        assert all(r.kept != r.base_failed for r in rows)
    assert rules.judged(docs.limit(0), labels).count() == 0


def test_strata_get_their_own_cutoffs(spark):
    """Many signs are normal in one language; there only the rule on signs must not bite."""
    def text(signs):
        return " ".join(f"w{i % 97}{i}" for i in range(80)) + " #" * signs

    rows, labels = [], []
    for i, (lang, good) in enumerate(product(("aa", "bb"), [True] * 3000 + [False] * 300)):
        rows.append((i, text(40 if not good or lang == "bb" else 0), lang))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r.kept for r in rules.judged(docs, spark.createDataFrame(labels, LABELS)).collect()}
    for i, _, lang in rows:
        assert found[i] == (lang == "bb" or labels[i][1] == 1)


@pytest.mark.parametrize("k,n,p", [(0, 5, 0.1), (3, 20, 0.25), (7, 9, 0.5)])
def test_binomial(k, n, p):
    want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert rules.at_most(k, n, p) == pytest.approx(want)


def test_search_ends_at_the_first_failure():
    assert rules.safe_cutoffs([0, 50, 0], 1000, 0.01, 0.01) == 1
    assert rules.safe_cutoffs([0, 0, 1], 2000, 0.01, 0.01) == 3
    assert rules.safe_cutoffs([0], 10, 0.01, 0.01) == 0


def _values(**columns):
    n = len(next(iter(columns.values())))
    return np.column_stack([columns.get(r, [-np.inf] * n) for r in rules.RULES]).astype(float)


def test_path_takes_the_step_worth_most():
    """Rules that catch what others leave come one behind the other; steps that cost more than they catch do not."""
    n = 40
    bad = np.arange(n) >= 30
    symbols = np.where(np.arange(n) >= 33, 0.4, 0.0)
    echoes = np.where((np.arange(n) >= 30) & (np.arange(n) < 33), 0.8, 0.0)
    upper = np.where(np.arange(n) % 2 == 0, 0.9, 0.0)
    steps = rules.path_of(_values(symbol_share=symbols, echo_share=echoes, upper_share=upper), ~bad)
    names = [list(rules.RULES)[r] for r, _ in steps]
    assert names == ["symbol_share", "echo_share"]
    assert all(cut < top for (_, cut), top in zip(steps, (0.4, 0.8)))


def test_every_path_step_by_brute_force():
    """Each step rejects, of all steps there are, what is worth most."""
    draw = np.random.default_rng(5)
    values, good = draw.random((300, len(rules.RULES))) * 0.9, draw.random(300) < 0.6
    values[good] *= 0.4
    rejected = np.zeros(300, bool)
    for rule, cut in rules.path_of(values, good):
        def worth(r, c):
            new = [i for i in range(300) if values[i, r] > c and not rejected[i]]
            return sum(-rules.GOOD_WEIGHT if good[i] else 1 for i in new)

        best = max(worth(r, c) for r, cuts in enumerate(rules.RULES.values()) for c in cuts)
        assert worth(rule, cut) == best > 0
        rejected |= values[:, rule] > cut


def test_few_labels_prove_nothing(spark):
    rows = [(i, " ".join(f"w{j}{i}" for j in range(80)) + " #" * (40 if i % 4 == 0 else 0), "aa") for i in range(160)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(160)], LABELS)
    assert all(r.kept for r in rules.judged(docs, labels).collect())


def test_paths_count_every_labelled_document(spark):
    """The path of a stratum with many labelled documents is that of all of them, not of some."""
    draw = np.random.default_rng(8)
    strata = {}
    for stratum, n in (("aa", 9000), ("bb", 40), ("cc", 1)):
        values, good = draw.random((n, len(rules.RULES))) * 0.9, draw.random(n) < 0.6
        values[good] *= 0.3
        values[draw.random(values.shape) < 0.3] = -np.inf
        strata[stratum] = values, good
    rows = [(s, int(g), v.tolist()) for s, (values, good) in strata.items() for v, g in zip(values, good)]
    found = rules.paths(spark.createDataFrame(rows, "stratum string, quality int, values array<double>")).collect()
    assert {r.stratum: list(zip(r.rules, r.cuts)) for r in found} == {s: rules.path_of(*x) for s, x in strata.items()}
