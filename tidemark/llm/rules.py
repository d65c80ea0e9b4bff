"""Quality rules with risk-controlled cutoffs.

Each rule rejects documents whose value of a measure lies beyond a cutoff. Cutoffs are chosen per stratum
(language) on the labelled documents, in two halves by a hash of the id. On the first half a path is
laid: step by step the cutoff is added or tightened, of whichever rule, that newly rejects most bad
documents, a good one weighing as much as ``GOOD_WEIGHT`` bad ones, until none is worth it. The second half
holds all labelled documents of it back for the proof: along the path, the good ones that any rule
rejects so far are counted, and an exact binomial test must refute that more than ``ALPHA`` of the good
documents are rejected, at level ``DELTA`` divided by the number of strata (Bonferroni). The first step
that fails ends the walk, so trying many steps needs no further correction, and the bound holds for all
rules of a stratum together. The steps passed are taken. Some 90 good documents in the half suffice
where none is rejected; a stratum with fewer gets no rule.

Statistics are made in one pass over whole texts and stored as narrow rows. Both halves count all their
labelled documents. For the paths these are folded to the combinations of cutoffs that they exceed; a round
over those finds the next step of every stratum, from one sum per stratum and cutoff, until no stratum
has another. The proof counts its half per stratum and step. Cutoffs meet the documents by a join that
broadcasts only strata with very many rows.

Defined cases: a null text has no words and fails the base; a null language is a stratum of its own;
a document with both labels counts as not labelled; no labels mean no verdicts; repeated rows get equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.skew import join_per_key
from tidemark.llm.common import mapped, stored

ALPHA = 0.05
DELTA = 0.05
GOOD_WEIGHT = 10.0
LEAST_WORDS = 50
MOST_REPEATED = 50

# Signs counted as symbols, and the white space between words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"

#: Rules: measure, and its cutoffs from the safest to the strictest. A value above the cutoff is rejected.
RULES: dict[str, tuple[float, ...]] = {
    "symbol_share": tuple(np.geomspace(0.5, 0.005, 24).tolist()),
    "mark_share": tuple(np.geomspace(1.0, 0.02, 24).tolist()),
    "upper_share": tuple(np.geomspace(0.95, 0.05, 24).tolist()),
    "echo_share": tuple(np.geomspace(0.9, 0.02, 24).tolist()),
    "dup_line_share": tuple(np.geomspace(0.9, 0.02, 24).tolist()),
    "long_words": tuple(np.geomspace(60.0, 6.0, 24).tolist()),
}

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_marks", "n_upper", "n_echoes")


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a window of three which occurs twice or more."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def measured(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of _COUNTS and _MORE."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    seen: set[str] = set()
    n_lines = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            n_lines += 1
            seen.add(line)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        n_lines - len(seen),
        repeated_words(words),
        n_lines,
        text.count("!"),
        sum(map(data.count, (bytes([c]) for c in range(65, 91)))),
        sum(map(eq, words, words[1:])),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, stratum and counts per document."""
    doc_id, lang = (docs.schema[c].dataType.simpleString() for c in ("doc_id", "lang"))
    counts = ", ".join(f"{c} bigint" for c in (*_COUNTS, *_MORE))
    return mapped(
        docs,
        ["doc_id", "lang", "text"],
        lambda doc_id, lang, text: [(doc_id, lang, *measured(text))],
        f"doc_id {doc_id}, lang {lang}, {counts}",
    )


def _measures(stats: DataFrame) -> DataFrame:
    """``stats`` with the value of each rule's measure, null where it has none."""

    def share(part: str, whole: str):
        return F.try_divide(F.col(part).cast("double"), F.col(whole))

    values = {
        "symbol_share": share("n_symbols", "word_chars"),
        "mark_share": share("n_marks", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "echo_share": share("n_echoes", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "long_words": share("word_chars", "n_words"),
    }
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return stats.withColumns(values | {"base_failed": failed, "stratum": F.coalesce(F.col("lang"), F.lit("\0"))})


def at_most(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` successes in ``n`` trials."""
    terms = [
        math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
        for i in range(k + 1)
    ]
    return min(1.0, math.fsum(terms))


def safe_cutoffs(rejected: list[int], n: int, share: float, level: float) -> int:
    """How many cutoffs, from the safest on, are proven to reject at most ``share``, each before the next."""
    for i, k in enumerate(rejected):
        if k > share * n or at_most(k, n, share) > level:
            return i
    return len(rejected)


def path_of(values: np.ndarray, good: np.ndarray) -> list[tuple[int, float]]:
    """Steps (rule, cutoff) that reject more and more documents, each worth most where it stands.

    ``values`` has a row per document and a column per rule, -inf where a measure has no value. It
    states for documents in memory what ``paths`` finds for all strata of a table.
    """
    steps: list[tuple[int, float]] = []
    at, rejected = [0] * len(RULES), np.zeros(len(values), bool)
    cuts = [np.array(c) for c in RULES.values()]
    while True:
        best, chosen = 0.0, None
        for rule, cutoffs in enumerate(cuts):
            for i in range(at[rule], len(cutoffs)):
                new = (values[:, rule] > cutoffs[i]) & ~rejected
                worth = float((new & ~good).sum()) - GOOD_WEIGHT * float((new & good).sum())
                if worth > best:
                    best, chosen = worth, (rule, i)
        if chosen is None:
            return steps
        rule, i = chosen
        rejected |= values[:, rule] > cuts[rule][i]
        at[rule] = i + 1
        steps.append((rule, float(cuts[rule][i])))


def paths(rows: DataFrame) -> DataFrame:
    """stratum, rules and cuts: the path of each stratum of ``rows`` (stratum, quality, values), as ``path_of`` has it.

    A document counts by the first cutoff of each rule that it exceeds. A step that was taken leaves its rule's
    earlier cutoffs nothing to reject, so they are never worth another.
    """
    longest = max(map(len, RULES.values()))

    def first(rule: int, cuts: tuple[float, ...]):
        kept = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: F.element_at("values", rule + 1) <= cut))
        return F.when(kept < len(cuts), kept).otherwise(longest)

    firsts = F.array(*[first(rule, cuts) for rule, cuts in enumerate(RULES.values())])
    folded = rows.select("stratum", "quality", firsts.alias("firsts")).groupBy("stratum", "quality", "firsts")
    folded = stored(folded.agg(F.count(F.lit(1)).alias("n")), "rule-levels")

    none = F.array(*[F.lit(-1)] * len(RULES))
    state = folded.select("stratum").distinct().select(
        "stratum",
        none.alias("reached"),
        F.lit([]).cast("array<int>").alias("rules"),
        F.lit([]).cast("array<double>").alias("cuts"),
        F.lit(True).alias("open"),
    )
    state = stored(state, "paths")
    worth = F.col("n") * F.when(F.col("quality") == 1, -GOOD_WEIGHT).otherwise(1.0)
    every = [(r, i, cut) for r, cuts in enumerate(RULES.values()) for i, cut in enumerate(cuts)]
    sums = [F.coalesce(F.sum(F.when(F.element_at("firsts", r + 1) <= i, F.col("worth"))), F.lit(0.0)) for r, i, _ in every]
    steps = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"), F.lit(cut).alias("cut")) for r, i, cut in every])
    left = ~F.exists(F.zip_with("firsts", "reached", lambda first, at: first <= at), lambda x: x)
    while not state.filter("open").isEmpty():
        ahead = state.filter("open").select("stratum", "reached")
        met = folded.join(ahead, "stratum").filter(left).select("stratum", "firsts", worth.alias("worth"))
        best = met.groupBy("stratum").agg(F.array(*sums).alias("sums"))
        best = best.select("stratum", F.array_max("sums").alias("most"), F.array_position("sums", F.array_max("sums")).alias("at"))
        best = best.filter("most > 0").select("stratum", F.element_at(steps, F.col("at").cast("int")).alias("step"))
        found = F.col("step").isNotNull()
        state = state.join(best, "stratum", "left").select(
            "stratum",
            F.transform("reached", lambda at, r: F.when(found & (F.col("step.rule") == r), F.col("step.i")).otherwise(at)).alias("reached"),
            F.when(found, F.array_append("rules", F.col("step.rule"))).otherwise(F.col("rules")).alias("rules"),
            F.when(found, F.array_append("cuts", F.col("step.cut"))).otherwise(F.col("cuts")).alias("cuts"),
            found.alias("open"),
        )
        state = stored(state, "paths")
    return state.select("stratum", "rules", "cuts")


def cutoffs(measures: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per stratum: one column per rule with its cutoff, null where none is taken."""
    rated = labels.filter(F.col("quality").isin(0, 1)).groupBy("doc_id")
    rated = rated.agg(F.min("quality").alias("quality"), F.max("quality").alias("high"))
    rated = rated.filter("quality = high").select("doc_id", "quality")
    passing = measures.filter(~F.col("base_failed")).join(rated, "doc_id")
    mark = F.xxhash64(F.col("doc_id").cast("string"))
    values = F.array(*[F.coalesce(F.col(r), F.lit(float("-inf"))) for r in RULES])
    passing = stored(passing.select("stratum", "quality", mark.alias("mark"), values.alias("values")), "labelled")

    laid = paths(passing.filter(F.pmod("mark", F.lit(2)) == 0))

    proof = passing.filter(F.pmod("mark", F.lit(2)) == 1)
    sizes = proof.groupBy("stratum").agg(F.count(F.lit(1)).alias("rows"))
    met = join_per_key(proof, sizes.join(laid, "stratum"), "stratum", "rows")
    hits = F.transform(
        F.arrays_zip("rules", "cuts"), lambda x, i: F.when(F.element_at("values", x["rules"] + 1) > x["cuts"], i)
    )
    counted = met.withColumn("step", F.array_min(hits)).groupBy("stratum", "quality", "step").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("n_strata", laid.agg(F.count(F.lit(1))).scalar()).join(laid, "stratum")

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        rules, cuts = list(rows.rules.iloc[0]), list(rows.cuts.iloc[0])
        good = rows[rows.quality == 1]
        hit = good[good.step.notna()]
        new = np.bincount(hit.step.astype(int), weights=hit.n, minlength=len(rules))
        rejected = np.cumsum(new).astype(int).tolist()[: len(rules)]
        taken = safe_cutoffs(rejected, int(good.n.sum()), alpha, delta / int(rows.n_strata.iloc[0]))
        out: dict[str, object] = {"stratum": rows.stratum.iloc[0]} | {r: None for r in RULES}
        for rule, cut in zip(rules[:taken], cuts[:taken]):
            out[list(RULES)[rule]] = cut
        return pd.DataFrame([out]).astype({r: float for r in RULES})

    ddl = "stratum string, " + ", ".join(f"{r} double" for r in RULES)
    return counted.groupBy("stratum").applyInPandas(choose, ddl)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: its counts, whether the base fails it, and whether base and rules keep it."""
    measures = _measures(stored(statistics(docs), "rule-statistics"))
    chosen = stored(cutoffs(measures, labels), "rule-cutoffs")
    chosen = chosen.select("stratum", F.struct(*RULES).alias("cutoff"))
    sizes = measures.groupBy("stratum").agg(F.count(F.lit(1)).alias("rows"))
    met = join_per_key(measures, sizes.join(chosen, "stratum", "left"), "stratum", "rows")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(F.col(rule) > F.col(f"cutoff.{rule}"), F.lit(False))
    return met.select("doc_id", *_COUNTS, "base_failed", (~F.col("base_failed") & ~rejected).alias("kept"))
