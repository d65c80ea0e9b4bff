"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, shuffled by a hash of its id, gets a virtual finish time: the words of
its source up to and including it, divided by the source's target. All documents of all sources in
order of finish time interleave the sources in proportion to their targets; the order is cut where
the budget is used up. A source whose target exceeds its size is queued again (another epoch).

Defined cases: a null text has no words; a null source is a source of its own, last in order; rows
alike in doc_id, source and size stand one behind the other, and where the budget ends among them, as
many are in as have room, those of the smallest hash of the text; documents without words are in the mix
once at most and count nothing; an empty table gives an empty mix. Other columns are carried, whatever
their names.

The sources themselves are put in order by one task: there must be no more of them than it can sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut_lineage, joined, n_words, offsets, ranged, running

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
SEED = "mix-1"

_KEY = ["source", "doc_id", "size"]
_SHUFFLED = ["source", "shuffle", "doc_id", "size"]
_BY_FINISH = ["finish", "source", "epoch", "shuffle", "doc_id", "size"]


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per (source, doc_id, size) with the number of rows alike and the shuffle key."""
    rows = docs.select("source", "doc_id", n_words(F.col("text")).alias("size"))
    shuffle = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return (
        rows.groupBy(*_KEY)
        .agg(F.count(F.lit(1)).alias("alike"))
        .withColumn("shuffle", shuffle)
        .withColumn("words", F.col("size") * F.col("alike"))
    )


def targets(
    items: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """Per source: size, target and the total budget. A row per source, so one task orders them.

    Sources in code point order, null last, weigh ``weights``, repeating. They share ``share`` times
    all words; no target exceeds ``most`` times its source, and the excess is shared again by weight.
    The sources that reach their limit are those of the smallest limit per weight: with sources in
    that order, ``level`` is the budget per weight once all before have taken their limit.
    """
    everything = Window.partitionBy()
    named = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(named) - 1) % len(weights) + 1).cast("int"),
    )
    sums = items.groupBy("source").agg(F.sum("words").alias("source_size"))
    limits = (
        sums.withColumn("weight", weight)
        .withColumn("budget", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn("limit", F.lit(most) * F.col("source_size"))
    )
    fills = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = fills.rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum("limit").over(earlier), F.lit(0))
    weighed = F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    level = (F.col("budget") - taken) / (F.sum("weight").over(everything) - weighed)
    at_limit = F.col("level") * F.col("weight") > F.col("limit")
    last = F.max(F.when(~F.col("at_limit"), F.col("level"))).over(everything)
    target = F.when(F.col("at_limit"), F.col("limit")).otherwise(last * F.col("weight"))
    return (
        limits.withColumn("level", level)
        .withColumn("at_limit", at_limit)
        .select("source", "source_size", target.cast("double").alias("target"), "budget")
    )


def schedule(items: DataFrame, shares: DataFrame, most: int = MOST) -> DataFrame:
    """Every item and epoch with its finish time and how many of its copies the mix takes.

    Both orders are range sorts of narrow rows whose running sums are put together from one
    subtotal per partition (and source), so a source with a third of all rows is spread like any.
    """
    cut = ranged(items, *_SHUFFLED)
    per_part = joined(offsets(cut, "words", ["source"]), shares, ["source"])
    inside = cut.withColumn("inside", running("words", _SHUFFLED, ["source"]))
    queued = joined(inside, per_part, ["part", "source"]).select(
        *_SHUFFLED,
        *["alike", "words", "source_size", "target", "budget"],
        (F.col("inside") + F.col("before")).alias("upto"),
    )
    passed = F.col("epoch") * F.col("source_size") + F.col("upto")
    finish = F.when(F.col("target") > 0, passed / F.col("target")).otherwise(F.lit(0.0))
    epochs = F.when(F.col("size") > 0, F.sequence(F.lit(0), F.lit(most - 1))).otherwise(F.array(F.lit(0)))
    entries = queued.withColumn("epoch", F.explode(epochs)).withColumn("finish", finish)
    cut = ranged(entries, *_BY_FINISH)
    per_part = offsets(cut, "words")
    placed = cut.withColumn("inside", running("words", _BY_FINISH)).join(per_part, "part")
    placed = placed.withColumn("place", F.col("inside") + F.col("before"))
    room = F.floor((F.col("budget") - (F.col("place") - F.col("words"))) / F.col("size"))
    fitting = F.greatest(F.lit(0), F.least(F.col("alike"), room))
    copies = F.when(F.col("size") > 0, fitting).when(F.col("place") <= F.col("budget"), F.col("alike")).otherwise(0)
    return placed.select(
        *_KEY, "alike", "source_size", "target", "epoch", "finish", "place", copies.cast("bigint").alias("copies")
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: int = MOST,
        placed: bool = False) -> DataFrame:
    """The mixed documents: each as often as it is taken, with its columns; ``placed`` adds ``place``,
    the words of the mix up to and including the document, by which a training run reads it."""
    items = cut_lineage(sized(docs))
    taken = schedule(items, targets(items, weights, share, most), most).filter("copies > 0")
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), "source", "doc_id", n_words(F.col("text")).alias("size")
    )
    columns = ["doc.*", *(["place"] if placed else [])]
    whole = joined(rows, taken.filter("copies = alike"), _KEY).select(*columns)
    # The budget ends within one entry at most.
    last = taken.filter("copies < alike").select(*_KEY, "place", "copies").collect()
    if not last:
        return whole
    some = rows.withColumn("text_hash", F.md5(F.coalesce(F.col("doc.text"), F.lit(""))))
    some = some.filter(_is(last[0])).select("doc", "text_hash", F.lit(1).alias("one"))
    cut = ranged(some, "text_hash")
    number = F.col("inside") + F.col("before")
    numbered = cut.withColumn("inside", running("one", ["text_hash"])).join(offsets(cut, "one"), "part")
    part = numbered.filter(number <= last[0].copies).withColumn("place", F.lit(last[0].place)).select(*columns)
    return whole.unionByName(part)


def _is(row: Row) -> Column:
    """Whether a row has the key of ``row``."""
    found = F.lit(True)
    for c in _KEY:
        found = found & F.col(c).eqNullSafe(F.lit(row[c]))
    return found


def taken_words(docs: DataFrame) -> DataFrame:
    """Per document, how many of its words the mix takes, repeats counted."""
    items = cut_lineage(sized(docs))
    entries = schedule(items, targets(items))
    per_item = entries.groupBy(*_KEY, "alike", "source_size", "target").agg(F.collect_list("copies").alias("epochs"))
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("alike")))
    times = F.size(F.filter("epochs", lambda n: n >= F.col("each")))
    return per_item.withColumn("each", each).select(
        "doc_id", "size", "source_size", "target", (times * F.col("size")).cast("bigint").alias("taken"), "source"
    )
