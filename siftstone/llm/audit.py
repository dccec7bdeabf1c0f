"""Filter interaction audit: how much each of five filters removes, in every order in which they may be applied.

The words of each distinct text are exploded and aggregated by (text, word) and then by text, for totals and distinct
words; the flags that need no words are outer-joined, and one aggregate counts the documents of each part by the set of
filters they fail: 32 conditional-count columns (and as many for good and for toxic documents). All orders are
arithmetic on those columns. A text stands for all documents that hold it, so copies are counted, not exploded again.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import materialize

FILTERS = "ABCDE"
_SETS = 1 << len(FILTERS)
_SPACE = r"[\x20\x09-\x0D]+"


def text_flags(text: Column) -> tuple[Column, Column]:
    """Filters C (capitals) and D (symbols) of a text, which is not null."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return 100 * capitals > 10 * F.length(text), text.rlike("[#$%&*|]")


def word_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """key, words, distinct for each key with a word. Rows of one key must hold one text each."""
    words = texts.select(key, F.explode(F.split(F.col(text), _SPACE)).alias("word")).filter("word <> ''")
    return words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("n")).groupBy(key).agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("distinct"))


def failing_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, and for each set of filters (a bit each, A the lowest) the documents that fail exactly these: n_0 to n_31,
    of them with labels quality = 1 (good_0 to good_31) and toxic = 1 (toxic_0 to toxic_31).

    Null texts are empty, a null lang is the part ''. Rows are documents: repeated rows count each, and are not each
    other's smaller copy, as their ids are equal. A null doc_id has no label and is neither smaller nor larger than others.
    Several labels of one id count as one with the larger values. Other columns are ignored; empty tables give no row."""
    text = F.coalesce(docs["text"], F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    capitals, symbols = text_flags(text)
    rows = docs.select(docs["doc_id"], F.coalesce(docs["lang"], F.lit("")).alias("part"), digest.alias("digest"), capitals.alias("c"), symbols.alias("d"))
    # equal rows are one from here on, so no id or text is hot but for its number of different partners
    rows = materialize(rows.groupBy("digest", "part", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.first("c").alias("c"), F.first("d").alias("d")), "audit")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.coalesce(labels["quality"] == 1, F.lit(False))).alias("good"), F.max(F.coalesce(labels["toxic"] == 1, F.lit(False))).alias("toxic"))
    none = F.lit(False)
    marked = rows.filter("doc_id is not null").join(known, "doc_id", "left").withColumns({"good": F.coalesce("good", none), "toxic": F.coalesce("toxic", none)})
    marked = marked.unionByName(rows.filter("doc_id is null").withColumns({"good": none, "toxic": none}))
    # documents of a text by part and label; those that hold the cell's smallest id, and those without an id, may be no copies
    cells = marked.groupBy("digest", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"), F.first("c").alias("c"), F.first("d").alias("d"))
    cells = materialize(cells, "audit")
    firsts = cells.groupBy("digest").agg(F.min("least").alias("first"))
    # one text a digest: partial aggregation leaves one copy a task before the shuffle, which also serves the words' groups
    once = docs.select(digest.alias("digest"), text.alias("text")).groupBy("digest").agg(F.first("text").alias("text"))
    counts = word_counts(once, "digest", "text")
    flags = cells.join(firsts, "digest").join(counts, "digest", "left")
    words, distinct = F.coalesce("words", F.lit(0)), F.coalesce("distinct", F.lit(0))
    bits = [words < 100, 100 * distinct < 80 * words, F.col("c"), F.col("d")]
    failed = sum((F.when(b, 1 << i).otherwise(0) for i, b in enumerate(bits)), F.lit(0))
    own = F.col("nameless") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    both = flags.select("part", "good", "toxic", F.explode(F.array(F.struct(failed.alias("set"), own.alias("n")), F.struct((failed + 16).alias("set"), (F.col("n") - own).alias("n")))).alias("x"))
    count = lambda kind, s, more: F.expr(f"sum(CASE WHEN x.set = {s} AND {more} THEN x.n ELSE 0 END) AS {kind}_{s}")
    return both.groupBy("part").agg(*[count(kind, s, more) for kind, more in (("n", "true"), ("good", "good"), ("toxic", "toxic")) for s in range(_SETS)])


def orders(counts: DataFrame) -> DataFrame:
    """part, filter_order, step and the counts after each step of all orders, from failing_sets(); all long."""
    counts = materialize(counts, "audit")  # some rows; the sums below read them many times
    bit_of = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = ", ".join(f"struct('{''.join(o)}', {k + 1}, {bit_of[o[k]]}, {sum(map(bit_of.get, o[:k]))})" for o in permutations(FILTERS) for k in range(len(FILTERS)))
    packed = counts.selectExpr("part", *[f"array({', '.join(f'struct({s} AS set, {kind}_{s} AS n)' for s in range(_SETS))}) AS {kind}" for kind in ("n", "good", "toxic")])
    each = packed.selectExpr("*", f"inline(array({steps})) AS (filter_order, step, bit, before)")
    bit, before = F.col("bit"), F.col("before")

    def total(kind: str, when) -> Column:
        return F.aggregate(kind, F.lit(0).cast("long"), lambda acc, x: acc + F.when(when(x["set"]), x["n"]).otherwise(0))

    fails = lambda s: s.bitwiseAND(bit) != 0
    passed = lambda s: s.bitwiseAND(before) == 0
    share = F.aggregate("n", F.lit(0).cast("long"), lambda acc, x: acc + F.when(fails(x["set"]), (F.lit(120) / F.bit_count(x["set"])).cast("long") * x["n"]).otherwise(0))
    return each.select(
        "part", "filter_order", "step",
        total("n", lambda s: passed(s) & ~fails(s)).alias("kept"),
        total("n", lambda s: passed(s) & fails(s)).alias("removed"),
        total("n", lambda s: ~passed(s) & fails(s)).alias("redundant"),
        total("n", lambda s: s == bit).alias("unique_fails"),
        total("good", lambda s: passed(s) & fails(s)).alias("good_lost"),
        total("toxic", lambda s: passed(s) & fails(s)).alias("toxic_lost"),
        share.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Five filters over docs (doc_id, text, lang), in all 120 orders; see failing_sets() for odd rows. shapley: what
    the step's filter removes, summed over all orders: a document that fails k filters is removed by each in 120 / k."""
    return orders(failing_sets(docs, labels))
