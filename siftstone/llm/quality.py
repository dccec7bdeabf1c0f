"""Quality rules with risk-controlled thresholds, in DataFrame functions alone.

Base rules are fixed. Beyond them, each statistic has a grid of cutoffs. A path through the grids leads from no cutoff
to the strictest ones, each step tightening one rule by one cutoff. It is chosen by documents that the tests do not use:
each step is the one that rejects most of the documents labelled bad for the unlabelled ones that it rejects.
In a stratum, a step is admitted if, of the labelled good documents there, so few exceed any of its cutoffs that the
exact binomial test refutes a false-rejection rate of `risk` for all rules together at level `delta / strata`. Steps
are nested, so testing them in order until one fails needs no division by their number, and none is left out by it.
The last admitted step is used. Then, with probability 1 - delta, no stratum loses more than `risk` of its good
documents; a stratum with too few labels to prove that (log(strata / delta) / risk about) has no cutoffs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import materialize

SPACE = r"[\x20\x09-\x0D]+"
#: Statistics (a document is rejected above the cutoff) and their grids.
RULES = {
    "symbols_per_char": ("n_symbols / greatest(word_chars, 1)", (0.02, 0.05, 0.1, 0.2, 0.3)),
    "dup_line_share": ("n_dup_lines / greatest(n_lines, 1)", (0.05, 0.1, 0.2, 0.3, 0.5)),
    "repeat_share": ("n_repeat_words / greatest(n_words, 1)", (0.05, 0.1, 0.15)),
    "mean_word": ("word_chars / greatest(n_words, 1)", (8.0, 10.0, 12.0, 15.0, 20.0)),
}


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of every whole text.

    Repeated windows are found by sorting the windows' hashes with their positions in the low bits, about n log n work
    for n words, and what these let pass is sorted by its words: counts are exact. Null texts count as empty."""
    t = docs.select(F.col(doc_id).alias("doc_id"), F.col(stratum).alias("stratum"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = t.select("doc_id", "stratum", F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), F.array_remove(F.split("t", SPACE), "").alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    t = t.select("doc_id", "stratum", "n_symbols", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.expr("if(size(w) < 5, array(), transform(sequence(1, size(w) - 4), i -> xxhash64(slice(w, i, 5))))").cast("array<bigint>").alias("h"), "w")
    t = t.withColumn("dup", F.size(F.array_distinct("h")) < F.size("h")).withColumn("bits", F.ceil(F.log2(F.size("h") + 1.0)).cast("int"))
    # hash in the high bits, position in the low ones; neighbours in order with equal hashes may be repeats
    t = t.withColumn("p", F.expr("case when dup then sort_array(transform(h, (x, i) -> shiftleft(x, bits) | i)) end")).drop("h")
    t = t.withColumn("q", F.expr("case when dup then filter(transform(p, (x, i) -> if((i > 0 and shiftright(x, bits) = shiftright(p[greatest(i - 1, 0)], bits)) or (i < size(p) - 1 and shiftright(x, bits) = shiftright(p[least(i + 1, size(p) - 1)], bits)), x & (shiftleft(1L, bits) - 1), -1L)), x -> x >= 0) end")).drop("p")
    # those whose words are equal are: windows in order, with their places
    t = t.withColumn("p", F.expr("case when dup then sort_array(transform(q, i -> struct(array_join(slice(w, cast(i as int) + 1, 5), ' ') as s, i as i))) end")).drop("q")
    t = t.withColumn("q", F.expr("case when dup then sort_array(transform(filter(transform(p, (x, i) -> if((i > 0 and x.s = p[greatest(i - 1, 0)].s) or (i < size(p) - 1 and x.s = p[least(i + 1, size(p) - 1)].s), x.i, -1L)), x -> x >= 0), x -> x)) end")).drop("p", "w")
    repeats = F.expr("case when size(q) > 1 then 5L + aggregate(transform(q, (x, i) -> if(i = 0, 0L, least(5L, x - q[greatest(i - 1, 0)]))), 0L, (a, x) -> a + x) else 0L end")
    # written, as what follows would else repeat the whole chain wherever it names a result
    return materialize(t.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(repeats, F.lit(0)).alias("n_repeat_words")), "measured")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def log_binomial_tail(n: Column, k: Column, p: float) -> Column:
    """log P(at most k of n at rate p), exactly; 0 where k is at or above the mean."""
    log_term = F.aggregate(F.sequence(F.lit(0), k.cast("int")), F.lit(0.0), lambda a, i: a + F.when(i == 0, 0.0).otherwise(F.log((n - i + 1) / i))) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))
    odds = (1 - p) / p
    total = F.aggregate(F.sequence(F.lit(0), k.cast("int")), zero, lambda a, i: F.struct((a["term"] * (k - i) / (n - k + i + 1) * F.lit(odds)).alias("term"), (a["sum"] + a["term"]).alias("sum")), lambda a: a["sum"])
    return F.when(k >= n * p, F.lit(0.0)).otherwise(log_term + F.log(total))


def level(name: str) -> Column:
    """How many of a rule's cutoffs a document exceeds: cutoff k rejects it if that is more than k."""
    stat, cuts = RULES[name]
    return F.expr(" + ".join(f"cast(coalesce({stat} > {c}, false) as int)" for c in cuts))


def path(cells: list[tuple[tuple[int, ...], int, int]]) -> list[tuple[int, ...]]:
    """The steps: the index of each rule's cutoff (the number of its cutoffs for none yet).

    cells: levels by rule, documents labelled bad, unlabelled documents. The next rule, and how far it is tightened, is
    what has the best ratio of newly rejected bad to newly rejected unlabelled documents; where nothing more rejects a
    bad one, the least tightened rule is next."""
    sizes = [len(cuts) for _, cuts in RULES.values()]
    now, steps, left = sizes.copy(), [], cells
    while any(now):
        found = []
        for r in range(len(sizes)):
            for k in range(now[r]):
                hit = [c for c in left if c[0][r] > k]
                found.append((sum(c[1] for c in hit) / (1 + sum(c[2] for c in hit)), now[r] / sizes[r], k, -r))
        _, _, k, r = max(found)
        left = [c for c in left if c[0][-r] <= k]
        while now[-r] > k:
            now[-r] -= 1
            steps.append(tuple(now))
    return steps


def cutoffs(measured: DataFrame, labels: DataFrame, risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """stratum and, for each rule, its cutoff in the last admitted step (null for none); labels: doc_id, good."""
    names = list(RULES)
    marks = labels.groupBy(F.col("doc_id").alias("lid")).agg(F.min("good").alias("good"))
    known = measured.filter(~base_failed()).join(marks, F.col("doc_id") == F.col("lid"), "left")
    cells = known.groupBy("stratum", *[level(n).alias(f"l_{n}") for n in names]).agg(*[F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(k) for k, c in {"good": F.col("good") == 1, "bad": F.col("good") != 1, "other": F.col("good").isNull()}.items()])
    cells = materialize(cells, "cells")
    pooled = cells.groupBy(*[f"l_{n}" for n in names]).agg(F.sum("bad").alias("bad"), F.sum("other").alias("other"))
    steps = path([(tuple(r[f"l_{n}"] for n in names), r["bad"], r["other"]) for r in sorted(pooled.collect())])  # at most the product of the grids' sizes
    exceeds = [" or ".join(f"l_{n} > {k}" for n, k in zip(names, step, strict=True)) for step in steps]
    counts = cells.groupBy("stratum").agg(F.sum("good").alias("n"), *[F.sum(F.expr(f"if({e}, good, 0)")).alias(f"k{i}") for i, e in enumerate(exceeds)]).filter("n > 0")
    counts = materialize(counts, "rejections")
    strata = max(1, counts.count())
    cut = lambda n, k: F.lit(RULES[n][1][k] if k < len(RULES[n][1]) else None).cast("double").alias(f"cut_{n}")
    tests = [F.struct(F.lit(i).alias("step"), F.col(f"k{i}").alias("k"), *[cut(n, k) for n, k in zip(names, step, strict=True)]) for i, step in enumerate(steps)]
    rows = counts.select("stratum", "n", F.explode(F.array(*tests)).alias("g")).select("stratum", "n", "g.*")
    admitted = rows.filter(log_binomial_tail(F.col("n"), F.col("k"), risk) <= math.log(delta / strata))
    last = admitted.groupBy("stratum").agg(F.max_by(F.struct(*[f"cut_{n}" for n in names]), "step").alias("g"))
    return last.select("stratum", "g.*")


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", label_id: str = "doc_id", label: str = "quality", risk: float = 0.01, delta: float = 0.05) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept for every document.

    labels (label_id, label 0 or 1): of ids labelled more than once the worst label counts. The null stratum is one
    of its own; a stratum without cutoffs keeps what passes the base rules. Repeated rows and null ids stay;
    empty tables give empty ones; other columns are ignored."""
    measured = measure(docs, doc_id, text, stratum)
    marks = labels.select(F.col(label_id).alias("doc_id"), F.col(label).alias("y")).filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.min("y").alias("good"))
    cuts = materialize(cutoffs(measured, marks, risk, delta).withColumnRenamed("stratum", "cut_stratum"), "cutoffs")
    out = measured.join(cuts, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    rejected = F.lit(False)
    for name, (stat, _) in RULES.items():
        rejected = rejected | F.coalesce(F.expr(stat) > F.col(f"cut_{name}"), F.lit(False))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed().alias("base_failed"), (~base_failed() & ~rejected).alias("kept"))
