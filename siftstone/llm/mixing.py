"""Mixing sources to target weights by entropy balancing.

Of all ways to re-weight documents so that each source takes its target number of tokens and no document counts
more than `cap` times, entropy balancing takes the one nearest to the corpus, in relative entropy over documents.
Its convex dual has one multiplier a source; at its optimum a document's rate is tilted exponentially by its own
tokens: rate = min(cap, exp(multiplier * size / mean size)). Newton steps solve the dual: each step is one
distributed aggregate over the documents' sizes (a row for each source and size, with its number of documents), for
all sources at once, and goes on until every source's tokens agree with its target.

Rates become whole copies by repeatable rounding: a document gets the whole part of its rate, and one copy more if
a hash of it falls below the fraction. What that misses of the target goes back as a shift of the threshold: documents
are ranked by hash minus fraction, and the prefix at whose end the source's target is met gets one copy more. The end of
that prefix is found digit by digit: sums over 4,096 buckets of the rank, then over 4,096 parts of the one bucket in
which the target falls, and so on until few rows are left, so no source is ever sorted or gathered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.llm.common import WORD, drop_table, fresh, materialize

WEIGHTS = (5, 2, 1)
#: Digits of the rank that one round of the search for a prefix's end looks at, and rows that it leaves to a sort.
DIGITS, FEW = 3, 20_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """totals (source, source_size) -> the same with target: sources by code point, null last, weigh weights in
    turn and share `share` times all words; no target is above cap times its source's words, the excess goes
    to the others by weight. The table has one row a source; its order is one sort of that table."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = totals.withColumn("w", w.cast("long")).withColumn("most", F.col("source_size") * F.lit(cap))
    by_ratio = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.lit(share) * F.sum("source_size").over(all_rows) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    t = t.withColumn("level", level).withColumn("pos", F.row_number().over(by_ratio))
    free = F.min(F.when(F.col("most") >= F.col("level") * F.col("w"), F.struct("pos", "level"))).over(all_rows)
    t = t.withColumn("free", free)
    return t.select("source", "source_size", F.least("most", F.coalesce(F.col("free.level") * F.col("w"), F.col("most"))).alias("target"))


def rate(size: Column, cap: float, of: str = "") -> Column:
    """A document's rate by the columns lam, scale and limit (of: what stands before their names); null lam stands for the
    limit at which all documents are at the cap (or, for target 0, at 0)."""
    tilted = F.least(F.exp(F.least(F.col(f"{of}lam") * size / F.col(f"{of}scale"), F.lit(50.0))), F.lit(float(cap)))
    return F.coalesce(F.round(tilted, 9), F.col(f"{of}limit"))


def solve(histogram: DataFrame, balance: DataFrame, cap: float = 2.0, steps: int = 60, near: float = 1e-9) -> DataFrame:
    """balance (source, source_size, target) with scale, lam and limit: the dual's optimum.

    histogram (source, size, n): n documents of that size. A Newton step goes by the logarithm of a source's tokens,
    in which the dual's gradient is nearly straight; where it would leave the bracket known to hold the optimum (in which
    capped documents flatten the gradient), the bracket is halved. Bracket at first: the multipliers at which the
    smallest documents alone would meet the target. Every step is one aggregate and one written table of a row a source."""
    pos = histogram.filter("size > 0")
    stats = pos.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("all"), F.sum("n").alias("docs"), F.min("size").alias("least")).withColumnRenamed("source", "s")
    state = balance.join(stats, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    state = state.withColumn("scale", F.coalesce(F.col("all") / F.col("docs"), F.lit(1.0)))
    ratio = F.col("target") / F.col("all")
    free = (F.col("target") > 0) & (ratio < cap)
    lowest = F.col("scale") / F.col("least")
    state = state.withColumns({
        "limit": F.when(F.col("target") > 0, F.lit(float(cap))).otherwise(0.0),
        "lo": F.when(free, F.least(F.log(ratio), F.lit(0.0)) * lowest),
        "hi": F.when(free, F.when(ratio > 1, F.lit(cap)).otherwise(F.lit(1.0)).cast("double")).cast("double"),
    }).withColumn("hi", F.when(F.col("hi") > 1, F.log(F.lit(cap)) * lowest).otherwise(F.col("hi") * 0.0))
    state = materialize(state.withColumn("lam", F.when(free, F.lit(0.0))), "dual")
    size, lam = F.col("size").cast("double"), F.col("lam")
    tilt = F.least(F.exp(F.least(lam * size / F.col("scale"), F.lit(50.0))), F.lit(float(cap)))
    for _ in range(steps):
        # tokens at the present multipliers and their slope
        of = state.filter("lam is not null").select(F.col("source").alias("s"), "lam", "scale")
        now = pos.join(of, F.col("source").eqNullSafe(F.col("s")))
        slope = F.when(tilt < cap, size * size / F.col("scale") * tilt).otherwise(0.0)
        sums = now.groupBy("s").agg(F.sum(F.col("n") * size * tilt).alias("f"), F.sum(F.col("n") * slope).alias("g"))
        new = state.join(sums, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        over = F.col("f") > F.col("target")
        new = new.withColumn("lo", F.when(over, F.col("lo")).otherwise(lam)).withColumn("hi", F.when(over, lam).otherwise(F.col("hi")))
        step = lam - F.log(F.col("f") / F.col("target")) * F.col("f") / F.col("g")
        inside = (F.col("g") > 0) & (step > F.col("lo")) & (step < F.col("hi"))
        off = F.abs(F.col("f") - F.col("target")) / F.col("target")
        done = (off <= near) | (F.col("hi") - F.col("lo") <= 1e-12)
        new = new.withColumn("off", F.when(lam.isNotNull() & ~done, off).otherwise(0.0))
        new = new.withColumn("lam", F.when(done, lam).when(inside, step).otherwise((F.col("lo") + F.col("hi")) / 2))
        new = materialize(new.select("source", "source_size", "target", "scale", "limit", "lo", "hi", "lam", "off"), "dual")
        drop_table(state)
        state = new
        if not state.filter("off > 0").limit(1).collect():
            break
    else:
        raise RuntimeError(f"the dual was not solved in {steps} steps")
    # rounded, so that another order of summation gives the same rates
    return state.select("source", "source_size", "target", "scale", "limit", F.round("lam", 7).alias("lam"))


def mark(doc_id: Column, text: Column) -> Column:
    """32 hex digits, the same in every run: a document's place in the random order."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.md5(F.concat(part(doc_id), F.lit("|"), F.md5(part(text).cast("binary"))).cast("binary"))


def fraction(mark: Column) -> Column:
    """The mark's first 12 digits as a number from 0 to 1."""
    return F.conv(F.substring(mark, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def rank(mark: Column, tie: Column, r: Column) -> Column:
    """60 hex digits by which documents are ranked: hash minus fraction of the rate, then the rest of the mark, then,
    of rows equal in id and text, their place in the table."""
    z = F.floor((fraction(mark) - (r - F.floor(r)) + 1) * F.lit(float(1 << 46))).cast("long")
    return F.concat(F.lpad(F.lower(F.hex(z)), 12, "0"), F.substring(mark, 1, 32), F.substring(F.md5(tie.cast("string").cast("binary")), 1, 16))


def sizes_of(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), mark(F.col(doc_id), F.col(text)).alias("mark"), F.monotonically_increasing_id().alias("tie"))


def ends(ranked: DataFrame, balance: DataFrame, cap: float = 2.0) -> DataFrame:
    """(s, last, one): for each source the rank up to which documents get one copy more; no row for nowhere.

    ranked: source, size, whole, rank. The prefix ends with the last document that still fits; `one` is the rank of
    the document after it whose size comes nearest to what is still missing."""
    base = ranked.groupBy("source").agg(F.sum(F.col("size") * F.col("whole")).alias("given")).withColumnRenamed("source", "s")
    want = balance.join(base, F.col("source").eqNullSafe(F.col("s")), "left")
    border = materialize(want.select(F.col("source").alias("s"), (F.col("target") - F.coalesce("given", F.lit(0))).alias("extra"), F.lit(0).cast("long").alias("before"), F.lit("").alias("prefix")).filter("extra > 0"), "border")
    ranked = ranked.filter(f"size > 0 and whole < {cap}").select("source", "size", "rank")  # the others take no more
    inside, digits = ranked, 0
    while True:
        digits += DIGITS
        bucket = F.substring("rank", 1, digits)
        cum = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"))
        cum = cum.join(border, F.col("source").eqNullSafe(F.col("s")))
        run = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        cum = cum.withColumn("upto", F.col("before") + F.sum("n").over(run))
        # the bucket in which the target falls; the last one, if rounding leaves it beyond all
        at = F.struct((F.col("upto") < F.col("extra")).alias("beyond"), F.when(F.col("upto") < F.col("extra"), -F.col("upto")).otherwise(F.col("upto")).alias("by"), "bucket", (F.col("upto") - F.col("n")).alias("before"), "rows")
        hit = cum.groupBy("s", "extra").agg(F.min(at).alias("at")).select("s", "extra", F.col("at.before").alias("before"), F.col("at.bucket").alias("prefix"), F.col("at.rows").alias("rows"))
        hit = materialize(hit, "border")
        drop_table(border)
        border = hit
        found = inside.join(border.select("s", "prefix"), F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("prefix"))).select("source", "size", "rank")
        if digits == DIGITS or digits % (4 * DIGITS) == 0:
            found = materialize(found, "inside")
        inside = found
        most = border.agg(F.max("rows")).first()[0] or 0
        if most <= FEW or digits >= 60:
            break
    order = Window.partitionBy("s").orderBy("rank")
    rest = inside.join(border, F.col("source").eqNullSafe(F.col("s"))).withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fits = rest.filter("upto <= extra").groupBy("s").agg(F.max("rank").alias("last"), F.max("upto").alias("upto"))
    fits = border.join(fits.withColumnRenamed("s", "fs"), F.col("s").eqNullSafe(F.col("fs")), "left")
    # no document of the border bucket fits: the prefix ends before that bucket
    fits = fits.select(F.col("s").alias("of"), F.coalesce("last", "prefix").alias("last"), (F.col("extra") - F.coalesce("upto", "before")).alias("miss"))
    fits = materialize(fits, "fits")
    after = ranked.join(fits, F.col("source").eqNullSafe(F.col("of"))).filter("rank > last and abs(miss - size) < miss")
    one = after.groupBy("source").agg(F.min(F.struct(F.abs(F.col("miss") - F.col("size")).alias("by"), "rank")).alias("one")).withColumnRenamed("source", "os")
    return fits.join(one, F.col("of").eqNullSafe(F.col("os")), "left").select(F.col("of").alias("s"), "last", F.col("one.rank").alias("one"))


def plan(sizes: DataFrame, cap: float = 2.0, **how) -> DataFrame:
    """sizes (doc_id, source, size, mark, tie) -> one row a source: s, source_size, target, scale, limit, lam, last, one."""
    if cap != int(cap) or cap < 1:
        raise ValueError("cap must be a whole number of copies")
    histogram = materialize(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    balance = materialize(targets(totals, cap=cap, **how), "targets")
    balance = solve(histogram, balance, cap)
    of = balance.select(F.col("source").alias("s"), "scale", "limit", "lam")
    ranked = sizes.join(of, F.col("source").eqNullSafe(F.col("s")))
    r = rate(F.col("size"), cap)
    # hashes of the ranks are computed once; the search for the prefix's end reads them several times
    ranked = materialize(ranked.select("source", "size", F.floor(r).alias("whole"), rank(F.col("mark"), F.col("tie"), r).alias("rank")), "ranked")
    last = ends(ranked, balance, cap)
    got = balance.join(last, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumnRenamed("source", "s")
    return materialize(got, "plan")


def _chosen(place: Column, last: Column, one: Column) -> Column:
    return (place <= last) | F.coalesce(place == one, F.lit(False))


def copies(size: Column, mark: Column, tie: Column, cap: float = 2.0, of: str = "") -> Column:
    """Copies of a document, from the columns of plan() beside it (of: what stands before their names)."""
    r = rate(size, cap, of)
    more = F.col(f"{of}last").isNotNull() & (size > 0) & _chosen(rank(mark, tie, r), F.col(f"{of}last"), F.col(f"{of}one"))
    return F.least(F.floor(r) + F.when(F.coalesce(more, F.lit(False)), 1).otherwise(0), F.lit(int(cap)))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cap: float = 2.0, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken: what the mix takes of each document, `cap` times its words at most.

    Null texts have size 0, the null source is a source of its own, repeated rows and null ids are documents of
    their own (of rows equal in id and text as many get a copy more as the target takes). Other columns are ignored; an
    empty table gives an empty one. Equal inputs give equal results, whatever the partitions."""
    sizes = materialize(sizes_of(docs, doc_id, text, source), "sizes")
    out = sizes.join(plan(sizes, cap, **how), F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("size"), F.col("mark"), F.col("tie"), cap)).alias("taken"))


def remix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cap: float = 2.0, **how) -> DataFrame:
    """docs with each row as often as the mix takes it (up to `cap` times; rows without a word once); columns as they are.

    docs is read twice and must give its rows in the same order, as a table does: that order tells equal rows
    apart. The plan has one row a source; whether it is broadcast is the planner's decision by its size. The texts
    themselves are not shuffled then. Nulls, repeated rows and empty tables as in mix()."""
    size, own, tie, times = fresh(docs, "size", "mark", "tie", "times")
    sizes = materialize(sizes_of(docs, doc_id, text, source), "sizes")
    p = plan(sizes, cap, **how)
    p = p.select(F.struct(*p.columns).alias("__plan"))
    rows = docs.select("*", n_words(F.col(f"`{text}`")).alias(size), mark(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias(own), F.monotonically_increasing_id().alias(tie))
    rows = rows.join(p, rows[f"`{source}`"].eqNullSafe(p["__plan"]["s"]))
    n = F.when(F.col(size) == 0, 1).otherwise(copies(F.col(size), F.col(own), F.col(tie), cap, "__plan."))
    rows = rows.withColumn(times, F.explode(F.array_repeat(F.lit(1), n.cast("int"))))
    return rows.select(*[f"`{c}`" for c in docs.columns])
