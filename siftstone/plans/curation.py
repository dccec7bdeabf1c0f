"""The core plan: validity, score, two near-duplicate eliminations, the judge's reply, top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.config import Config
from siftstone.functions import judge
from siftstone.functions.scalars import dot, unit
from siftstone.operators import dedup, filters, neardup, ranking

JUDGED = 30
#: The plan's stages, in their order.
VALID, LATER = ("resolution", "aspect", "score"), ("hashes", "vectors", "judge", "top")


def _settled(replies: DataFrame) -> DataFrame:
    """poi, outcome, content: skipped if that is given (clients.judged), else by the content; one reply of a group."""
    o = judge.outcome(F.col("content"))
    if "outcome" in replies.columns:
        o = F.when(F.col("outcome") == judge.SKIPPED, judge.SKIPPED).otherwise(o)
    return replies.select("poi", F.struct(o.alias("outcome"), "content").alias("r")).groupBy("poi").agg(F.min("r").alias("r")).select("poi", "r.*")


def _passed(ranked: Column, seen: Column, outcome: Column, content: Column) -> Column:
    """Of a group's ranked rows those that the judge lets pass: all if it was skipped, none if it failed."""
    chosen = F.transform(judge.chosen(content, seen), lambda i: F.get(ranked, i))
    return F.when(outcome == judge.SKIPPED, ranked).when(outcome == judge.REPLIED, chosen).otherwise(F.slice(ranked, 1, 0))


def selected(candidates: DataFrame, replies: DataFrame | None = None, config: Config | None = None, least: float | None = None, similarity: float | None = None, distance: int | None = None) -> DataFrame:
    """poi, invalid (how many rows each of the three validity filters drops), sizes (rows that enter and that are left by
    each later stage) and top (ord of the rows chosen, in order): one row a group, by one shuffle.

    A group is an array: both eliminations, the order by score, the judge's reply and the choice are steps over it. What
    validity drops is counted where it is read and travels without its vector."""
    c = config or Config()
    bits, cosine = c.hash_distance if distance is None else distance, c.similarity if similarity is None else similarity
    tagged = filters.image_candidates(candidates, c.min_width, c.min_height, c.min_aspect, c.max_aspect, c.score_min if least is None else least)
    ok = F.col("stage_rejected").isNull()
    row = F.struct(F.col("ord").alias("o"), F.col("phash").alias("p"), F.when(F.size("embedding") > 0, unit(F.col("embedding"))).alias("u"), F.coalesce("score", F.lit(0.0)).alias("s"))
    rows = tagged.groupBy("poi").agg(*[F.count_if(F.col("stage_rejected") == s).alias(s) for s in VALID], F.array_sort(F.collect_list(F.when(ok, row))).alias("r0"))
    if replies is None:
        rows = rows.withColumns({"outcome": F.lit(judge.SKIPPED), "content": F.lit(None).cast("string")})
    else:
        rows = rows.join(_settled(replies).withColumnRenamed("poi", "of"), F.col("poi").eqNullSafe(F.col("of")), "left").drop("of")
    kind = dict(rows.dtypes)["r0"]
    rows = rows.withColumn("r1", dedup.fold(F.col("r0"), kind, lambda r: r["p"].isNotNull(), lambda k, r: F.bit_count(k["p"].bitwiseXOR(r["p"])) < bits))
    rows = rows.withColumn("r2", dedup.fold(F.col("r1"), kind, lambda r: r["u"].isNotNull(), lambda k, r: dot(k["u"], r["u"]) >= cosine))
    # those without a vector go to the end; then by score, equal ones by place
    moved = F.concat(F.filter("r2", lambda r: r["u"].isNotNull()), F.filter("r2", lambda r: r["u"].isNull()))
    rows = rows.withColumn("r3", F.array_sort(F.transform(moved, lambda r, i: F.struct((-r["s"]).alias("a"), i.alias("i"), r["o"].alias("o")))))
    rows = rows.withColumn("r4", _passed(F.col("r3"), F.least(F.size("r3"), F.lit(JUDGED)), F.col("outcome"), F.col("content")))
    best = F.slice(F.array_sort(F.transform("r4", lambda r, j: F.struct(r["a"].alias("a"), j.alias("j"), r["o"].alias("o")))), 1, c.target_max)
    rows = rows.withColumn("top", F.when(F.size("r4") <= c.target_max, F.transform("r4", lambda r: r["o"])).otherwise(F.transform(best, lambda r: r["o"])))
    sizes = F.array(*[F.size(x) for x in ("r0", "r1", "r2", "r4", "top")])
    return rows.select("poi", F.array(*VALID).alias("invalid"), sizes.alias("sizes"), "top")


def accounts(chosen: DataFrame) -> DataFrame:
    """poi, step, stage, before, rejected, remaining for each stage of the plan, from selected()."""
    left = F.col("sizes")[0]
    steps = []
    for k in reversed(range(len(VALID))):  # what enters a validity filter is what is left and what it and the later ones drop
        before = left + F.col("invalid")[k]
        steps.insert(0, F.struct(F.lit(k).alias("step"), F.lit(VALID[k]).alias("stage"), before.cast("long").alias("before"), left.cast("long").alias("remaining")))
        left = before
    for k, stage in enumerate(LATER):
        steps.append(F.struct(F.lit(len(VALID) + k).alias("step"), F.lit(stage).alias("stage"), F.col("sizes")[k].cast("long").alias("before"), F.col("sizes")[k + 1].cast("long").alias("remaining")))
    return chosen.select("poi", F.inline(F.array(*steps))).select("poi", "step", "stage", "before", (F.col("before") - F.col("remaining")).alias("rejected"), "remaining")


def curate(candidates: DataFrame, replies: DataFrame | None = None, config: Config | None = None, least: float | None = None, similarity: float | None = None, distance: int | None = None, blocks: bool = False) -> DataFrame:
    """candidates (poi, ord, width, height, phash, embedding, score) -> the rows chosen for each poi, with pos.

    What the eliminations leave is ordered by score. The judge sees the 30 best of a group; replies (poi, content, and
    outcome if they come from clients.judged) name them by that order. Without replies no judge is asked and all pass, as do
    groups whose call was skipped; a group whose call failed, whose reply is blank or that has none fails: it has no row.
    Of more than the wanted number the best by score are chosen. With blocks, groups may hold any number of rows:
    the eliminations then are tables (operators.neardup) instead of arrays."""
    if not blocks:
        # the outer form: for the other, Spark infers a filter on the array's size and computes the whole plan again for it
        top = selected(candidates, replies, config, least, similarity, distance).select("poi", F.posexplode_outer("top").alias("pos", "ord")).filter("pos is not null")
        own = top.select(F.col("poi").alias("__p"), F.col("ord").alias("__o"), "pos")
        return candidates.join(own, F.col("poi").eqNullSafe(F.col("__p")) & F.col("ord").eqNullSafe(F.col("__o"))).drop("__p", "__o")
    c = config or Config()
    ok = filters.image_candidates(candidates, c.min_width, c.min_height, c.min_aspect, c.max_aspect, c.score_min if least is None else least).filter("stage_rejected is null").drop("stage_rejected")
    kept = neardup.two_pass(ok, c.hash_distance if distance is None else distance, c.similarity if similarity is None else similarity)
    rows = ok.join(kept, ["poi", "ord"])
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("poi").orderBy(*ranking.by_score("score", "pos"))) - 1)
    if replies is not None:
        settled = _settled(replies)
        free = rows.join(settled.filter(F.col("outcome") == judge.SKIPPED).select("poi"), "poi", "left_semi")
        seen = rows.filter(F.col("pos") < JUDGED)
        said = seen.groupBy("poi").agg(F.count(F.lit(1)).cast("int").alias("n")).join(settled.filter(F.col("outcome") == judge.REPLIED), "poi")
        said = said.select("poi", F.posexplode(judge.chosen(F.col("content"), F.col("n"))).alias("__at", "pos"))
        rows = seen.join(said, ["poi", "pos"]).drop("pos").withColumnRenamed("__at", "pos").unionByName(free)
    return ranking.top_n(rows.withColumnRenamed("ord", "__first").withColumnRenamed("pos", "ord"), n=c.target_max).drop("ord").withColumnRenamed("__first", "ord")


def retry(first: DataFrame, more: DataFrame, least: int = 12) -> DataFrame:
    """Candidates of a second try: for groups below the gate (those without any row included), first and more
    together, more numbered after first; others as they were."""
    have = first.groupBy("poi").agg(F.count(F.lit(1)).alias("__n"), (F.max("ord") + 1).alias("__start"))
    extra = more.join(have, "poi", "left").filter(F.coalesce("__n", F.lit(0)) < least)
    extra = extra.withColumn("ord", F.col("ord") + F.coalesce("__start", F.lit(0))).drop("__n", "__start")
    return first.unionByName(extra, allowMissingColumns=True)
