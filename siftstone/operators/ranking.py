"""Order, top-N, versions and numbering. Ties always go by the row's ordinal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_score(score: str, order: str) -> list[Column]:
    return [F.coalesce(F.col(score), F.lit(0.0)).desc(), F.col(order).asc()]


def top_n(df: DataFrame, poi: str = "poi", order: str = "ord", score: str = "score", n: int = 15) -> DataFrame:
    """df's rows of each group with pos from 0: all in their order if there are n or fewer, else the n best."""
    g = Window.partitionBy(poi)
    ranked = df.withColumn("__n", F.count(F.lit(1)).over(g)).withColumn("__best", F.row_number().over(g.orderBy(*by_score(score, order)))).withColumn("__in", F.row_number().over(g.orderBy(order)))
    pos = F.when(F.col("__n") <= n, F.col("__in")).otherwise(F.col("__best"))
    return ranked.withColumn("pos", pos - 1).filter(F.col("pos") < n).drop("__n", "__best", "__in")


def latest(df: DataFrame, at: str, key: str, n: int) -> DataFrame:
    """The n latest rows, those without a time first, as the store sorts them."""
    return df.orderBy(F.desc_nulls_first(at), F.asc(key)).limit(n)


def next_version(names: DataFrame, used: DataFrame, done: DataFrame) -> DataFrame:
    """names (name) -> name, next: the name itself unless it is in done (name), else `name vK` with the least K of 2
    or more that is in neither used (name) nor done."""
    taken = used.select("name").unionByName(done.select("name")).distinct()
    k = F.regexp_extract("name", r"^(.*) v([0-9]{1,9})$", 2)
    base = F.regexp_extract("name", r"^(.*) v([0-9]{1,9})$", 1)
    versions = taken.select(base.alias("b"), F.try_to_number(k, F.lit("999999999")).cast("int").alias("k")).filter("k >= 2").distinct()
    held = versions.groupBy("b").agg(F.sort_array(F.collect_set("k")).alias("ks"))
    rows = names.join(held, names["name"] == held["b"], "left").join(done.select(F.col("name").alias("d")).distinct(), names["name"] == F.col("d"), "left")
    # in sorted order, the first place i where the version is not i + 2 is free
    gap = F.filter(F.transform("ks", lambda x, i: F.when(x != i + 2, i + 2)), lambda x: x.isNotNull())
    free = F.when(F.col("ks").isNull(), 2).when(F.size(gap) > 0, F.get(gap, F.lit(0))).otherwise(F.size("ks") + 2)
    return rows.select("name", F.when(F.col("d").isNull(), F.col("name")).otherwise(F.concat("name", F.lit(" v"), free.cast("string"))).alias("next"))


def number_files(df: DataFrame, poi: str = "poi", order: str = "ord", start: str | None = None) -> DataFrame:
    """df with candidate_id: candidate_%04d, counted from each group's start (0)."""
    n = F.row_number().over(Window.partitionBy(poi).orderBy(order)) - 1 + (F.col(start) if start else F.lit(0))
    return df.withColumn("candidate_id", F.format_string("candidate_%04d", n))
