"""Reads of the pipeline's tables. Small sides are left to the planner, which knows their size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pending_images(layer: DataFrame, least: int | None = None) -> DataFrame:
    """Scraped enough, no image chosen, idle. A threshold of 0 or none is the default."""
    return layer.filter((F.col("scraped_count") >= (least or 12)) & (F.col("img_count") == 0) & (F.col("processing_status") == "idle"))


def pending_videos(layer: DataFrame, least: int | None = None) -> DataFrame:
    return layer.filter((F.col("img_count") >= (least or 12)) & (F.col("clip_count") == 0) & (F.col("processing_status") == "idle"))


def ready_batches(batches: DataFrame) -> DataFrame:
    return batches.filter(F.col("compilation_status") == "pending")


def lookup(df: DataFrame, key: str, value: Column | str, first: bool = False) -> DataFrame:
    out = df.filter(F.col(key) == value)
    return out.limit(1) if first else out


def videos_for_download(videos: DataFrame, batches: DataFrame, poi: str | None = None) -> DataFrame:
    """Drafts without a compressed URL, with their batch's name; of one name if given."""
    b = batches.select(F.col("id").alias("__bid"), "poi_name")
    if poi is not None:
        b = b.filter(F.col("poi_name") == poi)
    v = videos.filter((F.col("publishing_status") == "draft") & F.col("compressed_video_url").isNull())
    return v.join(b, v["poi_id"] == b["__bid"]).drop("__bid")


def cache_status(names: DataFrame, cache: DataFrame, now: Column, skip_days: int = 15) -> DataFrame:
    """names (poi_name) with cache_status: new (no record), skip (younger than skip_days), else rescrape."""
    from siftstone.functions.scalars import age_days

    c = cache.select(F.col("poi_name").alias("__n"), "first_synced_at", F.lit(True).alias("__hit"))
    out = names.join(c, names["poi_name"] == c["__n"], "left")
    status = F.when(F.col("__hit").isNull(), "new").when(age_days("first_synced_at", now) < skip_days, "skip").otherwise("rescrape")
    return out.select(*[names[x] for x in names.columns], status.alias("cache_status"))


def cached_attribute(names: DataFrame, cache: DataFrame, value: Column, alias: str) -> DataFrame:
    """names (poi_name) with what the cache knows of an attribute; `missing` marks those that a client is asked for.

    Empty answers count as unknown, and so does the word UNKNOWN."""
    from siftstone.functions.scalars import known

    c = cache.select(F.col("poi_name").alias("__n"), known(value).alias(alias))
    out = names.join(c, names["poi_name"] == c["__n"], "left").drop("__n")
    return out.withColumn("missing", F.col(alias).isNull())


def with_foreign_key(rows: DataFrame, layer: DataFrame) -> DataFrame:
    """rows (poi_name) with optimization_layer_id, null where the name is unknown."""
    k = layer.select(F.col("poi_name").alias("__n"), F.col("id").alias("optimization_layer_id"))
    return rows.join(k, rows["poi_name"] == k["__n"], "left").drop("__n")


def survivors(rows: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    return rows.join(kept.select(key).distinct(), key, "left_semi")


def not_stored(rows: DataFrame, stored: DataFrame, name: str) -> DataFrame:
    """Rows whose name is not in storage yet; equal names are enough, contents are not compared."""
    return rows.join(stored.select(name).distinct(), name, "left_anti")


def with_score(rows: DataFrame, scores: DataFrame, key: str, score: str = "score") -> DataFrame:
    return rows.join(scores.select(key, score), key, "left").withColumn(score, F.coalesce(score, F.lit(0.0)))


def exists(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """rows with found: whether other has a row with the same keys."""
    marks = other.select(*keys).distinct().withColumn("found", F.lit(True))
    return rows.join(marks, keys, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def failed_names(steps: DataFrame, run_id: str) -> DataFrame:
    return steps.filter((F.col("run_id") == run_id) & (F.col("status") == "failed")).select("poi_name").distinct()


def run_summary(results: DataFrame) -> DataFrame:
    """n_ok, n_failed and exit_code of (poi, ok)."""
    n = results.agg(F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_failed"))
    return n.withColumn("exit_code", F.when(F.col("n_failed") > 0, 1).otherwise(0))


def selection_stats(df: DataFrame, by: list[str], score: str = "score") -> DataFrame:
    return df.groupBy(*by).agg(F.max(score).alias("best"), F.min(score).alias("worst"), F.avg(score).alias("mean"), F.count(F.lit(1)).alias("n"))


def matching(df: DataFrame, equal: dict[str, object] | None = None, least: dict[str, object] | None = None, below: dict[str, object] | None = None, null: tuple[str, ...] = ()) -> DataFrame:
    """Rows by the store's comparisons: = equal, >= least, < below, IS NULL; a null fits the last alone. All reach the scan."""
    for compare, wanted in ((Column.__eq__, equal), (Column.__ge__, least), (Column.__lt__, below)):
        for name, value in (wanted or {}).items():
            df = df.filter(compare(F.col(name), F.lit(value)))
    for name in null:
        df = df.filter(F.col(name).isNull())
    return df


def first_row(df: DataFrame, order: str, **equal: object) -> DataFrame:
    """The first row, by order, of those that are equal to the given values; none if there is none."""
    return matching(df, equal).orderBy(F.col(order).asc_nulls_last()).limit(1)


def value_counts(df: DataFrame, by: list[str], column: str, values: tuple[str, ...]) -> DataFrame:
    """by, and n_value for each of values: how many rows of a group have it; 0 where none has."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])


def overlay_urls(videos: DataFrame, variations: DataFrame) -> DataFrame:
    """videos (id) with final_output_url of one of a video's variations, the smallest that is not null; null without one. The
    store gives any; the same one each time is what a rerun needs."""
    of = variations.groupBy(F.col("compiled_video_id").alias("__v")).agg(F.min("final_output_url").alias("final_output_url"))
    return videos.join(of, videos["id"] == of["__v"], "left").drop("__v")
