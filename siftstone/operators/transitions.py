"""Changes to the pipeline's tables, as pure functions: table in, table out, with `changed` marking affected rows.

A plain table has no atomic compare-and-set: one writer at a time is assumed, or a table format beneath.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def update(df: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """Rows where the condition holds take the values; null conditions change nothing."""
    hit = F.coalesce(where, F.lit(False))
    return df.select(*[F.when(hit, values[c].cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in df.columns], hit.alias("changed"))


def n_changed(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("changed").alias("n_changed"))


def insert(df: DataFrame, rows: DataFrame) -> DataFrame:
    return df.unionByName(rows, allowMissingColumns=True).select(*df.columns)


def required(df: DataFrame, where: Column, what: str) -> None:
    """Raises where no row meets the condition: one job that ends at the first that does."""
    if df.filter(where).limit(1).isEmpty():
        raise ValueError(f"{what}: no matching record")


def create(df: DataFrame, rows: DataFrame, what: str) -> DataFrame:
    """As insert; raises where there is nothing to insert."""
    required(rows, F.lit(True), f"create {what}")
    return insert(df, rows)


def update_one(df: DataFrame, key: str, value: str, values: dict[str, Column], what: str) -> DataFrame:
    """As update of the rows whose key has the value; raises where none has."""
    where = F.col(key) == value
    required(df, where, f"update {what} {value!r}")
    return update(df, where, values)


def update_poi(layer: DataFrame, name: str, values: dict[str, Column], now: Column) -> DataFrame:
    """As update, stamping updated_at; raises where no row has the name."""
    return update_one(layer, "poi_name", name, values | {"updated_at": now}, "POI")


def create_videos(videos: DataFrame, poi_id: str, rows: DataFrame) -> DataFrame:
    """rows added under the batch poi_id; raises where there are none."""
    return create(videos, rows.withColumn("poi_id", F.lit(poi_id)), f"video of batch {poi_id!r}")


def update_video(videos: DataFrame, video_id: str, values: dict[str, Column]) -> DataFrame:
    return update_one(videos, "id", video_id, values, "video")


def create_overlays(variations: DataFrame, videos: DataFrame, rows: DataFrame) -> DataFrame:
    """variations with rows (compiled_video_id, overlay_text, final_output_url) added as completed; each row's video must be
    among videos (id), as the store's foreign key wants it."""
    strays = rows.join(videos.select(F.col("id").alias("__id")), F.col("compiled_video_id") == F.col("__id"), "left_anti")
    required(strays.select(F.lit(1).alias("n")).groupBy().agg(F.count("n").alias("n")), F.col("n") == 0, "a video for each overlay")
    return insert(variations, rows.select("compiled_video_id", "overlay_text", "final_output_url", F.lit("completed").alias("status")))


def claim(layer: DataFrame, name: str, now: Column) -> DataFrame:
    return update(layer, (F.col("poi_name") == name) & (F.col("processing_status") == "idle"), {"processing_status": F.lit("processing"), "updated_at": now})


def release(layer: DataFrame, name: str, now: Column, status: str = "idle") -> DataFrame:
    return update_poi(layer, name, {"processing_status": F.lit(status)}, now)


def reset_stale_pois(layer: DataFrame, now: Column, minutes: int = 120) -> DataFrame:
    """processing since before the cutoff becomes idle; updated_at stays."""
    return update(layer, (F.col("processing_status") == "processing") & (F.col("updated_at") < now - F.make_dt_interval(mins=F.lit(minutes))), {"processing_status": F.lit("idle")})


def reset_stale_runs(runs: DataFrame, now: Column, minutes: int = 120) -> DataFrame:
    """For runs and for their steps."""
    return update(runs, (F.col("status") == "running") & (F.col("started_at") < now - F.make_dt_interval(mins=F.lit(minutes))), {"status": F.lit("stale"), "completed_at": now})


def get_or_create_batches(batches: DataFrame, wanted: DataFrame, layer: DataFrame) -> DataFrame:
    """wanted (id, poi_name, ...) that batches lack by name are added with their foreign key, the rest stays."""
    from siftstone.operators.tables import with_foreign_key

    new = wanted.join(batches.select("poi_name").distinct(), "poi_name", "left_anti")
    return insert(batches, with_foreign_key(new, layer))


def finish_run(runs: DataFrame, run_id: str, status: str, now: Column, summary: Column | None = None, error: Column | None = None) -> DataFrame:
    """completed or failed; summary and error are changed only where given."""
    values = {"status": F.lit(status), "completed_at": now}
    if summary is not None:
        values["summary"] = F.coalesce(summary, F.col("summary"))
    if error is not None:
        values["error_message"] = F.coalesce(error, F.col("error_message"))
    return update(runs, F.col("run_id") == run_id, values)


def finish_step(steps: DataFrame, run_id: str, poi: str, stage: str, status: str, now: Column, duration: Column | None = None, metrics: Column | None = None, error: Column | None = None) -> DataFrame:
    values = {"status": F.lit(status), "completed_at": now}
    for name, v in (("duration_s", duration), ("metrics", metrics), ("error_message", error)):
        if v is not None:
            values[name] = F.coalesce(v, F.col(name))
    return update(steps, (F.col("run_id") == run_id) & (F.col("poi_name") == poi) & (F.col("stage") == stage), values)


def new_runs(rows: DataFrame, now: Column) -> DataFrame:
    """(run_id, poi_names, from_stage, triggered_by [, config, parent_run_id]) as running runs with poi_count."""
    return rows.withColumns({"poi_count": F.size("poi_names"), "status": F.lit("running"), "started_at": now})


def upsert(df: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """rows replace what they give (nulls keep the old value) where the key exists, and are added elsewhere."""
    old, new = df.alias("o"), rows.alias("n")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    pick = lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")) if c in rows.columns else F.col(f"o.{c}")
    return joined.select(*[pick(c).alias(c) for c in df.columns])


def registered(rows: DataFrame) -> DataFrame:
    """poi_name, registered: whether anything was uploaded; a scrape without images changes no table."""
    return rows.select("poi_name", F.coalesce(F.col("scraped_count") > 0, F.lit(False)).alias("registered"))


def register_scrape(layer: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """rows (poi_name, scraped_pics, scraped_count): created or updated, idle, stamped; those without images are not."""
    done = rows.filter("scraped_count > 0")
    return upsert(layer, done.withColumns({"processing_status": F.lit("idle"), "updated_at": now}), "poi_name")
