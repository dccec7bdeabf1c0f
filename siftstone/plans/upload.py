"""What an upload has to do, worked out from two listings before any client is called."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upload_plan(new: DataFrame, stored: DataFrame, poi: str = "poi", name: str = "name") -> DataFrame:
    """new (poi, name) with archive and upload.

    A group is archived first if its stored images (JSON files aside) are not as many as the new ones; its files are
    then all uploaded. Elsewhere a file is uploaded unless its name is stored. Listings are sets of names."""
    fresh = new.select(poi, name).distinct()
    old = stored.select(F.col(poi).alias("__p"), F.col(name).alias("__f")).distinct()
    n_new = fresh.groupBy(poi).agg(F.count(F.lit(1)).alias("__new"))
    n_old = old.filter(~F.col("__f").endswith(".json")).groupBy("__p").agg(F.count(F.lit(1)).alias("__old"))
    sizes = n_new.join(n_old, n_new[poi] == n_old["__p"], "left").select(F.col(poi).alias("__g"), F.coalesce(F.col("__old") != F.col("__new"), F.lit(False)).alias("archive"))
    out = fresh.join(sizes, F.col(poi) == F.col("__g")).join(old, (F.col(poi) == F.col("__p")) & (F.col(name) == F.col("__f")), "left")
    return out.select(poi, name, "archive", (F.col("archive") | F.col("__f").isNull()).alias("upload"))
