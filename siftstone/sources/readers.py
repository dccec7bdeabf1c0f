"""Files: manifests, image folders, and tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone import schemas
from siftstone.functions.headers import image_size

# Extensions of images on resume and among candidates.
RESUME = ("jpg", "jpeg", "png", "webp")
CANDIDATE = ("jpg", "jpeg", "png", "webp", "bmp")


def read_manifest(spark: SparkSession, path: str, most: int | None = None, lines: bool = False) -> DataFrame:
    """poi, ord, url, source, category, subpage of the first `most` entries of each manifest: a file each, or, with lines, a
    line each, as write_manifest() leaves them."""
    m = spark.read.schema(schemas.MANIFEST).option("multiLine", not lines).json(path)
    rows = m.select(F.col("poi_name").alias("poi"), F.posexplode("urls").alias("ord", "e")).select("poi", "ord", "e.*")
    return rows if most is None else rows.filter(F.col("ord") < most)


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("overwrite").json(path)


def image_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = CANDIDATE, more_than: int = -1, content: bool = False) -> DataFrame:
    """path, length [, content] of image files, by path; resumed folders want more than 1,000 bytes."""
    files = spark.read.format("binaryFile").load(path)
    ext = F.lower(F.substring_index("path", ".", -1))
    out = files.filter(ext.isin(*extensions) & (F.col("length") > more_than))
    return out.select("path", "length", *(["content"] if content else [])).orderBy("path")


def image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """path, width, height by the files' headers (PNG, GIF, BMP, JPEG, WebP); files that are none of these have -1; empty files
    have no row."""
    files = spark.read.format("binaryFile").load(path).select("path", image_size(F.col("content")).alias("s"))
    return files.select("path", "s.width", "s.height")


def image_pixels(spark: SparkSession, path: str) -> DataFrame:
    """path, image (height, width, nChannels, data) of the files that can be decoded; WebP is none of them."""
    files = spark.read.format("image").option("dropInvalid", True).load(path)
    return files.select(F.col("image.origin").alias("path"), F.struct("image.height", "image.width", "image.nChannels", "image.data").alias("image"))


def listing(files: DataFrame, path: str = "path") -> DataFrame:
    """dir, name of stored objects; those without a name are dropped."""
    from siftstone.functions.scalars import split_path

    return files.select(split_path(path).alias("p")).filter("p is not null and p.name <> ''").select("p.dir", "p.name")


def sidecar(rows: DataFrame, poi: str, key: str, value: str) -> DataFrame:
    """poi, metadata: one JSON object a group."""
    return rows.groupBy(poi).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))).alias("metadata"))


def fetch(df: DataFrame, client: Callable[[pd.DataFrame], pd.DataFrame], schema: str, at_once: int = 4) -> DataFrame:
    """Rows through a client (search engine, download, model, store) in Arrow batches, at most at_once tasks together.

    The client is given; none is part of this library, as all need a network."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield client(pdf)

    return df.repartition(at_once).mapInPandas(run, schema)


def with_retries(client: Callable[[pd.DataFrame], pd.DataFrame], tries: int = 3, wait: Callable[[int], None] = lambda k: None, on_failure: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The client tried again on errors; afterwards on_failure's rows, or the error."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        for k in range(tries):
            try:
                return client(pdf)
            except Exception:
                if k + 1 == tries and on_failure is None:
                    raise
                wait(k)
        return on_failure(pdf)

    return run
