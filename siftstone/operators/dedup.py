"""Duplicates: first-seen, quotas across groups, and two order-dependent near-duplicate eliminations.

The greedy eliminations are folds over a group in its order: a dropped row never suppresses another, which no
join can express. A group holds one point of interest's candidates (hundreds by configuration).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.functions.scalars import dot, unit


def first_seen(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def head_of_group(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__rn") <= n).drop("__rn")


def _groups(df: DataFrame, poi: str, order: str, value: str) -> DataFrame:
    return df.groupBy(poi).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(value).alias("x")))).alias("rows"))


def quota_across_tabs(df: DataFrame, poi: str = "poi", tab: str = "category", url: str = "url", order: str = "ord", first_tab: str = "all", first_quota: int = 30, quota: int = 10, cap: int = 200) -> DataFrame:
    """poi, ord, url, tab of the accepted entries, in order: a URL is accepted once, up to its tab's quota and the
    cap. A URL seen earlier takes no quota; one cut off by a quota may be accepted from a later tab.

    Of a tab only each URL's first entry can be accepted, and only the first of these: as many as its quota and as were
    accepted elsewhere, at most the cap. So a group's array has that many entries a tab, however many it was given."""
    nameless = F.when(F.col(url).isNull(), F.col(order)).alias("__n")
    once = df.groupBy(poi, tab, url, nameless).agg(F.min(order).alias("__o")).select(poi, tab, url, F.col("__o").alias(order))
    df = head_of_group(once, [poi, tab], [F.col(order)], max(first_quota, quota) + cap)
    rows = df.groupBy(poi).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(url).alias("u"), F.col(tab).alias("t")))).alias("rows"))
    kind = f"array<struct<o:{dict(df.dtypes)[order]},u:string,t:string>>"

    def take(acc: Column, r: Column) -> Column:
        limit = F.when(F.lower(r["t"]) == first_tab, first_quota).otherwise(quota)
        full = (F.size(acc) >= cap) | (F.size(F.filter(acc, lambda a: a["t"] == r["t"])) >= limit)
        return F.when(full | F.exists(acc, lambda a: a["u"] == r["u"]), acc).otherwise(F.concat(acc, F.array(r)))

    kept = rows.select(poi, F.explode_outer(F.aggregate("rows", F.array().cast(kind), take)).alias("r"))
    return kept.select(poi, F.col("r.o").alias(order), F.col("r.u").alias(url), F.col("r.t").alias(tab))


def fold(rows: Column, kind: str, comparable, near) -> Column:
    """The rows (an array of type kind) that stay: those that can't be compared, and those near no earlier one that stays."""
    def step(acc: Column, r: Column) -> Column:
        return F.when(comparable(r) & F.exists(acc, lambda k: F.coalesce(near(k, r), F.lit(False))), acc).otherwise(F.concat(acc, F.array(r)))

    return F.aggregate(rows, F.array().cast(kind), step)


def _fold(rows: Column, kind: str, near) -> Column:
    return fold(rows, kind, lambda r: r["x"].isNotNull(), lambda k, r: near(k["x"], r["x"]))


def hash_dedup(df: DataFrame, poi: str = "poi", order: str = "ord", phash: str = "phash", distance: int = 8) -> DataFrame:
    """poi, ord of the rows kept: dropped is what is less than `distance` bits from a kept hash. Rows without a hash
    stay in their place and suppress nothing."""
    kinds = dict(df.dtypes)
    kept = _fold(F.col("rows"), f"array<struct<o:{kinds[order]},x:{kinds[phash]}>>", lambda a, b: F.bit_count(a.bitwiseXOR(b)) < distance)
    return _groups(df, poi, order, phash).select(poi, F.explode_outer(kept).alias("r")).select(poi, F.col("r.o").alias(order))


def embedding_dedup(df: DataFrame, poi: str = "poi", order: str = "ord", embedding: str = "embedding", similarity: float = 0.89) -> DataFrame:
    """poi, ord, pos: the rows kept and their new position: dropped is what has a cosine of `similarity` or more to a
    kept row. Rows without a vector stay, but move to the end."""
    kind = f"array<struct<o:{dict(df.dtypes)[order]},x:array<double>>>"
    normed = df.withColumn("__u", F.when(F.size(embedding) > 0, unit(F.col(embedding))))
    kept = _fold(F.col("rows"), kind, lambda a, b: dot(a, b) >= similarity)
    ordered = F.concat(F.filter(kept, lambda r: r["x"].isNotNull()), F.filter(kept, lambda r: r["x"].isNull()))
    return _groups(normed, poi, order, "__u").select(poi, F.posexplode_outer(ordered).alias("pos", "r")).select(poi, F.col("r.o").alias(order), "pos")


def embedding_dedup_blocks(df: DataFrame, poi: str = "poi", order: str = "ord", embedding: str = "embedding", similarity: float = 0.89) -> DataFrame:
    """As embedding_dedup, for groups of many thousands: the kept vectors form a matrix, one product a row."""
    kinds = dict(df.dtypes)

    def run(parts: Iterator[pd.DataFrame]) -> pd.DataFrame:
        pdf = pd.concat(list(parts)).sort_values("o", kind="stable")
        kept, last, m, n = [], [], None, 0
        for o, x in zip(pdf["o"], pdf["x"], strict=True):
            if x is None or not len(x):
                last.append(o)
                continue
            v = np.asarray(x, dtype=np.float64)
            v = v / np.sqrt((v * v).sum())
            if n and (m[:n] @ v).max() >= similarity:
                continue
            if m is None:
                m = np.empty((64, len(v)))
            elif n == len(m):
                m = np.concatenate([m, np.empty_like(m)])
            m[n] = v
            n += 1
            kept.append(o)
        out = kept + last
        return pd.DataFrame({"poi": pdf["poi"].iloc[0], "o": out, "pos": range(len(out))})

    src = df.select(F.col(poi).alias("poi"), F.col(order).alias("o"), F.col(embedding).alias("x"))
    got = src.groupBy("poi").applyInPandas(lambda pdf: run([pdf]), f"poi {kinds[poi]}, o {kinds[order]}, pos int")
    return got.select(F.col("poi").alias(poi), F.col("o").alias(order), "pos")


def two_pass_dedup(df: DataFrame, poi: str = "poi", order: str = "ord", phash: str = "phash", embedding: str = "embedding", distance: int = 8, similarity: float = 0.89, blocks: bool = False) -> DataFrame:
    """Hashes first, then vectors among what is left; poi, ord, pos."""
    left = hash_dedup(df, poi, order, phash, distance)
    return (embedding_dedup_blocks if blocks else embedding_dedup)(df.join(left, [poi, order], "left_semi"), poi, order, embedding, similarity)


def _logged(rows: Column, kind: str, order: str, comparable, score) -> Column:
    """For each row of an array: o, its best score against the rows that stay before it, which of these has it (the first of
    equal ones) and whether it stays, by `near` of the score; null without such a row."""
    log = f"struct<kept:{kind},log:array<struct<o:{order},best:double,matched:{order},kept:boolean>>>"
    value, near = score

    def step(acc: Column, r: Column) -> Column:
        scored = F.transform(F.filter(acc["kept"], lambda k: comparable(k)), lambda k, i: F.struct(value(k, r).alias("b"), (-i).alias("i"), k["o"].alias("o")))
        best = F.when(comparable(r), F.array_max(scored))
        stays = ~F.coalesce(near(best["b"]), F.lit(False))
        return F.struct(
            F.when(stays, F.concat(acc["kept"], F.array(r))).otherwise(acc["kept"]).alias("kept"),
            F.concat(acc["log"], F.array(F.struct(r["o"].alias("o"), best["b"].alias("best"), best["o"].alias("matched"), stays.alias("kept")))).alias("log"))

    none = F.struct(F.array().cast(kind).alias("kept"), F.array().cast(f"array<struct<o:{order},best:double,matched:{order},kept:boolean>>").alias("log")).cast(log)
    return F.aggregate(rows, none, step, lambda acc: acc["log"])


def hash_log(df: DataFrame, poi: str = "poi", order: str = "ord", phash: str = "phash", distance: int = 8) -> DataFrame:
    """poi, ord, nearest (bits to the nearest hash that stays before the row), matched (whose it is) and kept: hash_dedup()
    with its reasons. Rows without a hash are kept and have no nearest."""
    kinds = dict(df.dtypes)
    bits = lambda k, r: -F.bit_count(k["x"].bitwiseXOR(r["x"])).cast("double")
    log = _logged(F.col("rows"), f"array<struct<o:{kinds[order]},x:{kinds[phash]}>>", kinds[order], lambda r: r["x"].isNotNull(), (bits, lambda b: -b < distance))
    got = _groups(df, poi, order, phash).select(poi, F.explode_outer(log).alias("r"))
    return got.select(poi, F.col("r.o").alias(order), (-F.col("r.best")).cast("int").alias("nearest"), F.col("r.matched").alias("matched"), F.col("r.kept").alias("kept"))


def embedding_log(df: DataFrame, poi: str = "poi", order: str = "ord", embedding: str = "embedding", similarity: float = 0.89) -> DataFrame:
    """poi, ord, nearest (largest cosine to a row that stays before it), matched and kept: embedding_dedup() with its reasons."""
    kind = dict(df.dtypes)[order]
    normed = df.withColumn("__u", F.when(F.size(embedding) > 0, unit(F.col(embedding))))
    log = _logged(F.col("rows"), f"array<struct<o:{kind},x:array<double>>>", kind, lambda r: r["x"].isNotNull(), (lambda k, r: dot(k["x"], r["x"]), lambda b: b >= similarity))
    got = _groups(normed, poi, order, "__u").select(poi, F.explode_outer(log).alias("r"))
    return got.select(poi, F.col("r.o").alias(order), F.col("r.best").alias("nearest"), F.col("r.matched").alias("matched"), F.col("r.kept").alias("kept"))


_BASIS = np.cos(np.pi * (2 * np.arange(32)[None, :] + 1) * np.arange(8)[:, None] / 64)


def _signs(grey: np.ndarray) -> np.ndarray:
    """64-bit hashes of 32 x 32 images: signs of the 8 x 8 low band of their cosine transforms against its median."""
    low = np.einsum("uy,nyx,vx->nuv", _BASIS, grey, _BASIS, optimize=True).reshape(len(grey), 64)
    low = np.round(low, 6)  # what is 0 but for the order of summation, as in an image of one colour, is 0
    return np.packbits(low > np.median(low, axis=1, keepdims=True), axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def perceptual_hash(gray: Column) -> Column:
    """64-bit hash of a 32 x 32 grey image (array of 1,024 numbers); null for other lengths."""

    @F.pandas_udf("long")
    def run(images: pd.Series) -> pd.Series:
        fit = images.map(lambda x: x is not None and len(x) == 1024)
        out = pd.Series(pd.NA, index=images.index, dtype="Int64")
        if fit.any():
            out[fit] = _signs(np.stack(images[fit].to_list()).astype(np.float64).reshape(-1, 32, 32))
        return out

    return run(gray)


def _weights(size: int) -> np.ndarray:
    """32 x size: shares of the pixels of a line in each of 32 new ones, by a Lanczos window of three lobes that is as
    wide as the line is shrunk by."""
    scale = max(1.0, size / 32)
    middle = (np.arange(32) + 0.5) * size / 32
    first, last = np.maximum(0, np.floor(middle - 3 * scale + 0.5)), np.minimum(size, np.floor(middle + 3 * scale + 0.5))
    at = np.arange(size)[None, :]
    x = (at + 0.5 - middle[:, None]) / scale
    w = np.where((np.abs(x) < 3) & (at >= first[:, None]) & (at < last[:, None]), np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def grey_32(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """32 x 32 grey values of an image's bytes (rows of pixels; blue, green, red and what follows, or grey alone):
    luma, then both sides resampled, each a product with a matrix, in whole numbers from 0 to 255."""
    px = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels).astype(np.int64)
    grey = px[:, :, 0] if channels < 3 else (px[:, :, 2] * 19595 + px[:, :, 1] * 38470 + px[:, :, 0] * 7471 + 0x8000) >> 16
    whole = lambda m: np.clip(np.floor(m + 0.5), 0, 255)
    grey = grey.astype(np.float64)
    if width != 32:
        grey = whole(grey @ _weights(width).T)
    return grey if height == 32 else whole(_weights(height) @ grey)


def image_hash(image: Column) -> Column:
    """Perceptual hash of a decoded image, struct(height, width, nChannels, data) as Spark's image source gives it; null
    for nulls, images without a pixel and data that does not fit the sides."""

    @F.pandas_udf("long")
    def run(images: pd.DataFrame) -> pd.Series:
        out = pd.Series(pd.NA, index=images.index, dtype="Int64")
        grey, fit = [], []
        for k, (h, w, c, data) in zip(images.index, images[["height", "width", "nChannels", "data"]].itertuples(index=False), strict=True):
            if data is not None and h and w and c and len(data) == h * w * c:
                grey.append(grey_32(bytes(data), int(h), int(w), int(c)))
                fit.append(k)
        if fit:
            out[fit] = _signs(np.stack(grey))
        return out

    return run(image)
