"""Validity filters. Each is a condition and a filter by it; the error policy is in each docstring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.functions.scalars import bbox, dot

# Limits of text in images, as shares of area, width and height.
MIN_CONF, SIGN_AREA, MARK_AREA = 0.3, 0.08, 0.001
TOP, BOTTOM, LEFT, RIGHT = 0.15, 0.80, 0.10, 0.90
# Names of picture agencies.
AGENCIES = ("getty", "shutterstock", "alamy", "dreamstime", "istock", "adobe", "123rf")


def large_enough(w: Column, h: Column, min_w: int = 600, min_h: int = 600) -> Column:
    """False for unreadable images (null or negative sizes)."""
    return F.coalesce((w >= min_w) & (h >= min_h), F.lit(False))


def fair_aspect(w: Column, h: Column, low: float = 0.4, high: float = 2.5) -> Column:
    """low <= w/h <= high, both included; no height is ratio 0; false for nulls."""
    return F.coalesce(F.when(h > 0, w / F.nullif(h, F.lit(0))).otherwise(0.0).between(low, high), F.lit(False))


def head_score(v: Column, weights: list[float], bias: float) -> Column:
    """A linear head on the vector over its length; null for no vector or a zero one."""
    w = F.array(*map(F.lit, weights))
    return dot(v, w) / F.nullif(F.sqrt(dot(v, v)), F.lit(0.0)) + bias


def good_looking(score: Column, least: float = 6.0) -> Column:
    """A score that could not be computed counts as the least, so the image stays."""
    return F.coalesce(score, F.lit(least)) >= least


def has_overlay_text(dets: Column, w: Column, h: Column) -> Column:
    """Whether detections (bbox, text, conf) show an agency's name, text in a margin or much text.

    No detections, no size and nulls: false, the image stays."""
    area = F.nullif((w * h).cast("double"), F.lit(0.0))
    seen = F.filter(dets, lambda d: d["conf"] >= MIN_CONF)
    size = lambda b: (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])
    named = F.exists(seen, lambda d: F.exists(F.array(*map(F.lit, AGENCIES)), lambda k: F.lower(d["text"]).contains(k)))

    def in_margin(d: Column) -> Column:
        b = bbox(d["bbox"])
        x, y = (b["x0"] + b["x1"]) / 2 / F.nullif(w, F.lit(0)), (b["y0"] + b["y1"]) / 2 / F.nullif(h, F.lit(0))
        return ((y > BOTTOM) | (y < TOP) | (x < LEFT) | (x > RIGHT)) & (size(b) / area >= MARK_AREA)

    total = F.aggregate(seen, F.lit(0.0), lambda a, d: a + size(bbox(d["bbox"])))
    return F.coalesce(named, F.lit(False)) | F.coalesce(F.exists(seen, in_margin), F.lit(False)) | F.coalesce(total / area > SIGN_AREA, F.lit(False))


def valid_payload(content_type: Column, n_bytes: Column, least: int = 5000) -> Column:
    return F.coalesce((content_type.contains("image") | content_type.contains("octet-stream")) & (n_bytes >= least), F.lit(False))


def scraped_recently(count: Column, updated_at: Column, now: Column, least: int = 12, days: int = 15, force: bool = False) -> Column:
    """Enough images, taken after now - days; unknown states don't skip."""
    if force:
        return F.lit(False)
    return F.coalesce((count >= least) & (updated_at > now - F.make_dt_interval(F.lit(days))), F.lit(False))


def image_candidates(df: DataFrame, min_w: int = 600, min_h: int = 600, low: float = 0.4, high: float = 2.5, least: float = 6.0) -> DataFrame:
    """Candidates with stage_rejected: the first filter that drops the row (null: none), in one lazy pass."""
    w, h = F.col("width"), F.col("height")
    stage = F.when(~large_enough(w, h, min_w, min_h), "resolution").when(~fair_aspect(w, h, low, high), "aspect").when(~good_looking(F.col("score"), least), "score")
    return df.withColumn("stage_rejected", stage)


def stage_counts(tagged: DataFrame, stages: list[str], by: list[str]) -> DataFrame:
    """by, stage, before, rejected, remaining: one row for each group and stage, from one aggregate."""
    counts = tagged.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("stage_rejected") == s).alias(f"r_{s}") for s in stages])
    gone = F.lit(0)
    rows = []
    for k, s in enumerate(stages):
        rows.append(F.struct(F.lit(k).alias("step"), F.lit(s).alias("stage"), (F.col("n") - gone).alias("before"), F.col(f"r_{s}").alias("rejected"), (F.col("n") - gone - F.col(f"r_{s}")).alias("remaining")))
        gone = gone + F.col(f"r_{s}")
    return counts.select(*by, F.explode(F.array(*rows)).alias("s")).select(*by, "s.*")


def quality_gate(counts: DataFrame, n: str = "n", least: int = 12, tried: bool = False) -> DataFrame:
    """counts with gate: fail at 0, then retry (fail on the second try) below least, else pass."""
    return counts.withColumn("gate", F.when(F.col(n) == 0, "fail").when(F.col(n) < least, "fail" if tried else "retry").otherwise("pass"))
