"""A plan as a list of named stages, and what each of them dropped, observed in the pass that computes the result."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from siftstone.config import Config
from siftstone.operators import dedup, filters, ranking

Stage = tuple[str, Callable[[DataFrame], DataFrame]]


def _count(seen: Observation) -> int:
    try:
        return seen.get.get("n", 0)
    except Py4JJavaError:  # that part of the plan did not run
        return 0


class Watched:
    """df after all stages, and, once an action on it has run, how many rows entered and left each."""

    def __init__(self, df: DataFrame, stages: list[Stage]):
        names = [n for n, _ in stages]
        if len(set(names)) != len(names):
            raise ValueError("two stages have one name")
        self.names, self.seen = names, [Observation() for _ in range(len(stages) + 1)]
        self.df = df.observe(self.seen[0], F.count(F.lit(1)).alias("n"))
        for (_, stage), seen in zip(stages, self.seen[1:], strict=True):
            self.df = stage(self.df).observe(seen, F.count(F.lit(1)).alias("n"))

    def counts(self) -> list[tuple[str, int, int, int]]:
        """stage, before, rejected, remaining. Waits for the first action on df; a part of the plan that Spark did not have
        to run, as nothing reached it, counts as empty."""
        n = [_count(s) for s in self.seen]
        return [(name, a, a - b, b) for name, a, b in zip(self.names, n, n[1:], strict=False)]


def image_stages(config: Config | None = None, more: list[Stage] | None = None) -> list[Stage]:
    """The plan's stages over candidates (poi, ord, width, height, phash, embedding, score), each a step of its own; `more`
    (the judge's, say) stand before the choice. plans.curation does the same in one step."""
    c = config or Config()
    w, h = F.col("width"), F.col("height")

    def choose(df: DataFrame) -> DataFrame:
        return ranking.top_n(df, n=c.target_max)

    return [
        ("resolution", lambda df: df.filter(filters.large_enough(w, h, c.min_width, c.min_height))),
        ("aspect", lambda df: df.filter(filters.fair_aspect(w, h, c.min_aspect, c.max_aspect))),
        ("score", lambda df: df.filter(filters.good_looking(F.col("score"), c.score_min))),
        ("hashes", lambda df: df.join(dedup.hash_dedup(df, distance=c.hash_distance), ["poi", "ord"], "left_semi")),
        ("vectors", lambda df: df.join(dedup.embedding_dedup(df, similarity=c.similarity).select("poi", "ord"), ["poi", "ord"], "left_semi")),
        *(more or []),
        ("top", choose),
    ]
