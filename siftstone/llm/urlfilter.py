"""URL filters: host and path rules, and gradient-boosted trees on lexical features where no rule fits.

Rules are a table of one row a host: pages are joined with it once for each number of labels that a rule's host has, so
that lists of any length work, and whether that table is broadcast is the planner's decision by its size.
The trees are fitted on a bounded sample of labelled URLs and become one SQL expression. Features: length, depth, digit
ratio, entropy, parameter count, host labels and the smoothed share of blocked URLs of the host's suffix (over all
labelled URLs; for those that the trees are fitted on, over the hosts of other folds only). A third of the hosts fitted on
have their suffix hidden, as if no labelled URL had it: so the trees learn what a URL says where its suffix says nothing, and
a URL of an unseen suffix gets about the share of all, more or less by its own features.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import fresh, materialize

FEATURES = ("length", "depth", "digit_ratio", "entropy", "n_params", "n_labels", "suffix_rate")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and where there is no `://`."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """rows (host, path and others) with rule and ruled: text and verdict of the longest rule that fits (ties: the first
    in code-point order); null for none. A rule fits its host and all subdomains, if the path starts with the rule's."""
    rank, path, at, hits = fresh(rows, "rank", "rule_path", "rule_host", "hits")
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    kind = "array<struct<n:int,text:string,path:string,verdict:string>>"
    found = []
    for depth in sorted({h.count(".") + 1 for h in by_host}):
        of = {h: rs for h, rs in by_host.items() if h.count(".") + 1 == depth}
        table = rows.sparkSession.createDataFrame([(h, [(-len(r.text), r.text, r.path, r.verdict) for r in rs]) for h, rs in sorted(of.items())], f"`{at}` string, `{rank}{depth}` {kind}")
        rows = rows.join(table, F.substring_index("host", ".", -depth) == F.col(at), "left").drop(at)
        found.append(F.coalesce(F.filter(f"{rank}{depth}", lambda r: F.startswith(F.col("path"), r["path"])), F.array().cast(kind)))
    if not found:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "ruled": F.lit(None).cast("string")})
    rows = rows.withColumn(hits, F.array_min(F.concat(*found)))
    rows = rows.withColumns({"rule": F.col(hits)["text"], "ruled": F.col(hits)["verdict"]})
    return rows.drop(hits, *[c for c in rows.columns if c.startswith(rank)])


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that need no other URL."""
    u = F.coalesce(url, F.lit(""))
    n = F.length(u)
    chars = F.split(u, "")
    entropy = F.aggregate(F.transform(F.array_distinct(F.array_remove(chars, "")), lambda c: (n - F.length(F.replace(u, c))) / n), F.lit(0.0), lambda a, p: a - p * F.log2(p))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    return {
        "length": n.cast("double"),
        "depth": F.size(F.array_remove(F.split(path, "/"), "")).cast("double"),
        "digit_ratio": F.regexp_count(u, F.lit("[0-9]")) / F.greatest(n, F.lit(1)),
        "entropy": F.when(n > 0, entropy).otherwise(0.0),
        "n_params": F.size(F.array_remove(F.split(query, "&"), "")).cast("double"),
        "n_labels": F.size(F.array_remove(F.split(host, r"\."), "")).cast("double"),
    }


class Tree(NamedTuple):
    """A leaf has feature -1."""

    feature: int
    cut: float
    value: float
    left: Tree | None = None
    right: Tree | None = None


def boost(x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 3, rate: float = 0.2, bins: int = 16, l2: float = 1.0) -> tuple[float, list[Tree]]:
    """Gradient boosting with logistic loss on quantile bins; (start score, trees). Deterministic."""
    if not len(y):
        return 0.0, []
    p = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(p / (1 - p)))
    if y.min() == y.max():
        return start, []
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    score = np.full(len(y), start)
    out = []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int) -> Tree:
        sg, sh = g[rows].sum(), h[rows].sum()
        best = (1e-6, -1, 0)
        if level < depth:
            for f, c in enumerate(cuts):
                bg = np.bincount(code[rows, f], g[rows], len(c) + 1).cumsum()[:-1]
                bh = np.bincount(code[rows, f], h[rows], len(c) + 1).cumsum()[:-1]
                gain = bg**2 / (bh + l2) + (sg - bg) ** 2 / (sh - bh + l2) - sg**2 / (sh + l2)
                if len(gain) and gain.max() > best[0]:
                    best = (float(gain.max()), f, int(gain.argmax()))
        if best[1] < 0:
            return Tree(-1, 0.0, float(-sg / (sh + l2)) * rate)
        f, b = best[1:]
        low = code[rows, f] <= b
        return Tree(f, float(cuts[f][b]), 0.0, grow(rows[low], g, h, level + 1), grow(rows[~low], g, h, level + 1))

    def value(t: Tree, rows: np.ndarray) -> np.ndarray:
        if t.feature < 0:
            return np.full(len(rows), t.value)
        low = x[rows, t.feature] <= t.cut
        v = np.empty(len(rows))
        v[low], v[~low] = value(t.left, rows[low]), value(t.right, rows[~low])
        return v

    everyone = np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        out.append(grow(everyone, p - y, p * (1 - p), 0))
        score = score + value(out[-1], everyone)
    return start, out


def expression(start: float, trees: list[Tree]) -> Column:
    """P(block) as a column expression over the features."""

    def of(t: Tree) -> Column:
        if t.feature < 0:
            return F.lit(t.value)
        return F.when(F.col(FEATURES[t.feature]) <= t.cut, of(t.left)).otherwise(of(t.right))

    total = F.lit(start)
    for t in trees:
        total = total + of(t)
    return 1 / (1 + F.exp(-total))


#: Parts of the labelled hosts: a URL's suffix statistics for fitting come from the other parts; one host in HIDDEN has none.
FOLDS, HIDDEN = 5, 3


def hashed(host: str, what: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.col(host), F.lit(what)), F.lit(n))


def described(rows: DataFrame) -> DataFrame:
    """rows (u, host, path and others) with the features that need no other URL, and suffix."""
    return rows.withColumns(lexical(F.col("u"), F.col("host"), F.col("path"))).withColumn("suffix", F.element_at(F.split("host", r"\."), -1))


def suffix_rates(known: DataFrame, strength: float = 10.0) -> tuple[DataFrame, float]:
    """(s, fold, suffix_rate) and the prior: the smoothed share of blocked URLs of each suffix. Fold -1: over all of known
    (suffix, fold, y); another: over the rest."""
    counts = materialize(known.groupBy("suffix", "fold").agg(F.sum("y").alias("b"), F.count(F.lit(1)).alias("n")), "suffixes")
    total = counts.agg(F.sum("b"), F.sum("n")).first()
    prior = ((total[0] or 0) + 1.0) / ((total[1] or 0) + 2.0)
    every = counts.groupBy(F.col("suffix").alias("s")).agg(F.sum("b").alias("all_b"), F.sum("n").alias("all_n"))
    rest = counts.join(every, F.col("suffix") == F.col("s")).select("s", "fold", (F.col("all_b") - F.col("b")).alias("b"), (F.col("all_n") - F.col("n")).alias("n"))
    both = rest.unionByName(every.select("s", F.lit(-1).cast("long").alias("fold"), F.col("all_b").alias("b"), F.col("all_n").alias("n")))
    return materialize(both.select("s", "fold", ((F.col("b") + strength * F.lit(prior)) / (F.col("n") + strength)).alias("suffix_rate")), "rates"), prior


class Model(NamedTuple):
    """rates: suffix_rates() of all labelled URLs, a row for each suffix and fold."""

    start: float
    trees: list[Tree]
    rates: DataFrame
    prior: float


def fit(known: DataFrame, sample: int = 20_000) -> Model:
    """known: described() rows with y (1: blocked). About `sample` of them are fitted on, chosen by a hash."""
    known = known.withColumn("fold", hashed("host", "fold", FOLDS))
    rates, prior = suffix_rates(known)
    part = min(1.0, sample / max(1, known.count()))
    mark = F.xxhash64("u", F.lit("fit"))
    some = known.filter(F.pmod(mark, F.lit(1_000_000)) < part * 1_000_000).orderBy(mark).limit(2 * sample)
    own = rates.withColumnRenamed("fold", "of")
    some = some.join(own, (F.col("suffix") == F.col("s")) & (F.col("fold") == F.col("of")), "left")
    seen = F.when(hashed("host", "hide", HIDDEN) > 0, F.col("suffix_rate"))
    got = some.withColumn("suffix_rate", F.coalesce(seen, F.lit(prior))).groupBy(*FEATURES, "y").count().orderBy(*FEATURES, "y").collect()
    n = np.array([r["count"] for r in got], dtype=int)
    x = np.repeat(np.array([[r[f] for f in FEATURES] for r in got], dtype=float).reshape(-1, len(FEATURES)), n, axis=0)
    y = np.repeat(np.array([r["y"] for r in got], dtype=float), n)
    return Model(*boost(x, y), rates, prior)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """described() rows with block_score: the trees' P(block)."""
    out = rows.join(model.rates.filter("fold = -1").select("s", "suffix_rate"), F.col("suffix") == F.col("s"), "left").drop("s")
    return out.withColumn("suffix_rate", F.coalesce("suffix_rate", F.lit(model.prior))).withColumn("block_score", expression(model.start, model.trees))


def split_urls(rows: DataFrame) -> DataFrame:
    """rows (u) with host and path."""
    host, path = parts(F.col("u"))
    return rows.withColumn("host", host).withColumn("path", path)


def judge(pages: DataFrame, rules: list[Rule], labelled: DataFrame | None = None, page_id: str = "page_id", url: str = "url", sample: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score for every row.

    labelled (url, blocked 0 or 1) trains the trees; by default the URLs that a rule fits, labelled by it. About
    `sample` of them are fitted on, chosen by a hash. A URL that no rule fits is blocked if its score is above `threshold` and
    above the share of blocked URLs among the labelled ones: where its features say nothing it is not. Without labels the
    score is 0.5 and the verdict allow. Null and odd URLs have empty parts and are judged like any other; repeated rows
    stay; an empty table gives an empty one; other columns are ignored."""
    rows = with_rules(split_urls(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("u"))), rules)
    rows = materialize(described(rows), "urls")
    if labelled is None:
        known = rows.filter("ruled is not null").withColumn("y", (F.col("ruled") == "block").cast("int"))
    else:
        known = described(split_urls(labelled.select(F.col("url").alias("u"), F.col("blocked").cast("int").alias("y")).filter("y in (0, 1)")))
    model = fit(known, sample)
    verdict = F.coalesce("ruled", F.when(F.col("block_score") > max(threshold, model.prior), "block").otherwise("allow"))
    return scored(rows, model).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "block_score")
