"""URL entries out of pages and snapshots, and their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.functions.scalars import full_size_url, is_junk, is_skipped_domain, unescape_url
from siftstone.operators.dedup import first_seen, head_of_group

# A photograph's URL in script text.
SCRIPT_URL = r"""(https://[^\s'"\\]{20,500}\.(?:jpg|jpeg|png|webp)[^\s'"\\]*)"""
# The source attribute of an image element.
IMG_SRC = r"""<img\b[^>]*?\b(?:data-)?src\s*=\s*["']([^"']*)["']"""


def script_urls(pages: DataFrame, poi: str, html: str, cap: int = 50) -> DataFrame:
    """poi, ord, url, source: image URLs of script text, first-seen, unescaped, without junk, up to cap."""
    found = pages.select(F.col(poi).alias("poi"), F.posexplode(F.regexp_extract_all(F.col(html), F.lit(SCRIPT_URL), F.lit(1))).alias("ord", "url"))
    found = first_seen(found, ["poi", "url"], "ord").withColumn("url", unescape_url("url"))
    found = found.filter(~is_skipped_domain("url") & ~is_junk("url"))
    return head_of_group(found, ["poi"], [F.col("ord")], cap).withColumn("source", F.lit("google_images"))


def page_images(pages: DataFrame, poi: str, subpage: str, html: str, pattern: str = IMG_SRC, least: int = 30, cap: int = 50) -> DataFrame:
    """poi, ord, url, source, subpage: image elements of stored pages in order; empty, inline, short and junk ones
    are skipped, the rest is first-seen and at full size, up to cap."""
    found = pages.select(F.col(poi).alias("poi"), F.col(subpage).alias("subpage"), F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))).alias("at", "url"))
    found = found.filter((F.length("url") >= least) & ~F.col("url").startswith("data:") & ~is_junk("url"))
    found = found.withColumn("ord", F.row_number().over(Window.partitionBy("poi").orderBy("subpage", "at")) - 1).withColumn("url", full_size_url("url"))
    found = first_seen(found, ["poi", "url"], "ord")
    return head_of_group(found, ["poi"], [F.col("ord")], cap).select("poi", "ord", "url", F.lit("official_site").alias("source"), "subpage")


def panel_url(src: Column, width: Column) -> Column:
    """A panel image's URL without its size; null for avatars, tiny images and short URLs."""
    bare = F.regexp_replace(src, "=.*$", "")
    ok = src.contains("googleusercontent") & ~src.contains("/a/") & ~src.contains("/a-/") & (width >= 30) & (F.length(bare) > 50)
    return F.when(ok, bare)


def union_sources(parts: list[DataFrame]) -> DataFrame:
    """Entries of several sources in the order given, with source_rank; missing columns are null."""
    ranked = [p.withColumn("source_rank", F.lit(k)) for k, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def merge_entries(parts: list[DataFrame]) -> DataFrame:
    """The union with each URL of a group once, where it comes first, and ord counted anew."""
    every = union_sources(parts).withColumn("__o", F.struct("source_rank", "ord"))
    once = first_seen(every, ["poi", "url"], "__o")
    return once.withColumn("ord", F.row_number().over(Window.partitionBy("poi").orderBy("__o")) - 1).drop("__o")


def manifest(entries: DataFrame, extracted_at: Column, sources: tuple[str, ...] = ("google_kp", "google_images", "official_site")) -> DataFrame:
    """One row a group: poi_name, extracted_at, source_counts (zeros included), total, urls in order."""
    names = [c for c in ("url", "source", "category", "subpage") if c in entries.columns]
    counts = F.map_from_arrays(F.array(*map(F.lit, sources)), F.array(*[F.count_if(F.col("source") == s) for s in sources]))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.struct(*names).alias("e")))), lambda x: x["e"])
    return entries.groupBy(F.col("poi").alias("poi_name")).agg(counts.alias("source_counts"), F.count(F.lit(1)).alias("total"), rows.alias("urls")).withColumn("extracted_at", extracted_at)


def _line(snapshot: DataFrame, text: str) -> DataFrame:
    return snapshot.select("*", F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))


def label_of_ref(refs: DataFrame, snapshots: DataFrame, poi: str = "poi", ref: str = "ref", text: str = "snapshot") -> DataFrame:
    """refs (poi, ref) with label: the quoted text of the first line that holds [ref=N], else subpage_N."""
    lines = _line(snapshots.select(F.col(poi).alias("p"), F.col(text).alias("s")), "s")
    lines = lines.withColumn("r", F.regexp_extract("line", r"\[ref=([0-9]+)\]", 1)).filter("r <> ''")
    first = lines.groupBy("p", "r").agg(F.min_by(F.regexp_extract("line", '"([^"]*)"', 1), "line_no").alias("label"))
    label = F.trim(F.substring_index(F.regexp_replace("label", r"\.+$", ""), "|", 1))
    out = refs.join(first, (refs[poi] == first["p"]) & (refs[ref].cast("string") == first["r"]), "left")
    return out.select(*[refs[c] for c in refs.columns], F.coalesce(F.nullif(label, F.lit("")), F.concat(F.lit("subpage_"), refs[ref].cast("string"))).alias("label"))


# How a page's snapshot writes the button to its photos, a reference, a tab of a collection and a priced link.
PHOTOS = r'(?:button|link).*"[^"]*[Pp]hotos[^"]*".*\[ref=\d+\]'
REF = r"\[ref=(\d+)\]"
TAB = r'"Change collection to (.+?)" \[ref=(\d+)\]'
PRICED = r'link\s+"([^"]+?)\s*\$\d+'


def photos_button(snapshot: Column) -> Column:
    """The ref of the first button or link to photos, or null."""
    hit = F.filter(F.split(snapshot, "\n"), lambda x: x.rlike(PHOTOS))
    return F.nullif(F.regexp_extract(F.get(hit, F.lit(0)), REF, 1), F.lit(""))


def tab_refs(snapshot: Column) -> Column:
    """map of tab name to ref: a name's place is its first one, its ref the last one."""
    hits = F.filter(F.transform(F.split(snapshot, "\n"), lambda x: F.struct(F.regexp_extract(x, TAB, 1).alias("k"), F.regexp_extract(x, TAB, 2).alias("v"))), lambda s: s["v"] != "")
    names = F.array_distinct(F.transform(hits, lambda s: s["k"]))
    return F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(F.filter(hits, lambda s: s["k"] == k), -1)["v"]))


def pack_names(snapshot: Column) -> Column:
    """Names before a price in links, in order."""
    names = F.transform(F.split(snapshot, "\n"), lambda x: F.trim(F.regexp_extract(x, PRICED, 1)))
    return F.array_remove(names, "")


def best_name(names: Column, wanted: Column) -> Column:
    """The name with most words of the wanted one; the first on ties and where none has any."""
    from siftstone.functions.scalars import words_in_common

    scored = F.transform(names, lambda n, i: F.struct((-words_in_common(n, wanted)).alias("s"), i.alias("i"), n.alias("n")))
    return F.when(F.size(names) > 0, F.array_min(scored)["n"])
