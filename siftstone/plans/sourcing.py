"""From queries to numbered files: several sources together, one failing alone, and downloads of what they found."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftstone.functions.scalars import guess_extension
from siftstone.operators import ranking, urls
from siftstone.operators.dedup import first_seen, quota_across_tabs
from siftstone.sources.readers import fetch

Client = Callable[[pd.DataFrame], pd.DataFrame]


def search_all(queries: DataFrame, sources: dict[str, Client], at_once: int = 4) -> DataFrame:
    """poi, ord, url, source: what the sources (name: client of sources.clients.search) find for queries (poi, ord, query),
    sources in the order given, then queries in theirs; a URL that several give counts where it comes first. at_once: tasks of
    all sources together, one of each at least."""
    own = max(1, at_once // max(1, len(sources)))
    schema = f"poi {dict(queries.dtypes)['poi']}, ord {dict(queries.dtypes)['ord']}, query string, source string, url string, nth int"
    parts = [fetch(queries.select("poi", "ord", "query"), client, schema, own).withColumn("rank", F.lit(k)) for k, client in enumerate(sources.values())]
    every = reduce(DataFrame.unionByName, parts).withColumn("at", F.struct("rank", "ord", "nth"))
    once = first_seen(every, ["poi", "url"], "at")
    numbered = ranking.number_files(once, order="at").withColumn("ord", F.regexp_extract("candidate_id", "[0-9]+", 0).cast("int"))
    return numbered.select("poi", "ord", "url", "source")


def site_images(sites: DataFrame, client: Client, cap: int = 50, at_once: int = 4) -> DataFrame:
    """poi, ord, url, source, subpage of the images on the pages that a client of sources.clients.crawl opens for sites
    (poi, url), in the order of the pages, each once, up to cap."""
    pages = fetch(sites.select("poi", "url"), client, f"poi {dict(sites.dtypes)['poi']}, nth int, subpage string, html string", at_once)
    keyed = pages.withColumn("subpage", F.concat_ws(" ", F.format_string("%04d", "nth"), "subpage"))
    found = urls.page_images(keyed, "poi", "subpage", "html", cap=cap)
    return found.withColumn("subpage", F.substring("subpage", 6, 1 << 20))


def panel_images(images: DataFrame, first_quota: int = 30, quota: int = 10, cap: int = 200) -> DataFrame:
    """poi, ord, url, category of a panel's images (poi, ord, category, src, width), tab by tab in their order: at full
    size, without avatars and tiny ones, each once, by the tabs' quotas."""
    found = images.withColumn("url", F.concat(urls.panel_url(F.col("src"), F.col("width")), F.lit("=s0"))).filter("url is not null")
    return quota_across_tabs(found.select("poi", "ord", "category", "url"), first_quota=first_quota, quota=quota, cap=cap)


def download_all(entries: DataFrame, client: Client, start: str | None = None, most: int | None = None, at_once: int = 4) -> DataFrame:
    """poi, ord, url, name, content of the entries (poi, ord, url[, start]) that could be downloaded, the first `most` of
    each group tried. Files are numbered from start before they are tried, so a failure leaves a gap."""
    rows = entries if most is None else entries.filter(F.col("ord") < most)
    named = ranking.number_files(rows, start=start).select("poi", "ord", "url", F.concat("candidate_id", guess_extension("url")).alias("name"))
    got = fetch(named, client, ", ".join(f"{c} {t}" for c, t in named.dtypes) + ", content binary", at_once)
    return got.filter("content is not null")
