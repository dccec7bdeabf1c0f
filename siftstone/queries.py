"""One query for each operator over the driver's tables, each with its SQL; names begin with the survey's row.

`embeddings` stand in for candidates (label: point of interest), `part` for sizes, `events` for states, `pages`
for stored HTML. Thresholds that would be vacuous on these tables are lowered here, never in the library.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.functions import judge, scalars
from siftstone.operators import dedup, filters, neardup, ranking, tables, transitions, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NOW = "timestamp '2024-01-31 00:00:00'"
WEIGHTS = [((i * 7) % 11 - 5) / 10.0 for i in range(64)]
BIAS = 6.0
_HEAD = f"list_sum(list_transform(list_zip(embedding::DOUBLE[], {WEIGHTS}::DOUBLE[]), lambda x: x[1] * x[2])) / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) + {BIAS}"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


class T:
    """The tables of one folder."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.d}/{name}.parquet")


def now() -> Column:
    return F.expr(NOW)


def part_sizes(t: T) -> DataFrame:
    return t.part.select("p_partkey", (F.col("p_size") * 40).alias("w"), (F.pmod("p_partkey", F.lit(50)) * 30).alias("h"))


_SIZES = "(SELECT p_partkey, p_size * 40 AS w, (p_partkey % 50) * 30 AS h FROM part)"


def scored(t: T) -> DataFrame:
    return t.embeddings.select(F.col("label").alias("poi"), F.col("vec_id").alias("ord"), "embedding", filters.head_score(F.col("embedding"), WEIGHTS, BIAS).alias("score"))


@query(f"SELECT p_partkey, w, h FROM {_SIZES} WHERE w >= 600 AND h >= 600")
def p1_resolution(spark, d):
    return part_sizes(T(spark, d)).filter(filters.large_enough(F.col("w"), F.col("h")))


@query("SELECT p_partkey, CASE WHEN p_partkey % 8 = 7 THEN -1 ELSE p_size * 40 END AS width, CASE WHEN p_partkey % 8 = 7 THEN -1 ELSE (p_partkey % 50) * 30 + 1 END AS height, p_partkey % 8 < 7 AND p_size * 40 >= 600 AND (p_partkey % 50) * 30 + 1 >= 600 AS large_enough FROM part")
def s12_p1_image_sizes(spark, d):
    """Headers of seven kinds of files, and one that is none, with the parts' sizes."""
    from siftstone.functions.headers import image_size

    t = T(spark, d)
    w, h = F.col("p_size") * 40, F.pmod("p_partkey", F.lit(50)) * 30 + 1
    big = lambda v, n: F.lpad(F.hex(v), 2 * n, "0")
    little = lambda v, n: F.concat(*[F.lpad(F.hex(F.shiftright(v, 8 * k).bitwiseAND(255)), 2, "0") for k in range(n)])
    kinds = [
        F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), big(w, 4), big(h, 4)),
        F.concat(F.lit("474946383961"), little(w, 2), little(h, 2)),
        F.concat(F.lit("424D" + "00" * 12 + "28000000"), little(w, 4), little(-h, 4)),
        F.concat(F.lit("FFD8FFE000040102FFC2001108"), big(h, 2), big(w, 2)),
        F.concat(F.lit("52494646000000005745425056503820000000003001009D012A"), little(w, 2), little(h, 2)),
        F.concat(F.lit("5249464600000000574542505650384C000000002F"), little((w - 1).bitwiseOR(F.shiftleft(h - 1, 14)), 4)),
        F.concat(F.lit("52494646000000005745425056503858" + "00" * 8), little(w - 1, 3), little(h - 1, 3)),
        F.lit("3C68746D6C3E"),
    ]
    k = F.pmod("p_partkey", F.lit(8))
    files = t.part.select("p_partkey", image_size(F.unhex(F.coalesce(*[F.when(k == i, x) for i, x in enumerate(kinds)]))).alias("s"))
    return files.select("p_partkey", "s.width", "s.height", filters.large_enough(F.col("s.width"), F.col("s.height")).alias("large_enough"))


@query(f"SELECT p_partkey, w, h FROM {_SIZES} WHERE CASE WHEN h > 0 THEN w / h ELSE 0 END BETWEEN 0.4 AND 2.5")
def p2_aspect(spark, d):
    return part_sizes(T(spark, d)).filter(filters.fair_aspect(F.col("w"), F.col("h")))


@query(f"SELECT vec_id AS ord, round({_HEAD}, 6) AS score FROM embeddings WHERE {_HEAD} >= 6.0")
def p3_p4_score(spark, d):
    return scored(T(spark, d)).filter(filters.good_looking(F.col("score"))).select("ord", F.round("score", 6).alias("score"))


@query("""
WITH b AS (SELECT p_partkey, p_name, p_size / 50.0 AS conf, (p_partkey % 90) * 10.0 AS x0, (p_partkey % 70) * 12.0 AS y0, 20.0 + p_size * 8 AS bw, 5.0 + p_size AS bh FROM part)
SELECT p_partkey, (conf >= 0.3 AND ((((y0 + bh / 2) / 1000 > 0.8 OR (y0 + bh / 2) / 1000 < 0.15 OR (x0 + bw / 2) / 1000 < 0.1 OR (x0 + bw / 2) / 1000 > 0.9) AND bw * bh / 1000000 >= 0.001)
  OR bw * bh / 1000000 > 0.08 OR contains(lower(p_name), 'adobe'))) AS rejected FROM b""")
def p5_a10_f36_overlay_text(spark, d):
    b = T(spark, d).part.select("p_partkey", "p_name", (F.col("p_size") / 50.0).alias("conf"), (F.pmod("p_partkey", F.lit(90)) * 10.0).alias("x0"), (F.pmod("p_partkey", F.lit(70)) * 12.0).alias("y0"), (F.lit(20.0) + F.col("p_size") * 8).alias("bw"), (F.lit(5.0) + F.col("p_size")).alias("bh"))
    box = F.array(F.array("x0", "y0"), F.array(F.col("x0") + F.col("bw"), "y0"), F.array(F.col("x0") + F.col("bw"), F.col("y0") + F.col("bh")), F.array("x0", F.col("y0") + F.col("bh")))
    dets = F.array(F.struct(box.alias("bbox"), F.col("p_name").alias("text"), F.col("conf").alias("conf")))
    return b.withColumn("dets", dets).select("p_partkey", filters.has_overlay_text(F.col("dets"), F.lit(1000), F.lit(1000)).alias("rejected"))


_LIKE = lambda c, parts: " OR ".join(f"contains({c}, '{p}')" for p in parts)
_HREFS = "(SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS url, generate_subscripts(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1), 1) - 1 AS idx FROM pages)"


def hrefs(t: T) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    return t.pages.select("page_id", F.col("url").alias("page_url"), F.posexplode(found).alias("idx", "url"))


@query(f"SELECT page_id, url, ({_LIKE('lower(url)', scalars.JUNK)}) AS junk, ({_LIKE('url', scalars.SKIP_DOMAINS)}) AS skipped FROM pages")
def p6_p8_url_predicates(spark, d):
    return T(spark, d).pages.select("page_id", "url", scalars.is_junk("url").alias("junk"), scalars.is_skipped_domain("url").alias("skipped"))


@query("SELECT page_id, contains(html, 'lang=\"en\"') AND length(html) >= 5000 AS valid FROM pages")
def p7_payload(spark, d):
    kind = F.when(F.col("html").contains('lang="en"'), "image/jpeg").otherwise("text/html")
    return T(spark, d).pages.select("page_id", filters.valid_payload(kind, F.length("html")).alias("valid"))


@query("SELECT doc_id, md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT (" + " OR ".join(f"contains(x, '{p}')" for p in scalars.NOISE) + ")), chr(10))) AS clean_md5 FROM documents")
def p9_noise_lines(spark, d):
    return T(spark, d).documents.select("doc_id", F.md5(scalars.drop_noise_lines("text").cast("binary")).alias("clean_md5"))


_STATES = "(SELECT user_id, count(*) AS n, max(ts) AS idx FROM events GROUP BY user_id)"


def states(t: T) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("idx"))


@query(f"SELECT user_id, coalesce(n >= 12 AND idx > {NOW} - INTERVAL 1 DAY, false) AS skip FROM {_STATES}")
def p10_recently_scraped(spark, d):
    return states(T(spark, d)).select("user_id", filters.scraped_recently(F.col("n"), F.col("idx"), now(), days=1).alias("skip"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 1000 AND o_totalprice < 200000 AND nullif(o_orderpriority, '1-URGENT') IS NULL")
def p11_p15_predicates(spark, d):
    o = T(spark, d).orders
    o = o.withColumn("calm", F.nullif("o_orderpriority", F.lit("1-URGENT")))
    return tables.matching(o, {"o_orderstatus": "O"}, {"o_totalprice": 1000}, {"o_totalprice": 200000}, ("calm",)).select("o_orderkey", "o_totalprice")


_LAYER = "(SELECT p_partkey AS id, p_size AS scraped_count, p_partkey % 2 AS img_count, (p_partkey % 40)::INT AS enough, p_partkey % 3 AS clip_count, CASE WHEN p_partkey % 5 = 0 THEN 'processing' ELSE 'idle' END AS processing_status FROM part)"


def layer(t: T) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(k.alias("id"), F.col("p_size").alias("scraped_count"), (k % 2).alias("img_count"), (k % 40).cast("int").alias("enough"), (k % 3).alias("clip_count"), F.when(k % 5 == 0, "processing").otherwise("idle").alias("processing_status"))


@query(f"SELECT id, scraped_count FROM {_LAYER} WHERE scraped_count >= 12 AND img_count = 0 AND processing_status = 'idle'")
def p16_pending_images(spark, d):
    return tables.pending_images(layer(T(spark, d)), 0).select("id", "scraped_count")


@query(f"SELECT id FROM {_LAYER} WHERE enough >= 20 AND clip_count = 0 AND processing_status = 'idle'")
def p17_pending_videos(spark, d):
    return tables.pending_videos(layer(T(spark, d)).withColumn("img_count", F.col("enough")), 20).select("id")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def p18_ready_batches(spark, d):
    o = T(spark, d).orders.withColumn("compilation_status", F.when(F.col("o_orderstatus") == "P", "pending").otherwise("completed"))
    return tables.ready_batches(o).select("o_orderkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_name = 'Customer#000000042' OR c_custkey = 42")
def p19_lookup(spark, d):
    c = T(spark, d).customer
    return tables.lookup(c, "c_custkey", F.lit(42)).select("c_custkey", "c_name")


@query("SELECT p_brand, n, CASE WHEN n = 0 THEN 'fail' WHEN n < 80 THEN 'retry' ELSE 'pass' END AS gate FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand)")
def p21_quality_gate(spark, d):
    return filters.quality_gate(T(spark, d).part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), least=80)


@query("SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O' AND nullif(o_orderpriority, '2-HIGH') IS NULL")
def j1_p14_p20_embed_join(spark, d):
    t = T(spark, d)
    v = t.orders.select("o_orderkey", F.col("o_custkey").alias("poi_id"), F.when(F.col("o_orderstatus") == "O", "draft").alias("publishing_status"), F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("compressed_video_url"))
    b = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("poi_name"))
    return tables.videos_for_download(v, b).select("o_orderkey", F.col("poi_id").alias("o_custkey"), F.col("poi_name").alias("c_name"))


@query(f"""SELECT c_custkey, CASE WHEN idx IS NULL THEN 'new' WHEN floor((epoch({NOW}) - epoch(idx)) / 86400) < 1 THEN 'skip' ELSE 'rescrape' END AS cache_status
FROM customer LEFT JOIN {_STATES} ON user_id = c_custkey""")
def j2_f28_cache_status(spark, d):
    t = T(spark, d)
    cache = states(t).select(F.col("user_id").alias("poi_name"), F.col("idx").alias("first_synced_at"))
    names = t.customer.select(F.col("c_custkey").alias("poi_name"))
    return tables.cache_status(names, cache, now(), 1).withColumnRenamed("poi_name", "c_custkey")


@query("SELECT c_custkey AS poi_name, CASE WHEN s_suppkey IS NOT NULL THEN s_name END AS optimization_layer_id FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def j3_foreign_key(spark, d):
    t = T(spark, d)
    return tables.with_foreign_key(t.customer.select(F.col("c_custkey").alias("poi_name")), t.supplier.select(F.col("s_suppkey").alias("poi_name"), F.col("s_name").alias("id")))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def j4_semi_join(spark, d):
    t = T(spark, d)
    return tables.survivors(t.customer.select("c_custkey", "c_name"), t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def j5_k5_anti_join(spark, d):
    t = T(spark, d)
    return tables.not_stored(t.customer.select("c_custkey", "c_name"), t.orders.filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


_SCORES = f"(SELECT vec_id, label, {_HEAD} AS score FROM embeddings)"


@query(f"SELECT doc_id, round(coalesce(score, 0), 6) AS score FROM documents LEFT JOIN {_SCORES} ON vec_id = doc_id")
def j7_score_attach(spark, d):
    t = T(spark, d)
    return tables.with_score(t.documents.select("doc_id"), scored(t).select(F.col("ord").alias("doc_id"), "score"), "doc_id").select("doc_id", F.round("score", 6).alias("score"))


@query("SELECT p_partkey, coalesce(n_name, 'subpage_' || p_partkey) AS label FROM part LEFT JOIN nation ON n_nationkey = p_partkey")
def j10_f24_ref_labels(spark, d):
    t = T(spark, d)
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(F.lit('- link "'), x["n_name"], F.lit('. | more" [ref='), x["n_nationkey"].cast("string"), F.lit("]"))), "\n")
    snap = t.nation.agg(lines.alias("snapshot")).withColumn("poi", F.lit("x"))
    refs = t.part.select("p_partkey", F.lit("x").alias("poi"), F.col("p_partkey").alias("ref"))
    out = urls.label_of_ref(refs, snap).select("p_partkey", F.regexp_replace("label", r"\.$", "").alias("label"))
    return out


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS found FROM customer")
def j11_exists(spark, d):
    t = T(spark, d)
    return tables.exists(t.customer.select("c_custkey"), t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("""WITH c AS (SELECT list(n_name ORDER BY n_nationkey) AS names FROM nation),
s AS (SELECT c_custkey, unnest(names) AS n, generate_subscripts(names, 1) AS i, c_name FROM (SELECT c_custkey, n_name || ' of ' || c_name AS c_name FROM customer JOIN nation ON n_nationkey = c_nationkey), c)
SELECT c_custkey, arg_max(n, (len(list_intersect(list_distinct(regexp_split_to_array(lower(n), '\\s+')), list_distinct(regexp_split_to_array(lower(c_name), '\\s+')))) * 1000 - i)) AS best FROM s GROUP BY c_custkey""")
def j12_u5_best_name(spark, d):
    t = T(spark, d)
    pack = t.nation.agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda x: F.concat(F.lit('- link "'), x["n_name"], F.lit(' $99 4.3" [ref=1]'))).alias("s")).select(F.lit("all").alias("g"), urls.pack_names(F.array_join("s", "\n")).alias("names"))
    wanted = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.concat("n_name", F.lit(" of "), "c_name").alias("w"), F.lit("all").alias("g"))
    return wanted.join(pack, "g").select("c_custkey", urls.best_name(F.col("names"), F.col("w")).alias("best"))


@query("SELECT lang, count(*) FILTER (source = 'src0') AS n_src0, count(*) FILTER (source = 'src1') AS n_src1, count(*) FILTER (source = 'none') AS n_none FROM documents GROUP BY lang")
def a1_a2_counts(spark, d):
    return tables.value_counts(T(spark, d).documents, ["lang"], "source", ("src0", "src1", "none"))


@query(f"""WITH x AS (SELECT p_partkey % 10 AS poi, w, h FROM {_SIZES}),
t AS (SELECT poi, CASE WHEN NOT (w >= 600 AND h >= 600) THEN 1 WHEN NOT (w / h BETWEEN 0.4 AND 2.5) THEN 2 END AS s FROM x),
c AS (SELECT poi, count(*) AS n, count(*) FILTER (s = 1) AS r1, count(*) FILTER (s = 2) AS r2 FROM t GROUP BY poi)
SELECT poi, 0 AS step, 'resolution' AS stage, n AS before, r1 AS rejected, n - r1 AS remaining FROM c UNION ALL SELECT poi, 1, 'aspect', n - r1, r2, n - r1 - r2 FROM c UNION ALL SELECT poi, 2, 'score', n - r1 - r2, 0, n - r1 - r2 FROM c""")
def a3_stage_counts(spark, d):
    c = part_sizes(T(spark, d)).select((F.col("p_partkey") % 10).alias("poi"), F.col("w").alias("width"), F.col("h").alias("height"), F.lit(None).cast("double").alias("score"))
    return filters.stage_counts(filters.image_candidates(c), ["resolution", "aspect", "score"], ["poi"])


@query(f"SELECT label AS poi, round(max(score), 6) AS best, round(min(score), 6) AS worst, round(avg(score), 6) AS mean, count(*) AS n FROM {_SCORES} GROUP BY label")
def a4_selection_stats(spark, d):
    s = tables.selection_stats(scored(T(spark, d)), ["poi"])
    return s.select("poi", *[F.round(c, 6).alias(c) for c in ("best", "worst", "mean")], "n")


@query("""SELECT a.vec_id AS ord, round(max(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])), 6) AS nearest
FROM embeddings a JOIN embeddings b ON a.label = b.label AND b.vec_id < a.vec_id GROUP BY a.vec_id""")
def a5_nearest_earlier(spark, d):
    return neardup.nearest_earlier(scored(T(spark, d))).select("ord", F.round("nearest", 6).alias("nearest"))


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'click'")
def a7_failed_distinct(spark, d):
    e = T(spark, d).events.select(F.lit("r").alias("run_id"), F.when(F.col("event_type") == "click", "failed").alias("status"), F.col("user_id").alias("poi_name"))
    return tables.failed_names(e, "r").withColumnRenamed("poi_name", "user_id")


@query("SELECT count(*) FILTER (quality = 1) AS n_ok, count(*) FILTER (quality <> 1) AS n_failed, CASE WHEN count(*) FILTER (quality <> 1) > 0 THEN 1 ELSE 0 END AS exit_code FROM labels")
def a8_run_summary(spark, d):
    return tables.run_summary(T(spark, d).labels.select((F.col("quality") == 1).alias("ok")))


@query("SELECT event_id, coalesce((props::JSON->>'$.k')::BIGINT, 0) AS prompt, 0::BIGINT AS completion, 0::BIGINT AS total FROM events")
def a11_usage(spark, d):
    reply = F.concat(F.lit('{"usage": {"prompt_tokens": '), F.coalesce(F.get_json_object("props", "$.k"), F.lit("0")), F.lit("}}"))
    return T(spark, d).events.select("event_id", judge.usage(reply).alias("u")).select("event_id", "u.*")


@query(f"SELECT page_id, idx, url FROM {_HREFS} QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, idx) = 1")
def w1_j6_first_seen(spark, d):
    return dedup.first_seen(hrefs(T(spark, d)).withColumn("o", F.struct("page_id", "idx")), ["url"], "o").select("page_id", "idx", "url")


@query(f"SELECT page_id, idx, url FROM {_HREFS} WHERE idx < 3")
def w3_cap(spark, d):
    return dedup.head_of_group(hrefs(T(spark, d)).select("page_id", "idx", "url"), ["page_id"], [F.col("idx")], 3)


@query(f"""WITH h AS (SELECT (page_id % 16)::VARCHAR AS poi, page_id * 1000 + idx AS ord, url, CASE WHEN page_id % 3 = 0 THEN 'all' ELSE (page_id % 3)::VARCHAR END AS t FROM {_HREFS}),
g AS (SELECT poi, list({{'o': ord, 'u': url, 't': t}} ORDER BY ord) AS r FROM h GROUP BY poi),
k AS (SELECT poi, list_reduce(list_transform(r, lambda e: [e]), lambda a, b: CASE WHEN len(a) >= 9 OR len(list_filter(a, lambda q: q.t = b[1].t)) >= CASE WHEN b[1].t = 'all' THEN 5 ELSE 3 END OR len(list_filter(a, lambda q: q.u = b[1].u)) > 0 THEN a ELSE list_concat(a, b) END) AS kept FROM g),
u AS (SELECT poi, unnest(kept) AS q FROM k) SELECT poi, q.o AS ord, q.u AS url, q.t AS category FROM u""")
def w2_quota_across_tabs(spark, d):
    h = hrefs(T(spark, d)).select((F.col("page_id") % 16).cast("string").alias("poi"), (F.col("page_id") * 1000 + F.col("idx")).alias("ord"), "url", F.when(F.col("page_id") % 3 == 0, "all").otherwise((F.col("page_id") % 3).cast("string")).alias("category"))
    return dedup.quota_across_tabs(h, first_quota=5, quota=3, cap=9)


@query(f"SELECT label AS poi, vec_id AS ord, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) - 1 AS pos FROM {_SCORES} QUALIFY pos < 30")
def w4_w5_head30(spark, d):
    return ranking.top_n(scored(T(spark, d)), n=30).select("poi", "ord", F.col("pos").cast("long").alias("pos"))


#: Large groups, and some of one row each.
_TWO = f"(SELECT vec_id, CASE WHEN vec_id % 100 = 7 THEN vec_id + 1000 ELSE label END AS poi, score FROM {_SCORES})"


@query(f"""SELECT poi, vec_id AS ord, (CASE WHEN count(*) OVER (PARTITION BY poi) <= 15 THEN row_number() OVER (PARTITION BY poi ORDER BY vec_id) ELSE row_number() OVER (PARTITION BY poi ORDER BY score DESC, vec_id) END) - 1 AS pos
FROM {_TWO} QUALIFY pos < 15""")
def w6_top_n(spark, d):
    s = scored(T(spark, d)).withColumn("poi", F.when(F.col("ord") % 100 == 7, F.col("ord") + 1000).otherwise(F.col("poi")))
    return ranking.top_n(s).select("poi", "ord", F.col("pos").cast("long").alias("pos"))


@query("SELECT o_orderkey, nullif(o_orderdate, timestamp '1995-01-01') AS idx FROM orders ORDER BY idx DESC NULLS FIRST, o_orderkey LIMIT 10")
def w7_w8_latest(spark, d):
    o = T(spark, d).orders.select("o_orderkey", F.nullif("o_orderdate", F.expr("timestamp '1995-01-01'")).alias("idx"))
    return ranking.latest(o, "idx", "o_orderkey", 10)


@query("SELECT s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN s_name ELSE s_name || ' v' || CASE WHEN s_suppkey % 4 = 1 THEN 2 WHEN s_suppkey % 4 = 2 THEN 3 ELSE 4 END END AS next FROM supplier")
def w9_next_version(spark, d):
    s = T(spark, d).supplier
    k = F.col("s_suppkey") % 4
    done = s.filter(k > 0).select(F.col("s_name").alias("name"))
    v = lambda n, when: s.filter(when).select(F.concat("s_name", F.lit(f" v{n}")).alias("name"))
    used = v(2, k >= 2).unionByName(v(3, k == 3)).unionByName(v(5, k == 3)).unionByName(v(2, k == 0))
    return ranking.next_version(s.select(F.col("s_name").alias("name")), used, done)


@query("SELECT doc_id, printf('candidate_%04d', row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 + 7) AS candidate_id FROM documents")
def w10_k1_numbering(spark, d):
    docs = T(spark, d).documents.select("doc_id", "lang").withColumn("start", F.lit(7))
    return ranking.number_files(docs, "lang", "doc_id", "start").select("doc_id", "candidate_id")


_SIGNS = "list_sum(list_transform(range(63), lambda i: CASE WHEN embedding[(i + 1)::INT] > 0 THEN (1::BIGINT << i::INT) ELSE 0 END))::BIGINT"


def hashed(t: T) -> DataFrame:
    bits = F.aggregate(F.sequence(F.lit(0), F.lit(62)), F.lit(0).cast("long"), lambda a, i: a + F.when(F.element_at("embedding", i + 1) > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return t.embeddings.select(F.col("label").alias("poi"), F.col("vec_id").alias("ord"), "embedding", bits.alias("phash"))


@query(f"""WITH h AS (SELECT label, vec_id, {_SIGNS} AS p FROM embeddings),
g AS (SELECT label, list({{'o': vec_id, 'x': p}} ORDER BY vec_id) AS r FROM h GROUP BY label),
k AS (SELECT label, list_reduce(list_transform(r, lambda e: [e]), lambda a, b: CASE WHEN len(list_filter(a, lambda q: bit_count(xor(q.x, b[1].x)) < 24)) > 0 THEN a ELSE list_concat(a, b) END) AS kept FROM g)
SELECT label AS poi, unnest(list_transform(kept, lambda q: q.o)) AS ord FROM k""")
def g1_j8_hash_dedup(spark, d):
    return dedup.hash_dedup(hashed(T(spark, d)), distance=24)


@query("""WITH g AS (SELECT label, list({'o': vec_id, 'x': embedding::DOUBLE[]} ORDER BY vec_id) AS r FROM embeddings GROUP BY label),
k AS (SELECT label, list_reduce(list_transform(r, lambda e: [e]), lambda a, b: CASE WHEN len(list_filter(a, lambda q: list_cosine_similarity(q.x, b[1].x) >= 0.3)) > 0 THEN a ELSE list_concat(a, b) END) AS kept FROM g)
SELECT label AS poi, unnest(list_transform(kept, lambda q: q.o)) AS ord FROM k""")
def g2_j9_embedding_dedup(spark, d):
    return dedup.embedding_dedup(hashed(T(spark, d)), similarity=0.3).select("poi", "ord")


@query(SQL["g2_j9_embedding_dedup"])
def g2_blocks(spark, d):
    return dedup.embedding_dedup_blocks(hashed(T(spark, d)), similarity=0.3).select("poi", "ord")


def _two_folds(rows: str, bits: int, cosine: float) -> str:
    """SQL of tables f (poi, ord, pos): rows (poi, ord, x, p, ...) after the fold on hashes p and then that on vectors x."""
    fold = lambda near: f"list_reduce(list_transform(r, lambda e: [e]), lambda a, b: CASE WHEN len(list_filter(a, lambda q: {near})) > 0 THEN a ELSE list_concat(a, b) END)"
    return f"""c AS ({rows}),
g1 AS (SELECT poi, list({{'o': ord, 'x': p}} ORDER BY ord) AS r FROM c GROUP BY poi),
k1 AS (SELECT poi, unnest(list_transform({fold(f'bit_count(xor(q.x, b[1].x)) < {bits}')}, lambda q: q.o)) AS ord FROM g1),
g2 AS (SELECT c.poi, list({{'o': c.ord, 'x': c.x}} ORDER BY c.ord) AS r FROM c JOIN k1 ON k1.poi = c.poi AND k1.ord = c.ord GROUP BY c.poi),
k2 AS (SELECT poi, list_transform({fold(f'list_cosine_similarity(q.x, b[1].x) >= {cosine}')}, lambda q: q.o) AS kept FROM g2),
f AS (SELECT poi, unnest(kept) AS ord, (generate_subscripts(kept, 1) - 1)::INT AS pos FROM k2)"""


@query("WITH " + _two_folds(f"SELECT label AS poi, vec_id AS ord, embedding::DOUBLE[] AS x, {_SIGNS} AS p FROM embeddings", 24, 0.3) + " SELECT poi, ord, pos FROM f")
def g3_two_pass(spark, d):
    return dedup.two_pass_dedup(hashed(T(spark, d)), distance=24, similarity=0.3)


_FEW = f"(SELECT label AS poi, vec_id AS ord, {_SIGNS} & 268435455 AS p FROM embeddings)"
_FEW_KEPT = f"""g AS (SELECT poi, list({{'o': ord, 'x': p}} ORDER BY ord) AS r FROM {_FEW} GROUP BY poi),
k AS (SELECT poi, list_reduce(list_transform(r, lambda e: [e]), lambda a, b: CASE WHEN len(list_filter(a, lambda q: bit_count(xor(q.x, b[1].x)) < 8)) > 0 THEN a ELSE list_concat(a, b) END) AS kept FROM g),
s AS (SELECT poi, unnest(list_transform(kept, lambda q: q.o)) AS ord FROM k)"""


def few_bits(t: T) -> DataFrame:
    return hashed(t).withColumn("phash", F.col("phash").bitwiseAND((1 << 28) - 1))


@query(f"WITH {_FEW_KEPT} SELECT poi, ord FROM s")
def g1_rounds(spark, d):
    """The elimination by hashes as tables, of groups beyond a head of eight rows."""
    return neardup.hash_dedup(few_bits(T(spark, d)), head=8)


@query(SQL["g2_j9_embedding_dedup"])
def g2_rounds(spark, d):
    return neardup.embedding_dedup(hashed(T(spark, d)), similarity=0.3, head=8).select("poi", "ord")


@query(f"""WITH {_FEW_KEPT}, e AS (SELECT r.poi, r.ord, min(bit_count(xor(f.p, r.p))) AS nearest, arg_min(f.ord, bit_count(xor(f.p, r.p)) * 1000000 + f.ord) AS matched
FROM {_FEW} r JOIN s ON s.poi = r.poi AND s.ord < r.ord JOIN {_FEW} f ON f.poi = s.poi AND f.ord = s.ord GROUP BY r.poi, r.ord)
SELECT r.poi, r.ord, e.nearest::INT AS nearest, e.matched, s.ord IS NOT NULL AS kept FROM {_FEW} r LEFT JOIN e ON e.poi = r.poi AND e.ord = r.ord LEFT JOIN s ON s.poi = r.poi AND s.ord = r.ord""")
def a5_nearest_kept_hash(spark, d):
    """Which row that stays is nearest to each row, and whether that drops it."""
    return neardup.hash_log(few_bits(T(spark, d)))


@query(f"""WITH s AS ({SQL["g2_j9_embedding_dedup"]}), v AS (SELECT label AS poi, vec_id AS ord, embedding::DOUBLE[] AS x FROM embeddings),
e AS (SELECT r.poi, r.ord, max(list_cosine_similarity(f.x, r.x)) AS nearest, arg_max(f.ord, list_cosine_similarity(f.x, r.x)) AS matched FROM v r JOIN s ON s.poi = r.poi AND s.ord < r.ord JOIN v f ON f.poi = s.poi AND f.ord = s.ord GROUP BY r.poi, r.ord)
SELECT r.poi, r.ord, round(e.nearest, 6) AS nearest, e.matched, s.ord IS NOT NULL AS kept FROM v r LEFT JOIN e ON e.poi = r.poi AND e.ord = r.ord LEFT JOIN s ON s.poi = r.poi AND s.ord = r.ord""")
def a5_nearest_kept_vector(spark, d):
    return neardup.embedding_log(hashed(T(spark, d)), similarity=0.3).withColumn("nearest", F.round("nearest", 6))


@query("SELECT 0 AS source_rank, n_name AS name FROM nation UNION ALL SELECT 1, r_name FROM region UNION ALL SELECT 2, s_name FROM supplier")
def u1_u3_union(spark, d):
    t = T(spark, d)
    return urls.union_sources([t.nation.select(F.col("n_name").alias("name")), t.region.select(F.col("r_name").alias("name")), t.supplier.select(F.col("s_name").alias("name"))])


_MERGE = f"""WITH h AS (SELECT (page_id % 8)::BIGINT AS poi, page_id * 1000 + idx AS ord, url, (page_id % 3)::INT AS source_rank FROM {_HREFS}),
f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY poi, url ORDER BY source_rank, ord) = 1)"""


def entries(t: T) -> list[DataFrame]:
    h = hrefs(t).select((F.col("page_id") % 8).alias("poi"), (F.col("page_id") * 1000 + F.col("idx")).alias("ord"), "url", (F.col("page_id") % 3).alias("k"))
    return [h.filter(F.col("k") == k).drop("k").withColumn("source", F.lit(s)) for k, s in enumerate(("google_kp", "google_images", "official_site"))]


@query(_MERGE + " SELECT poi, url, source_rank, (row_number() OVER (PARTITION BY poi ORDER BY source_rank, ord) - 1)::INT AS ord FROM f")
def u2_merge(spark, d):
    return urls.merge_entries(entries(T(spark, d))).select("poi", "url", "source_rank", "ord")


@query(_MERGE + " SELECT poi AS poi_name, count(*) AS total, count(*) FILTER (source_rank = 0) AS kp, count(*) FILTER (source_rank = 1) AS images, count(*) FILTER (source_rank = 2) AS site FROM f GROUP BY poi")
def k2_manifest(spark, d):
    m = urls.manifest(urls.merge_entries(entries(T(spark, d))), now())
    c = F.col("source_counts")
    return m.select("poi_name", "total", c["google_kp"].alias("kp"), c["google_images"].alias("images"), c["official_site"].alias("site"))


@query("SELECT doc_id, true AS kept FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def u4_membership(spark, d):
    t = T(spark, d)
    return tables.survivors(t.documents.select("doc_id"), t.labels, "doc_id").withColumn("kept", F.lit(True))


@query(f"SELECT page_id, url, url_out FROM (SELECT page_id, url, url AS url_out, row_number() OVER (PARTITION BY page_id, url ORDER BY idx) AS k FROM {_HREFS} WHERE length(url) >= 10 AND NOT starts_with(url, 'data:') AND NOT ({_LIKE('lower(url)', scalars.JUNK)})) WHERE k = 1")
def s7_page_images(spark, d):
    t = T(spark, d)
    found = urls.page_images(t.pages.withColumn("sub", F.lit("homepage")), "page_id", "sub", "html", pattern='href="([^"]*)"', least=10, cap=10**6)
    return found.select(F.col("poi").alias("page_id"), "url", F.col("url").alias("url_out"))


@query("SELECT page_id, 'https://img.example/photograph-of-' || page_id || '.jpg?w=1&h=2' AS url FROM pages")
def s5_f4_script_urls(spark, d):
    p = T(spark, d).pages
    js = F.concat(F.lit("var a='https://img.example/photograph-of-"), F.col("page_id").cast("string"), F.lit(".jpg?w"), F.lit("=1&h=2'; b='https://www.google.com/some/long/path/x.png'; c='https://cdn.example/logo/abcdefgh.png'"))
    return urls.script_urls(p.select("page_id", js.alias("js")), "page_id", "js").select(F.col("poi").alias("page_id"), "url")


@query("SELECT page_id, CASE WHEN page_id % 3 > 0 AND page_id % 2 = 1 THEN 'https://lh3.googleusercontent.com/' || repeat('x', 30) || page_id END AS panel FROM pages")
def s8_panel_urls(spark, d):
    k = F.col("page_id")
    src = F.concat(F.lit("https://lh3.googleusercontent.com/"), F.when(k % 3 == 0, "a/").otherwise(""), F.repeat(F.lit("x"), 30), k.cast("string"), F.lit("=w100"))
    return T(spark, d).pages.select("page_id", urls.panel_url(src, F.when(k % 2 == 1, 100).otherwise(20)).alias("panel"))


@query("SELECT p_partkey, p_name AS display_name, lpad((p_partkey % 10000)::VARCHAR, 4, '0') AS base_key, '.jpg' AS ext, 'image/png' AS mime, 'pois/' || p_name || '/s/f.png' AS path FROM part")
def f1_f2_f9_f13_names(spark, d):
    k = F.format_string("candidate_%04d", F.col("p_partkey") % 10000)
    path = scalars.storage_path("p_name", F.lit(""), F.lit("s"), F.lit("f.png"))
    return T(spark, d).part.select("p_partkey", scalars.display_name(F.concat("p_name", F.lit(" v12"))).alias("display_name"), scalars.base_key(F.concat(F.lit("/1111/"), k, F.lit(".jpg"))).alias("base_key"), scalars.guess_extension(F.lit("http://x/y.JPG?z")).alias("ext"), scalars.mime_type(path).alias("mime"), path.alias("path"))


@query("""SELECT page_id, regexp_replace(url, 'ref=x', 'wid=2000') AS boosted, replace(replace(url, ' ', '+'), '&', '%26') AS encoded,
regexp_replace(replace(replace(replace(lower(trim(url)), 'https://', ''), 'http://', ''), 'www.', ''), '/+$', '') AS domain FROM pages""")
def f3_f5_f6_urls(spark, d):
    u = F.concat(F.lit("cache.marriott.com/is/image/"), F.replace("url", F.lit("ref=x"), F.lit("wid=17")))
    boosted = F.replace(scalars.full_size_url(u), F.lit("cache.marriott.com/is/image/"), F.lit(""))
    return T(spark, d).pages.select("page_id", boosted.alias("boosted"), scalars.encode_query("url").alias("encoded"), scalars.bare_domain("url").alias("domain"))


@query("""SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN [n_name, n_name || ' hotel resort', n_name || ' nature view', n_name || ' surroundings', n_name || ' aerial view', n_name || ' scenic landscape']
ELSE [n_name, n_name || ' L resort', n_name || ' L nature view', n_name || ' L surroundings', n_name || ' L aerial view', n_name || ' L scenic drive to'] END[4] AS fourth,
greatest(n_nationkey * 10 // 6, 10)::INT AS per_query FROM nation""")
def f7_f8_f14_queries(spark, d):
    q = scalars.search_queries("n_name", F.when(F.col("n_regionkey") > 0, scalars.short_location(F.lit("A, B, L "))))
    return T(spark, d).nation.select("n_nationkey", q[3].alias("fourth"), scalars.per_query(F.col("n_nationkey") * 10, q).alias("per_query"))


_REPLY = "(SELECT doc_id // 50 AS poi, list(quality ORDER BY doc_id) AS q FROM labels GROUP BY 1)"


def replies(t: T) -> DataFrame:
    g = t.labels.groupBy(F.floor(F.col("doc_id") / 50).alias("poi")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "quality"))).alias("q"))
    lines = F.transform("q", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), F.when(x["quality"] == 1, "keep - fine").otherwise("Reject: poor")))
    return g.select("poi", F.size("q").alias("n"), F.array_join(lines, "\n").alias("content"))


@query(f"SELECT poi, list_transform(q, lambda x: CASE WHEN x = 1 THEN 'KEEP' ELSE 'REJECT' END)::VARCHAR AS decisions, list_sum(q)::BIGINT AS n_keep FROM {_REPLY}")
def f15_a9_decisions(spark, d):
    r = replies(T(spark, d)).withColumn("d", judge.decisions(F.col("content"), F.col("n")))
    return r.select("poi", F.concat(F.lit("["), F.array_join("d", ", "), F.lit("]")).alias("decisions"), F.size(F.filter("d", lambda x: x == "KEEP")).cast("long").alias("n_keep"))


@query(f"SELECT poi, CASE WHEN poi % 2 = 0 AND len(q) >= 2 THEN [1, 0, 1] ELSE list_filter(list_transform(range(len(q)), lambda i: CASE WHEN q[(i + 1)::INT] = 1 THEN i END), lambda i: i IS NOT NULL) END::VARCHAR AS chosen FROM {_REPLY}")
def f16_f17_chosen(spark, d):
    r = replies(T(spark, d)).withColumn("content", F.when(F.col("poi") % 2 == 0, F.concat("content", F.lit("\n**Top 15：** 2, 1, x, 99999, 2"))).otherwise(F.col("content")))
    c = judge.chosen(F.col("content"), F.col("n"))
    return r.select("poi", F.concat(F.lit("["), F.array_join(c.cast("array<string>"), ", "), F.lit("]")).alias("chosen"))


@query("SELECT doc_id, nullif(regexp_extract(text, '[0-9]+'), '') AS ref, len(regexp_extract_all(text, '[0-9]+')[1:3])::INT AS n_refs FROM documents")
def f18_f19_refs(spark, d):
    return T(spark, d).documents.select("doc_id", scalars.first_ref("text").alias("ref"), F.size(scalars.first_refs("text", 3)).alias("n_refs"))


@query("""SELECT event_id, props::JSON->>'$.k' AS k, CASE WHEN props::JSON->>'$.k' IS NULL THEN NULL ELSE props::JSON->>'$.k' END AS after_put FROM events""")
def f25_f26_notes(spark, d):
    put = scalars.put_note("props", "z", F.lit("1"))
    return T(spark, d).events.select("event_id", scalars.note("props", "k").alias("k"), scalars.note(scalars.pop_note(put, "z"), "k").alias("after_put"))


@query("""SELECT event_id, '{"n":' || user_id || ',"deep":{"list":[' || user_id || ',true,null],"s":"' || event_type || '"},"z":"1"}' AS put, '{"deep":{"list":[' || user_id || ',true,null],"s":"' || event_type || '"}}' AS popped,
'{"n": ' || user_id || ', "deep": {"list":[' || user_id || ',true,null],"s":"' || event_type || '"}, "m": ["' || event_type || '", "x"]}' AS many FROM events""")
def f26_typed_notes(spark, d):
    """Other members keep their types; the whole text is compared."""
    u = F.col("user_id").cast("string")
    e = T(spark, d).events.select("event_id", "event_type", F.concat(F.lit('{"n": '), u, F.lit(', "deep": {"list": ['), u, F.lit(', true, null], "s": "'), F.col("event_type"), F.lit('"}}')).alias("notes"))
    return e.select("event_id", scalars.put_note("notes", "z", F.lit("1")).alias("put"), scalars.pop_note("notes", "n").alias("popped"), scalars.put_note_list("notes", "m", F.array("event_type", F.lit("x"))).alias("many"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey >= 4 THEN n_name || ',b,c,d' END AS suffixes FROM nation")
def f27_suffix_list(spark, d):
    items = F.when(F.col("n_nationkey") >= 4, F.concat(F.lit('```json\n[" '), F.col("n_name"), F.lit('","b ","c","d","e"]\n```'))).otherwise('["a"]')
    return T(spark, d).nation.select("n_nationkey", F.array_join(scalars.suffix_list(items), ",").alias("suffixes"))


@query(f"SELECT event_id, floor((epoch({NOW}) - floor(epoch(ts))) / 86400)::BIGINT AS age, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events")
def f28_f30_times(spark, d):
    return T(spark, d).events.select("event_id", scalars.age_days("ts", now()).alias("age"), scalars.stamp("ts").alias("stamp"))


@query("""WITH a AS (SELECT p_partkey, p_retailprice / 10 AS dur, (p_size * 40)::DOUBLE AS w, ((p_partkey % 50) * 30 + 16)::DOUBLE AS h, CASE WHEN p_partkey % 2 = 0 THEN 2.0 ELSE 4.0 END AS fps FROM part),
b AS (SELECT *, greatest(ceil(least(ceil(dur * fps), 2048) / 2) * 2, 2) AS nf FROM a),
c AS (SELECT *, greatest(8192.0, least(least(131072.0 * 1024 * 2 / nf, 307200.0), 8388608.0)) AS mp, CASE WHEN least(h, w) < 32 THEN CASE WHEN h < w THEN floor(w * 32 / h) ELSE 32 END ELSE w END AS w2, CASE WHEN least(h, w) < 32 THEN CASE WHEN h < w THEN 32 ELSE floor(h * 32 / w) END ELSE h END AS h2 FROM b),
e AS (SELECT *, round_even(h2 / 32, 0) * 32 AS hb, round_even(w2 / 32, 0) * 32 AS wb FROM c),
f AS (SELECT *, CASE WHEN hb * wb > mp THEN floor(h2 / sqrt(h2 * w2 / mp) / 32) * 32 WHEN hb * wb < 8192 THEN ceil(h2 * sqrt(8192 / (h2 * w2)) / 32) * 32 ELSE hb END AS hf,
  CASE WHEN hb * wb > mp THEN floor(w2 / sqrt(h2 * w2 / mp) / 32) * 32 WHEN hb * wb < 8192 THEN ceil(w2 * sqrt(8192 / (h2 * w2)) / 32) * 32 ELSE wb END AS wf, floor((floor(dur * 100) + 1 - 1) / 2) + 1 AS t1 FROM e)
SELECT p_partkey, (nf / 2 * floor(hf / 16 * wf / 16 / 4) + nf / 2 * CASE WHEN fps > 2 THEN 5 ELSE 3 END + nf / 2 * 2 + 2 + ceil((floor(t1 / 2) + (t1 % 2)) / 4) + 2)::BIGINT AS tokens FROM f""")
def f31_video_tokens(spark, d):
    p = T(spark, d).part
    fps = F.when(F.col("p_partkey") % 2 == 0, F.lit(2.0)).otherwise(F.lit(4.0))
    return p.select("p_partkey", scalars.video_tokens(F.col("p_retailprice") / 10, F.col("p_size") * 40, F.pmod("p_partkey", F.lit(50)) * 30 + 16, fps).alias("tokens"))


@query("SELECT p_partkey, trunc(p_size * 8.0 * 1024 * 1024 / p_retailprice / 1000)::BIGINT AS bitrate, p_size > 10 AS compress, greatest(2, least(10, CASE WHEN p_size % 13 = 0 THEN 2 ELSE p_size % 13 END))::INT AS fps, greatest(p_size * 4 // 2, 50)::INT AS budget FROM part")
def f32_f34_f42_numbers(spark, d):
    return T(spark, d).part.select("p_partkey", scalars.target_bitrate("p_size", "p_retailprice").alias("bitrate"), scalars.needs_compression("p_size").alias("compress"), scalars.clamp_fps(F.col("p_size") % 13).alias("fps"), scalars.retry_budget(F.col("p_size") * 4).alias("budget"))


@query("SELECT region.r_regionkey, base64(encode(r_name)) AS b64, lower(r_name) IN ('true', '1', 'yes') AS truthy, 'http://x/' || r_name AS url FROM region")
def f12_f35_f40_text(spark, d):
    return T(spark, d).region.select("r_regionkey", F.base64(F.encode("r_name", "utf-8")).alias("b64"), scalars.truthy("r_name").alias("truthy"), scalars.public_url(F.lit("http://x"), "r_name").alias("url"))


@query("SELECT vec_id AS ord, round(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))), 5) AS norm FROM embeddings")
def f38_norm(spark, d):
    return T(spark, d).embeddings.select(F.col("vec_id").alias("ord"), F.round(F.sqrt(scalars.dot(F.col("embedding"), F.col("embedding"))), 5).alias("norm"))


@query("""WITH g AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
px AS (SELECT vec_id, y, x, e[((32 * y + x + 5 * y * y) % 61 + 1)::INT] AS v FROM g, range(32) ty(y), range(32) tx(x)),
across AS (SELECT vec_id, y, u, sum(v * cos(pi() * (2 * x + 1) * u / 64)) AS s FROM px, range(8) tu(u) GROUP BY vec_id, y, u),
low AS (SELECT vec_id, w, u, sum(s * cos(pi() * (2 * y + 1) * w / 64)) AS c FROM across, range(8) tw(w) GROUP BY vec_id, w, u),
m AS (SELECT vec_id, median(c) AS md FROM low GROUP BY vec_id),
b AS (SELECT vec_id, sum(CASE WHEN c > md THEN (1::HUGEINT << (63 - 8 * w - u)::INT) ELSE 0 END)::HUGEINT AS h FROM (SELECT vec_id, w, u, c, md FROM low JOIN m USING (vec_id)) GROUP BY vec_id)
SELECT vec_id AS ord, (CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END)::BIGINT AS phash FROM b""")
def f39_perceptual_hash(spark, d):
    at = F.expr("transform(sequence(0, 1023), i -> element_at(embedding, cast((i + 5 * floor(i / 32) * floor(i / 32)) % 61 + 1 as int)))")
    return T(spark, d).embeddings.select(F.col("vec_id").alias("ord"), dedup.perceptual_hash(at).alias("phash"))


@query("""WITH g AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
px AS (SELECT vec_id, y, x, floor(((b + 40 * x) % 256 * 7471 + (b * 3 + 17 * y) % 256 * 38470 + (b + x * y) % 256 * 19595 + 32768) / 65536) AS v FROM (SELECT vec_id, (vec_id * 31 + floor(abs(e[1]) * 100)::BIGINT) % 256 AS b FROM g), range(32) ty(y), range(32) tx(x)),
across AS (SELECT vec_id, y, u, sum(v * cos(pi() * (2 * x + 1) * u / 64)) AS s FROM px, range(8) tu(u) GROUP BY vec_id, y, u),
low AS (SELECT vec_id, w, u, sum(s * cos(pi() * (2 * y + 1) * w / 64)) AS c FROM across, range(8) tw(w) GROUP BY vec_id, w, u),
m AS (SELECT vec_id, median(c) AS md FROM low GROUP BY vec_id),
b AS (SELECT vec_id, sum(CASE WHEN c > md THEN (1::HUGEINT << (63 - 8 * w - u)::INT) ELSE 0 END)::HUGEINT AS h FROM (SELECT vec_id, w, u, c, md FROM low JOIN m USING (vec_id)) GROUP BY vec_id)
SELECT vec_id AS ord, (CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END)::BIGINT AS phash FROM b""")
def f39_image_bytes(spark, d):
    """The same of pixels: 32 rows of 32 times blue, green and red, as bytes."""
    b = F.pmod(F.col("vec_id") * 31 + F.floor(F.abs(F.element_at("embedding", 1).cast("double")) * 100), F.lit(256))
    rows = T(spark, d).embeddings.select(F.col("vec_id").alias("ord"), b.alias("b"))
    byte = lambda v: f"lpad(hex(pmod({v}, 256)), 2, '0')"
    data = F.expr(f"unhex(array_join(transform(sequence(0, 1023), i -> concat({byte('b + i % 32 * 40')}, {byte('b * 3 + i div 32 * 17')}, {byte('b + i % 32 * (i div 32)')})), ''))")
    image = F.struct(F.lit(32).alias("height"), F.lit(32).alias("width"), F.lit(3).alias("nChannels"), data.alias("data"))
    return rows.select("ord", image.alias("image")).select("ord", dedup.image_hash(F.col("image")).alias("phash"))


_JOBS = "(SELECT event_id AS id, CASE WHEN event_type = 'click' THEN 'processing' ELSE 'idle' END AS processing_status, CASE WHEN event_type = 'click' THEN 'running' ELSE 'completed' END AS status, ts, user_id FROM events)"


def jobs(t: T) -> DataFrame:
    click = F.col("event_type") == "click"
    return t.events.select(F.col("event_id").alias("id"), F.when(click, "processing").otherwise("idle").alias("processing_status"), F.when(click, "running").otherwise("completed").alias("status"), F.col("ts").alias("updated_at"), F.col("ts").alias("started_at"), F.lit(None).cast("timestamp").alias("completed_at"), F.col("user_id").cast("string").alias("poi_name"))


@query(f"SELECT id, CASE WHEN user_id = 7 AND processing_status = 'idle' THEN 'processing' ELSE processing_status END AS processing_status, user_id = 7 AND processing_status = 'idle' AS changed FROM {_JOBS}")
def d3_claim(spark, d):
    return transitions.claim(jobs(T(spark, d)), "7", now()).select("id", "processing_status", "changed")


@query(f"SELECT id, CASE WHEN user_id = 7 THEN 'idle' ELSE processing_status END AS processing_status, user_id = 7 AS changed FROM {_JOBS}")
def d2_d4_release(spark, d):
    return transitions.release(jobs(T(spark, d)), "7", now()).select("id", "processing_status", "changed")


@query(f"SELECT id, CASE WHEN processing_status = 'processing' AND ts < {NOW} - INTERVAL 120 MINUTE THEN 'idle' ELSE processing_status END AS processing_status, ts AS updated_at FROM {_JOBS}")
def d5_reset_stale_pois(spark, d):
    return transitions.reset_stale_pois(jobs(T(spark, d)), now()).select("id", "processing_status", "updated_at")


@query(f"SELECT count(*) FILTER (status = 'running' AND ts < {NOW} - INTERVAL 120 MINUTE) AS n_changed FROM {_JOBS}")
def d6_a6_reset_stale_runs(spark, d):
    return transitions.n_changed(transitions.reset_stale_runs(jobs(T(spark, d)), now()))


@query("""SELECT c_name AS poi_name, NULL::VARCHAR AS id, NULL::VARCHAR AS optimization_layer_id FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_name, 'new' || c_custkey, s_name FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey WHERE c_mktsegment <> 'BUILDING'""")
def d1_d7_get_or_create(spark, d):
    t = T(spark, d)
    none = F.lit(None).cast("string")
    have = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_name").alias("poi_name"), none.alias("id"), none.alias("optimization_layer_id"))
    wanted = t.customer.select(F.col("c_name").alias("poi_name"), F.concat(F.lit("new"), F.col("c_custkey").cast("string")).alias("id"))
    lay = t.customer.join(t.supplier, F.col("s_suppkey") == F.col("c_custkey")).select(F.col("c_name").alias("poi_name"), F.col("s_name").alias("id"))
    return transitions.get_or_create_batches(have, wanted, lay)


@query("SELECT o_orderkey, CASE WHEN o_orderkey = 7 THEN 'completed' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey = 7 THEN 'ok' END AS summary FROM orders")
def d8_d13_finish_run(spark, d):
    o = T(spark, d).orders.select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderstatus").alias("status"), F.lit(None).cast("timestamp").alias("completed_at"), F.lit(None).cast("string").alias("summary"), "o_orderkey")
    return transitions.finish_run(o, "7", "completed", now(), F.lit("ok")).select("o_orderkey", "status", "summary")


@query("SELECT c_custkey, count(o_orderkey)::INT AS poi_count, 'running' AS status FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def d12_new_runs(spark, d):
    r = T(spark, d).orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list("o_orderkey").alias("poi_names"))
    return transitions.new_runs(r, now()).select("c_custkey", "poi_count", "status")


@query("SELECT n_nationkey, n_regionkey, CASE WHEN n_nationkey = 3 AND n_regionkey = 1 THEN 'passed' ELSE n_name END AS status, CASE WHEN n_nationkey = 3 AND n_regionkey = 1 THEN 2.5 END AS duration_s FROM nation")
def d14_finish_step(spark, d):
    k = F.col("n_nationkey").cast("string")
    s = T(spark, d).nation.select("n_nationkey", "n_regionkey", k.alias("run_id"), F.col("n_regionkey").cast("string").alias("poi_name"), F.lit("vibe").alias("stage"), F.col("n_name").alias("status"), F.lit(None).cast("timestamp").alias("completed_at"), F.lit(None).cast("double").alias("duration_s"))
    return transitions.finish_step(s, "3", "1", "vibe", "passed", now(), F.lit(2.5)).select("n_nationkey", "n_regionkey", "status", "duration_s")


@query("SELECT coalesce(s_suppkey, c_custkey) AS k, coalesce(s_name, c_name) AS name, c_mktsegment AS seg FROM customer FULL JOIN supplier ON s_suppkey = c_custkey + 5")
def d9_d11_d15_upsert(spark, d):
    t = T(spark, d)
    old = t.customer.select((F.col("c_custkey") + 5).alias("j"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"))
    new = t.supplier.select(F.col("s_suppkey").alias("j"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"))
    return transitions.upsert(old, new, "j").select("k", "name", "seg")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN '9' ELSE props::JSON->>'$.k' END AS k FROM events")
def d16_notes_update(spark, d):
    e = T(spark, d).events.select("event_id", "event_type", "props")
    return transitions.update(e, F.col("event_type") == "click", {"props": scalars.put_note("props", "k", F.lit("9"))}).select("event_id", scalars.note("props", "k").alias("k"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = 7 ORDER BY o_orderkey LIMIT 1")
def d10_first_url(spark, d):
    return tables.first_row(T(spark, d).orders, "o_orderkey", o_custkey=7).select("o_orderkey", "o_totalprice")


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN 'old/' || s_suppkey WHEN s_suppkey % 4 = 1 THEN 'u/' || s_suppkey || '/0' END AS url, CASE WHEN s_suppkey % 4 = 1 THEN 3 WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS n_variations, s_suppkey % 4 <= 1 AS completed FROM supplier")
def d10_overlay_variations(spark, d):
    """Variations of some videos, three more each of others, and each video's URL."""
    k = F.col("s_suppkey")
    s = T(spark, d).supplier
    videos = s.select(k.alias("id"))
    old = s.filter(k % 4 == 0).select(k.alias("compiled_video_id"), F.col("s_name").alias("overlay_text"), F.concat(F.lit("old/"), k).alias("final_output_url"), F.lit("completed").alias("status"))
    new = s.filter(k % 4 == 1).select(k.alias("compiled_video_id"), F.col("s_name").alias("overlay_text"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda j: F.concat(F.lit("u/"), k, F.lit("/"), j))).alias("final_output_url"))
    both = transitions.create_overlays(old, videos, new)
    counts = both.groupBy(F.col("compiled_video_id").alias("v")).agg(F.count(F.lit(1)).cast("int").alias("n"), F.bool_and(F.col("status") == "completed").alias("completed"))
    out = tables.overlay_urls(videos, both).join(counts, F.col("id") == F.col("v"), "left")
    return out.select("id", F.col("final_output_url").alias("url"), F.coalesce("n", F.lit(0)).alias("n_variations"), F.coalesce("completed", F.lit(False)).alias("completed"))


@query("SELECT lang, to_json(map_from_entries(list((source, n) ORDER BY source)))::VARCHAR AS metadata FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang")
def k6_a2_sidecar(spark, d):
    from siftstone.sources.readers import sidecar

    return sidecar(T(spark, d).documents.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "lang", "source", "n")


@query("SELECT page_id, 'pois/p/archive/20240131_000000/s/' || page_id || '.jpg' AS path FROM pages WHERE page_id % 2 = 0")
def k7_archive(spark, d):
    p = T(spark, d).pages.select("page_id", F.concat(F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".jpg").otherwise(".json")).alias("f"))
    return p.filter(~F.col("f").endswith(".json")).select("page_id", scalars.archive_path(F.lit("p"), scalars.stamp(now()), F.lit("s"), "f").alias("path"))


#: Candidates of the plan: sizes of which both rules drop some, hashes, vectors and scores.
_CANDIDATES = f"""SELECT * FROM (SELECT label AS poi, vec_id AS ord, embedding::DOUBLE[] AS x, {_SIGNS} AS p, {_HEAD} AS score, 500 + (vec_id * 37) % 1500 AS w, 500 + (vec_id * 53) % 1100 AS h FROM embeddings)
WHERE w >= 600 AND h >= 600 AND w / h BETWEEN 0.6 AND 2.0 AND score >= 5.9"""
_CURATED = "WITH " + _two_folds(_CANDIDATES, 20, 0.3) + ", r AS (SELECT f.poi, f.ord, row_number() OVER (PARTITION BY f.poi ORDER BY c.score DESC, f.pos) - 1 AS nth FROM f JOIN c ON c.poi = f.poi AND c.ord = f.ord)"


def candidates(t: T) -> DataFrame:
    k = F.col("ord")
    sizes = {"width": 500 + k * 37 % 1500, "height": 500 + k * 53 % 1100}
    return hashed(t).withColumns({"score": filters.head_score(F.col("embedding"), WEIGHTS, BIAS)} | sizes)


def _config():
    from siftstone.config import Config

    return Config(min_width=600, min_height=600, min_aspect=0.6, max_aspect=2.0, target_max=15)


def _plan(c: DataFrame, replies: DataFrame | None = None) -> DataFrame:
    from siftstone.plans import curation

    return curation.curate(c, replies, _config(), least=5.9, similarity=0.3, distance=20).select("poi", "ord", F.col("pos").cast("long").alias("pos"))


@query(_CURATED + " SELECT poi, ord, nth AS pos FROM r WHERE nth < 15")
def curate(spark, d):
    """The core plan: resolution, aspect, score, both eliminations, order, top 15."""
    return _plan(candidates(T(spark, d)))


@query(_CURATED + """, s AS (SELECT poi, ord, nth, CASE WHEN poi % 2 = 0 THEN nth - 1 ELSE [1, 2, 0][nth + 1] END AS q FROM r WHERE CASE WHEN poi % 2 = 0 THEN nth BETWEEN 1 AND 29 ELSE nth < 3 END),
n AS (SELECT *, count(*) OVER (PARTITION BY poi) AS n FROM s)
SELECT poi, ord, CASE WHEN n <= 15 THEN row_number() OVER (PARTITION BY poi ORDER BY q) ELSE row_number() OVER (PARTITION BY poi ORDER BY nth) END - 1 AS pos FROM n QUALIFY pos < 15""")
def curate_judged(spark, d):
    """The plan with replies: even groups lose their best, odd ones name three."""
    c = candidates(T(spark, d))
    r = c.select("poi").distinct().withColumn("content", F.when(F.col("poi") % 2 == 0, "1. REJECT\n2. KEEP").otherwise("TOP15: 3, 1, 2"))
    return _plan(c, r)


@query("WITH " + _two_folds(_CANDIDATES, 20, 0.3) + f""", a AS (SELECT label AS poi, {_HEAD} AS score, 500 + (vec_id * 37) % 1500 AS w, 500 + (vec_id * 53) % 1100 AS h FROM embeddings),
n AS (SELECT poi, count(*) AS n0, count(*) FILTER (w >= 600 AND h >= 600) AS n1, count(*) FILTER (w >= 600 AND h >= 600 AND w / h BETWEEN 0.6 AND 2.0) AS n2 FROM a GROUP BY poi),
m AS (SELECT n.*, (SELECT count(*) FROM c WHERE c.poi = n.poi) AS n3, (SELECT count(*) FROM k1 WHERE k1.poi = n.poi) AS n4, (SELECT count(*) FROM f WHERE f.poi = n.poi) AS n5 FROM n),
j AS (SELECT *, CASE WHEN poi % 3 = 0 THEN n5 WHEN poi % 3 = 1 THEN greatest(least(n5, 30) - 1, 0) ELSE 0 END AS n6 FROM m),
x AS (SELECT poi, unnest([0, 1, 2, 3, 4, 5, 6]) AS step, unnest(['resolution', 'aspect', 'score', 'hashes', 'vectors', 'judge', 'top']) AS stage, unnest([n0, n1, n2, n3, n4, n5, n6]) AS before, unnest([n1, n2, n3, n4, n5, n6, least(n6, 15)]) AS remaining FROM j)
SELECT poi, step, stage, before, before - remaining AS rejected, remaining FROM x""")
def a3_all_stages(spark, d):
    """What each stage of the whole plan drops: a third of the groups skip the judge, a third lose one image to it, a third fail."""
    from siftstone.plans import curation

    c = candidates(T(spark, d))
    k = F.pmod("poi", F.lit(3))
    replies = c.select("poi").distinct().select("poi", F.when(k == 0, "skipped").when(k == 1, "replied").otherwise("failed").alias("outcome"), F.when(k == 1, "1. REJECT").alias("content"))
    return curation.accounts(curation.selected(c, replies, _config(), least=5.9, similarity=0.3, distance=20))


@query("""SELECT coalesce(s.k, c.k) AS poi_name, CASE WHEN s.k IS NULL THEN c.pics ELSE 'pois/' || s.k END AS scraped_pics, coalesce(s.n, c.n) AS scraped_count, CASE WHEN s.k IS NULL THEN 'processing' ELSE 'idle' END AS processing_status, s.k IS NOT NULL AS stamped
FROM (SELECT (c_custkey + 5)::VARCHAR AS k, c_name AS pics, c_nationkey::INT AS n FROM customer) c FULL JOIN (SELECT s_suppkey::VARCHAR AS k, (s_suppkey % 3)::INT AS n FROM supplier WHERE s_suppkey % 3 > 0) s ON s.k = c.k""")
def d17_register_scrape(spark, d):
    t = T(spark, d)
    layer = t.customer.select((F.col("c_custkey") + 5).cast("string").alias("poi_name"), F.col("c_name").alias("scraped_pics"), F.col("c_nationkey").cast("int").alias("scraped_count"), F.lit("processing").alias("processing_status"), F.lit(None).cast("timestamp").alias("updated_at"))
    k = F.col("s_suppkey").cast("string")
    rows = t.supplier.select(k.alias("poi_name"), F.concat(F.lit("pois/"), k).alias("scraped_pics"), (F.col("s_suppkey") % 3).cast("int").alias("scraped_count"))
    return transitions.register_scrape(layer, rows, now()).select("poi_name", "scraped_pics", "scraped_count", "processing_status", F.col("updated_at").isNotNull().alias("stamped"))


@query("SELECT page_id, idx, url FROM " + _HREFS + " WHERE idx < 2")
def s9_manifest_prefix(spark, d):
    """Each page's links as a manifest, written and read back by its first entries."""
    import uuid

    from siftstone.shared import folder
    from siftstone.sources import readers

    none = F.lit(None).cast("string")
    entries = hrefs(T(spark, d)).select(F.col("page_id").cast("string").alias("poi"), F.col("idx").alias("ord"), "url", F.lit("official_site").alias("source"), none.alias("category"), none.alias("subpage"))
    path = f"{folder(spark)}/siftstone/manifest-{uuid.uuid4().hex}"
    readers.write_manifest(urls.manifest(entries, now()), path)
    return readers.read_manifest(spark, path, most=2, lines=True).select(F.col("poi").cast("long").alias("page_id"), F.col("ord").alias("idx"), "url")


@query("SELECT regexp_replace(url, '/[^/]*$', '') AS dir, regexp_extract(url, '[^/]*$') AS name FROM pages WHERE contains(url, '/') AND NOT ends_with(url, '/')")
def s18_f13_listing(spark, d):
    from siftstone.sources.readers import listing

    return listing(T(spark, d).pages, "url")


@query("SELECT c_custkey AS poi_name, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS location, (s_suppkey IS NULL OR s_suppkey % 3 = 0) AS missing FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def s19_cached_attribute(spark, d):
    t = T(spark, d)
    k = F.col("s_suppkey")
    cache = t.supplier.select(k.alias("poi_name"), F.when(k % 3 > 0, F.concat("s_name", F.lit(" "))).when(k % 2 == 0, "unknown").otherwise("").alias("location"))
    return tables.cached_attribute(t.customer.select(F.col("c_custkey").alias("poi_name")), cache, F.col("location"), "location")


@query("""WITH n AS (SELECT DISTINCT doc_id // 3 AS poi, doc_id FROM documents), s AS (SELECT DISTINCT doc_id // 3 AS poi, doc_id FROM labels),
g AS (SELECT poi, count(*) AS k FROM n GROUP BY poi), c AS (SELECT poi, count(*) AS k FROM s GROUP BY poi)
SELECT n.poi, n.doc_id || '.jpg' AS name, coalesce(c.k <> g.k, false) AS archive, (coalesce(c.k <> g.k, false) OR s.doc_id IS NULL) AS upload
FROM n JOIN g ON g.poi = n.poi LEFT JOIN c ON c.poi = n.poi LEFT JOIN s ON s.doc_id = n.doc_id""")
def k5_upload_plan(spark, d):
    from siftstone.plans.upload import upload_plan

    t = T(spark, d)
    files = lambda df, end=".jpg": df.select(F.floor(F.col("doc_id") / 3).alias("poi"), F.concat(F.col("doc_id").cast("string"), F.lit(end)).alias("name"))
    return upload_plan(files(t.documents), files(t.labels).unionByName(files(t.documents, ".json")))


@query(f"""WITH f AS (SELECT label AS poi, vec_id AS ord FROM {_SCORES} WHERE score >= 6.1), m AS (SELECT label AS poi, vec_id AS ord FROM {_SCORES} WHERE score < 6.1),
h AS (SELECT poi, count(*) AS n, max(ord) + 1 AS start FROM f GROUP BY poi)
SELECT poi, ord FROM f UNION ALL SELECT m.poi, m.ord + coalesce(h.start, 0) AS ord FROM m LEFT JOIN h ON h.poi = m.poi WHERE coalesce(h.n, 0) < 6""")
def u3_retry(spark, d):
    from siftstone.plans.curation import retry

    s = scored(T(spark, d)).select("poi", "ord", "score")
    return retry(s.filter("score >= 6.1").drop("score"), s.filter("score < 6.1").drop("score"), least=6)


@query("SELECT c_custkey, c_custkey::VARCHAR AS button, c_nationkey::VARCHAR AS rooms, 2 AS n_tabs, c_name AS pack FROM customer")
def f21_f22_f23_snapshot(spark, d):
    k, n = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    snap = F.concat(F.lit('- text "Photos"\n- button "All photos" [ref='), k, F.lit(']\n- tab "Change collection to Rooms" [ref=1]\n- tab "Change collection to Food" [ref=2]\n- tab "Change collection to Rooms" [ref='), n, F.lit(']\n- link "'), F.col("c_name"), F.lit(' $120 4.5" [ref=9]'))
    tabs = urls.tab_refs(snap)
    return T(spark, d).customer.select("c_custkey", urls.photos_button(snap).alias("button"), tabs["Rooms"].alias("rooms"), F.size(tabs).alias("n_tabs"), F.get(urls.pack_names(snap), F.lit(0)).alias("pack"))


@query("SELECT event_id, CASE WHEN event_type <> 'click' THEN epoch(date_trunc('second', ts))::BIGINT END AS at FROM events")
def f29_iso_times(spark, d):
    text = F.when(F.col("event_type") == "click", "no time").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return T(spark, d).events.select("event_id", F.unix_seconds(scalars.iso_timestamp(text)).alias("at"))


@query("SELECT vec_id AS ord, " + ", ".join(f"round(list_{f}((embedding::DOUBLE[])[{a}:{a + 31}]), 6) AS {n}" for n, f, a in (("x0", "min", 1), ("y0", "min", 33), ("x1", "max", 1), ("y1", "max", 33))) + " FROM embeddings")
def f36_bounding_boxes(spark, d):
    points = F.zip_with(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32), lambda x, y: F.array(x.cast("double"), y.cast("double")))
    return T(spark, d).embeddings.select(F.col("vec_id").alias("ord"), *[F.round(v, 6).alias(k) for k, v in scalars.bbox(points).items()])


@query("SELECT c_custkey, contains(p, ', ' || n_name) AS place, contains(p, 'About: ' || c_mktsegment) AS about, contains(p, 'Images: ' || c_nationkey) AS images FROM (SELECT c_custkey, n_name, c_mktsegment, c_nationkey, 'Place: ' || c_name || CASE WHEN c_nationkey > 9 THEN ', ' || n_name ELSE '' END || CASE WHEN c_acctbal > 0 THEN chr(10) || 'About: ' || c_mktsegment ELSE '' END || chr(10) || 'Images: ' || c_nationkey AS p FROM customer JOIN nation ON n_nationkey = c_nationkey)")
def f37_prompts(spark, d):
    t = T(spark, d)
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    p = scalars.judge_prompt("c_name", F.when(F.col("c_nationkey") > 9, F.col("n_name")), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(""), "c_nationkey")
    return rows.select("c_custkey", *[p.contains(F.concat(F.lit(a), F.col(b).cast("string"))).alias(n) for n, a, b in (("place", ", ", "n_name"), ("about", "About: ", "c_mktsegment"), ("images", "Images: ", "c_nationkey"))])


@query("SELECT n_nationkey AS k, n_name AS name, n_regionkey AS region FROM nation UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def f41_d1_insert(spark, d):
    t = T(spark, d)
    have = t.nation.select(F.col("n_nationkey").cast("long").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return transitions.insert(have, t.supplier.select(F.col("s_suppkey").cast("long").alias("k"), F.col("s_name").alias("name")))
