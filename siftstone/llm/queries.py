"""The queries op1 to op13 and pipeline, each over its whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm import ann, audit, decontam, langid, lexical, mixing, pii, quality, sentpiece, simhash, toxicity, urlfilter, warc
from siftstone.llm.common import held_out, materialize

#: Where the tokenizer model is; a parameter of the operator, read on the driver only.
PIECES = os.environ.get("SIFTSTONE_PIECES", "/opt/tokenizers/piece_bpe_32k.model")

#: Pages are of some kilobytes: beyond this size their records are segmented.
CHUNK = 4096

RULES = [urlfilter.Rule("com", "/", "allow"), urlfilter.Rule("example.com", "/en/", "block"), urlfilter.Rule("www.example.com", "/en/", "allow"), urlfilter.Rule("net", "/es/", "block"), urlfilter.Rule("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter(~held_out("doc_id")), F.col("doc_id"))
    got = langid.identify(docs, model, keep=["doc_id"])
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(spark, warc.write(_table(spark, sf_dir, "pages"), chunk=CHUNK))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.sanitise(docs).drop("text")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), RULES)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentpiece.encode_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out("doc_id"))
    model = toxicity.fit(docs, labels)
    got = docs.select("doc_id", held_out("doc_id").alias("held_out"), toxicity.score(docs, model).alias("score"))
    return got.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.index(_table(spark, sf_dir, "documents"))
    got = decontam.contaminated(found, decontam.prepare(found, _table(spark, sf_dir, "benchmark"), decontam.WIDTH))
    listed = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = materialize(lexical.item_terms(_table(spark, sf_dir, "benchmark")), "asked")
    found = lexical.index(_table(spark, sf_dir, "documents"), asked.select("term").distinct())
    return lexical.search(found, asked)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_langid, op2_warc, op3_mixing, op4_pii, op5_ann, op6_quality, op7_urls, op8_sentencepiece, op9_simhash, op10_toxicity, op11_filter_audit, op12_decontamination, op13_ranked_search, pipeline)
    return {f.__name__: f for f in found}


_BASE32 = "list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, 10 * (i // 8)::INT + 1, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31) + 1)::INT, 1)), 'string_agg', '')"

#: What op12 and op13 take for words: the same, as A-Z are lower-cased.
_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op2_warc": f"""
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
        q AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM q""",
    # the dual by bisection, in which Newton steps and their rounding leave no trace
    "op3_mixing": r"""
        WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                          md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS mark FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT] AS w, source_size * 2.0 AS most FROM s),
        l AS (SELECT *, row_number() OVER o AS pos,
                     (1.5 * sum(source_size) OVER () - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
              FROM w WINDOW o AS (ORDER BY most / w, source IS NULL, encode(source))),
        f AS (SELECT arg_min(level, pos) AS level FROM l WHERE most >= level * w),
        t AS (SELECT source, source_size, least(most, (SELECT level FROM f) * w)::DOUBLE AS target FROM l),
        h AS (SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY source, size),
        g AS (SELECT source, sum(size * n) / sum(n) AS scale, min(size) AS least FROM h GROUP BY source),
        b AS (SELECT t.source, target, scale, scale / least * least(ln(target / source_size), 0.0) AS lo, scale / least * CASE WHEN target > source_size THEN ln(2.0) ELSE 0.0 END AS hi, 0 AS step
              FROM t JOIN g ON g.source IS NOT DISTINCT FROM t.source WHERE target > 0 AND target / source_size < 2
              UNION ALL
              SELECT source, target, scale, CASE WHEN now > target THEN lo ELSE (lo + hi) / 2 END, CASE WHEN now > target THEN (lo + hi) / 2 ELSE hi END, step + 1
              FROM (SELECT b.source, target, scale, lo, hi, step, sum(n * size * least(exp(least((lo + hi) / 2 * size / scale, 50.0)), 2.0)) AS now
                    FROM b JOIN h ON h.source IS NOT DISTINCT FROM b.source WHERE step < 80 GROUP BY ALL)),
        m AS (SELECT t.*, b.scale, round(b.lo, 7) AS lam FROM t LEFT JOIN b ON b.source IS NOT DISTINCT FROM t.source AND b.step = 80),
        r AS (SELECT d.*, m.source_size, m.target, coalesce(round(least(exp(least(lam * size / scale, 50.0)), 2.0), 9), CASE WHEN target > 0 THEN 2.0 ELSE 0.0 END) AS rate FROM d JOIN m ON m.source IS NOT DISTINCT FROM d.source),
        z AS (SELECT *, floor(rate)::BIGINT AS whole, floor((('0x' || substr(mark, 1, 12))::BIGINT / 281474976710656.0 - (rate - floor(rate)) + 1) * 70368744177664.0)::BIGINT AS place FROM r),
        e AS (SELECT *, target - sum(size * whole) OVER (PARTITION BY source) AS extra, size > 0 AND whole < 2 AS free FROM z),
        c AS (SELECT *, CASE WHEN free THEN sum(CASE WHEN free THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY place, mark ROWS UNBOUNDED PRECEDING) END AS upto FROM e),
        p AS (SELECT *, extra > 0 AND free AND upto <= extra AS more, extra - coalesce(max(CASE WHEN free AND upto <= extra THEN upto END) OVER (PARTITION BY source), 0) AS miss FROM c),
        o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY free AND NOT more AND extra > 0 AND abs(miss - size) < miss DESC, abs(miss - size), place, mark) = 1 AND free AND NOT more AND extra > 0 AND abs(miss - size) < miss AS one FROM p)
        SELECT doc_id, size, source_size, target, (size * least(whole + CASE WHEN more OR one THEN 1 ELSE 0 END, 2))::BIGINT AS taken FROM o""",
    "op11_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        l AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words), 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text),
                      regexp_matches(text, '[#$%&*|]'), coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)] AS fails
              FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
        m AS (SELECT part, good, toxic, list_sum(list_transform(range(1, 6), lambda i: CASE WHEN fails[i] THEN 1 << (i - 1)::INT ELSE 0 END))::INT AS failed, count(*) AS n FROM f GROUP BY ALL),
        x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM x a, x b, x c, x d, x e WHERE a.c NOT IN (b.c, c.c, d.c, e.c) AND b.c NOT IN (c.c, d.c, e.c) AND c.c NOT IN (d.c, e.c) AND d.c <> e.c),
        s AS (SELECT filter_order, step, filter_order[step] AS own, 1 << (ascii(filter_order[step]) - 65) AS bit,
                     coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS past FROM o, (SELECT unnest(range(1, 6))::INT AS step)),
        g AS (SELECT part, filter_order, step, own,
                     sum(CASE WHEN failed & (past | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                     sum(CASE WHEN failed & past = 0 AND failed & bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
                     sum(CASE WHEN failed & past <> 0 AND failed & bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                     sum(CASE WHEN failed = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
                     sum(CASE WHEN failed & past = 0 AND failed & bit <> 0 AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
                     sum(CASE WHEN failed & past = 0 AND failed & bit <> 0 AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost
              FROM m, s GROUP BY ALL)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM g""",
    "op12_decontamination": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
        i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        q AS (SELECT DISTINCT item_id, least(10, len(w)) AS width, unnest(list_transform(range(1, len(w) - least(10, len(w)) + 2), lambda k: array_to_string(w[k:k + least(10, len(w)) - 1], ' '))) AS phrase FROM i WHERE len(w) > 0),
        p AS (SELECT r, width, w, unnest(range(1, len(w) - width + 2)) AS k FROM d, (SELECT DISTINCT width FROM q)),
        h AS (SELECT r, k, p.width, item_id FROM p JOIN q ON q.width = p.width AND q.phrase = array_to_string(w[k:k + p.width - 1], ' ')),
        c AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + width)) AS place FROM h) GROUP BY r),
        n AS (SELECT r, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS sha FROM (SELECT DISTINCT r, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY r)
        SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN n USING (r)""",
    "op13_ranked_search": rf"""
        WITH t AS (SELECT doc_id, unnest({_WORDS}) AS term FROM documents),
        p AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
        l AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM p GROUP BY doc_id),
        a AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM l),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, a GROUP BY term, docs),
        i AS (SELECT item_id, unnest({_WORDS}) AS term FROM benchmark),
        q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
        s AS (SELECT item_id, p.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
              FROM p JOIN l ON l.doc_id IS NOT DISTINCT FROM p.doc_id JOIN w USING (term) JOIN q USING (term), a GROUP BY ALL)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST))::INT AS rank, doc_id, score
        FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) <= 10""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
