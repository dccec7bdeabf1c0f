"""Ranked lexical search: an index of postings in buckets of terms, and integer BM25-like scores by joins.

index() counts the terms of each document and writes two tables: postings (bucket, term, doc_id, tf), a folder a bucket
of terms and sorted by term within, and the documents' lengths. search() reads the buckets of its items' terms, brings each
document's postings together, joins the items on terms, scores each match in 64-bit integers and sums by item and
document; a window of row numbers keeps the best k of an item, of which each task keeps k before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftstone.llm.common import fresh_path, materialize

#: What separates terms; the weights of the score.
_APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Buckets of terms unless told otherwise; a search reads those that its terms fall into.
BUCKETS = 16


def lowered(term: Column) -> Column:
    """A-Z lower-cased, and no other letters; what is ASCII as a whole goes the short way."""
    return F.when(F.length(term) == F.octet_length(term), F.lower(term)).otherwise(F.translate(term, _UPPER, _LOWER))


def terms_of(text: Column) -> Column:
    """A row a term, repeats included; the empty strings at a text's ends must be filtered out."""
    return F.explode(F.split(text, _APART))


@dataclass(frozen=True)
class Index:
    """postings: bucket, term, doc_id, tf (term is null for all terms that were not asked for); lengths: doc_id, n, for
    documents with a term; documents and terms: how many there are, repeats of terms included."""

    postings: DataFrame
    lengths: DataFrame
    documents: int
    terms: int
    buckets: int


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def index(docs: DataFrame, only: DataFrame | None = None, buckets: int = BUCKETS) -> Index:
    """An index of docs (doc_id, text), of all terms or of those of `only` (a table with distinct `term`): then the
    other terms count for lengths alone.

    Rows that share an id, or have none, are one document, whose terms add up. Null texts, and texts without a term, add
    nothing; a document without any term is not counted. Other columns are ignored; an empty table gives an empty index.
    Words are counted where they are read, so that one row a document and term is shuffled."""
    words = docs.select(docs["doc_id"], terms_of(docs["text"]).alias("term")).filter("term <> ''").withColumn("term", lowered(F.col("term")))
    if only is not None:
        words = words.join(only.select("term", F.lit(True).alias("known")), "term", "left").select("doc_id", F.when(F.col("known"), F.col("term")).alias("term"))
    counts = words.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    spark = docs.sparkSession
    path = fresh_path(spark, "postings")
    stored = counts.withColumn("bucket", F.when(F.col("term").isNull(), -1).otherwise(bucket_of(F.col("term"), buckets)))
    stored.sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(path)
    postings = spark.read.schema(stored.schema).parquet(path)
    lengths = materialize(postings.groupBy("doc_id").agg(F.sum("tf").alias("n")), "lengths")
    documents, terms = lengths.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Index(postings, lengths, documents, terms, buckets)


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times: the terms of items (item_id, text), A-Z lower-cased. Rows that share an id are one item."""
    words = items.select(items["item_id"], terms_of(items["text"]).alias("term")).filter("term <> ''")
    return words.groupBy("item_id", lowered(F.col("term")).alias("term")).agg(F.count(F.lit(1)).alias("times"))


def search(found: Index, asked: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k best documents of a score above 0, equal scores by
    ascending doc_id (a null id first). asked: item_id, term, times, as item_terms() gives; kept in a table, of whose size
    the planner knows whether it may be broadcast."""
    if not found.documents:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(None).cast(found.lengths.schema["doc_id"].dataType).alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    n, total = F.lit(found.documents).cast("long"), F.lit(found.terms).cast("long")
    terms = asked.select("term").distinct().withColumn("bucket", bucket_of(F.col("term"), found.buckets))
    buckets = [r[0] for r in terms.select("bucket").distinct().collect()]  # no more than there are buckets
    postings = found.postings.filter(F.col("bucket").isin(buckets))
    hits = postings.join(terms.select("term"), "term", "left_semi")
    weight = F.floor(1000 * F.log((2 * n + 2).cast("double") / (2 * F.col("df") + 1)))
    weights = materialize(hits.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select("term", weight.cast("long").alias("w")), "weights")
    weighed = materialize(asked.join(weights, "term").select("term", "item_id", (F.col("times") * F.col("w")).alias("w")), "asked")

    def scores(mine: DataFrame) -> DataFrame:
        """Sums by item and document of rows (doc_id, term, tf, n)."""
        m = mine.withColumns({"documents": n, "terms": total}).withColumn("m", F.expr("25 + (75 * n * documents) div terms"))
        part = m.select("doc_id", "term", F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)").alias("part"))
        return part.join(weighed, "term").groupBy("item_id", "doc_id").agg(F.sum(F.col("w") * F.col("part")).alias("score"))

    # documents meet their lengths by doc_id, so that the sums need no further shuffle; the one without an id goes alone
    every = scores(hits.filter("doc_id is not null").join(found.lengths.filter("doc_id is not null"), "doc_id"))
    nameless = found.lengths.filter("doc_id is null").first()
    if nameless is not None:
        every = every.unionByName(scores(hits.filter("doc_id is null").withColumn("n", F.lit(nameless["n"]))))
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return every.filter("score > 0").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
