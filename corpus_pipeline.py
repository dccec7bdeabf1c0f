"""A corpus pipeline: language ID, near-duplicates, personal data, mixing, token ids; each stage one operator.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what each returns as Parquet
to the shared folder, hands the reread table to the next and deletes what the stage has left besides.

In all stages: rows may repeat, any column may be null, an empty table gives an empty one, and columns beyond COLUMNS are
dropped, whatever their names. Texts are read whole, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm import langid, mixing, pii, sentpiece, shingles, simhash
from siftstone.llm.common import Scratch, drop_table, held_out, materialize
from siftstone.llm.queries import PIECES

#: Words that the last stage remembers a generation: its workers share executors whose heap earlier stages have grown.
REMEMBERED = 100_000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language: those with no letter, an empty text or none go."""
    model = langid.fit(docs.filter(~held_out("doc_id")), F.col("doc_id"))
    got = docs.withColumn("__lid", langid.predict(docs, model)).filter(F.col("__lid.lang") != langid.UND)
    return got.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id; empty texts and nulls are one group."""
    return simhash.keep_one(docs).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """near_duplicates(), then of documents whose five-word shingles are similar by 0.8 or more only the first.

    A document goes only if it is similar to an earlier one, which may have gone itself: in a chain (B like A, C like B) C may
    go though it is unlike A. No two documents that stay are similar."""
    once = materialize(near_duplicates(spark, docs, sf_dir), "once")
    return shingles.keep_one(once).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; personal data and what gives it away is replaced in the text, and n_chars follows (null texts
    stay null, and so does their n_chars)."""
    got = pii.sanitise(docs, rewrite=True).withColumn("n_chars", F.length("text").cast("long"))
    return got.select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to 2 times; the null source is one of its own, and documents without
    a word (null or empty text) stay as they are."""
    return mixing.remix(docs).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang and token ids of each row; none for empty texts and nulls."""
    return docs.select("doc_id", "source", "lang", sentpiece.encode(docs, PIECES, remembered=REMEMBERED).alias("ids"))


STAGES = [("language", language), ("near_duplicates", near_copies), ("personal_data", personal_data), ("mixture", mixture), ("tokens", tokens)]

#: No stage but the third's patterns is within SQL: a network, shingles, Newton steps and a tokenizer's ids. Tests hold
#: each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        with Scratch(spark) as scratch:
            done = scratch.keep(materialize(stage(spark, docs, sf_dir), name))
        drop_table(docs)
        docs = done
    return docs
