"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint of 64 bits emits every value within half the radius of itself: for radius 2, itself and its 64
one-bit variants. Two fingerprints at distance 2 or less share such a variant, so one shuffle on variants
finds every link. As fingerprints are made distinct first, a variant is hit by at most 65 of them, and which
ones is kept as one 64-bit mask: the aggregate has a fixed size and combines on the map side. All hits of
a variant lie within the radius of each other, so linking each to the smallest loses no component, and no
pairs are formed within a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import drop_table, fresh, materialize, without, word_blocks
from siftstone.llm.components import connected_components

SEED = 42
#: Fingerprints whose variants one task emits, about.
BALLS = 100_000


def _bit_counts(hashes: list[int]) -> np.ndarray:
    return np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint_bytes(data: bytes | None, width: int = 3) -> int:
    """The unsigned SimHash of one UTF-8 text; the text is taken in blocks, whatever its length."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    if not data:
        return 0
    total, n, carry = np.zeros(64, dtype=np.int64), 0, []
    for words in word_blocks(data.lower()):  # bytes.lower() changes A-Z alone
        words = carry + words
        for at in range(0, max(0, len(words) - width + 1), 1 << 15):
            part = words[at : at + (1 << 15) + width - 1]
            hashes = [digest(b" ".join(s), SEED) for s in zip(*(part[k:] for k in range(width)), strict=False)]
            total += _bit_counts(hashes)
            n += len(hashes)
        carry = words[-(width - 1) :]
    if not n:
        if not carry:
            return 0
        total, n = _bit_counts([digest(b" ".join(carry), SEED)]), 1
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | Column, width: int = 3) -> Column:
    """A 64-bit fingerprint (as a signed long) of words of width-word shingles, A-Z lower-cased.

    Null, empty and white-space-only texts give 0; texts of fewer words than width are one shingle."""

    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = np.fromiter((fingerprint_bytes(x.as_py(), width) for x in batch), dtype=np.uint64, count=len(batch))
            yield pa.array(out.view(np.int64))

    return run((F.col(text) if isinstance(text, str) else text).cast("binary"))


def _ball(radius: int) -> list[int]:
    """Bit masks of weight up to radius, as signed longs."""
    if radius not in (0, 1):
        raise ValueError("variants are emitted within 0 or 1 bit: for links of up to 0 or 2 bits")
    return [0] + [(1 << i) - (1 << 64 if i == 63 else 0) for i in range(64)] * radius


def near_links(fingerprints: DataFrame, col: str, radius: int = 2) -> DataFrame:
    """(u, v): links that join all distinct non-null values of col within radius bits (0 to 2), directly or
    through a chain of links, each verified. Equal values are one node and have no link."""
    masks = F.array(*[F.lit(m).cast("long") for m in _ball((radius + 1) // 2)])
    fp = fingerprints.select(F.col(col).cast("long").alias("fp")).filter("fp is not null")
    # dealt out by number: AQE would put rows of 8 bytes into few tasks, and each row becomes 65
    tasks = max(int(fp.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-fp.count() // BALLS))
    fp = fp.repartition(tasks, "fp").distinct()
    hits = fp.select("fp", F.explode(masks).alias("m")).select(F.col("fp").bitwiseXOR(F.col("m")).alias("variant"), "m")
    met = hits.groupBy("variant").agg(F.bit_or("m").alias("flips"), F.max(F.col("m") == 0).alias("own"))
    met = met.filter(F.bit_count("flips") + F.col("own").cast("int") >= 2)
    members = F.transform(F.filter(masks, lambda m: F.when(m == 0, F.col("own")).otherwise(F.col("flips").bitwiseAND(m) != 0)), lambda m: F.col("variant").bitwiseXOR(m))
    met = met.select("variant", "own", members.alias("members"))
    if radius == 1:  # members of a ball are up to 2 bits apart then: each is linked to the ball's middle
        met = met.filter("own").select("members", F.col("variant").alias("v"))
    else:
        met = met.withColumn("v", F.array_min("members"))
    met = met.select("v", F.explode("members").alias("u"))
    return met.filter("u <> v").distinct().filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp (signed long), component_id: the smallest doc_id reachable over links of up to radius bits.

    One row for each input row, repeated rows included. Null ids are allowed: such a row belongs to its group
    but never names it; component_id is null if the whole group has none. Other columns are ignored, whatever
    their names; an empty table gives an empty one."""
    return _grouped(docs, doc_id, text, width, radius).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, doc_id: str, text: str, width: int, radius: int, **more: Column) -> DataFrame:
    """doc_id, fp, the columns of more, root (which names the group even where groups share an id) and component_id."""
    table = materialize(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text, width).alias("fp"), *[c.alias(k) for k, c in more.items()]), "simhash")
    nodes = materialize(table.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = connected_components(near_links(nodes, "fp", radius))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = materialize(rooted.join(named, "root").select("fp", "root", "component_id"), "named")
    drop_table(rooted)
    return table.join(of, "fp").select("doc_id", "fp", *more, "root", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """docs without near-duplicates: of each group one row with the group's smallest doc_id stays.

    Groups go by text: rows of one id in different groups do not touch each other. Of a group's rows that repeat
    its smallest id, one stays. A row without an id stays unless its group has a row with one.
    All input columns are kept as they are."""
    h, ident = fresh(docs, "h", "ident")
    found = materialize(_grouped(docs, doc_id, text, width, radius, h=F.xxhash64(F.col(text))).filter("component_id is not null"), "grouped")
    chosen = found.filter("doc_id = component_id").groupBy("root").agg(F.min("h").alias("kept"))
    rest = found.join(chosen, "root").filter("doc_id is null or doc_id <> component_id or h <> kept")
    gone = materialize(rest.select(F.col("h").alias(h), F.col("doc_id").alias(ident)).distinct(), "gone")
    out = without(docs, F.xxhash64(docs[text]), gone, h, docs[doc_id].eqNullSafe(gone[ident]))
    again = found.filter("doc_id is not null").groupBy("doc_id", "h").count().filter("count > 1")
    if not again.isEmpty():
        rest = out.filter(F.col(doc_id).isNotNull()).withColumn(h, F.xxhash64(F.col(text))).dropDuplicates([doc_id, h]).drop(h)
        out = rest.unionByName(out.filter(F.col(doc_id).isNull()))
    return out
