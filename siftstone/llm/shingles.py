"""Near copies by shingles: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from MinHash: 20 bands of 4 minima, so that a pair at similarity 0.8 shares no band with a probability
of 0.00003 and one above it with less. The members of a band are held against a few leaders only; of similar ones the later
goes, the leaders have been held against all others and leave the group, and the rest do it again with eight times as
many. A group of copies so ends with the first round, at a pair a member. What is left after eight leaders is
unlike texts that share a passage, and the band says too little: these are grouped anew by the rarest of their shingles.
Shingles are looked at in one order, those that many texts share last. If two sets' similarity is 0.8, at most a ninth of the
smaller one's shingles and a fifth of the larger one's are not in the other, so one of the smaller one's first ninth, and one
more, is among the larger one's first fifth, and one more. A passage that many texts share is among neither, unless it is
most of the text. Only pairs are compared of which one has the group's shingle in its first ninth. The new groups begin
with one leader.

A pair is first compared by its 80 minima; the sets of only those that may be similar are joined and compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import drop_table, fresh, materialize, may_be_among, without, word_blocks, worker_state

SEED = 42
WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 4
#: Leaders of a group in the first round, how many times as many the next has, and the most before groups are formed anew.
LEADERS, MORE, MOST = 1, 8, 8
#: Share of equal minima below which a pair is not looked at: 4.5 standard deviations below that of a similarity of 0.8.
LIKELY = 0.6

_MULT = np.random.default_rng(5).integers(1, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(6).integers(1, 2**63, (1, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(data: bytes | None, width: int = WIDTH) -> np.ndarray:
    """The distinct hashes of one UTF-8 text's shingles, A-Z lower-cased; fewer words than width are one shingle."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    parts, carry = [], []
    for words in word_blocks((data or b"").lower()):
        words = carry + words
        if len(words) >= width:
            parts.append(np.unique(np.array([digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(width)), strict=False)], dtype=np.uint64)))
        carry = words[-(width - 1) :]
    if not parts:
        return np.array([digest(b" ".join(carry), SEED)] if carry else [], dtype=np.uint64)
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least of the hashes by each of BANDS * ROWS orders."""
    least = np.full(BANDS * ROWS, 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        x = hashes[None, at : at + 4096] * _MULT
        least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=1))
    return least


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One number a band, the band itself mixed in; none for a text without words."""
    if not len(hashes):
        return hashes.view(np.int64)
    mixed = (minima(hashes).reshape(BANDS, ROWS) * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[0, 0]
    return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _bands(text: Column) -> Column:
    @F.arrow_udf("array<bigint>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state("shingles", dict)  # what an earlier operator has left goes
        for batch in batches:
            yield pa.array([band_keys(shingle_hashes(x.as_py())) for x in batch], pa.list_(pa.int64()))

    return run(text.cast("binary"))


def _signed(text: Column) -> Column:
    """struct(hashes, sketch): a text's set of shingles and the low 32 bits of its minima."""

    @F.arrow_udf("hashes array<bigint>, sketch array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker_state("shingles", dict)
        for batch in batches:
            sets = [shingle_hashes(x.as_py()) for x in batch]
            sketches = pa.array([minima(x).astype(np.uint32).view(np.int32) for x in sets], pa.list_(pa.int32()))
            yield pa.StructArray.from_arrays([pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64())), sketches], ["hashes", "sketch"])

    return run(text.cast("binary"))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """node: the later one of each pair (first, node) that is similar enough. Sets of other documents stay where they are."""
    of = lambda pairs, side: may_be_among(sets, F.col("node.h"), pairs.select(f"{side}.h"))
    met = lambda pairs, column: pairs.join(of(pairs, "first").select(F.col("node").alias("first"), F.col(column).alias("x")), "first").join(of(pairs, "node").select("node", F.col(column).alias("y")), "node")
    alike = F.size(F.filter(F.zip_with("x", "y", lambda a, b: a == b), lambda e: e))
    likely = materialize(met(pairs, "sketch").filter(alike >= LIKELY / SIMILARITY * similarity * BANDS * ROWS).select("first", "node"), "likely")
    common = F.size(F.array_intersect("x", "y"))
    alike = common >= F.lit(similarity) * (F.size("x") + F.size("y") - common)
    gone = materialize(met(likely, "hashes").filter(alike).select("node").distinct(), "copies")
    drop_table(likely)
    return gone


#: Documents, and the shingles of one at most, by which it is told what is common; how many of them a common shingle is in.
SAMPLE, SAMPLE_SIZE, COMMON = 512, 8192, 4


def _common_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of a bounded sample of documents have, in order, and how many of these."""
    some = sets.filter(F.col("size") <= SAMPLE_SIZE).orderBy(F.xxhash64("node")).limit(SAMPLE)
    found = some.select(F.explode("hashes").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= COMMON).orderBy("t").toArrow()
    return found.column("t").to_numpy(), found.column("n").to_numpy()


def rarest(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The first n of a set's shingles: those that are not common, by their hash, then the others, the least common first. In
    whatever order shingles are looked at, it is the same for all sets, and no pair is lost by it; this one keeps what many
    texts share for last."""
    often = np.zeros(len(hashes), dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        often = np.where(common[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, often))[:n]]


def _by_rare_shingles(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """band, node, size, short: a row for each shingle that is among the rarest of a document; short: among so few of them that
    it must be looked at where the other document is no smaller."""
    mine = nodes.join(may_be_among(sets, F.col("node.h"), nodes.select("node.h")), "node")
    common, counts = _common_shingles(mine)
    shared = sets.sparkSession.sparkContext.broadcast((common, counts))
    long, short = ((lambda n, t=t: n - int(np.ceil(t * n - 1e-9)) + 1) for t in (similarity, 2 * similarity / (1 + similarity)))

    @F.arrow_udf("array<struct<band:bigint,short:boolean>>")
    def first(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for x in batch:
                h = x.values.to_numpy()
                out.append([{"band": t, "short": k < short(len(h))} for k, t in enumerate(rarest(h, *shared.value, long(len(h))).tolist())])
            yield pa.array(out, pa.list_(pa.struct([("band", pa.int64()), ("short", pa.bool_())])))

    found = mine.select("node", "size", F.explode(first("hashes")).alias("x"))
    return found.select("x.band", "node", "size", "x.short")


def _round(groups: DataFrame, sets: DataFrame, leaders: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """What goes (node), and the groups (band, node, size, short) as they are after it. Pairs of which neither is short are not
    compared. In groups of few short members all other pairs are, and the group is done."""
    small = 2 * leaders + 1
    # bands with the same members are one group: copies share all of theirs
    same = groups.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.count_if("short").alias("s"), *[F.bit_xor(F.xxhash64("node", "short", F.lit(k))).alias(f"m{k}") for k in range(2)])
    sizes = materialize(same.filter("n > 1 and s > 0").groupBy("n", "s", "m0", "m1").agg(F.min("band").alias("band")).select("band", "s"), "sizes")
    few, many = (groups.join(sizes.filter(of).select("band"), "band") for of in (f"s <= {small}", f"s > {small}"))
    first = many.filter("short").groupBy("band", F.pmod("node.h", F.lit(leaders)).alias("part")).agg(F.min(F.struct("node", "size")).alias("least"))
    first = materialize(first.select("band", F.col("least.node").alias("leader"), F.col("least.size").alias("leader_size")), "leaders")
    # of sets whose sizes differ by more no pair can be similar enough: such pairs need no look at the sets
    close = F.least("leader_size", "size") >= F.lit(similarity) * F.greatest("leader_size", "size")
    all_of = few.filter("short").select("band", F.col("node").alias("leader"), F.col("size").alias("leader_size")).join(few, "band").filter("leader < node or leader > node and not short")
    met = many.join(first, "band").filter("leader <> node").select("band", "leader", "leader_size", "node", "size").unionByName(all_of.drop("short"))
    pairs = materialize(met.filter(close).select(F.least("leader", "node").alias("first"), F.greatest("leader", "node").alias("node")).distinct(), "pairs")
    gone = _verified(pairs, sets, similarity)
    left = many.join(first.select("band", F.col("leader").alias("node")), ["band", "node"], "left_anti").join(gone, "node", "left_anti")
    left = materialize(left.select("band", "node", "size", "short"), "groups")
    for done in (sizes, first, pairs):
        drop_table(done)
    return gone, left


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, leaders: int = LEADERS, most: int = MOST) -> DataFrame:
    """docs of which no two are near copies. A document goes only if it is a near copy of one that comes before it, by
    doc_id (null ids last) and then by a hash of the text; that one may go as well, so that in a chain (B like A, C like
    B) C may go though it is unlike A, and may stay once B has gone.

    Rows equal in id and text stay or go together; texts without words stay. Columns are kept as they are, whatever their
    names; an empty table gives an empty one. leaders: of the first round; most: after how many groups are formed anew."""
    h, ident = fresh(docs, "h", "ident")
    named = lambda df: F.struct(df[f"`{doc_id}`"].isNull().alias("nameless"), df[f"`{doc_id}`"].alias("id"), F.xxhash64(df[f"`{text}`"]).alias("h"))
    src = docs.select(named(docs).alias("node"), F.col(f"`{text}`").alias("t"))
    bands = materialize(src.select("node", F.explode(_bands(F.col("t"))).alias("band")), "bands")
    met = materialize(bands.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("band"), "met")
    groups = materialize(may_be_among(bands, F.col("band"), met).join(met, "band").distinct(), "groups")
    for done in (bands, met):
        drop_table(done)
    members = groups.select(F.col("node.h").alias("h"), F.col("node").alias("member")).distinct()
    some = may_be_among(src, F.col("node.h"), groups.select("node.h"))
    texts = some.join(members, (F.xxhash64("t") == F.col("h")) & F.col("node").eqNullSafe(F.col("member"))).dropDuplicates(["node"])
    sets = materialize(texts.select("node", _signed(F.col("t")).alias("s")).select("node", F.size("s.hashes").alias("size"), "s.hashes", "s.sketch"), "sets")
    sized = materialize(groups.join(sets.select("node", "size"), "node").select("band", "node", "size", F.lit(True).alias("short")), "groups")
    drop_table(groups)
    groups, gone, by_rare = sized, [], False
    while not groups.isEmpty():
        if leaders > most and not by_rare:
            by_rare, leaders = True, LEADERS
            met = groups.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            nodes = materialize(groups.join(met, "band", "left_semi").select("node").distinct(), "nodes")
            rest = materialize(_by_rare_shingles(nodes, sets, similarity), "groups")
            drop_table(nodes)
        else:
            out, rest = _round(groups, sets, leaders, similarity)
            gone.append(out)
            leaders *= MORE
        drop_table(groups)
        groups = rest
    for done in (sets, groups):
        drop_table(done)
    if not gone:
        return docs
    out = materialize(reduce(DataFrame.unionByName, gone).select(F.col("node.id").alias(ident), F.col("node.h").alias(h)).distinct(), "gone")
    return without(docs, F.xxhash64(docs[f"`{text}`"]), out, h, docs[f"`{doc_id}`"].eqNullSafe(out[ident]))
