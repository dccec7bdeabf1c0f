"""The eliminations for groups of any size against plain loops, and on a large group."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.operators import dedup, neardup
from siftstone.shared import Steps


def fold(rows, near):
    kept = []
    for o, x in sorted(rows, key=lambda r: r[0]):
        if x is None or not any(k is not None and near(k, x) for _, k in kept):
            kept.append((o, x))
    return {o for o, _ in kept}


def hashes(rnd, n):
    centres = [rnd.getrandbits(63) for _ in range(max(2, n // 20))]
    return [None if rnd.random() < 0.02 else rnd.choice(centres) ^ sum(1 << b for b in rnd.sample(range(63), rnd.choice([0, 1, 3, 4, 5, 9]))) for _ in range(n)]


@pytest.mark.parametrize("head", [1, 8, 1000])
def test_hash_rounds_equal_the_fold(spark, head):
    rnd = random.Random(head)
    rows = [(p, o, h) for p, n in (("a", 400), ("b", 30), ("c", 1)) for o, h in enumerate(hashes(rnd, n))] + [(None, 0, 5), (None, 1, 5), ("d", 3, None)]
    df = spark.createDataFrame(rows, "poi string, ord int, phash long").withColumn("x", F.lit("clash"))
    got = {tuple(r) for r in neardup.hash_dedup(df, head=head).collect()}
    want = {(p, o) for p in "abcd" for o in fold([(o, h) for q, o, h in rows if q == p], lambda a, b: (a ^ b).bit_count() < 8)}
    assert got == want | {(None, 0), (None, 1)}
    assert neardup.hash_dedup(df.limit(0), head=head).count() == 0


def test_hash_rounds_equal_the_arrays_at_each_distance(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([("a", o, h) for o, h in enumerate(hashes(rnd, 200))], "poi string, ord int, phash long")
    for distance in (0, 1, 4, 8):
        assert {tuple(r) for r in neardup.hash_dedup(df, distance=distance, head=4).collect()} == {tuple(r) for r in dedup.hash_dedup(df, distance=distance).collect()}
    with pytest.raises(ValueError, match="8"):
        neardup.hash_dedup(df, distance=9)


def test_a_chain_takes_rounds(spark):
    links = spark.createDataFrame([("a", k, k + 1) for k in range(9)] + [("b", 0, 5), ("b", 0, 6), ("b", 5, 7), ("b", 6, 8), ("b", 5, 6)], "poi string, u int, v int")
    with Steps(spark) as steps:
        gone = {tuple(r) for r in neardup.first_independent(steps, links).collect()}
    assert gone == {("a", k) for k in range(1, 10, 2)} | {("b", 5), ("b", 6)}


@pytest.mark.parametrize("head", [1, 8, 1000])
@pytest.mark.parametrize("similarity", [0.3, 0.89])
def test_vector_rounds_equal_the_fold(spark, head, similarity, monkeypatch):
    monkeypatch.setattr(neardup, "CELLS", 6)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = np.random.default_rng(head)
    rows = []
    for p, n in (("a", 150), ("b", 20)):
        centres = rng.normal(size=(10, 12))
        rows += [(p, o, None if rng.random() < 0.03 else (centres[rng.integers(10)] + rng.normal(size=12) * rng.choice([0, 0.2, 0.6])).tolist()) for o in range(n)]
    rows += [("c", 0, []), ("c", 1, None), (None, 0, [1.0] * 12), ("c", 2, [0.0] * 12), ("c", 3, [1.0] * 12)]
    df = spark.createDataFrame(rows, "poi string, ord int, embedding array<double>")
    got = {(r["poi"], r["ord"]): r["pos"] for r in neardup.embedding_dedup(df, similarity=similarity, head=head).collect()}

    def near(a, b):
        a, b = np.array(a), np.array(b)
        return a @ b / np.sqrt((a @ a) * (b @ b)) >= similarity

    for p in "ab":
        own = [(o, x) for q, o, x in rows if q == p]
        kept = fold(own, near)
        assert {o for q, o in got if q == p} == kept
        order = sorted(kept, key=lambda o: (dict(own)[o] is None, o))
        assert [got[p, o] for o in order] == list(range(len(order)))
    assert {o for q, o in got if q == "c"} == {0, 1, 2, 3} and (None, 0) in got


def test_a_group_of_a_hundred_thousand(spark):
    # 100,000 rows of one group: a third are copies, a third near copies of 40 pictures, a third unlike each other
    k = F.col("id")
    centre = F.xxhash64(F.pmod(k, F.lit(40)))
    flip = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(k), F.lit(63)).cast("int"))
    h = F.when(k % 3 == 0, F.lit(77).cast("long")).when(k % 3 == 1, centre.bitwiseXOR(flip)).otherwise(F.xxhash64(k))
    df = spark.range(100_000).select(F.lit("a").alias("poi"), k.alias("ord"), h.alias("phash"))
    rows = [(r["ord"], r["phash"]) for r in df.collect()]
    got = {r["ord"] for r in neardup.hash_dedup(df).select("ord").collect()}
    signed = np.array([x for _, x in rows], dtype=np.int64).view(np.uint64)
    kept, at = np.empty(len(rows), dtype=np.uint64), []
    for o, x in enumerate(signed):
        if not at or np.bitwise_count(kept[: len(at)] ^ x).min() >= 8:
            kept[len(at)] = x
            at.append(o)
    assert got == set(at)


def test_quotas_of_a_large_group(spark):
    """One group of 60,000 entries in a dozen tabs, of which many URLs repeat within and across tabs."""
    rnd = random.Random(6)
    rows = [("p", k, rnd.choice(["All", *(f"t{j}" for j in range(11))]), f"u{rnd.randrange(400)}" if k % 3 else f"v{k}") for k in range(60_000)] + [("q", k, "All", "same") for k in range(500)] + [("r", k, "t1", None) for k in range(4)]
    df = spark.createDataFrame(rows, "poi string, ord int, category string, url string").repartition(4)
    for quotas in ((30, 10, 200), (3, 2, 15), (5, 50, 60)):
        want = []
        for p in "pqr":
            kept, of = [], {}
            for q, o, t, u in rows:
                if q == p and len(kept) < quotas[2] and of.get(t, 0) < (quotas[0] if t == "All" else quotas[1]) and (u is None or all(x[2] != u for x in kept)):
                    kept.append((p, o, u, t))
                    of[t] = of.get(t, 0) + 1
            want += kept
        assert sorted(tuple(r) for r in dedup.quota_across_tabs(df, first_quota=quotas[0], quota=quotas[1], cap=quotas[2]).collect()) == sorted(want)


def test_vectors_of_a_group_of_twenty_thousand(spark):
    """Half the rows are near copies of 3,000 vectors, so that many a cluster begins beyond the head."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(20_000, 24))
    x[10_000:] = x[rng.integers(0, 3000, 10_000)] + 0.1 * rng.normal(size=(10_000, 24))
    x = x[rng.permutation(len(x))]
    df = spark.createDataFrame([("p", k, v.tolist()) for k, v in enumerate(x)], "poi string, ord int, embedding array<double>").repartition(8)
    got = {r["ord"] for r in neardup.embedding_dedup(df).select("ord").collect()}
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    kept, at = np.empty_like(u), []
    for k, v in enumerate(u):
        if not at or (kept[: len(at)] @ v).max() < 0.89:
            kept[len(at)] = v
            at.append(k)
    assert got == set(at) and len(at) < 15_000
