"""The nearest rows of groups of any size against plain loops, and what is left of large groups before links are formed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone import queries
from siftstone.operators import dedup, neardup


@pytest.fixture
def blocks(monkeypatch):
    monkeypatch.setattr(neardup, "SIDE", 40)
    monkeypatch.setattr(neardup, "SLICE", 7)


def vectors(seed, n, dims=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    return [(centres[rng.integers(8)] + rng.normal(size=dims) * rng.choice([0.05, 0.4])).tolist() for _ in range(n)]


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def test_nearest_earlier_equals_a_loop(spark, blocks):
    rows = [(p, o * 3 % 301, x) for p, n in (("a", 300), ("b", 2), ("c", 1)) for o, x in enumerate(vectors(n, n))]
    rows += [("d", 0, [1.0, 0.0]), ("d", 1, [1.0]), ("d", 2, [3.0, 4.0]), ("d", 3, [0.0, 0.0]), ("d", 4, None), ("d", 5, []), ("d", 6, [2.0, None]), (None, 0, [1.0]), (None, 1, [1.0])]
    got = {(r["poi"], r["ord"]): r["nearest"] for r in neardup.nearest_earlier(spark.createDataFrame(rows, "poi string, ord int, embedding array<double>")).collect()}
    want = {("d", 2): 0.6}
    for p in "abc":
        own = [(o, x) for q, o, x in rows if q == p]
        want |= {(p, o): max(cosine(x, y) for k, y in own if k < o) for o, x in own if any(k < o for k, _ in own)}
    assert got == pytest.approx(want)
    assert neardup.nearest_earlier(spark.createDataFrame([], "poi string, ord int, embedding array<double>")).count() == 0


def test_no_group_of_the_nearest_is_in_one_row(spark):
    for name in ("a5_nearest_earlier", "a5_nearest_kept_hash", "a5_nearest_kept_vector"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "collect_list" not in plan, name


def test_hash_log_equals_the_arrays(spark, blocks):
    rnd = random.Random(3)
    rows = [(p, o, None if rnd.random() < 0.03 else rnd.getrandbits(20) | rnd.choice([0, 1 << 63]) - (1 << 63)) for p, n in (("a", 250), ("b", 30), ("c", 1)) for o in range(n)] + [("d", 0, None), ("d", 1, 5), ("d", 2, 5)]
    df = spark.createDataFrame(rows, "p string, o int, h long")
    for distance in (8, 3, 0):
        got = {tuple(r) for r in neardup.hash_log(df, "p", "o", "h", distance, head=8).collect()}
        want = dedup.hash_log(df, "p", "o", "h", distance)
        assert got == {tuple(r) for r in want.collect()} and len(got) == len(rows)
        assert neardup.hash_log(df, "p", "o", "h", distance).dtypes == want.dtypes
    lone = {tuple(r) for r in neardup.hash_log(spark.createDataFrame([(None, 0, 5), (None, 1, 5)], "poi string, ord int, phash long")).collect()}
    assert lone == {(None, 0, None, None, True), (None, 1, None, None, True)}


def test_vector_log_equals_the_arrays(spark, blocks):
    rows = [(p, o, x) for p, n in (("a", 250), ("b", 30), ("c", 1)) for o, x in enumerate(vectors(n + 1, n))]
    rows += [("d", 0, None), ("d", 1, [1.0, 0.0]), ("d", 2, [1.0]), ("d", 3, [2.0, 0.1]), ("d", 4, []), ("d", 5, [2.0])]
    df = spark.createDataFrame(rows, "poi string, ord int, embedding array<double>")
    got = {r["ord"] if r["poi"] == "d" else (r["poi"], r["ord"]): r for r in neardup.embedding_log(df, similarity=0.8, head=8).collect()}
    want = {r["ord"] if r["poi"] == "d" else (r["poi"], r["ord"]): r for r in dedup.embedding_log(df, similarity=0.8).collect()}
    assert {k: (r["matched"], r["kept"]) for k, r in got.items() if k != 2} == {k: (r["matched"], r["kept"]) for k, r in want.items() if k != 2}
    assert {k: r["nearest"] for k, r in got.items()} == pytest.approx({k: r["nearest"] for k, r in want.items()})
    assert got[2]["matched"] is None and got[2]["kept"]  # the arrays name the first row here, though it has no cosine


@pytest.mark.parametrize("head", [8, 600])
def test_hashes_of_few_bits_leave_few_rows_to_link(spark, head, monkeypatch):
    """Two groups of 12,000 rows with hashes of 20 bits: nearly all pairs share a band, and one in eight is near."""
    linked = []
    own = neardup._hash_links

    def links(distance):
        of = own(distance)

        def run(steps, rows):
            linked.append(rows.groupBy("poi").count().agg(F.max("count")).first()[0])
            return of(steps, rows)

        return run

    monkeypatch.setattr(neardup, "_hash_links", links)
    k = F.col("id")
    df = spark.range(24_000).select((k % 2).alias("poi"), k.alias("ord"), F.xxhash64("id").bitwiseAND((1 << 22) - 1).alias("phash"))
    rows = [tuple(r) for r in df.collect()]
    got = {tuple(r) for r in neardup.hash_dedup(df, distance=5, head=head).collect()}
    want = set()
    for p in (0, 1):
        kept = np.zeros(0, dtype=np.uint64)
        for q, o, h in rows:
            if q == p and not (np.bitwise_count(kept ^ np.uint64(h)) < 5).any():
                kept = np.append(kept, np.uint64(h))
                want.add((p, o))
    assert got == want
    assert max(linked, default=0) <= neardup.MANY


def test_bands_are_dealt_by_the_bits_that_differ(spark):
    """Hashes that differ in 24 bits alone: no band may be the same for all rows."""
    from siftstone.shared import Steps

    k = F.col("id")
    df = spark.range(3_000).select(F.lit("a").alias("poi"), k.alias("ord"), F.shiftleft(F.xxhash64("id").bitwiseAND((1 << 24) - 1), 40).alias("x"))
    with Steps(spark) as steps:
        links = neardup._hash_links(5)(steps, df)
        got = {(r["u"], r["v"]) for r in links.select("u", "v").collect()}
    h = np.array([r["x"] for r in df.orderBy("ord").collect()], dtype=np.int64).view(np.uint64)
    u, v = np.nonzero(np.bitwise_count(h[:, None] ^ h[None, :]) < 5)
    assert got == {(a, b) for a, b in zip(u.tolist(), v.tolist(), strict=True) if a < b}


@pytest.mark.parametrize("head", [8, 1000])
def test_vectors_of_other_lengths_are_near_none(spark, head):
    rows = [("a", o, [1.0] * (1 + o % 3)) for o in range(60)]
    df = spark.createDataFrame(rows, "poi string, ord int, embedding array<double>")
    assert {r["ord"] for r in neardup.embedding_dedup(df, head=head).collect()} == {0, 1, 2}
