"""Filter audit, decontamination and ranked search against brute force and on odd, empty and large inputs."""

import itertools
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from siftstone.llm import audit, common, decontam, lexical, shingles, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("n", "words", "term", "block", "tf", "digest", "part", "good", "toxic", "item", "counts", "bucket", "known", "word", "h", "c", "d")


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASH if c not in df.columns})


# --- filter audit ----------------------------------------------------------------------------------------------------


def brute_audit(docs, labels):
    first, marks = {}, {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    for d, q, x in labels:
        good, toxic = marks.get(d, (False, False))
        if d is not None:
            marks[d] = (good or q == 1, toxic or x == 1)
    rows = []
    for d, t, lang in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, yes in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search("[#$%&*|]", t)), d is not None and d > first[t]), strict=True) if yes}
        rows.append((lang or "", fails, *marks.get(d, (False, False))))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        removed = {f: 0 for f in "ABCDE"}
        table = []
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                here = [r for r in own if f in r[1] and not r[1] & before]
                removed[f] += len(here)
                table.append((part, "".join(order), k + 1, sum(not r[1] & (before | {f}) for r in own), len(here), sum(f in r[1] and bool(r[1] & before) for r in own), sum(r[1] == {f} for r in own), sum(r[2] for r in here), sum(r[3] for r in here)))
        out += [(*t, removed[t[1][t[2] - 1]]) for t in table]
    return sorted(out)


def test_audit_equals_brute_force(spark):
    rnd = random.Random(1)
    text = lambda: " ".join(rnd.choice(["word", "Two", "THREE", "fo#ur", "five", "é", "ÄÖ"]) + str(rnd.randrange(rnd.choice([5, 500]))) for _ in range(rnd.choice([3, 99, 100, 150])))
    pool = [text() for _ in range(30)] + ["", None, " \t\n", "Ünï \x0b x", "A" * 5000 + " b" * 3000]
    docs = [(rnd.choice([None, *range(60)]), rnd.choice(pool), rnd.choice([None, "en", "de", ""])) for _ in range(200)]
    docs += [docs[0]] * 5 + [(3, "same", "en"), (3, "same", "de"), (None, "same", "en"), (9, "same", "en")]
    labels = [(rnd.choice([None, *range(60)]), rnd.choice([None, 0, 1]), rnd.choice([None, 0, 1])) for _ in range(60)]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    lf = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    got = sorted(tuple(r) for r in audit.audit(df, lf).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())
    assert got == brute_audit(docs, labels)
    assert audit.audit(df.limit(0), lf).count() == 0 and audit.audit(df, lf.limit(0)).count() == len(got)


# --- decontamination -------------------------------------------------------------------------------------------------


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(docs, items, width):
    windows = []
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        windows += [(i, tuple(w[k : k + n])) for k in range(len(w) - n + 1) if n]
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, x in windows:
            for k in range(len(w) - len(x) + 1):
                if tuple(w[k : k + len(x)]) == x:
                    hit.update(range(k, k + len(x)))
                    found.add(i)
        out.append((d, len(w), len(hit), sorted(found - {None})))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1, 40, 10**6])
def test_windows_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(decontam, "_TRIED", 7)
    rnd = random.Random(block)
    word = lambda: rnd.choice(["a", "b", "c", "Äh", "x1", "ß"])
    said = lambda n: rnd.choice([" ", "-", " .\x7f"]).join(word() for _ in range(n))
    items = [(k, said(rnd.choice([1, 2, 4, 5, 9]))) for k in range(12)] + [(None, "a b c"), (50, None), (51, ""), (52, "?!"), (3, "zzz"), (3, "x1 x1 x1"), (53, "zzz a"), (54, "b " * 9)]
    docs = [(k, said(rnd.choice([0, 1, 3, 5, 30, 200]))) for k in range(40)] + [(None, "a b c a b c"), (7, None), (7, ""), (8, items[4][1]), (8, items[4][1].upper()), (9, "b " * 50), (60, "a"), (60, "b")]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    bench = clashing(spark.createDataFrame(items, "item_id long, text string"))
    found = decontam.index(df, block=block)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in decontam.contaminated(found, decontam.prepare(found, bench, 5), 5).collect()]
    assert sorted(got, key=repr) == brute_hits(docs, items, 5)
    none = decontam.contaminated(found, decontam.prepare(found, bench.limit(0), 5), 5)
    assert none.count() == len(docs) and none.filter("n_hit > 0").count() == 0
    empty = decontam.index(df.limit(0))
    assert decontam.contaminated(empty, decontam.prepare(empty, bench, 5), 5).count() == 0


@pytest.mark.parametrize("block", [1, 10**6])
def test_near_equals_brute_force(spark, block):
    rnd = random.Random(2)
    docs = [(k, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.choice([2, 20, 60])))) for k in range(40)] + [(None, "a b"), (5, None)]
    items = [(1, "a b c"), (2, "h g"), (3, "d"), (4, "a zzz"), (5, "a a b"), (6, None)]
    found = decontam.index(spark.createDataFrame(docs, "doc_id long, text string"), block=block)
    count = {}
    for _, t in docs:
        for w in words(t):
            count[w] = count.get(w, 0) + 1
    for within in (1, 3, 6):
        got = sorted((tuple(r) for r in decontam.near(found, decontam.prepare(found, spark.createDataFrame(items, "item_id long, text string"), None), within).collect()), key=repr)
        want = []
        for (d, t), (i, q) in itertools.product(docs, items):
            w, terms = words(t), list(dict.fromkeys(words(q)))
            if not terms or any(x not in count for x in terms):
                continue
            rare = min(terms, key=lambda x: count[x])
            n = sum(x == rare and any(lo <= p < lo + within and set(terms) <= set(w[max(0, lo) : lo + within]) for lo in range(p - within + 1, p + 1)) for p, x in enumerate(w))
            if n:
                want.append((d, i, n))
        assert got == sorted(want, key=repr)


def test_words_across_pieces(monkeypatch):
    text = ("Ab-c" * 50 + " " + "é" * 40 + "x" * 100 + " end").encode()
    whole = [w for ws in decontam.words_of(text) for w in ws]
    monkeypatch.setattr(decontam, "_PIECE", 7)
    assert [w for ws in decontam.words_of(text) for w in ws] == whole == [w.encode() for w in words(text.decode())]


# --- ranked search ---------------------------------------------------------------------------------------------------


def brute_search(docs, items, k):
    counts, asked = {}, {}
    for d, t in docs:
        for w in words(t):
            own = counts.setdefault(d, {})
            own[w] = own.get(w, 0) + 1
    n, total = len(counts), sum(sum(c.values()) for c in counts.values())
    df = {}
    for c in counts.values():
        for w in c:
            df[w] = df.get(w, 0) + 1
    for i, t in items:
        asked.setdefault(i, []).extend(words(t))
    out = []
    for i, terms in asked.items():
        scores = {}
        for d, c in counts.items():
            m = 25 + 75 * sum(c.values()) * n // total
            scores[d] = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1000000000 * c[w] // (1000 * c[w] + 8 * m)) for w in terms if w in c)
        best = sorted((d for d in scores if scores[d] > 0), key=lambda d: (-scores[d], d is not None, d))[:k]
        out += [(i, r + 1, d, scores[d]) for r, d in enumerate(best)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("all_terms", [True, False])
def test_search_equals_brute_force(spark, all_terms):
    rnd = random.Random(4)
    word = lambda: rnd.choice(["the", "The", "É", "é", "a1", "zwölf", *(f"w{k}" for k in range(30))])
    docs = [(k, ", ".join(word() for _ in range(rnd.choice([1, 5, 40, 300])))) for k in range(60)]
    docs += [(70, "w1 w2"), (71, "w1 w2"), (72, "w1 w2"), (None, "w1 w3"), (None, "w5"), (5, "w1"), (80, None), (81, ""), (82, "!?"), (83, "x" * 3000)]
    items = [(k, " ".join(word() for _ in range(rnd.choice([1, 3, 12])))) for k in range(10)] + [(11, "w1 w2 w1"), (12, None), (13, "nowhere"), (14, "the " * 5), (3, "w9"), (None, "w5 w3")]
    df, bench = clashing(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)), clashing(spark.createDataFrame(items, "item_id long, text string"))
    asked = lexical.item_terms(bench)
    found = lexical.index(df, None if all_terms else asked.select("term").distinct(), buckets=4)
    for k in (1, 3, 10):
        assert sorted((tuple(r) for r in lexical.search(found, asked, k).select("item_id", "rank", "doc_id", "score").collect()), key=repr) == brute_search(docs, items, k)
    assert lexical.search(found, asked.limit(0)).count() == 0
    empty = lexical.index(df.limit(0))
    assert lexical.search(empty, asked).count() == 0 and empty.documents == 0
    if all_terms:
        got = {(r["doc_id"], r["term"]): r["tf"] for r in found.postings.collect()}
        assert got[(70, "w1")] == 1 and (83, "x" * 3000) in got and found.terms == sum(got.values())


# --- near copies beyond leaders --------------------------------------------------------------------------------------


def shingle_set(t):
    w = (t or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def passages(n, seed):
    """n texts that share half their words, three in a hundred of them near copies of the one before."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    common, rows, last = " ".join(word() for _ in range(60)), [], ""
    for k in range(n):
        last = last + " tail" if k % 33 == 32 else common + " " + " ".join(word() for _ in range(60))
        rows.append((k, last, "en", "s", 0))
    return rows


def test_unlike_texts_that_share_a_passage(spark, monkeypatch):
    counted = []
    own = shingles._verified
    monkeypatch.setattr(shingles, "_verified", lambda pairs, *a: (counted.append(pairs.count()), own(pairs, *a))[1])
    made = {}
    for n in (300, 600):
        counted.clear()
        rows = passages(n, n)
        kept = {r["doc_id"] for r in shingles.keep_one(spark.createDataFrame(rows, DOCS), most=8).collect()}
        assert kept == {k for k in range(n) if k % 33 != 32}
        made[n] = sum(counted)
    assert made[600] < 3 * made[300]  # all pairs would be four times as many


def test_a_chain_of_near_copies(spark):
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(100)]
    rows = [(k, " ".join([f"n{j}" for j in range(k * 8)] + base[k * 8 :]), "en", "s", 0) for k in range(6)]
    sets = [shingle_set(r[1]) for r in rows]
    near = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    assert near(sets[0], sets[1]) and not near(sets[0], sets[3])
    kept = [r["doc_id"] for r in shingles.keep_one(spark.createDataFrame(rows, DOCS)).collect()]
    assert 0 in kept and not any(near(sets[a], sets[b]) for a in kept for b in kept if a < b)
    assert all(any(near(sets[g], sets[e]) for e in range(g)) for g in set(range(6)) - set(kept))


def test_recall_of_near_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = {r["doc_id"] for r in shingles.keep_one(docs).select("doc_id").collect()}
    sets = {r["doc_id"]: shingle_set(r["text"]) for r in docs.collect()}
    ids = sorted(sets)
    by = {}
    for d in ids:
        for s in sets[d]:
            by.setdefault(s, []).append(d)
    near = {}
    for d in ids:
        seen = {}
        for s in sets[d]:
            for e in by[s]:
                if e < d:
                    seen[e] = seen.get(e, 0) + 1
        near[d] = [e for e, n in seen.items() if n >= 0.8 * (len(sets[d]) + len(sets[e]) - n)]
    for d in ids:
        if d in kept:
            assert not [e for e in near[d] if e in kept]
        else:
            assert near[d]
    assert len(kept) < len(ids)


def shuffled(spark):
    """Bytes of shuffle that the session has written."""
    found = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(found.apply(k).totalShuffleWrite() for k in range(found.size()))


def test_texts_without_near_copies_stay_where_they_are(spark):
    rnd = random.Random(5)
    texts = [" ".join(f"{rnd.getrandbits(60):x}" for _ in range(1000)) for _ in range(400)]
    for k in range(200, 220):  # near copies, of which texts and sets must meet
        texts[k] = texts[k - 200] + " tail"
    texts[220] = texts[50]  # and one that SimHash finds
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOCS).repartition(8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every table were large
    try:
        df.write.mode("overwrite").parquet(path := common.fresh_path(spark, "test"))
        docs, before = spark.read.parquet(path), shuffled(spark)
        once = common.materialize(simhash.keep_one(docs), "once")
        kept = {r["doc_id"] for r in shingles.keep_one(once).select("doc_id", "text").collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert kept == set(range(400)) - set(range(200, 221))
    assert shuffled(spark) - before < 0.4 * sum(map(len, texts))


def test_rows_that_may_be_among_keys(spark):
    df = spark.range(20000).select(F.xxhash64("id").alias("k"), "id", F.lit(1).alias("word"), F.lit(2).alias("__word"))
    keys = spark.range(0, 20000, 7).select(F.xxhash64("id").alias("k"))
    among = {r["id"] for r in common.may_be_among(df, F.col("k"), keys).collect()}
    rest = {r["id"] for r in common.may_be_among(df, F.col("k"), keys, "left_anti").collect()}
    assert set(range(0, 20000, 7)) <= among and not among & rest and among | rest == set(range(20000))
    assert len(among) < 2857 + 100
    assert common.may_be_among(df, F.col("k"), keys.limit(0)).count() == 0
    gone = df.filter("id % 7 = 0 and id % 2 = 0").select(F.col("k").alias("h"), F.col("id").alias("gone_id"))
    left = common.without(df.unionByName(df), F.col("k"), gone, "h", F.col("id").eqNullSafe(F.col("gone_id")))
    assert left.columns == df.columns
    assert sorted(r["id"] for r in left.collect()) == sorted([i for i in range(20000) if i % 14] * 2)
