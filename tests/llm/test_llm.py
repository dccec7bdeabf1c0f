"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and on edge cases:
nulls in any column, empty and very long texts, ties, repeated rows, empty tables, columns with clashing names."""

import hashlib
import base64
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftstone.llm import ann, components, langid, mixing, pii, quality, sentpiece, shingles, simhash, toxicity, urlfilter, warc
from siftstone.llm.common import word_blocks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \t\n", "a", "Ünïcödé ▂ 日本", "x " * 20000, "1 2 3 - !"]


def odd_docs(spark, extra=True):
    rows = [(k, t, None if k % 2 else "en", None if k % 3 == 0 else "s", None) for k, t in enumerate(ODD)] + [(3, "a", "en", "s", 1), (3, "a", "en", "s", 1), (None, "a b c", "en", "s", 5)]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit("clash") for c in ("size", "key", "score", "fp", "root", "h", "t", "w", "stratum", "spans")}) if extra else df


# --- SimHash ---------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_blocks_and_edges():
    rnd = random.Random(1)
    long = " ".join(rnd.choice("alpha beta gamma delta".split()) + str(rnd.randrange(99)) for _ in range(30000))
    for t in (*ODD, "A b", "one two three", long):
        assert simhash.fingerprint_bytes(t.encode() if t is not None else None) == brute_fingerprint(t)
    big = ("word " * 500000).encode()
    assert sum(map(len, word_blocks(big))) == 500000
    assert [w for b in word_blocks(long.encode(), 100) for w in b] == long.encode().split()


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_near_duplicates_equal_brute_force(spark, radius):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(30)]
    fps = base + [b ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for b in base for _ in range(4)] + [0, 0, (1 << 64) - 1]
    # stars: all at 1 bit from their middle and 2 bits from each other
    fps += [m ^ bit for m in base[:4] for bit in (1, 2, 4, 1 << 62, 1 << 63)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp long"), "fp", radius)
    roots = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in parent:
        for b in parent:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert {f: roots.get(f, f) for f in signed} == {f: find(f) for f in signed}


def test_near_duplicates_edges(spark):
    got = simhash.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == len(ODD) + 3
    by = {r["doc_id"]: r for r in got}
    assert by[0]["component_id"] == by[1]["component_id"] == by[2]["component_id"] == 0
    assert simhash.near_duplicates(odd_docs(spark).limit(0)).count() == 0
    kept = simhash.keep_one(odd_docs(spark))
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(3) == 1 and ids.count(None) == 1 and 1 not in ids and "spans" in kept.columns


def test_rows_of_one_id_in_different_groups_stay(spark):
    texts = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcde"]
    rows = [(7, t, "en", "s", 0) for t in texts[:4]] + [(7, texts[0], "en", "s", 0), (3, texts[1], "en", "s", 0), (9, texts[2], "en", "s", 0), (9, texts[4], "en", "s", 0), (None, texts[3], "en", "s", 0), (None, texts[0] + " ", "en", "s", 0)]
    kept = sorted((r["doc_id"], texts.index(r["text"])) for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect())
    assert kept == [(3, 1), (7, 0), (7, 2), (7, 3), (9, 4)]


def test_near_copies_by_shingles(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    rows = []
    for k in range(12):
        base = [word() for _ in range(200)]
        for n in range(6):
            w = list(base)
            for at in rnd.sample(range(200), n):
                w[at] = word()
            rows.append((len(rows), " ".join(w), "en", "s", 0))
    hot = [word() for _ in range(120)]
    for _ in range(40):  # a large group, of which pairs are formed in rounds
        w = list(hot)
        for at in rnd.sample(range(120), 3):
            w[at] = word()
        rows.append((len(rows), " ".join(w), "en", "s", 0))
    rows += [(None, rows[0][1] + " end", "en", "s", 0), (None, "", "en", "s", 0), (999, None, "en", "s", 0), (5000, "a b", "en", "s", 0), (5000, "c d", "en", "s", 0)]

    def shingle(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    near = lambda a, b: bool(a and b) and len(a & b) >= 0.8 * len(a | b)
    df = spark.createDataFrame(rows, DOCS)
    kept = [tuple(r) for r in shingles.keep_one(df, leaders=8).collect()]
    sets = [shingle(r[1]) for r in kept]
    assert not any(near(a, b) for i, a in enumerate(sets) for b in sets[:i])
    gone = [r for r in rows if r not in kept]
    assert len(kept) + len(gone) == len(rows) and (None, rows[0][1] + " end", "en", "s", 0) in gone
    assert all(any(near(shingle(r[1]), shingle(x[1])) for x in rows if x[0] is not None and (r[0] is None or x[0] < r[0])) for r in gone)
    assert {(999, None), (None, ""), (5000, "a b"), (5000, "c d")} <= {r[:2] for r in kept}
    stage = dict(pipeline.STAGES)["near_duplicates"](spark, df, "").collect()
    sets = [shingle(r["text"]) for r in stage]
    assert not any(near(a, b) for i, a in enumerate(sets) for b in sets[:i])
    assert shingles.keep_one(df.limit(0)).count() == 0


# --- SentencePiece ---------------------------------------------------------------------------------------------


def test_encoding_equals_the_library_and_decodes():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    p = sentpiece.load_pieces(MODEL)
    e, d = sentpiece.Encoder(p, remembered=50), sentpiece.Decoder(p)
    rnd = random.Random(3)
    texts = ["", " ", "  a b ", "a\nb", "日本語テキスト" * 90, "a" * 900, "ab" * 700 + "   " * 40, "🙂🙂 x", "The quick brown foxes12345678 jumped!!!!", "\x00\t\r\n"]
    texts += ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 400))) for al in ("ab 日é\n\t.!1", "theanin ", "e t$%.,") for _ in range(150)]
    for t in texts:
        ids = e.encode(t).tolist()
        assert ids == sp.encode(t)
        assert d.decode(ids) == t


def test_streaming_keeps_a_window_and_commits_where_paths_meet(monkeypatch):
    """Blocks of a few characters, cut anywhere; the window stays bounded on runs of any length."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    e = sentpiece.Encoder(sentpiece.load_pieces(MODEL))
    rnd = random.Random(24)
    texts = ["".join(rnd.choice(al) for _ in range(3000)) for al in ("abcdeinrst", "日本語テキスト", "theanin ", "a", "ab\n\U0001f642", "  x")]
    kept = []
    real = e._commit
    monkeypatch.setattr(e, "_commit", lambda *a: kept.append(len(a[1])) or real(*a))
    for t in texts:
        want = sp.encode(t)
        marked = (" " if e.p.prefix else "") + t
        for size in (1, 7, 500):
            blocks = [marked[k : k + size].replace(" ", sentpiece.SPACE) for k in range(0, len(marked), size)]
            assert list(e.stream(blocks)) == want
        monkeypatch.setattr(sentpiece, "BLOCK", 64)
        assert e.encode(t).tolist() == want
        monkeypatch.undo()
        monkeypatch.setattr(e, "_commit", lambda *a: kept.append(len(a[1])) or real(*a))
    assert kept and max(kept) <= 6 * e.p.longest
    committed = []
    monkeypatch.undo()
    blocks = (committed.append(k) or "abcdeinrst"[k % 10] for k in range(4000))
    ids = e.stream(blocks)
    next(ids)
    assert len(committed) < 400  # the first ids come before the text has ended


def test_decoding_refuses_ids_out_of_range():
    d = sentpiece.Decoder(sentpiece.load_pieces(MODEL))
    for ids in ([-1], [5, 10**6]):
        with pytest.raises(ValueError, match="out of range"):
            d.decode(ids)
    assert d.decode([]) == ""


def test_encode_edges(spark):
    got = sentpiece.encode_documents(odd_docs(spark), MODEL)
    rows = got.collect()
    assert len(rows) == len(ODD) + 3 and all(r["round_trip"] for r in rows)
    assert got.limit(0).count() == 0
    ids = odd_docs(spark, False).select(sentpiece.encode(odd_docs(spark), MODEL).alias("ids"), "text")
    back = ids.select("text", sentpiece.decode(ids, MODEL).alias("b")).collect()
    assert all(r["b"] == (r["text"] or "") for r in back)


# --- language identification -------------------------------------------------------------------------------------


def sample_texts(rnd, n):
    pieces = {"aa": ["the", "and", "ing", "ly", "th"], "bb": ["der", "ung", "sch", "keit", "ß"], "cc": ["que", "eau", "ré", "ç", "eux"]}
    return [(" ".join("".join(rnd.choice(pieces[b]) for _ in range(rnd.randint(1, 3))) for _ in range(30)), b) for _ in range(n) for b in pieces]


def test_language_held_out_accuracy_and_edges(spark):
    rnd = random.Random(4)
    model = langid.train(sample_texts(rnd, 40), steps=120)
    who = langid.Labeller(model)
    test = sample_texts(rnd, 30)
    got = who.predict([t for t, _ in test])
    assert np.mean([g[0] == b for g, (_, b) in zip(got, test, strict=True)]) > 0.95
    assert all(0 <= s <= 1 for _, s in got)
    assert who.predict([None, "", "123 !?", "½"]) == [("und", 0.0)] * 4
    rows = langid.identify(odd_docs(spark), model).collect()
    assert len(rows) == len(ODD) + 3 and {r["lang_pred"] for r in rows if r["text"] in (None, "", " \t\n", "1 2 3 - !")} == {"und"}
    assert langid.identify(odd_docs(spark).limit(0), model).count() == 0
    assert langid.train([]).labels == [] and langid.Labeller(langid.train([])).predict(["abc"]) == [("und", 0.0)]


def test_backpropagation_equals_numeric_gradients():
    rng = np.random.default_rng(0)
    net = langid.Net(*(rng.normal(0, 0.5, s) for s in ((9, 257), (9, 3), (2, 3))))
    x = rng.integers(97, 100, (5, 4))
    out, tape = langid._run(net, x, keep=True)
    w = rng.normal(size=(5, 3, 4))
    grads = langid._backward(net, x, tape, w)
    loss = lambda n: float((langid._run(n, x) * w).sum())
    for which in range(2):
        for at in [(0, 97), (4, 98), (8, 99)] if which == 0 else [(0, 0), (4, 2), (8, 1)]:
            moved = [a.copy() for a in net]
            moved[which][at] += 1e-5
            up = loss(langid.Net(*moved))
            moved[which][at] -= 2e-5
            down = loss(langid.Net(*moved))
            assert math.isclose((up - down) / 2e-5, grads[which][at], rel_tol=1e-4, abs_tol=1e-6)


def test_every_position_is_labelled_with_state_from_both_sides():
    """Against a plain pass over the bytes, position by position."""
    rnd = random.Random(14)
    model = langid.train(sample_texts(rnd, 20), steps=30)

    def states(net, data):
        size = net.u.shape[1]
        squash = lambda a: a / (1 + np.abs(a))
        h, out = np.zeros(size), []
        for b in data:
            a, g = net.x[:, b].astype(float), net.u.astype(float) @ h
            z, r = (0.5 * squash(a[k : k + size] + g[k : k + size]) + 0.5 for k in (0, size))
            n = squash(a[2 * size :] + r * g[2 * size :])
            h = n + z * (h - n)
            out.append(h)
        return out

    docs = [t.encode() for t in ("a", "der und the 12 ré!", " ".join(t for t, _ in sample_texts(rnd, 3)))]
    got = [{} for _ in docs]
    for doc, start, p, letters in langid.position_labels(model, docs):
        for b in range(len(doc)):
            for t in range(p.shape[0]):
                if start[b] + t < len(docs[doc[b]]) and t < langid.LENGTH:
                    got[doc[b]][start[b] + t] = (p[t, :, b], letters[t, b])
    for data, found in zip(docs, got, strict=True):
        assert sorted(found) == list(range(len(data)))
        for at in range(0, len(data), langid.LENGTH):  # the bytes of a stretch and AROUND on either side
            end, skip = min(len(data), at + langid.LENGTH), min(at, langid.AROUND)
            f = states(model.forward, data[at - skip : end])[skip:]
            r = states(model.backward, data[at : end + langid.AROUND][::-1])[::-1]
            for k in range(at, end):
                logits = model.forward.o @ f[k - at] + model.backward.o @ r[k - at] + model.bias
                assert np.abs(found[k][0] - np.exp(logits) / np.exp(logits).sum()).max() < 1e-4
                assert found[k][1] == (data[k] >= 128 or chr(data[k]).isalpha())


def test_language_of_many_labels_and_repeated_keys(spark):
    """Every label is learnt from, however many there are; a key that repeats does not swell the sample."""
    rows = [(k % 3 and 7 or None, f"text number {k} " * 20, f"l{k % 80}") for k in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, F.col("doc_id"), rows=400, steps=2)
    assert len(model.labels) == 80
    from siftstone.llm.common import bounded_sample

    for wanted in (80, 400):
        got = bounded_sample(df, F.xxhash64("doc_id", "text"), "lang", wanted)
        assert got.count() <= 2 * wanted and got.select("lang").distinct().count() == 80 and got.columns == df.columns


# --- WARC --------------------------------------------------------------------------------------------------------


def warc_pages(spark, pages, **how):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"body": F.lit("clash"), "key": F.lit("clash"), "part": F.lit("clash")})
    return sorted((tuple(r) for r in warc.read_pages(spark, warc.write(df.repartition(3), **how)).collect()), key=repr)


def brute_warc(pages):
    first = {}
    for k, _, h in pages:
        if k is not None:
            first[h or ""] = min(k, first.get(h or "", k))
    want = []
    for k, _, h in pages:
        b = (h or "").encode()
        f = first.get(h or "")
        response = f is None or k == f
        want.append((k, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", None if response else f))
    return sorted(want, key=repr)


def test_warc_round_trip(spark):
    evil = "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx\r\n\r\n"
    pages = [(1, "u", "é" * 700), (2, None, "é" * 700), (3, "u\r\nX: y", evil), (4, "u", None), (5, "u", ""), (6, "u", "z" * 1001), (7, "u", "z" * 1001), (8, "u", "short"), (8, "u", "short"), (None, "u", "short"), (None, "u", "nameless")]
    for chunk in (500, 3, 1 << 20):
        assert warc_pages(spark, pages, chunk=chunk) == brute_warc(pages)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert warc.read_pages(spark, warc.write(df.limit(0))).count() == 0
    small = {r["page_id"]: r["record_type"] for r in warc.read_pages(spark, warc.write(df.filter("page_id in (1, 2, 8)"), min_bytes=2000)).collect()}
    assert set(small.values()) == {"response"}


def test_warc_rows_that_share_an_id_do_not_meet(spark):
    """Repeated rows, null ids and one id with several payloads, all over the chunk size: one row a page."""
    pages = [(1, "u", "a" * 1001), (1, "v", "a" * 1001), (None, "u", "b" * 1200), (None, "v", "b" * 1200), (2, "u", "c" * 1001), (2, "u", "d" * 2001), (2, "u", "c" * 1001), (3, "u", "d" * 2001), (None, "u", "e" * 2001), (None, "u", "f" * 501)]
    assert warc_pages(spark, pages, chunk=500) == brute_warc(pages)
    many = [(None if k % 2 else 5, "u", "x" * (900 if k % 3 else 20)) for k in range(3000)]
    assert warc_pages(spark, many, chunk=300) == brute_warc(many)
    named = spark.createDataFrame([("a:b\r\n<>", "u", "x" * 40), ("é", "u", "x" * 40), (None, "u", "y")], "page_id string, url string, html string")
    got = {(r["page_id"], r["refers_to"]) for r in warc.read_pages(spark, warc.write(named, chunk=7), "string").collect()}
    assert got == {("a:b\r\n<>", None), ("é", "a:b\r\n<>"), (None, None)}


def test_warc_record_ids_differ_and_damage_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a" * 1001)] * 5 + [(2, "u", "bc" * 700)], "page_id long, url string, html string")
    archive = warc.write(df, path=f"file://{tmp_path}/w", chunk=500)
    rows = warc.read(spark, archive).collect()
    assert len({(r["record_id"], r["chunk_no"]) for r in rows}) == len(rows) == 6 * 3 and len({r["record_id"] for r in rows}) == 6
    bodies = {}
    for r in sorted(rows, key=lambda r: r["chunk_no"]):
        bodies[r["record_id"]] = bodies.get(r["record_id"], b"") + bytes(r["body"])
    assert sorted(bodies.values()) == [b"a" * 1001] * 5 + [b"bc" * 700]
    import glob
    import gzip

    from pyspark.errors import PythonException

    for at in glob.glob(f"{tmp_path}/w/segmented/*.gz"):
        data = gzip.open(at).read()
        with gzip.open(at, "wb") as f:
            f.write(data.replace(b"bcbc", b"cbcb"))
    for at in glob.glob(f"{tmp_path}/w/segmented/.*.crc"):
        import os

        os.remove(at)
    with pytest.raises(PythonException, match="not that of its digest"):
        warc.read_pages(spark, archive).collect()


def test_a_record_goes_on_in_the_next_archive(spark, tmp_path):
    """A payload of many archives: files stay small, its segments are digested across them, and a lost file is noticed."""
    import glob
    import os

    from pyspark.errors import PythonException

    rnd = random.Random(3)
    noise = "".join(chr(rnd.randrange(32, 127)) for _ in range(1 << 20))
    pages = [(1, "u", noise * 8), (2, "u", "short"), (3, "u", noise * 8), (4, "u", noise[:300000] * 3), (5, "u", "é" * 150000), (None, "u", noise * 2)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    archive = warc.write(df, path=f"file://{tmp_path}/w", chunk=1 << 16, archive=1 << 18)
    files = glob.glob(f"{tmp_path}/w/*/*.gz")
    assert len(files) > 30 and max(map(os.path.getsize, files)) < 1 << 18
    got = sorted((tuple(r) for r in warc.read_pages(spark, archive).collect()), key=repr)
    assert got == brute_warc(pages)
    rows = warc.read(spark, archive).filter("page_id = '1'").orderBy("chunk_no").collect()
    assert b"".join(bytes(r["body"]) for r in rows).decode() == noise * 8 and [r["chunk_no"] for r in rows] == list(range(128))
    assert rows[64]["running"] == base64.b32encode(hashlib.sha1((noise * 8).encode()[: 65 << 16]).digest()).decode() and rows[64]["so_far"] == 65 << 16
    os.remove(sorted(glob.glob(f"{tmp_path}/w/segmented/*.gz"))[3])
    with pytest.raises(PythonException, match="segment"):
        warc.read_pages(spark, archive).collect()


def test_chunks_carry_digests(spark):
    df = spark.createDataFrame([(1, bytearray(b"abcdefg")), (2, bytearray(b""))], "id long, body binary")
    rows = warc.chunk_digests(warc.chunks(df, 3).coalesce(1)).collect()
    assert [(r["id"], r["chunk_no"], bytes(r["body"])) for r in rows] == [(1, 0, b"abc"), (1, 1, b"def"), (1, 2, b"g"), (2, 0, b"")]
    assert rows[2]["running"] == hashlib.sha1(b"abcdefg").hexdigest()


# --- mixing ------------------------------------------------------------------------------------------------------


def test_mixing_equals_brute_force(spark):
    rnd = random.Random(6)
    rows = [(k, " ".join("w" * 1 for _ in range(rnd.randint(0, 60))) if k % 17 else None, "en", rnd.choice(["a", "a", "a", "b", "c", "d", None]), 0) for k in range(400)]
    got = {r["doc_id"]: r for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()}
    size = {k: len((t or "").split()) for k, t, *_ in rows}
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, pot = {}, set(names), 1.5 * sum(total.values())
    while True:  # the excess goes to the others by weight until none is above
        share = {s: pot * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * total[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * total[s]
            pot -= target[s]
            free.remove(s)
    for s in names:
        mine = [got[r[0]] for r in rows if r[3] == s]
        assert all(math.isclose(r["target"], target[s], rel_tol=1e-9) and r["source_size"] == total[s] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= 30
        assert all(r["size"] == size[r["doc_id"]] and r["taken"] <= 2 * r["size"] for r in mine)
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(spark.createDataFrame(rows[::-1], DOCS).repartition(7)).collect()}
    assert again == {k: r["taken"] for k, r in got.items()}
    many = mixing.remix(spark.createDataFrame(rows, DOCS)).groupBy("doc_id").count().collect()
    times = {r["doc_id"]: r["count"] for r in many}
    assert all(got[k]["taken"] == size[k] * times.get(k, 0) for k in size)


def test_rates_are_the_optimum_of_the_dual(spark):
    """Against a bisection over every document: rates min(2, exp(lam * size)) that meet the target."""
    rnd = random.Random(16)
    sizes = {s: [int(rnd.paretovariate(1.2) * 5) for _ in range(300)] for s in "abcd"}
    rows = [(s, n, 1) for s, ns in sizes.items() for n in ns]
    hist = spark.createDataFrame(rows, "source string, size long, n long").groupBy("source", "size").agg(F.sum("n").alias("n"))
    want = {"a": 0.2, "b": 1.0, "c": 1.7, "d": 2.0}
    balance = spark.createDataFrame([(s, sum(sizes[s]), want[s] * sum(sizes[s])) for s in sizes], "source string, source_size long, target double")
    got = {r["source"]: r for r in mixing.solve(hist, balance).collect()}
    for s in "abc":
        lo, hi = -5.0, 5.0
        for _ in range(200):
            mid = (lo + hi) / 2
            if sum(n * min(2.0, math.exp(min(50, mid * n))) for n in sizes[s]) < got[s]["target"]:
                lo = mid
            else:
                hi = mid
        assert math.isclose(got[s]["lam"] / got[s]["scale"], lo, rel_tol=1e-3, abs_tol=1e-6)
    assert got["d"]["lam"] is None and got["d"]["limit"] == 2.0
    # a source below its target tilts towards its long documents, one above it towards its short ones
    assert got["a"]["lam"] < 0 and abs(got["b"]["lam"]) < 1e-6 < got["c"]["lam"]


def test_mixing_splits_equal_rows(spark):
    rows = [(1, "w " * 20, "en", "s", 0)] * 300 + [(None, "x " * 20, "en", "t", 0)] * 300 + [(k, "y " * 9, "en", "u", 0) for k in range(200)]
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    for weights in ((5, 2, 1), (1, 9, 9)):
        got = mixing.mix(df, weights=weights).collect()
        for s in {r["target"] for r in got}:
            assert abs(sum(r["taken"] for r in got if r["target"] == s) - sum({(r["target"], r["source_size"]) for r in got if r["target"] == s}.pop()[:1])) <= 20
        assert all(r["taken"] <= 2 * r["size"] for r in got)
    kept = mixing.remix(spark.createDataFrame(rows, DOCS), weights=weights).groupBy("source").count().collect()
    assert sum(r["count"] * (9 if r["source"] == "u" else 20) for r in kept) == sum(r["taken"] for r in got)


def test_mixing_refines_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FEW", 3)
    rows = [(k // 40, "w " * (1 + k // 40 % 7), "en", "ab"[k % 2], 0) for k in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    for t in {r["target"] for r in got}:
        assert abs(sum(r["taken"] for r in got if r["target"] == t) - t) <= 7


def test_mixing_edges(spark):
    got = mixing.mix(odd_docs(spark)).collect()
    assert len(got) == len(ODD) + 3
    assert mixing.mix(odd_docs(spark).limit(0)).count() == 0
    zero = spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], DOCS)
    assert [(r["target"], r["taken"]) for r in mixing.mix(zero).collect()] == [(0.0, 0), (0.0, 0)]
    assert set(mixing.remix(odd_docs(spark)).columns) == set(odd_docs(spark).columns)


@pytest.mark.parametrize("cap", [1, 3, 5])
def test_mixing_with_another_cap(spark, cap):
    rnd = random.Random(40)
    rows = [(k, "w " * rnd.choice([0, 1, 5, 30, 200]), "en", rnd.choice(["a", "a", "a", "a", "b", "b", "c", None]), 0) for k in range(900)]
    df = spark.createDataFrame(rows, DOCS)
    share = 0.9 if cap == 1 else 1.5
    got = sorted(mixing.mix(df, cap=cap, share=share).collect(), key=lambda r: r["doc_id"])
    by = {}
    for r, (_, _, _, s, _) in zip(got, rows, strict=True):
        assert r["taken"] <= cap * r["size"] and r["target"] <= cap * r["source_size"]
        x = by.setdefault(s, [r["target"], 0, 0])
        x[1], x[2] = x[1] + r["taken"], max(x[2], r["size"])
    assert all(abs(taken - target) <= most for target, taken, most in by.values())
    assert math.isclose(sum(x[0] for x in by.values()), share * sum(r["size"] for r in got), rel_tol=1e-9)
    times = {}
    for r in mixing.remix(df, cap=cap, share=share).collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert {r["doc_id"]: times.get(r["doc_id"], 0) * r["size"] for r in got} == {r["doc_id"]: r["taken"] for r in got}
    with pytest.raises(ValueError, match="whole"):
        mixing.mix(df, cap=2.5)


def test_every_label_is_met(spark):
    from siftstone.llm.common import bounded_sample

    df = spark.range(30_000).selectExpr("id as doc_id", "concat('l', case when id % 3 = 0 then 0 else id % 3000 end) as lang")
    labels = df.select("lang").distinct().count()
    for wanted in (500, 6000):
        got = bounded_sample(df, F.xxhash64("doc_id"), "lang", wanted)
        assert got.count() <= max(wanted, labels) and got.select("lang").distinct().count() == labels


# --- personal data -----------------------------------------------------------------------------------------------


def brute_spans(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], ("email", "ip", "card", "phone").index(s[0])))


def test_base_spans_equal_the_patterns():
    rnd = random.Random(7)
    for al in ("a@.b-", "12.5 ", "0123456789 -", "+1 (2).3-", "a1@.+ -é"):
        for _ in range(1500):
            t = "".join(rnd.choice(al) for _ in range(rnd.randint(0, 40)))
            assert pii.base_spans(t) == brute_spans(t), t
    assert pii.base_spans("4381893557741609") == [("card", 0, 16)]
    assert pii.base_spans("1" * 200000) == []


def test_terms_that_give_an_entity_away(spark):
    rnd = random.Random(8)
    filler = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    line = lambda n: " ".join(rnd.choice(filler) for _ in range(n))
    rows = [(k, f"{line(5)}\n{rnd.choice(filler)} Quixotle zed@example.org {rnd.choice(filler)} {rnd.choice(filler)}\n{line(5)}") for k in range(12)]
    rows += [(100 + k, f"{line(30)} user{k}@example.org {line(5)}") for k in range(400)]
    got = {r["doc_id"]: r for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string"), rewrite=True).collect()}
    for k, t in rows:
        base = pii.joined(brute_spans(t))
        assert got[k]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and got[k]["n_email"] == 1
        at = t.find("Quixotle")
        assert (f"remove:{at}:{at + 8}" in got[k]["spans"]) == (at >= 0)
        assert "example.org" not in got[k]["text"] and "Quixotle" not in got[k]["text"]
        if at < 0:
            assert got[k]["spans"] == base


def disclosing(spark, rows, **how):
    got = pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string"), settings=pii.Settings(**how)).collect()
    texts = dict(rows)
    return {texts[r["doc_id"]][int(a) : int(b)] for r in got for k, a, b in (x.split(":") for x in r["spans"].split(",") if x) if k in ("remove", "generalise")}


def pii_rows(n_own, n_other, rnd, line="{} Quixotle zed@example.org {}"):
    filler = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(20) for j in range(20)]
    some = lambda n: " ".join(rnd.choice(filler) for _ in range(n))
    rows = [(k, f"{some(9)}\n{line.format(some(1), some(2))}\n{some(9)}") for k in range(n_own)]
    rows += [(5000 + k, some(40)) for k in range(30 * n_own)]
    return rows + [(1000 + k, f"{some(30)} user{k}@example.org {some(5)}") for k in range(n_other)]


@pytest.mark.parametrize("how", [{}, {"told": 0, "part": 2}])
def test_disclosing_terms_by_either_way(spark, how):
    """One entity alone, one that has most mentions, a name in the same line everywhere, and copies."""
    rnd = random.Random(18)
    assert disclosing(spark, pii_rows(12, 0, rnd), **how) == {"Quixotle"}
    assert "Quixotle" in disclosing(spark, pii_rows(100, 30, rnd), **how)
    assert {"Quixotle", "Jane"} <= disclosing(spark, pii_rows(3, 100, rnd, line="Jane Quixotle zed@example.org"), **how)
    assert disclosing(spark, pii_rows(2, 100, rnd), **how) == set()
    once = pii_rows(1, 0, rnd)[0][1]
    near = [(k, once + f" tail{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(40)]
    assert disclosing(spark, near + [(100 + k, once) for k in range(5)], **how) == set()


def brute_measures(texts, s):
    near, total, mentions, everything = {}, {}, {}, 0
    for t in texts:
        terms = [(m.start(), m.group().lower()) for m in re.finditer(r"[^\W\d_]{3,}", t or "")]
        everything += len(terms)
        for _, w in terms:
            total[w] = total.get(w, 0) + 1
        for kind, a, b in brute_spans(t or ""):
            left, right = [x for x in terms if x[0] < a], [x for x in terms if x[0] >= b]
            lines = lambda x: t[min(x[0], a) : max(x[0], b)].count("\n") == 0
            n_left, n_right = len([x for x in left[-s.window :] if lines(x)]), len([x for x in right[: s.window] if lines(x)])
            close = {w for _, w in left[len(left) - n_left :] + right[:n_right]}
            far = [w for _, w in left[: len(left) - n_left][-s.around :] + right[n_right:][: s.around]]
            if close:
                context = min((zlib.crc32(w.encode()) * 2654435761 % (1 << 32) for w in far), default=-1)
                e = (kind, t[a:b].lower())
                for w in close:
                    near.setdefault((w, e), []).append((context, t))
                    mentions[e] = mentions.get(e, 0) + 1
    out = []
    for (w, e), seen in near.items():
        by = {}
        for c, t in seen:
            by.setdefault(c, set()).add(t)
        n = sum(map(len, by.values()))
        if len(by) >= min(s.min_contexts, s.remove_contexts) and max(map(len, by.values())) <= s.most * n:
            p = min(1.0, len(seen) / total[w])
            out.append((w, len(by), len(seen), total[w], mentions[e], p, math.log2(p / (mentions[e] / everything))))
    return sorted(out)


def test_disclosure_equals_brute_force(spark):
    rnd = random.Random(28)
    word = lambda: rnd.choice(["anna", "Berta", "the", "and", "for", "Zoë", "it", "x1", "mail", *(f"w{chr(97 + k)}o" for k in range(20))])
    said = lambda n: " ".join(word() for _ in range(n))
    mails = ["a@b.org", "c@d.org", "10.0.0.1", "+49 30 1234567"]
    texts = [said(rnd.randrange(12)) + rnd.choice(["\n", " ", " " * 500]) + f"anna {rnd.choice(mails)} " + rnd.choice(["\n", "", " " * 700]) + said(rnd.randrange(40)) for _ in range(150)]
    texts += texts[:9] + [None, "", "a@b.org", "anna a@b.org", "q" * 5000 + " a@b.org berta"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string").withColumn("h", F.xxhash64("t"))
    for s in (pii.Settings(), pii.Settings(window=1, around=2, min_contexts=2, remove_contexts=2, most=0.9)):
        got = sorted((r["term"], r["contexts"], r["n"], r["total"], r["mentions"], r["p"], r["bits"]) for r in pii.measures(df, s).collect())
        want = brute_measures(texts, s)
        assert [g[:5] for g in got] == [w[:5] for w in want] and want
        assert all(math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) for g, w in zip(got, want, strict=True) for a, b in zip(g[5:], w[5:], strict=True))


def test_terms_that_run_into_an_entity():
    s = pii.Settings()
    found = lambda t: {c[0] for c in pii.contexts(t, s)}
    assert found("éèàund@x.org nachher") == {"éèà", "nachher"} and found("vor a@b.orgäöü nach") == {"vor", "äöü", "nach"}
    assert found("éund@x.org") == set() and found("name" + " " * 5000 + "a@b.org") == {"name"}


def test_pii_edges(spark):
    got = pii.sanitise(odd_docs(spark))
    assert got.count() == len(ODD) + 3 and pii.sanitise(odd_docs(spark).limit(0)).count() == 0
    assert got.filter("doc_id = 0").first()["base_sha256"] == hashlib.sha256(b"").hexdigest()


# --- nearest neighbours --------------------------------------------------------------------------------------------


def test_walk_is_as_long_as_recall_takes(spark):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(500, 8))
    cell = rng.integers(0, 12, 500).astype(int)
    index = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(m, cell, strict=True))], "vec_id long, v array<double>, cell int").repartition(3)
    ids = np.array([0, 20, 40])
    found = ann.true_cells(index, ids, m[ids], 20)
    s = m @ m.T
    for n, q in enumerate(ids):
        near = [i for i in np.argsort(-s[q]) if i != q][:20]
        assert sorted(c for k, c in found if k == n) == sorted(int(cell[i]) for i in near)
    sizes = np.bincount(cell, minlength=12)
    order = lambda n: [int(c) for c in np.random.default_rng(n).permutation(12)]

    def reached(length):
        hit = 0
        for n, c in found:
            seen = order(n)
            hit += sizes[seen[: seen.index(c)]].sum() < length
        return hit / len(found)

    for recall in (0.5, 0.9, 1.0):
        length = ann.walk_length(found, order, sizes, recall)
        assert reached(length) >= recall > reached(length - 1)
    assert ann.walk_length([], order, sizes, 0.9) == 0


def test_search_by_its_method_on_vectors_with_and_without_structure(spark):
    """What is found comes by the measured walk alone."""
    rng = np.random.default_rng(10)
    settings = ann.Settings(shard=300)
    schema = "vec_id long, embedding array<float>"
    for clustered in (True, False):
        x = rng.normal(size=(2000, 16))
        if clustered:
            x = 0.05 * x + rng.normal(size=(40, 16))[rng.integers(0, 40, 2000)]
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], schema).repartition(5)
        x = x.astype(np.float32).astype(np.float64)
        true = {}
        for q in range(0, 2000, 20):
            s = x @ x[q]
            s[q] = -np.inf
            true[q] = set(np.argsort(-s, kind="stable")[:20].tolist())
        got = {}
        for r in ann.search(df, settings=settings).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        assert np.mean([len(got[q] & true[q]) / 20 for q in true]) >= 0.9
        share = ann.measured_walk(ann.build(df, "vec_id", "embedding", settings), 20, 20, settings) / 2000
        assert share < 0.2 if clustered else share < 0.95


def test_search_with_a_vector_that_a_third_of_the_rows_have(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(900, 8))
    x[300:600] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(20, x[20].tolist()), (20, x[21].tolist())]
    got = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id int, embedding array<double>"), settings=ann.Settings(shard=64, recall=1.0)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 900, 20)) and len(got[20]) == 40
    for q in (0, 300, 320, 880):
        want = sorted(((-float((x[i] * x[q]).sum()), i) for i in range(900) if i != q))[:20]
        near = [(v, s) for _, v, s in sorted(got[q])]
        assert all(math.isclose(-w, s, rel_tol=1e-12) for (w, _), (_, s) in zip(want, near, strict=True))
        if q == 300:
            assert [v for v, _ in near] == [i for _, i in want]


def test_search_is_exact_when_small_and_recalls_when_large(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[5] = x[25]
    rows = [(i, [float(a) for a in v], 0) for i, v in enumerate(x)]
    schema = "vec_id long, embedding array<float>, label int"
    bad = [(5000, None, 0), (5020, [0.0] * 16, 0), (5040, [float("nan")] + [1.0] * 15, 0), (5060, [1.0], 0), (None, [1.0] * 16, 0), (5080, [None] + [1.0] * 15, 0)]
    s = x.astype(np.float64) @ x.astype(np.float64).T

    def truth(q, n):
        order = sorted((i for i in range(n) if i != q), key=lambda i: (-s[q, i], i))
        return order[:20]

    small = {}
    for r in ann.search(spark.createDataFrame(rows[:300] + bad, schema), settings=ann.Settings(recall=1.0)).collect():
        small.setdefault(r["query_id"], {})[r["rank"]] = r
    assert sorted(small) == list(range(0, 300, 20))
    for q, got in small.items():
        assert [got[k]["vec_id"] for k in range(1, 21)] == truth(q, 300)
        assert all(math.isclose(got[k]["score"], s[q, got[k]["vec_id"]], rel_tol=1e-12) for k in got)
    large = {}
    for r in ann.search(spark.createDataFrame(rows, schema)).collect():
        large.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(large[q] & set(truth(q, 3000))) / 20 for q in range(0, 3000, 20)]) >= 0.9
    few = ann.search(spark.createDataFrame(rows[:3], schema)).collect()
    assert len(few) == 2 and ann.search(spark.createDataFrame(bad, schema).filter("vec_id <> 5060")).count() == 0
    assert ann.search(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_query(spark, sf):
    from siftstone.llm.queries import op5_ann

    d = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    got = {}
    for r in op5_ann(spark, d).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    recall = []
    for n in np.flatnonzero(ids % 20 == 0):
        s = (x * x[n]).sum(axis=1)
        order = [m for m in np.lexsort((ids, -s)) if m != n][:20]
        near = sorted(got[ids[n]])
        assert [k for k, _, _ in near] == list(range(1, len(near) + 1)) and all(math.isclose(v, s[np.flatnonzero(ids == i)[0]], rel_tol=1e-12) for _, i, v in near)
        recall.append(len({i for _, i, _ in near} & set(ids[order].tolist())) / 20)
    assert len(recall) == sum(ids % 20 == 0) and np.mean(recall) >= 0.9


# --- quality -------------------------------------------------------------------------------------------------------


def brute_quality(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_equal_brute_force(spark):
    rnd = random.Random(10)
    texts = ODD + ["\n".join(" ".join(rnd.choice("a b c #x é".split()) for _ in range(rnd.randint(0, 7))) for _ in range(rnd.randint(1, 9))) for _ in range(120)]
    df = spark.createDataFrame([(k, t, "en", None, 0) for k, t in enumerate(texts)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.judge(df, none).collect()}
    for k, t in enumerate(texts):
        n, chars, sym, dup, rep = brute_quality(t)
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, sym, dup, rep)
        assert r["base_failed"] == (n < 10 or 100 * rep > 20 * n) and r["kept"] == (not r["base_failed"])
    assert quality.judge(odd_docs(spark), none).count() == len(ODD) + 3 and quality.judge(odd_docs(spark).limit(0), none).count() == 0


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, 0.03) for n in (1, 10, 300, 2000) for k in (0, 1, 5, 40) if k < n * 0.03]
    df = spark.createDataFrame([c[:2] for c in cases], "n long, k long")
    got = [r[0] for r in df.select(quality.log_binomial_tail(F.col("n"), F.col("k"), 0.03)).collect()]
    for (n, k, p), g in zip(cases, got, strict=True):
        assert math.isclose(math.exp(g), sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)), rel_tol=1e-9)


def test_thresholds_need_proof(spark):
    good = [(k, "plain words of some text that goes on and on with ease %d" % k, "en", None, 0) for k in range(6000)]
    junk = [(10000 + k, " ".join(f"w{k}x{i}$$$" for i in range(20)), "en", None, 0) for k in range(5)]
    df = spark.createDataFrame(good + junk, DOCS)
    labels = spark.range(6000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(df, labels).collect()}
    assert all(kept[k] for k in range(6000)) and not any(kept[10000 + k] for k in range(5))
    few = {r["doc_id"]: r["kept"] for r in quality.judge(df, labels.limit(100)).collect()}
    assert all(few.values())


def test_thresholds_of_several_strata(spark):
    good = [(k, "plain words of some text that goes on and on with ease %d" % k, f"l{k % 4}", None, 0) for k in range(2000)]
    junk = [(10000 + k, " ".join(f"w{k}x{i}$$$" for i in range(20)), f"l{k % 4}", None, 0) for k in range(8)]
    labels = spark.range(2000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(good + junk, DOCS), labels).collect()}
    assert all(kept[k] for k in range(2000)) and not any(kept[10000 + k] for k in range(8))


def test_path_goes_where_bad_documents_are():
    sizes = [len(cuts) for _, cuts in quality.RULES.values()]
    steps = quality.path([((3, 0, 0, 0), 10, 1), ((0, 0, 2, 0), 5, 100), ((0, 1, 0, 0), 0, 7)])
    assert len(steps) == sum(sizes) and steps[-1] == (0,) * len(sizes)
    assert all(sum(a) - sum(b) == 1 and all(x >= y for x, y in zip(a, b, strict=True)) for a, b in zip([tuple(sizes), *steps], steps, strict=False))
    reaches = [next(i for i, s in enumerate(steps) if s[r] < lvl) for r, lvl in ((0, 3), (2, 2))]
    assert reaches[0] < reaches[1]


def test_strata_have_their_own_cutoffs_within_the_risk(spark):
    """Good documents with symbols in one language alone; a third has few labels. Of fresh good documents, few go."""
    rnd = random.Random(20)
    words = ["w" + "".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(500)]

    def text(share):
        return " ".join(rnd.choice(words) + ("$" if rnd.random() < share else "") for _ in range(40))

    def rows(n, start):
        return [(start + k, text((0.3 if k % 2 else 0.0) if k % 5 else 0.0), "loud" if k % 2 else "calm", None, 0) for k in range(n)]

    good, fresh = rows(3000, 0), rows(1500, 50000)
    bad = [(100000 + k, text(0.3), ("loud", "calm", "few")[k % 3], None, 0) for k in range(600)]
    few = [(200000 + k, text(0.0), "few", None, 0) for k in range(50)]
    docs = spark.createDataFrame(good + fresh + bad + few, DOCS)
    labels = spark.createDataFrame([(r[0], 1) for r in good + few] + [(r[0], 0) for r in bad[:300]] + [(good[1][0], 1), (None, 1)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, labels).collect()}
    for lang in ("calm", "loud"):
        lost = [not kept[r[0]] for r in fresh if r[2] == lang]
        assert np.mean(lost) <= 0.02
    assert not any(kept[r[0]] for r in bad if r[2] == "calm") and all(kept[r[0]] for r in bad if r[2] != "calm")
    measured = quality.measure(docs)
    marks = labels.selectExpr("doc_id", "quality as good")
    cuts = {r["stratum"]: r for r in quality.cutoffs(measured, marks).collect()}
    assert cuts["calm"]["cut_symbols_per_char"] < (cuts["loud"]["cut_symbols_per_char"] or 1) and "few" not in cuts
    # more strata share the level: each needs more labels for it
    assert quality.cutoffs(measured, marks, risk=0.002).count() < quality.cutoffs(measured, marks, risk=0.01).count()


# --- URLs ----------------------------------------------------------------------------------------------------------


def test_url_rules_and_trees(spark):
    from siftstone.llm.queries import RULES

    urls = [None, "", "no scheme", "http://WWW.Example.COM/en/x?a=1&b#f", "https://example.com/en/1", "https://a.example.com/en/1", "https://example.com", "https://x.net/es/", "https://x.net/esp", "https://net/fr/1", "http://xnet/fr/1", "ftp://h?q=/p", "http://É.org/Ü#x/y"]
    df = spark.createDataFrame([(k, u, "") for k, u in enumerate(urls)] + [(3, urls[3], "")], "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: r for r in urlfilter.judge(df, RULES).collect()}
    for k, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.text), default=None)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, best and best.text)
        assert got[k]["verdict"] == (best.verdict if best else got[k]["verdict"]) in ("allow", "block")
    assert urlfilter.judge(df.limit(0), RULES).count() == 0
    assert got[9]["rule"] == "net/fr/" and got[4]["rule"] == "example.com/en/" and got[3]["rule"] == "www.example.com/en/"


def test_rules_by_a_join_on_hosts(spark):
    rnd = random.Random(22)
    hosts = [".".join(rnd.choice(["a", "b", "ab", ""]) for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    rules = [urlfilter.Rule(rnd.choice(hosts), rnd.choice(["/", "/x", "/x/", ""]), rnd.choice(["allow", "block"])) for _ in range(3000)]
    rows = [(k, rnd.choice(hosts) + rnd.choice(["", ".a", ".b"]), rnd.choice(["", "/", "/x", "/x/y"])) for k in range(300)]
    df = spark.createDataFrame(rows, "k long, host string, path string").withColumn("rank", F.lit("clash"))
    got = {r["k"]: r for r in urlfilter.with_rules(df, rules).collect()}
    assert len(got) == 300
    for k, host, path in rows:
        fit = {r.text for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)}
        assert got[k]["rule"] == min(fit, key=lambda t: (-len(t), t), default=None)
    assert all(r["rule"] is None for r in urlfilter.with_rules(df, []).collect())


def test_expression_equals_the_trees(spark):
    rng = np.random.default_rng(23)
    x = np.round(rng.normal(size=(400, len(urlfilter.FEATURES))), 2)
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] < -0.1)).astype(float)
    start, trees = urlfilter.boost(x, y, trees=12)

    def value(t, row):
        while t.feature >= 0:
            t = t.left if row[t.feature] <= t.cut else t.right
        return t.value

    want = [1 / (1 + math.exp(-(start + sum(value(t, row) for t in trees)))) for row in x]
    df = spark.createDataFrame([(k, *map(float, row)) for k, row in enumerate(x)], ["k", *urlfilter.FEATURES])
    got = {r["k"]: r["p"] for r in df.select("k", urlfilter.expression(start, trees).alias("p")).collect()}
    assert np.allclose([got[k] for k in range(400)], want, atol=1e-12) and np.mean((np.array(want) > 0.5) == (y > 0.5)) > 0.9


def test_suffix_rates_leave_out_the_fold(spark):
    known = spark.createDataFrame([("net", 0, 1), ("net", 0, 1), ("net", 1, 0), ("org", 1, 1)], "suffix string, fold long, y int")
    rates, prior = urlfilter.suffix_rates(known, strength=1.0)
    got = {(r["s"], r["fold"]): r["suffix_rate"] for r in rates.collect()}
    assert prior == 4 / 6
    want = {("net", -1): (2, 3), ("net", 0): (0, 1), ("net", 1): (2, 2), ("org", -1): (1, 1), ("org", 1): (0, 0)}
    assert set(got) == set(want) and all(math.isclose(got[k], (b + prior) / (n + 1)) for k, (b, n) in want.items())


def test_boosting_learns(spark):
    rnd = random.Random(11)
    rows = [(k, f"http://h{k % 7}.org/" + ("a/" * (6 if k % 2 else 1)) + str(rnd.randrange(99))) for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = pages.filter("page_id < 200").selectExpr("url", "cast(page_id % 2 as int) as blocked")
    got = urlfilter.judge(pages, [], marks).collect()
    assert np.mean([(r["verdict"] == "block") == bool(r["page_id"] % 2) for r in got if r["page_id"] >= 200]) > 0.95


def test_unseen_suffixes_and_hosts_are_judged_by_their_features(spark):
    """Labels go by the URL's parameters and lean on its suffix; hosts and a suffix without labels are judged by the former."""
    rnd = random.Random(12)
    rows = []
    for k in range(1500):
        suffix = ("com", "net", "org")[k % 3]
        bad = rnd.random() < (0.75 if suffix == "net" else 0.35 if suffix == "com" else 0.5)
        rows.append((k, f"http://h{k % 37}.{suffix}/p{rnd.randrange(9)}" + (f"?a={rnd.randrange(10**6)}&b={rnd.randrange(10**6)}" if bad else "/page"), int(bad), suffix, k % 37))
    df = spark.createDataFrame(rows, "page_id long, url string, blocked int, suffix string, host int")
    known = df.filter("suffix <> 'org' and host < 25").select("url", "blocked")
    got = {r["page_id"]: r for r in urlfilter.judge(df.select("page_id", "url"), [], known).collect()}
    for part in (lambda r: r[3] == "org", lambda r: r[3] != "org" and r[4] >= 25):
        held = [r for r in rows if part(r)]
        assert np.mean([(got[r[0]]["verdict"] == "block") == bool(r[2]) for r in held]) > 0.95
        assert len({got[r[0]]["verdict"] for r in held}) == 2
    # where nothing but the suffix is known, an unseen one is near the share of all and is not blocked
    flat = [(k, f"http://h{k // 3 % 30}.{('abc', 'bca', 'cab')[k % 3]}/x") for k in range(600)]
    pages = spark.createDataFrame(flat, "page_id long, url string")
    marks = pages.filter("page_id % 3 < 2").selectExpr("url", "cast(page_id % 3 as int) as blocked")
    mean = [r["block_score"] for r in urlfilter.judge(pages, [], marks).collect() if r["host"].endswith("cab")]
    assert abs(np.mean(mean) - 0.5) < 0.2


# --- toxicity ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def lm():
    text = " ".join(["you are an idiot and a moron my friend loser clown the stupid trash talk goes on pathetic worthless people here"] * 50) + " hello there the rest of it is fine and good "
    c = toxicity.char_codes(text)
    return np.bincount((c[:-2] * toxicity.SIZE + c[1:-1]) * toxicity.SIZE + c[2:], minlength=toxicity.SIZE**3)


def test_deobfuscation(lm):
    m = toxicity.CharModel(lm)
    for hidden, word in {"1d10t": "idiot", "m0r0n": "moron", "stuuupid": "stupid", "l0s3r": "loser", "cl0wn": "clown", "tr@sh": "trash", "p4thet!c": "pathetic", "idiooot": "idiot"}.items():
        assert word in toxicity.readings(hidden, m), hidden
    assert toxicity.readings("hello", m) == ["hello"] and toxicity.readings("", m) == [] and toxicity.readings("123", m) == []
    assert "moron" in toxicity.spelled("you m o r o n") and "idiot" in toxicity.spelled("an i.d.i.o.t here") and toxicity.spelled("a b") == []


@pytest.mark.parametrize("spelled_out", [False, True])
def test_the_reading_is_the_best_path_of_the_whole_lattice(spelled_out):
    """Every path is scored on its own; a model of random counts, so that no path is best by habit."""
    from itertools import groupby, product

    rnd = random.Random(33)
    model = toxicity.CharModel(np.random.default_rng(3).integers(0, 9, toxicity.SIZE**3) ** 3)
    space, other = 0, toxicity.SIZE - 1

    def options(c, n, between):
        if between:
            return [("", 0.0), (" ", 0.0)]
        out = {c * n: 0.0}
        for d in toxicity.SIGNS.get(c, ""):
            for m in {n, *([1] if n > 1 else []), *([2] if n > 2 else [])}:
                out.setdefault(d * m, 1.5)
        for m in (1, 2):
            if c.isalpha() and n > m:
                out.setdefault(c * m, 1.5)
        if not c.isalnum():
            out.setdefault("", 1.5)
        return list(out.items())

    def score(path):
        total, x, y = -sum(price for _, price in path), space, space
        for s, _ in path:
            if s == " " and y == space:
                return None
            for d in s:
                z = toxicity._INDEX.get(d, other if d.isalnum() or d in toxicity.SIGNS else space)
                if z == y == space:
                    continue
                total += float(model.log[x, y, z]) - (2.0 if z == other else 0.0)
                x, y = y, z
        return total + float(model.log[x, y, space])

    for _ in range(150):
        signs = "ab3@1*i!s$x|"
        word = "-".join(rnd.choice(signs) for _ in range(rnd.randint(1, 5))) if spelled_out else "".join(rnd.choice(signs) * rnd.choice([1, 1, 2, 3]) for _ in range(rnd.randint(1, 5)))
        runs = [(c, 1) for c in word] if spelled_out else [(c, len(list(g))) for c, g in groupby(word)]
        paths = [(score(p), "".join(s for s, _ in p)) for p in product(*(options(c, n, spelled_out and k % 2 == 1) for k, (c, n) in enumerate(runs)))]
        best = max(s for s, _ in paths if s is not None)
        assert toxicity.restore(word, model, spelled_out=spelled_out) in {t for s, t in paths if s is not None and s > best - 1e-9}, word


def test_deobfuscation_of_spelled_and_doubled_letters(lm):
    m = toxicity.CharModel(lm)
    for low, word in {"t h a t i d i o t": "idiot", "such a i d 1 0 t here": "idiot", "y o u a r e a m 0 r 0 n": "moron"}.items():
        assert word in toxicity.spelled(low, m), low
    for hidden, word in {"stuupid": "stupid", "iddiot": "idiot", "moroon": "moron"}.items():
        assert word in toxicity.readings(hidden, m), hidden
    for k in range(150, 260, 7):  # wherever the lattice is cut
        assert "idiot" in toxicity.readings("ab/" * (k // 3) + "x" * (k % 3) + "/1d10t", m), k
        assert "moron" in toxicity.spelled(" ".join("ab" * (k // 3)) + " m 0 r 0 n", m), k
    assert "you" in toxicity.restore("y o u a r e", m, spelled_out=True).split()
    assert toxicity.spelled("1 2 3 4", m) == [] and len(toxicity.spelled("a b " * 5000)) < 70 * 2


def test_words_without_a_lattice_have_the_same_features(lm):
    rnd = random.Random(34)
    bases = ["idiot", "moron", "aabba", "trash", "loser", "bookk", "ßeer", "abab"]
    rates = {"idiot": 0.9, "moron~": 0.5, "mooron": 0.4, "tras~": 0.6, "book~": 0.7, "loosser": 0.8, "aab~": 0.3, "abab~": 0.3}
    s = toxicity.Scorer(toxicity.Model("x", lm, rates, 0.1))
    for _ in range(3000):
        w = "".join(c * rnd.choice([1, 1, 1, 2, 3]) for c in rnd.choice(bases)) + rnd.choice(["", "s", "ness", "1"])
        want = tuple(f for r in toxicity.readings(w, s.lm) for f in toxicity.features(r) if f in rates)
        assert s.found(w) == want, w


def test_toxicity_held_out(spark, lm):
    rnd = random.Random(12)
    filler = ["".join(rnd.choice(["ba", "ko", "ri", "mu", "te"]) for _ in range(3)) for _ in range(200)]

    def text(y, word):
        w = [rnd.choice(filler) for _ in range(40)]
        if y:
            w[rnd.randrange(40)] = word
        return " ".join(w)

    train = [(text(k % 4 == 0, rnd.choice(["idiot", "moron"])), int(k % 4 == 0)) for k in range(400)]
    model = toxicity.train(train, lm)
    s = toxicity.Scorer(model)
    assert min(s.score(text(1, w)) for w in ("idiot", "1d10t", "m0r0n", "moron!!!", "M O R O N")) >= 0.3
    assert max(s.score(text(0, "")) for _ in range(50)) < 0.3
    rows = odd_docs(spark).select("doc_id", toxicity.score(odd_docs(spark), model).alias("s")).collect()
    assert len(rows) == len(ODD) + 3 and all(0 <= r["s"] < 0.3 for r in rows)
    assert toxicity.Scorer(toxicity.train([], lm)).score(None) == toxicity.Scorer(toxicity.train([], lm)).score("")


def test_sample_of_labelled_rows_is_bounded(spark, lm):
    """A key that a third of the rows have counts once; rows without a key, text or label do not count."""
    words = lambda k: "some words " + "".join("abcdefghij"[int(c)] for c in str(k)) + " here "
    rows = [(7 if k % 3 == 0 else k, words(k) + "idiot " * (k % 4 == 0), int(k % 4 == 0)) for k in range(1200)] + [(None, "x", 1), (5000, None, 1), (5001, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    seen = []
    real = toxicity.fit_bags
    try:
        toxicity.fit_bags = lambda bags, counts: seen.append(len(bags)) or real(bags, counts)
        model = toxicity.fit(df, df.select("doc_id", "toxic"), sample=300)
    finally:
        toxicity.fit_bags = real
    assert 150 <= seen[0] <= 600 and "idiot" in model.rates
    assert toxicity.fit(df.limit(0), df, sample=300).rates == {} and toxicity.fit(df, df.limit(0), sample=300).rates == {}


def test_character_counts_cover_all_documents(spark):
    df = spark.createDataFrame([("abc",), ("abc",), (None,)], "text string")
    n = toxicity.count_chars(df)
    a, b, c = toxicity.char_codes("abc")
    assert n[(a * toxicity.SIZE + b) * toxicity.SIZE + c] == 2
    assert toxicity.count_chars(df.limit(0)).sum() == 0


# --- pipeline ------------------------------------------------------------------------------------------------------


def test_pipeline_on_the_smallest_tables(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = pipeline.language(spark, docs, "")
    want = {r["doc_id"] for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))}
    assert {r["doc_id"] for r in one.collect()} == want and one.columns == docs.columns
    two = pipeline.near_duplicates(spark, docs, "")
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    roots = {d: d for d in fps}

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                lo, hi = sorted((find(a), find(b)))
                roots[hi] = lo
    assert {r["doc_id"] for r in two.collect()} == {d for d in fps if find(d) == d}
    three = pipeline.personal_data(spark, docs, "").collect()
    assert all(not brute_spans(r["text"]) or "[" in r["text"] for r in three) and all(r["n_chars"] == len(r["text"]) for r in three)


def test_stages_on_odd_and_empty_tables(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    odd = odd_docs(spark)
    texts = [r["text"] for r in odd.collect()]
    want = {"language": [t for t in texts if t and any(map(str.isalpha, t))], "personal_data": texts}
    for name, stage in pipeline.STAGES:
        done = stage(spark, odd, "")
        got = done.collect()
        if name in want:
            assert sorted(map(repr, (r["text"] for r in got))) == sorted(map(repr, want[name]))
        if name != "tokens":
            assert done.columns == list(pipeline.COLUMNS)
        assert stage(spark, odd.limit(0), "").collect() == []


def test_mixture_and_tokens_equal_brute_force(spark):
    import sentencepiece

    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    mixed = dict(pipeline.STAGES)["mixture"](spark, docs, "").collect()
    rows = docs.collect()
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows}
    of = {r["doc_id"]: r["source"] for r in rows}
    target = {of[r["doc_id"]]: r["target"] for r in mixing.mix(docs).collect()}
    times = {k: 0 for k in size}
    for r in mixed:
        times[r["doc_id"]] += 1
    for s, t in target.items():
        mine = [size[r["doc_id"]] for r in rows if r["source"] == s]
        lo, hi = -5.0, 5.0
        for _ in range(200):  # the dual by bisection
            mid = (lo + hi) / 2
            if sum(n * min(2.0, math.exp(min(50.0, mid * n))) for n in mine) < t:
                lo = mid
            else:
                hi = mid
        for r in rows:
            if r["source"] == s and size[r["doc_id"]]:
                rate = min(2.0, math.exp(min(50.0, hi * size[r["doc_id"]])))
                assert math.floor(rate - 1e-3) <= times[r["doc_id"]] <= math.ceil(rate + 1e-3)
        taken = sum(size[r["doc_id"]] * times[r["doc_id"]] for r in rows if r["source"] == s)
        assert abs(taken - t) <= max(mine) / 2 + 1
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    coded = dict(pipeline.STAGES)["tokens"](spark, docs, "").collect()
    text = {r["doc_id"]: r["text"] for r in rows}
    assert len(coded) == len(rows) and all(r["ids"] == sp.encode(text[r["doc_id"]] or "") for r in coded)


def test_run_leaves_only_its_result(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    from siftstone.llm import common

    before = set(common._written)
    got = pipeline.run(spark, "/root/testdata/sf0.001")
    assert [p for p in common._written if p not in before] == [got._siftstone_path] and got.count() > 0


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from siftstone.llm import common

    def session(master, at=None):
        conf = SimpleNamespace(get=lambda *a: at)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: conf))

    assert common.shared_dir(session("spark://x", "s3://shared/")) == "s3://shared"
    assert common.shared_dir(session("local[4]")) == common.LOCAL_CHECKPOINTS
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(session(master))
