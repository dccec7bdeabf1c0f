"""The search source, the store's sink, the workers' models and the observed stages."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from siftstone.config import Config
from siftstone.plans import stages
from siftstone.sources import engines
from siftstone.sources.engines import Engine


def test_search_source_over_pages(spark, tmp_path):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}

    def find(query):
        import re

        if query == "3":
            raise OSError("down")
        return [None, *re.findall('href="([^"]*)"', pages[int(query)])]

    mark = str(tmp_path)

    def sleep(seconds):
        with open(os.path.join(mark, f"{os.getpid()}-{threading.get_ident()}-{os.urandom(4).hex()}"), "w") as f:
            f.write(str(seconds))

    queries = [(f"poi{k % 2}", k, str(k)) for k in range(6)]
    registry = engines.Registry()
    registry.add(Engine("first", find))
    registry.add(Engine("paced", find, pause=engines.PAUSE, most=3))
    registry.add(Engine("off", find))
    with pytest.raises(ValueError, match="first"):
        registry.add(Engine("first", find))
    chosen = registry.chosen(["paced", "first"])
    assert [e.name for e in chosen] == ["first", "paced"]
    spark.dataSource.register(engines.search_source(chosen, queries, sleep, "fake_search"))
    df = spark.read.format("fake_search").load()
    assert df.rdd.getNumPartitions() == 6 + 2
    got = sorted((r["source"], r["ord"], r["nth"], r["url"]) for r in df.collect())
    want = []
    for name, most in (("first", 20), ("paced", 3)):
        for _, k, q in queries:
            if q != "3":
                want += [(name, k, n, u) for n, u in enumerate([u for u in find(q)[:most] if u])]
    assert got == sorted(want)
    waits = [(tmp_path / f).read_text() for f in os.listdir(tmp_path)]
    assert waits == ["5.0"] * 4  # three queries of two groups
    spark.dataSource.register(engines.search_source(chosen, [], sleep, "no_search"))
    assert spark.read.format("no_search").load().count() == 0
    with pytest.raises(ValueError, match="queries"):
        engines.search_source(chosen, queries * 2000)


def test_pace_by_a_clock():
    now = [0.0]
    asked = []

    def find(q):
        asked.append((q, now[0]))
        now[0] += 1.5
        if q == "b":
            raise OSError
        return [q]

    part, = engines.partitions([Engine("x", find, pause=5.0)], [("p", k, q) for k, q in enumerate("abc")])
    got = list(engines.answers(part, lambda s: now.__setitem__(0, now[0] + s)))
    assert asked == [("a", 0.0), ("b", 6.5), ("c", 13.0)] and [g[5] for g in got] == ["a", "c"]


def test_sink_uploads_once(spark, tmp_path):
    root = str(tmp_path)
    at = lambda p: os.path.join(root, p.replace("/", "_"))

    def exists(p):
        return os.path.exists(at(p))

    def put(p, content, mime):
        with open(at(p) + ".tries", "a") as f:
            f.write("x")
        tries = os.path.getsize(at(p) + ".tries")
        if p.endswith("bad") and not os.path.exists(os.path.join(root, "mended")):
            raise OSError("refused")
        if p.endswith("late") and tries < 3:
            raise OSError("busy")
        with open(at(p), "wb") as f:
            f.write(content)
        if p.endswith("ghost"):
            raise OSError("no answer")

    def done(uploaded, present):
        with open(os.path.join(root, "done"), "w") as f:
            f.write(f"{uploaded} {present}")

    spark.dataSource.register(engines.upload_sink(engines.Store(put, exists, done), name="fake_store"))
    rows = spark.createDataFrame([(f"p/{n}", n.encode(), "image/png") for n in ("a", "b", "late", "ghost", "bad")], "path string, content binary, mime string").repartition(1).sortWithinPartitions("path")
    with pytest.raises(Exception, match="refused"):
        rows.write.format("fake_store").mode("append").save()
    assert not os.path.exists(os.path.join(root, "done")) and exists("p/a") and not exists("p/bad")
    (tmp_path / "mended").write_text("")
    rows.write.format("fake_store").mode("append").save()
    assert (tmp_path / "done").read_text() == "['p/bad', 'p/ghost', 'p/late'] ['p/a', 'p/b']"
    assert [os.path.getsize(at(f"p/{n}") + ".tries") for n in ("a", "b", "late", "ghost")] == [1, 1, 3, 3]


def test_sink_takes_an_object_that_is_there_as_uploaded():
    stored = {}

    def put(p, content, mime):
        stored[p] = content
        raise OSError("no answer")

    waits = []
    calls = iter([False, True])
    got = engines.put_all(iter([{"path": "x", "content": b"1", "mime": "m"}]), engines.Store(put, lambda p: next(calls)), wait=waits.append)
    assert (got.uploaded, got.present, waits) == (["x"], [], [0, 1])


def test_models_are_loaded_once_a_worker(spark, tmp_path):
    mark = str(tmp_path)

    def said(what):
        with open(os.path.join(mark, f"{what}-{os.getpid()}-{os.urandom(4).hex()}"), "w"):
            pass

    def load():
        said("load")
        return 0.5

    def predict(half, images):
        if len(images) > 16:
            raise AssertionError("too many")
        if any(x == b"bad" for x in images):
            raise OSError("unreadable")
        return [float("nan") if x == b"nan" else half * len(x) for x in images]

    rows = [(k, b"x" * k) for k in range(60)] + [(60, b"bad"), (61, None), (62, b"nan")]
    df = spark.createDataFrame(rows, "k int, b binary").repartition(4)
    got = {r["k"]: r["s"] for r in df.select("k", engines.scored(F.col("b"), "half", load, predict, lambda m: said("unload")).alias("s")).collect()}
    assert got == {k: 0.5 * k for k in range(60)} | {60: 6.0, 61: 6.0, 62: 6.0}
    df.select(engines.scored(F.col("b"), "half", load, predict, lambda m: said("unload"))).collect()
    loads = [f.split("-")[1] for f in os.listdir(mark) if f.startswith("load")]
    assert len(loads) == len(set(loads)) <= 4
    spark.range(8).repartition(8).select(engines.scored(F.lit(b"xx"), "other", lambda: 1.0, predict)).collect()
    assert {f.split("-")[1] for f in os.listdir(mark) if f.startswith("unload")} <= set(loads)


def test_one_model_at_a_time(monkeypatch):
    monkeypatch.setattr(engines, "_loaded", {})
    gone = []
    assert engines.model("a", lambda: "A", gone.append) == "A" and engines.model("a", lambda: "new") == "A"
    assert engines.model("b", lambda: "B") == "B" and gone == ["A"] and list(engines._loaded) == ["b"]


def test_observed_stages(spark):
    rows = [("p", o, 900 if o % 3 else 100, 900, None if o == 1 else o % 5 << 20, [1.0, float(o % 4)], 9.0 - o % 7) for o in range(40)]
    df = spark.createDataFrame(rows, "poi string, ord int, width int, height int, phash long, embedding array<double>, score double")
    for more in ([], [("judge", lambda d: d.filter("ord % 2 = 0"))]):
        listed = stages.image_stages(Config(target_max=3, hash_distance=1), more)
        watched = stages.Watched(df, listed)
        got = watched.df.collect()
        left, want = df, []
        for name, stage in listed:
            n = left.count()
            left = stage(left)
            want.append((name, n, n - left.count(), left.count()))
        assert watched.counts() == want and len(got) == want[-1][3]
    empty = stages.Watched(df.limit(0), listed)
    empty.df.collect()
    assert [c[1:] for c in empty.counts()] == [(0, 0, 0)] * len(listed)
    with pytest.raises(ValueError, match="name"):
        stages.Watched(df, listed + listed)
