"""Cases from the survey's fixtures, folds against plain loops, and the error policy."""

import math
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from siftstone.config import Config
from siftstone.functions import judge, scalars
from siftstone.operators import dedup, filters, ranking, transitions, urls


def one(spark, c, **row):
    return spark.createDataFrame([Row(**row)]).select(c.alias("x")).first()["x"]


def test_config_defaults_and_override(monkeypatch):
    monkeypatch.delenv("SCRAPE_TARGET_IMAGES_MAX", raising=False)
    assert (Config().target_max, Config().target_min) == (15, 12)
    monkeypatch.setenv("SCRAPE_TARGET_IMAGES_MAX", "20")
    assert Config().target_max == 20
    monkeypatch.setenv("SCRAPE_DYNAMIC_QUERIES", "Yes")
    assert Config().dynamic_queries is True


def test_sizes_and_aspect(spark):
    rows = [(800, 600, True, True), (200, 200, False, True), (100, 1000, False, False), (400, 1000, False, True), (800, 0, False, False), (None, 5, False, False), (-1, -1, False, False)]
    df = spark.createDataFrame([r[:2] for r in rows], "w int, h int")
    got = df.select(filters.large_enough(F.col("w"), F.col("h")), filters.fair_aspect(F.col("w"), F.col("h"))).collect()
    assert [tuple(r) for r in got] == [r[2:] for r in rows]


def test_overlay_text(spark):
    def det(x0, y0, x1, y1, text, conf):
        return ([[float(x0), float(y0)], [float(x1), float(y0)], [float(x1), float(y1)], [float(x0), float(y1)]], text, conf)

    cases = [([det(850, 900, 990, 950, "DANNY DONG", 0.8)], True), ([det(400, 450, 600, 480, "HOTEL NAME", 0.9)], False), ([det(400, 400, 600, 430, "Getty Images", 0.9)], True), ([det(850, 900, 990, 950, "x", 0.2)], False), ([], False), (None, False)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "dets array<struct<bbox:array<array<double>>,text:string,conf:double>>")
    got = [r[0] for r in df.select(filters.has_overlay_text(F.col("dets"), F.lit(1000), F.lit(1000))).collect()]
    assert got == [w for _, w in cases]
    assert df.select(filters.has_overlay_text(F.col("dets"), F.lit(0), F.lit(0))).count() == len(cases)


def test_scores(spark):
    got = spark.createDataFrame([(5.99,), (6.0,), (None,)], "s double").select(filters.good_looking(F.col("s"))).collect()
    assert [r[0] for r in got] == [False, True, True]


def greedy(rows, near):
    kept = []
    for o, x in rows:
        if x is None or not any(k is not None and near(k, x) for _, k in kept):
            kept.append((o, x))
    return kept


def test_hash_fold_equals_loop(spark):
    rnd = random.Random(3)
    rows = [(p, o, None if rnd.random() < 0.1 else rnd.getrandbits(12)) for p in range(4) for o in range(40)]
    got = {tuple(r) for r in dedup.hash_dedup(spark.createDataFrame(rows, "poi int, ord int, phash long"), distance=4).collect()}
    want = {(p, o) for p in range(4) for o, _ in greedy([r[1:] for r in rows if r[0] == p], lambda a, b: (a ^ b).bit_count() < 4)}
    assert got == want


def test_embedding_folds_equal_loop(spark):
    rnd = random.Random(4)
    rows = [(p, o, None if rnd.random() < 0.1 else [rnd.gauss(0, 1) for _ in range(4)]) for p in range(3) for o in range(30)]
    df = spark.createDataFrame(rows, "poi int, ord int, embedding array<double>")
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b)) >= 0.7
    want = []
    for p in range(3):
        kept = greedy([r[1:] for r in rows if r[0] == p], cos)
        want += [(p, o, k) for k, (o, _) in enumerate([x for x in kept if x[1] is not None] + [x for x in kept if x[1] is None])]
    for f in (dedup.embedding_dedup, dedup.embedding_dedup_blocks):
        assert sorted(tuple(r) for r in f(df, similarity=0.7).collect()) == sorted(want)


def test_quota_equals_loop(spark):
    rnd = random.Random(5)
    rows = [(p, o, f"u{rnd.randrange(12)}", rnd.choice(["all", "a", "b"])) for p in ("x", "y") for o in range(40)]
    got = sorted(tuple(r) for r in dedup.quota_across_tabs(spark.createDataFrame(rows, "poi string, ord int, url string, category string"), first_quota=4, quota=2, cap=7).collect())
    want = []
    for p in ("x", "y"):
        seen, per = [], {}
        for _, o, u, t in [r for r in rows if r[0] == p]:
            if len(seen) < 7 and per.get(t, 0) < (4 if t == "all" else 2) and u not in seen:
                seen.append(u)
                per[t] = per.get(t, 0) + 1
                want.append((p, o, u, t))
    assert got == sorted(want)


def test_judge_replies(spark):
    text = "1. KEEP - a\n2: reject\n3) KEEP\n2. **KEEP**\n3 - REJECT\n9. REJECT\nnoise"
    df = spark.createDataFrame([(text, 4), ("", 2), (None, 1), ("TOP15: 3, 1", 0)], "c string, n int")
    got = [r[0] for r in df.select(judge.decisions(F.col("c"), F.col("n"))).collect()]
    assert got == [["KEEP", "REJECT", "REJECT", "KEEP"], ["KEEP", "KEEP"], ["KEEP"], []]
    tops = [("**TOP15:** 3, 7, 1, x, 3", [2, 0, 2]), ("top 15： 2", [1]), ("TOP15: 99\nTOP 15: 1", [0]), ("none", [])]
    df = spark.createDataFrame([(t,) for t, _ in tops], "c string")
    assert [r[0] for r in df.select(judge.top15(F.col("c"), F.lit(5))).collect()] == [w for _, w in tops]
    assert one(spark, judge.chosen(F.col("t"), F.lit(3)), t="1. REJECT") == [1, 2]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.display_name(F.lit("Inn v2")).alias("a"), scalars.base_key(F.lit("/x/candidate_10000.jpg")).alias("b"), scalars.base_key(F.lit("none.jpg")).alias("c"),
        scalars.full_size_url(F.lit("https://m/marriott-renditions/x?downsize=10px:*&")).alias("d"), scalars.unescape_url(F.lit("a\\u003db\\u0026c")).alias("e"), scalars.storage_path(F.lit("p"), F.lit(""), F.lit("s"), F.lit("f")).alias("f"),
        scalars.put_note(F.lit("broken"), "k", F.lit("v")).alias("g"), scalars.put_note_list(F.lit('{"n": 1}'), "k", F.array(F.lit("a"))).alias("h"), scalars.suffix_list(F.lit('["a","b","c"]')).alias("i"),
        scalars.age_days(F.expr("timestamp '2024-01-01 23:00:00'"), F.expr("timestamp '2024-01-03 22:00:00'")).alias("j"), scalars.first_ref(F.lit("None")).alias("k"), scalars.clamp_fps(F.lit(0)).alias("l"), scalars.mime_type(F.lit("a.PNG")).alias("m"), scalars.split_path(F.lit("nodir")).alias("n"),
        scalars.put_note_list(F.lit("x"), "k", F.array(F.lit("a"))).alias("o"), scalars.iso_timestamp(F.lit("2024-01-01T00:00:00Z")).alias("p"), scalars.guess_extension(F.lit("u.WEBP.jpg")).alias("q"),
    ).first()
    assert tuple(row)[:9] == ("Inn", "1000", None, "https://m/marriott-renditions/x", "a=b&c", "pois/p/s/f", '{"k":"v"}', '{"n": 1, "k": ["a"]}', None)
    assert tuple(row)[9:15] == (1, None, 2, "image/png", None, '{"k": ["a"]}')
    assert row["p"].year == 2024 and row["q"] == ".webp"


def test_top_n_keeps_small_groups(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 9.0), ("b", 0, 1.0), ("b", 1, None), ("b", 2, 5.0), ("b", 3, 5.0)], "poi string, ord int, score double")
    got = sorted((r["poi"], r["pos"], r["ord"]) for r in ranking.top_n(df, n=3).collect())
    assert got == [("a", 0, 0), ("a", 1, 1), ("b", 0, 2), ("b", 1, 3), ("b", 2, 0)]


def test_transitions(spark):
    df = spark.sql("select * from values ('a', 'idle', timestamp '2024-01-01'), ('b', 'processing', timestamp '2024-01-01'), ('c', cast(null as string), cast(null as timestamp)) t(poi_name, processing_status, updated_at)")
    now = F.expr("timestamp '2024-01-02'")
    assert transitions.n_changed(transitions.claim(df, "a", now)).first()[0] == 1
    assert transitions.n_changed(transitions.claim(df, "b", now)).first()[0] == 0
    got = {r["poi_name"]: r["processing_status"] for r in transitions.reset_stale_pois(df, now).collect()}
    assert got == {"a": "idle", "b": "idle", "c": None}


def test_snapshots(spark):
    snap = '- button "See photos" [ref=5]\n- tab "Change collection to Rooms" [ref=12]\n- tab "Change collection to Food" [ref=13]\n- tab "Change collection to Rooms" [ref=14]\n- link "W Miami $444 4.3" [ref=30]\n- link "The Grand W Hotel $20" [ref=31]'
    row = spark.createDataFrame([(snap,)], "s string").select(urls.photos_button(F.col("s")), urls.tab_refs(F.col("s")), urls.pack_names(F.col("s")), urls.best_name(urls.pack_names(F.col("s")), F.lit("grand hotel")), urls.best_name(urls.pack_names(F.col("s")), F.lit("zzz"))).first()
    assert tuple(row) == ("5", {"Rooms": "14", "Food": "13"}, ["W Miami", "The Grand W Hotel"], "The Grand W Hotel", "W Miami")


def test_images_and_manifest(spark, tmp_path):
    import struct
    import zlib

    from siftstone.sources import readers

    def png(w, h):
        chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
        return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + bytes(w) for _ in range(h)))) + chunk(b"IEND", b"")

    (tmp_path / "i").mkdir()
    (tmp_path / "i" / "b.png").write_bytes(png(30, 20))
    (tmp_path / "i" / "a.png").write_bytes(b"no image")
    (tmp_path / "i" / "c.txt").write_bytes(b"x")
    sizes = {r["path"].rsplit("/", 1)[-1]: (r["width"], r["height"]) for r in readers.image_sizes(spark, str(tmp_path / "i")).collect()}
    assert sizes["b.png"] == (30, 20) and sizes["a.png"] == (-1, -1)
    assert [r["path"].rsplit("/", 1)[-1] for r in readers.image_files(spark, str(tmp_path / "i")).collect()] == ["a.png", "b.png"]
    e = spark.createDataFrame([("p", 0, "u1", "google_kp", "all", None), ("p", 1, "u2", "official_site", None, "home")], "poi string, ord int, url string, source string, category string, subpage string")
    readers.write_manifest(urls.manifest(e, F.expr("timestamp '2024-01-01'")), str(tmp_path / "m"))
    assert [r["url"] for r in readers.read_manifest(spark, str(tmp_path / "m"), most=1).collect()] == ["u1"]


def test_perceptual_hash(spark):
    rnd = random.Random(1)
    noise = [rnd.random() for _ in range(1024)]
    flat = [float(i) for i in range(1024)]
    df = spark.createDataFrame([(noise,), (noise,), (flat,), (None,), ([1.0],)], "g array<double>")
    got = [r[0] for r in df.select(dedup.perceptual_hash(F.col("g"))).collect()]
    assert got[0] == got[1] and got[0] != got[2] and got[3:] == [None, None]


def test_retry_and_upload_plan(spark):
    from siftstone.plans.curation import retry
    from siftstone.plans.upload import upload_plan

    first = spark.createDataFrame([("a", 0), ("a", 4), ("b", 0)], "poi string, ord int")
    more = spark.createDataFrame([("a", 0), ("b", 0), ("b", 1), ("c", 0)], "poi string, ord int")
    assert sorted(map(tuple, retry(first, more, least=2).collect())) == [("a", 0), ("a", 4), ("b", 0), ("b", 1), ("b", 2), ("c", 0)]
    new = spark.createDataFrame([("a", "1.jpg"), ("a", "2.jpg"), ("a", "2.jpg"), ("b", "1.jpg"), ("c", "1.jpg"), ("c", "2.jpg")], "poi string, name string")
    stored = spark.createDataFrame([("a", "1.jpg"), ("a", "9.jpg"), ("a", "metadata.json"), ("b", "metadata.json"), ("c", "1.jpg")], "poi string, name string")
    got = {(r["poi"], r["name"]): (r["archive"], r["upload"]) for r in upload_plan(new, stored).collect()}
    assert got == {("a", "1.jpg"): (False, False), ("a", "2.jpg"): (False, True), ("b", "1.jpg"): (False, True), ("c", "1.jpg"): (True, True), ("c", "2.jpg"): (True, True)}
    assert upload_plan(new.limit(0), stored).count() == 0


def test_zero_row_changes_raise(spark):
    import pytest

    layer = spark.sql("select 'a' as poi_name, 'idle' as processing_status, cast(null as timestamp) as updated_at")
    now = F.expr("timestamp '2024-01-02'")
    assert transitions.update_poi(layer, "a", {}, now).first()["updated_at"].day == 2
    videos = spark.sql("select 'v' as id, 'b' as poi_id, 'idle' as publishing_status")
    assert transitions.update_video(videos, "v", {"publishing_status": F.lit("done")}).first()["publishing_status"] == "done"
    assert transitions.create_videos(videos, "c", spark.sql("select 'w' as id")).filter("poi_id = 'c'").count() == 1
    for change in (lambda: transitions.update_poi(layer, "b", {}, now), lambda: transitions.release(layer, "b", now), lambda: transitions.update_video(videos, "w", {}), lambda: transitions.create_videos(videos, "c", videos.limit(0)), lambda: transitions.create(layer, layer.limit(0), "POI")):
        with pytest.raises(ValueError, match="no matching record"):
            change()


def test_register_scrape(spark):
    layer = spark.sql("select * from values ('a', 'x', 3, 'processing', timestamp '2024-01-01') t(poi_name, scraped_pics, scraped_count, processing_status, updated_at)")
    rows = spark.createDataFrame([("a", "pois/a", 0), ("b", "pois/b", 2), ("c", None, None)], "poi_name string, scraped_pics string, scraped_count int")
    got = {r["poi_name"]: (r["scraped_pics"], r["scraped_count"], r["processing_status"], r["updated_at"].day) for r in transitions.register_scrape(layer, rows, F.expr("timestamp '2024-01-02'")).collect()}
    assert got == {"a": ("x", 3, "processing", 1), "b": ("pois/b", 2, "idle", 2)}
    assert {r["poi_name"]: r["registered"] for r in transitions.registered(rows).collect()} == {"a": False, "b": True, "c": False}


def test_sources_fail_alone(spark):
    from siftstone.plans import sourcing
    from siftstone.sources import clients

    def find(query):
        if query == "bad":
            raise OSError("down")
        return [f"http://x/{query}", None, "", "http://x/both"]

    def never(query):
        raise OSError("down")

    queries = spark.createDataFrame([("p", 0, "bad"), ("p", 1, "one"), ("p", 2, "two"), ("q", 0, "bad")], "poi string, ord int, query string")
    sources = {"a": clients.search("a", find, key=None), "b": clients.search("b", never), "c": clients.search("c", find), "d": clients.search("d", find)}
    got = sorted((r["poi"], r["ord"], r["url"], r["source"]) for r in sourcing.search_all(queries, sources).collect())
    assert got == [("p", 0, "http://x/one", "c"), ("p", 1, "http://x/both", "c"), ("p", 2, "http://x/two", "c")]


def test_downloads_leave_gaps_and_retry_without_referer(spark):
    from siftstone.plans import sourcing
    from siftstone.sources import clients

    def get(url, headers):
        if "refuses" in url and "Referer" in headers or "gone" in url:
            raise clients.HttpError("403")
        if "broken" in url:
            raise OSError("reset")
        return ("text/html" if "page" in url else "image/png"), b"x" * (10 if "tiny" in url else 6000)

    names = ["a.png", "refuses.jpg", "gone", "broken", "page", "tiny", "z.webp"]
    entries = spark.createDataFrame([("p", k, f"http://h/{n}", 5) for k, n in enumerate(names)] + [("p", 9, "http://h/late", 5)], "poi string, ord int, url string, start int")
    got = sorted((r["name"], len(r["content"])) for r in sourcing.download_all(entries, clients.download(get, {"User-Agent": "x"}), "start", most=9).collect())
    assert got == [("candidate_0005.png", 6000), ("candidate_0006.jpg", 6000), ("candidate_0011.webp", 6000)]


def test_uploads_probes_and_image_encoding():
    import json

    import pandas as pd
    import pytest

    from siftstone.sources import clients

    tried = []

    def put(path, content, mime):
        tried.append(path)
        if path != "ok" and not (path == "second" and tried.count("second") == 2):
            raise OSError(35, "busy")

    rows = pd.DataFrame({"path": ["ok", "second", "ghost", "lost"], "content": [b"x"] * 4, "mime": ["image/jpeg"] * 4})
    got = clients.upload(put, lambda p: p == "ghost", lambda p: f"http://cdn/{p}")(rows)
    assert got["url"].tolist() == ["http://cdn/ok", "http://cdn/second", "http://cdn/ghost", None] and tried.count("lost") == 3

    def shrink(content):
        if content.startswith(b"bad"):
            raise ValueError("no image")
        return b"small"

    images = pd.DataFrame({"path": ["a", "b", "c"], "content": [b"x" * 10, b"y" * 30, b"bad" * 10], "mime": ["image/png"] * 3})
    got = clients.encode_images(shrink, above=20)(images)
    assert [(base, mime) for base, mime in zip(got["data"], got["mime"])] == [("eHh4eHh4eHh4eA==", "image/png"), ("c21hbGw=", "image/jpeg"), ("YmFk" * 10, "image/png")]
    said = json.dumps({"format": {"duration": "2.5"}, "streams": [{"width": 4, "height": 3}]})
    assert clients.probe(lambda p: said)(pd.DataFrame({"path": ["v"]})).iloc[0].tolist() == ["v", 2.5, 4, 3]
    with pytest.raises(KeyError):
        clients.probe(lambda p: "{}")(pd.DataFrame({"path": ["v"]}))


def test_types_by_family(spark):
    row = spark.range(1).select(*[scalars.mime_type(F.lit(p), f).alias(f"x{k}") for k, (p, f) in enumerate([("a.PNG", "image"), ("a.mp4", "image"), ("a.mov", "video"), ("a.png", "video"), ("a", "video")])]).first()
    assert tuple(row) == ("image/png", "image/jpeg", "video/quicktime", "video/mp4", "video/mp4")


def test_plan_settings_of_zero_count(spark):
    from siftstone.plans.curation import curate

    rows = [("p", k, 700, 700, k, [1.0, float(k)], float(k)) for k in range(4)]
    df = spark.createDataFrame(rows, "poi string, ord int, width int, height int, phash long, embedding array<double>, score double")
    assert curate(df, least=0.0, similarity=1.1, distance=0).count() == 4
    got = [tuple(r) for r in curate(df, least=0.0, similarity=1.1, distance=0, blocks=True).orderBy("pos").select("ord", "pos").collect()]
    assert got == [(3, 0), (2, 1), (1, 2), (0, 3)]


def test_sites_and_panels(spark):
    from siftstone.plans import sourcing
    from siftstone.sources import clients

    image = "https://cdn.example.org/pictures/large/{}.jpg"
    pages = {"h": ["a", "b", "gone", "c", "d"], "a": [], "b": [], "c": [], "d": []}

    def open_page(url):
        if url not in pages:
            raise OSError("no page")
        return f'<img src="{image.format(url)}"><img src="{image.format("both")}">', pages[url]

    def choose(poi, links):
        if poi == "q":
            raise OSError("no reply")
        return ["elsewhere", "b", "b", "gone", "a", "c"]

    sites = spark.createDataFrame([("p", "h"), ("q", "h"), ("r", "none")], "poi string, url string")
    got = [tuple(r) for r in sourcing.site_images(sites, clients.crawl(open_page, choose)).orderBy("poi", "ord").select("poi", "url", "subpage").collect()]
    assert got == [("p", image.format("h"), "h"), ("p", image.format("both"), "h"), ("p", image.format("b"), "b"), ("p", image.format("a"), "a"), ("q", image.format("h"), "h"), ("q", image.format("both"), "h")]
    long = "https://lh3.googleusercontent.com/p/" + "x" * 40
    rows = [("p", 0, "All", long + "1=w20", 90), ("p", 1, "All", long + "1=w40", 90), ("p", 2, "Food", long + "2=w1", 10), ("p", 3, "Food", "https://lh3.googleusercontent.com/a/" + "y" * 40, 90), ("p", 4, "Food", long + "3", 90), ("p", 5, "Food", long + "4", 90)]
    df = spark.createDataFrame(rows, "poi string, ord int, category string, src string, width int")
    assert sorted((r["ord"], r["url"], r["category"]) for r in sourcing.panel_images(df, quota=1).collect()) == [(0, long + "1=s0", "All"), (4, long + "3=s0", "Food")]


def test_asking_a_model():
    import pandas as pd
    import pytest

    from siftstone.sources import clients

    sent = []

    def post(payload):
        sent.append(payload)
        return (200, "yes") if payload["messages"][0]["content"][0]["text"] != "fail" else (500, "down")

    rows = pd.DataFrame({"poi": ["p", "q"], "prompt": ["one", "two"], "urls": [["u"], None], "images": [[("image/png", "eA==")], None], "videos": [["v"], ["w"]], "fps": [30, 1]})
    assert clients.ask(post, "m")(rows)["reply"].tolist() == ["yes", "yes"]
    assert [len(p["messages"][0]["content"]) for p in sent] == [4, 2] and [p["messages"][0]["content"][-1]["fps"] for p in sent] == [10, 2]
    with pytest.raises(clients.HttpError, match="500"):
        clients.ask(post, "m")(rows.assign(prompt="fail"))
