"""Image headers, hashes of decoded images, typed notes and the judge's outcomes."""

import json
import random
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siftstone.config import Config
from siftstone.functions import judge, scalars
from siftstone.functions.headers import image_size, sides
from siftstone.operators import dedup
from siftstone.plans import curation
from siftstone.sources import clients, readers


def png(w, h, rows=None):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    kind, body = (2, b"".join(b"\0" + bytes(r) for r in rows)) if rows is not None else (0, b"".join(b"\0" + bytes(w) for _ in range(h)))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def jpeg(w, h, frame=0xC0, before=b""):
    return b"\xff\xd8\xff\xe0\x00\x10JFIF\0\x01\x01\0\0\x01\0\x01\0\0" + before + b"\xff\xff" + bytes([frame]) + struct.pack(">HBHHB", 17, 8, h, w, 3) + bytes(9)


def webp(kind, body):
    return b"RIFF" + struct.pack("<I", len(body) + 12) + b"WEBP" + kind + struct.pack("<I", len(body)) + body


LONG = b"\xff\xe1" + struct.pack(">H", 65535) + b"\xff\xc0" * 32766 + b"x"  # a segment that holds what looks like frames
HEADERS = [
    (png(800, 600), (800, 600)), (png(800, 600)[:24], (800, 600)), (png(800, 600)[:22], (-1, -1)), (b"\x89PNG\r\n\x1a\n" + bytes(24), (-1, -1)),
    (b"GIF89a" + struct.pack("<HH", 321, 45) + bytes(3), (321, 45)), (b"GIF87a" + struct.pack("<HH", 1, 2), (1, 2)), (b"GIF89a\1", (-1, -1)),
    (b"BM" + bytes(12) + struct.pack("<Iii", 40, 640, -480), (640, 480)), (b"BM" + bytes(12) + struct.pack("<Iii", 40, 640, 480), (640, 480)), (b"BM" + bytes(12) + struct.pack("<IHH", 12, 7, 9), (7, 9)),
    (jpeg(1024, 768), (1024, 768)), (jpeg(1024, 768, 0xC2, LONG), (1024, 768)), (jpeg(5, 6)[:30], (5, 6)), (jpeg(5, 6)[:24], (-1, -1)), (b"\xff\xd8\xff\xda\0\2", (-1, -1)), (b"\xff\xd8\xff\xd9", (-1, -1)), (b"\xff\xd8 no", (-1, -1)), (b"\xff\xd8" + b"\xff\xc4\0\3x" + jpeg(9, 8)[2:], (9, 8)),
    (webp(b"VP8 ", b"\x30\x01\0\x9d\x01\x2a" + struct.pack("<HH", 700 | 0x4000, 500)), (700, 500)), (webp(b"VP8 ", b"\x30\x01\0\x9d\x01\x2b" + struct.pack("<HH", 700, 500)), (-1, -1)),
    (webp(b"VP8L", b"\x2f" + struct.pack("<I", 1234 | 777 << 14 | 1 << 28)), (1235, 778)), (webp(b"VP8X", b"\x10\0\0\0" + (69999).to_bytes(3, "little") + (3).to_bytes(3, "little")), (70000, 4)), (webp(b"ALPH", bytes(20)), (-1, -1)),
    (b"", (-1, -1)), (None, (-1, -1)), (b"no image at all", (-1, -1)), (png(0, 5), (-1, -1)),
]


def test_sides_of_each_format(spark, tmp_path):
    assert [sides(b) for b, _ in HEADERS] == [w for _, w in HEADERS]
    df = spark.createDataFrame([(k, b) for k, (b, _) in enumerate(HEADERS)], "k int, b binary")
    got = df.select("k", image_size(F.col("b")).alias("s")).orderBy("k").select("s.*").collect()
    assert [tuple(r) for r in got] == [w for _, w in HEADERS]
    for k, (b, _) in enumerate(HEADERS):
        (tmp_path / f"{k:02d}.webp").write_bytes(b or b"")
    found = {r["path"].rsplit("/", 1)[-1]: (r["width"], r["height"]) for r in readers.image_sizes(spark, str(tmp_path)).collect()}
    assert found == {f"{k:02d}.webp": w for k, (b, w) in enumerate(HEADERS) if b}


def lanczos(line):
    """One line of pixels to 32, pixel by pixel."""
    n, out = len(line), []
    scale = max(1.0, n / 32)
    for i in range(32):
        mid = (i + 0.5) * n / 32
        lo, hi = max(0, int(mid - 3 * scale + 0.5)), min(n, int(mid + 3 * scale + 0.5))
        w = [np.sinc((x + 0.5 - mid) / scale) * np.sinc((x + 0.5 - mid) / scale / 3) if abs((x + 0.5 - mid) / scale) < 3 else 0.0 for x in range(lo, hi)]
        out.append(min(255, max(0, int(np.floor(sum(a * line[x] for a, x in zip(w, range(lo, hi))) / sum(w) + 0.5)))))
    return out


def test_hash_of_images_through_bytes(spark, tmp_path):
    rnd = np.random.default_rng(3)
    noise = rnd.integers(0, 256, (60, 80, 3), dtype=np.uint8)
    red = np.zeros((60, 80, 3), dtype=np.uint8)
    red[:, :, 0] = 255
    pattern = np.zeros((60, 80, 3), dtype=np.uint8)
    pattern[::2, ::2] = 255
    for name, px in (("noise", noise), ("noise2", noise), ("red", red), ("red2", red), ("pattern", pattern)):
        (tmp_path / f"{name}.png").write_bytes(png(80, 60, px.reshape(60, 240)))
    (tmp_path / "broken.png").write_bytes(png(80, 60)[:40])
    got = {r["path"].rsplit("/", 1)[-1]: r["h"] for r in readers.image_pixels(spark, str(tmp_path)).select("path", dedup.image_hash(F.col("image")).alias("h")).collect()}
    assert got["noise.png"] == got["noise2.png"] and got["red.png"] == got["red2.png"] and "broken.png" not in got
    rows = spark.createDataFrame([("p", k, got[n]) for k, n in enumerate(("red.png", "red2.png", "noise.png", "pattern.png"))], "poi string, ord int, phash long")
    assert sorted(r["ord"] for r in dedup.hash_dedup(rows).collect()) in ([0, 2, 3], [0, 2])  # equal ones go, the noise stays
    grey = (noise[:, :, 0].astype(int) * 19595 + noise[:, :, 1].astype(int) * 38470 + noise[:, :, 2].astype(int) * 7471 + 0x8000) >> 16
    across = np.array([lanczos(r) for r in grey.tolist()])
    small = np.array([lanczos(c) for c in across.T.tolist()]).T
    assert np.abs(dedup.grey_32(noise[:, :, ::-1].tobytes(), 60, 80, 3) - small).max() <= 1
    same = spark.createDataFrame([([float(v) for v in small.ravel()],)], "g array<double>").select(dedup.perceptual_hash(F.col("g"))).first()[0]
    assert (same ^ got["noise.png"]).bit_count() <= 2
    odd = spark.createDataFrame([((2, 2, 3, b"x"),), (None,), ((0, 0, 3, b""),), ((32, 32, 1, bytes(range(256)) * 4),)], "i struct<height:int,width:int,nChannels:int,data:binary>")
    hashes = [r[0] for r in odd.select(dedup.image_hash(F.col("i"))).collect()]
    assert hashes[:3] == [None] * 3 and hashes[3] is not None


def test_notes_keep_types(spark):
    text = '{"a":1,"b":{"c":[2,true,null],"d":"x\\"y"},"n":null,"f":0.25,"big":12345678901234567890,"s":"1","é":"\\u2028"}'
    df = spark.createDataFrame([(text,), ("{}",), (None,), ("x",), ("[1]",), ('{"k":1,"k":2,"z":3}',), (" {\"k\" : {\"q\": 1}} ",)], "n string")
    rows = df.select("n", scalars.put_note("n", "k", F.lit("v")).alias("put"), scalars.put_note("n", "k", F.lit(7)).alias("number"), scalars.pop_note("n", "a").alias("pop"), scalars.put_note_list("n", "k", F.array(F.lit("a"), F.lit('b"'))).alias("many"), scalars.put_note("n", "k", F.lit(None).cast("string")).alias("none")).collect()
    for r in rows:
        try:
            old = json.loads(r["n"])
            old = old if isinstance(old, dict) else {}
        except (TypeError, ValueError):
            old = {}
        same = lambda a, b: json.loads(a) == b and list(json.loads(a)) == list(b)
        assert same(r["put"], old | {"k": "v"}) and same(r["number"], old | {"k": 7}) and same(r["none"], old | {"k": None})
        assert same(r["pop"], {k: v for k, v in old.items() if k != "a"}) and same(r["many"], old | {"k": ["a", 'b"']})
        assert r["many"] == json.dumps(json.loads(r["many"]), ensure_ascii=False) or "{" in r["many"][1:]
    assert rows[0]["pop"] == text.replace('"a":1,', "").replace("\\u2028", " ")


def test_judge_fails_closed(spark):
    waited = []
    calls = {"down": 0, "late": 0}

    def call(row):
        if row.poi == "down":
            calls["down"] += 1
            return " " if calls["down"] < 3 else None
        if row.poi == "late":
            calls["late"] += 1
            if calls["late"] < 3:
                raise OSError("busy")
        return "1. REJECT\n2. KEEP"

    pdf = pd.DataFrame({"poi": ["fine", "down", "late"]})
    got = clients.judged(call, sleep=waited.append)(pdf)
    assert got.values.tolist() == [["fine", "replied", "1. REJECT\n2. KEEP"], ["down", "failed", None], ["late", "replied", "1. REJECT\n2. KEEP"]]
    assert waited == [5, 15, 5, 15] and calls == {"down": 3, "late": 3}
    assert clients.judged(None)(pdf)["outcome"].tolist() == ["skipped"] * 3


@pytest.mark.parametrize("blocks", [False, True])
def test_plan_by_outcomes(spark, blocks):
    rows = [(p, o, 900, 900, o << 20 | (o * 37) << 40, [float(o == k) for k in range(40)], 9.0 - o / 100) for p in ("replied", "skipped", "failed", "missing", "blank") for o in range(35)]
    df = spark.createDataFrame(rows, "poi string, ord int, width int, height int, phash long, embedding array<double>, score double")
    replies = spark.createDataFrame([("replied", "replied", "TOP15: 30, 31, 1"), ("skipped", "skipped", None), ("failed", "failed", None), ("blank", "replied", " ")], "poi string, outcome string, content string")
    plan = lambda r, c: sorted(tuple(x) for x in curation.curate(df, r, c, least=0.0, distance=0, blocks=blocks).select("poi", "pos", "ord").collect())
    got = plan(replies, Config(target_max=40))
    assert [x for x in got if x[0] == "replied"] == [("replied", 0, 29), ("replied", 1, 0)]
    assert [x for x in got if x[0] == "skipped"] == [("skipped", k, k) for k in range(35)]
    assert {x[0] for x in got} == {"replied", "skipped"}
    alone = plan(replies.select("poi", "content"), Config(target_max=40))
    assert {x[0] for x in alone} == {"replied"}
    assert len(plan(None, Config(target_max=40))) == 5 * 35


def test_outcome_of_text(spark):
    df = spark.createDataFrame([("x",), (" \n",), (None,)], "c string")
    assert [r[0] for r in df.select(judge.outcome(F.col("c"))).collect()] == ["replied", "failed", "failed"]


def test_accounts_of_all_stages(spark):
    rnd = random.Random(4)
    rows = [(p, o, rnd.choice([500, 900, 2000]), 700, rnd.choice([None, 1, 2, 1 << 40, (1 << 40) | 1, -1]), rnd.choice([None, [1.0, 0.0], [0.0, 1.0], [1.0, 0.1]]), rnd.choice([None, 5.0, 7.0, 8.0])) for p in "ab" for o in range(40)]
    df = spark.createDataFrame(rows, "poi string, ord int, width int, height int, phash long, embedding array<double>, score double")
    chosen = curation.selected(df, config=Config(target_max=5))
    got = [tuple(r) for r in curation.accounts(chosen).orderBy("poi", "step").collect()]
    for p in "ab":
        left = [r for r in rows if r[0] == p]
        want = []
        for name, keep in (("resolution", lambda r: r[2] >= 600), ("aspect", lambda r: 0.4 <= r[2] / r[3] <= 2.5), ("score", lambda r: r[6] is None or r[6] >= 6.0)):
            rest = [r for r in left if keep(r)]
            want.append((p, len(want), name, len(left), len(left) - len(rest), len(rest)))
            left = rest
        for name, x, near in (("hashes", 4, lambda a, b: (a ^ b).bit_count() < 8), ("vectors", 5, lambda a, b: np.dot(a, b) / np.sqrt(np.dot(a, a) * np.dot(b, b)) >= 0.89)):
            rest = []
            for r in left:
                if r[x] is None or not any(k[x] is not None and near(k[x] & (1 << 64) - 1 if x == 4 else k[x], r[x] & (1 << 64) - 1 if x == 4 else r[x]) for k in rest):
                    rest.append(r)
            want.append((p, len(want), name, len(left), len(left) - len(rest), len(rest)))
            left = rest
        want.append((p, 5, "judge", len(left), 0, len(left)))
        want.append((p, 6, "top", len(left), max(0, len(left) - 5), min(5, len(left))))
        assert [x for x in got if x[0] == p] == want
