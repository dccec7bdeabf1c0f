"""Scalar functions, as columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of URLs that mark no photograph.
JUNK = ("favicon", "logo", "icon", "pixel", "spacer", "tracking", "1x1", "sprite", "svg", "badge", "avatar", "star", "rating", "/a/", "/a-/", "maps.googleapis.com", "maps.gstatic.com", "khms", "tile.openstreetmap", "maps/api/", "map-tile")
# Domains that an image page links to for itself.
SKIP_DOMAINS = ("google.", "gstatic.", "googleapis.", "schema.org", "youtube.", "blogger.")
# Phrases of result-page furniture.
NOISE = ("About this result", "Search Labs", "Google apps", "Google Account", "More filters", "Tools", "Search", "Page 2", "Page 3", "Page 4", "Page 5", "Page 6", "Page 7", "Page 8", "Page 9", "Page 10", "How much", "Are meals", "What is the least", "Is ", "More info", '"Read more"')
# Search templates, with and without a known location.
QUERIES_WITH_LOCATION = ("", " {l} resort", " {l} nature view", " {l} surroundings", " {l} aerial view", " {l} scenic drive to")
QUERIES_FALLBACK = ("", " hotel resort", " nature view", " surroundings", " aerial view", " scenic landscape")
# MIME types by extension.
MIME = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "webp": "image/webp", "gif": "image/gif", "mp4": "video/mp4", "mov": "video/quicktime", "webm": "video/webm"}
# The type of a file whose extension is not of its family.
MIME_DEFAULT = {"image": "image/jpeg", "video": "video/mp4"}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_of(c: Column, parts: tuple[str, ...]) -> Column:
    """Whether c holds one of the literal parts."""
    return reduce(lambda a, p: a | c.contains(p), parts[1:], c.contains(parts[0]))


def is_junk(url: Column | str) -> Column:
    return any_of(F.lower(col(url)), JUNK)


def is_skipped_domain(url: Column | str) -> Column:
    return any_of(col(url), SKIP_DOMAINS)


def drop_noise_lines(text: Column | str) -> Column:
    return F.array_join(F.filter(F.split(col(text), "\n"), lambda x: ~any_of(x, NOISE)), "\n")


def display_name(name: Column | str) -> Column:
    """The name without its version suffix."""
    return F.regexp_replace(col(name), r"\s+v\d+$", "")


def base_key(path: Column | str) -> Column:
    """The first four digits of the file name, or null."""
    return F.nullif(F.regexp_extract(F.substring_index(col(path), "/", -1), "[0-9]{4}", 0), F.lit(""))


def full_size_url(url: Column | str) -> Column:
    """Three hosts' image URLs at full size; others as they are."""
    u = col(url)
    return (
        F.when(u.contains("cache.marriott.com/is/image/"), F.regexp_replace(u, r"wid=\d+", "wid=2000"))
        .when(u.contains("marriott-renditions") & u.contains("downsize="), F.regexp_replace(F.regexp_replace(u, r"downsize=\d+px:\*", ""), "[&?]+$", ""))
        .when(u.contains("fourseasons.com/alt/img-opt/"), F.regexp_replace(u, r"~\d+\.\d+\.", "~90.2000."))
        .otherwise(u)
    )


def unescape_url(url: Column | str) -> Column:
    return F.replace(F.replace(col(url), F.lit("\\u003d"), F.lit("=")), F.lit("\\u0026"), F.lit("&"))


def encode_query(text: Column | str) -> Column:
    """Spaces and ampersands only."""
    return F.replace(F.replace(col(text), F.lit(" "), F.lit("+")), F.lit("&"), F.lit("%26"))


def bare_domain(text: Column | str) -> Column:
    c = F.lower(F.trim(col(text)))
    for part in ("https://", "http://", "www."):
        c = F.replace(c, F.lit(part), F.lit(""))
    return F.regexp_replace(c, "/+$", "")


def search_queries(poi: Column | str, location: Column | str, suffixes: Column | str | None = None) -> Column:
    """The name alone and five more queries: from four or more suffixes, else from the templates."""
    p, loc = col(poi), col(location)
    has = loc.isNotNull() & (loc != "")
    placed = F.array(*[F.concat(p, F.replace(F.lit(q), F.lit("{l}"), loc)) for q in QUERIES_WITH_LOCATION])
    plain = F.array(*[F.concat(p, F.lit(q)) for q in QUERIES_FALLBACK])
    out = F.when(has, placed).otherwise(plain)
    if suffixes is None:
        return out
    s = col(suffixes)
    made = F.concat(F.array(p), F.transform(F.slice(s, 1, 4), lambda x: F.trim(F.concat(p, F.lit(" "), F.coalesce(loc, F.lit("")), F.lit(" "), x))))
    return F.when(F.size(s) >= 4, made).otherwise(out)


def per_query(most: Column | int, queries: Column) -> Column:
    m = F.lit(most) if isinstance(most, int) else most
    return F.greatest(F.floor(m / F.size(queries)).cast("int"), F.lit(10))


def guess_extension(url: Column | str) -> Column:
    u = F.lower(col(url))
    return F.when(u.contains(".png"), ".png").when(u.contains(".webp"), ".webp").when(u.contains(".jpeg"), ".jpeg").otherwise(".jpg")


def mime_type(path: Column | str, family: str = "image") -> Column:
    """The type by the extension, if it is one of the family; else the family's default."""
    table = F.create_map(*[F.lit(x) for k, v in MIME.items() if v.startswith(f"{family}/") for x in (k, v)])
    return F.coalesce(F.try_element_at(table, F.lower(F.substring_index(col(path), ".", -1))), F.lit(MIME_DEFAULT[family]))


def storage_path(poi: Column | str, run: Column | str, stage: Column | str, name: Column | str) -> Column:
    """pois/poi/[run/]stage/name; a null or empty run is left out."""
    return F.concat_ws("/", F.lit("pois"), col(poi), F.nullif(col(run), F.lit("")), col(stage), col(name))


def archive_path(poi: Column | str, stamp: Column | str, stage: Column | str, name: Column | str) -> Column:
    return F.concat_ws("/", F.lit("pois"), col(poi), F.lit("archive"), col(stamp), col(stage), col(name))


def public_url(base: Column | str, path: Column | str) -> Column:
    return F.concat(col(base), F.lit("/"), col(path))


def split_path(path: Column | str) -> Column:
    """struct(dir, name) by the last slash; null without one."""
    p = col(path)
    return F.when(p.contains("/"), F.struct(F.regexp_replace(p, "/[^/]*$", "").alias("dir"), F.substring_index(p, "/", -1).alias("name")))


def short_location(location: Column | str) -> Column:
    return F.trim(F.substring_index(col(location), ",", -1))


def known(reply: Column | str) -> Column:
    """A trimmed answer; null for an empty one and for UNKNOWN."""
    answer = F.trim(col(reply))
    return F.when((answer != "") & (F.upper(answer) != "UNKNOWN"), answer)


def first_ref(reply: Column | str) -> Column:
    """The first integer of a reply; null for none, `none` and empty ones."""
    r = F.trim(col(reply))
    return F.when((F.lower(r) != "none") & (r != ""), F.nullif(F.regexp_extract(r, "[0-9]+", 0), F.lit("")))


# Characters of a page's snapshot that a model is asked about.
SNAPSHOT = 8000


def asked_about(snapshot: Column | str) -> Column:
    """The part of a page's snapshot that a model is asked about."""
    return F.substring(col(snapshot), 1, SNAPSHOT)


def first_refs(reply: Column | str, k: int) -> Column:
    return F.slice(F.regexp_extract_all(col(reply), F.lit("([0-9]+)"), F.lit(1)), 1, k)


def clean_label(label: Column | str) -> Column:
    """Without the trailing full stop, before the first bar."""
    return F.trim(F.substring_index(F.regexp_replace(col(label), r"\.+$", ""), "|", 1))


def note(notes: Column | str, key: str) -> Column:
    """A value of a JSON object kept as text; null where it is missing or the text is no JSON."""
    return F.get_json_object(col(notes), f"$.{key}")


def _edited(notes: Column | str, key: str, value: Column | None, gap: str = "") -> Column:
    """The JSON text of notes without the key, or with value (JSON text) under it; gap: what follows commas and colons.

    Members are read as variants, so that numbers, truth values, lists and objects stay what they are and keep their order;
    of a repeated member the last counts. A decimal fraction of zeros goes (1.0 is written 1). Text that is no object is
    an empty one, nulls included."""
    some = F.coalesce(F.map_entries(F.from_json(col(notes), "map<string,variant>")), F.array().cast("array<struct<key:string,value:variant>>"))
    keys = F.array_distinct(F.transform(some, lambda e: e["key"]))
    quoted = lambda k: F.to_json(k.cast("variant"))
    written = lambda k: F.to_json(F.element_at(F.filter(some, lambda e: e["key"] == k), -1)["value"])
    if value is None:
        texts = F.transform(F.filter(keys, lambda k: k != key), lambda k: F.concat(quoted(k), F.lit(f":{gap}"), written(k)))
    else:
        keys = F.array_union(keys, F.array(F.lit(key)))  # a new key is the last
        texts = F.transform(keys, lambda k: F.concat(quoted(k), F.lit(f":{gap}"), F.when(k == key, F.coalesce(value, F.lit("null"))).otherwise(written(k))))
    return F.concat(F.lit("{"), F.array_join(texts, f",{gap}"), F.lit("}"))


def put_note(notes: Column | str, key: str, value: Column) -> Column:
    """The JSON text with a value of any simple type put under a key; other members keep their types. Text that is no
    object starts anew; a null value is JSON's null."""
    return _edited(notes, key, F.to_json(value.cast("variant")))


def pop_note(notes: Column | str, key: str) -> Column:
    """The JSON text without a key; other members keep their types."""
    return _edited(notes, key, None)


def put_note_list(notes: Column | str, key: str, values: Column) -> Column:
    """As put_note, for an array of strings (null: an empty one), written with a blank after commas and colons."""
    items = F.transform(F.coalesce(values, F.array().cast("array<string>")), lambda v: F.coalesce(F.to_json(v.cast("variant")), F.lit("null")))
    return _edited(notes, key, F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]")), " ")


def suffix_list(reply: Column | str) -> Column:
    """Four trimmed strings of a JSON list, fenced or not; null for shorter lists and other text."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(col(reply)), "^`+(json)?\\s*", ""), "`+\\s*$", "")
    found = F.from_json(bare, "array<string>")
    return F.when(F.size(found) >= 4, F.transform(F.slice(found, 1, 4), lambda x: F.trim(x)))


def age_days(at: Column | str, now: Column) -> Column:
    """Whole periods of 24 hours; not a difference of dates."""
    return F.floor((F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(col(at).cast("timestamp"))) / 86400)


def iso_timestamp(text: Column | str) -> Column:
    return F.try_to_timestamp(F.regexp_replace(col(text), "Z$", "+00:00"))


def stamp(at: Column | str) -> Column:
    return F.date_format(col(at), "yyyyMMdd_HHmmss")


def clamp_fps(fps: Column | str) -> Column:
    f = F.coalesce(F.nullif(col(fps), F.lit(0)), F.lit(2))
    return F.greatest(F.lit(2), F.least(F.lit(10), f))


def target_bitrate(mb: Column | str, seconds: Column | str) -> Column:
    """kbit/s for a size of mb, truncated."""
    return (col(mb) * 8 * 1024 * 1024 / col(seconds) / 1000).cast("long")


def needs_compression(size_mb: Column | str, most: float = 10.0) -> Column:
    return col(size_mb) > most


def retry_budget(n: Column | str) -> Column:
    return F.greatest(F.floor(col(n) * 0.5).cast("int"), F.lit(50))


def truthy(text: Column | str) -> Column:
    return F.lower(col(text)).isin("true", "1", "yes")


# Patch edge, patches merged on an edge, frames in a grid, pixel and frame limits of the video model.
PATCH, MERGE, FRAMES_PER_GRID, MAX_TOKENS, MIN_PIX, MAX_PIX, MAX_FRAMES, FRAME_TOKENS = 16, 2, 2, 131072, 8192, 8388608, 2048, 300


def video_tokens(duration: Column | str, width: Column | str, height: Column | str, fps: Column, full: bool = False, mute: bool = False) -> Column:
    """Input tokens of a video: vision grids, a time stamp and two marks for each, and sound.

    Rounds half to even; a side below one merged patch is scaled up to it."""
    d, w0, h0 = col(duration), col(width).cast("double"), col(height).cast("double")
    edge = PATCH * MERGE
    pix = edge * edge
    frames = F.least(F.ceil(d * fps), F.lit(MAX_FRAMES))
    frames = F.greatest(F.ceil(frames / FRAMES_PER_GRID) * FRAMES_PER_GRID, F.lit(FRAMES_PER_GRID))
    budget = F.lit(float(MAX_TOKENS * pix * FRAMES_PER_GRID)) / frames
    if not full:
        budget = F.least(budget, F.lit(float(FRAME_TOKENS * pix)))
    budget = F.greatest(F.lit(float(MIN_PIX)), F.least(budget, F.lit(float(MAX_PIX))))
    small = F.least(h0, w0) < edge
    w = F.when(small, F.when(h0 < w0, F.floor(w0 * edge / h0)).otherwise(edge)).otherwise(w0)
    h = F.when(small, F.when(h0 < w0, F.lit(edge)).otherwise(F.floor(h0 * edge / w0))).otherwise(h0)
    hb, wb = F.rint(h / edge) * edge, F.rint(w / edge) * edge
    over, under = F.sqrt(h * w / budget), F.sqrt(F.lit(float(MIN_PIX)) / (h * w))
    fit = lambda side, bar: F.when(hb * wb > budget, F.floor(side / over / edge) * edge).when(hb * wb < MIN_PIX, F.ceil(side * under / edge) * edge).otherwise(bar)
    grids = frames / FRAMES_PER_GRID
    each = F.floor(fit(h, hb) / PATCH * fit(w, wb) / PATCH / (MERGE * MERGE))
    total = grids * each + grids * F.when(fps > 2, 5).otherwise(3) + grids * 2 + 2
    if not mute:
        spectrum = F.floor(d * 100) + 1
        t = F.floor((spectrum - 1) / 2) + 1
        t = F.floor(t / 2) + F.pmod(t, F.lit(2))
        total = total + F.ceil(t / 4) + 2
    return total.cast("long")


def bbox(points: Column) -> dict[str, Column]:
    """x0, y0, x1, y1 of an array of points."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """The vector over its length; nulls of one of zeros, which is near nothing."""
    n = F.nullif(F.sqrt(dot(v, v)), F.lit(0.0))
    return F.transform(v, lambda x: x.cast("double") / n)


def words_in_common(a: Column, b: Column) -> Column:
    parts = lambda c: F.array_distinct(F.array_remove(F.split(F.lower(c), r"\s+"), ""))
    return F.size(F.array_intersect(parts(a), parts(b)))


def judge_prompt(poi: Column | str, location: Column | str, description: Column | str, count: Column | str) -> Column:
    """What a judge of images is asked; place and description appear where they are known."""
    loc, what = col(location), col(description)
    return F.concat(F.lit("Place: "), col(poi), F.when(loc != "", F.concat(F.lit(", "), loc)).otherwise(""), F.when(what != "", F.concat(F.lit("\nAbout: "), what)).otherwise(""), F.lit("\nImages: "), col(count).cast("string"), F.lit("\nAnswer `n. KEEP` or `n. REJECT` for each, then one line `TOP15:` with the best in order."))
