"""Clients for sources.readers.fetch: what a search, a download, an upload or a probe does with errors.

The call that needs a network, a browser or a program is always given; the rules around it are here. Clients take and
return pandas frames, one row of input at a time failing alone.
"""

from __future__ import annotations

import base64
import json
import logging
import time
from collections.abc import Callable
from urllib.parse import urlparse

import pandas as pd

from siftstone.functions.judge import FAILED, REPLIED, SKIPPED

log = logging.getLogger(__name__)

# Types that a download may have, and its least length.
DOWNLOAD_TYPES, DOWNLOAD_LEAST = ("image", "octet-stream"), 5000
# Bytes up to which an image is sent as it is.
SHRINK_ABOVE = 2048 * 1024


def search(source: str, find: Callable[[str], list[str | None]], key: str | None = "", most: int = 20) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (poi, ord, query) -> poi, ord, query, source, url, nth: what find(query) gives, `most` at most.

    Without a key (None) there are no results; a query that fails has none, and the others go on; empty URLs are dropped."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pdf.itertuples(index=False) if key is not None else ():
            try:
                found = [u for u in find(row.query)[:most] if u]
            except Exception as error:
                log.warning("%s: %r failed: %s", source, row.query, error)
                continue
            out += [(row.poi, row.ord, row.query, source, u, n) for n, u in enumerate(found)]
        return pd.DataFrame(out, columns=["poi", "ord", "query", "source", "url", "nth"])

    return run


class HttpError(Exception):
    """What get() raises for an answer that is not a success."""


def download(get: Callable[[str, dict[str, str]], tuple[str, bytes]], headers: dict[str, str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows with url -> the same with content, null where nothing valid came. get(url, headers): type and bytes.

    First with the site itself as Referer, then, after an HTTP error, without; another error is final. Valid is an image
    or plain bytes of DOWNLOAD_LEAST or more; what is not is not tried again."""

    def one(url: str) -> bytes | None:
        at = urlparse(url)
        for extra in ({"Referer": f"{at.scheme}://{at.netloc}/"}, {}):
            try:
                kind, content = get(url, {**headers, **extra})
            except HttpError:
                continue
            except Exception as error:
                log.warning("%s: %s", url, error)
                return None
            return content if any(t in kind for t in DOWNLOAD_TYPES) and len(content) >= DOWNLOAD_LEAST else None
        return None

    return lambda pdf: pdf.assign(content=[one(u) for u in pdf["url"]])


def upload(put: Callable[[str, bytes, str], None], exists: Callable[[str], bool], public_url: Callable[[str], str], tries: int = 3, wait: Callable[[int], None] = lambda k: None) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (path, content, mime) -> path, url; url is null where the upload failed.

    put() is tried `tries` times; if the last try fails and the object is there all the same, that is a success."""

    def one(path: str, content: bytes, mime: str) -> str | None:
        for k in range(tries):
            try:
                put(path, content, mime)
                return public_url(path)
            except Exception as error:
                log.warning("%s: try %d of %d: %s", path, k + 1, tries, error)
                if k + 1 < tries:
                    wait(k)
        try:
            return public_url(path) if exists(path) else None
        except Exception as error:
            log.warning("%s: %s", path, error)
            return None

    return lambda pdf: pd.DataFrame({"path": pdf["path"], "url": [one(*r) for r in pdf[["path", "content", "mime"]].itertuples(index=False)]}, dtype=object)


def encode_images(shrink: Callable[[bytes], bytes], above: int = SHRINK_ABOVE) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (path, content, mime) -> path, data (base64), mime. Content over `above` bytes is shrunk first and then a
    JPEG; where that fails it goes as it is."""

    def one(path: str, content: bytes, mime: str) -> tuple[str, str, str]:
        if len(content) > above:
            try:
                content, mime = shrink(content), "image/jpeg"
            except Exception as error:
                log.warning("%s: %s", path, error)
        return path, base64.b64encode(content).decode(), mime

    return lambda pdf: pd.DataFrame([one(*r) for r in pdf[["path", "content", "mime"]].itertuples(index=False)], columns=["path", "data", "mime"])


# Subpages of a site that are read beside its first page.
SUBPAGES = 3
# Frames a second that a video is asked about with.
FPS_LEAST, FPS_MOST = 2, 10


def crawl(open_page: Callable[[str], tuple[str, list[str]]], choose: Callable[[str, list[str]], list[str]], most: int = SUBPAGES) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (poi, url) -> poi, nth, subpage, html: a site's first page and up to `most` of the pages it links to.

    open_page(url): HTML and links; choose(poi, links): the links to follow. Where choosing fails none is followed; a
    page that does not open is left out, and if that is the first one, so is the site."""

    def one(poi: str, url: str) -> list[tuple[str, int, str, str]]:
        try:
            html, links = open_page(url)
        except Exception as error:
            log.warning("%s: %s", url, error)
            return []
        out = [(poi, 0, url, html)]
        try:
            chosen = [u for u in dict.fromkeys(choose(poi, links)) if u in links and u != url][:most]
        except Exception as error:
            log.warning("%s: %s", poi, error)
            chosen = []
        for k, sub in enumerate(chosen):
            try:
                out.append((poi, k + 1, sub, open_page(sub)[0]))
            except Exception as error:
                log.warning("%s: %s", sub, error)
        return out

    return lambda pdf: pd.DataFrame([r for x in pdf[["poi", "url"]].itertuples(index=False) for r in one(*x)], columns=["poi", "nth", "subpage", "html"])


# The names in the request and the reply of ask() are fixed values: they are the service's.


def ask(post: Callable[[dict], tuple[int, str]], model: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (poi, prompt, urls, images, videos, fps) -> poi, reply: one call of a multimodal model a row.

    urls: image links; images: (mime, base64) pairs; videos: links, asked about at fps frames a second, from 2 to 10. An
    answer other than 200 is raised."""

    def one(poi, prompt, urls, images, videos, fps) -> tuple[str, str]:
        content = [{"type": "text", "text": prompt}]
        content += [{"type": "image_url", "image_url": {"url": u}} for u in _items(urls)]
        content += [{"type": "image_url", "image_url": {"url": f"data:{m};base64,{d}"}} for m, d in _items(images)]
        rate = min(FPS_MOST, max(FPS_LEAST, int(fps or FPS_LEAST)))
        content += [{"type": "video_url", "video_url": {"url": u}, "fps": rate} for u in _items(videos)]
        status, body = post({"model": model, "messages": [{"role": "user", "content": content}]})
        if status != 200:
            raise HttpError(f"{status}: {body[:200]}")
        return poi, body

    return lambda pdf: pd.DataFrame([one(*r) for r in pdf[["poi", "prompt", "urls", "images", "videos", "fps"]].itertuples(index=False)], columns=["poi", "reply"])


# Tries of a judge's call, and seconds after each that brought nothing.
JUDGE_TRIES, JUDGE_WAITS = 3, (5, 15)


def judged(call: Callable[[object], str | None] | None, tries: int = JUDGE_TRIES, waits: tuple[float, ...] = JUDGE_WAITS, sleep: Callable[[float], None] = time.sleep) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows with poi -> poi, outcome, content: what call(row) replies, tried again after an error or a blank reply.

    Without a call (no key) every row is skipped, which lets its group pass. A row of which all tries came to nothing has
    failed, and so does its group; the other rows go on. One wait lies between two tries, none after the last."""

    def one(row) -> tuple[object, str, str | None]:
        if call is None:
            return row.poi, SKIPPED, None
        for k in range(tries):
            try:
                content = call(row)
                if content and content.strip():
                    return row.poi, REPLIED, content
                log.warning("%s: blank reply in try %d of %d", row.poi, k + 1, tries)
            except Exception as error:
                log.warning("%s: try %d of %d: %s", row.poi, k + 1, tries, error)
            if k + 1 < tries:
                sleep(waits[min(k, len(waits) - 1)])
        return row.poi, FAILED, None

    return lambda pdf: pd.DataFrame([one(r) for r in pdf.itertuples(index=False)], columns=["poi", "outcome", "content"], dtype=object)


def _items(values) -> list:
    return [] if values is None else list(values)


def probe(describe: Callable[[str], str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (path) -> path, duration, width, height. describe(path): the JSON that a media prober prints of the format's
    duration and the first video stream's sides; an error of it, or a reply without them, is raised."""

    def one(path: str) -> tuple[str, float, int, int]:
        said = json.loads(describe(path))
        return path, float(said["format"]["duration"]), int(said["streams"][0]["width"]), int(said["streams"][0]["height"])

    return lambda pdf: pd.DataFrame([one(p) for p in pdf["path"]], columns=["path", "duration", "width", "height"])
