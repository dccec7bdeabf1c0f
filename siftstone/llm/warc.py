"""WARC archives as tables of chunks.

Writing: payloads are cut where they are read. One up to `chunk` bytes is one record; a larger one is a segmented record, a
row for each chunk (record and chunk number) with the digest carried from chunk to chunk, and only such rows are shuffled,
sorted and joined: no step after the scan holds a whole record. Every row is one WARC record and ends with an empty line,
which is the row separator of Spark's text writer: archives are therefore written by Spark's own committer to any store,
gzipped, and survive a lost executor. A file takes a fixed number of rows, so a record that is larger than an archive goes
on in the next one.

Reading goes by Content-Length, never by what a payload may contain, file by file: each is of bounded size, and so is what is
held of one. A record that lies in one file is digested there. The segments of one that does not are shuffled by record
and segment number, and a digest is carried along them.

Every input row is a record of its own: its id is made of page id, payload digest and the row's place in the table. Rows that
repeat an id, with the same payload or others, and rows without one do not meet. The place must be the same whenever the
table is read, as it is of files.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.common import fresh_path, materialize

CHUNK = 1 << 20
#: Bytes of uncompressed records that one archive holds, about.
ARCHIVE = 32 << 20
DATE = "2024-01-01T00:00:00Z"
#: Archives that one task writes, about.
TASK = 8
#: Bytes of a record besides its payload, about.
HEAD = 600


def base32(hex_digest: Column) -> Column:
    """Bare upper-case base32 of a 40-digit hex string: five bytes are eight characters."""
    part = lambda k: F.translate(F.lpad(F.conv(F.substring(hex_digest, 10 * k + 1, 10), 16, 32), 8, "0"), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*(part(k) for k in range(4)))


def payload(html: str) -> Column:
    return F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")


def chunks(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """rows (body binary and others) -> the same with chunk_no and n_chunks, body cut: in order within each record."""
    n = F.greatest(F.ceil(F.length("body") / F.lit(size)).cast("int"), F.lit(1))
    cut = rows.select("*", n.alias("n_chunks")).select("*", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("chunk_no"))
    return cut.withColumn("body", F.substring("body", F.col("chunk_no") * size + 1, F.lit(size)))


def chunk_digests(table: DataFrame) -> DataFrame:
    """The chunk table, in order within each partition, with running: hex SHA-1 of the record up to the chunk.

    One hash state goes from chunk to chunk; only one batch of chunks is in memory."""
    names = table.columns
    no_at, body_at = names.index("chunk_no"), names.index("body")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = hashlib.sha1()
        for batch in batches:
            out = []
            for no, body in zip(batch.column(no_at).to_pylist(), batch.column(body_at), strict=True):
                if no == 0:
                    state = hashlib.sha1()
                state.update(body.as_buffer())
                out.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*names, "running"])

    return table.mapInArrow(run, ", ".join(f"`{k}` {t}" for k, t in table.dtypes) + ", running string")


class Archive(NamedTuple):
    """Where write() has put the archives."""

    path: str
    parts: tuple[str, ...]


def _rows(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    uri = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\r\n]", " ")
    rows = pages.select(F.monotonically_increasing_id().alias("k"), F.col(page_id).alias("id"), uri.alias("uri"), payload(html).alias("body"))
    return rows.select("k", "id", "uri", "body", F.length("body").cast("long").alias("n_bytes"), base32(F.sha1("body")).alias("digest"))


def revisits(table: DataFrame, min_bytes: int) -> DataFrame:
    """table (k, id, digest, n_bytes), a row a page -> k, refers_to, refers_k of the pages that are no response: the id whose
    payload they repeat, and the place of its first row."""
    first = table.filter((F.col("n_bytes") >= min_bytes) & F.col("id").isNotNull()).groupBy("digest").agg(F.min(F.struct("id", "k")).alias("first"))
    again = table.join(first, "digest").filter(F.col("id").isNull() | (F.col("id") != F.col("first.id")))
    return again.select("k", F.col("first.id").alias("refers_to"), F.col("first.k").alias("refers_k"))


def _records(rows: DataFrame) -> Column:
    """The WARC record of each row of (id, uri, digest, n_bytes, refers_to, refers_k, k, chunk_no, n_chunks, running, body)."""
    again, cut = F.col("refers_to").isNotNull(), F.col("n_chunks") > 1
    text = lambda c: F.url_encode(F.col(c)) if dict(rows.dtypes)[c] == "string" else F.col(c).cast("string")
    urn = lambda ident, *more: F.concat(F.lit("<urn:page:"), F.coalesce(ident, F.lit("")), F.lit(":"), F.col("digest"), *more, F.lit(">"))
    own = urn(text("id"), F.lit(":"), F.col("k").cast("string"))
    fields = {
        "WARC-Record-ID": F.when(F.col("chunk_no") == 0, own).otherwise(urn(text("id"), F.lit(":"), F.col("k").cast("string"), F.lit(":"), (F.col("chunk_no") + 1).cast("string"))),
        "WARC-Date": F.lit(DATE),
        "WARC-Target-URI": F.when(F.col("uri") != "", F.col("uri")),
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
        "WARC-Refers-To": F.when(again, urn(text("refers_to"), F.lit(":"), F.col("refers_k").cast("string"))),
        "WARC-Profile": F.when(again, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        "WARC-Segment-Number": F.when(cut, F.col("chunk_no") + 1),
        "WARC-Segment-Origin-ID": F.when(F.col("chunk_no") > 0, own),
        "WARC-Segment-Total-Length": F.when(cut & (F.col("chunk_no") == F.col("n_chunks") - 1), F.col("n_bytes")),
        "X-Running-Digest": F.when(cut, F.concat(F.lit("sha1:"), base32(F.col("running")))),
        "X-Payload-Length": F.col("n_bytes"),
        "X-Page-ID": text("id"),
        "X-Refers-To-Page": text("refers_to"),
        "Content-Type": F.lit("text/html"),
        "Content-Length": F.length("body"),
    }
    lines = [F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit("")) for name, value in fields.items()]
    kind = F.when(again, "revisit").when(F.col("chunk_no") == 0, "response").otherwise("continuation")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\n"), *lines, F.lit("\r\n"))
    return F.concat(F.encode(head, "utf-8"), F.col("body")).cast("string")


def write(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, chunk: int = CHUNK, archive: int = ARCHIVE) -> Archive:
    """Write one record for each page; payload: html in UTF-8 (null: empty).

    Of equal payloads of min_bytes or more, the one with the smallest page_id is a response and the others
    revisit it (rows that repeat that page_id are responses too; if all ids are null, all are). Payloads over
    chunk bytes are segmented. Which page revisits which is found in a narrow table; pages are read a second time, and
    their chunks are shuffled once, by the page's place in the table, so that no key is hot. An archive holds about
    `archive` bytes before compression. An empty table gives no records; other columns of pages are ignored."""
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    rows = _rows(pages, page_id, url, html)
    # all that the second reading takes is read here too, so that rows have the same places
    table = materialize(rows.select("k", "id", "digest", "n_bytes", F.length("uri").alias("u")), "digests")
    again = materialize(revisits(table, min_bytes), "revisits")
    large = F.col("n_bytes") > chunk
    sums = table.groupBy(large.alias("large")).agg(F.sum(F.col("n_bytes") + HEAD).alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    written = []
    for r in sorted(sums, key=lambda r: r["large"]):
        n = int(max(1, -(-r["bytes"] // (TASK * archive)), min(spark.sparkContext.defaultParallelism, r["n"] // 256)))
        if r["large"]:
            of, one = chunk_digests(chunks(rows.filter(large), chunk)), chunk + HEAD
        else:
            of, one = rows.filter(~large).withColumns({"chunk_no": F.lit(0), "n_chunks": F.lit(1), "running": F.lit("")}), r["bytes"] // r["n"]
        of = of.repartition(n, "k").join(again.repartition(n, "k"), "k", "left")
        revisit = F.col("refers_to").isNotNull()
        of = of.filter(~revisit | (F.col("chunk_no") == 0)).withColumn("n_chunks", F.when(revisit, 1).otherwise(F.col("n_chunks")))
        of = of.withColumn("body", F.when(revisit, F.lit(b"")).otherwise(F.col("body"))).sortWithinPartitions("k", "chunk_no")
        written.append(f"{path}/{'segmented' if r['large'] else 'whole'}")
        out = of.select(_records(of).alias("value")).write.option("maxRecordsPerFile", int(max(1, archive // one)))
        out.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(written[-1])
    return Archive(path, tuple(written))


_FIELD = re.compile(rb"([A-Za-z-]+): ([^\r\n]*)\r\n")


def parse(data: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one gzipped archive, one at a time; only the record at hand is unpacked."""
    unzip, held, fed, n = zlib.decompressobj(31), bytearray(), 0, len(data)

    def more() -> bool:
        nonlocal fed, unzip
        while fed < n or unzip.unconsumed_tail:
            piece = unzip.unconsumed_tail or bytes(data[fed : fed + (1 << 16)])
            fed += 0 if unzip.unconsumed_tail else len(piece)
            got = unzip.decompress(piece, 1 << 20)
            if unzip.eof and (unzip.unused_data or fed < n):
                rest = unzip.unused_data
                unzip = zlib.decompressobj(31)
                fed -= len(rest)
            held.extend(got)
            if got:
                return True
        return False

    at = 0  # where the record at hand begins in held
    while True:
        while (end := held.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if held[at:].strip():
                    raise ValueError("an archive ends within a header")
                return
        head = {a.decode(): b.decode("utf-8", "replace") for a, b in _FIELD.findall(bytes(held[at : end + 2]))}
        start = end + 4
        end = start + int(head["Content-Length"])
        while len(held) < end + 4:
            if not more():
                raise ValueError("an archive ends within a record")
        if held[end : end + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")
        yield head, bytes(held[start:end])
        at = end + 4
        if at > 1 << 20:
            del held[:at]
            at = 0


_OUT = "record_id string, page_id string, chunk_no int, last boolean, record_type string, refers_to string, n_bytes long, so_far long, running string, payload_bytes long, payload_digest string, body binary, whole boolean"
_NAMES = [x.split()[0] for x in _OUT.split(", ")]
_TYPES = [{"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in _OUT.split(", ")]


def _pack(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


class _Run:
    """The segments of one record, as they come: a digest is carried along, from the first segment on."""

    def __init__(self, origin: str, first: int):
        self.origin, self.next, self.known, self.done = origin, first, first == 0, False
        self.state, self.so_far = hashlib.sha1(), 0

    def add(self, number: int, body: bytes, last: bool, kind: str, digest: str) -> tuple[int | None, str | None]:
        """Length and digest of the payload up to this segment; unknown of a run that does not begin at the first."""
        if self.done or number != self.next:
            raise ValueError(f"a segment is missing before segment {number + 1} of {self.origin}")
        self.next, self.done = number + 1, last
        if not self.known:
            return None, None
        self.state.update(body)
        self.so_far += len(body)
        running = base64.b32encode(self.state.digest()).decode()
        if last and kind != "revisit" and running != digest:
            raise ValueError(f"the payload of {self.origin} is not that of its digest")
        return self.so_far, running


def _segments(spark: SparkSession, archive: Archive, bodies: bool) -> DataFrame:
    """A row for each WARC record, file by file; whole: all of its payload's segments are in the file. Of others the body
    comes along in any case, and length and digest are still unknown."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held, now, open_rows = [], 0, None, []

                def close(now=None) -> None:  # the record at hand has ended, or the file or another record cuts it off
                    for r in open_rows:
                        r[-1] = bool(now and now.done and now.known)
                        if r[-1] and not bodies:
                            r[-2] = None
                    rows.extend(open_rows)
                    open_rows.clear()

                for head, body in parse(memoryview(content.as_buffer())):
                    number = int(head.get("WARC-Segment-Number", 1)) - 1
                    origin = head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"])
                    last = "WARC-Segment-Number" not in head or "WARC-Segment-Total-Length" in head
                    if now is None or now.origin != origin:
                        close()
                        now = _Run(origin, number)
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    so_far, running = now.add(number, body, last, head["WARC-Type"], digest)
                    open_rows.append([origin, head.get("X-Page-ID"), number, last, head["WARC-Type"], head.get("X-Refers-To-Page"), len(body), so_far, running, int(head["X-Payload-Length"]), digest, body, False])
                    held += len(body) + 400
                    if last:
                        close(now)
                        now = None
                    if held > 8 << 20 and rows:
                        yield _pack(rows)
                        rows, held = [], 0
                close()
                if rows:
                    yield _pack(rows)

    files = spark.read.format("binaryFile").load(list(archive.parts)).select("content")
    return files.mapInArrow(run, _OUT)


def _joined(segments: DataFrame, bodies: bool) -> DataFrame:
    """Segments of records that lie in several files, by record and number, with length and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Run | None = None
        for batch in batches:
            rows = [list(r.values()) for r in batch.to_pylist()]
            for r in rows:
                if now is None or now.origin != r[0]:
                    if now is not None and not now.done:
                        raise ValueError(f"{now.origin} ends without its last segment")
                    if r[2] != 0:
                        raise ValueError(f"a segment is missing before segment {r[2] + 1} of {r[0]}")
                    now = _Run(r[0], 0)
                r[7], r[8] = now.add(r[2], r[11], r[3], r[4], r[10])
                r[11] = r[11] if bodies else None
            if rows:
                yield _pack(rows)
        if now is not None and not now.done:
            raise ValueError(f"{now.origin} ends without its last segment")

    return segments.repartition("record_id").sortWithinPartitions("record_id", "chunk_no").mapInArrow(run, _OUT)


def read(spark: SparkSession, archive: Archive, bodies: bool = True) -> DataFrame:
    """The chunk table of archives: a row for each WARC record: its own length, and length and SHA-1 (base32) of the
    payload up to its end (so_far, running), from the bytes read. With bodies, these come along, and the archives are
    read twice; without them a table of what was read is written between.

    Archives that are cut short, in which a segment is missing, or whose bytes belie a digest are refused."""
    if not archive.parts:
        return spark.createDataFrame([], _OUT).drop("whole")
    found = _segments(spark, archive, bodies)
    if not bodies:
        found = materialize(found, "segments")
    return found.filter("whole").unionByName(_joined(found.filter("not whole"), bodies)).drop("whole")


def read_pages(spark: SparkSession, archive: Archive, id_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: one row for each page of the archives.

    A response's length and digest are computed from what was read, over all its segments; a revisit has those
    of its header. id_type is that of the pages written."""
    found = read(spark, archive, bodies=False).filter("last")
    again = F.col("record_type") == "revisit"
    ident = lambda c: F.url_decode(F.col(c)) if id_type == "string" else F.col(c).cast(id_type)
    return found.select(
        ident("page_id").alias("page_id"),
        F.when(again, F.col("payload_bytes")).otherwise(F.col("so_far")).alias("payload_bytes"),
        F.when(again, F.col("payload_digest")).otherwise(F.col("running")).alias("payload_digest"),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        ident("refers_to").alias("refers_to"),
    )
