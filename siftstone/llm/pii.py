"""Personal data: patterns for four kinds of entities, and information-theoretic sanitisation around them.

The patterns give the base spans. Then co-occurrence over the whole corpus tells which terms give away an
entity: a term is a candidate if it stands near the same entity in several texts with different surroundings. A
text's surroundings are told by the least hash of the words around, beyond the nearest ones: copies and near copies
mostly share it and so do not pass for evidence, while a name in the same line of unlike texts does. Of a candidate,
every occurrence in the corpus is counted. The disclosure of a term is the conditional probability p(entity | term) and
the pointwise mutual information log2(p(entity | term) / p(entity)), both over all occurrences of terms in the corpus.
Above the upper threshold a term is removed, above the lower one generalised.

The corpus is read three times: for the terms near entities, for the candidates' occurrences, for the spans.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import append, fresh, materialize, worker_state

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
_ORDER = {k: i for i, k in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]{3,}")
_NOT_DIGIT = re.compile(r"[^0-9]+")


class Settings(NamedTuple):
    window: int = 3  # words on either side of an entity, in its line
    around: int = 24  # words on either side whose least hash, without those of the window, tells contexts apart
    min_bits: float = 4.0  # pointwise mutual information
    generalise: float = 0.5  # p(entity | term) from which a term is generalised
    min_contexts: int = 4  # different contexts in which the term then stands near the entity
    remove: float = 0.8  # p(entity | term) from which a term is removed
    remove_contexts: int = 3  # and the contexts that takes
    most: float = 0.5  # share of one context in the texts at most: a larger one is a text and its near copies
    told: int = 200_000  # terms that a worker holds as a table; more are found by a filter and a join
    part: int = 1 << 20  # terms that one such filter is for


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if k % 2:
            x = x * 2 - 9 if x > 4 else x * 2
        total += x
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the four patterns, by start, then kind; positions in code points, end exclusive."""
    out = []
    at = text.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(x) <= 3 and int(x) <= 255 for x in (p.lstrip("0") or "0" for p in m.group().split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _NOT_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    out.sort(key=lambda s: (s[1], _ORDER[s[0]]))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _place(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) * 2654435761 % (1 << 32)


def contexts(text: str, s: Settings) -> Iterator[tuple[str, int, int]]:
    """(term, entity, context) for the terms near each entity of one text. Terms are found once, and looked up by place,
    however far from the entity they stand; a term that runs into an entity counts as far as it is outside."""
    spans = base_spans(text)
    if not spans:
        return
    starts = array("q", (m.start() for m in _TERM.finditer(text)))
    word = lambda k: _TERM.match(text, starts[k]).group().lower()
    for kind, a, b in spans:
        i, j = bisect_left(starts, a), bisect_left(starts, b)
        line, end = text.rfind("\n", 0, a) + 1, text.find("\n", b)
        n_left = min(s.window, i - bisect_left(starts, line))
        n_right = min(s.window, (bisect_left(starts, end) if end >= 0 else len(starts)) - j)
        left = [word(k) for k in range(max(0, i - n_left - s.around), i)]
        right = [word(k) for k in range(j, min(len(starts), j + n_right + s.around))]
        if left and starts[i - 1] + len(left[-1]) > a:
            cut = text[starts[i - 1] : a].lower()
            left[-1:] = [cut] if len(cut) > 2 else []
            n_left -= not left or len(cut) < 3
        if b < len(text) and text[b - 1].isalpha() and (m := _TERM.match(text, b)):
            right = [m.group().lower(), *right]
            n_right = min(s.window, n_right + 1)
        near = {*left[len(left) - n_left :], *right[:n_right]}
        if near:
            beyond = (*left[: len(left) - n_left][-s.around :], *right[n_right:][: s.around])
            entity, context = _hash(kind, text[a:b].lower()), min(map(_place, beyond), default=-1)
            for term in near:
                yield term, entity, context


def _long(values) -> pa.Array:
    return pa.array(values, pa.int64())


def _near(docs: DataFrame, s: Settings) -> DataFrame:
    """term, entity, context and the text's hash, once for each occurrence; docs: h, t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("pii", dict)  # what an earlier operator has left goes
        for batch in batches:
            found = [(*c, h) for h, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) if (t := x.as_py()) for c in contexts(t, s)]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), *(_long([f[k] for f in found]) for k in (1, 2, 3))], ["term", "entity", "context", "h"])

    return docs.select("h", "t").mapInArrow(run, "term string, entity long, context long, h long")


class _Filter:
    """A bitmap of terms' hashes, 16 bits a term: which words may be one of them, remembered up to a fixed number."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size, self.memo = bits.tobytes(), len(bits) * 8, {}

    def __call__(self, word: str) -> str:
        """The term in lower case, or empty."""
        got = self.memo.get(word)
        if got is None:
            low = word.lower()
            b = zlib.crc32(low.encode("utf-8", "surrogatepass")) % self.size
            if len(self.memo) > 200_000:
                self.memo.clear()
            got = self.memo[word] = low if self.bits[b >> 3] >> (b & 7) & 1 else ""
        return got


def _parts(terms: DataFrame, s: Settings) -> Iterator[np.ndarray]:
    """Bitmaps for terms (term), in parts of about s.part terms each, whatever their number: a part's bitmap has 2 s.part
    bytes at most, and no more numbers than terms in a part reach the driver at once."""
    n = max(1, terms.count())
    parts = -(-n // s.part)
    size = 1 << max(10, (16 * -(-n // parts) - 1).bit_length())
    code = F.crc32(F.encode("term", "utf-8"))
    for part in range(parts):
        found = terms.filter(F.pmod(F.xxhash64("term"), F.lit(parts)) == part).select(F.pmod(code, F.lit(size)).cast("int").alias("b")).distinct()
        at = found.toArrow().column("b").to_numpy().astype(np.int64)
        bits = np.zeros(size // 8, dtype=np.uint8)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield bits


def _totals(docs: DataFrame, terms: DataFrame, s: Settings) -> DataFrame:
    """term, total: how often each of the terms occurs in all of docs, and under the empty term all occurrences of any
    term; counted within each task first, so that a frequent term is one row a task, not one an occurrence."""
    out = []
    for nth, bits in enumerate(_parts(terms, s)):
        shared = docs.sparkSession.sparkContext.broadcast(bits)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, everything=nth == 0) -> Iterator[pa.RecordBatch]:
            known, counts = _Filter(shared.value), Counter()

            def out() -> pa.RecordBatch:
                rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), _long(list(counts.values()))], ["term", "n"])
                counts.clear()
                return rows

            for batch in batches:
                for x in batch.column(0):
                    words = _TERM.findall(x.as_py() or "")
                    counts.update(filter(None, map(known, words)))
                    if everything:
                        counts[""] += len(words)
                    if len(counts) > 100_000:
                        yield out()
            yield out()

        out.append(docs.select("t").mapInArrow(run, "term string, n long"))
    return reduce(DataFrame.unionByName, out).groupBy("term").agg(F.sum("n").alias("total"))


def _hits(docs: DataFrame, terms: DataFrame, s: Settings) -> DataFrame:
    """k, h, term, start, end: occurrences of what the filters let pass in docs (k, h, t); to be joined with the terms."""
    kind, out = dict(docs.dtypes)["k"], []
    for bits in _parts(terms, s):
        shared = docs.sparkSession.sparkContext.broadcast(bits)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = _Filter(shared.value)
            for batch in batches:
                ks, hs = batch.column(0), batch.column(1)
                found = [(n, term, m.start(), m.end()) for n, x in enumerate(batch.column(2)) for m in _TERM.finditer(x.as_py() or "") if (term := known(m.group()))]
                at = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays([ks.take(at), hs.take(at), pa.array([f[1] for f in found], pa.string()), _long([f[2] for f in found]), _long([f[3] for f in found])], ["k", "h", "term", "start", "end"])

        out.append(docs.select("k", "h", "t").mapInArrow(run, f"k {kind}, h long, term string, start long, end long"))
    return reduce(DataFrame.unionByName, out)


def measures(docs: DataFrame, s: Settings) -> DataFrame | None:
    """term, entity, contexts, n, total, mentions, p, bits of each term that stands near one entity in enough contexts, in docs
    (k, h, t); None if there is none. Counts go over all documents: n, how often the term stands near the entity; total,
    how often it occurs; mentions, how often any term stands near the entity."""
    near = _near(docs, s).groupBy("term", "entity", "context", "h").agg(F.count(F.lit(1)).alias("n"))
    near = materialize(near.groupBy("term", "entity", "context").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n")), "near")
    joint = near.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("contexts"), F.sum("texts").alias("texts"), F.max("texts").alias("most"), F.sum("n").alias("n"))
    joint = joint.filter((F.col("contexts") >= min(s.min_contexts, s.remove_contexts)) & (F.col("most") <= s.most * F.col("texts")))
    joint = materialize(joint.select("term", "entity", "contexts", "n"), "joint")
    if joint.isEmpty():
        return None
    total = materialize(_totals(docs, joint.select("term").distinct(), s), "totals")
    entities = near.groupBy("entity").agg(F.sum("n").alias("mentions"))
    everything = total.filter("term = ''").first()["total"]
    p = F.least(F.col("n") / F.col("total"), F.lit(1.0))
    bits = F.log2(p / (F.col("mentions") / F.lit(float(everything))))
    return joint.join(total, "term").join(entities, "entity").withColumn("p", p).withColumn("bits", bits)


def disclosures(docs: DataFrame, s: Settings) -> DataFrame | None:
    """term, kind (generalise or remove): terms of docs (k, h, t) that give an entity away; None if no term stands
    near one entity in enough contexts."""
    told = measures(docs, s)
    if told is None:
        return None
    told = told.filter(F.col("bits") >= s.min_bits)
    kind = F.when((F.col("p") >= s.remove) & (F.col("contexts") >= s.remove_contexts), 2).when((F.col("p") >= s.generalise) & (F.col("contexts") >= s.min_contexts), 1)
    told = told.withColumn("kind", kind).filter("kind is not null").groupBy("term").agg(F.max("kind").alias("kind"))
    return materialize(told.select("term", F.when(F.col("kind") == 2, "remove").otherwise("generalise").alias("kind")), "told")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Entities and generalised terms become their kind in brackets, removed terms nothing; of overlapping spans the
    earlier gives the mark and the whole union goes."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out.append(text[at:a])
            out.append("" if kind == "remove" else "[TERM]" if kind == "generalise" else f"[{kind.upper()}]")
        at = max(at, b)
    out.append(text[at:])
    return "".join(out)


_TYPE = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"


def _spans(text: Column, extra: Column, rewrite: bool, told=None) -> Column:
    """The results of each text: its base spans, those of extra and the occurrences of the broadcast table told."""

    @F.arrow_udf(_TYPE)
    def run(texts: pa.Array, extras: pa.Array) -> pa.Array:
        worker_state("pii", dict)
        terms = told.value if told is not None else {}
        rows = []
        for n in range(len(texts)):
            t = texts[n].as_py() or ""
            base = base_spans(t)
            more = [(e["kind"], e["start"], e["end"]) for e in (extras[n].as_py() or ())]
            if terms and not terms.keys().isdisjoint(_TERM.findall(t.lower())):
                more += [(kind, m.start(), m.end()) for m in _TERM.finditer(t) if (kind := terms.get(m.group().lower()))]
            spans = sorted({*base, *more}, key=lambda s: (s[1], _ORDER[s[0]], s[2])) if more else base
            count = [sum(1 for s in base if s[0] == k) for k in KINDS[:4]]
            rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans), redact(t, spans) if rewrite and spans else None))
        cols = list(zip(*rows, strict=True)) or [()] * 7
        return pa.StructArray.from_arrays([pa.array(c, pa.int64() if k < 4 else pa.string()) for k, c in enumerate(cols)], [x.split()[0] for x in _TYPE.split(", ")])

    return run(text, extra)


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: bool = False, settings: Settings | None = None) -> DataFrame:
    """docs with n_email, n_ip, n_card, n_phone, base_sha256 and spans; with rewrite, the text redacted too.

    Null texts count as empty and stay null; texts without a span stay as they are. Repeated rows and null
    keys are allowed; input columns named like a result give way; an empty table gives an empty one.

    Terms that give entities away are looked for in the pass that finds the spans where there are up to settings.told of
    them; of more, occurrences are found by filters of bounded size and joined with the terms and the documents."""
    s = settings or Settings()
    spark = docs.sparkSession
    names = docs.columns
    k, h, extra, pii = fresh(docs, "k", "h", "extra", "pii")
    src = docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("t"))
    terms = disclosures(src, s)
    rows, more, told = docs, F.lit(None).cast("array<struct<kind:string,start:bigint,end:bigint>>"), None
    if terms is not None and terms.count() <= s.told:
        told = spark.sparkContext.broadcast({r["term"]: r["kind"] for r in terms.collect()})
    elif terms is not None:
        hits = _hits(src, terms, s).join(terms, "term").select("k", "h", "kind", "start", "end").distinct()
        found = hits.groupBy("k", "h").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias(extra))
        found = materialize(found.select(F.col("k").alias(k), F.col("h").alias(h), extra), "hits")
        rows = docs.join(found, docs[f"`{key}`"].eqNullSafe(found[k]) & (F.xxhash64(docs[f"`{text}`"]) == found[h]), "left").drop(k, h)
        more = F.col(extra)
    got = rows.withColumn(pii, _spans(F.col(f"`{text}`"), more, rewrite, told)).drop(extra)
    new = {c: got[f"{pii}.{c}"] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
    if rewrite:
        got = got.withColumn(text, F.coalesce(f"{pii}.redacted", F.col(f"`{text}`")))
    return append(got, new).select(*[f"`{c}`" for c in names if c.lower() not in new], *new)
