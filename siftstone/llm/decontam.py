"""Benchmark decontamination by a distributed positional inverted index.

index() deals documents into blocks of about a million words and writes each block's postings: a row a term, with the
places at which it stands. A document is whole in one block, so places that follow each other are words that follow
each other, and no block knows more than its own words. contaminated() finds each window of an item's words by lists: from
the rarest of the window's terms (by its count in all blocks) come the places where the window might begin, and each next
rarer term keeps of them those where its own list, moved by its offset, has a place. near() finds the places where
all terms of a query stand within some words of each other, in any order, in the same manner.

Items meet a block only if the block holds the rarest term of one of their windows: a join on terms. So neither all items
nor all postings are ever in one place; a task sees one block and the items that may touch it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import materialize

#: Fixed value: a word, in lower-cased UTF-8.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_RUN = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*")
#: Words of a window.
WIDTH = 10
#: Words of a block, about: a block ends with the document that reaches it.
BLOCK = 1_000_000
#: Bytes of a text that are split at once.
_PIECE = 1 << 20
#: Places that are tried at once.
_TRIED = 1 << 21

_POSTINGS = "block long, term string, steps array<int>, ids array<{id}>, sizes array<int>"


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, A-Z lower-cased, piece by piece; a word across two pieces is one."""
    at, n = 0, len(data)
    while at < n:
        end = _RUN.match(data, min(n, at + _PIECE)).end()  # up to the end of a word
        yield WORD.findall(data[at:end].lower())
        at = end


class _Block:
    """Words of whole documents, as numbers of the block's own vocabulary. Before each document one place is left
    empty, so that no window crosses from one to the next."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict(count().__next__)  # a new word takes the next number
        self.parts: list[np.ndarray] = []
        self.ids: list = []
        self.sizes: list[int] = []
        self.words = 0

    def add(self, doc_id, data: bytes) -> None:
        size, numbers = 0, self.numbers
        self.parts.append(np.array([-1], dtype=np.int32))
        for words in words_of(data):
            self.parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            size += len(words)
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.words += size

    def rows(self, block: int, schema: pa.Schema) -> pa.RecordBatch:
        """A row a term, with the steps between its places (the first from place 0), and one of the documents."""
        said = np.concatenate(self.parts)
        keys = (said.astype(np.int64) << 32) | np.arange(len(said), dtype=np.int64)
        keys.sort()  # by word, then place; the empty places first
        order = (keys[len(self.ids) :] & 0xFFFFFFFF).astype(np.int32)
        counts = np.bincount(said[order], minlength=len(self.numbers)) if len(order) else np.zeros(0, dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        steps = np.diff(order, prepend=np.int32(0))
        steps[offsets[:-1]] = order[offsets[:-1]]
        n = len(self.numbers)
        steps = pa.ListArray.from_arrays(pa.array(np.append(offsets, offsets[-1])), pa.array(steps, pa.int32()))
        nothing = [None] * n
        ids, sizes = pa.array([*nothing, self.ids], schema.field("ids").type), pa.array([*nothing, self.sizes], schema.field("sizes").type)
        terms = pa.array([*self.numbers, None], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([pa.array([block] * (n + 1), pa.int64()), terms, steps.cast(schema.field("steps").type), ids, sizes], schema=schema)


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The index of docs, in the shared folder: block, term, steps (differences of its places), and for each block a row
    with a null term that has ids and sizes (words) of its documents.

    Each input row is a document of its own, whether or not its id is null or repeated. Null texts have no words. Other
    columns are ignored; an empty table gives an empty index."""
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = pa.schema([("block", pa.int64()), ("term", pa.string()), ("steps", pa.list_(pa.int32())), ("ids", pa.list_(_arrow(docs, doc_id))), ("sizes", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                now.add(i.as_py(), t.as_py() or b"")
                if now.words + len(now.ids) >= block:
                    yield now.rows(number, schema)
                    number, now = number + 1, _Block()
        if now.ids:
            yield now.rows(number, schema)

    return materialize(docs.select(F.col(doc_id), F.col(text).cast("binary")).mapInArrow(run, _POSTINGS.format(id=kind)), "postings")


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def item_words(text: Column) -> Column:
    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([[w.decode() for words in words_of(x.as_py() or b"") for w in words] for x in batch], pa.list_(pa.string()))

    return run(text.cast("binary"))


def _anchored(words: list[str], counts: dict[str, int], width: int) -> set[str]:
    """The rarest term of each window of which all terms are known; the first of equally rare ones."""
    width = min(width, len(words))
    windows = (words[i : i + width] for i in range(len(words) - width + 1))
    return {min(w, key=counts.__getitem__) for w in windows if w and all(x in counts for x in w)}


def _anchors(words: str, counts: str, width: int) -> Column:
    @F.arrow_udf("array<string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for w, c in batches:
            yield pa.array([sorted(_anchored(a.as_py(), dict(b.as_py()), width)) for a, b in zip(w, c, strict=True)], pa.list_(pa.string()))

    return run(F.col(words), F.col(counts))


def prepare(found: DataFrame, items: DataFrame, width: int | None, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item (its id), words, counts (of each term that any document has, in all documents) and anchors: the terms from which
    the item's windows of `width` words start (None: the one rarest term of all, if all are known). A row for each distinct item."""
    rows = materialize(items.select(F.col(item_id).alias("item"), item_words(F.col(text)).alias("words")).filter("size(words) > 0").distinct(), "items")
    asked = rows.select("item", "words", F.explode(F.array_distinct("words")).alias("term"))
    terms = asked.select("term").distinct()
    counts = found.select("term", F.size("steps").cast("long").alias("n")).join(terms, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    known = asked.join(counts, "term").groupBy("item", "words").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "n")))).alias("counts"))
    return materialize(known.withColumn("anchors", _anchors("words", "counts", width or 1 << 30)), "items")


class _Lists:
    """The postings of one block: its terms' places as one sorted array of (term number, place)."""

    SHIFT = 40

    def __init__(self, rows: pa.Table) -> None:
        terms = rows.column("term").combine_chunks()
        about = terms.is_null().to_numpy(zero_copy_only=False).nonzero()[0]
        self.ids = rows.column("ids")[int(about[0])].as_py() if len(about) else []
        self.sizes = np.array(rows.column("sizes")[int(about[0])].as_py() if len(about) else [], dtype=np.int64)
        self.begins = np.cumsum(self.sizes + 1) - self.sizes  # a document's first place
        self.numbers = {t: k for k, t in enumerate(terms.to_pylist()) if t is not None}
        steps = rows.column("steps").combine_chunks()
        sizes = np.diff(steps.offsets.to_numpy())
        flat = steps.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        if len(flat):
            base = np.repeat(np.concatenate([[0], np.cumsum(flat)])[self.first[:-1]], sizes)
            flat = np.cumsum(flat) - base
        self.keys = flat + (np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) << self.SHIFT)

    def places(self, number: int) -> np.ndarray:
        return self.keys[self.first[number] : self.first[number + 1]] - (number << self.SHIFT)

    def has(self, numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
        want = (numbers.astype(np.int64) << self.SHIFT) + places
        at = np.searchsorted(self.keys, want)
        return (places >= 0) & (self.keys[np.minimum(at, len(self.keys) - 1)] == want)

    def doc(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, side="right") - 1


def _starts(lists: _Lists, numbers: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, place at which it begins) for all occurrences of the windows: rows of term numbers, rarest first, and
    their offsets. Windows are tried in lots, so that no more than about _TRIED places are held."""
    sizes = np.diff(lists.first)[numbers[:, 0]]
    for lot in np.split(np.arange(len(numbers)), np.flatnonzero(np.diff(np.cumsum(sizes) // _TRIED)) + 1):
        window = np.repeat(lot, sizes[lot])
        if not len(window):
            continue
        begin = np.concatenate([lists.places(n) for n in numbers[lot, 0]]) - offsets[window, 0]
        for k in range(1, numbers.shape[1]):
            keep = lists.has(numbers[window, k], begin + offsets[window, k])
            window, begin = window[keep], begin[keep]
            if not len(window):
                break
        if len(window):
            yield window, begin


def _windows(lists: _Lists, items: list[dict], width: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By width: term numbers, rarest first, offsets and item numbers of all windows whose terms the block has."""
    got: dict[int, list] = {}
    for k, item in enumerate(items):
        counts, words = dict(item["counts"]), item["words"]
        number = np.array([lists.numbers.get(w, -1) for w in words], dtype=np.int64)
        often = np.array([counts.get(w, 0) for w in words], dtype=np.int64)
        w = min(width, len(words))
        number, often = (np.lib.stride_tricks.sliding_window_view(x, w) for x in (number, often))
        whole = (number >= 0).all(axis=1)
        number, order = number[whole], np.argsort(often[whole], axis=1, kind="stable")
        got.setdefault(w, []).append((np.take_along_axis(number, order, axis=1), order, np.full(len(number), k)))
    return {w: tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for w, parts in got.items()}


def _cogrouped(found: DataFrame, asked: DataFrame, per_block, schema: str) -> DataFrame:
    """per_block(lists, items) for each block: of the block's postings those that any item asks for, and the items one
    of whose anchors it has."""
    terms = asked.select(F.explode("words").alias("term")).distinct()
    mine = found.filter("term is not null").join(terms, "term", "left_semi").select("block", "term", "steps", "ids", "sizes")
    mine = mine.unionByName(found.filter("term is null"))
    met = found.filter("term is not null").select("block", "term").join(asked.select("item", "words", F.explode("anchors").alias("term")), "term").select("block", "item", "words").distinct()
    own = asked.select(F.col("item").alias("own"), F.col("words").alias("said"), F.map_entries("counts").alias("counts"))
    met = met.join(own, F.col("item").eqNullSafe(F.col("own")) & (F.col("words") == F.col("said"))).select(F.col("block").alias("at"), "item", "words", "counts")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        items = [r | {"counts": [(x["key"], x["value"]) for x in r["counts"]]} for r in right.to_pylist()]
        return per_block(_Lists(left), items)

    return mine.groupBy("block").cogroup(met.groupBy("at")).applyInArrow(run, schema)


def contaminated(found: DataFrame, asked: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_hit, items: for each document of the index its words, those within any occurrence of a window of
    `width` words of an item (an item of fewer is one window), and the ids of the items that have such a window.

    asked: prepare(found, items, width). One row a document. Items of equal words count each; one id counts once, and a null
    id's windows hit but are not listed. An empty benchmark hits nothing."""
    kind, item = found.schema["ids"].dataType.elementType.simpleString(), asked.schema["item"].dataType.simpleString()
    ids_type, item_type = found.schema["ids"].dataType, asked.schema["item"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    out = pa.schema([("doc_id", to_arrow_type(ids_type.elementType)), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(to_arrow_type(item_type)))])

    def per_block(lists: _Lists, items: list[dict]) -> pa.Table:
        change = np.zeros(int((lists.sizes + 1).sum()) + width + 1, dtype=np.int64)
        having: list[set] = [set() for _ in lists.ids]
        for w, (numbers, offsets, of) in _windows(lists, items, width).items():
            for window, begin in _starts(lists, numbers, offsets):
                np.add.at(change, begin, 1)
                np.add.at(change, begin + w, -1)
                for d, k in set(zip(lists.doc(begin).tolist(), of[window].tolist(), strict=True)):
                    having[d].add(items[k]["item"])
        covered = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
        hit = covered[lists.begins + lists.sizes] - covered[lists.begins]
        listed = [sorted(h - {None}) for h in having]
        return pa.Table.from_arrays([pa.array(lists.ids, out.field(0).type), pa.array(lists.sizes), pa.array(hit), pa.array(listed, out.field(3).type)], schema=out)

    return _cogrouped(found, asked, per_block, f"doc_id {kind}, n_words long, n_hit long, items array<{item}>")


def near(found: DataFrame, asked: DataFrame, within: int) -> DataFrame:
    """doc_id, item, n: how many places of the item's rarest term have all its other terms so near that all stand within
    `within` consecutive words, in any order; a row for each document with such a place.

    asked: prepare(found, items, None). A term that a query repeats counts once. Each place of the rarest term is judged on
    its own: the other terms' places around it, a list each, are walked for the shortest stretch that has all."""
    kind, item = found.schema["ids"].dataType.elementType.simpleString(), asked.schema["item"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    out = pa.schema([("doc_id", to_arrow_type(found.schema["ids"].dataType.elementType)), ("item", to_arrow_type(asked.schema["item"].dataType)), ("n", pa.int64())])

    def stretch(around: list[np.ndarray], begin: int, end: int) -> bool:
        """Whether `within` words between begin and end, the anchor among them, have one place of each list."""
        for left in sorted({p for a in around for p in a.tolist()} | {begin + within - 1}):
            if begin <= left <= begin + within - 1 and all(np.searchsorted(a, left + within) > np.searchsorted(a, left) for a in around):
                return True
        return False

    def per_block(lists: _Lists, items: list[dict]) -> pa.Table:
        rows: list[tuple] = []
        for x in items:
            counts = dict(x["counts"])
            numbers = [lists.numbers.get(w, -1) for w in sorted(set(x["words"]), key=lambda w: (counts.get(w, 0), x["words"].index(w)))]
            if min(numbers) < 0:
                continue
            at = lists.places(numbers[0])
            for n in numbers[1:]:  # the rarest terms first: a place goes as soon as one term is not around it
                other = lists.places(n)
                at = at[np.searchsorted(other, at + within) > np.searchsorted(other, at - within + 1)]
            docs = lists.doc(at)
            counted: dict[int, int] = {}
            for p, d in zip(at.tolist(), docs.tolist(), strict=True):
                low, high = max(p - within + 1, int(lists.begins[d])), min(p + within, int(lists.begins[d] + lists.sizes[d]))
                around = [a[np.searchsorted(a, low) : np.searchsorted(a, high)] for a in map(lists.places, numbers[1:])]
                if stretch(around, p - within + 1, p + within) if around else True:
                    counted[d] = counted.get(d, 0) + 1
            rows += [(lists.ids[d], x["item"], n) for d, n in counted.items()]
        return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), out, strict=True)] if rows else [pa.array([], f.type) for f in out], schema=out)

    return _cogrouped(found, asked, per_block, f"doc_id {kind}, item {item}, n long")
