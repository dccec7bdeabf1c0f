"""SentencePiece encoding and decoding with a streaming Viterbi search.

The model file holds byte-pair pieces with byte fallback. For such models the library's own segmentation of
a text is the one path of pieces whose every adjacent pair is stable: merging the two pieces' text from
scratch gives the same two pieces again. The search keeps, for each boundary, the last piece of the path that
survives there (a back pointer); it needs the last max-piece-length boundaries only, and whenever all
back-pointer paths from those meet in one boundary, the ids before it are committed and forgotten. Where no piece
of the vocabulary can cross a boundary (white space begins, a line ends) all paths are known to meet there: texts
are read in blocks up to such boundaries, and the ids between two of them are remembered, up to a fixed number.
The ids equal the library's; decoding gives the text back exactly, but for U+2581, which stands for a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import worker_state

SPACE = "▁"
#: Characters that are looked at together.
BLOCK = 1 << 16
#: Words whose ids a worker remembers, in each of two generations: about 0.2 kB each.
REMEMBERED = 250_000
#: Characters by which the pieces are known that can end with them.
TAIL = 4


class Pieces(NamedTuple):
    """What a worker needs of a model: piece -> (id, rank); byte ids; flags. Bounded by the vocabulary."""

    ids: dict[str, int]
    rank: dict[str, float]
    byte_ids: tuple[int, ...]
    text: tuple[str, ...]
    byte_of: dict[int, int]
    silent: frozenset[int]
    prefix: bool
    longest: int
    unknown: int


def load_pieces(path: str) -> Pieces:
    """Read a model on the driver; workers get its pieces with the task, not the path."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    silent = frozenset(i for i in range(n) if sp.is_control(i) or sp.is_unused(i))
    byte_of = {i: int(names[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
    plain = [i for i in range(n) if i not in silent and i not in byte_of and not sp.is_unknown(i)]
    if any(SPACE in names[i].lstrip(SPACE) for i in plain):
        raise ValueError("a piece holds a space after another character")
    by_byte = {b: i for i, b in byte_of.items()}
    return Pieces({names[i]: i for i in plain}, {names[i]: -sp.get_score(i) for i in plain}, tuple(by_byte[b] for b in range(256)) if len(by_byte) == 256 else (), tuple(names), byte_of, silent, bool(sp.encode("a") and sp.id_to_piece(sp.encode("a")[0]).startswith(SPACE)), max(map(len, (names[i] for i in plain)), default=1), sp.unk_id())


class Encoder:
    """Encodes one text at a time; remembers the ids of words it has met, in two generations of a fixed size."""

    def __init__(self, pieces: Pieces, remembered: int = REMEMBERED):
        self.p = pieces
        self.stable: dict[int, bool] = {}
        #: Pieces that merging reaches from single characters; lengths of those beyond TAIL, longest first, by their last TAIL characters.
        self.whole = {t: i for t, i in pieces.ids.items() if len(t) == 1 or self.merged(t) == [t]}
        longer: dict[str, set[int]] = {}
        for t in self.whole:
            if len(t) > TAIL:
                longer.setdefault(t[-TAIL:], set()).add(len(t))
        self.longer = {k: sorted(v, reverse=True) for k, v in longer.items()}
        self.ends: dict[str, tuple[tuple[int, int], ...]] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.remembered = remembered
        self.code = "<u2" if len(pieces.text) <= 1 << 16 else "<u4"
        #: Runs that no piece crosses: white space begins a new one, and so do a line end and, after a letter, the
        #: characters that follow a letter in no piece. Shorter runs recur more often.
        after = {b for t in pieces.ids for a, b in zip(t, t[1:], strict=False) if a.isalpha()}
        cut = "".join(re.escape(c) for c in ".,;:!?%$&#*|)\"" if c not in after)
        self.run = re.compile((f"{SPACE}*+[^\\W\\d_]++(?=[{cut}])|" if cut else "") + f"{SPACE}*+[^{SPACE}\n]++|{SPACE}++|\n++")

    def merged(self, text: str) -> list[str]:
        """Byte-pair merges from single characters, best rank first, leftmost on ties."""
        return self._merged(list(text), 0)

    def _merged(self, parts: list[str], border: int) -> list[str]:
        """As merged(), of single characters; nothing once a merge goes over the border (in characters; 0: none)."""
        rank, none = self.p.rank.get, float("inf")
        ranks = [rank(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            if border and at == border - 1:
                return []
            if at < border:
                border -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def pair(self, a: int, b: int) -> bool:
        """Whether the path may go from piece a to piece b; a piece outside the vocabulary meets any other."""
        key = a << 32 | b
        got = self.stable.get(key)
        if got is None:
            if len(self.stable) > 400_000:
                self.stable.clear()
            x, y = self.p.text[a], self.p.text[b]
            got = self.stable[key] = self._merged([*x, *y], len(x)) == [x, y]
        return got

    def ending(self, tail: str) -> tuple[tuple[int, int], ...]:
        """Length and id of the pieces that can end where a text does, by its last TAIL characters, longest first; of longer ones, which
        are to be looked up, the id is -1."""
        if len(self.ends) > 200_000:
            self.ends.clear()
        short = ((l, self.whole.get(tail[-l:])) for l in range(TAIL, 0, -1))
        got = self.ends[tail] = (*((l, -1) for l in self.longer.get(tail, ())), *((l, i) for l, i in short if i is not None))
        return got

    def spell(self, char: str) -> list[int]:
        """A character outside the vocabulary as its bytes."""
        return [self.p.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")] if self.p.byte_ids else [self.p.unknown]

    def stream(self, blocks: Iterable[str]) -> Iterator[int]:
        """The ids of a text that comes in blocks, in order, committed as soon as the surviving paths meet: of what
        has come, only the window since the last committed boundary is kept."""
        longest = self.p.longest
        piece: list[int] = [-1]  # piece[k]: id of the piece that ends at the window's boundary k; -1 at the start and for unknown characters
        size: list[int] = [0]  # and its length
        held = ""  # the window's characters
        for block in blocks:
            for at in range(0, len(block), longest):
                held += block[at : at + longest]
                self._extend(held, piece, size)
                if len(held) >= 2 * longest:
                    gone, done = self._commit(held, piece, size)
                    held = held[gone:]
                    yield from done
        yield from self._path(held, piece, size, len(held))

    def _extend(self, held: str, piece: list[int], size: list[int]) -> None:
        """The surviving piece at each boundary of the window that has none yet."""
        whole, ends, stable = self.whole, self.ends, self.stable
        pad = max(self.p.longest, TAIL)
        padded = "\n" * pad + held  # no piece of several characters holds a line end
        for k in range(len(piece), len(held) + 1):
            e = k + pad
            tail = padded[e - TAIL : e]
            for l, i in ends.get(tail) or self.ending(tail):
                if i < 0:
                    i = whole.get(padded[e - l : e])
                    if i is None:
                        continue
                before = piece[k - l]
                if before < 0:
                    break
                ok = stable.get(before << 32 | i)
                if ok or (ok is None and self.pair(before, i)):
                    break
            else:
                i, l = -1, 1
            piece.append(i)
            size.append(l)

    def _path(self, held: str, piece: list[int], size: list[int], k: int) -> list[int]:
        out: list[int] = []
        while k > 0:
            out.extend([piece[k]] if piece[k] >= 0 else self.spell(held[k - 1])[::-1])
            k -= size[k]
        return out[::-1]

    def _commit(self, held: str, piece: list[int], size: list[int]) -> tuple[int, list[int]]:
        """Follow the paths from the last boundaries of the window until one boundary is left; drop what is before it.

        The committed boundary keeps its piece: pairs over it are still to be checked."""
        ends = set(range(max(0, len(piece) - self.p.longest), len(piece)))
        while len(ends) > 1:
            k = max(ends)
            ends.remove(k)
            ends.add(k - size[k])
        at = ends.pop()
        if at <= 0:
            return 0, []
        done = self._path(held, piece, size, at)
        del piece[:at], size[:at]
        size[0] = 0
        return at, done

    def ids_of(self, run: str) -> bytes:
        if len(run) > 64:
            return np.fromiter(self.stream((run,)), dtype=self.code).tobytes()
        piece, size = [-1], [0]  # a run of one window, which needs no committing before its end
        self._extend(run, piece, size)
        return np.array(self._path(run, piece, size, len(run)), dtype=self.code).tobytes()

    def remember(self, run: str) -> bytes:
        if len(run) > 64:
            return self.ids_of(run)
        got = self.old.get(run)
        if got is None:
            got = self.ids_of(run)
        if len(self.young) >= self.remembered:
            self.old, self.young = self.young, {}
        self.young[run] = got
        return got

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text; none for null and empty texts."""
        if not text:
            return np.zeros(0, dtype=self.code)
        out, at = [], 0
        while at < len(text):
            end = run_start(text, at, at + BLOCK)
            lead = SPACE if self.p.prefix and not at else ""
            if end - at > 2 * BLOCK:  # no boundary for long: the search itself finds them
                parts = (text[k : min(end, k + BLOCK)].replace(" ", SPACE) for k in range(at, end, BLOCK))
                out.append(np.fromiter(self.stream((lead, *parts) if lead else parts), dtype=self.code).tobytes())
            else:
                out.append(self._known(lead + text[at:end].replace(" ", SPACE)))
            at = end
        return np.frombuffer(b"".join(out), dtype=self.code)

    def _known(self, block: str) -> bytes:
        remember, get, parts = self.remember, self.young.get, []
        for r in self.run.findall(block):
            b = get(r)
            if b is None:
                b = remember(r)
                get = self.young.get
            parts.append(b)
        return b"".join(parts)


def run_start(text: str, at: int, end: int) -> int:
    """The last place up to end, or else the first one after it, where white space begins: no piece crosses it."""
    if end >= len(text):
        return len(text)
    k = end
    while (k := text.rfind(" ", at + 1, k + 1)) > at:
        if text[k - 1] != " ":
            return k
        k -= 1
    k = end
    while (k := text.find(" ", k)) >= 0:
        if text[k - 1] != " ":
            return k
        k += 1
    return len(text)


class Decoder:
    def __init__(self, pieces: Pieces):
        self.p = pieces
        self.raw = [b"" if i in pieces.silent else bytes([pieces.byte_of[i]]) if i in pieces.byte_of else b" \xe2\x81\x87 " if i == pieces.unknown else t.replace(SPACE, " ").encode() for i, t in enumerate(pieces.text)]

    def decode(self, ids) -> str:
        """The text of a list of ids; invalid byte sequences become U+FFFD, control ids vanish."""
        if len(ids) and not 0 <= min(ids) <= max(ids) < len(self.raw):
            raise ValueError("an id is out of range")
        raw = b"".join(map(self.raw.__getitem__, ids))
        return (raw[1:] if self.p.prefix and raw.startswith(b" ") else raw).decode("utf-8", "replace")


def _worker(name: str, pieces, remembered: int = REMEMBERED) -> tuple[Encoder, Decoder]:
    """One encoder a Python worker and model: words met in an earlier batch or task need no new search."""
    return worker_state(f"{name}:{remembered}", lambda: (Encoder(pieces.value, remembered), Decoder(pieces.value)))


def encode(docs: DataFrame, model: str, text: str = "text", remembered: int = REMEMBERED) -> Column:
    """array<int> of ids of docs' text column, equal to the library's; null and empty texts give no ids. Fewer words
    remembered take less memory and more time."""
    shared, name = docs.sparkSession.sparkContext.broadcast(load_pieces(model)), model

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc, _ = _worker(name, shared, remembered)
        for batch in batches:
            found = [enc.encode(x.as_py()) for x in batch]
            offsets = np.zeros(len(found) + 1, dtype=np.int64)
            np.cumsum([len(x) for x in found], out=offsets[1:])
            values = np.concatenate(found).astype(np.int32) if found else np.zeros(0, np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

    return run(F.col(text))


def decode(docs: DataFrame, model: str, ids: str = "ids") -> Column:
    """The text of an array<int> column of docs; null for null, empty for no ids. Ids out of range fail."""
    shared, name = docs.sparkSession.sparkContext.broadcast(load_pieces(model)), model

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        _, dec = _worker(name, shared)
        for batch in batches:
            values, ends = batch.values.to_numpy(zero_copy_only=False), batch.offsets.to_numpy()
            yield pa.array([dec.decode(values[a:b].tolist()) if ok else None for a, b, ok in zip(ends[:-1], ends[1:], batch.is_valid().to_pylist(), strict=True)], pa.string())

    return run(F.col(ids))


def encode_and_check(docs: DataFrame, model: str, text: str = "text") -> Column:
    """struct(ids, round_trip) of docs' text column: encoded, and decoded again, in one pass by one worker."""
    shared, name = docs.sparkSession.sparkContext.broadcast(load_pieces(model)), model

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc, dec = _worker(name, shared)
        for batch in batches:
            lengths, values, same = np.zeros(len(batch) + 1, dtype=np.int64), [], []
            for k, x in enumerate(batch):
                t = x.as_py() or ""
                ids = enc.encode(t)
                lengths[k + 1] = len(ids)
                values.append(ids)
                same.append(dec.decode(ids.tolist()) == t)
            flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
            del values
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(flat)), pa.array(same, pa.bool_())], ["ids", "round_trip"])

    return run(F.col(text))


def encode_documents(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """doc_id (if docs has one), ids, n_ids, and round_trip: whether decoding the ids gives the text again.

    round_trip is false only for texts with U+2581; null texts count as empty ones. Repeated rows stay."""
    keep = [c for c in docs.columns if c == "doc_id"]
    coded = docs.select(*keep, encode_and_check(docs, model, text).alias("__coded"))
    return coded.select(*keep, F.col("__coded.ids").alias("ids"), F.size("__coded.ids").cast("long").alias("n_ids"), F.col("__coded.round_trip").alias("round_trip"))
