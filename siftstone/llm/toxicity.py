"""Toxicity: noisy-channel deobfuscation, then a score of the restored text.

A character language model (trigrams with interpolation) is counted over the whole corpus. What may hide a
word (digits and symbols among letters, letters spelled out with spaces or dots, repeated letters)
becomes a lattice: each sign offers the letters it may stand for, each repetition one or two copies, each at
the channel's cost; each separator between spelled-out letters offers to be nothing or a space. Viterbi decoding finds
the likeliest reading, and the document is scored on both what was written and what was restored. Words without such
signs have a lattice of one path: they are themselves.
"""

from __future__ import annotations

import heapq
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import materialize, worker_state

#: What a sign may stand for besides itself.
SIGNS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h", "%": "x"}
#: Code points of the model's alphabet: other characters count as one more sign, and all white space as another.
ALPHABET = " abcdefghijklmnopqrstuvwxyzßàáâäæçèéêëìíîïñòóôöùúûüœ"
SIZE = len(ALPHABET) + 1
_INDEX = {c: i for i, c in enumerate(ALPHABET)}
_TABLE = np.full(0x250, SIZE - 1, dtype=np.int32)
for _c, _i in _INDEX.items():
    _TABLE[ord(_c)] = _i
for _c in "\t\n\x0b\x0c\r":
    _TABLE[ord(_c)] = 0

_LETTER = r"[^\W\d_]"
_LETTERS = re.compile(rf"{_LETTER}+")
#: What makes a word worth decoding: a sign, or a letter twice.
_HIDES = re.compile(r"[0-9@$!|+(<€£¡*#%]|([^\W\d_])\1")
#: Letters spelled out: three or more single letters or signs with one separator or space between each two.
_UNIT = r"(?:[^\W_]|[@$!|+(<€£¡#%])"
_SPELLED = re.compile(rf"(?<!\w){_UNIT}[ .\-_*](?:{_UNIT}[ .\-_*])+{_UNIT}(?!\w)")
_BETWEEN = frozenset(" .-_*")
#: Letters of a tail that are looked at: longer than any word.
TAIL = 64
#: Decoration at a word's edges: repeated signs, and signs that resemble no letter.
_EDGE = re.compile(r"^(?:([^\w\s])\1+|[^\w\s@$!|+(<€£¡])+|(?:([^\w\s])\2+|[^\w\s@$€£])+$")


def char_codes(text: str) -> np.ndarray:
    """Alphabet index of each character of the lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    return _TABLE[np.minimum(points, len(_TABLE) - 1)]


class CharModel:
    """Interpolated trigram log-probabilities over the alphabet."""

    def __init__(self, counts: np.ndarray):
        tri = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
        p1 = (uni + 1) / (uni.sum() + SIZE)
        p2 = (bi + 5 * p1[None, :]) / (bi.sum(axis=1, keepdims=True) + 5)
        p3 = (tri + 5 * p2[None, :, :]) / (tri.sum(axis=2, keepdims=True) + 5)
        self.log = np.log(p3).astype(np.float32)


def count_chars(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Trigram counts over every whole text of docs, summed by Spark; SIZE cubed numbers at most reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, dtype=np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                joined = " \n ".join(x for x in batch.column(0).slice(k, 256).to_pylist() if x)
                for at in range(0, len(joined), 1 << 22):
                    c = char_codes(joined[max(0, at - 2) : at + (1 << 22)])
                    if len(c) > 2:
                        total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["code", "n"])

    found = docs.select(F.col(text).alias("t")).mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(SIZE**3, dtype=np.int64)
    for r in found:
        out[r["code"]] = r["n"]
    return out


#: Characters that one lattice is built over, and by how many the next one overlaps it: more than any word.
SPAN, OVERLAP = 256, 64


def restore(word: str, lm: CharModel, channel: float = 1.5, spelled_out: bool = False) -> str:
    """The likeliest reading of some characters (lower case): Viterbi over their lattice, channel nats for each change.

    A sign may be itself or a letter it resembles; a run of one letter may be itself, one or two of it; signs
    that stand for nothing are passed over. Of spelled-out text, every second run is a separator: it may be nothing or
    the end of a word, at no cost but the model's."""
    runs: list[tuple[str, int]] = []
    for c in word:
        if runs and runs[-1][0] == c and not spelled_out:
            runs[-1] = (c, runs[-1][1] + 1)
        else:
            runs.append((c, 1))
    log, space, other = lm.log, 0, SIZE - 1
    beams: dict[tuple[int, int], tuple[float, str]] = {(space, space): (0.0, "")}
    for nth, (c, n) in enumerate(runs):
        if spelled_out and nth % 2:
            options: list[tuple[str, float]] = [("", 0.0), (" ", 0.0)]
        else:
            options = [(c * n, 0.0)]
            for d in SIGNS.get(c, ""):
                options += [(d * n, channel)] + ([(d, channel)] if n > 1 else []) + ([(d * 2, channel)] if n > 2 else [])
            if c.isalpha() and n > 1:
                options += [(c, channel)] + ([(c * 2, channel)] if n > 2 else [])
            if not c.isalnum():
                options.append(("", channel))
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, out) in beams.items():
            for s, price in options:
                x, y, total = a, b, cost - price
                if s == " " and y == space:
                    continue  # a word has ended already
                for d in s:
                    z = _INDEX.get(d, other if d.isalnum() or d in SIGNS else space)  # marks end a word
                    if z == y == space:
                        continue
                    total += float(log[x, y, z]) - (2.0 if z == other else 0.0)
                    x, y = y, z
                if (x, y) not in after or total > after[x, y][0]:
                    after[x, y] = (total, out + s)
        beams = after
    return max((cost + float(log[a, b, space]), out) for (a, b), (cost, out) in beams.items())[1]


def spans(text: str) -> list[str]:
    """text in pieces of SPAN characters that overlap by OVERLAP, so that no word is cut in all of them."""
    return [text[k : k + SPAN] for k in range(0, max(1, len(text) - OVERLAP), SPAN - OVERLAP)]


def readings(token: str, lm: CharModel) -> list[str]:
    """The words of one white-space-delimited token, in lower case: its runs of letters, and what it may hide."""
    out = _LETTERS.findall(token)
    if len(out) != 1 or len(out[0]) != len(token):
        core = _EDGE.sub("", token)
    else:
        core = token
    if _HIDES.search(core) and (out or len(core) > 3):
        for part in spans(core):
            out += [w for w in _LETTERS.findall(restore(part, lm)) if w not in out]
    return out


def spelled(low: str, lm: CharModel | None = None) -> list[str]:
    """Words spelled out letter by letter in a lower-cased text: the letters as written and, with lm, the likeliest
    reading of letters, signs and separators, with and without its word breaks. Each tail of three letters or more counts
    too, as other words may come before; of a tail, TAIL letters are looked at."""
    out: dict[str, None] = {}
    for m in _SPELLED.finditer(low):
        parts = _LETTERS.findall("".join(c for c in m.group()[::2]))
        if not parts:
            continue
        for part in spans(m.group()) if lm else ():
            read = restore(part, lm, spelled_out=True)
            parts += [*_LETTERS.findall(read), *_LETTERS.findall(read.replace(" ", ""))]
        for part in dict.fromkeys(parts):
            out |= dict.fromkeys(part[k : k + TAIL] for k in range(len(part) - 2))
    return list(out)


def features(word: str) -> list[str]:
    """A word and its beginnings of 4 to 6 letters: rare endings share what their stems have shown."""
    return [word] + [f"{word[:k]}~" for k in (4, 5, 6) if len(word) > k]


class Model(NamedTuple):
    name: str
    counts: np.ndarray
    rates: dict[str, float]
    base: float


def copies(bags: list[set[str]], bands: int = 5, rows: int = 3, common: float = 0.05) -> list[int]:
    """A group number for each bag of words: bags that share a band of minima over their rarer words are copies."""
    df: dict[str, int] = {}
    for bag in bags:
        for w in bag:
            df[w] = df.get(w, 0) + 1
    rng = np.random.default_rng(11)
    mult = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) | np.uint64(1)
    above = max(2.0, common * len(bags))
    parent = list(range(len(bags)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    seen: dict[tuple, int] = {}
    for k, bag in enumerate(bags):
        rare = [zlib.crc32(w.encode("utf-8", "replace")) for w in bag if df[w] <= above]
        if len(rare) < 4:
            continue
        h = (np.array(rare, dtype=np.uint64)[:, None] + np.uint64(1)) * mult[None, :]
        least = (h ^ (h >> np.uint64(29))).min(axis=0).reshape(bands, rows)
        for b in range(bands):
            parent[root(k)] = root(seen.setdefault((b, *least[b].tolist()), k))
    return [root(k) for k in range(len(bags))]


def train(texts: list[tuple[str, int]], counts: np.ndarray) -> Model:
    """fit_bags() of texts."""
    lm, memo = CharModel(counts), {}
    return fit_bags([(words_of(t, lm, memo), y) for t, y in sorted(set(texts))], counts)


def fit_bags(labelled: list[tuple[set[str], int]], counts: np.ndarray, max_features: int = 20_000) -> Model:
    """Words and stems whose share of toxic texts exceeds the base rate beyond chance, at a level divided by the
    number tested, each with its smoothed share as its rate.

    The one that tells most, by its likelihood, is taken first and explains its words; the others are judged by
    the words left, so that a stem gains nothing from a word that speaks for itself. Copies count as one text."""
    texts = labelled
    bags = [bag for bag, _ in labelled]
    group = copies(bags)
    toxic_of: dict[str, set[int]] = {}
    calm_of: dict[str, set[int]] = {}
    for bag, (_, y), g in zip(bags, texts, group, strict=True):
        if y:
            for w in bag:
                toxic_of.setdefault(w, set()).add(g)
    stems: dict[str, list[str]] = {}
    for w in toxic_of:
        for f in features(w):
            stems.setdefault(f, []).append(w)
    for bag, (_, y), g in zip(bags, texts, group, strict=True):
        if not y:
            for w in bag:
                if any(f in stems for f in features(w)):
                    if w not in toxic_of and w not in calm_of:
                        for f in features(w):
                            if f in stems:
                                stems[f].append(w)
                    calm_of.setdefault(w, set()).add(g)
    n, n_toxic = len(set(group)), len({g for g, (_, y) in zip(group, texts, strict=True) if y})
    base = min(0.5, (n_toxic + 0.5) / (n + 1))

    def tail(t: int, c: int) -> float:
        """log P(at least t of t + c at the base rate), by Chernoff's bound."""
        m = t + c
        p = t / m if m else 0.0
        if p <= base:
            return 0.0
        return -m * (p * math.log(p / base) + ((1 - p) * math.log((1 - p) / (1 - base)) if p < 1 else 0.0))

    none: set[int] = set()
    explained: set[str] = set()

    def told(f: str) -> tuple[int, int]:
        left = [w for w in stems[f] if w not in explained]
        return len(none.union(*(toxic_of.get(w, none) for w in left))), len(none.union(*(calm_of.get(w, none) for w in left)))

    level = math.log(0.01 / max(1, len(stems)))
    heap = []
    for f, words in stems.items():
        if f.endswith("~") and sum(1 for w in words if w in toxic_of) < 3:
            continue  # a stem is more than one word's beginning
        if sum(len(toxic_of.get(w, none)) for w in words) >= 3 and (now := tail(*told(f))) < level:
            heap.append((now, f.endswith("~"), f))
    heapq.heapify(heap)
    rates: dict[str, float] = {}
    while heap and len(rates) < max_features:
        _, stem, f = heapq.heappop(heap)
        t, c = told(f)
        now = tail(t, c)
        if now >= level:
            continue
        if heap and now > heap[0][0]:
            heapq.heappush(heap, (now, stem, f))
            continue
        if (rate := (t + 0.5 * base) / (t + c + 0.5)) > 0.35:
            rates[f] = rate
            explained.update(stems[f])
    rest = [y for bag, (_, y) in zip(bags, texts, strict=True) if not any(f in rates for w in bag for f in features(w))]
    return Model(uuid.uuid4().hex, counts, rates, (sum(rest) + base) / (len(rest) + 1) if rest else base)


def words_of(text: str, lm: CharModel, memo: dict[str, list[str]]) -> set[str]:
    """All words of one text, as written and as restored."""
    low = text.lower()
    out: set[str] = set()
    for token in set(low.split()):
        got = memo.get(token)
        if got is None:
            got = memo[token] = readings(token, lm)
        out.update(got)
    out.update(spelled(low, lm))
    return out


_REPEATED = re.compile(r"(.)\1+", re.DOTALL)


class Scorer:
    """Scores texts; remembers which features a token has, up to a fixed number of tokens.

    A reading of a word of letters alone differs from it by repeated letters only: where not even without repeats the word
    is or begins like a feature, no reading of it has one, and its lattice is not built."""

    def __init__(self, model: Model, remembered: int = 400_000):
        self.model, self.lm, self.remembered = model, CharModel(model.counts), remembered
        self.memo: dict[str, tuple[str, ...]] = {}
        once = lambda f: _REPEATED.sub(r"\1", f)
        self.words = {once(f) for f in model.rates if not f.endswith("~")}
        self.stems = {once(f[:-1]) for f in model.rates if f.endswith("~")}

    def may_hide(self, word: str) -> bool:
        low = _REPEATED.sub(r"\1", word)
        return low in self.words or any(low[:k] in self.stems for k in range(1, 7))

    def found(self, token: str) -> tuple[str, ...]:
        rates = self.model.rates
        read = [token] if token.isalpha() and not self.may_hide(token) else readings(token, self.lm)
        got = tuple(f for w in read for f in features(w) if f in rates)
        if len(self.memo) >= self.remembered:
            self.memo.clear()
        if len(token) <= 64:
            self.memo[token] = got
        return got

    def score(self, text: str | None) -> float:
        """1 minus the product of (1 - rate) over the base rate and the features of the text."""
        calm = 1 - self.model.base
        if text:
            rates, get = self.model.rates, self.memo.get
            low = text.lower()
            seen: set[str] = set()
            for token in set(low.split()):
                got = get(token)
                if got is None:
                    got = self.found(token)
                if got:
                    seen.update(got)
            for w in spelled(low, self.lm):
                seen.update(f for f in features(w) if f in rates)
            for f in sorted(seen):
                calm *= 1 - rates[f]
        return min(1.0, max(0.0, 1 - calm))


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Toxicity between 0 and 1 of docs' text column, over whole texts; the base rate for null and empty ones."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), model.name

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        who = worker_state(name, lambda: Scorer(shared.value))
        for batch in batches:
            yield pa.array([who.score(x.as_py()) for x in batch], pa.float64())

    return run(F.col(text))


def bags_of(docs: DataFrame, counts: np.ndarray, text: str = "text") -> Column:
    """array<string>: all words of docs' text column, as written and as restored, in order and each once."""
    shared, name = docs.sparkSession.sparkContext.broadcast(counts), uuid.uuid4().hex

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lm, memo = worker_state(name, lambda: (CharModel(shared.value), {}))
        for batch in batches:
            out = []
            for x in batch:
                if len(memo) > 200_000:
                    memo.clear()
                out.append(sorted(words_of(x.as_py() or "", lm, memo)))
            yield pa.array(out, pa.list_(pa.string()))

    return run(F.col(text))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 3500) -> Model:
    """The language model is counted over all of docs; the classifier is fitted on a bounded sample of the documents that
    labels (key, label 0 or 1) marks: about `sample` keys (2 * sample at most), chosen by a hash of the key, in their natural
    proportion; of documents that share a key one is taken, and of labels the worst. The keys are chosen by a join of the
    keys alone, and few enough to find their texts without a shuffle of the others; their words come to the driver."""
    counts = count_chars(docs, text)
    marks = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    marks = materialize(marks.join(docs.select(F.col(key).alias("of")), F.col("k") == F.col("of"), "left_semi"), "marks")
    r = marks.agg(F.sum(F.col("y").cast("long")).alias("t"), F.count(F.lit(1)).alias("n")).first()
    part, at = min(1.0, sample / max(1, r["n"])), F.xxhash64("k", F.lit("sample"))
    chosen = materialize(marks.filter(F.pmod(at, F.lit(1_000_000)) < part * 1_000_000).orderBy(at).limit(2 * sample), "chosen")
    rows = docs.select(F.col(key).alias("of"), F.col(text).alias("t")).filter("t is not null").join(chosen, F.col("of") == F.col("k"))
    rows = rows.groupBy("k", "y").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    got = materialize(rows.select(bags_of(rows, counts, "t").alias("words"), "y").distinct(), "bags").collect()
    model = fit_bags([(set(x["words"]), x["y"]) for x in sorted(got)], counts)
    return model._replace(base=min(model.base, ((r["t"] or 0) + 0.5) / (r["n"] + 1)))
