"""Language identification: a bidirectional gated recurrent network over bytes.

The network is trained here in numpy by backpropagation through time. It reads all UTF-8 bytes of a document
(lower-cased: letters, spaces, digits and marks alike) in both directions and labels every byte position; a
document's probabilities are the mean over the positions of its letters. To read many places at once, a document is
read in stretches of LENGTH bytes; each direction begins AROUND bytes before its stretch, so that a position's state
has seen at least so many bytes on either side, across words. Gates and candidates are squashed by x / (1 + |x|).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftstone.llm.common import bounded_sample, fresh, worker_state

LENGTH, AROUND = 128, 24
#: Stretches that are read at once, and bytes of documents that are laid out for that, about.
BATCH, BLOCK = 1024, 1 << 20
#: What is read before a document begins and after it ends: the state stays 0.
PAD = 256
UND = "und"

_WORD = re.compile(r"[^\W\d_]+")
#: Bytes of letters: ASCII ones and parts of longer characters.
_IN_LETTER = np.array([chr(b).isalpha() if b < 128 else b < 256 for b in range(257)])


def has_letter(text: str) -> bool:
    return any(any(map(str.isalpha, m.group())) for m in _WORD.finditer(text))


class Net(NamedTuple):
    """Weights of one direction, for update gate, reset gate and candidate one below the other."""

    x: np.ndarray  # 3H x 257: by byte
    u: np.ndarray  # 3H x H: recurrent
    o: np.ndarray  # L x H: output


class Model(NamedTuple):
    name: str
    labels: list[str]
    forward: Net
    backward: Net
    bias: np.ndarray


def _squash(a: np.ndarray, space: np.ndarray) -> None:
    np.abs(a, out=space)
    space += 1
    np.divide(a, space, out=a)


def _run(net: Net, x: np.ndarray, keep: bool = False):
    """Hidden states (T x H x B) for bytes x (T x B); with keep, also what the backward pass needs."""
    size, (steps, width) = net.u.shape[1], x.shape
    out = np.empty((steps, size, width), dtype=net.x.dtype)
    a, g, space = (np.empty((3 * size, width), dtype=net.x.dtype) for _ in range(3))
    h, tape = np.zeros((size, width), dtype=net.x.dtype), []
    for t in range(steps):
        np.take(net.x, x[t], axis=1, out=a, mode="clip")
        np.matmul(net.u, h, out=g)
        gates, n, hc = a[: 2 * size], a[2 * size :], g[2 * size :]
        gates += g[: 2 * size]
        _squash(gates, space[: 2 * size])
        gates *= 0.5
        gates += 0.5
        if keep:
            tape.append([h.copy(), gates.copy(), hc.copy()])
        hc *= gates[size:]
        n += hc
        _squash(n, space[2 * size :])
        if keep:
            tape[-1].append(n.copy())
        h -= n
        h *= gates[:size]
        h += n
        out[t] = h
    return (out, tape) if keep else out


def _backward(net: Net, x: np.ndarray, tape: list, dh_at: np.ndarray) -> list[np.ndarray]:
    """Gradients of x and u through time; dh_at: T x H x B from the outputs."""
    size, steps = net.u.shape[1], len(tape)
    gu, dh = np.zeros_like(net.u), np.zeros_like(tape[0][0])
    das = np.empty((steps, 3 * size, x.shape[1]), dtype=net.x.dtype)
    for t in range(steps - 1, -1, -1):
        h, gates, hc, n = tape[t]
        z, r = gates[:size], gates[size:]
        dh = dh + dh_at[t]
        da_n = dh * (1 - z) * (1 - np.abs(n)) ** 2
        bend = 0.5 * (1 - np.abs(2 * gates - 1)) ** 2
        da = das[t]
        da[:size], da[size : 2 * size], da[2 * size :] = dh * (h - n) * bend[:size], da_n * hc * bend[size:], da_n
        dg = da.copy()
        dg[2 * size :] *= r
        gu += dg @ h.T
        dh = dh * z + net.u.T @ dg
    # sums by byte: sorted by byte, added up run by run
    flat = das.transpose(0, 2, 1).reshape(-1, 3 * size)
    order = np.argsort(x.ravel(), kind="stable")
    which, starts = np.unique(x.ravel()[order], return_index=True)
    gx = np.zeros_like(net.x)
    gx[:, which] = np.add.reduceat(flat[order], starts, axis=0).T
    gx[:, PAD] = 0
    return [gx, gu]


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Over the middle axis, in place."""
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def stretches(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of the documents, with PADs around each; for each stretch its document, its start there and its length."""
    n = np.array([len(b) for b in data], dtype=np.int64)
    first = AROUND + np.cumsum(n + LENGTH + AROUND) - (n + LENGTH + AROUND)
    flat = np.full(int((n + LENGTH + AROUND).sum()) + 2 * AROUND, PAD, dtype=np.intp)
    for b, at in zip(data, first.tolist(), strict=True):
        flat[at : at + len(b)] = np.frombuffer(b, dtype=np.uint8)
    per = -(-n // LENGTH)
    doc = np.repeat(np.arange(len(data)), per)
    start = (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)) * LENGTH
    return flat, first, doc, start


def position_labels(model: Model, data: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """In batches of stretches: their documents (B), starts (B), probabilities (T x L x B) of each of their positions,
    and which of these are letters of the document (T x B)."""
    flat, first, doc, start = stretches(data)
    length = np.minimum(LENGTH, np.array([len(b) for b in data], dtype=np.int64)[doc] - start)
    for part in np.array_split(np.argsort(-length, kind="stable"), max(1, -(-len(doc) // BATCH))):
        if not len(part):
            continue
        longest, d = int(length[part].max()), doc[part]
        x = flat[(first[d] + start[part])[None, :] + np.arange(-AROUND, longest + AROUND)[:, None]]
        hf = _run(model.forward, x[: AROUND + longest])[AROUND:]
        hb = _run(model.backward, x[AROUND:][::-1])[AROUND:][::-1]
        p = _softmax(np.matmul(model.forward.o, hf) + np.matmul(model.backward.o, hb) + model.bias[None, :, None])
        inside = np.arange(longest)[:, None] < length[part][None, :]
        yield d, start[part], p, inside & _IN_LETTER[x[AROUND : AROUND + longest]]


def train(examples: list[tuple[str, str]], hidden: int = 16, steps: int = 300, batch: int = 160, width: int = 48, seed: int = 7) -> Model:
    """Fit the network to (text, label) pairs: every byte position of a stretch of width bytes gets its text's label.

    Stretches are drawn with equal weight for each label, from all places of its texts; Adam with a fixed
    seed, so that equal examples give an equal model. No labels at all: a model that answers `und`."""
    rng = np.random.default_rng(seed)
    pools: dict[str, bytes] = {}
    for b in sorted({b for _, b in examples}):
        raw = b"\n".join(sorted(t.lower().encode("utf-8", "replace") for t, c in examples if c == b and has_letter(t)))
        if raw:
            pools[b] = raw + b"\n" * max(0, width - len(raw))
    labels = sorted(pools)

    def net() -> Net:
        weights = [rng.normal(0, 1 / np.sqrt(hidden), shape).astype(np.float32) for shape in ((3 * hidden, 257), (3 * hidden, hidden), (max(1, len(labels)), hidden))]
        weights[0][:, PAD] = 0
        weights[0][:hidden, PAD] = 1e9  # an update gate of 1: the state stays
        return Net(*weights)

    model = Model(uuid.uuid4().hex, labels, net(), net(), np.zeros(max(1, len(labels)), np.float32))
    if len(labels) < 2:
        return model
    params = [*model.forward, *model.backward, model.bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    codes = [np.frombuffer(pools[b], dtype=np.uint8) for b in labels]
    each = max(1, batch // len(labels))
    few = len(labels) > batch  # of very many labels, a step draws some
    for step in range(1, steps + 1):
        target = rng.choice(len(labels), batch, replace=False) if few else np.repeat(np.arange(len(labels)), each)
        x = np.stack([codes[k][(at := rng.integers(0, len(codes[k]) - width + 1)) : at + width] for k in target], axis=1).astype(np.intp)
        hf, fwd = _run(model.forward, x, keep=True)
        hb, bwd = _run(model.backward, x[::-1], keep=True)
        d = _softmax(np.matmul(model.forward.o, hf) + np.matmul(model.backward.o, hb[::-1]) + model.bias[None, :, None])
        d[:, target, np.arange(len(target))] -= 1
        d /= x.size
        go_f = np.einsum("tlb,thb->lh", d, hf)
        go_b = np.einsum("tlb,thb->lh", d, hb[::-1])
        grads = [*_backward(model.forward, x, fwd, np.matmul(model.forward.o.T, d)), go_f, *_backward(model.backward, x[::-1], bwd, np.matmul(model.backward.o.T, d[::-1])), go_b, d.sum(axis=(0, 2))]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        pace = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, a, b in zip(params, grads, m, v, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (pace * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


class Labeller:
    """Pools documents' positions."""

    def __init__(self, model: Model):
        self.model = model

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Label and probability of each text; documents are laid out together up to BLOCK bytes."""
        out: list[tuple[str, float]] = [(UND, 0.0)] * len(texts)
        held: list[tuple[int, bytes]] = []
        size = 0
        for k, t in enumerate(texts):
            if t and self.model.labels and has_letter(t):
                held.append((k, t.lower().encode("utf-8", "replace")))
                size += len(held[-1][1])
                if size >= BLOCK:
                    self._pool(held, out)
                    held, size = [], 0
        self._pool(held, out)
        return out

    def _pool(self, held: list[tuple[int, bytes]], out: list[tuple[str, float]]) -> None:
        if not held:
            return
        total = np.zeros((len(held), len(self.model.labels)))
        for doc, _, p, letters in position_labels(self.model, [b for _, b in held]):
            np.add.at(total, doc, np.einsum("tlb,tb->bl", p, letters.astype(np.float32)))
        total /= np.maximum(total.sum(axis=1, keepdims=True), 1e-30)
        best = total.argmax(axis=1)
        for (k, _), b, p in zip(held, best, total, strict=True):
            out[k] = (self.model.labels[b], float(min(1.0, max(0.0, p[b]))))


def predict(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """struct(lang, score) of docs' text column: whole texts; `und` and 0 for null and letterless ones."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), model.name

    @F.arrow_udf("lang string, score double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        who = worker_state(name, lambda: Labeller(shared.value))
        for batch in batches:
            found = []
            for k in range(0, len(batch), 512):
                found += who.predict(batch.slice(k, 512).to_pylist())
            yield pa.StructArray.from_arrays([pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], ["lang", "score"])

    return run(F.col(text))


def fit(docs: DataFrame, key: Column, text: str = "text", lang: str = "lang", rows: int = 1200, windows: int = 3, window: int = 1000, **how) -> Model:
    """Train on a bounded sample: about `rows` rows (2 * rows at most) dealt evenly over the labels, of each `windows`
    windows of that many characters from places chosen by the row's hash. Rows without a label or a text are ignored."""
    mark = F.xxhash64(key, F.col(text), F.lit("sample"))
    some = docs.select(mark.alias("__m"), F.col(text).alias("__text"), F.col(lang).alias("__lang")).filter("__lang is not null and __text is not null")
    start = lambda k: F.pmod(F.xxhash64("__m", F.lit(k)), F.greatest(F.length("__text") - window, F.lit(1))) + 1
    cut = F.concat_ws("\n", *[F.substr("__text", start(k).cast("int"), F.lit(window)) for k in range(windows)])
    got = bounded_sample(some.select("__m", "__lang", cut.alias("__text")), F.col("__m"), "__lang", rows).select("__m", "__lang", "__text").collect()
    return train([(r["__text"], r["__lang"]) for r in sorted(got, key=lambda r: (r["__m"], r["__text"]))], **how)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs' keep columns (all by default) with lang_pred and score; columns of these names give way.

    Null texts and texts without a letter: `und`, 0. Empty tables give empty ones; repeated rows stay."""
    names = [c for c in (keep if keep is not None else docs.columns) if c.lower() not in ("lang_pred", "score")]
    lid, = fresh(docs, "lid")
    got = docs.withColumn(lid, predict(docs, model, text))
    return got.select(*[f"`{c}`" for c in names], F.col(f"{lid}.lang").alias("lang_pred"), F.col(f"{lid}.score").alias("score"))
