"""Approximate nearest neighbours by an inverted multi-index.

Each half of a vector is quantised with its own codebook, fitted on a bounded sample; a pair of centroids is
a cell, and every vector is indexed in its cell. The number of centroids grows with the fourth root of the number of
vectors, that of cells with its square root, so a cell stays small. A query walks the cells by the sum of its
distances to the two centroids with a heap, until the cells seen hold the wanted number of vectors, and their entries are
reranked by the exact inner product in double precision. How many are wanted is measured, not guessed: a bounded
sample of queries is searched exactly, which tells where on its walk each true neighbour's cell comes, and the
walk is as long as the wanted recall takes: short where vectors form clusters, long where they have no structure.

Cells are laid out in shards of bounded size (a cell larger than a shard is spread by a hash). An entry goes to its
shard and nowhere else; a query goes to the shards of its cells, with the sum at which its walk ended, which tells
there which cells it sees. In a shard, entries come first and are held; queries stream past them in small blocks.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftstone.llm.common import materialize


class Settings(NamedTuple):
    centroids: int | None = None  # of each half; None: four times the fourth root of the vectors, 8 to 1,024
    sample: int = 64  # rows for each centroid that the codebooks are fitted on, about
    recall: float = 0.95  # share of the sampled queries' true neighbours that the walk must reach
    tried: int = 256  # queries that the walk's length is measured on, at most about
    shard: int = 1 << 16  # vectors in a shard at most, about
    block: int = 64  # queries that are held against a shard at once


class Index(NamedTuple):
    """table: vec_id, v, h (a hash of both), cell; sizes: vectors by cell, centroids squared of them at most."""

    table: DataFrame
    c1: np.ndarray
    c2: np.ndarray
    sizes: np.ndarray

    def distances(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of queries (Q x D) to the centroids of either half (Q x C): minus the inner product."""
        half = self.c1.shape[1]
        return -(q[:, :half] @ self.c1.T), -(q[:, half:] @ self.c2.T)


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), min(k, len(x)), replace=False))].copy()
    for _ in range(rounds):
        a = nearest(x, c)
        for j in range(len(c)):
            if (m := a == j).any():
                c[j] = x[m].mean(axis=0)
    return c


def nearest(x: np.ndarray, c: np.ndarray, lot: int = 8192) -> np.ndarray:
    """Of each row the nearest centroid; distances are held for `lot` rows at once."""
    norms = (c * c).sum(axis=1)[None, :]
    return np.concatenate([np.zeros(0, dtype=np.int64), *((norms - 2 * x[at : at + lot] @ c.T).argmin(axis=1) for at in range(0, len(x), lot))])


def matrix(column) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def walk(d1: np.ndarray, d2: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of d1[i] + d2[j], until they hold the wanted number of entries (or all cells)."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    a, b = d1[o1].tolist(), d2[o2].tolist()
    heap, out, got, wide = [(a[0] + b[0], 0, 0)], [], 0, len(b)
    while heap and got < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]) * wide + int(o2[j])
        if sizes[cell]:
            out.append(cell)
            got += int(sizes[cell])
        if j + 1 < wide:
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return out


def true_cells(index: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(query number, cell) of the k nearest rows of index (vec_id, v, cell) to each query, by one scan of the
    whole index: each task keeps k rows a query, so len(ids) * k rows a task are shuffled and as many collected."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(q), k), -np.inf)
        cells = np.full((len(q), k), -1, dtype=np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                own = part.column(0).to_numpy(zero_copy_only=False)
                score = np.where(ids[:, None] == own[None, :], -np.inf, q @ matrix(part.column(1)).T)
                score = np.concatenate([best, score], axis=1)
                cell = np.concatenate([cells, np.broadcast_to(part.column(2).to_numpy(), (len(q), part.num_rows))], axis=1)
                top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                best, cells = np.take_along_axis(score, top, axis=1), np.take_along_axis(cell, top, axis=1)
        n, r = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int32)), pa.array(cells[n, r]), pa.array(best[n, r])], ["n", "cell", "score"])

    found = index.select("vec_id", "v", "cell").mapInArrow(run, "n int, cell int, score double")
    order = Window.partitionBy("n").orderBy(F.desc("score"), "cell")
    return [(r["n"], r["cell"]) for r in found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).collect()]


def walk_length(found: list[tuple[int, int]], order: Callable[[int], np.ndarray], sizes: np.ndarray, recall: float) -> int:
    """The least number of vectors to walk for `recall` of found (query number, cell); order: all cells as a query walks."""
    cells: dict[int, list[int]] = {}
    for n, cell in found:
        cells.setdefault(n, []).append(cell)
    before: list[int] = []
    at = np.empty(len(sizes), dtype=np.int64)
    for n, true in cells.items():
        seen = np.asarray(order(n))
        at[seen] = np.cumsum(sizes[seen]) - sizes[seen]
        before += at[true].tolist()
    return sorted(before)[math.ceil(recall * len(before)) - 1] + 1 if before else 0


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id, v: rows with an id and a finite non-zero vector of the commonest length; equal rows count once."""
    v = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    v = v.filter((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    n = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return v.filter(F.size("v") == (n[0]["n"] if n else 0)).withColumn("v", F.col("v").cast("array<double>")).dropDuplicates(["vec_id", "v"])


def build(vectors: DataFrame, vec_id: str, embedding: str, s: Settings) -> Index | None:
    """The index of all usable rows; None if there are none."""
    rows = materialize(usable(vectors, vec_id, embedding), "vectors")
    n = rows.count()
    if not n:
        return None
    k = s.centroids or int(min(1024, max(8, round(4 * n**0.25))))
    rate = min(1.0, max(8192, s.sample * k) / n)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1_000_000)) < rate * 1_000_000).orderBy("vec_id").limit(2 * max(8192, s.sample * k)).select("v").toArrow()
    x = matrix((sample if sample.num_rows else rows.limit(1).select("v").toArrow()).column("v"))
    half = x.shape[1] // 2
    c1, c2 = kmeans(x[:, :half], k), kmeans(x[:, half:], k)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = matrix(batch.column(1))
            cell = nearest(m[:, :half], c1) * len(c2) + nearest(m[:, half:], c2) if len(m) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["vec_id", "v", "h", "cell"])

    kind = dict(rows.dtypes)["vec_id"]
    table = rows.select("vec_id", "v", F.xxhash64("vec_id", "v").alias("h")).mapInArrow(assign, f"vec_id {kind}, v array<double>, h long, cell int")
    table = materialize(table, "index")
    sizes = np.zeros(len(c1) * len(c2), dtype=np.int64)
    counts = table.groupBy("cell").count().toArrow()  # at most centroids squared rows
    sizes[counts.column("cell").to_numpy()] = counts.column("count").to_numpy()
    return Index(table, c1, c2, sizes)


def measured_walk(index: Index, every: int, k: int, s: Settings) -> int:
    """How many vectors a query is to see."""
    n, wanted = int(index.sizes.sum()), k + 1
    if n <= wanted:
        return wanted
    part = min(1.0, s.tried * every / n)
    queries = index.table.filter(F.col("vec_id") % every == 0)
    tried = queries.filter(F.pmod(F.xxhash64("vec_id", F.lit("tried")), F.lit(1_000_000)) < part * 1_000_000).orderBy("vec_id").limit(2 * s.tried).select("vec_id", "v").collect()
    if not tried:
        return wanted
    q = np.array([r["v"] for r in tried], dtype=np.float64)
    found = true_cells(index.table, np.array([r["vec_id"] for r in tried]), q, k)
    d1, d2 = index.distances(q)
    full = lambda i: np.argsort((d1[i][:, None] + d2[i][None, :]).ravel(), kind="stable")
    return max(wanted, walk_length(found, full, index.sizes, s.recall))


class _Shard:
    """The entries of one shard, by cell; queries are held against those of them that their walks have seen."""

    def __init__(self, index: Index, ids: np.ndarray, v: np.ndarray, cells: np.ndarray, k: int):
        order = np.argsort(cells, kind="stable")
        self.index, self.k = index, k
        self.ids, self.v = ids[order], v[order]
        self.cells, self.at = np.unique(cells[order], return_inverse=True)

    def nearest(self, ids: np.ndarray, q: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query its number, and ids and exact scores of its k nearest entries here."""
        d1, d2 = self.index.distances(q)
        wide = len(self.index.c2)
        seen = d1[:, self.cells // wide] + d2[:, self.cells % wide] <= ends[:, None]  # Q x cells
        rows = np.flatnonzero(seen.any(axis=0)[self.at])
        e, own, at = (self.v, self.ids, self.at) if len(rows) == len(self.at) else (self.v[rows], self.ids[rows], self.at[rows])
        score = q @ e.T
        score[~seen[:, at] | (ids[:, None] == own[None, :])] = -np.inf
        for n in range(len(q)):
            near = np.flatnonzero(score[n] > -np.inf)
            if len(near) > self.k:  # leave what can't be among the first k; then the exact measure, alike for equal vectors
                mine = score[n, near]
                near = near[mine >= np.partition(mine, len(near) - self.k)[len(near) - self.k] - 1e-6 * (1 + np.abs(mine).max())]
            if len(near):
                exact = (e[near] * q[n]).sum(axis=1)
                best = np.lexsort((own[near], -exact))[: self.k]
                yield n, own[near][best], exact[best]


def search(vectors: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: of each row whose id is divisible by `every`, its k nearest among all other
    rows by inner product, nearest first, ties to the smaller id.

    Null ids, and vectors that are null, zero, of another length than most or with null or non-finite parts take
    no part; rows with the query's own id are no candidates. Rows equal in id and vector count once; an id with several
    vectors is that many rows. Fewer than k candidates give fewer rows; an empty table gives none. Tables of any size are
    searched alike; with a recall of 1, and no more queries than settings.tried, every neighbour is found."""
    s = settings or Settings()
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[vec_id]
    index = build(vectors, vec_id, embedding, s)
    if index is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    wanted, sizes = measured_walk(index, every, k, s), index.sizes
    n, cpus = int(sizes.sum()), spark.sparkContext.defaultParallelism
    shard = int(min(s.shard, max(1024, -(-n // (2 * cpus)))))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    first, last = starts[:-1] // shard, np.maximum(starts[:-1], starts[1:] - 1) // shard
    books = index._replace(table=None)  # what tasks need of the index
    columns = f"shard int, query boolean, cell int, id {kind}, v array<double>, walk_end double"
    names = [x.split()[0] for x in columns.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, h = batch.column(3).to_numpy(), batch.column(2).to_numpy().view(np.uint64)
            at = (starts[cell] + (h % np.maximum(sizes[cell], 1).astype(np.uint64)).astype(np.int64)) // shard
            none = pa.nulls(batch.num_rows, pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.zeros(len(at), bool)), batch.column(3), batch.column(0), batch.column(1), none], names)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lot in range(0, whole.num_rows, 1024):
                batch = whole.slice(lot, 1024)
                d1, d2 = books.distances(matrix(batch.column(1)))
                rows, shards, ends = [], [], []
                for r in range(batch.num_rows):
                    cells = np.array(walk(d1[r], d2[r], sizes, wanted), dtype=np.int64)
                    to = np.zeros(int(last[-1]) + 2, dtype=np.int64)
                    np.add.at(to, first[cells], 1)
                    np.add.at(to, last[cells] + 1, -1)
                    to = np.flatnonzero(np.cumsum(to)[:-1])
                    rows.append(np.full(len(to), r))
                    shards.append(to)
                    ends.append(np.full(len(to), (d1[r][cells // len(books.c2)] + d2[r][cells % len(books.c2)]).max()))
                take = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shards).astype(np.int32)), pa.array(np.ones(len(take), bool)), batch.column(3).take(take), batch.column(0).take(take), batch.column(1).take(take), pa.array(np.concatenate(ends))], names)

    queries = index.table.filter(F.col("vec_id") % every == 0).repartition(max(1, min(cpus * 2, n // every // 64 + 1)), "h")
    both = index.table.mapInArrow(place, columns).unionByName(queries.mapInArrow(route, columns))
    both = both.repartition(int(last[-1]) + 1, "shard").sortWithinPartitions("shard", "query", "cell")

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        at, now = -1, None
        for batch in batches:
            shards, query = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((np.diff(shards) != 0) | np.diff(query)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if shards[a] != at:
                    at, now, held = int(shards[a]), None, []
                part = batch.slice(a, b - a)
                if not query[a]:
                    held.append(part)
                    continue
                if held:
                    t = pa.Table.from_batches(held)
                    now, held = _Shard(books, t.column("id").to_numpy(), matrix(t.column("v")), t.column("cell").to_numpy(), k), []
                    del t
                if now is None:
                    continue
                for lot in range(0, part.num_rows, s.block):
                    some = part.slice(lot, s.block)
                    ids, q = some.column(3).to_numpy(), matrix(some.column(4))
                    ends = some.column(5).to_numpy()
                    got = [(np.full(len(c), ids[n]), np.full(len(c), zlib.crc32(q[n].tobytes())), c, score) for n, c, score in now.nearest(ids, q, ends + 1e-9 * (1 + np.abs(ends)))]
                    if got:
                        qid, of, c, score = (np.concatenate(x) for x in zip(*got, strict=True))
                        yield pa.RecordBatch.from_arrays([pa.array(qid).cast(some.column(3).type), pa.array(of.astype(np.int64)), pa.array(c).cast(some.column(3).type), pa.array(score)], ["query_id", "of", "vec_id", "score"])

    found = both.mapInArrow(rerank, f"query_id {kind}, of long, vec_id {kind}, score double")
    order = Window.partitionBy("query_id", "of").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
