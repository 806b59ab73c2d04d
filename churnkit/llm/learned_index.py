"""Approximate nearest neighbours over learned partitions: a balanced cut of a neighbour graph and a classifier that routes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import stored

# The index is fitted on so many vectors at most, those whose ids have the least hash; every vector is indexed.
SAMPLE = 4096
# A partition for each so many vectors of the sample, up to a number of partitions.
SAMPLE_PER_PART, MAX_PARTS = 128, 32
NEIGHBOURS = 10
# Recall that probes are chosen for, measured on vectors of the sample that neither graph nor classifier has seen.
AIM = 0.97
# Vectors that a task holds while queries pass by.
CELL_ROWS = 4096


def nearest_in(sample: np.ndarray, queries: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Places of the ``k`` nearest vectors of a sample for each query; ``own`` names the place of the query itself."""
    out = []
    squares = (sample ** 2).sum(1)
    for at in range(0, len(queries), 512):
        part = queries[at:at + 512]
        far = squares - 2 * part @ sample.T
        if own is not None:
            far[np.arange(len(part)), own[at:at + 512]] = np.inf
        out.append(np.argpartition(far, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def cut_graph(neighbours: np.ndarray, parts: int, slack: float = 0.05, rounds: int = 30) -> np.ndarray:
    """Partition of a neighbour graph (row i has the neighbours of vertex i) into parts of nearly equal size that few edges
    cross.

    Halves are split off along the second eigenvector of the graph, found by power iteration. Then vertices move to the
    part that most of their neighbours are in, those that gain most first, as long as sizes stay within ``slack`` of equal.
    """
    n, k = neighbours.shape
    a = np.concatenate([np.repeat(np.arange(n), k), neighbours.ravel()])
    b = np.concatenate([neighbours.ravel(), np.repeat(np.arange(n), k)])
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    rng = np.random.default_rng(0)
    while todo:
        own, first, share = todo.pop()
        if share == 1:
            part[own] = first
            continue
        place = np.full(n, -1)
        place[own] = np.arange(len(own))
        inside = (place[a] >= 0) & (place[b] >= 0)
        x, y = place[a[inside]], place[b[inside]]
        degree = np.bincount(x, minlength=len(own)) + 1.0
        v = rng.standard_normal(len(own))
        for _ in range(60):
            v -= (v * degree).sum() / degree.sum()
            v = (v + np.bincount(x, v[y], len(own))) / degree + v
            v /= np.linalg.norm(v) + 1e-30
        left = share // 2
        order = np.argsort(v, kind="stable")
        cut = len(own) * left // share
        todo += [(own[order[:cut]], first, left), (own[order[cut:]], first + left, share - left)]
    most, least = int(np.ceil(n / parts * (1 + slack))), int(n / parts * (1 - slack))
    sizes = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        links = np.bincount(a * parts + part[b], minlength=n * parts).reshape(n, parts)
        here = links[np.arange(n), part]
        best = links.argmax(1)
        gain = links[np.arange(n), best] - here
        moved = 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < most and sizes[part[v]] > least:
                sizes[part[v]] -= 1
                sizes[best[v]] += 1
                part[v] = best[v]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A network of one hidden layer that says how probable it is to find neighbours of a vector in each partition."""

    first: np.ndarray
    bias: np.ndarray
    second: np.ndarray
    offset: np.ndarray
    centre: np.ndarray
    scale: float
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.offset)

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        x = (vectors - self.centre) / self.scale
        return np.maximum(x @ self.first + self.bias, 0) @ self.second + self.offset

    def part_of(self, vectors: np.ndarray) -> np.ndarray:
        return self.logits(vectors).argmax(1)

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The most probable partitions of each vector, as many as there are probes."""
        return np.argsort(-self.logits(vectors), axis=1, kind="stable")[:, :self.probes]


def train_router(vectors: np.ndarray, wanted: np.ndarray, hidden: int = 128, epochs: int = 40, seed: int = 3) -> Router:
    """Fit a router to ``wanted``, for each vector the shares of its neighbourhood that lie in each partition."""
    rng = np.random.default_rng(seed)
    n, d = vectors.shape
    parts = wanted.shape[1]
    centre = vectors.mean(0)
    scale = float(np.sqrt(((vectors - centre) ** 2).mean())) or 1.0
    net = [rng.standard_normal((d, hidden)) * (2 / d) ** 0.5, np.zeros(hidden),
           rng.standard_normal((hidden, parts)) * (1 / hidden) ** 0.5, np.zeros(parts)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in net]
    x = (vectors - centre) / scale
    turn = 0
    for epoch in range(epochs):
        order = rng.permutation(n)
        step = 0.003 * (1 - epoch / epochs) + 1e-4
        for at in range(0, n, 256):
            own = order[at:at + 256]
            h = np.maximum(x[own] @ net[0] + net[1], 0)
            z = h @ net[2] + net[3]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            dz = (p - wanted[own]) / len(own)
            dh = dz @ net[2].T * (h > 0)
            turn += 1
            for i, g in enumerate((x[own].T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                g = g + 1e-4 * net[i]
                m, v = moments[i]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net[i] = net[i] - step * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.999 ** turn)) + 1e-8)
    return Router(*net, centre, scale)


def fit_router(sample: np.ndarray, k: int = NEIGHBOURS) -> Router:
    """A router learned from a sample, with as many probes as it takes to reach the recall aimed at.

    A quarter of the sample is kept back. The neighbour graph of the rest is cut, the classifier learns the cut, and for the
    quarter it is counted how many probes find the nearest of all vectors of the sample. Copies count once.
    """
    sample = np.unique(np.asarray(sample, np.float64), axis=0)
    sample = sample[np.random.default_rng(1).permutation(len(sample))]
    kept = sample[len(sample) // 4:]
    parts = min(MAX_PARTS, len(kept) // SAMPLE_PER_PART)
    if parts < 2:
        d = sample.shape[1]
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), np.zeros(d), 1.0)
    near = nearest_in(kept, kept, k, np.arange(len(kept)))
    cut = cut_graph(near, parts)
    around = np.concatenate([cut[:, None], cut[near]], axis=1)
    shares = np.stack([np.bincount(row, minlength=parts) for row in around]) / around.shape[1]
    router = train_router(kept, shares)
    asked = np.arange(len(sample) // 4)
    true = router.part_of(sample)[nearest_in(sample, sample[asked], k, asked)]
    order = np.argsort(-router.logits(sample[asked]), axis=1, kind="stable")
    rank = np.argsort(order, axis=1)[np.arange(len(asked))[:, None], true]
    found = np.cumsum(np.bincount(rank.ravel(), minlength=parts)) / rank.size
    router.probes = int(np.searchsorted(found, AIM) + 1)
    router.probes = min(router.probes, parts)
    return router


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part: with an id, no null or non-finite component, not zero. Where vectors differ
    in length, those of the most frequent length do, of two such lengths the shorter."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0))
    length = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (length.d if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def index_vectors(rows: DataFrame, router: Router) -> DataFrame:
    """(id, part, vector) for every row of ``usable``: each vector is in the partition the router finds most probable."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                part = router.part_of(_matrix(b.column("vector")))
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(part, pa.int32()), b.column("vector")], ["id", "part", "vector"])

    return rows.mapInArrow(run, "id long, part int, vector array<double>")


def _best(ids: np.ndarray, vectors: np.ndarray, squares: np.ndarray, query: int, point: np.ndarray, close: np.ndarray, k: int):
    """The ``k`` ids of a cell nearest to one query, by exact distances, ties by id. Equal ids stand next to each other."""
    other = np.flatnonzero(ids != query)
    if not len(other):
        return other, other
    far = close[other]
    firsts = np.flatnonzero(np.concatenate([[True], np.diff(ids[other]) != 0]))
    if len(firsts) > k:
        # each id counts once, at its nearest row
        nearest = np.minimum.reduceat(far, firsts) if len(firsts) < len(other) else far
        bound = np.partition(nearest, k - 1)[k - 1]
        # sums found by products may be off in their last digits: whatever may tie is measured again
        other = other[far <= bound + 1e-9 * (1 + squares.max() + point @ point)]
    exact = np.sqrt(((vectors[other] - point) ** 2).sum(1))
    order = np.lexsort((ids[other], exact))
    chosen, seen = [], set()
    for i in order:
        if ids[other[i]] not in seen:
            seen.add(ids[other[i]])
            chosen.append(i)
            if len(chosen) == k:
                break
    return ids[other[chosen]], exact[chosen]


def search_cells(indexed: DataFrame, queries: DataFrame, router: Router, k: int) -> DataFrame:
    """(query_id, vec_id, score): for each query and each cell it visits, the nearest of the cell.

    A partition is dealt into cells of about ``CELL_ROWS`` vectors by the hash of their ids, so one that holds a third of
    all rows, or copies of one vector, is searched by many tasks. A task holds one cell's vectors and lets the queries pass.
    """
    sizes = {r.part: r.n for r in indexed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = np.array([max(1, -(-sizes.get(p, 0) // CELL_ROWS)) for p in range(router.parts)])
    firsts = np.cumsum(cells) - cells

    def routed(batches):
        for b in batches:
            if b.num_rows:
                parts = router.route(_matrix(b.column("vector")))
                for vector, i in zip(b.column("vector"), range(b.num_rows), strict=True):
                    visited = np.concatenate([firsts[p] + np.arange(cells[p]) for p in parts[i]])
                    n = len(visited)
                    yield pa.RecordBatch.from_arrays([pa.array(visited, pa.int64()), pa.array([1] * n, pa.int32()), pa.array([b.column("id")[i].as_py()] * n, pa.int64()),
                                                      pa.array([vector.as_py()] * n, pa.list_(pa.float64()))], ["cell", "kind", "id", "vector"])

    schema = "cell long, kind int, id long, vector array<double>"
    asks = queries.select("id", "vector").mapInArrow(routed, schema)
    first, count = (F.element_at(F.array(*[F.lit(int(x)) for x in column]), F.col("part") + 1) for column in (firsts, cells))
    held = indexed.select((first + F.pmod(F.xxhash64("id"), count)).cast("long").alias("cell"), F.lit(0).alias("kind"), "id", "vector")
    dealt = held.union(asks).repartition("cell").sortWithinPartitions("cell", "kind", "id")

    def run(batches):
        cell, parts, here = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            cols = np.asarray(b.column(0)), np.asarray(b.column(1)), np.asarray(b.column(2))
            matrix = _matrix(b.column(3))
            edges = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            for at, end in zip([0, *edges], [*edges, b.num_rows], strict=True):
                if cols[0][at] != cell:
                    cell, parts, here = cols[0][at], [], None
                if cols[1][at] == 0:
                    parts.append((cols[2][at:end], matrix[at:end]))
                    continue
                if not parts:
                    continue
                if here is None:
                    ids, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
                    here = ids, vectors, (vectors ** 2).sum(1)
                ids, vectors, squares = here
                points = matrix[at:end]
                close = squares - 2 * points @ vectors.T
                found = [_best(ids, vectors, squares, int(q), p, c, k) for q, p, c in zip(cols[2][at:end], points, close, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(cols[2][at:end], [len(i) for i, _ in found]), pa.int64()),
                     pa.array(np.concatenate([i for i, _ in found]), pa.int64()),
                     pa.array(np.concatenate([s for _, s in found]), pa.float64())], ["query_id", "vec_id", "score"])

    return dealt.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest_neighbours(vectors: DataFrame, every: int = 100, k: int = NEIGHBOURS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, its ``k`` nearest found among all
    rows of other ids, nearest first, ties to the smaller id; score is the Euclidean distance of the original vectors.

    Candidates are the rows of the partitions that the router finds most probable for the query; how many are visited is
    set by the recall on a part of the sample kept back, so vectors without structure cost more probes. Rows that cannot
    take part (see ``usable``) are neither queries nor candidates. Rows with one id count once, at their nearest; of query
    rows with one id the least vector asks. A table without rows that take part gives none; other columns are not read.
    """
    rows = stored(usable(vectors, key, vector).distinct(), "vectors")
    sample = np.array([r.vector for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()], np.float64)
    if not len(sample):
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    router = fit_router(sample, min(k, max(1, len(sample) // 4)))
    queries = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    found = search_cells(stored(index_vectors(rows, router), "indexed"), queries, router, k)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
