"""Approximate nearest neighbours by cosine: low-dimensional stable projections, kd-trees and a chi-square stopping test.

Vectors are scaled to length one and projected on ``AXES`` Gaussian directions. For a pair at distance d, the squared
projected distance over d^2 follows a chi-square law with ``AXES`` degrees of freedom. Neighbours in the projected space
are met in the order of their distance and verified with the exact cosine; the search ends when the next projected
distance is so large that a pair closer than the k-th found so far would lie there with probability 1 - ``CONFIDENCE``.

A top kd-tree, fitted on a bounded sample of ``SAMPLE`` vectors (the first by hash of their id), cuts the projected space
into cells; every vector is indexed in its cell. Cells of more than ``BLOCK`` vectors are split by hash, so hot cells and
equal vectors spread over tasks. A query searches its own cell first. With the distance found there it goes on to the
cells whose bounding box passes the same test, and the best of all blocks are merged. A block is a kd-tree of its own in
a task's memory; queries stream past it.

Defined cases: vectors that are NULL, zero, of another length than most, or hold NULL or non-finite components take no
part, neither do rows with a NULL id. Rows that repeat an id are one candidate, the nearest of them, and never a
candidate of their own query; as queries the first of them by content counts. Ties go to the smaller id. Fewer than k candidates are
all returned. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pulseframe.sources.staging import stage

AXES = 8
CONFIDENCE = 0.97
SAMPLE = 32_768
BLOCK = 4_096
MOST_CELLS = 2_048
LEAF = 128
QUERY_EVERY = 50
NEIGHBOURS = 5
SLACK = 1e-9


@lru_cache(maxsize=8)
def chi_square_quantile(share: float, freedom: int = AXES) -> float:
    """The value below which a chi-square number with an even number of degrees of freedom lies with this share."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, freedom // 2):
            term *= mid / 2 / i
            total += term
        low, high = (mid, high) if 1 - exp(-mid / 2) * total < share else (low, mid)
    return high


@lru_cache(maxsize=8)
def directions(size: int) -> np.ndarray:
    """The fixed projection of vectors of this length."""
    return np.random.default_rng(20_240_501).standard_normal((size, AXES))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of binary vectors (float64) as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), "f8").reshape(len(column), -1)


def projected(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ directions(vectors.shape[1])


def split_order(points: np.ndarray, leaves: int) -> list[np.ndarray]:
    """Cut points into about ``leaves`` groups by medians of the widest axis."""
    groups = [np.arange(len(points))]
    while len(groups) < leaves:
        parts = []
        for g in groups:
            if len(g) < 2:
                parts.append(g)
                continue
            axis = int(np.argmax(np.ptp(points[g], axis=0)))
            order = g[np.argsort(points[g, axis], kind="stable")]
            parts += [order[:len(g) // 2], order[len(g) // 2:]]
        if len(parts) == len(groups):
            break
        groups = parts
    return groups


class CellTree:
    """The top kd-tree: medians of a sample, applied to any number of points."""

    def __init__(self, sample: np.ndarray, cells: int) -> None:
        self.nodes: list[tuple[int, float, int, int]] = []  # axis, cut, left, right; below 0: -(cell + 1)
        self.cells = 0
        self.root = self._grow(sample, cells)

    def _grow(self, points: np.ndarray, cells: int) -> int:
        spread = np.ptp(points, axis=0) if len(points) else np.zeros(AXES)
        if cells < 2 or not spread.max() > 0:
            self.cells += 1
            return -self.cells
        axis = int(np.argmax(spread))
        cut = float(np.median(points[:, axis]))
        below = points[:, axis] <= cut
        if below.all():  # the median is the largest value: cut just below it
            cut = float(points[points[:, axis] < cut, axis].max())
            below = points[:, axis] <= cut
        number = len(self.nodes)
        self.nodes.append((axis, cut, 0, 0))
        left = self._grow(points[below], cells // 2)
        right = self._grow(points[~below], cells - cells // 2)
        self.nodes[number] = (axis, cut, left, right)
        return number

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), "i4")
        waiting = [(self.root, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            axis, cut, left, right = self.nodes[node]
            below = points[rows, axis] <= cut
            waiting += [(left, rows[below]), (right, rows[~below])]
        return out


class Block:
    """A kd-tree over some vectors: leaves of neighbouring points with their boxes in the projected space."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        points = projected(vectors)
        groups = split_order(points, max(1, -(-len(ids) // LEAF)))
        order = np.concatenate(groups)
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.ends = np.cumsum([len(g) for g in groups])
        self.low = np.stack([points[g].min(axis=0) for g in groups])
        self.high = np.stack([points[g].max(axis=0) for g in groups])

    def nearest(self, own: int, vector: np.ndarray, point: np.ndarray, k: int, known: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the k nearest of this block, as far as the stopping test with the k-th cosine, which is
        ``known`` at first (below -1: none), lets them be seen."""
        reach = chi_square_quantile(CONFIDENCE)
        gaps = np.maximum(0.0, np.maximum(self.low - point, point - self.high))
        away = (gaps * gaps).sum(axis=1)
        length = np.linalg.norm(vector)
        best_ids, best, worst = np.zeros(0, "i8"), np.zeros(0), known
        for leaf in np.argsort(away, kind="stable"):
            if worst >= -1 and away[leaf] > (max(0.0, 2 - 2 * worst) + SLACK) * reach:
                break
            rows = slice(self.ends[leaf - 1] if leaf else 0, self.ends[leaf])
            scores = (self.vectors[rows] @ vector) / (self.norms[rows] * length)
            fits = scores >= worst
            if not fits.any():
                continue
            best_ids, best = first_of_each(
                np.concatenate([best_ids, self.ids[rows][fits]]), np.concatenate([best, scores[fits]]), own, k
            )
            if len(best) == k:
                worst = max(worst, best[-1])
        return best_ids, best


def first_of_each(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score, then id, each id once and without ``own``."""
    order = np.lexsort((ids, -scores))
    ids, scores = ids[order], scores[order]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)
    first = first[ids[first] != own][:k]
    return ids[first], scores[first]


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (float64 as bytes) of the rows that take part."""
    narrow = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    sizes = narrow.where("v IS NOT NULL AND vec_id IS NOT NULL").groupBy(F.size("v").alias("n")).count()
    most = sizes.where("n > 0").orderBy(F.desc("count"), F.desc("n")).select("n").limit(1).collect()
    size = most[0]["n"] if most else 0
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = narrow.where((F.size("v") == size) & F.col("vec_id").isNotNull() & finite & F.exists("v", lambda x: x != 0))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy().astype("<f8").reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([row.tobytes() for row in flat], pa.binary())], names=["vec_id", "vector"]
            )

    return kept.mapInArrow(pack, "vec_id long, vector binary")


def with_cells(vectors: DataFrame, tree: CellTree) -> DataFrame:
    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = tree.cell_of(projected(matrix(batch.column("vector"))))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells, pa.int32())], names=["vec_id", "vector", "cell"]
                )

    return vectors.mapInArrow(place, "vec_id long, vector binary, cell int")


def boxes(indexed: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cell, number of vectors and bounding box of every cell, folded in the tasks before the driver sees them."""
    sides = [f"{side}{axis}" for side in ("low", "high") for axis in range(AXES)]

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points, cells = projected(matrix(batch.column("vector"))), batch.column("cell").to_numpy()
            names, number = np.unique(cells, return_inverse=True)
            low, high = np.full((len(names), AXES), np.inf), np.full((len(names), AXES), -np.inf)
            np.minimum.at(low, number, points)
            np.maximum.at(high, number, points)
            columns = [pa.array(names, pa.int32()), pa.array(np.bincount(number), pa.int64())]
            columns += [pa.array(c) for c in (*low.T, *high.T)]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "n", *sides])

    parts = indexed.mapInArrow(fold, "cell int, n long, " + ", ".join(f"{s} double" for s in sides))
    folded = parts.groupBy("cell").agg(
        F.sum("n").alias("n"), *[(F.min if s.startswith("low") else F.max)(s).alias(s) for s in sides]
    )
    return [
        (r["cell"], r["n"], np.array([r[f"low{a}"] for a in range(AXES)]), np.array([r[f"high{a}"] for a in range(AXES)]))
        for r in folded.orderBy("cell").collect()
    ]


def sub_block(key: str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(key), parts).cast("int")


def searched(indexed: DataFrame, routes: DataFrame, parts: DataFrame, k: int) -> DataFrame:
    """The k best (query_id, vec_id, score) of every block for every query routed to its cell.

    ``routes`` holds query_id, vector, cell and ``known``; ``parts`` the number of blocks of every cell.
    """
    points = indexed.join(F.broadcast(parts), "cell").select(
        "cell", sub_block("vec_id", F.col("parts")).alias("part"), F.lit(0).alias("kind"), F.col("vec_id").alias("id"),
        "vector", F.lit(-2.0).alias("known"),
    )
    asked = routes.join(F.broadcast(parts), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"),
        F.col("query_id").alias("id"), "vector", "known",
    )
    dealt = points.unionByName(asked).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind", "id")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, tree, ids, vectors = None, None, [], []
        for batch in batches:
            found: list[tuple[int, np.ndarray, np.ndarray]] = []
            columns = [batch.column(n).to_pylist() for n in ("cell", "part", "kind", "id", "vector", "known")]
            for cell, part, kind, number, vector, known in zip(*columns, strict=True):
                if (cell, part) != place:
                    place, tree, ids, vectors = (cell, part), None, [], []
                if kind == 0:
                    ids.append(number)
                    vectors.append(vector)
                    continue
                if tree is None and ids:
                    tree = Block(np.array(ids), np.frombuffer(b"".join(vectors), "f8").reshape(len(ids), -1))
                if tree is not None:
                    own = np.frombuffer(vector, "f8")
                    found.append((number, *tree.nearest(number, own, projected(own[None])[0], k, known)))
            ids_found = np.concatenate([np.zeros(0, "i8"), *(f[1] for f in found)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype("i8"), pa.int64()),
                 pa.array(ids_found.astype("i8"), pa.int64()),
                 pa.array(np.concatenate([np.zeros(0), *(f[2] for f in found)]), pa.float64())],
                names=["query_id", "vec_id", "score"],
            )

    return dealt.mapInArrow(search, "query_id long, vec_id long, score double")


def merged(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the k best of all blocks."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def nearest_neighbours(
    rows: DataFrame, every: int = QUERY_EVERY, k: int = NEIGHBOURS, block: int = BLOCK, sample: int = SAMPLE
) -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest of every row whose id is divisible by ``every``."""
    vectors = stage(usable(rows), "vectors")
    count = vectors.count()
    chosen = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vector").toArrow().column("vector")
    points = projected(matrix(chosen.combine_chunks())) if count else np.zeros((0, AXES))
    tree = CellTree(points, min(MOST_CELLS, max(1, -(-count // block))))
    indexed = stage(with_cells(vectors, tree), "indexed")
    known_cells = boxes(indexed)
    parts = rows.sparkSession.createDataFrame(
        [(cell, -(-n // block)) for cell, n, _, _ in known_cells], "cell int, parts int"
    )
    queries = (
        indexed.where(F.col("vec_id") % every == 0)
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min_by(F.struct("vector", "cell"), "vector").alias("own"))
        .select("query_id", "own.vector", "own.cell")
    )
    queries = stage(queries, "queries")
    first = stage(searched(indexed, queries.withColumn("known", F.lit(-2.0)), parts, k), "home")
    kth = merged(first, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("known"))
    waiting = queries.join(kth, "query_id", "left").select("query_id", "vector", "cell", F.coalesce("known", F.lit(-2.0)).alias("known"))

    cells = np.array([c for c, _, _, _ in known_cells], "i4")
    low = np.array([b for _, _, b, _ in known_cells]).reshape(-1, AXES)
    high = np.array([b for _, _, _, b in known_cells]).reshape(-1, AXES)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = chi_square_quantile(CONFIDENCE)
        for batch in batches:
            for number, vector, home, known in zip(*(batch.column(n).to_pylist() for n in ("query_id", "vector", "cell", "known")), strict=True):
                point = projected(np.frombuffer(vector, "f8")[None])[0]
                gaps = np.maximum(0.0, np.maximum(low - point, point - high))
                away = (gaps * gaps).sum(axis=1)
                passes = cells != home
                if known >= -1:
                    passes &= away <= (max(0.0, 2 - 2 * known) + SLACK) * reach
                n = int(passes.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * n, pa.int64()), pa.array([vector] * n, pa.binary()),
                     pa.array(cells[passes], pa.int32()), pa.array([known] * n, pa.float64())],
                    names=["query_id", "vector", "cell", "known"],
                )

    routes = waiting.mapInArrow(route, "query_id long, vector binary, cell int, known double")
    return merged(first.unionByName(searched(indexed, routes, parts, k)), k)
