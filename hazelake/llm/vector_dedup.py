"""Embedding near-duplicates by an inverted multi-index.

Vectors are scaled to unit length and halved, and each half has its own codebook; a pair of centroids is a cell of the
product grid. Every vector stays in the cell next to it. From a vector, cells are visited in the order of their
distance (a multi-sequence traversal of the two sorted lists of centroids) until the distance exceeds that of the
nearest cell by a bound at which the target recall is met for vectors just at the threshold, in whichever coordinates
they differ. What is met is verified with the exact cosine. As a pair may be found from either side, the recall of pairs lies above the target.

Copies of a vector are one class, indexed once. A full cell is dealt out in blocks of bounded size, each compared as
one product of matrices.
"""

import heapq
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazelake.llm.common import checkpointed, only, sliced, staged
from hazelake.llm.components import components

THRESHOLD = 0.9
#: Rows from which codebooks and the bound are fitted; every row is indexed.
SAMPLE_ROWS = 20_000
#: Centroids of a half, at most; about ``CELL_ROWS`` vectors are meant to share a cell below that.
MOST_CENTROIDS, CELL_ROWS = 256, 16
#: Share of vectors just at the threshold whose cell is visited from the other one.
TARGET_RECALL = 0.95
#: Numbers of coordinates that vectors at the threshold may differ in, beside one half and all of them.
FEW = (1, 2, 4, 8)
#: Rows of a block of those that stay in a cell, and of those that visit it.
STAYING_ROWS, VISITING_ROWS = 2048, 8192
ROUNDS = 10


def _usable(vectors: DataFrame) -> DataFrame:
    """``embedding`` as an array of doubles; null if it cannot be compared (null, zero, or holding null or non-finite)."""
    exact = F.col("embedding").cast("array<double>")
    finite = F.forall(exact, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists(exact, lambda x: x != 0)
    return vectors.withColumn("embedding", F.when(usable, exact))


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten()).reshape(-1, width)


def _distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    squares = (rows**2).sum(axis=1)[:, None] - 2 * rows @ centroids.T + (centroids**2).sum(axis=1)
    return np.maximum(squares, 0)


def _codebook(rows: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Centroids of ``rows`` by Lloyd's rounds."""
    pick = np.random.default_rng(seed)
    centroids = rows[pick.choice(len(rows), min(size, len(rows)), replace=False)].copy()
    for _ in range(ROUNDS):
        own = _distances(rows, centroids).argmin(axis=1)
        for k in range(len(centroids)):
            if (own == k).any():
                centroids[k] = rows[own == k].mean(axis=0)
    return centroids


class Grid:
    """Codebooks of both halves and how far beyond the nearest cell a traversal goes."""

    def __init__(self, sample: np.ndarray, rows: int, threshold: float, recall: float):
        self.width, self.half = sample.shape[1], sample.shape[1] // 2
        size = int(np.clip(round((rows / CELL_ROWS) ** 0.5), 1, MOST_CENTROIDS))
        unit = _unit(sample)
        self.books = [_codebook(part, size, seed) for seed, part in enumerate(self.halves(unit))]
        self.beyond = self._bound(unit, threshold, recall)

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit[:, : self.half], unit[:, self.half :]

    def distances(self, unit: np.ndarray) -> list[np.ndarray]:
        return [_distances(part, book) for part, book in zip(self.halves(unit), self.books, strict=True)]

    def _bound(self, unit: np.ndarray, threshold: float, recall: float) -> float:
        """Quantile of how much farther than its own cell the cell of a vector at the threshold is.

        Vectors may differ in all coordinates, in one half, or in few of them, where a cell is left sooner; the bound is
        the largest of all these cases.
        """
        turn, (n, width) = np.random.default_rng(2), unit.shape
        near, rows, bounds = self.distances(unit), np.arange(n), []
        few = [k for k in FEW if k < width]
        for case in range(3 + len(few)):
            aside = turn.normal(size=unit.shape)
            if case in (1, 2):
                aside[:, slice(self.half) if case == 1 else slice(self.half, width)] = 0
            elif case > 2:
                at = np.argsort(turn.random(unit.shape), axis=1)[:, few[case - 3] :]
                np.put_along_axis(aside, at, 0, axis=1)
            aside -= (aside * unit).sum(axis=1, keepdims=True) * unit
            length = np.linalg.norm(aside, axis=1, keepdims=True)
            other = threshold * unit + (1 - threshold**2) ** 0.5 * aside / np.maximum(length, 1e-12)
            at = [d.argmin(axis=1) for d in self.distances(other)]
            excess = sum(d[rows, a] - d.min(axis=1) for d, a in zip(near, at, strict=True))
            bounds.append(np.quantile(excess, recall))
        return float(max(bounds)) + 1e-9

    def cell(self, distances: list[np.ndarray]) -> np.ndarray:
        return distances[0].argmin(axis=1) * len(self.books[1]) + distances[1].argmin(axis=1)

    def traversal(self, first: np.ndarray, second: np.ndarray) -> list[int]:
        """Cells in order of distance, until the bound; a cell waits until those before it in both lists were visited."""
        order = first.argsort(kind="stable"), second.argsort(kind="stable")
        a, b = first[order[0]], second[order[1]]
        most, waiting, visited = a[0] + b[0] + self.beyond, [(a[0] + b[0], 0, 0)], []
        while waiting and waiting[0][0] <= most:
            _, i, j = heapq.heappop(waiting)
            visited.append(int(order[0][i]) * len(second) + int(order[1][j]))
            if i + 1 < len(a) and j == 0:
                heapq.heappush(waiting, (a[i + 1] + b[0], i + 1, 0))
            if j + 1 < len(b):
                heapq.heappush(waiting, (a[i] + b[j + 1], i, j + 1))
        return visited


def _visits(grid: Grid, batch):
    unit = _unit(_matrix(batch.column(1), grid.width))
    near = grid.distances(unit)
    cells = [grid.traversal(x, y) for x, y in zip(*near, strict=True)]
    return grid.cell(near), np.array([c for found in cells for c in found], np.int64), [len(found) for found in cells]


def _count(batches, grid: Grid):
    size = len(grid.books[0]) * len(grid.books[1])
    staying, visiting = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for batch in sliced(batches, 4096):
        own, cells, _ = _visits(grid, batch)
        staying += np.bincount(own, minlength=size)
        visiting += np.bincount(cells, minlength=size)
    at = np.flatnonzero(staying)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at), pa.array(staying[at]), pa.array(visiting[at])], names=["cell", "staying", "visiting"]
    )


def _deal(batches, grid: Grid, counts: dict[int, tuple[int, int]]):
    """Rows for each block of a cell that a vector stays in or visits."""
    size = len(grid.books[0]) * len(grid.books[1])
    parts = np.zeros((2, size), np.int64)
    for cell, (staying, visiting) in counts.items():
        parts[:, cell] = -(-staying // STAYING_ROWS), -(-visiting // VISITING_ROWS)
    for batch in sliced(batches, 1024):
        ids = np.asarray(batch.column(0))
        own, cells, sizes = _visits(grid, batch)
        row = np.repeat(np.arange(len(ids)), sizes)
        used = parts[0, cells] > 0  # nothing stays in the others
        row, cells = row[used], cells[used]
        mixed = (ids * 2654435761 & 0xFFFFFFFF) >> 7
        for role, at, cell in ((0, np.arange(len(ids)), own), (1, row, cells)):
            blocks = parts[1 - role, cell]  # of the other role, which all must be met
            start = np.cumsum(blocks) - blocks
            other = np.arange(int(blocks.sum())) - np.repeat(start, blocks)
            at, cell = np.repeat(at, blocks), np.repeat(cell, blocks)
            mine = mixed[at] % np.maximum(parts[role, cell], 1)
            a, b = (mine, other) if role == 0 else (other, mine)
            for i in range(0, len(at), 8192):
                cut = slice(i, i + 8192)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cell[cut]), pa.array(a[cut]), pa.array(b[cut]),
                        pa.array(np.full(len(at[cut]), role, np.int32)), pa.array(ids[at[cut]]),
                        batch.column(1).take(pa.array(at[cut])), batch.column(2).take(pa.array(at[cut])),
                    ],
                    names=["cell", "a", "b", "role", "id", "embedding", "copies"],
                )


def _roots(labels: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``labels`` lowered until the ends of every pair have the same."""
    while True:
        least = np.minimum(labels[p], labels[q])
        if (least == labels[p]).all() and (least == labels[q]).all():
            return labels
        np.minimum.at(labels, p, least)
        np.minimum.at(labels, q, least)


def _comparison(grid: Grid, threshold: float):
    """Compares a block. Each vector in it gets a row with its links counted here and a root within the block.

    A pair that is met from both sides is counted only where the vector with the smaller id visits. Instead of all
    pairs, a block returns what joins them.
    """

    def compare(block: pa.Table) -> pa.Table:
        role, ids, copies = (block.column(name).to_numpy() for name in ("role", "id", "copies"))
        unit = _unit(_matrix(block.column("embedding"), grid.width))
        near = grid.distances(unit)
        own = [d.argmin(axis=1) for d in near]
        reach = near[0].min(axis=1) + near[1].min(axis=1) + grid.beyond
        staying, visiting = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        nodes, node = np.unique(ids, return_inverse=True)
        others, joins = np.zeros(len(nodes), np.int64), []
        for i in range(0, len(visiting), 1024):
            rows = visiting[i : i + 1024]
            p, s = np.nonzero(unit[rows] @ unit[staying].T >= threshold)
            p, s = rows[p], staying[s]
            differs = ids[p] != ids[s]
            p, s = p[differs], s[differs]
            back = near[0][s, own[0][p]] + near[1][s, own[1][p]] <= reach[s]
            labels = _roots(np.arange(len(nodes)), node[p], node[s])
            joined = np.flatnonzero(labels != np.arange(len(nodes)))
            joins.append(np.stack([joined, labels[joined]]))
            once = (ids[p] < ids[s]) | ~back
            np.add.at(others, node[p[once]], copies[s[once]])
            np.add.at(others, node[s[once]], copies[p[once]])
        roots = _roots(np.arange(len(nodes)), *(np.concatenate([x[k] for x in joins] or [[]]).astype(int) for k in (0, 1)))
        used = np.flatnonzero((others > 0) | (roots != np.arange(len(nodes))))
        return pa.table({"id": nodes[used], "others": others[used], "root": nodes[roots[used]]})

    return compare


def links(classes: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """``id, others, root`` of the linked rows of ``classes(id, embedding, copies)``, in parts to be put together.

    ``id`` is a distinct long, ``embedding`` an array of doubles that can be compared. ``others`` sums to the copies of
    the classes it is linked with; links from ``id`` to ``root`` join what is linked. Vectors of different widths are
    not compared; each width has a grid of its own.
    """
    widths = classes.groupBy(F.size("embedding").alias("width")).count().collect()
    found = [classes.sparkSession.createDataFrame([], "id long, others long, root long")]
    for width, rows in sorted((r["width"], r["count"]) for r in widths):
        own = classes.where(F.size("embedding") == width).select("id", "embedding", "copies")
        share = min(1.0, SAMPLE_ROWS / rows)
        drawn = own.where(F.pmod(F.xxhash64("embedding"), F.lit(1 << 20)) <= share * (1 << 20)).limit(2 * SAMPLE_ROWS)
        sample = [r["embedding"] for r in drawn.select("embedding").collect()]
        sample = sample or [r["embedding"] for r in own.select("embedding").limit(1).collect()]
        grid = Grid(np.array(sample).reshape(-1, width), rows, threshold, recall)
        counted = own.mapInArrow(partial(_count, grid=grid), "cell long, staying long, visiting long")
        counts = {
            r["cell"]: (r["s"], r["v"])
            for r in counted.groupBy("cell").agg(F.sum("staying").alias("s"), F.sum("visiting").alias("v")).collect()
        }
        dealt = own.mapInArrow(
            partial(_deal, grid=grid, counts=counts),
            "cell long, a long, b long, role int, id long, embedding array<double>, copies long",
        )
        blocks = dealt.groupBy("cell", "a", "b")
        found.append(blocks.applyInArrow(_comparison(grid, threshold), "id long, others long, root long"))
    return reduce(DataFrame.unionByName, found)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding, …)``.

    Copies and repeated rows are linked with each other and with whatever one of them is linked with. A vector that
    cannot be compared has no link and is its own component. A null id is never the smallest of a component, unless
    there is no other, and never kept.
    """
    rows = _usable(only(vectors, "vec_id", "embedding"))
    classes = rows.where("embedding is not null").groupBy("embedding").agg(
        F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    classes = staged(classes.withColumn("id", F.monotonically_increasing_id()), "vectors")
    pairs = checkpointed(links(classes, threshold, recall))
    linked = pairs.groupBy("id").agg(F.sum("others").alias("others"))
    roots = components(pairs.select(F.col("id").alias("a"), F.col("root").alias("b")))
    of_class = (
        classes.join(linked, "id", "left")
        .join(roots, F.col("id") == F.col("node"), "left")
        .select(
            "embedding",
            "first",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("root", "id").alias("root"),
        )
    )
    least = of_class.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = of_class.join(least, "root").select("embedding", "n_links", "component_id")
    return rows.join(of_class, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(
            F.col("vec_id") == F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")),
            F.lit(False),
        ).alias("kept"),
    )
