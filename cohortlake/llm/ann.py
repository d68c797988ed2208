"""Nearest neighbours by randomly rotated one-bit codes.

Indexing: centroids are fitted to ``SAMPLE`` vectors at most, the first by hash; every row is dealt to
the cell of its nearest centroid. A vector, scaled to length one, less the centroid, is rotated at random; the
code is the sign of each coordinate, a bit. Three numbers go with it: the length of what was coded, its inner
product with the code (how well the code stands for it), and its inner product with the centroid.

Searching: a query visits the cells of its nearest centroids, as many as the sample's own neighbours need to be
found with a recall of ``RECALL``; neighbours in the sample lie farther than those in the whole table, so
that is on the safe side. In a cell the inner product of a query with a code is counted on packed bits: the
query's coordinates are rounded to ``PLANES`` bits, and each plane's bits are counted where the code has a
one. Divided by the second number it estimates the cosine without bias; the error shrinks with the
dimension and has a bound that holds with a confidence that ``WIDTH`` sets. Only vectors whose upper bound
reaches the k-th best lower bound of distinct ids in the cell are reranked, by the exact cosine of the original
vectors, which lie in the cell with their codes: a row is sent once, and the queries come to the rows. A cell
of many rows is dealt to blocks, and its many queries to blocks as well, a task holding one of each.
Queries that get fewer than k candidates that way, as all their cells hold copies or nothing, visit all cells.
``recall=1`` is the exact way: all cells, and every row reranked.

Cases: rows with a null vec_id, or a vector that is null, zero, or holds null or non-finite
components, take no part; nor do vectors of another length than the query's. Rows that share the
query's vec_id are not its candidates. A candidate id that occurs several times counts once, with
its largest cosine. Fewer than k candidates: all of them. Ties go to the smaller vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import prepare, staged
from cohortlake.llm.vectors import cosines, matrix, norms, usable

#: Standard widths of the error bound on either side; a row is passed over only if two of them miss.
WIDTH = 2.0
#: Bits that a query's coordinates are rounded to.
PLANES = 5
RECALL = 0.97
SAMPLE = 4096
#: Rows that a cell should have, and centroids at most.
ROWS_IN_CELL, CENTROIDS = 2048, 1024
#: Rows and queries of a block.
ROWS_IN_BLOCK, QUERIES_IN_BLOCK = 8192, 2048
FIELDS = (
    "vec_id long, dim int, vec binary, cell int, code binary, length double, fit double, centred double"
)
NAMES = [field.split()[0] for field in FIELDS.split(", ")]


@cache
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, centre: np.ndarray):
    """Codes (packed bits) of unit vectors, with length, fit and inner product with the centre, which is
    one for all of them or a row for each."""
    dim = unit.shape[1]
    rest = unit - centre
    length = norms(rest)
    turned = (rest / np.where(length > 0, length, 1)[:, None]) @ rotation(dim)
    fit = np.abs(turned).sum(axis=1) / np.sqrt(dim)
    return np.packbits(turned > 0, axis=1), length, fit, (rest * centre).sum(axis=1)


def words(codes: np.ndarray) -> np.ndarray:
    """Rows of packed bits as 64-bit words, filled up with zeros."""
    out = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), dtype=np.uint8)
    out[:, : codes.shape[1]] = codes
    return out.view(np.uint64)


def packed_inner(codes: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of rows of ``turned`` with the signs of codes, (rows, codes), counted on bits, and the
    standard width of what rounding the coordinates leaves out."""
    dim = turned.shape[1]
    low, high = turned.min(axis=1), turned.max(axis=1)
    step = np.where(high > low, high - low, 1) / (2**PLANES - 1)
    level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    held = words(codes)
    ones = np.bitwise_count(held).sum(axis=1)
    total = np.zeros((len(turned), len(codes)), dtype=np.int64)
    for plane in range(PLANES):
        bits = words(np.packbits(level >> plane & 1, axis=1))
        for k in range(held.shape[1]):
            total += np.bitwise_count(bits[:, k, None] & held[None, :, k]).astype(np.int64) << plane
    # the sum over ones, twice, less the sum over all
    inner = 2 * (low[:, None] * ones + step[:, None] * total)
    inner -= (dim * low + step * level.sum(axis=1))[:, None]
    return inner, step * np.sqrt(dim / 12)


def bounds(codes, length, fit, centred, queries: np.ndarray, centre: np.ndarray):
    """Estimated cosines of unit queries with coded vectors, and the width of their bounds:
    two arrays (queries, vectors)."""
    dim = queries.shape[1]
    moved = queries - centre
    inner, rounding = packed_inner(codes, moved @ rotation(dim))
    fit = np.where(fit > 0, fit, 1)
    scale = length / fit
    estimate = (queries @ centre)[:, None] + scale * inner / np.sqrt(dim) + centred
    spread = np.sqrt(np.maximum(1 - fit**2, 0) / max(dim - 1, 1))
    width = np.hypot(spread * norms(moved)[:, None], rounding[:, None] / np.sqrt(dim))
    return estimate, WIDTH * scale * width + 1e-12


def nearest_cells(unit: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The centroids of each row, nearest first."""
    return np.argsort((centroids * centroids).sum(axis=1) / 2 - unit @ centroids.T, axis=1, kind="stable")


def centroids_of(unit: np.ndarray, n: int) -> np.ndarray:
    """``n`` means of the rows, by Lloyd's rounds from rows drawn at random."""
    found = unit[np.random.default_rng(len(unit)).permutation(len(unit))[:n]].copy()
    for _ in range(8 if n > 1 else 1):
        own = nearest_cells(unit, found)[:, 0] if n > 1 else np.zeros(len(unit), dtype=int)
        counts = np.bincount(own, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, own, unit)
        some = counts > 0
        found[some] = sums[some] / counts[some, None]
    return found


def visits(unit: np.ndarray, centroids: np.ndarray, k: int, recall: float) -> int:
    """How many cells the rows must visit to find that share of their k nearest among themselves."""
    asked = unit[:: max(1, len(unit) // 512)]
    score = asked @ unit.T
    score[np.arange(len(asked)), np.arange(0, len(unit), max(1, len(unit) // 512))[: len(asked)]] = -np.inf
    near = np.argsort(-score, axis=1)[:, : min(k, len(unit) - 1)]
    own = nearest_cells(unit, centroids)[:, 0]
    place = np.argsort(nearest_cells(asked, centroids), axis=1)
    needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel())
    if not len(needed):
        return len(centroids)
    return int(needed[min(int(np.ceil(recall * len(needed))), len(needed) - 1)]) + 1


class Index:
    """Coded rows, and for each length of vector its centroids and how many of them a query visits. Vectors
    of a length that the sample doesn't have are one cell."""

    def __init__(self, rows: DataFrame, centroids: dict[int, np.ndarray], visited: dict[int, int]) -> None:
        self.rows, self.centroids, self.visited = rows, centroids, visited


def centroids_for(dim: int, centroids: dict[int, np.ndarray]) -> np.ndarray:
    return centroids.get(dim, np.zeros((1, dim)))


def _units(column: pa.Array, dim: int) -> np.ndarray:
    raw = matrix(column, dim)
    return raw / norms(raw)[:, None]


def index(rows: DataFrame, k: int = 5, recall: float = RECALL) -> Index:
    """Code every usable row of (vec_id, embedding)."""
    prepare(rows.sparkSession)
    vectors = staged(usable(rows).select("vec_id", "dim", "vec"))
    n = vectors.count()
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE).select("dim", "vec").collect()
    by_dim: dict[int, list[bytes]] = {}
    for dim, vec in sample:
        by_dim.setdefault(dim, []).append(vec)
    centroids, visited = {}, {}
    for dim, some in by_dim.items():
        unit = _units(pa.array(some, pa.binary()), dim)
        wanted = n * len(some) / len(sample) / ROWS_IN_CELL
        # a centroid should stand for a few rows of the sample at least
        centroids[dim] = centroids_of(unit, int(min(max(wanted, 1), CENTROIDS, max(len(some) // 4, 1))))
        cells = len(centroids[dim])
        visited[dim] = cells if recall >= 1 else visits(unit, centroids[dim], k, recall)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            dims = part.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = part.filter(pa.array(dims == dim))
                unit = _units(own.column("vec"), dim)
                middle = centroids_for(dim, centroids)
                cell = nearest_cells(unit, middle)[:, 0]
                codes, *numbers = encode(unit, middle[cell])
                code = pa.array([c.tobytes() for c in codes], pa.binary())
                columns = [*own.columns, pa.array(cell, pa.int32()), code, *map(pa.array, numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return Index(staged(vectors.mapInArrow(run, FIELDS)), centroids, visited)


def _best(cell: pa.Table, centre: np.ndarray, k: int, exact: bool) -> Iterator[tuple]:
    """(query, id, cosine): the k best rows of a cell's block for each query of the block."""
    asked = cell.filter(pa.compute.equal(cell["asks"], 1))
    held = cell.filter(pa.compute.equal(cell["asks"], 0))
    if not len(asked) or not len(held):
        return
    dim = len(centre)
    raw, ids = matrix(held["vec"], dim), held["vec_id"].to_numpy()
    codes = np.frombuffer(b"".join(held["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
    numbers = [held[n].to_numpy() for n in ("length", "fit", "centred")]
    by_id = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.diff(ids[by_id], prepend=ids[by_id[0]] - 1))
    # rows of few queries at a time: the bounds of one with all rows of the block are a row each
    for begin in range(0, len(asked), 256):
        some = asked.slice(begin, 256)
        queries, own = matrix(some["vec"], dim), some["vec_id"].to_numpy()
        unit = queries / norms(queries)[:, None]
        chosen = own[:, None] != ids[None, :]
        if not exact and len(starts) > k:
            estimate, width = bounds(codes, *numbers, unit, centre)
            lower = np.where(chosen, estimate - width, -np.inf)
            # the bound is over ids, an id with its largest: copies of one must not take several places
            if len(starts) < len(ids):
                lower = np.maximum.reduceat(lower[:, by_id], starts, axis=1)
            kth = np.partition(lower, -k, axis=1)[:, -k]
            chosen &= estimate + width >= kth[:, None]
        for q in range(len(own)):
            near = np.flatnonzero(chosen[q])
            if not len(near):
                continue
            score = cosines(raw[near], np.broadcast_to(queries[q], (len(near), dim)))
            if len(near) > 4 * k and len(starts) == len(ids):
                some_best = np.flatnonzero(score >= np.partition(score, -k)[-k])
                near, score = near[some_best], score[some_best]
            order = np.lexsort((-score, ids[near]))
            near, score = near[order], score[order]
            first = np.flatnonzero(np.diff(ids[near], prepend=ids[near[0]] - 1))
            near, score = near[first], score[first]
            for i in np.lexsort((ids[near], -score))[:k]:
                yield int(own[q]), int(ids[near[i]]), float(score[i])


def _probed(asking: DataFrame, held: Index, every: bool) -> DataFrame:
    """(vec_id, dim, vec, cell): the queries, once per cell that they visit."""
    centroids, visited = held.centroids, held.visited

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            dims = part.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = part.filter(pa.array(dims == dim))
                middle = centroids_for(dim, centroids)
                order = nearest_cells(_units(own.column("vec"), dim), middle)
                cells = order if every else order[:, : visited.get(dim, len(middle))]
                lists = pa.array(list(cells.astype(np.int32)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(c) for c in ("vec_id", "dim", "vec")), lists],
                    names=["vec_id", "dim", "vec", "cells"],
                )

    listed = asking.select("vec_id", "dim", "vec").mapInArrow(
        run, "vec_id long, dim int, vec binary, cells array<int>"
    )
    return listed.select("vec_id", "dim", "vec", F.explode("cells").alias("cell"))


def _found(held: Index, asking: DataFrame, k: int, every: bool, exact: bool) -> DataFrame:
    """(query_id, vec_id, score) of the k best of every cell's block that a query visits."""
    probes = _probed(asking, held, every)
    blocks = lambda n, name: F.ceil(F.count("*") / n).cast("int").alias(name)
    sizes = (
        held.rows.groupBy("dim", "cell").agg(blocks(ROWS_IN_BLOCK, "row_blocks"))
        .join(probes.groupBy("dim", "cell").agg(blocks(QUERIES_IN_BLOCK, "query_blocks")), ["dim", "cell"])
    )
    own = lambda n: F.pmod(F.xxhash64("vec_id", "vec"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = [*NAMES, "i", "j", "asks"]
    rows = held.rows.join(sizes, ["dim", "cell"]).withColumns(
        {"i": own("row_blocks"), "j": each("query_blocks"), "asks": F.lit(0)}
    )
    queries = probes.join(sizes, ["dim", "cell"]).withColumns(
        {
            "i": each("row_blocks"), "j": own("query_blocks"), "asks": F.lit(1),
            "code": F.lit(None).cast("binary"),
            **{name: F.lit(None).cast("double") for name in ("length", "fit", "centred")},
        }
    )
    centroids = held.centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in common.runs(batches, ["dim", "cell", "i", "j"]):
            centre = centroids_for(part["dim"][0].as_py(), centroids)[part["cell"][0].as_py()]
            found = list(_best(part, centre, k, exact))
            columns = zip(*found, strict=True) if found else ([], [], [])
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["query_id", "vec_id", "score"],
            )

    cells = rows.select(names).unionByName(queries.select(names))
    return common.dealt(cells, "dim", "cell", "i", "j").mapInArrow(
        run, "query_id long, vec_id long, score double"
    )


def search(held: Index, asks: Column, k: int = 5, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every indexed row that ``asks``."""
    asking = held.rows.where(asks)
    exact = recall >= 1

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return (
            found.groupBy("query_id", "vec_id")
            .agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
        )

    found = staged(best(_found(held, asking, k, exact, exact)))
    if exact:
        return found
    enough = found.where(F.col("rank") == k).select("query_id")
    short = asking.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti")
    if short.isEmpty():
        return found
    again = best(_found(held, short, k, True, True))
    return found.join(enough, "query_id", "left_semi").unionByName(again)


def nearest(rows: DataFrame, asks: Column, k: int = 5, recall: float = RECALL) -> DataFrame:
    """Index every row of (vec_id, embedding) and search it for the rows that ``asks``."""
    return search(index(rows, k, recall), asks, k, recall)
