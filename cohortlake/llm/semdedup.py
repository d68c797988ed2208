"""Near-duplicate embeddings by an inverted multi-index.

The two halves of a vector, scaled to length one, have codebooks of their own; the cells are the
product of the two. A vector lies in the cell of its nearest centroids. It visits cells in the order
of a lower bound of the distance to anything in them: per half, how far the half would have to
move until another centroid is the nearer one; the squares add up. Two vectors lie on two sides of
the planes between their cells, and their distances to those planes add up to no more than their
own distance; so of each link one vector, at least, has half of the squared distance as its bound
for the other's cell. The walk ends there, and the target recall is 1. Who meets is verified by the
exact cosine. A link that both vectors walk to counts once.

The codebooks come from ``SAMPLE`` rows at most, the first by hash; every row is indexed, and any
codebook gives the same links, only in more or less time. They grow with the rows, so that a cell has
``ROWS_IN_CELL`` of them on average.

Vectors that are equal are one entry with a count. A cell's members and visitors are dealt to
blocks, and a task compares one block of each, so a hot cell is many tasks. A block gives per entry
the number of its links and the smallest entry that links within the block lead to: rows by entry,
never by pair.

Cases: rows with a null label, a null vec_id, or a vector that is null, zero, or holds null or
non-finite components link with nothing; vectors of different lengths don't either. They come back
with n_links 0 and their own vec_id. Rows that share a vec_id are one vector of the graph; each row
has the links of its own label and values. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import prepare, staged
from cohortlake.llm.vectors import cosines, matrix, norms, usable

THRESHOLD = 0.98
SAMPLE = 8192
#: Rows of a cell, on average, and centroids of a half at most. More centroids: fewer comparisons, more
#: cells to visit.
ROWS_IN_CELL, CENTROIDS = 800, 1024
BLOCK = 512
#: Copies of a vector beyond which it is hot, in rows and as a share of all rows.
COPIES, HOT = 1000, 10_000


def codebook(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of rows (k-means from an even spread of them)."""
    rows = np.unique(rows, axis=0)
    if not len(rows):
        return np.zeros((1, rows.shape[1]))
    pick = np.random.default_rng(5).permutation(len(rows))[:k]
    centroids = rows[pick].copy()
    for _ in range(rounds):
        nearest = distances(rows, centroids).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, rows)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled][:, None]
    return centroids


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (rows, centroids)."""
    return np.maximum(
        (rows**2).sum(1)[:, None] - 2 * rows @ centroids.T + (centroids**2).sum(1), 0
    )


def reach(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and squared lower bounds of the row's distance to
    whatever lies nearest to each centroid."""
    far = distances(rows, centroids)
    own = far.argmin(axis=1)
    gap = np.sqrt(distances(centroids, centroids))[own]
    bound = (far - far[np.arange(len(rows)), own][:, None]) / np.where(gap > 0, 2 * gap, np.inf)
    return own, np.maximum(bound, 0) ** 2


def traverse(one: np.ndarray, other: np.ndarray, limit: float, width: int) -> np.ndarray:
    """The cells of a row in ascending order of their bounds, as far as the bound allows."""
    a, b = np.flatnonzero(one <= limit), np.flatnonzero(other <= limit)
    total = one[a][:, None] + other[b][None, :]
    i, j = np.nonzero(total <= limit)
    order = np.argsort(total[i, j], kind="stable")
    return (a[i] * width + b[j])[order]


def train(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The two codebooks for each length of vector in the sample."""
    n = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("dim", "vec").collect()
    by_dim: dict[int, list[np.ndarray]] = {}
    for dim, vec in sample:
        v = np.frombuffer(vec)
        by_dim.setdefault(dim, []).append(v / np.sqrt((v * v).sum()))
    books = {}
    for dim, v in by_dim.items():
        cells = n * len(v) / len(sample) / ROWS_IN_CELL
        k = max(1, min(int(np.ceil(np.sqrt(cells))), CENTROIDS, len(v) // 8))
        books[dim] = codebook(np.array(v)[:, : dim // 2], k), codebook(np.array(v)[:, dim // 2 :], k)
    return books


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        # -0.0 and 0.0 are one value
        raw = [(np.frombuffer(v) + 0.0).tobytes() for v in part.column("vec").to_pylist()]
        digest = pa.array([hashlib.blake2b(v, digest_size=16).digest() for v in raw], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [*part.columns, digest], names=[*part.schema.names, "digest"]
        )


def _linked(cell: pa.Table, threshold: float) -> pa.RecordBatch:
    """Links of a block: per entry the vectors it links with, and the smallest entry reached."""
    dim = cell["dim"][0].as_py()
    visits = cell["visits"].to_numpy()
    who = cell["entry"].to_numpy()
    copies = cell["copies"].to_numpy()
    raw = matrix(cell["vec"], dim)
    v, m = np.flatnonzero(visits == 1), np.flatnonzero(visits == 0)
    unit = raw / norms(raw)[:, None]
    near = unit[v] @ unit[m].T
    links = near >= threshold
    close = np.argwhere(np.abs(near - threshold) < 1e-9)
    if len(close):
        exact = cosines(raw[v[close[:, 0]]], raw[m[close[:, 1]]])
        links[close[:, 0], close[:, 1]] = exact >= threshold
    links &= who[v][:, None] != who[m][None, :]
    # where the member visits the visitor's home as well, the one with the smaller name counts
    one, other = np.nonzero(links)
    if len(one):
        walked = cell["walked"].combine_chunks().take(pa.array(m))
        flat, sizes = walked.flatten().to_numpy(), walked.value_lengths().to_numpy()
        homes = cell["home"].to_numpy()
        width = max(int(flat.max(initial=0)), int(homes.max())) + 1
        known = np.sort(np.repeat(np.arange(len(m)), sizes) * width + flat)
        asked = other * width + homes[v[one]]
        at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
        back = known[at] == asked if len(known) else np.zeros(len(one), dtype=bool)
        links[one, other] = ~back | (who[v[one]] < who[m[other]])
    some_v, some_m = links.any(axis=1), links.any(axis=0)
    v, m, links = v[some_v], m[some_m], links[some_v][:, some_m]
    at_v, at_m = who[v].copy(), who[m].copy()
    highest = np.iinfo(np.int64).max
    while len(v):
        new_m = np.minimum(at_m, np.where(links, at_v[:, None], highest).min(axis=0))
        new_v = np.minimum(at_v, np.where(links, new_m[None, :], highest).min(axis=1))
        if (new_m == at_m).all() and (new_v == at_v).all():
            break
        at_v, at_m = new_v, new_m
    count_v = links.astype(np.int64) @ copies[m]
    count_m = links.T.astype(np.int64) @ copies[v]
    return common.batch(
        ["entry", "links", "leads_to"],
        np.concatenate([who[v], who[m]]).astype(np.int64),
        np.concatenate([count_v, count_m]).astype(np.int64),
        np.concatenate([at_v, at_m]).astype(np.int64),
    )


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    spark = rows.sparkSession
    prepare(spark)
    vectors = staged(
        usable(rows.where("label IS NOT NULL")).mapInArrow(
            _digest, "vec_id long, label long, dim int, vec binary, digest binary"
        )
    )
    # Half of the squared distance of unit vectors with that cosine; a little more, for rounding.
    limit = 1 - threshold + 1e-9
    books = train(vectors)
    same = ["label", "digest"]
    counted = staged(
        vectors.groupBy(*same).agg(F.min("vec_id").alias("entry"), F.count("*").alias("copies"))
    )
    first = counted.withColumnRenamed("entry", "vec_id")
    entries = vectors.join(first, [*same, "vec_id"]).dropDuplicates([*same, "vec_id"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            dims = part.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = part.filter(pa.array(dims == dim))
                raw = matrix(own.column("vec"), dim)
                unit = raw / norms(raw)[:, None]
                half = dim // 2
                trivial = (np.zeros((1, half)), np.zeros((1, dim - half)))
                one, other = books.get(dim, trivial)
                home_a, far_a = reach(unit[:, :half], one)
                home_b, far_b = reach(unit[:, half:], other)
                cells = [
                    traverse(a, b, limit, len(other)) for a, b in zip(far_a, far_b, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("label"), own.column("dim"), own.column("vec_id"),
                        own.column("copies"), own.column("vec"),
                        pa.array(home_a * len(other) + home_b, pa.int64()),
                        pa.array(cells, pa.list_(pa.int64())),
                    ],
                    names=["label", "dim", "entry", "copies", "vec", "home", "cells"],
                )

    placed = staged(
        entries.mapInArrow(
            place,
            "label long, dim int, entry long, copies long, vec binary, home long, cells array<long>",
        )
    )
    where = ["label", "dim", "cell"]
    members = placed.withColumn("cell", F.col("home")).withColumnRenamed("cells", "walked")
    nowhere = F.lit(None).cast("array<long>")
    visitors = placed.withColumn("cell", F.explode("cells")).drop("cells").withColumn("walked", nowhere)
    blocks = lambda name: F.ceil(F.count("*") / BLOCK).cast("int").alias(name)
    sizes = (
        members.groupBy(*where)
        .agg(blocks("rows"))
        .join(visitors.groupBy(*where).agg(blocks("columns"), F.count("*").alias("n")), where)
        .where("n > 1")
        .drop("n")
    )
    block = lambda name: F.pmod(F.xxhash64("entry"), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    met = (
        members.join(sizes, where)
        .withColumns({"i": block("rows"), "j": every("columns"), "visits": F.lit(0)})
        .unionByName(
            visitors.join(sizes, where).withColumns(
                {"i": every("rows"), "j": block("columns"), "visits": F.lit(1)}
            )
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in common.runs(batches, [*where, "i", "j"]):
            yield _linked(cell, threshold)

    links = staged(
        common.dealt(met.drop("rows", "columns"), *where, "i", "j").mapInArrow(
            run, "entry long, links long, leads_to long"
        )
    )
    # An entry's name is its smallest vec_id; if that occurs with several vectors, they count
    # together, which repeated ids ask for.
    by_entry = links.groupBy("entry").agg(F.sum("links").alias("links"))
    edges = links.select(F.col("entry").alias("a"), F.col("leads_to").alias("b")).where("a <> b")
    # the names of vectors with many copies, fewer than HOT, are broadcast: no task gets all copies of one
    many = F.col("copies") > max(COPIES, (counted.agg(F.sum("copies")).first()[0] or 0) // HOT)
    hot, ids = F.broadcast(counted.where(many)), vectors.select("vec_id", *same)
    cold = ids.join(hot, same, "left_anti").join(counted.where(~many), same)
    named = staged(cold.unionByName(ids.join(hot, same)).drop(*same))
    several = (
        named.groupBy("vec_id")
        .agg(F.min("entry").alias("a"), F.max("entry").alias("z"))
        .where("a < z")
    )
    ties = named.join(several, "vec_id").select("a", F.col("entry").alias("b")).where("a <> b")
    found = common.components(edges.union(ties))
    known = (
        named.join(by_entry, "entry", "left")
        .join(found.select(F.col("node").alias("entry"), "component"), "entry", "left")
        .groupBy("vec_id")
        .agg(
            F.max(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.min(F.coalesce("component", "entry")).alias("component"),
        )
    )
    component = F.coalesce("component", "vec_id")
    return (
        rows.select(F.col("vec_id").cast("long"))
        .join(known, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
