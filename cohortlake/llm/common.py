"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.scratch import scratch_dir, staged, temporary

__all__ = ["components", "free_name", "prepare", "scratch_dir", "staged", "table", "temporary"]

ROOT = str(Path(__file__).resolve().parents[2])
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of text that are hashed in one go; longer texts are cut between words.
PIECE = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package where it is installed at the driver's path (on other
    clusters ship it with --py-files), and bound the bytes of an Arrow batch, so that very long
    texts do not meet by the ten thousand."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, ROOT]))
    spark.conf.set(BATCH_BYTES, "8m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- words as 64-bit hashes, many texts at once ------------------------------------------------

_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: every bit of the input moves every bit of the output."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _stream(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _MULTIPLIER + _U(seed))


_NEAR = 4096
_POSITION = _stream(7, _NEAR) | _U(1)
_BYTE = _stream(11, 256)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]  # A-Z count as a-z

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and the ASCII punctuation.
BREAKS = WHITE.copy()
BREAKS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = True


def _hash_piece(data: np.ndarray, breaks: np.ndarray, prefix: int):
    outside = breaks[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], outside, [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        empty = np.empty(0, dtype=_U)
        return starts, empty, empty
    word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(data))))
    place = np.arange(starts[0], len(data)) - starts[word]
    weight = _POSITION[np.minimum(place, _NEAR - 1)]
    far = place >= _NEAR
    if far.any():
        weight[far] = mix(place[far].astype(_U)) | _U(1)
    values = _BYTE[data[starts[0] :]] * weight
    values[outside[starts[0] :]] = 0
    at = starts - starts[0]
    size = (ends - starts).astype(_U)
    whole = mix(np.add.reduceat(values, at) + size * _MULTIPLIER)
    if not prefix:
        return starts, whole, whole
    values[place >= prefix] = 0
    return starts, whole, mix(np.add.reduceat(values, at) + _U(prefix))


def word_hashes(
    texts: list[bytes], breaks: np.ndarray = WHITE, prefix: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, ASCII letters in lower case: (number of the text, hash, hash of the
    word's first ``prefix`` bytes). A word is a longest run of bytes that ``breaks`` doesn't hold."""
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    owners, wholes, heads, begin = [], [], [], 0
    with np.errstate(over="ignore"):
        while begin < len(data):
            end = min(begin + PIECE, len(data))
            while end < len(data) and not breaks[data[end - 1]]:
                gap = np.flatnonzero(breaks[data[end : end + PIECE]])
                end = end + int(gap[0]) + 1 if len(gap) else min(end + PIECE, len(data))
            starts, whole, head = _hash_piece(data[begin:end], breaks, prefix)
            owners.append(np.searchsorted(offsets, starts + begin, side="right") - 1)
            wholes.append(whole)
            heads.append(head)
            begin = end
    if not owners:
        empty = np.empty(0, dtype=_U)
        return np.empty(0, dtype=np.int64), empty, empty
    return np.concatenate(owners), np.concatenate(wholes), np.concatenate(heads)


def groups(texts: Iterable[bytes], most: int = PIECE) -> Iterator[list[bytes]]:
    """Cut a sequence of texts into lists of about ``most`` bytes."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def as_bytes(column: pa.Array) -> list[bytes]:
    """A string column as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def batch(names: list[str], *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=names
    )


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut rows that are sorted by integer ``keys`` into one table per key; a table may begin in
    one batch and end in another."""
    held: pa.Table | None = None
    for part in batches:
        if not part.num_rows:
            continue
        rows = pa.Table.from_batches([part])
        rows = rows if held is None else pa.concat_tables([held, rows])
        of = np.stack([rows[c].to_numpy() for c in keys], axis=1)
        cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1).tolist()]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            yield rows.slice(lo, hi - lo)
        held = rows.slice(cuts[-1])
    if held is not None:
        yield held


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key in one task, sorted by key, ready for ``runs``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *keys).sortWithinPartitions(*keys)


# --- in another engine's words -----------------------------------------------------------------

#: For queries: ``bits`` has the table of the checksum in its one row.
CRC_TABLE_SQL = """
bits AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS bits
  FROM range(256) AS bytes(i))
""".strip()


def crc_sql(text: str) -> str:
    """CRC-32 of a text in UTF-8, beside ``bits``."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(octet_length(encode({text}))),
      lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, bits[(xor(c, b) & 255) + 1])))"""


def lower_sql(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# --- connected components ----------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges ``a``, ``b``: the smallest node reachable.

    Each round hooks every node onto its smallest neighbour, follows the hooks to their ends by
    doubling, and contracts the edges; an edge whose ends meet is gone. Rounds grow with the
    logarithm of the longest path. All of it is joins and aggregations over staged tables; those of the
    rounds are removed at the end.
    """
    with temporary(edges.sparkSession) as folder:
        return staged(_components(edges, folder))


def _components(edges: DataFrame, folder: str) -> DataFrame:
    edges = staged(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        folder,
    )
    found = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = staged(
            both.groupBy("a")
            .agg(F.min("b").alias("m"))
            .select(F.col("a").alias("node"), F.least("a", "m").alias("component")),
            folder,
        )
        while True:
            ends = hooks.select(F.col("node").alias("component"), F.col("component").alias("end"))
            hooks = staged(
                hooks.join(ends, "component").select(
                    "node",
                    F.col("end").alias("component"),
                    (F.col("end") != F.col("component")).alias("moved"),
                ),
                folder,
            )
            moved = not hooks.where("moved").isEmpty()
            hooks = hooks.drop("moved")
            if not moved:
                break
        to = lambda name: hooks.select(
            F.col("node").alias(name), F.col("component").alias(f"{name}_to")
        )
        if found is None:
            found = hooks
        else:
            ends = hooks.select(F.col("node").alias("component"), F.col("component").alias("end"))
            known = found.join(ends, "component", "left")
            new = hooks.join(found, "node", "left_anti")
            known = known.select("node", F.coalesce("end", "component").alias("component"))
            found = staged(known.unionByName(new), folder)
        edges = staged(
            edges.join(to("a"), "a")
            .join(to("b"), "b")
            .where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .distinct(),
            folder,
        )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name
