"""Token ids as binary shards with a minimal perfect hash index over document keys.

The table is range-sorted by doc_id; each task encodes its range and writes one shard: the raw ids
of its documents, one after the other, and an index file. The index has, per document in order,
its key and where its ids end, and a minimal perfect hash over the distinct keys: a bucket's stored
displacement leads a key to its slot, the slot holds a fingerprint and the document's number. The
smallest and largest key of every shard say which one to open; a keyed read then seeks to the
displacement, the slot and the document's ends, whatever the shard's size. A key that the shard doesn't have
is told by its fingerprint, but for one in 2^32, and by the key kept with the document.

Ids are little-endian unsigned integers of 16 bits if the vocabulary allows it, or else 32; the
index says which. Encoding is the ``tokenizers`` library's, once per distinct chunk and worker; what a worker
remembers over its tasks is bounded in chunks and bytes.

Cases: a null text counts as empty, so only the end id is written. Rows without a doc_id come
first and have no key: they are read in order only. Rows that share a doc_id follow each other by the hash
of their texts, over as many shards as they need; a keyed read gives them all. An empty table gives no shard. Other columns are not looked at.
"""

from __future__ import annotations

import io
import os
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.llm.bpe import LETTERS, Memory, byte_symbols, vocabulary_path
from cohortlake.llm.common import _stream, mix, prepare, scratch_dir, staged
from cohortlake.llm.store import open_file, qualified, write_file

END = 2
#: Keys per bucket of the hash, on average.
PER_BUCKET = 3
#: Displacements that are tried at a time.
TRIES = 64

_U = np.uint64
_BUCKET, _SLOT, _PRINT = _stream(41, 3)


def _slots(keys: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys ^ mix(shift.astype(_U) ^ _SLOT)) % _U(n)).astype(np.int64)


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys ^ _BUCKET) % _U(n)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ _PRINT) >> _U(32)).astype(np.uint32)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacements per bucket, slot per key) of distinct keys: the slots are 0 to n - 1, each
    once. Buckets are placed from the largest on; one with a single key names its slot, as -1 - s."""
    keys = keys.view(_U)
    n = len(keys)
    buckets = _buckets(keys, max(1, n // PER_BUCKET))
    shifts = np.zeros(max(1, n // PER_BUCKET), dtype=np.int64)
    order = np.argsort(buckets, kind="stable")
    found, starts, sizes = np.unique(buckets[order], return_index=True, return_counts=True)
    slot, free = np.full(n, -1, dtype=np.int64), np.ones(n, dtype=bool)
    for b in np.argsort(-sizes, kind="stable"):
        own = order[starts[b] : starts[b] + sizes[b]]
        if len(own) == 1:
            break
        tried = 0
        while True:
            shift = np.arange(tried, tried + TRIES)
            at = _slots(keys[own][None, :], shift[:, None], n)
            lines = np.sort(at, axis=1)
            fits = free[at].all(axis=1) & (lines[:, 1:] != lines[:, :-1]).all(axis=1)
            if fits.any():
                k = int(np.argmax(fits))
                shifts[found[b]], slot[own] = shift[k], at[k]
                free[at[k]] = False
                break
            tried += TRIES
    alone = order[starts[sizes == 1]]
    slot[alone] = np.flatnonzero(free)
    shifts[found[sizes == 1]] = -1 - slot[alone]
    return shifts, slot


class Index:
    """A shard's index: what ``build`` makes and ``to_bytes`` writes."""

    FIELDS = ("width", "keys", "missing", "ends", "shifts", "prints", "record")

    def __init__(self, **arrays: np.ndarray) -> None:
        self.arrays = arrays
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def build(cls, keys: list[int | None], sizes: list[int], width: int) -> Index:
        """From the documents' keys in order, None first and then ascending, and their ids' counts."""
        values = np.array([k or 0 for k in keys], dtype=np.int64)
        missing = np.array([k is None for k in keys], dtype=bool)
        unkeyed = int(missing.sum())
        distinct, first = np.unique(values[unkeyed:], return_index=True)
        shifts, slot = perfect_hash(distinct) if len(distinct) else (np.zeros(1, np.int64), first)
        prints, record = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.int64)
        prints[slot] = fingerprints(distinct.view(_U))
        record[slot] = first + unkeyed
        return cls(
            width=np.array(width),
            keys=values,
            missing=missing,
            ends=np.cumsum(np.array(sizes, dtype=np.int64)),
            shifts=shifts,
            prints=prints,
            record=record,
        )

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        for name in self.FIELDS:
            np.save(out, self.arrays[name])
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        file = io.BytesIO(data)
        return cls(**{name: np.load(file) for name in cls.FIELDS})

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of the first document with each key, or -1."""
        keys = np.asarray(keys, dtype=np.int64).view(_U)
        n = len(self.record)
        if not n:
            return np.full(len(keys), -1, dtype=np.int64)
        shift = self.shifts[_buckets(keys, len(self.shifts))]
        slot = np.where(shift < 0, -1 - shift, _slots(keys, np.maximum(shift, 0), n))
        return np.where(self.prints[slot] == fingerprints(keys), self.record[slot], -1)

    def span(self, record: int) -> tuple[int, int]:
        """Where a document's ids begin and end in the shard."""
        return int(self.ends[record - 1]) if record else 0, int(self.ends[record])


class StoredIndex:
    """An index that lies in a file, of which single numbers are read."""

    def __init__(self, file) -> None:
        self.file, self.places = file, {}
        for name in Index.FIELDS:
            np.lib.format.read_magic(file)
            shape, _, dtype = np.lib.format.read_array_header_1_0(file)
            n, begin = int(np.prod(shape)), file.tell()
            self.places[name] = (begin, n, dtype)
            file.seek(begin + n * dtype.itemsize)

    def __len__(self) -> int:
        return self.places["keys"][1]

    def get(self, name: str, at: int = 0):
        begin, _, dtype = self.places[name]
        self.file.seek(begin + at * dtype.itemsize)
        return np.frombuffer(self.file.read(dtype.itemsize), dtype=dtype)[0]

    def find(self, key: int) -> int:
        """The number of the first document with the key, or -1."""
        keys, n = np.array([key], dtype=np.int64).view(_U), self.places["record"][1]
        if not n:
            return -1
        shift = self.get("shifts", int(_buckets(keys, self.places["shifts"][1])[0]))
        slot = -1 - int(shift) if shift < 0 else int(_slots(keys, np.array([shift]), n)[0])
        return int(self.get("record", slot)) if self.get("prints", slot) == fingerprints(keys)[0] else -1

    def span(self, record: int) -> tuple[int, int]:
        return int(self.get("ends", record - 1)) if record else 0, int(self.get("ends", record))


def names(task: int) -> tuple[str, str]:
    return f"ids-{task:06d}.bin", f"index-{task:06d}.bin"


@cache
def library_memory(path: str) -> Memory:
    """Encodes distinct chunks with the ``tokenizers`` library."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    names_of = str.maketrans({chr(b): name for b, name in enumerate(byte_symbols())})
    model = tokenizer.model

    def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A chunk of letters below U+0130 is one word that normalizing only puts in lower case, so
        it goes to the library's model at once; others go the library's whole way."""
        ids: list[list[int] | None] = []
        for chunk in chunks:
            if chunk.isalpha() and max(chunk) < LETTERS:
                word = chunk.lower().encode().decode("latin-1").translate(names_of)
                ids.append([token.id for token in model.tokenize(word)])
            else:
                ids.append(None)
        rest = [i for i, known in enumerate(ids) if known is None]
        for begin in range(0, len(rest), 4096):
            some = rest[begin : begin + 4096]
            found = tokenizer.encode_batch([chunks[i] for i in some], add_special_tokens=False)
            for i, one in zip(some, found, strict=True):
                ids[i] = one.ids
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum()))
        return flat, counts

    return Memory(encode, tokenizer.get_vocab_size(with_added_tokens=True))


def write_shards(docs: DataFrame, folder: str, path: str | None = None, end: int = END) -> DataFrame:
    """Write the ids of (doc_id, text) to ``folder``; returns (task, records, tokens, low, high) per
    shard, with the smallest and largest of its keys. Shards in the order of their task numbers hold the documents in ascending doc_id order."""
    spark = docs.sparkSession
    prepare(spark)
    where = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        memory = library_memory(where)
        width = np.dtype(memory.dtype).itemsize
        keys, sizes = [], []

        def payload() -> Iterator[bytes]:
            for part in batches:
                keys.extend(part.column("doc_id").to_pylist())
                for ids in memory.encode(part.column("text").to_pylist()):
                    sizes.append(len(ids) + 1)
                    yield np.append(ids, memory.dtype(end)).astype(f"<u{width}").tobytes()

        ids_name, index_name = names(task)
        write_file(folder, ids_name, payload())
        write_file(folder, index_name, [Index.build(keys, sizes, width).to_bytes()])
        keyed = [key for key in keys if key is not None]
        row = (task, len(keys), sum(sizes), min(keyed, default=None), max(keyed, default=None))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int64()) for x in row], names=["task", "records", "tokens", "low", "high"]
        )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    # rows without a key, or with the same, are dealt to ranges by their texts, and equal ones at random
    rows = rows.withColumns({"hash": F.xxhash64("text"), "salt": F.rand(5)})
    order = [F.col("doc_id").asc_nulls_first(), "hash", "salt"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return staged(
        rows.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
        .mapInArrow(run, "task long, records long, tokens long, low long, high long")
    )


class Shards:
    """The shards of a folder, for reading. ``manifest`` is what ``write_shards`` returns: a row
    per task, so the driver holds numbers of tasks only."""

    def __init__(self, folder: str, manifest: DataFrame) -> None:
        rows = manifest.select("task", "tokens", "low", "high").collect()
        rows.sort(key=lambda row: row.task)
        self.folder = folder
        self.tasks = [row.task for row in rows]
        self.begin = [0]
        for row in rows:
            self.begin.append(self.begin[-1] + row.tokens)
        # by range of keys; ranges may share their ends
        keyed = [row for row in rows if row.low is not None]
        self.lows, self.highs = [row.low for row in keyed], [row.high for row in keyed]
        self.keyed = [row.task for row in keyed]

    def _open(self, task: int):
        ids_name, index_name = names(task)
        with open_file(self.folder, index_name) as file:
            index = Index.from_bytes(file.read())
        return index, open_file(self.folder, ids_name)

    def _read(self, index, file, record: int, width: int) -> tuple[int, np.ndarray]:
        lo, hi = index.span(record)
        file.seek(lo * width)
        return lo, np.frombuffer(file.read((hi - lo) * width), dtype=f"<u{width}").astype("<u4")

    def shards_of(self, key: int) -> list[int]:
        """The shards whose range holds a key: one, unless its documents reach over several."""
        return self.keyed[bisect_left(self.highs, key) : bisect_right(self.lows, key)]

    def lookup(self, keys: list[int]) -> list[list[np.ndarray]]:
        """For each key the ids of the documents that have it."""
        found: list[list[np.ndarray]] = [[] for _ in keys]
        for place, key in enumerate(keys):
            for task in self.shards_of(key):
                ids_name, index_name = names(task)
                with open_file(self.folder, index_name) as own, open_file(self.folder, ids_name) as file:
                    index = StoredIndex(own)
                    width, record = int(index.get("width")), index.find(key)
                    while 0 <= record < len(index) and index.get("keys", record) == key:
                        found[place].append(self._read(index, file, record, width)[1])
                        record += 1
        return found

    def documents(self, spark: SparkSession) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) of every document, a shard per task. Each key's
        place comes from the shard's hash."""
        prepare(spark)
        begin = dict(zip(self.tasks, self.begin, strict=False))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                for task in part.column("id").to_pylist():
                    if task in begin:
                        yield self._digests(task, begin[task])

        n = max(self.tasks, default=-1) + 1
        return spark.range(0, n, 1, max(n, 1)).mapInArrow(
            run, "doc_id long, start long, n_tokens long, ids_crc32 long"
        )

    def _digests(self, task: int, begin: int) -> pa.RecordBatch:
        index, file = self._open(task)
        n = len(index.keys)
        place = np.arange(n)
        keyed = ~index.missing
        first = index.find(index.keys[keyed])
        own = index.keys[keyed]
        run_start = np.flatnonzero(np.diff(own, prepend=own[:1] - 1)) if len(own) else first
        within = np.arange(len(own)) - np.repeat(run_start, np.diff(np.append(run_start, len(own))))
        place[keyed] = first + within
        starts, counts, sums = [], [], []
        with file:
            for record in place.tolist():
                lo, ids = self._read(index, file, record, int(index.width))
                starts.append(begin + lo)
                counts.append(len(ids))
                sums.append(zlib.crc32(ids.tobytes()))
        columns = [pa.array(index.keys, mask=index.missing)]
        columns += [pa.array(x, pa.int64()) for x in (starts, counts, sums)]
        return pa.RecordBatch.from_arrays(
            columns, names=["doc_id", "start", "n_tokens", "ids_crc32"]
        )

    def shard_of(self, start: int) -> int:
        """The task that wrote the id at a global place."""
        return self.tasks[bisect_right(self.begin, start) - 1]


def token_files(docs: DataFrame, folder: str | None = None, path: str | None = None) -> DataFrame:
    """Write the shards and read them back."""
    spark = docs.sparkSession
    folder = qualified(spark, folder or scratch_dir(spark))
    return Shards(folder, write_shards(docs, folder, path)).documents(spark)
