"""Language-model scores of documents by stupid backoff, relationally.

Three relations. The n-grams of every order, counted per block of documents; a block is a hash
bucket of documents. The count table, partitioned by the hash of the n-gram: totals over all
blocks. And the totals joined back to the blocks' n-grams, from which each block sums the log
scores of its documents. An n-gram is one row per block and not per occurrence, so the most
frequent word is no hot key, and what one task holds is one block or one partition of the table.

What the shuffles write is what bounds the operator, so all of it travels compressed. Texts are shuffled
once, as batches of a block's documents that a task has read. The rows of a (block, partition) travel
as one packed row: sorted 64-bit hashes as differences, with their counts. Back go, in the same order,
a bit per n-gram that says whether it occurs in other blocks, and the totals of those that do; the
block finds its n-grams again in its texts. Numbers go in byte planes, each compressed by itself: low
planes of differences are noise, and would hide that the high ones and those of counts are not.

A document is scored against all others: its own occurrences are taken off every count. With
c the counts that are left and n all words left, a word w after the words u gets

    c(u w) / c(u)                  if c(u w) > 0
    0.4 * (the score after u without its first word)      otherwise

and without words before it c(w) / n, or 0.4 / n if no other document has it.

Words are runs without white space, ASCII letters in lower case. Cases: a null or empty text has
n_words 0 and null for the scores. A single document, with no others to learn from, has only unseen
words and n = 1. Rows that share a doc_id are documents of their own. Rows without a doc_id are
scored too. Rows go to blocks by id and text, so a repeated id isn't one block. An empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import mix, prepare
from cohortlake.llm.mixing import size_of

ORDER = 3
BACKOFF = 0.4
#: Bytes of text in a block, about. The larger, the fewer blocks that an n-gram is a row of.
BLOCK_BYTES = 16 << 20
#: Bytes of text that a task packs by block in one go.
HELD_BYTES = 32 << 20

_U = np.uint64
_FACTORS = common._stream(53, 16) | _U(1)


def ngrams(texts: list[bytes], order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order from 1 on: the text of every n-gram, and its hash."""
    owner, words, _ = common.word_hashes(texts)
    out = []
    with np.errstate(over="ignore"):
        for n in range(1, order + 1):
            total = np.full(max(len(words) - n + 1, 0), _U(n) * _FACTORS[15])
            for k in range(n):
                total += words[k : len(words) - n + 1 + k] * _FACTORS[k]
            first = owner[: len(total)]
            whole = first == owner[n - 1 : n - 1 + len(total)]
            out.append((first[whole], mix(total[whole])))
    return out


def _pack_docs(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(batches).sort_by("block")
    blocks, starts = np.unique(rows["block"].to_numpy(), return_index=True)
    docs = rows.select(["doc_id", "text"])
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    packed = []
    for lo, hi in zip(starts, np.append(starts[1:], rows.num_rows), strict=True):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema, options=options) as stream:
            stream.write_table(docs.slice(lo, hi - lo))
        packed.append(sink.getvalue().to_pybytes())
    return common.batch(["block", "docs"], blocks, pa.array(packed, pa.binary()))


def pack_docs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, doc_id, text) as few rows (block, docs)."""
    held, size = [], 0
    for part in batches:
        if part.num_rows:
            held.append(part)
            size += part.nbytes
        if size >= HELD_BYTES:
            yield _pack_docs(held)
            held, size = [], 0
    if held:
        yield _pack_docs(held)


def unpack_docs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    for docs in rows["docs"]:
        yield from pa.ipc.open_stream(docs.as_buffer())


def _texts(rows: pa.Table) -> Iterator[list[bytes]]:
    texts = chain.from_iterable(common.as_bytes(docs["text"]) for docs in unpack_docs(rows))
    return common.groups(texts)


def _distinct(rows: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes of the block's n-grams of all orders, and their counts."""
    hashes = np.concatenate([h for texts in _texts(rows) for _, h in ngrams(texts, order)])
    hashes.sort()
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)
    return hashes[first], np.diff(first, append=len(hashes))


def _cuts(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Where the sorted hashes of each partition of the table begin; partitions are ranges."""
    width = (1 << 64) // parts + 1
    edges = np.array([i * width for i in range(parts)], dtype=_U)
    return np.append(np.searchsorted(hashes, edges), len(hashes))


def squeeze(numbers: np.ndarray) -> bytes:
    """Whole numbers in as many byte planes as the largest takes, each compressed by itself."""
    wide = (int(numbers.max(initial=0)).bit_length() + 7) // 8
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T[:wide]
    out = [len(numbers).to_bytes(8, "little")]
    for plane in planes:
        packed = pa.compress(plane.tobytes(), "zstd", asbytes=True)
        out += [len(packed).to_bytes(8, "little"), packed]
    return b"".join(out)


def expand(data: bytes) -> np.ndarray:
    size, at, plane = int.from_bytes(data[:8], "little"), 8, 0
    numbers = np.zeros((size, 8), dtype=np.uint8)
    while at < len(data):
        end = at + 8 + int.from_bytes(data[at : at + 8], "little")
        numbers[:, plane] = np.frombuffer(pa.decompress(data[at + 8 : end], size, "zstd"), np.uint8)
        at, plane = end, plane + 1
    return numbers.view("<u8").ravel()


def pack(hashes: np.ndarray) -> bytes:
    """Sorted hashes as differences."""
    return squeeze(np.diff(hashes, prepend=_U(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data), dtype=_U)


def _count_block(key: tuple, rows: pa.Table, order: int, parts: int) -> pa.Table:
    hashes, counts = _distinct(rows, order)
    cuts = _cuts(hashes, parts)
    filled = np.flatnonzero(cuts[1:] > cuts[:-1])
    spans = [slice(cuts[i], cuts[i + 1]) for i in filled]
    return pa.table(
        {
            "part": pa.array(filled, pa.int32()),
            "block": pa.array([key[0].as_py()] * len(spans), pa.int32()),
            "hashes": pa.array([pack(hashes[s]) for s in spans], pa.binary()),
            "counts": pa.array([squeeze(counts[s]) for s in spans], pa.binary()),
        }
    )


def _total_part(rows: pa.Table) -> pa.Table:
    """A partition of the count table: totals of all its n-grams, sent back to every block."""
    counts = [expand(x).astype(np.int64) for x in rows["counts"].to_pylist()]
    hashes = np.concatenate([unpack(x) for x in rows["hashes"].to_pylist()])
    table, at = np.unique(hashes, return_inverse=True)
    totals = np.bincount(at, np.concatenate(counts), len(table)).astype(np.int64)
    elsewhere, sums, begin = [], [], 0
    for own in counts:
        total = totals[at[begin : begin + len(own)]]
        begin += len(own)
        more = total > own
        elsewhere.append(np.packbits(more).tobytes())
        sums.append(squeeze(total[more]))
    return pa.table(
        {
            "part": rows["part"],
            "block": rows["block"],
            "elsewhere": pa.array(elsewhere, pa.binary()),
            "totals": pa.array(sums, pa.binary()),
        }
    )


def _score_texts(
    texts: list[bytes], hashes: np.ndarray, totals: np.ndarray, order: int, all_words: int
) -> tuple[np.ndarray, np.ndarray]:
    """Words and log score of each text, by the totals of the sorted hashes."""
    grams = ngrams(texts, order)
    words = np.bincount(grams[0][0], minlength=len(texts))
    left_words = np.maximum(all_words - words, 1).astype(np.float64)

    def left(owner: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Counts in all other documents."""
        by = np.argsort(of, kind="stable")  # owners ascend, and do so within each n-gram
        of, owner = of[by], owner[by]
        new = np.ones(len(of), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        own = np.diff(first, append=len(of))
        counts = np.empty(len(of))
        counts[by] = np.repeat(totals[np.searchsorted(hashes, of[first])] - own, own)
        return counts

    owner, unigrams = grams[0]
    counts_left = left(owner, unigrams)
    score = np.where(counts_left > 0, counts_left, BACKOFF) / left_words[owner]
    # of the word at a place: where in its document it is, to find the n-grams that end there
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    shorter = counts_left
    for length in range(2, order + 1):
        ends = place >= length - 1
        gram_owner, gram = grams[length - 1]
        counts_left = left(gram_owner, gram)
        # the context of the n-gram that ends at a place is the shorter one that ends before it
        context = np.roll(shorter, 1)[ends] if length == 2 else shorter_at[np.flatnonzero(ends) - 1]
        seen = counts_left > 0
        longer = score[ends] * BACKOFF
        longer[seen] = counts_left[seen] / context[seen]
        score = score.copy()
        score[ends] = longer
        shorter_at = np.zeros(len(owner))
        shorter_at[ends] = counts_left
    return words, np.bincount(owner, np.log(score), len(texts))


def _score_block(
    rows: pa.Table, table: pa.Table, order: int, parts: int, all_words: int
) -> pa.Table:
    hashes, totals = _distinct(rows, order)
    cuts = _cuts(hashes, parts)
    for part, bits, sums in zip(
        *(table[c].to_pylist() for c in ("part", "elsewhere", "totals")), strict=True
    ):
        lo, hi = cuts[part], cuts[part + 1]
        more = np.unpackbits(np.frombuffer(bits, np.uint8), count=hi - lo).astype(bool)
        totals[lo:hi][more] = expand(sums)
    found = [_score_texts(texts, hashes, totals, order, all_words) for texts in _texts(rows)]
    words, total = (np.concatenate(x) for x in zip(*found, strict=True))
    filled = words > 0
    mean = np.where(filled, total / np.maximum(words, 1), 0)
    nothing = pa.array(~filled)
    null = lambda x: pa.compute.if_else(nothing, pa.scalar(None, pa.float64()), pa.array(x))
    return pa.table(
        {
            "doc_id": pa.chunked_array([docs["doc_id"] for docs in unpack_docs(rows)]),
            "n_words": pa.array(words, pa.int64()),
            "log_score": null(total),
            "mean_log_score": null(mean),
            "perplexity": null(np.exp(-mean)),
        }
    )


def block_of(blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score, perplexity) of every row."""
    prepare(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    size, all_words = rows.agg(F.sum(F.octet_length("text")), F.sum(size_of(F.col("text")))).first()
    blocks = parts = max(1, -(-(size or 0) // BLOCK_BYTES))
    rows = rows.select(block_of(blocks).alias("block"), "doc_id", "text")
    rows = rows.mapInArrow(pack_docs, "block int, docs binary")

    # plain functions without hints: Spark tells the kind of function by its arguments
    def count(key, rows):
        return _count_block(key, rows, order, parts)

    def add_up(key, rows):
        return _total_part(rows)

    def rate(key, rows, table):
        return _score_block(rows, table, order, parts, all_words or 0)

    totals = (
        rows.groupBy("block")
        .applyInArrow(count, "part int, block int, hashes binary, counts binary")
        .groupBy("part")
        .applyInArrow(add_up, "part int, block int, elsewhere binary, totals binary")
    )
    return (
        rows.groupBy("block")
        .cogroup(totals.groupBy("block"))
        .applyInArrow(
            rate,
            "doc_id long, n_words long, log_score double, mean_log_score double, perplexity double",
        )
    )
