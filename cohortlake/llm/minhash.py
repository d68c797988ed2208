"""Near-duplicate texts by HyperMinHash sketches.

A text's set of word shingles is hashed once per shingle. The hash picks one of ``registers``
buckets, and the bucket keeps its smallest hash as a leading-zero count and mantissa bits (16 bits
in all). For banding, an empty register takes the value of the first filled one in a random order that
belongs to the register and is the same for all texts (densified one-permutation hashing), and each value
carries the register that it comes from: so a band of a short text is as telling as one of a long text.
Four registers make a band; texts that share a band meet. What meets is first held
against the sketches (matching registers less the collisions to be expected), and what may reach
the threshold is confirmed on the full sets.

At a similarity of 0.75, two large sets miss each other in all 40 bands with a probability of
2.5e-7; sets of a dozen shingles do about as seldom, as their bands draw from the same few shingles, each by its own
order. Sets of up to ``FEW`` shingles have too few of them to tell bands apart, so they meet on shingles: on the
smallest hashes, as many as a pair that links must share one of. Sets that are large enough to link with
one of more than ``FEW`` have bands, those small enough to link with one of ``FEW`` shingles meet on these as well.
A band that one shingle fills alone gives no key.
The estimate drops a pair only if it lies five standard deviations under the threshold.

Pairs aren't listed. Texts with the same set are one entry from the start. Estimates gather entries
into families: first every entry is held against the smallest one of its bucket; then, in the
buckets that still hold several families, entries of different families against each other, in
cells of bounded size that give only which families meet. Links are confirmed within families,
again in cells of bounded size, on the full sets of the texts; a cell skips pairs that its links
have joined and gives a forest of links. That takes two steps. First a family's texts are dealt to
blocks, the family's first text to all of them, and each block is compared within itself: a large
group of near copies is one class after that, for work that grows with its size. Then, in families
of several blocks that still hold several classes, the texts outside the largest class are compared with each other
and with that class. No pair that could join two classes is left out.

Cases: a null or empty text, or one without words, has no shingles and links with nothing. Rows
without a doc_id are returned with component_id null and kept true. Rows that share a doc_id are
one document. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import mix, prepare, staged, temporary

SHINGLE = 5
REGISTERS = 160
BAND = 4
MANTISSA = 10
PERCENT = 75
#: Sets of up to so many shingles have no bands.
FEW = 10
#: Entries of a block: sketches of a bucket, texts of a family and bytes of these. A cell holds two blocks.
SKETCHES = 1024
TEXTS, BYTES = 256, 4 << 20
#: Copies of a text beyond which it is hot, in rows and as a share of all rows.
COPIES, HOT = 1000, 10_000

_U = np.uint64
_FACTORS = common._stream(23, SHINGLE) | _U(1)


def shingle_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its distinct shingles as sorted 64-bit hashes. A text of fewer words than a
    shingle has all its words as one."""
    owner, words, _ = common.word_hashes(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs = max(len(words) - SHINGLE + 1, 0)
    with np.errstate(over="ignore"):
        total = np.zeros(runs, dtype=_U)
        for k in range(SHINGLE):
            total += words[k : k + runs] * _FACTORS[k]
        total = mix(total)
        sets = []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            if hi - lo >= SHINGLE:
                sets.append(np.unique(total[lo : hi - SHINGLE + 1]))
            elif hi > lo:
                few = words[lo:hi] * _FACTORS[: hi - lo]
                sets.append(mix(np.array([few.sum() + _U(hi - lo)], dtype=_U)))
            else:
                sets.append(np.empty(0, dtype=_U))
    return sets


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a sorted set: per bucket 1 + leading zeros and the mantissa; 0 if empty."""
    out = np.zeros(REGISTERS, dtype=np.uint16)
    if not len(hashes):
        return out
    with np.errstate(over="ignore"):
        bucket = ((hashes >> _U(32)) * _U(REGISTERS)) >> _U(32)
        rest = hashes * _U(REGISTERS) | _U(1)
    first = np.flatnonzero(np.diff(bucket, prepend=_U(REGISTERS)))
    rest = rest[first]
    zeros = np.minimum(64 - np.frexp(rest.astype(np.float64))[1], 62).clip(0).astype(_U)
    mantissa = (rest << zeros << _U(1)) >> _U(64 - MANTISSA)
    out[bucket[first].astype(np.int64)] = ((zeros + _U(1)) << _U(MANTISSA)) | mantissa
    return out


def _orders() -> np.ndarray:
    """For every register the order in which it looks at all registers, itself first."""
    keys = common._stream(41, REGISTERS * REGISTERS).reshape(REGISTERS, REGISTERS).copy()
    np.fill_diagonal(keys, 0)
    return np.argsort(keys, axis=1, kind="stable")


_ORDERS = _orders()


def densified(rows: np.ndarray) -> np.ndarray:
    """Rows of registers, each with at least one filled: value and origin of every register, where
    empty ones take the first filled one of their order."""
    out = rows.astype(np.uint32)
    out |= np.where(out > 0, np.arange(REGISTERS, dtype=np.uint32) << 16, 0).astype(np.uint32)
    own = out.copy()
    row, register = np.nonzero(out == 0)
    step = 1
    while len(row):
        value = own[row, _ORDERS[register, step]]
        out[row, register] = value
        row, register = row[value == 0], register[value == 0]
        step += 1
    return out


def similarity(one: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray):
    """Estimated Jaccard similarities of rows of registers, and how many registers they rest on.

    Matches that come from two different smallest hashes are taken off: per register that both
    fill, about 0.17 * 4nm / (n + m)^2 / 2^mantissa of them (HyperMinHash, its approximation)."""
    used = (one > 0) | (other > 0)
    both = ((one > 0) & (other > 0)).sum(axis=-1)
    same = ((one == other) & used).sum(axis=-1)
    ratio = n.astype(np.float64) * m / (n.astype(np.float64) + m) ** 2
    chance = both * 0.169919487 * 4 * ratio / 2.0**MANTISSA
    filled = used.sum(axis=-1)
    return np.maximum(same - chance, 0) / np.maximum(filled, 1), filled


def may_link(one: np.ndarray, other: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """False only where the sizes rule a link out or the estimate lies five deviations too low."""
    limit = PERCENT / 100
    estimate, filled = similarity(one, other, n, m)
    margin = 5 * np.sqrt(limit * (1 - limit) / np.maximum(filled, 1)) + 1e-9
    fits = 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)
    return fits & (estimate >= limit - margin)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        sizes, digests, sketches, few = [], [], [], []
        for texts in common.groups(common.as_bytes(part.column("text"))):
            for hashes in shingle_hashes(texts):
                sizes.append(len(hashes))
                filled = len(hashes) > 0
                raw = hashes.tobytes()
                digests.append(
                    hashlib.blake2b(raw, digest_size=16).digest() if filled else None
                )
                sketches.append(registers(hashes).tobytes() if filled else None)
                # two sets that link share at least PERCENT of either: one of these, if sorted alike
                n = len(hashes)
                most = n - -(-PERCENT * n // 100) + 1 if 0 < PERCENT * n <= 100 * FEW else 0
                few.append(hashes[:most].view(np.int64))
        yield common.batch(
            ["doc_id", "n_shingles", "digest", "sketch", "few"],
            part.column("doc_id"),
            pa.array(sizes, pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(sketches, pa.binary()),
            pa.array(few, pa.list_(pa.int64())),
        )


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, sketch, hashes that a small set meets others on) of
    every row; no shingles: null, null, none."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sketch, "doc_id long, n_shingles long, digest binary, sketch binary, few array<long>"
    )


def _rows_of(column: pa.Array) -> np.ndarray:
    """Sketches of a column as rows of registers."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype=np.uint16).reshape(-1, REGISTERS)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = REGISTERS // BAND
    tag = common._stream(31, bands)
    for part in batches:
        ids = part.column("doc_id").to_numpy(zero_copy_only=False)
        sizes = part.column("n_shingles").to_numpy(zero_copy_only=False)
        for begin in range(0, len(ids), 2048):
            some = slice(begin, begin + 2048)
            own, large = ids[some], sizes[some] > FEW
            if large.any():
                values = densified(_rows_of(part.column("sketch").slice(begin, 2048))[large])
                band = values.reshape(-1, bands, BAND)
                packed = np.ascontiguousarray(values).view(_U).reshape(-1, bands, BAND // 2)
                with np.errstate(over="ignore"):
                    keys = tag + np.zeros(packed.shape[:2], dtype=_U)
                    for k in range(BAND // 2):
                        keys = mix(keys ^ packed[:, :, k]) + tag
                several = (band != band[:, :, :1]).any(axis=2)
                of = np.broadcast_to(own[large][:, None], several.shape)
                yield common.batch(["key", "doc_id"], keys[several].view(np.int64), of[several])
            few = part.column("few").slice(begin, 2048)
            hashes = few.flatten().to_numpy().view(_U)
            if len(hashes):
                of = np.repeat(own, few.value_lengths().to_numpy())
                yield common.batch(["key", "doc_id"], mix(hashes ^ tag[0]).view(np.int64), of)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        if part.num_rows:
            number = lambda name: part.column(name).to_numpy(zero_copy_only=False)  # noqa: E731, B023
            fits = may_link(
                _rows_of(part.column("sketch_a")),
                _rows_of(part.column("sketch_b")),
                number("n_a"),
                number("n_b"),
            )
            yield part.select(["a", "b"]).filter(pa.array(fits))


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up

    def join(self, a: int, b: int) -> bool:
        up = self.up
        while up[a] != a:
            a = up[a] = up[up[a]]
        while up[b] != b:
            b = up[b] = up[up[b]]
        up[max(a, b)] = min(a, b)
        return a != b


def _sides(cell: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    """The rows of the cell's first and second block, and whether they are one block."""
    block, i, j = (cell[c].to_numpy() for c in ("block", "i", "j"))
    return np.flatnonzero(block == i), np.flatnonzero(block == j), i[0] == j[0]


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which families a bucket's entries join by the estimates, from rows of (key, i, j)."""
    for cell in common.runs(batches, ["key", "i", "j"]):
        families, group = np.unique(cell["component"].to_numpy(), return_inverse=True)
        if len(families) < 2:
            continue
        left, right, same = _sides(cell)
        rows, sizes = _rows_of(cell["sketch"]), cell["n_shingles"].to_numpy()
        forest = Forest(len(families))
        for at, a in enumerate(left):
            others = right[at + 1 :] if same else right
            roots = forest.roots()[group]
            others = others[roots[others] != roots[a]]
            if len(others):
                fits = may_link(rows[a], rows[others], np.full(len(others), sizes[a]), sizes[others])
                for other in np.unique(group[others[fits]]):
                    forest.join(group[a], other)
        ends = forest.roots()
        moved = ends != np.arange(len(ends))
        yield common.batch(["a", "b"], families[ends[moved]], families[moved])


def links(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sorted sets of hashes are similar enough."""
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    if not len(small) or 100 * len(small) < PERCENT * len(large):
        return False
    at = np.searchsorted(large, small)
    shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * shared >= PERCENT * (len(small) + len(large) - shared)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A forest of links within each cell of a family, from rows of (family, i, j). Texts of the
    same ``component`` are joined already."""
    for cell in common.runs(batches, ["family", "i", "j"]):
        ids = cell["doc_id"].to_numpy()
        texts = common.as_bytes(cell["text"].combine_chunks())
        sets = [s for few in common.groups(texts) for s in shingle_hashes(few)]
        rows, sizes = np.stack([registers(s) for s in sets]), np.array([len(s) for s in sets])
        left, right, same = _sides(cell)
        forest, found = Forest(len(ids)), []
        _, known, of = np.unique(
            cell["component"].to_numpy(), return_index=True, return_inverse=True
        )
        forest.up = known[of]
        for at, a in enumerate(left):
            others = right[at + 1 :] if same else right
            roots = forest.roots()
            others = others[roots[others] != roots[a]]
            if not len(others):
                continue
            fits = may_link(rows[a], rows[others], np.full(len(others), sizes[a]), sizes[others])
            for b in others[fits]:
                if forest.roots()[a] != forest.roots()[b] and links(sets[a], sets[b]):
                    forest.join(a, b)
                    found.append((ids[a], ids[b]))
        if found:
            pairs = np.array(found, dtype=np.int64)
            yield common.batch(["a", "b"], pairs[:, 0], pairs[:, 1])


def _grid(rows: DataFrame) -> DataFrame:
    """Deal the rows of a key to its ``blocks`` by doc_id, and each block to the cells of all its pairs
    of blocks: adds block, i and j."""
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("blocks", "other")
    )


def _blocks_with_first(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """(family, doc_id, component, text, block, i, j): every member in one block of its family, and the
    first one in all of them; a block is a cell. ``home`` is the block that is a row's own."""
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.when(F.col("doc_id") == F.col("family"), every).otherwise(F.array(block))
    return (
        members.join(sizes, "family")
        .select(
            "family", "doc_id", F.col("doc_id").alias("component"), "blocks", "text",
            block.alias("own"), F.explode(own).alias("block"),
        )
        .withColumns({"i": F.col("block"), "j": F.col("block"), "home": F.col("block") == F.col("own")})
        .drop("own")
    )


def _outside_the_largest(state: DataFrame, texts: DataFrame) -> DataFrame:
    """Cells, as of ``_blocks_with_first``, of the families that were more than one block (``state`` has
    their number) and hold several components: all pairs of blocks but those within the largest
    component, whose blocks come first."""
    size = F.struct("n", (-F.col("component")).alias("first"))
    several = (
        state.groupBy("family", "blocks", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("family", "blocks")
        .agg(
            F.max_by("component", size).alias("largest"),
            F.max("n").alias("most"),
            F.sum("n").alias("all"),
            F.count("*").alias("kinds"),
        )
        .where("kinds > 1")
        .withColumn("each", F.col("all") / F.col("blocks"))
        .select(
            "family",
            "largest",
            F.ceil(F.col("most") / F.col("each")).cast("int").alias("inner"),
            F.ceil((F.col("all") - F.col("most")) / F.col("each")).cast("int").alias("outer"),
        )
    )
    inside, key = F.col("component") == F.col("largest"), F.xxhash64("doc_id")
    inner, outer = F.col("inner"), F.col("outer")
    block = F.when(inside, F.pmod(key, inner)).otherwise(inner + F.pmod(key, outer)).cast("int")
    others = F.sequence(F.when(inside, inner).otherwise(F.lit(0)), inner + outer - 1)
    return (
        state.join(several, "family")
        .select("family", "doc_id", "component", block.alias("block"), others.alias("others"))
        .join(texts, "doc_id")
        .withColumn("other", F.explode("others"))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("other", "others")
    )


def _entries(filled: DataFrame) -> DataFrame:
    """(doc_id, entry): the smallest doc_id with the same set. Sets with many copies are joined by
    broadcast, so that no task gets all copies of one: there are fewer than ``HOT`` of these."""
    classes = staged(filled.groupBy("digest").agg(F.min("doc_id").alias("entry"), F.count("*").alias("n")))
    rows = classes.agg(F.sum("n")).first()[0] or 0
    many = F.col("n") > max(COPIES, rows // HOT)
    hot = F.broadcast(classes.where(many).select("digest", "entry"))
    rest = classes.where(~many).select("digest", "entry")
    copies = filled.select("doc_id", "digest")
    cold = copies.join(hot, "digest", "left_anti").join(rest, "digest")
    return cold.unionByName(copies.join(hot, "digest")).select("doc_id", "entry")


def _blocks_of(n: int, size: int | None = None):
    """An aggregate: how many blocks of ``n`` rows, and of ``size`` bytes in all, a group is."""
    count = F.count("*") / n
    return F.ceil(count if size is None else F.greatest(count, F.sum("bytes") / size)).cast("int").alias("blocks")


def _met_families(met: DataFrame, entries: DataFrame, family: DataFrame) -> DataFrame:
    """(a, b): families that the estimates join in buckets that still hold several. An entry's sketch
    is joined once, whatever the number of its buckets."""
    left = (
        met.select("key", "doc_id")
        .join(family.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    several = (
        left.groupBy("key")
        .agg(
            _blocks_of(SKETCHES),
            F.count("*").alias("n"),
            F.min("component").alias("x"),
            F.max("component").alias("y"),
        )
        .where("n > 2 AND x < y")
        .select("key", "blocks")
    )
    buckets = F.collect_list(F.struct("key", "blocks")).alias("buckets")
    rows = (
        left.join(several, "key")
        .groupBy("doc_id", "component")
        .agg(buckets)
        .join(entries.select("doc_id", "n_shingles", "sketch"), "doc_id")
        .select("doc_id", "component", "n_shingles", "sketch", F.inline("buckets"))
    )
    return common.dealt(_grid(rows), "key", "i", "j").mapInArrow(_families, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id that links lead to), kept."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketched = staged(sketches(docs))
    filled = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    copies = staged(_entries(filled))
    with temporary(docs.sparkSession) as folder:
        found = _classes(docs, filled, copies, folder)
    by_doc = (
        copies.groupBy("doc_id")
        .agg(F.min("entry").alias("entry"))
        .join(found.select(F.col("node").alias("entry"), "component"), "entry", "left")
        .select("doc_id", F.coalesce("component", "entry").alias("component"))
    )
    component = F.coalesce("component", "doc_id")
    return (
        sketched.select("doc_id", "n_shingles")
        .join(by_doc, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def _classes(docs: DataFrame, filled: DataFrame, copies: DataFrame, folder: str) -> DataFrame:
    """(node, component) of the entries that links join, with staged tables in ``folder``."""
    entries = staged(
        filled.join(
            copies.where("doc_id = entry").select("doc_id").distinct(), "doc_id", "left_semi"
        ).dropDuplicates(["digest", "doc_id"]),
        folder,
    )
    rows = entries.select("doc_id", "n_shingles", "sketch", "few").mapInArrow(
        _bands, "key long, doc_id long"
    )
    shared = (
        rows.groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last")
        .drop("last")
    )
    met = staged(rows.join(shared, "key").distinct(), folder)

    side = lambda s: entries.select(
        F.col("doc_id").alias(s),
        F.col("n_shingles").alias(f"n_{s}"),
        F.col("sketch").alias(f"sketch_{s}"),
    )
    stars = met.where("doc_id <> first").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    stars = stars.distinct().join(side("a"), "a").join(side("b"), "b")
    near = staged(stars.mapInArrow(_estimated, "a long, b long").distinct(), folder)
    family = common.components(near)
    more = staged(_met_families(met, entries, family).distinct(), folder)
    if not more.isEmpty():
        family = common.components(near.union(more))
    members = family.select(F.col("node").alias("doc_id"), F.col("component").alias("family"))

    def confirm(cells: DataFrame) -> DataFrame:
        rows = common.dealt(cells, "family", "i", "j")
        return staged(rows.mapInArrow(_confirmed, "a long, b long").distinct(), folder)

    texts = members.join(docs, "doc_id").withColumn("bytes", F.octet_length("text"))
    sizes = texts.groupBy("family").agg(_blocks_of(TEXTS, BYTES))
    cells = staged(_blocks_with_first(texts.drop("bytes"), sizes), folder)
    confirmed = linked = confirm(cells.drop("blocks", "home"))
    several = cells.where("blocks > 1 AND home")
    if not several.isEmpty():
        classes = common.components(linked).withColumnRenamed("node", "doc_id")
        state = staged(
            several.select("doc_id", "family", "blocks")
            .distinct()
            .join(classes, "doc_id", "left")
            .withColumn("component", F.coalesce("component", "doc_id")),
            folder,
        )
        outside = _outside_the_largest(state, several.select("doc_id", "text"))
        confirmed = linked.union(confirm(outside))

    # Rows that share a doc_id are one document, also if their texts belong to different classes.
    twice = (
        copies.groupBy("doc_id")
        .agg(F.min("entry").alias("a"), F.max("entry").alias("b"), F.count("*").alias("n"))
        .where("n > 1 AND a < b")
    )
    ties = copies.join(twice, "doc_id").select("a", F.col("entry").alias("b")).where("a <> b")
    return common.components(confirmed.union(ties))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows that ``near_duplicates`` keeps, with all their columns. Of rows that share a kept
    doc_id all stay; rows without a doc_id stay."""
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL")
    name = common.free_name(docs, "kept")
    kept = kept.select(F.col("doc_id").alias(name)).distinct()
    identified = docs.join(kept, F.col("doc_id").cast("long") == F.col(name), "left_semi")
    return identified.unionByName(docs.where("doc_id IS NULL"))
