"""Toxicity of documents by a factorization machine over hashed terms.

A text's terms are its words, in lower case, and the words' first bytes, each hashed to one of
2^20 buckets; a term is there or not, however long the text. The machine's score is a bias, a weight
per term, and for every pair of terms the inner product of their factors, so that two terms can
mean together what neither means alone. All pairs of a text are summed at once, from the sum and
the sum of squares of its factors.

It is fitted on at most ``SAMPLE`` labelled documents, the first by hash; of those only rows whose
crc32 of the doc_id as text isn't divisible by 5. Terms whose share differs by class more than chance
explains, ``TERMS`` of them at most, get weights: the rest would only add noise to long texts. So do the terms
of pairs whose joint share differs by class more than chance explains, although neither term's own does: an
interaction is learned where its terms are as frequent in one class as in the other. Pairs are looked for
among the ``PAIRED`` terms whose presence tells most, those nearest to half of the sampled documents. Every
document is scored, from its whole text.

Cases: a null or empty text has no terms and gets the bias. Labels that are null or not 0 or 1 are
left out; a document with both labels counts as toxic. Without labelled rows the score is 0; with
one class only, all texts get that class's smoothed share. Rows without a doc_id can't be labelled
and are not held out; they are scored. Repeated rows are scored each. Other columns are not used.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import prepare, staged

SAMPLE = 20_000
TERMS = 4096
BITS = 20
PREFIX = 4
#: Standard deviations from equal shares that a term must show.
SIGNIFICANT = 4.5
#: The same for a pair of terms; there are more of them to be found by chance.
PAIR_SIGNIFICANT = 7.0
#: Terms among which pairs are looked for.
PAIRED = 1024
#: Documents that a term must be in.
LEAST = 5
FOLDS = 5


@dataclass
class Machine:
    """Bias, weights and factors of the chosen buckets."""

    buckets: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def table(self) -> np.ndarray:
        """Row of each bucket, or the number of rows for buckets that weren't chosen."""
        out = np.full(1 << BITS, len(self.buckets), dtype=np.int32)
        out[self.buckets] = np.arange(len(self.buckets))
        return out

    def logits(self, owner: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Of n texts, from the distinct terms' rows and the texts they are in, sorted by text."""
        score = np.full(n, self.bias)
        if len(owner):
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            v = self.factors[term]
            pairs = np.add.reduceat(v, first) ** 2 - np.add.reduceat(v * v, first)
            score[owner[first]] += np.add.reduceat(self.weights[term], first) + pairs.sum(axis=1) / 2
        return score


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def terms(
    texts: list[bytes], known: np.ndarray | None = None, rows: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct terms, sorted. With ``known``, a table of rows per bucket:
    (text, row) of those whose row is below ``rows``."""
    owner, words, heads = common.word_hashes(texts, common.BREAKS, PREFIX)
    owner = np.concatenate([owner, owner])
    bucket = (np.concatenate([words, heads]) >> np.uint64(64 - BITS)).astype(np.int64)
    if known is not None:
        bucket = known[bucket].astype(np.int64)
        chosen = bucket < rows
        owner, bucket = owner[chosen], bucket[chosen]
    pairs = np.unique(owner << BITS | bucket)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def fit(
    owner: np.ndarray,
    term: np.ndarray,
    y: np.ndarray,
    count: int,
    factors: int = 8,
    epochs: int = 12,
    rate: float = 0.1,
    ridge: float = 1e-4,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss by AdaGrad over small batches; ``owner`` sorted, ``term`` below ``count``."""
    rng = np.random.default_rng(3)
    w, v = np.zeros(count), rng.normal(0, 0.05, (count, factors))
    share = np.clip(y.mean(), 1 / (len(y) + 2), 1 - 1 / (len(y) + 2))
    bias = float(np.log(share / (1 - share)))
    past_w, past_v, past_b = np.full(count, 1e-6), np.full((count, factors), 1e-6), 1e-6
    starts = np.searchsorted(owner, np.arange(len(y) + 1))
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for begin in range(0, len(y), 128):
            rows = order[begin : begin + 128]
            spans = starts[rows + 1] - starts[rows]
            at = np.repeat(starts[rows] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())
            t, of = term[at], np.repeat(np.arange(len(rows)), spans)
            sums = np.zeros((len(rows), factors))
            np.add.at(sums, of, v[t])
            squares = np.bincount(of, (v[t] ** 2).sum(axis=1), len(rows))
            score = bias + np.bincount(of, w[t], len(rows)) + ((sums**2).sum(axis=1) - squares) / 2
            error = sigmoid(score) - y[rows]
            step = float(error.sum())
            past_b += step * step
            bias -= rate * step / np.sqrt(past_b)
            g_w = np.bincount(t, error[of], count) + ridge * w
            past_w += g_w**2
            w -= rate * g_w / np.sqrt(past_w)
            g_v = ridge * v
            np.add.at(g_v, t, error[of][:, None] * (sums[of] - v[t]))
            past_v += g_v**2
            v -= rate * g_v / np.sqrt(past_v)
    return bias, w, v


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def first_by_hash(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``keys``, which are distinct. Only the share of the hashes that
    surely has so many is sorted, so what one task gets doesn't grow with the rows."""
    key = F.xxhash64(*keys)
    share = (1.2 * n + 1000) / max(rows.count(), 1)
    if share < 1:
        rows = rows.where(key < F.lit(int(share * 2**64) - 2**63))
    return rows.orderBy(key, *keys).limit(n)


def labelled_sample(labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic) of the rows to learn from; at most ``sample`` of them, the first by hash."""
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    return first_by_hash(known, sample, "doc_id")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = TERMS) -> Machine:
    """Fit a machine. The sample's labels are broadcast (``sample`` rows of two numbers); its terms
    are counted by class in Spark; the driver gets the chosen terms of the sampled rows."""
    spark = docs.sparkSession
    prepare(spark)
    chosen = spark.createDataFrame(labelled_sample(labels, sample).collect(), "doc_id long, toxic int")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            toxic, at = part.column("toxic").to_pylist(), 0
            for texts in common.groups(common.as_bytes(part.column("text"))):
                owner, bucket = terms(texts)
                cuts = np.searchsorted(owner, np.arange(1, len(texts)))
                yield common.batch(
                    ["doc_id", "toxic", "terms"],
                    part.column("doc_id").slice(at, len(texts)),
                    pa.array(toxic[at : at + len(texts)], pa.int32()),
                    pa.array(np.split(bucket.astype(np.int32), cuts), pa.list_(pa.int32())),
                )
                at += len(texts)

    found = staged(
        rows.join(F.broadcast(chosen), "doc_id").mapInArrow(
            run, "doc_id long, toxic int, terms array<int>"
        )
    )
    if found.count() > sample:
        # repeated ids bring more rows than were sampled; of these, equal ones count once
        distinct = found.dropDuplicates(["doc_id", "terms"])
        found = staged(first_by_hash(distinct, sample, "doc_id", "terms"))
    n, positive = found.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    none = np.empty(0, dtype=np.int64)
    if not n:
        return Machine(none, -500.0, np.zeros(1), np.zeros((1, 1)))
    share = positive / n
    p = (F.col("bad") + F.col("good")) / F.lit(float(n))
    spread = F.sqrt(p * (1 - p) * (1 / max(positive, 1) + 1 / max(n - positive, 1)))
    z = (F.col("bad") / max(positive, 1) - F.col("good") / max(n - positive, 1)) / spread
    counts = staged(
        found.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
        .where((p < 1) & (F.col("bad") + F.col("good") >= LEAST))
        .withColumn("z", z)
    )
    alone = counts.where(F.abs("z") >= SIGNIFICANT).orderBy(F.desc(F.abs("z")), "term").limit(most)
    buckets = np.array(sorted(r.term for r in alone.select("term").collect()), dtype=np.int64)
    if 0 < share < 1:
        half = F.abs(F.col("bad") + F.col("good") - n / 2)
        frequent = counts.where(F.abs("z") < SIGNIFICANT).orderBy(half, "term").limit(PAIRED)
        wanted = np.array(sorted(r.term for r in frequent.select("term").collect()), dtype=np.int64)
        buckets = np.union1d(buckets, wanted[paired(found, wanted)])
    if not len(buckets) or share in (0, 1):
        odds = np.log((positive + 1) / (n - positive + 1))
        return Machine(none, float(odds), np.zeros(1), np.zeros((1, 1)))
    rows = _terms_of(found, buckets)
    y = np.array([r.toxic for r in rows], dtype=np.float64)
    owner = np.repeat(np.arange(len(rows)), [len(r.terms) for r in rows])
    flat = np.array([t for r in rows for t in r.terms], dtype=np.int64)
    bias, weights, factors = fit(owner, np.searchsorted(buckets, flat), y, len(buckets))
    return Machine(buckets, bias, weights, factors)


def _terms_of(found: DataFrame, buckets: np.ndarray) -> list:
    """(toxic, terms) of the sampled rows in a fixed order, with these terms only, sorted."""
    picked = F.array_sort(F.array_intersect("terms", F.lit(buckets.astype(np.int32))))
    rows = found.select("doc_id", "toxic", picked.alias("terms"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "terms")
    return rows.select("toxic", "terms").collect()


def paired(found: DataFrame, buckets: np.ndarray) -> np.ndarray:
    """Which of the buckets are in a pair whose joint share differs by class more than chance explains."""
    if len(buckets) < 2:
        return np.zeros(len(buckets), dtype=bool)
    rows = _terms_of(found, buckets)
    here = np.zeros((len(rows), len(buckets)), dtype=np.float32)
    for row, at in zip(here, rows, strict=True):
        row[np.searchsorted(buckets, at.terms)] = 1
    toxic = np.array([r.toxic for r in rows], dtype=bool)
    bad, good = (some.T @ some for some in (here[toxic], here[~toxic]))
    p = (bad + good) / len(rows)
    spread = np.sqrt(p * (1 - p) * (1 / toxic.sum() + 1 / (~toxic).sum()))
    differs = np.abs(bad / toxic.sum() - good / (~toxic).sum()) >= PAIR_SIGNIFICANT * np.maximum(spread, 1e-12)
    np.fill_diagonal(differs, False)
    return (differs & (bad + good >= LEAST)).any(axis=1)


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = machine.table()
        for part in batches:
            scores = [np.empty(0)]
            for texts in common.groups(common.as_bytes(part.column("text"))):
                owner, term = terms(texts, known, len(machine.buckets))
                scores.append(sigmoid(machine.logits(owner, term, len(texts))))
            ids = part.column("doc_id").to_pylist()
            out = [i is not None and zlib.crc32(str(i).encode()) % FOLDS == 0 for i in ids]
            p = np.concatenate(scores)
            yield common.batch(
                ["doc_id", "held_out", "score", "predicted"],
                part.column("doc_id"),
                pa.array(out, pa.bool_()),
                p,
                (p >= 0.5).astype(np.int32),
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, machine: Machine) -> DataFrame:
    """The documents that the machine doesn't predict to be toxic, with all their columns."""
    prepare(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = machine.table()
        for part in batches:
            clean = [np.empty(0, dtype=bool)]
            for texts in common.groups(common.as_bytes(part.column(names.index("text")))):
                owner, term = terms(texts, known, len(machine.buckets))
                clean.append(sigmoid(machine.logits(owner, term, len(texts))) < 0.5)
            yield part.filter(pa.array(np.concatenate(clean)))

    return docs.mapInArrow(run, docs.schema)
