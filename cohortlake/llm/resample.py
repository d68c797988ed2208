"""Choose documents that are like a target, by importance resampling.

Every text is a bag of words and pairs of neighbouring words, hashed to buckets. How much likelier a
bucket is in the target's texts than in all documents is its gain; the gains are one array, which every task
has, and a document's weight is their mean over its features. Its score adds noise that depends on its id
only, so that the highest scores are a draw without replacement in proportion to the weights.

The scores are ranked by a distributed radix sort from the lowest digit on. The key is score, doc_id and
number of features; its bits, as many as the values at hand need, are cut into digits. A pass counts
each task's rows by digit; the counts, summed up over digits and tasks, say where each task's
rows of a digit begin, and a row's place is that beginning plus how many of its digit came before it in its
task. Rows are then dealt to tasks by their places, in ranges of equal length, and the next pass goes on. Each
digit keeps the order that the lower ones made. No task holds more than its range, whatever the
keys, and only counts (digits x tasks) are summed up across tasks.

Cases: a null or empty text has no features and weight 0. A null doc_id counts as an empty one in the
noise and comes last among equal scores. Rows equal in doc_id and score rank by their number of features; rows
that are equal in all of it get neighbouring ranks. Without target texts every gain rests on the
documents alone. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import operator
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm import common
from cohortlake.llm.common import prepare, staged

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Bits of a digit at most, and rows of a task's range.
DIGIT = 12
RANGE = 1 << 20

# Digits, a-z and all beyond ASCII, in UTF-8 and lower case; and the rest of a word in any case.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_REST = re.compile(rb"[0-9A-Za-z\x80-\xff]*+")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, ASCII letters in lower case, from pieces of bounded size that end where
    no word goes on."""
    at = 0
    while at < len(text):
        end = at + common.PIECE
        if end < len(text):
            end = _REST.match(text, end).end()
        yield _WORD.findall(text[at:end].lower())
        at = end


def features_of(text: bytes) -> Iterator[np.ndarray]:
    """Check values of all words, and of all pairs of neighbours with a blank between."""
    last: list[int] = []
    for words in words_of(text):
        ones = list(map(zlib.crc32, words))
        behind = words if last else words[1:]
        spaced = map(operator.add, [b" "] * len(behind), behind)
        twos = list(map(zlib.crc32, spaced, chain(last, ones)))
        yield np.array(ones, dtype=np.uint32)
        yield np.array(twos, dtype=np.uint32)
        last = ones[-1:] or last


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket: one number per bucket comes here."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for part in batches:
            for text in common.as_bytes(part.column("text")):
                for values in features_of(text):
                    total += np.bincount(values % buckets, minlength=buckets)
        filled = np.flatnonzero(total)
        yield common.batch(["bucket", "n"], filled, total[filled])

    counted = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths, floored."""
    own, theirs = float(documents.sum() + len(documents)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * own / ((s + 1.0) * theirs)))
            for s, t in zip(documents.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths, floored."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    drawn = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = []
            ids = part.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, common.as_bytes(part.column("text")), strict=True):
                n = total = 0
                for values in features_of(text):
                    n += len(values)
                    total += int(gain[values % len(gain)].sum())
                weight = total // n if n else 0
                # n words have n - 1 neighbours
                rows.append((doc_id, (n + 1) // 2, n, weight, weight + noise(doc_id, seed)))
            names = ["doc_id", "n_words", "n_features", "weight", "score"]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield common.batch(names, *(pa.array(c, pa.int64()) for c in columns))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(
        score, "doc_id long, n_words long, n_features long, weight long, score long"
    )


# --- radix sort ---------------------------------------------------------------------------------


def digits(parts: list[tuple[str, int]], most: int = DIGIT) -> list[Column]:
    """The digits of a key, lowest first, as expressions. The key is made of columns with numbers from
    0 on, given with their number of bits, lowest first. Digits have equal numbers of bits and
    may reach from one column into the next."""
    bits = sum(n for _, n in parts)
    width = -(-bits // max(-(-bits // most), 1))
    out, low = [], 0
    while low < bits:
        digit, at = F.lit(0).cast("long"), 0
        for name, n in parts:
            # the bits of this column that lie between low and low + width
            begin, end = max(low, at), min(low + width, at + n)
            if begin < end:
                cut = F.shiftrightunsigned(F.col(name), begin - at).bitwiseAND((1 << (end - begin)) - 1)
                digit = digit.bitwiseOR(F.shiftleft(cut, begin - low))
            at += n
        out.append(digit.cast("int"))
        low += width
    return out


def _places(width: int):
    """Adds the task's number, and how many rows of the same digit came before in the task."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), np.zeros(1 << width, dtype=np.int64)
        for part in batches:
            digit = part.column("digit").to_numpy()
            # a stable counting sort of the batch
            order = np.argsort(digit, kind="stable")
            counts = np.bincount(digit, minlength=len(seen))
            begins = np.cumsum(counts) - counts
            local = np.empty(len(digit), dtype=np.int64)
            local[order] = np.arange(len(digit)) - begins[digit[order]]
            local += seen[digit]
            seen += counts
            more = [pa.array(np.full(len(digit), task, dtype=np.int32)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, *more], names=[*part.schema.names, "task", "local"]
            )

    return place


def radix_sorted(rows: DataFrame, parts: list[tuple[str, int]], n: int) -> DataFrame:
    """Adds ``pos``, the place of each of the ``n`` rows in the order of their key, from 0."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    length = max(1, min(RANGE, -(-n // tasks)))
    rows = rows.withColumn("pos", F.lit(0).cast("long"))
    passes = digits(parts, DIGIT)
    for number, digit in enumerate(passes or [F.lit(0)]):
        if number:
            # the ranges of the places made by the pass before
            home = F.floor(F.col("pos") / length).cast("int")
            rows = rows.repartitionById(-(-n // length), home).sortWithinPartitions("pos")
        rows = rows.withColumn("digit", digit)
        fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
        kept = staged(rows.mapInArrow(_places(DIGIT), f"{fields}, task int, local long"))
        counts = kept.groupBy("digit", "task").agg(F.count("*").alias("rows"))
        before = Window.partitionBy("digit").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
        # one row per digit: no more than 2 ** DIGIT
        lower = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        whole = counts.groupBy("digit").agg(F.sum("rows").alias("rows"))
        whole = whole.select("digit", F.coalesce(F.sum("rows").over(lower), F.lit(0)).alias("lower"))
        begins = counts.join(whole, "digit").select(
            "digit",
            "task",
            (F.col("lower") + F.coalesce(F.sum("rows").over(before), F.lit(0))).alias("begin"),
        )
        rows = (
            kept.join(begins, ["digit", "task"])
            .withColumn("pos", F.col("begin") + F.col("local"))
            .drop("digit", "task", "local", "begin")
        )
    return rows


def ranked(rows: DataFrame) -> DataFrame:
    """Rows of ``scored`` with ``pos``: highest score first, then smaller doc_id (null last), then fewer
    features. An id is split in its upper and lower 32 bits, each counted from 0."""
    upper, lower = F.shiftright("doc_id", 32), F.col("doc_id").bitwiseAND(0xFFFFFFFF)
    n, ids, top, bottom, first, last, low, features = rows.agg(
        F.count("*"), F.count("doc_id"), F.max("score"), F.min("score"),
        F.min(upper), F.max(upper), F.max(lower), F.max("n_features"),
    ).first()
    if not n:
        return rows.withColumn("pos", F.lit(None).cast("long"))
    key = {
        "k_features": (F.col("n_features"), features),
        "k_lower": (F.coalesce(lower, F.lit(0)), low or 0),
        "k_upper": (F.coalesce(upper - F.lit(first or 0), F.lit(0)), (last or 0) - (first or 0)),
        "k_null": (F.col("doc_id").isNull(), int(ids < n)),
        "k_score": (F.lit(top) - F.col("score"), top - bottom),
    }
    rows = rows.withColumns({name: value.cast("long") for name, (value, _) in key.items()})
    found = radix_sorted(rows, [(name, most.bit_length()) for name, (_, most) in key.items()], n)
    return found.drop(*key)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_features, weight, score and rank; of the rows with ``min_words``
    words, ``percent`` of a hundred are drawn, by score, and have a rank from 1."""
    prepare(docs.sparkSession)
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = staged(scored(docs, gain, seed))
    fit = F.col("n_words") >= min_words
    n = rows.where(fit).count()
    order = ranked(rows.where(fit))
    rank = F.when(F.col("pos") < percent * n // 100, F.col("pos") + 1)
    names = ["doc_id", "n_features", "weight", "score"]
    return order.select(*names, rank.alias("rank")).unionByName(
        rows.where(~fit).select(*names, F.lit(None).cast("long").alias("rank"))
    )


def _bags_sql(table: str, name: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
  SELECT row_number() OVER () AS r, {name}, coalesce(len(w), 0) AS n_words,
    list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS features
  FROM (SELECT {name}, regexp_extract_all({common.lower_sql("text")}, '{pattern}') AS w FROM {table})"""


#: The same with a sort, in another engine's words.
SQL = f"""
WITH {common.CRC_TABLE_SQL},
bags AS ({_bags_sql("documents", "doc_id")}),
own AS (SELECT r, unnest(features) AS feature FROM bags),
theirs AS (SELECT unnest(features) AS feature FROM ({_bags_sql("benchmark", "item_id")})),
hashed AS (
  SELECT feature, {common.crc_sql("feature")} % 10000 AS bucket
  FROM (SELECT feature FROM own UNION SELECT feature FROM theirs), bits),
counts AS (
  SELECT buckets.bucket, coalesce(s, 0) AS s, coalesce(t, 0) AS t
  FROM range(10000) AS buckets(bucket)
  LEFT JOIN (SELECT bucket, count(*) AS s FROM own JOIN hashed USING (feature) GROUP BY bucket) USING (bucket)
  LEFT JOIN (SELECT bucket, count(*) AS t FROM theirs JOIN hashed USING (feature) GROUP BY bucket) USING (bucket)),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counts),
weighed AS (
  SELECT r, count(*) AS n_features, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
  FROM own JOIN hashed USING (feature) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT r, doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256(
      '7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM bags LEFT JOIN weighed USING (r)),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
    count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""
