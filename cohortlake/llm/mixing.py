"""Mix sources to target weights.

Every document gets a hash-random key. A range sort by (source, key) deals even a source that has
most of the rows to many tasks; each task adds up the sizes it meets in order, and the totals of
(task, source), a small table, give what lies before each task. The prefix sum of a document
within its source decides: the source's budget is taken in whole passes over the source, and the
last pass ends at the document that brings the sum nearest to the budget. Documents stay whole. Rows
with the same source, doc_id and size are sorted and summed as one unit; where the last pass ends within a
unit, it takes as many of its rows as bring the sum nearest to the budget. Which ones is drawn
once and written down, so that no task needs to number a unit that holds a third of all rows.

Targets: the sources in code point order, null last, have ``weights`` in turn and share ``share``
times all words; none gets more than ``epochs`` times its own size, and what lies above that is
shared again by weight until no source is above its limit.

Cases: a null or empty text has size 0 and takes 0 words. A null source is a source of its own.
Rows that share a doc_id are documents of their own. An empty table gives an empty result. Other columns
are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.llm.common import prepare, staged

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
SEED = "mix-1"
#: Rows of a unit beyond which it is hot, in rows and as a share of all rows; parts that one is numbered in.
ROWS, HOT = 1000, 10_000
PARTS = 4096


def size_of(text: Column) -> Column:
    """Number of words."""
    words = F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and the sum of ``amount`` over the rows of the same source that came
    before in this task; the rows are sorted by source."""
    task = TaskContext.get().partitionId()
    source, total, begun = None, 0, False
    for part in batches:
        if not part.num_rows:
            continue
        names = part.column("source").to_pylist()
        amounts = part.column("amount").to_numpy(zero_copy_only=False)
        before = np.empty(len(amounts), dtype=np.int64)
        changes = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
        for lo, hi in zip([0, *changes], [*changes, len(names)], strict=True):
            if not begun or names[lo] != source:
                source, total, begun = names[lo], 0, True
            sums = np.cumsum(amounts[lo:hi])
            before[lo:hi] = sums - amounts[lo:hi] + total
            total += int(sums[-1])
        columns = [*part.columns, pa.array(before), pa.array(np.full(len(names), task, np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "before", "task"])


def prefix_sums(rows: DataFrame, by: Sequence[Column | str], amount: str) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over all rows of the same ``source`` that come
    earlier in the order ``by``, which must begin with the source, nulls last."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("amount", F.col(amount).cast("long"))
    fields = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    kept = staged(
        rows.repartitionByRange(parts, *by)
        .sortWithinPartitions(*by)
        .mapInArrow(_running, f"{fields}, before long, task int")
    )
    totals = kept.groupBy("source", "task").agg(F.sum("amount").alias("total"))
    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("s"),
        F.col("task").alias("t"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"),
    )
    return (
        kept.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("task") == F.col("t")))
        .withColumn("before", F.col("before") + F.col("offset"))
        .drop("s", "t", "offset", "task", "amount")
    )


def targets(
    sizes: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: float = EPOCHS,
) -> DataFrame:
    """(source, source_size, target) from one row per source.

    The rank that deals out the weights is a prefix sum over the sorted sources. A source is at
    its limit if ``epochs * source_size <= level * weight``; each pass finds the level from the
    sources that aren't, until no further source is: one row comes to the driver per pass."""
    ordered = prefix_sums(
        sizes.withColumn("one", F.lit(1)).withColumnRenamed("source", "name")
        .withColumn("source", F.lit("all")),
        ["source", F.col("name").asc_nulls_last()],
        "one",
    )
    deal = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)),
        (F.col("before") % len(weights) + 1).cast("int"),
    )
    limit = (F.col("source_size") * float(epochs)).alias("limit")
    rows = staged(
        ordered.select(F.col("name").alias("source"), "source_size", deal.alias("weight"), limit)
    )
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, full = -1.0, -1
    while True:
        at_limit = F.col("limit") <= F.lit(level) * F.col("weight")
        now, above, weight = rows.agg(
            F.count(F.when(at_limit, 1)),
            F.coalesce(F.sum(F.when(at_limit, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~at_limit, F.col("weight"))), F.lit(0.0)),
        ).first()
        if now == full or not weight:
            break
        level, full = (share * total - above) / weight, now
    at_limit = F.col("limit") <= F.lit(level) * F.col("weight")
    target = F.when(at_limit, F.col("limit")).otherwise(F.lit(level) * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _units(
    rows: DataFrame, weights: Sequence[float], share: float, epochs: int, seed: str
) -> DataFrame:
    """One row per unit of (source, doc_id, size): its n rows, source_size, target, copies (passes that take
    all of them) and extra (how many of them one more pass takes)."""
    units = staged(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")))
    units = units.withColumn("words", F.col("size") * F.col("n"))
    sizes = units.groupBy("source").agg(F.sum("words").alias("source_size"))
    goals = staged(targets(sizes, weights, share, epochs))
    key = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    order = [F.col("source").asc_nulls_last(), "key", "doc_id", "size"]
    dealt = prefix_sums(units.withColumn("key", key), order, "words")
    goal = goals.withColumnRenamed("source", "s")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    passes = F.coalesce(passes, F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    last = F.floor((rest - F.col("before")) / F.expr("nullif(size, 0)") + F.lit(0.5))
    last = F.least(F.greatest(last, F.lit(0)), F.col("n"))
    some = F.col("size") > 0
    return dealt.join(goal, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "doc_id", "size", "n", "source_size", "target",
        F.when(some, passes).otherwise(0).cast("int").alias("copies"),
        F.when(some & (passes < epochs), last).otherwise(0).cast("long").alias("extra"),
    )


def _assigned(rows: DataFrame, units: DataFrame) -> DataFrame:
    """Adds source_size, target and copies to rows that have source, doc_id and size.

    Units of many rows, fewer than ``HOT`` of them, are joined by broadcast, so that no task gets all rows of
    one. Where a unit has an extra copy for some rows only, at most once per source, its rows are dealt to
    ``PARTS`` parts at random, which is staged; all rows of the first parts get one, and the
    rows of the part where they run out are numbered."""
    units = units.select(
        F.col("source").alias("u_source"), F.col("doc_id").alias("u_doc"), F.col("size").alias("u_size"),
        "n", "source_size", "target", "copies", "extra",
    )
    total = units.agg(F.sum("n")).first()[0] or 0
    many = F.col("n") > max(ROWS, total // HOT)
    same = (
        F.col("source").eqNullSafe(F.col("u_source"))
        & F.col("doc_id").eqNullSafe(F.col("u_doc"))
        & (F.col("size") == F.col("u_size"))
    )

    def joined(units: DataFrame) -> DataFrame:
        if units.where(many).isEmpty():
            return rows.join(units, same)
        hot = F.broadcast(units.where(many))
        rest = rows.join(hot, same, "left_anti").join(units.where(~many), same)
        return rows.join(hot, same).unionByName(rest)

    known = joined(units)
    names = [*rows.columns, "source_size", "target", "copies"]
    all_or_none = F.col("copies") + F.when(F.col("extra") > 0, 1).otherwise(0)
    whole = known.where("extra = 0 OR extra = n").withColumn("copies", all_or_none).select(names)

    split = units.where("extra > 0 AND extra < n")
    if split.isEmpty():
        return whole
    split = split.withColumn("unit", F.xxhash64("u_source", "u_doc", "u_size"))
    parted = staged(joined(split).withColumn("part", F.floor(F.rand(5) * PARTS).cast("int")))
    earlier = Window.partitionBy("unit").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parted.groupBy("unit", "part").agg(F.count("*").alias("here"))
    before = F.coalesce(F.sum("here").over(earlier), F.lit(0))
    parts = parts.select(F.col("unit").alias("p_unit"), F.col("part").alias("p_part"), "here", before.alias("ahead"))
    placed = parted.join(parts, (F.col("unit") == F.col("p_unit")) & (F.col("part") == F.col("p_part")))
    clear = (F.col("ahead") + F.col("here") <= F.col("extra")) | (F.col("ahead") >= F.col("extra"))
    number = F.row_number().over(Window.partitionBy("unit", "part").orderBy(F.lit(0)))
    one = F.when(F.col("ahead") < F.col("extra"), 1).otherwise(0)
    sure = placed.where(clear).withColumn("copies", F.col("copies") + one).select(names)
    numbered = placed.where(~clear).withColumn("number", F.col("ahead") + number)
    one = F.when(F.col("number") <= F.col("extra"), 1).otherwise(0)
    last = staged(numbered.withColumn("copies", F.col("copies") + one).select(names))
    return whole.unionByName(sure).unionByName(last)


def _keys(docs: DataFrame) -> list[Column]:
    return [
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"),
        size_of(F.col("text")).alias("size"),
    ]


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """Per row: source, doc_id, size, source_size, target, copies (how often the mix takes it) and taken (the
    words it takes of it)."""
    prepare(docs.sparkSession)
    rows = staged(docs.select(*_keys(docs)))
    units = staged(_units(rows, weights, share, epochs, seed))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return _assigned(rows, units).select("*", taken)


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """The documents as the mix takes them: each row as often as its copies say.

    The text of a document without words counts no words, so the mix leaves it out."""
    prepare(docs.sparkSession)
    keys = docs.select(*_keys(docs))
    units = staged(_units(keys, weights, share, epochs, seed))
    rows = docs.select(F.struct("*").alias("row"), *_keys(docs))
    wanted = units.where("copies > 0 OR extra > 0")
    taken = _assigned(rows, wanted).where("copies > 0")
    again = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return taken.select("row", again.alias("copy")).select("row.*")


#: The words, targets and prefix sums in another engine's words; rows as ``op10``'s.
SQL = r"""
WITH RECURSIVE sized AS (
  SELECT source, doc_id, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT)
    AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM sized GROUP BY source),
weighted AS (
  SELECT *, CASE turn WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS most FROM sources),
levels AS (
  SELECT 0 AS step, CAST(-1 AS DOUBLE) AS level, CAST(-1 AS BIGINT) AS n
  UNION ALL
  SELECT step + 1,
    ((SELECT 1.5::DOUBLE * sum(source_size) FROM weighted)
      - (SELECT coalesce(sum(CASE WHEN most <= level * weight THEN most END), 0.0) FROM weighted))
    / (SELECT sum(CASE WHEN most <= level * weight THEN NULL ELSE weight END) FROM weighted),
    (SELECT count(CASE WHEN most <= level * weight THEN 1 END) FROM weighted)
  FROM levels
  WHERE (SELECT count(CASE WHEN most <= level * weight THEN 1 END) FROM weighted) <> n
    AND (SELECT sum(CASE WHEN most <= level * weight THEN NULL ELSE weight END) FROM weighted) > 0),
final AS (SELECT level FROM levels ORDER BY step DESC LIMIT 1),
goals AS (
  SELECT source, source_size,
         CASE WHEN most <= level * weight THEN most ELSE level * weight END AS target
  FROM weighted, final),
units AS (SELECT source, doc_id, size, count(*) AS n FROM sized GROUP BY ALL),
dealt AS (
  SELECT u.*, g.source_size, g.target,
    CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS passes,
    coalesce(sum(size * n) OVER (PARTITION BY u.source
      ORDER BY md5('mix-1-' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM units u JOIN goals g ON u.source IS NOT DISTINCT FROM g.source),
counted AS (
  SELECT *, CASE WHEN size > 0 AND passes < 2 THEN
    least(greatest(floor((target - passes * source_size - before) / size + 0.5::DOUBLE), 0), n)
    ELSE 0 END AS extra FROM dealt)
SELECT doc_id, size, source_size, target,
  CAST(size * (passes + CASE WHEN number <= extra THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM counted, generate_series(1, n) AS rows(number)
"""
