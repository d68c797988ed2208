"""Global median and median imputation without gathering the column in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from cohortlake.functions.columns import column, no_nan
from cohortlake.scratch import staged, temporary

# Buckets per doubling of the value, then buckets of a linear split: few, so that map tasks combine
# the values of a narrow range as well.
LOG_BUCKETS = 1024
LINEAR_BUCKETS = 4096
# A bucket is kept aside for the passes to come if it holds no more than this share of the rows.
ASIDE = 0.25


def magnitude(v: Column) -> Column:
    """A whole number that never falls as ``v`` grows: sign and logarithm, in small steps."""
    # The smallest double is 2^-1074: the shift keeps the steps of positive values positive.
    step = F.floor(F.least(F.log2(F.abs(v)), F.lit(1025.0)) * LOG_BUCKETS) + 1075 * LOG_BUCKETS
    return F.when(v == 0, F.lit(0)).when(v > 0, step).otherwise(-step).cast("long")


def linear(v: Column, lo: float, hi: float) -> Column:
    """A whole number that never falls as ``v`` grows: equal steps from ``lo`` to ``hi``, one
    bucket below and one above."""
    # halves, where the range is wider than the largest double
    scale = 1.0 if math.isfinite(hi - lo) else 0.5
    offset = (v * F.lit(scale) - F.lit(lo * scale)) / F.lit(hi * scale - lo * scale)
    return (
        F.when(v < F.lit(lo), F.lit(-1))
        .when(v > F.lit(hi), F.lit(LINEAR_BUCKETS + 1))
        .when(v == F.lit(hi), F.lit(LINEAR_BUCKETS))
        .otherwise(F.floor(offset * LINEAR_BUCKETS))
        .cast("long")
    )


def bucket_totals(
    rows: DataFrame, bucket: Column, more: Mapping[str, Column] | None = None
) -> DataFrame:
    """(n, first, last) of the values ``v`` in every bucket, and ``more`` aggregates of its rows. Rows
    without a value are a bucket of their own. Each map task sends one row per bucket."""
    return rows.groupBy(bucket.alias("bucket")).agg(
        F.count("v").alias("n"),
        F.min("v").alias("first"),
        F.max("v").alias("last"),
        *[c.alias(name) for name, c in (more or {}).items()],
    )


def _holders(totals: DataFrame, ranks: tuple[int, int] | None = None) -> list[Row]:
    """(first, last, n, below, total) of the one or two buckets that hold the values of the two given
    ranks, by default the two in the middle: ``below`` values come before the bucket, of ``total``.

    ``bucket`` must not fall as ``v`` grows. Only the bucket totals come together in one task.
    """
    totals = totals.where("n > 0").select(
        "first",
        "last",
        "n",
        F.sum("n").over(Window.orderBy("bucket")).alias("upto"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    below = F.col("upto") - F.col("n")
    if ranks is None:
        wanted = [F.expr("(total + 1) div 2"), F.expr("total div 2 + 1")]
    else:
        wanted = [F.lit(rank) for rank in ranks]
    holds = [(below < rank) & (rank <= F.col("upto")) for rank in wanted]
    found = totals.where(holds[0] | holds[1]).orderBy("upto")
    return found.select("first", "last", "n", below.alias("below"), "total").collect()


def select_middle(
    values: DataFrame, totals: DataFrame, share: float, folder: str | None = None
) -> tuple[float, float] | None:
    """The two middle values of the non-null doubles ``v``, or two values of a bucket that holds
    both and no more than ``share`` of all rows; None if there are no values.

    ``totals`` are those of ``values`` by ``magnitude``: 1024 buckets per doubling of the value
    (2 * 2100 * 1024 if the data spans every double there is). Further passes split the bucket with the
    middle into 4096 linear steps, and the bucket found there, and so on. Once a bucket holds at most
    ``ASIDE`` of the rows, they are staged in ``folder``, and later passes read only them: counts are
    exact, so the middle can't lie elsewhere. That is the second pass over all values, and the last one, unless
    most of them lie within a thousandth of each other.

    The first and the last value of a bucket never fall into the same one again, so it ends;
    doubles of a bucket are 2^-53 apart at the closest, so no more than six linear passes follow. It
    ends as soon as the bucket holds a single distinct value, or the two middle values are the
    last of one bucket and the first of the next: with few distinct values, or one that fills a third
    of the table, after the first pass or two. A map task shuffles a row per bucket that it meets, at
    most; that bounds the shuffle by tasks times buckets.
    """
    held = _holders(totals)
    if not held:
        return None
    total = size = held[0]["total"]
    ranks = ((total + 1) // 2, total // 2 + 1)
    while len(held) == 1 and held[0]["first"] < held[0]["last"] and held[0]["n"] > share * total:
        (bucket,) = held
        lo, hi = bucket["first"], bucket["last"]
        values = values.where(F.col("v").between(lo, hi))
        ranks = tuple(rank - bucket["below"] for rank in ranks)
        if bucket["n"] <= ASIDE * size:
            values, size = staged(values, folder), bucket["n"]
        held = _holders(bucket_totals(values, linear(F.col("v"), lo, hi)), ranks)
    return held[0]["last"] if len(held) > 1 else held[0]["first"], held[-1]["first"]


def exact_median(
    values: DataFrame, totals: DataFrame | None = None, folder: str | None = None
) -> float | None:
    """The median of the non-null doubles ``v``, interpolated between the two middle values; None if
    there are none. ``values`` is read again by a pass or two, so it should be a written table or a
    columnar source."""
    if totals is None:
        totals = bucket_totals(values, magnitude(F.col("v")))
    found = select_middle(values, totals, 0, folder)
    if found is None:
        return None
    lower, upper = found
    if lower == upper or not math.isfinite(lower):
        return lower
    if not math.isfinite(upper):
        return upper
    gap = upper - lower
    return lower + gap / 2 if math.isfinite(gap) else lower / 2 + upper / 2


def near_median(
    values: DataFrame, error: float, totals: DataFrame | None = None, folder: str | None = None
) -> float | None:
    """One of the non-null doubles ``v`` whose rank is off the middle by no more than ``error`` of the
    rows; None if there are none. The bound is certain, as it rests on counts, and reruns agree.

    One pass is enough unless more than ``error`` of the rows lie within a thousandth of the median.
    """
    if not 0 < error < 1:
        raise ValueError("error must lie between 0 and 1")
    if totals is None:
        totals = bucket_totals(values, magnitude(F.col("v")))
    found = select_middle(values, totals, error, folder)
    return found[0] if found else None


def median(
    df: DataFrame,
    col: str,
    method: str = "exact",
    error: float = 0.0025,
    reread: bool = False,
    work_path: str | None = None,
) -> float | None:
    """The median of a numeric column; null and NaN are left out, None if nothing is left.

    ``exact`` interpolates between the two middle values, ``approx`` returns a value whose rank is off by
    no more than ``error`` of the rows; both are reproducible. ``exact`` reads ``df`` once to stage the
    column under ``work_path``, or else under ``spark.checkpoint.dir``, until the median is found; with
    ``reread`` it stages only what lies near the middle and reads ``df`` once or twice more, which is
    better for a plain columnar table. ``approx`` mostly ends after the one pass and always does the latter.
    """
    values = df.select(no_nan(column(col)).alias("v")).where(F.col("v").isNotNull())
    if method not in ("exact", "approx"):
        raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")
    with temporary(df.sparkSession, work_path) as folder:
        if method == "approx":
            return near_median(values, error, folder=folder)
        return exact_median(values if reread else staged(values, folder), folder=folder)


def fill_measure(df: DataFrame, col: str, fill: float | None, digits: int | None) -> DataFrame:
    """Missing values of ``col`` replaced by ``fill``, rounded to ``digits`` unless None. Without
    a fill the column stays null where it is missing."""
    value = F.lit(fill).cast("double")
    if digits is not None:
        value = F.round(value, digits)
    return df.withColumn(col, F.coalesce(no_nan(column(col)), value))


def impute_median(
    df: DataFrame,
    col: str,
    method: str = "exact",
    digits: int | None = 2,
    error: float = 0.0025,
    reread: bool = False,
    work_path: str | None = None,
) -> DataFrame:
    """Missing values of ``col`` replaced by its median, rounded to ``digits`` unless None.

    The median is found first and enters the frame as a number, so the frame itself is one
    narrow pass.
    """
    return fill_measure(df, col, median(df, col, method, error, reread, work_path), digits)
