"""Derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.columns import bucket, column, date_of


def bucketize(
    df: DataFrame,
    col: str,
    edges: Sequence[float],
    labels: Sequence[str],
    output: str,
    closed: str = "left",
    lower: float | None = None,
    null_label: str | None = None,
) -> DataFrame:
    """Add the range label of a numeric column; options as in ``functions.bucket``."""
    return df.withColumn(output, bucket(column(col), edges, labels, closed, lower, null_label))


def stamp(
    df: DataFrame, at: datetime | str | None = None, output: str = "processed_at"
) -> DataFrame:
    """Add the load time: ``at``, or the start of the query that evaluates the frame."""
    when = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return df.withColumn(output, when)


def fill_missing(df: DataFrame, values: Mapping[str, float | int | str | bool]) -> DataFrame:
    """Replace null, and NaN in floating columns, by a constant per column."""
    return df.fillna(dict(values))


def parse_date(df: DataFrame, col: str, output: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Add a date parsed from text; what does not parse becomes null."""
    return df.withColumn(output, date_of(column(col), fmt))
