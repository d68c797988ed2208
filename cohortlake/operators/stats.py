"""Grouped statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlake.functions.columns import column, no_nan

# Grouping keys, names of the measures, and the status that is counted.
COHORT_KEYS = ("trial_id", "drug")
ADVERSE_STATUS = "adverse_event"
NULL_KEYS = ("keep", "drop")


def record_measures() -> dict[str, Column]:
    """The six measures of a cohort of study records."""
    return {
        "patient_count": F.count("patient_id"),
        "avg_dosage_mg": F.avg(no_nan(F.col("dosage_mg"))),
        "avg_outcome_score": F.avg(no_nan(F.col("outcome_score"))),
        "avg_age": F.avg("age"),
        "site_count": F.count_distinct("site"),
        "adverse_events": F.count_if(F.col("status") == ADVERSE_STATUS),
    }


def cohort_stats(
    df: DataFrame,
    keys: Sequence[str] = COHORT_KEYS,
    measures: Mapping[str, Column] | None = None,
    null_keys: str = "keep",
) -> DataFrame:
    """All measures per group in one aggregation.

    A distinct count makes Spark group by (keys, counted column) first and by keys after that,
    both times counting in the map tasks before the shuffle, so one group holding a third of
    the rows is spread over many tasks.
    """
    if null_keys not in NULL_KEYS:
        raise ValueError(f"null_keys must be 'keep' or 'drop', not {null_keys!r}")
    if null_keys == "drop":
        df = df.dropna(subset=list(keys))
    chosen = record_measures() if measures is None else measures
    return df.groupBy(*[column(k) for k in keys]).agg(
        *[measure.alias(name) for name, measure in chosen.items()]
    )


def ordered(df: DataFrame, keys: Sequence[str] = COHORT_KEYS) -> DataFrame:
    """Sorted by the keys, nulls first."""
    return df.orderBy(*[column(k).asc_nulls_first() for k in keys])


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in the given order; each task keeps only its own first ``n``."""
    return df.orderBy(*order_by).limit(n)
