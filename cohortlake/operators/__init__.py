"""DataFrame to DataFrame operators, usable with ``df.transform``."""

from cohortlake.operators.features import bucketize, fill_missing, parse_date, stamp
from cohortlake.operators.imputation import impute_median, median
from cohortlake.operators.quality import (
    apply_contract,
    check_columns,
    drop_null_key,
    null_profile,
    parse_failures,
    quality_counts,
    record_count,
    split_valid,
)
from cohortlake.operators.stats import cohort_stats, ordered, preview, record_measures

__all__ = [
    "apply_contract",
    "bucketize",
    "check_columns",
    "cohort_stats",
    "drop_null_key",
    "fill_missing",
    "impute_median",
    "median",
    "null_profile",
    "ordered",
    "parse_date",
    "parse_failures",
    "preview",
    "quality_counts",
    "record_count",
    "record_measures",
    "split_valid",
    "stamp",
]
