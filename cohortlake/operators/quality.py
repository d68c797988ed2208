"""Counts and splits that tell how clean a record table is."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.contract import Contract, ContractError
from cohortlake.functions.columns import is_missing, is_valid, parse_failed, typed


def check_columns(df: DataFrame, contract: Contract) -> list[str]:
    """Raise if a contract column is absent; return the extra columns. Reads no data."""
    missing = sorted(set(contract.names) - set(df.columns))
    if missing:
        raise ContractError(f"missing columns: {', '.join(missing)}")
    return sorted(set(df.columns) - set(contract.names))


def apply_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns by name, in its order and types. Extra columns are left out."""
    check_columns(df, contract)
    return df.select(*[typed(df.schema[f.name], f, contract) for f in contract.schema])


def parse_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Per column the number of values that do not parse, from one pass over the input."""
    check_columns(df, contract)
    counts = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.count_if(parse_failed(df.schema[f.name], f, contract)).alias("failures"),
            )
            for f in contract.schema
        ]
    )
    return df.agg(counts.alias("counts")).select(F.inline("counts"))


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def split_valid(
    df: DataFrame, critical: Iterable[str], trim: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows by presence of the critical fields; two narrow filters."""
    valid = is_valid(df.schema, critical, trim=trim)
    return df.where(valid), df.where(~valid)


def quality_counts(df: DataFrame, critical: Iterable[str], trim: bool = False) -> DataFrame:
    """Total, valid and invalid rows from one pass."""
    valid = is_valid(df.schema, critical, trim=trim)
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(valid).alias("valid_records"),
        F.count_if(~valid).alias("invalid_records"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Per column the number and share of missing values, from one pass."""
    total = F.count(F.lit(1))
    counts = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.count_if(is_missing(f)).alias("missing_count"),
            )
            for f in df.schema
        ]
    )
    return (
        df.agg(total.alias("total"), counts.alias("counts"))
        .select("total", F.inline("counts"))
        .select(
            "column_name",
            "missing_count",
            F.when(F.col("total") > 0, F.col("missing_count") / F.col("total")).alias(
                "missing_share"
            ),
        )
    )


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.dropna(subset=[key])
