"""The declared shape of a record table: names, types, critical fields, key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


class ContractError(ValueError):
    """The input does not carry the columns the contract asks for."""


class EmptyInputError(ValueError):
    """The input holds no record, so nothing may be overwritten with it."""


@dataclass(frozen=True)
class Contract:
    """Names and types of a record table.

    ``critical`` fields must be present for a row to be valid. Text equal to one of
    ``null_values`` counts as missing, besides null and the empty string.
    """

    schema: T.StructType
    critical: tuple[str, ...]
    key: str
    date_format: str = "yyyy-MM-dd"
    null_values: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        unknown = {self.key, *self.critical} - set(self.names)
        if unknown:
            raise ContractError(f"critical or key fields not in the schema: {sorted(unknown)}")

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()


# Column names and types of a study record, its critical fields, and the
# bucket edges and labels of dosage and weight.
RECORDS = Contract(
    schema=T.StructType(
        [
            T.StructField("patient_id", T.StringType()),
            T.StructField("trial_id", T.StringType()),
            T.StructField("drug", T.StringType()),
            T.StructField("site", T.StringType()),
            T.StructField("dosage_mg", T.DoubleType()),
            T.StructField("age", T.IntegerType()),
            T.StructField("weight_kg", T.DoubleType()),
            T.StructField("enrollment_date", T.DateType()),
            T.StructField("status", T.StringType()),
            T.StructField("outcome_score", T.DoubleType()),
        ]
    ),
    critical=("patient_id", "drug", "site"),
    key="patient_id",
)
DOSAGE_EDGES = (100, 300)
DOSAGE_LABELS = ("low", "medium", "high")
WEIGHT_EDGES = (60, 85)
WEIGHT_LABELS = ("underweight", "normal", "overweight")
