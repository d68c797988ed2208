from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.contract import Contract

FLOATING = (T.DoubleType, T.FloatType)
ISO_DATE = r"^\d{4}-\d{2}-\d{2}\z"
FLOATING_NUMBER = (
    r"^[\x00-\x20]*[-+]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?[dDfF]?"
    r"|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][-+]?[0-9]+[dDfF]?"
    r"|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])[\x00-\x20]*$"
)
WHOLE_NUMBER = r"^[\x00-\x20\x7f]*[+-]?\d+[\x00-\x20\x7f]*\z"


def column(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def no_nan(c: Column) -> Column:
    """NaN is a missing value: an average or a median must never turn into NaN."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def is_missing(field: T.StructField, null_values: Sequence[str] = (), trim: bool = False) -> Column:
    """Null, empty text or NaN. Never null itself, so it can be negated."""
    c = column(field.name)
    if isinstance(field.dataType, T.StringType):
        text = F.trim(c) if trim else c
        return c.isNull() | text.isin("", *null_values)
    if isinstance(field.dataType, FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_valid(
    schema: T.StructType,
    critical: Iterable[str],
    null_values: Sequence[str] = (),
    trim: bool = False,
) -> Column:
    """All critical fields are present. Whitespace counts as present unless ``trim``."""
    valid = F.lit(True)
    for name in critical:
        valid = valid & ~is_missing(schema[name], null_values, trim)
    return valid


def date_of(c: Column, fmt: str) -> Column:
    """Text as a date; what does not match the format exactly becomes null."""
    if fmt == "yyyy-MM-dd":
        # The cast is many times faster than a formatter, but takes other notations as well.
        return F.when(c.rlike(ISO_DATE), c.try_cast("date"))
    return F.try_to_date(c, fmt)


def parsed(source: T.StructField, target: T.StructField, contract: Contract) -> Column:
    """The source column as the contract's type, NaN as it is; what does not parse becomes null."""
    c = column(source.name)
    if not isinstance(source.dataType, T.StringType):
        return c.try_cast(target.dataType)
    # A cast that fails costs far more than one that works, so text known to fail is kept out.
    c = F.when(~is_missing(source, contract.null_values), c)
    if isinstance(target.dataType, T.StringType):
        return c
    if isinstance(target.dataType, T.DateType):
        return date_of(c, contract.date_format)
    if isinstance(target.dataType, T.IntegralType):
        c = F.when(c.rlike(WHOLE_NUMBER), c)
    if isinstance(target.dataType, FLOATING):
        c = F.when(c.rlike(FLOATING_NUMBER), c)
    return c.try_cast(target.dataType)


def typed(source: T.StructField, target: T.StructField, contract: Contract) -> Column:
    """The source column as the contract's type; what does not parse becomes null."""
    return without_nan(parsed(source, target, contract), target).alias(target.name)


def without_nan(value: Column, target: T.StructField) -> Column:
    """A parsed value, null instead of NaN."""
    if isinstance(target.dataType, FLOATING):
        return F.nanvl(value, F.lit(None).cast(target.dataType))
    return value


def parse_failed(
    source: T.StructField, target: T.StructField, contract: Contract, value: Column | None = None
) -> Column:
    """A value is there but does not parse as the contract's type; ``value`` is what ``parsed`` gave, if
    that is a column already."""
    present = ~is_missing(source, contract.null_values)
    return present & (parsed(source, target, contract) if value is None else value).isNull()


def bucket(
    c: Column,
    edges: Sequence[float],
    labels: Sequence[str],
    closed: str = "left",
    lower: float | None = None,
    null_label: str | None = None,
) -> Column:
    """Label of the range a number falls in.

    ``closed="left"`` puts an edge into the range above it, ``"right"`` into the range below.
    Values before ``lower`` (and ``lower`` itself when right-closed) get no label; missing
    values get ``null_label``.
    """
    if closed not in ("left", "right"):
        raise ValueError(f"closed must be 'left' or 'right', not {closed!r}")
    if len(labels) != len(edges) + 1 or list(edges) != sorted(set(edges)):
        raise ValueError("need ascending edges and one label more than edges")
    x = no_nan(c)

    def before(edge: float) -> Column:
        return x < F.lit(float(edge)) if closed == "left" else x <= F.lit(float(edge))

    chain = F.when(x.isNull(), F.lit(null_label).cast("string"))
    if lower is not None:
        chain = chain.when(before(lower), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        chain = chain.when(before(edge), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))
