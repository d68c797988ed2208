"""Column expressions; every one stays inside the JVM."""

from cohortlake.functions.columns import (
    bucket,
    is_missing,
    is_valid,
    no_nan,
    parse_failed,
    typed,
)

__all__ = ["bucket", "is_missing", "is_valid", "no_nan", "parse_failed", "typed"]
