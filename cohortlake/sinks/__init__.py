from cohortlake.sinks.tables import (
    write_partitioned,
    write_table,
    write_validated,
    write_versioned,
)

__all__ = ["write_partitioned", "write_table", "write_validated", "write_versioned"]
