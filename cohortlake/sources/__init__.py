from cohortlake.sources.records import (
    RAGGED,
    files_by_header,
    ragged_rows,
    raw_records,
    read_frames,
    read_raw,
    read_records,
    read_text_columns,
)
from cohortlake.sources.tables import (
    file_manifest,
    footer_ranges,
    output_inventory,
    read_partitioned,
)

__all__ = [
    "RAGGED",
    "file_manifest",
    "files_by_header",
    "footer_ranges",
    "output_inventory",
    "ragged_rows",
    "raw_records",
    "read_frames",
    "read_partitioned",
    "read_raw",
    "read_records",
    "read_text_columns",
]
