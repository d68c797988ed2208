"""Options that reading and writing a format must agree on."""

from __future__ import annotations

# A header line, quotes doubled inside quoted fields, blanks at the ends of a field
# kept, and times to the microsecond.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def options_of(format: str) -> dict[str, str]:
    return dict(CSV_OPTIONS) if format == "csv" else {}
