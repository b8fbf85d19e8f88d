"""Sources: parquet tables, text lines with a file-order ordinal, sinks."""

from stratum.sources.tables import TABLES, load, read_lines, write_result

__all__ = ["TABLES", "load", "read_lines", "write_result"]
