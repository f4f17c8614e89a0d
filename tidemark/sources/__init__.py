"""Sources and sinks."""

from tidemark.sources.tables import read_table  # noqa: F401
