from tidemark.sinks.mart import MartSink, distributed, export_files, export_mart, mart_columns, ordered, sink_options
from tidemark.sinks.tables import (
    append,
    append_with_watermark,
    balanced,
    create_or_replace,
    full_load,
    full_load_table,
)

__all__ = [
    "MartSink",
    "append",
    "append_with_watermark",
    "balanced",
    "create_or_replace",
    "distributed",
    "export_files",
    "export_mart",
    "full_load",
    "full_load_table",
    "mart_columns",
    "ordered",
    "sink_options",
]
