from rushline.sinks.keyed import KeyedTable
from rushline.sinks.runlog import RunLog
from rushline.sinks.writers import append_table, scratch_uri, write_csv, write_json, write_table

__all__ = [
    "KeyedTable", "RunLog", "append_table", "scratch_uri", "write_csv", "write_json", "write_table",
]
