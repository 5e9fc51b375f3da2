from millrace.sinks.lake import (
    EmptyWriteError,
    WriteReceipt,
    overwrite_table,
    write_curated,
    write_jsonl,
    write_raw,
)

__all__ = ["EmptyWriteError", "WriteReceipt", "overwrite_table", "write_curated", "write_jsonl", "write_raw"]
