"""Sources: declared-schema readers and partition selection."""

from callfacts.sources.readers import (
    LEDGER,
    TIMESTAMP_NTZ_FORMAT,
    EmptyInputError,
    changed_dates,
    input_files,
    partition_paths,
    read_call_lines,
    read_calls_csv,
    read_chat_lines,
    read_chats_json,
    read_table,
    read_text,
    require_files,
)

__all__ = [
    "LEDGER",
    "TIMESTAMP_NTZ_FORMAT",
    "EmptyInputError",
    "changed_dates",
    "input_files",
    "partition_paths",
    "read_call_lines",
    "read_calls_csv",
    "read_chat_lines",
    "read_chats_json",
    "read_table",
    "read_text",
    "require_files",
]
