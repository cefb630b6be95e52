"""Sinks: any Spark format, save modes, partition overwrite, target naming,
staged publish of several catalog tables, versioned publish of several outputs."""

from callfacts.sinks.manifest import PublishConflict, current, expire, orphans, read_output, recover
from callfacts.sinks.publish import publish_staged
from callfacts.sinks.writer import (
    SAVE_MODES,
    WAREHOUSE_SETTINGS,
    SelfOverwriteError,
    connector_options,
    guard_self_overwrite,
    missing_settings,
    target_name,
    write_table,
)

__all__ = [
    "PublishConflict",
    "SAVE_MODES",
    "WAREHOUSE_SETTINGS",
    "SelfOverwriteError",
    "connector_options",
    "current",
    "expire",
    "guard_self_overwrite",
    "missing_settings",
    "orphans",
    "publish_staged",
    "read_output",
    "recover",
    "target_name",
    "write_table",
]
