"""Scoped cache of a shared input.

The dimension feeds two joins and two writes; persisting it makes it one scan.
The scope always releases it, also when a write fails.  A lost executor only
costs a recompute of its cached blocks from the lineage (no local checkpoint).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
