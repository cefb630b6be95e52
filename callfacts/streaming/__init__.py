"""Structured Streaming form of the job: new date folders in, enriched rows out."""

from callfacts.streaming.incremental import KINDS, fact_stream, run_available_now, start

__all__ = ["KINDS", "fact_stream", "run_available_now", "start"]
