"""When micro-batches run."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter


def triggered(writer: DataStreamWriter, available_now: bool, every: str | None) -> DataStreamWriter:
    """Take what is there and stop, or run ``every`` so often, or as fast as data comes."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer
