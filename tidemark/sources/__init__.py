"""Feeds, the change log, and the state table."""

from .feeds import landed_feed, read_feed, require_messages, stream_feed, write_feed
from .files import shared_folder
from .log import append_log, append_parquet, check_append, check_stream, noted_schema, read_if_present, read_log, stream_log
from .history import read_history, write_history
from .partitioned_state import PartitionedState
from .segments import append_segment, expire_segments, read_segments, stream_segments
from .state_table import StateTable

__all__ = [
    "PartitionedState",
    "StateTable",
    "append_log",
    "append_parquet",
    "append_segment",
    "check_append",
    "check_stream",
    "expire_segments",
    "landed_feed",
    "noted_schema",
    "read_feed",
    "read_history",
    "read_if_present",
    "read_log",
    "read_segments",
    "require_messages",
    "shared_folder",
    "stream_feed",
    "stream_log",
    "stream_segments",
    "write_feed",
    "write_history",
]
