"""Change-data capture on Spark: feeds of row changes in, current state of the tables out."""

from .functions import infer_schema, key_columns
from .operators import (
    current_state,
    decode,
    decode_key,
    fold_changes,
    latest_per_key,
    live_rows,
    merge_state,
    message_status,
    row_images,
    state_changes,
    to_change_feed,
)
from .plans import extract_after, publish_changes, publish_table, run_bronze
from .sources import PartitionedState, StateTable, read_feed, read_log, stream_feed, stream_log, write_feed
from .streaming import run_ingest, run_state_stream

__all__ = [
    "PartitionedState",
    "StateTable",
    "current_state",
    "decode",
    "decode_key",
    "extract_after",
    "fold_changes",
    "infer_schema",
    "key_columns",
    "latest_per_key",
    "live_rows",
    "merge_state",
    "message_status",
    "publish_changes",
    "publish_table",
    "read_feed",
    "read_log",
    "row_images",
    "run_bronze",
    "run_ingest",
    "run_state_stream",
    "state_changes",
    "stream_feed",
    "stream_log",
    "to_change_feed",
    "write_feed",
]
