"""DataFrame-to-DataFrame operators; all are lazy."""

from .decode import decode, decode_key, decode_with_status, extract_images, late_field, message_status, only_table
from .difference import state_changes
from .distinct import distinct_events
from .images import log_position, row_images
from .latest import latest_per_key
from .publish import source_struct, to_change_feed
from .state import current_state, fold_changes, live_rows, merge_state

__all__ = [
    "current_state",
    "decode",
    "decode_key",
    "decode_with_status",
    "distinct_events",
    "extract_images",
    "fold_changes",
    "late_field",
    "latest_per_key",
    "live_rows",
    "log_position",
    "merge_state",
    "message_status",
    "only_table",
    "row_images",
    "source_struct",
    "state_changes",
    "to_change_feed",
]
