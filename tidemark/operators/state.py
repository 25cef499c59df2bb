"""Current state of a table from its change events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import key_columns
from .images import has_position, row_images
from .latest import latest_per_key


def live_rows(state: DataFrame) -> DataFrame:
    """Rows that are not deleted.  A row without ``op`` counts as not live."""
    return state.filter(F.col("op") != "d")


def current_state(
    log: DataFrame, keys: str | list[str], order_by: str | list[str] = "ts_ms", op_from: str = "op"
) -> DataFrame:
    """Live rows of the table a decoded log describes."""
    position = has_position(log)
    state = live_rows(latest_per_key(row_images(log, op_from, position), keys, order_by))
    return state.drop("_position") if position else state


def merge_state(
    existing: DataFrame,
    changes: DataFrame,
    keys: str | list[str],
    order_by: str | list[str] = "ts_ms",
    keep_deletes: bool = False,
) -> DataFrame:
    """Newest row per key over state and changes together, neither of which need be unique.

    Columns are matched by name; one that a side lacks is null there.  With ``keep_deletes`` the
    winners that are deletes stay, which a later merge of an older event needs.
    """
    merged = latest_per_key(existing.unionByName(changes, allowMissingColumns=True), keys, order_by)
    return merged if keep_deletes else live_rows(merged)


def fold_changes(
    existing: DataFrame, changes: DataFrame, keys: str | list[str], order_by: str | list[str] = "ts_ms"
) -> DataFrame:
    """``merge_state`` with deletes kept, for an ``existing`` side that is large and unique on the keys.

    The changes are ranked first, which leaves them partitioned by key.  The state is shuffled once, unsorted, to the
    same partitioning, so that the union of both is ranked where it lies.  Each input is read once.
    """
    keys = key_columns(keys)
    placed = existing.repartition(*[F.col(f"`{k}`") for k in keys])
    return merge_state(placed, latest_per_key(changes, keys, order_by), keys, order_by, keep_deletes=True)
