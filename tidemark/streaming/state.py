"""Keep a state table up to date from a stream of decoded events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import latest_per_key, row_images
from ..operators.images import has_position
from ..sources import StateTable
from .trigger import triggered


def run_state_stream(
    events: DataFrame,
    table: StateTable,
    op_from: str = "op",
    fold_every: int | None = None,
    available_now: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Apply each micro-batch of a decoded feed, or of the log, to the table.

    A micro-batch costs its own size: its newest row per key is stored next to the state.  The
    state as a whole is rewritten by a job of its own that calls ``table.fold()`` meanwhile, or after every
    ``fold_every`` micro-batches.  No state store is involved, so neither keys nor lateness are bounded.  Batch numbers come from the checkpoint,
    which lives with the table; a replayed micro-batch replaces itself.
    """
    checkpoint, first = table.open_checkpoint()
    # Chosen before the sink, so that the stream's own plan reads no more than the images need.
    images = row_images(events, op_from, position=has_position(events))

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.add_changes(latest_per_key(batch, table.keys, table.order_by), first + batch_id)
        if fold_every and (batch_id + 1) % fold_every == 0:
            table.fold()

    writer = images.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return triggered(writer, available_now, every).start()
