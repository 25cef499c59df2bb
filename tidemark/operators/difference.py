"""What changed between two states of a table."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import key_columns


def state_changes(old: DataFrame, new: DataFrame, keys: str | list[str], at: str | Column | None = None) -> DataFrame:
    """``op``, ``before``, ``after`` and ``ts_ms`` of the events that turn the state ``old`` into ``new``.

    Both states have one row per key with ``op`` and ``ts_ms``; deleted rows may be there or not.  A row that is only live in
    ``new`` is a create, one that is only live in ``old`` a delete, and one that is live in both with
    another value in any column an update; images hold all columns but ``op``, ``ts_ms`` and the log position.  The
    time is that of the row in ``new``; a delete whose row ``new`` does not keep takes ``at`` (the time of the job by
    default).  Columns that one state lacks are null in its images.  Null keys are equal.

    States that are bucketed by the keys alike, such as two versions of one ``StateTable``, are joined where they lie; rows
    with a null in the key, which such a join leaves out, are few and joined by themselves.
    """
    keys = key_columns(keys)
    names = [c for c in new.columns if c not in ("op", "ts_ms", "_position")]
    names += [c for c in old.columns if c not in ("op", "ts_ms", "_position", *names)]
    at = F.unix_millis(F.current_timestamp()).cast("double") if at is None else F.col(at) if isinstance(at, str) else at

    def side(rows: DataFrame, name: str) -> DataFrame:
        kinds = {f.name: f.dataType for df in (old, new) for f in df.schema}
        image = F.struct(*[(F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast(kinds[c])).alias(c) for c in names])
        columns = [F.col(f"`{k}`").alias(f"{name}_{i}") for i, k in enumerate(keys)]
        live = F.coalesce(F.col("op") != "d", F.lit(False))
        return rows.select(*columns, F.when(live, image).alias(name), F.col("ts_ms").alias(f"{name}_ts_ms"))

    before, after = side(old, "before"), side(new, "after")
    pairs = [(F.col(f"before_{i}"), F.col(f"after_{i}")) for i in range(len(keys))]

    def has_null(of: int) -> Column:
        return reduce(or_, [pair[of].isNull() for pair in pairs])

    whole = before.filter(~has_null(0)).join(after.filter(~has_null(1)), reduce(and_, [a == b for a, b in pairs]), "full")
    rest = before.filter(has_null(0)).join(after.filter(has_null(1)), reduce(and_, [a.eqNullSafe(b) for a, b in pairs]), "full")
    both = whole.unionByName(rest)
    op = F.when(F.col("after").isNull(), "d").when(F.col("before").isNull(), "c").otherwise("u")
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).select(
        op.alias("op"), "before", "after", F.coalesce("after_ts_ms", at).alias("ts_ms")
    )
