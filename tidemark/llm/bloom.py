"""Bloom filters of 64-bit keys, built by all tasks and merged by segment.

A filter is an array of 64-bit words.  A key picks one word and one bit in each quarter of it.
Tasks report the cells they set, segments of the array are merged on the executors, and the merged
array, of at most ``max_bytes`` whatever the input, is broadcast.  A filter too small for its keys
lets more keys pass than it must; it never holds back a key it was given.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bound of a filter that is broadcast.
MAX_BYTES = 64 << 20
#: Cells for each key while the bound allows.
CELLS_PER_KEY = 16
#: Words that are merged together.
SEGMENT = 1 << 14
#: Cells that one task merges, about.
TOGETHER = 1 << 26
#: Keys that a task gathers before it reports their cells.
GATHERED = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _places(keys: np.ndarray, words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    h = mixed(keys.view(np.uint64) if keys.dtype == np.int64 else keys)
    word = ((h >> np.uint64(32)) * np.uint64(words)) >> np.uint64(32)
    return word, [((h >> np.uint64(4 * q)) & np.uint64(15)) + np.uint64(16 * q) for q in range(4)]


def _cells(keys: np.ndarray, words: int) -> np.ndarray:
    word, bits = _places(keys, words)
    return np.concatenate([word * np.uint64(64) + bit for bit in bits])


def _numbers(column: pa.Array) -> np.ndarray:
    return column.drop_null().to_numpy(zero_copy_only=False)


class Filter:
    """Keys that were seen (or seen twice) at least; others pass too, but seldom.

    Code that runs in tasks anyway asks ``holds(filter.shared.value, keys)``, which spares it a second worker.
    """

    def __init__(self, spark: SparkSession, words: np.ndarray):
        self.words = words
        self.shared = spark.sparkContext.broadcast(words)

    def destroy(self) -> None:
        """Frees the filter on all executors, once nothing that asks it will run again."""
        self.shared.destroy()

    def may_hold(self, key: Column) -> Column:
        """False only for keys that the filter was not given; null for null."""
        shared = self.shared

        @F.pandas_udf("boolean")
        def look_up(keys: pd.Series) -> pd.Series:
            null = keys.isna().to_numpy()
            found = holds(shared.value, keys.fillna(0).to_numpy(np.int64))
            return pd.Series(found, dtype="boolean").mask(null)

        return look_up(key)


def holds(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    word, bits = _places(keys, len(words))
    have, found = words[word], np.ones(len(keys), bool)
    for bit in bits:
        found &= (have >> bit) & np.uint64(1) == 1
    return found


def build(
    keys: DataFrame,
    rows: int,
    repeated: bool = False,
    max_bytes: int = MAX_BYTES,
    keys_of: Callable[[pa.RecordBatch], Iterable[np.ndarray]] | None = None,
) -> Filter:
    """The filter of the only column of ``keys`` (long; nulls are left out), about ``rows`` of them.

    ``keys_of`` instead takes batches of any columns and gives their keys, piece by piece.  With ``repeated`` it holds
    the keys that occur at least twice: cells count up to two, task by task and then by segment, and those set twice
    stay.  No key leaves its task, only cells do.  Where a segment has very many, shares of its reports are merged
    first, so that no task gets all of them.
    """
    spark = keys.sparkSession
    words = int(min(max(rows * CELLS_PER_KEY // 64, 64), max_bytes // 8))
    segments = -(-words // SEGMENT)
    salts = max(1, -(-4 * rows // (segments * TOGETHER)))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for own in keys_of(batch) if keys_of else [_numbers(batch.column(0))]:
                held.append(own)
                n += len(own)
                if n >= GATHERED:
                    yield from packed(np.concatenate(held))
                    held, n = [], 0
        if n:
            yield from packed(np.concatenate(held))

    def packed(own: np.ndarray) -> Iterator[pa.RecordBatch]:
        cells, times = np.unique(_cells(own, words), return_counts=True)
        segment = (cells // np.uint64(64 * SEGMENT)).astype(np.int32)
        code = ((cells % np.uint64(64 * SEGMENT)) * np.uint64(2) + (times > 1)).astype(np.uint32)
        at = np.flatnonzero(np.diff(segment, prepend=-1))
        for a, b in zip(at, [*at[1:], len(segment)]):
            steps = np.diff(code[a:b], prepend=np.uint32(0)).astype(np.uint32)
            salt = TaskContext.get().partitionId() % salts
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment[a]], pa.int32()), pa.array([salt], pa.int32()), pa.array([zlib.compress(steps.tobytes(), 1)], pa.binary())],
                ["segment", "salt", "cells"],
            )

    def counted(parts: pd.DataFrame) -> np.ndarray:
        seen = np.zeros(64 * SEGMENT, np.uint8)
        for part in parts.cells:
            code = np.cumsum(np.frombuffer(zlib.decompress(part), np.uint32), dtype=np.uint32)
            seen[code >> 1] = np.minimum(seen[code >> 1] + 1 + (code & 1), 2).astype(np.uint8)
        return seen

    def plane(parts: pd.DataFrame, seen: np.ndarray) -> pd.DataFrame:
        bits = np.packbits(seen > repeated, bitorder="little").tobytes()
        return pd.DataFrame({"segment": [int(parts.segment.iloc[0])], "plane": [zlib.compress(bits, 1)]})

    def merged(parts: pd.DataFrame) -> pd.DataFrame:
        return plane(parts, counted(parts))

    def share(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"segment": [int(parts.segment.iloc[0])], "seen": [zlib.compress(counted(parts).tobytes(), 1)]})

    def joined(parts: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(64 * SEGMENT, np.uint8)
        for part in parts.seen:
            seen = np.minimum(seen + np.frombuffer(zlib.decompress(part), np.uint8), 2)
        return plane(parts, seen)

    reports = keys.mapInArrow(report, "segment int, salt int, cells binary")
    if salts > 1:
        shares = reports.repartition(segments * salts, "segment", "salt").groupBy("segment", "salt").applyInPandas(share, "segment int, seen binary")
        planes = shares.repartition(segments, "segment").groupBy("segment").applyInPandas(joined, "segment int, plane binary")
    else:
        planes = reports.repartition(segments, "segment").groupBy("segment").applyInPandas(merged, "segment int, plane binary")
    out = np.zeros(segments * SEGMENT, np.uint64)
    for segment, plane in planes.collect():  # one job; ``max_bytes`` at most
        out[segment * SEGMENT : (segment + 1) * SEGMENT] = np.frombuffer(zlib.decompress(plane), np.uint64)
    return Filter(spark, out[:words].copy())
