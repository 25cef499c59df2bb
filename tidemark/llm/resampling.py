"""Resampling of documents towards a target text by hashed n-gram importance weights.

Features are runs of one to n neighbouring words; each counts in the bucket of its CRC-32.  What a bucket holds
of all documents and of all target texts gives its gain, a document's weight is the sum of the gains of its
features, and Gumbel noise from a hash of the id makes the highest sums a sample without replacement.

Words are seldom new: a bounded vocabulary of frequent words with the states of their CRC, and of frequent
pairs with their buckets, is counted over all texts and broadcast.  A feature that starts with a known word
goes on from that word's state; any other takes its CRC from its bytes.  Both give the same bucket, so the
vocabulary saves time and decides nothing.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import free, quoted, short_batches, stored

#: Frequent words, and frequent pairs, that are broadcast at most; some 10 MB of memory in a task.
VOCABULARY = 1 << 15
#: Different words that a task counts before it drops the rarer ones.
COUNTED = 1 << 18
#: Bytes of a word that may be in the vocabulary, so that its size is bounded too.
LONGEST = 64
#: Features whose buckets are found together.
STEP = 1 << 18
#: Bytes that are letters or digits of ASCII, or beyond ASCII; A-Z as a-z, and all others as a space.
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def split_words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and bytes beyond ASCII; only A-Z is lower-cased."""
    return text.translate(_KEPT).split()


def feature_bucket(feature: bytes, buckets: int) -> int:
    return zlib.crc32(feature) % buckets


class Vocabulary:
    """CRC states of frequent words and buckets of frequent pairs; tasks add what they meet, within the bound."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.buckets = buckets
        self.states = {word: zlib.crc32(word) for word in words}
        self.pairs = {pair: zlib.crc32(b" " + pair[1], zlib.crc32(pair[0])) % buckets for pair in pairs}

    def of(self, words: list[bytes], n: int) -> Iterator[np.ndarray]:
        """Buckets of all runs of 1 to ``n`` of the words, piece by piece."""
        known, pairs, buckets, crc = self.states.get, self.pairs.get, self.buckets, zlib.crc32
        for a in range(0, len(words), STEP):
            own = words[a : a + STEP]
            found = [known(word) for word in own]
            states = [crc(word) if state is None else state for word, state in zip(own, found)] if None in found else found
            yield np.array(states, np.int64) % buckets
            if n > 1:
                second = words[a + 1 : a + 1 + len(own)]
                held = [pairs(pair) for pair in zip(own, second)]
                yield np.array([crc(b" " + word, state) % buckets if bucket is None else bucket for bucket, word, state in zip(held, second, states)], np.int64)
            for size in range(3, n + 1):
                last = words[a + size - 1 : a + size - 1 + len(own)]
                middle = zip(*(words[a + k : a + k + len(last)] for k in range(1, size)))
                yield np.array([crc(b" " + b" ".join(rest), state) % buckets for rest, state in zip(middle, states)], np.int64)


def n_runs(words: int, n: int) -> int:
    return sum(max(words - k, 0) for k in range(n))


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.large_binary()):
        yield text.as_py() or b""


def _trimmed(counts: Counter, size: int) -> Counter:
    return Counter(dict(counts.most_common(size))) if len(counts) > size else counts


def frequent(texts: DataFrame, n: int, size: int = VOCABULARY) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
    """The most frequent words, and pairs where ``n`` asks for them, of the only column of ``texts``.

    Every task counts all its words and keeps the commonest ``size``; those are added up over tasks.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter() for _ in range(min(n, 2))]
        for batch in batches:
            for text in _texts(batch.column(0)):
                own = split_words(text)
                for a in range(0, len(own), STEP):
                    held[0].update(own[a : a + STEP])
                    if n > 1:
                        held[1].update(map(b" ".join, zip(own[a : a + STEP], own[a + 1 : a + 1 + STEP])))
                    held = [_trimmed(x, COUNTED // 4) if len(x) > COUNTED else x for x in held]
        rows = []
        for k, counts in enumerate(held):
            short = Counter({key: times for key, times in counts.items() if len(key) <= LONGEST})
            rows += [(k, *x) for x in short.most_common(size)]
        kind, key, times = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(key, pa.binary()), pa.array(times, pa.int64())], ["kind", "key", "times"]
        )

    counts = texts.mapInArrow(count, "kind int, key binary, times long").groupBy("kind", "key").agg(F.sum("times").alias("times"))
    counts = stored(counts, "resampling-frequent")
    words, pairs = ([bytes(r.key) for r in counts.filter(F.col("kind") == k).orderBy(F.desc("times"), "key").limit(size).collect()] for k in (0, 1))
    return words, [tuple(pair.split(b" ")) for pair in pairs]


def _bucketed(rows: DataFrame, vocabulary, n: int) -> DataFrame:
    """The last column of ``rows``, text, replaced by n_words and the packed buckets of its features."""
    *others, _ = rows.columns
    schema = T.StructType([rows.schema[c] for c in others]).add("n_words", T.LongType()).add("found", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        kind = np.uint16 if known.buckets <= 1 << 16 else np.uint32
        for batch in batches:
            n_words, found, start, size = [], [], 0, 0
            for row, text in enumerate(_texts(batch.column(batch.num_columns - 1))):
                own = split_words(text)
                n_words.append(len(own))
                found.append(b"".join(part.astype(kind).tobytes() for part in known.of(own, n)))
                size += len(found[-1])
                if size > 4 << 20 or row == batch.num_rows - 1:
                    part = batch.slice(start, row + 1 - start)
                    columns = [part.column(k) for k in range(len(others))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(n_words, pa.int64()), pa.array(found, pa.binary())], schema.names)
                    n_words, found, start, size = [], [], row + 1, 0

    return rows.mapInArrow(run, schema)


def _totals(found: DataFrame, buckets: int) -> np.ndarray:
    """What every bucket holds, exactly: tasks add up their features, one row per bucket reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                held += np.bincount(_unpacked(packed, buckets), minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], ["bucket", "times"])

    rows = found.select("found").mapInArrow(count, "bucket long, times long").groupBy("bucket").agg(F.sum("times").alias("times")).collect()
    out = np.zeros(buckets, np.int64)
    for row in rows:
        out[row.bucket] = row.times
    return out


def _unpacked(packed: pa.Scalar, buckets: int) -> np.ndarray:
    return np.frombuffer(packed.as_buffer() or b"", np.uint16 if buckets <= 1 << 16 else np.uint32)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target than in the source, with one added to all."""
    all_source, all_target, more = float(source.sum()), float(target.sum()), float(len(source))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (all_source + more) / ((s + 1.0) * (all_target + more)))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def noise(hashed: int) -> int:
    """Gumbel noise in thousandths from 32 random bits."""
    return math.floor(-1000 * math.log(-math.log((hashed + 0.5) / 4294967296)))


def _scores(rows: DataFrame, target: DataFrame, n: int, buckets: int, seed: int, vocabulary: int) -> DataFrame:
    """id, key, n_words, n_features, weight, score of rows (id, key, text)."""
    spark = rows.sparkSession
    short_batches(spark)
    words, pairs = frequent(rows.select("text").unionByName(target), n, vocabulary)
    known = spark.sparkContext.broadcast(Vocabulary(words, pairs, buckets))
    found = stored(_bucketed(rows, known, n), "resampling-features")
    of_target = stored(_bucketed(target, known, n), "resampling-target")
    known.destroy()
    gain = spark.sparkContext.broadcast(gains(_totals(found, buckets), _totals(of_target, buckets)))
    width = 2 if buckets <= 1 << 16 else 4
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    schema = T.StructType([rows.schema["id"], rows.schema["key"]])
    for name in ("n_words", "n_features", "weight", "score"):
        schema = schema.add(name, T.LongType())

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(4)
            weight = [int(gain.value[_unpacked(x, buckets)].sum()) for x in packed]
            score = [w + noise(h) for w, h in zip(weight, batch.column(3).to_pylist())]
            sizes = [len(x.as_buffer() or b"") // width for x in packed]
            numbers = [pa.array(x, pa.int64()) for x in (sizes, weight, score)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *numbers], schema.names)

    return found.select("id", "key", "n_words", hashed.alias("hashed"), "found").mapInArrow(weigh, schema)


def _ranked(
    docs: DataFrame, target: DataFrame, share: tuple[int, int], least_words: int, n: int, buckets: int, seed: int, id: str, text: str,
    target_text: str, vocabulary: int,
) -> DataFrame:
    rows = docs.select(quoted(id).alias("id"), F.xxhash64(quoted(id), quoted(text)).alias("key"), quoted(text).alias("text"))
    scored = _scores(rows, target.select(quoted(target_text).alias("text")), n, buckets, seed, vocabulary)
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    able = scored.filter(F.col("n_words") >= least_words)
    many = able.count() * share[0] // share[1]
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("row").asc()]
    # the numbers given out in sorted partitions hold the partition and the place in it
    placed = able.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("part", F.shiftright("at", 33)).withColumn("place", F.col("at").bitwiseAND((1 << 33) - 1)), "resampling-order")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy("part").agg(F.count("*").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    rank = F.col("before") + F.col("place") + 1
    columns = ["id", "key", "n_words", "n_features", "weight", "score"]
    drawn = placed.join(F.broadcast(parts.select("part", "before")), "part").select(*columns, F.when(rank <= many, rank).alias("rank"))
    rest = scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest)


def importance_resample(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least_words: int = 20, n: int = 2, buckets: int = 10_000,
    seed: int = 2024, id: str = "doc_id", text: str = "text", target_text: str = "text", vocabulary: int = VOCABULARY,
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_features, weight, score, rank.

    Words are runs of letters, digits and characters beyond ASCII, A-Z as a-z; features are runs of 1 to ``n``
    words joined by a space, repeats counted.  A bucket's gain is ``floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))``
    where ``docs`` hold s of all S features in it and ``target`` t of T.  ``weight`` adds the gains of a row's
    features, ``score`` adds Gumbel noise from SHA-256 of ``seed:id``.  Null and empty texts have no features and weight 0;
    a null id counts as an empty one there.

    Of the N rows with ``least_words`` words or more the ``floor(share N)`` of highest score are drawn and ranked 1, 2,
    3, ...; the rank of all others is null.  Ties go to the smaller id, a null id comes last, and of rows that
    repeat an id and a score either may come first.  Rows that repeat are scored each.  An empty ``docs`` gives an
    empty result, an empty target leaves t and T at 0.  Other columns are not looked at.

    Ranks are dealt by a sort over all executors: each sorted partition numbers its rows on from the sum of those
    before it, so only the sizes of partitions come together.
    """
    ranked = _ranked(docs, target, share, least_words, n, buckets, seed, id, text, target_text, vocabulary)
    return ranked.drop("key").withColumnRenamed("id", id)


def resampled(
    docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), least_words: int = 20, n: int = 2, buckets: int = 10_000,
    seed: int = 2024, id: str = "doc_id", text: str = "text", target_text: str = "text", vocabulary: int = VOCABULARY,
) -> DataFrame:
    """The rows of ``docs`` that ``importance_resample`` draws, whole; rows that repeat both id and text are drawn together."""
    (key,) = free(docs, "key")
    ranked = _ranked(docs, target, share, least_words, n, buckets, seed, id, text, target_text, vocabulary)
    drawn = stored(ranked.filter("rank IS NOT NULL").select(F.col("key").alias(key)), "resampling-drawn")
    return docs.withColumn(key, F.xxhash64(quoted(id), quoted(text))).join(drawn, key, "left_semi").drop(key)
