"""Substring dedup: words go that a window of words covers which also starts earlier in the corpus.

Windows are looked for level by level: at 5 words, 10 words and so on, each length twice the one before, up to the
window's own.  On each level only the least hash of its length in every window is looked at: a window
that repeats has the same least piece wherever it stands.  Windows whose piece occurs in one document alone
are done with; those that survive are extended to twice the length, until none survives or the length is
reached.  Hashes only choose candidates; at full length the words themselves decide.

Exact copies are settled by their hash before that, so neither their pieces nor their windows are listed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .bloom import holds
from .exact import text_hash
from .shared import quoted, short_batches, stored, with_group
from .words import Words, combined, joined_words, run_digests, words

WINDOW = 20
#: Length of the first level's pieces, at least.
LEAST = 5
#: Stands for a null id: such rows come before all others and are not judged against one another.
_FIRST = -(1 << 63)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for the ``size`` words from each place on; lengths are doubled where they are even."""
    if len(hashes) < size:
        return hashes[:0]
    if size == 1:
        return hashes
    if size % 2:
        longer = window_hashes(hashes, size - 1)
        return combined(longer[: len(hashes) - size + 1], hashes[size - 1 :])
    return doubled(window_hashes(hashes, size // 2), size // 2)


def doubled(half: np.ndarray, size: int) -> np.ndarray:
    """Hashes of twice the length from those of ``size`` words."""
    return combined(half[: max(len(half) - size, 0)], half[size:])


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    reach, least = 1, values
    while reach * 2 <= width:
        least, reach = np.minimum(least[:-reach], least[reach:]), reach * 2
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def levels(window: int, least: int = LEAST) -> list[int]:
    """Lengths that double up to the window's, from the smallest that is not below ``least``."""
    out = [window]
    while out[0] % 2 == 0 and out[0] // 2 >= least:
        out.insert(0, out[0] // 2)
    if len(out) == 1 and window > 1:
        out.insert(0, window // 2)
    return out


def _standing(text: Words, length: int, survivors: np.ndarray | None, window: int) -> np.ndarray:
    """Places of the windows whose least piece of that length is among the survivors; all at the first level."""
    if survivors is None or len(text.hashes) < window:
        return np.arange(max(len(text.hashes) - window + 1, 0))
    return np.flatnonzero(holds(survivors, _least(text, length, window)))


def _least(text: Words, length: int, window: int) -> np.ndarray:
    """Per window the least hash of its pieces of that length."""
    return least_in_window(window_hashes(text.hashes, length), window - length + 1)


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(
        quoted(id).alias("id"),
        F.coalesce(quoted(id).cast("long"), F.lit(_FIRST)).alias("doc"),
        quoted(text).alias("text"),
        F.xxhash64(quoted(id), quoted(text)).alias("key"),
    )


def _later_copies(keyed: DataFrame) -> DataFrame:
    """doc and key of the rows whose whole text has a smaller id elsewhere."""
    rows = stored(keyed.select("doc", "key", text_hash(F.col("text")).alias("sha")), "repeat-texts")
    twice = bloom.build(rows.select(F.xxhash64("sha").alias("hash")), rows.count(), repeated=True)
    maybe = rows.filter(twice.may_hold(F.xxhash64("sha")))
    groups = maybe.groupBy("sha").agg(F.min("doc").alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = with_group(maybe, stored(groups, "repeat-copies"), ["sha"], "n").filter("doc > first")
    return stored(later.select("doc", "key").distinct(), "repeat-later")


def _listed(rows: DataFrame, of_text: Callable[[Words], np.ndarray], skipped=None) -> DataFrame:
    """``of_text(words)`` of every text, each hash once a text; rows whose key ``skipped`` may hold are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if skipped is not None:
                batch = batch.filter(pa.array(~holds(skipped.value, batch.column(2).to_numpy())))
            held, n = [], 0
            for text in words(batch.column(1)):
                held.append(np.unique(of_text(text)))
                n += len(held[-1])
                if n > 1 << 17:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64))], ["hash"])
                    held, n = [], 0
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(held).view(np.int64))], ["hash"])

    return rows.select("doc", "text", "key").mapInArrow(run, "hash long")


def _without(keyed: DataFrame, later: DataFrame, chosen: bloom.Filter, listing: Callable) -> DataFrame:
    """``listing(rows, skipped)`` of the rows that are not later copies; only those that the filter of these may hold are joined."""
    first = keyed.filter(chosen.may_hold(F.col("key"))).join(later.select("key").distinct(), "key", "left_anti")
    return listing(keyed, chosen.shared).unionByName(listing(first.select(*keyed.columns), None))


def _windows(keyed: DataFrame, standing: Callable[[Words], np.ndarray], window: int, skipped=None) -> DataFrame:
    """(digest, doc, key, place) of the windows still standing, each word sequence once a text, at its first place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if skipped is not None:
                batch = batch.filter(pa.array(~holds(skipped.value, batch.column(2).to_numpy())))
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), words(batch.column(1))):
                places = standing(text)
                if len(places):
                    places = places[_first_ones(text, places, window)]
                for a in range(0, len(places), 1 << 14):
                    own = places[a : a + (1 << 14)]
                    digests = pa.array(run_digests(text, own, window), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [digests, pa.array(np.full(len(own), doc)), pa.array(np.full(len(own), key)), pa.array(own.astype(np.int32))],
                        ["digest", "doc", "key", "place"],
                    )

    return keyed.select("doc", "text", "key").mapInArrow(run, "digest binary, doc long, key long, place int")


def _first_ones(text: Words, places: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows are the first of their word sequence in the text; equal hashes are looked at word by word."""
    full = window_hashes(text.hashes, window)[places]
    different, at = np.unique(full, return_index=True)
    first = np.zeros(len(places), bool)
    first[at] = True
    if len(at) < len(full):
        again = np.flatnonzero(~first)
        leaders = at[np.unique(np.searchsorted(different, full[again]))]
        seen = set(run_digests(text, places[leaders], window))
        for k, digest in zip(again, run_digests(text, places[again], window)):
            if digest not in seen:
                seen.add(digest)
                first[k] = True
    return first


def repeated_windows(
    docs: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text", least: int = LEAST, counted: list | None = None
) -> tuple[DataFrame, DataFrame]:
    """(key, place) of the windows that start earlier in another document, and the later copies (doc, key).

    ``key`` is a hash of id and text.  Each level counts, for the windows still standing, their least pieces of
    its length by document; those of two documents or more go into a Bloom filter of bounded size, and windows whose
    piece it holds stand for the next length, twice as long.  (When it is too small more of them do.)  At full
    length the windows' own words are compared, by digest.  The loop ends early once no piece is shared.
    ``counted``, if given, gets (length, number of shared pieces) of each level.
    """
    short_batches(docs.sparkSession)
    keyed = _keyed(docs, id, text)
    later = _later_copies(keyed)
    copies = bloom.build(later.select("key"), later.count())
    lengths, alive, many = levels(window, least), None, 1

    def at_level(length: int) -> tuple[Callable[[Words], np.ndarray], Callable[[Words], np.ndarray]]:
        known, before = alive.shared if alive else None, length // 2

        def standing(text: Words) -> np.ndarray:
            return _standing(text, before, known.value if known else None, window)

        def pieces(text: Words) -> np.ndarray:
            places = standing(text)
            return _least(text, length, window)[places] if len(places) else text.hashes[:0]

        return standing, pieces

    for length in lengths[:-1]:
        of_text = at_level(length)[1]
        pieces = _without(keyed, later, copies, lambda rows, skipped, of_text=of_text: _listed(rows, of_text, skipped))
        shared = stored(pieces.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "repeat-pieces")
        many, last = shared.count(), alive
        if counted is not None:
            counted.append((length, many))
        if last:
            last.destroy()
        alive = bloom.build(shared, many)
        if not many:
            break
    if many:
        standing = at_level(window)[0]
        # later copies go as a whole: their windows are those of the first copy
        windows = stored(_without(keyed, later, copies, lambda rows, skipped: _windows(rows, standing, window, skipped)), "repeat-windows")
    else:
        windows = keyed.sparkSession.createDataFrame([], "digest binary, doc long, key long, place int")
    groups = windows.groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = with_group(windows, stored(groups, "repeat-groups"), ["digest"], "n").filter("doc > first")
    again = stored(again.select("key", "place").distinct(), "repeat-again")
    for one in (copies, alive):
        if one:
            one.destroy()
    return again, later


def repeat_levels(docs: DataFrame, least: int = LEAST, id: str = "doc_id", text: str = "text") -> list[tuple[int, int]]:
    """How many different word sequences of ``least`` words, twice as many and so on occur in two documents or more.

    Each length looks only at windows whose halves are both shared at the length before; the loop ends at the first
    length without any.  Null and empty texts have no windows; rows of one text count as documents of their own.
    """
    short_batches(docs.sparkSession)
    rows, length, found, alive = _keyed(docs, id, text), least, [], None
    while True:

        def pieces(text: Words, length: int = length, alive=alive) -> np.ndarray:
            full = window_hashes(text.hashes, length)
            if alive is None or not len(full):
                return full
            half = holds(alive.value, window_hashes(text.hashes, length // 2))
            return full[half[: len(full)] & half[length // 2 :]]

        shared = stored(_listed(rows, pieces).groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "repeat-level")
        many = shared.count()
        found.append((length, many))
        if not many:
            return found
        alive, length = bloom.build(shared, many).shared, length * 2


def _covered(flagged: np.ndarray, n: int, window: int) -> np.ndarray:
    """Words of ``n`` that a flagged window covers."""
    edge = np.zeros(n + 1, np.int64)
    edge[: len(flagged)] += flagged
    edge[window : window + len(flagged)] -= flagged
    return np.cumsum(edge[:n]) > 0


def remove_repeats(docs: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, kept (the words that stay, joined by one space).

    A window is ``window`` consecutive words of one document.  A word goes if a window that covers it has a word
    sequence that also starts earlier: in a document of smaller id, or in the same document before.  All
    windows are judged on the input.  Null and empty texts have no words, shorter ones no window.  Rows that
    repeat an id are not judged against one another; a null id comes before all others.

    The places that go are gathered per row, whose number of words bounds them.  Rows that a Bloom
    filter knows to have none pass straight through; within-document repeats are found where the text is.
    """
    again, later = repeated_windows(docs, window, id, text)
    marks = again.select("key", "place", F.lit(False).alias("copy")).unionByName(
        later.select("key", F.lit(None).cast("int").alias("place"), F.lit(True).alias("copy"))
    )
    marks = stored(marks.groupBy("key").agg(F.collect_list("place").alias("places"), F.max("copy").alias("copy")), "repeat-marks")
    chosen = bloom.build(marks.select("key"), marks.count())
    keyed = _keyed(docs, id, text)
    marked = keyed.filter(chosen.may_hold(F.col("key"))).join(marks, "key", "left").select("id", "text", "places", F.coalesce("copy", F.lit(False)).alias("copy"))
    known = chosen.shared

    def clean_marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from clean(batch, batch.column(2), batch.column(3).to_pylist())

    def clean_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~holds(known.value, batch.column(2).to_numpy())))
            yield from clean(batch, None, None)

    def clean(batch: pa.RecordBatch, places, copies) -> Iterator[pa.RecordBatch]:
        n_words, n_removed, kept = [], [], []
        start, size = 0, 0
        for i, text in enumerate(words(batch.column(1))):
            n = len(text.hashes)
            flagged = np.ones(max(n - window + 1, 0), bool)
            if len(flagged) and not (copies and copies[i]):
                flagged = ~_first_ones(text, np.arange(len(flagged)), window)
                if places is not None and places[i].is_valid:
                    flagged[places[i].values.to_numpy()] = True
            keep = ~_covered(flagged, n, window)
            n_words.append(n)
            n_removed.append(n - int(keep.sum()))
            kept.append(joined_words(text, keep))
            size += len(kept[-1])
            if size > 4 << 20:
                yield _cleaned(batch, start, i + 1, n_words, n_removed, kept)
                start, size, n_words, n_removed, kept = i + 1, 0, [], [], []
        if kept:
            yield _cleaned(batch, start, batch.num_rows, n_words, n_removed, kept)

    schema = f"id {docs.schema[id].dataType.simpleString()}, n_words long, n_removed long, kept string"
    others = keyed.select("id", "text", "key").mapInArrow(clean_others, schema)
    return others.unionByName(marked.mapInArrow(clean_marked, schema)).withColumnRenamed("id", id)


def _cleaned(batch: pa.RecordBatch, a: int, b: int, n_words: list, n_removed: list, kept: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column(0).slice(a, b - a), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        ["id", "n_words", "n_removed", "kept"],
    )
