"""Words of whole texts as 64-bit hashes, found on the bytes of Arrow columns without a Python loop per word.

A word is a longest run of bytes other than the space and the control characters from tab to carriage
return.  Its hash starts from its length and takes in eight bytes at a time, mixed after each; long words get a
BLAKE2 digest.  Hashes choose what is compared; where words decide, callers compare digests of the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from .bloom import mixed

#: Bytes of text that are worked on together.
CHUNK = 1 << 19
#: Bytes from which a word is digested by itself.
LONG_WORD = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Keeps the first so many of eight bytes.
_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, 0, (1,))  # the eight bytes from every place on
    out = mixed((eight[starts] & _FIRST[np.minimum(size, 8)]) ^ (size.astype(np.uint64) * _ODD))
    at = 8
    longer = np.flatnonzero(size > at)
    while len(longer) and at < LONG_WORD:
        part = eight[starts[longer] + at] & _FIRST[np.minimum(size[longer] - at, 8)]
        out[longer] = mixed(out[longer] * _ODD ^ part)
        at += 8
        longer = longer[size[longer] > at]
    for k in longer:
        out[k] = int.from_bytes(blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return out


def combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes in this order."""
    return mixed(left * np.uint64(0xD6E8FEB86659FD93) + mixed(right))


class Words(NamedTuple):
    """The words of one text: hashes, and where they start and end in ``data``."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row, with one more at the end; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    return data, offsets


def _found(data: np.ndarray, edges: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of ``data``; none runs over an edge (sorted, inside the data)."""
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    first[inner] = word[inner]
    last[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(starts):
        return starts, ends, np.empty(0, np.uint64)
    return starts, ends, _hashes(_LOWER[data] if fold else data, starts, ends)


def _long(data: np.ndarray, fold: bool) -> Words:
    """The words of one long text, taken in pieces that end between words."""
    parts, at = [], 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data):
            cut = np.flatnonzero(_SPACE[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
                break
            end += CHUNK  # one word longer than a piece
        starts, ends, hashes = _found(data[at:end], np.empty(0, np.int64), fold)
        parts.append((hashes, starts + at, ends + at))
        at = end
    joined = [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 2]
    return Words(*joined, data)


def words(column: pa.Array, fold: bool = False) -> Iterator[Words]:
    """The words of every text in order; ``fold`` takes A-Z as a-z."""
    data, offsets = flat(column)
    row, n = 0, len(offsets) - 1
    while row < n:
        until = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, "right")) - 1)
        until = min(until, n)
        a, b = offsets[row], offsets[until]
        if b - a > CHUNK:
            yield _long(data[a:b], fold)
        else:
            own, edges = data[a:b], offsets[row : until + 1] - a
            starts, ends, hashes = _found(own, edges, fold)
            at = np.searchsorted(starts, edges)
            for i, j, k in zip(at, at[1:], range(until - row)):
                yield Words(hashes[i:j], starts[i:j] - edges[k], ends[i:j] - edges[k], own[edges[k] : edges[k + 1]])
        row = until


def joined_words(text: Words, keep: np.ndarray) -> bytes:
    """The chosen words with one space between them."""
    starts, sizes = text.starts[keep], (text.ends - text.starts)[keep] + 1
    if not len(starts):
        return b""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
    out = text.data[np.minimum(places, len(text.data) - 1)]
    out[ends - 1] = 0x20
    return out[:-1].tobytes()


def run_digests(text: Words, places: np.ndarray, size: int, fold: bool = False, bytes_of: int = 16) -> list[bytes]:
    """For the ``size`` words from each place on a digest of the words themselves: equal ones are taken for equal words."""
    joined = joined_words(text, np.ones(len(text.hashes), bool))
    joined = joined.lower() if fold else joined  # of bytes: A-Z alone
    ends = np.cumsum(text.ends - text.starts + 1)
    starts = ends - (text.ends - text.starts + 1)
    first, last = starts[places].tolist(), (ends[np.minimum(places + size, len(ends)) - 1] - 1).tolist()
    return [blake2b(joined[a:b], digest_size=bytes_of).digest() for a, b in zip(first, last)]
