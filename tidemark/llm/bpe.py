"""Byte-level BPE by backtracking over longest matches, and the way back.

A vocabulary of ranks alone decides which tokens merge.  A sequence of tokens is what the merges
give if and only if every adjacent pair is compatible, that is, merging the pair's bytes from
scratch leaves the same pair.  So a piece of text is encoded from the left by the longest token
that is compatible with the one before it; where none fits, the last token gives way to its next
shorter prefix.  Each place is given up once at most, which keeps the time linear.

The longest matches come from an Aho-Corasick automaton over the tokens, whose bytes are written
as the Latin-1 characters of the same numbers.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import quoted, short_batches

#: Pieces whose ids a worker remembers, in each of two generations.
REMEMBERED = 100_000
#: Pairs of tokens whose compatibility it remembers.
PAIRS = 200_000
#: Tokens that are decoded together.
DECODED = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a file of base64 and number in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Encoder:
    """Ids of the pieces of a text; ``split`` is the pattern that cuts it into pieces."""

    def __init__(self, ranks: dict[bytes, int], split: str):
        self.ranks = ranks
        # \s of the pattern's own library is the Unicode property, without the separators U+001C to U+001F
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.token = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        self.pair: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits: dict[int, bool] = {}
        self.prefix: dict[int, int] = {}
        for rank in sorted(self.token):
            self._add(rank)
        for rank in self.token:
            self._shorten(rank)
        self.automaton.make_automaton()
        self.known = _Known(self)

    def _add(self, rank: int) -> None:
        """Notes of a token the two it is merged from.

        Earlier ranks are noted already, so the two are the compatible pair among these.  A token that no
        merge makes is matched as a whole piece only.
        """
        token = self.token[rank]
        if len(token) > 1:
            for n in range(1, len(token)):
                left, right = self.ranks.get(token[:n]), self.ranks.get(token[n:])
                if left is not None and right is not None and max(left, right) < rank and self._compatible(left, right):
                    self.pair[left, right] = rank
                    self.halves[rank] = left, right
                    break
            else:
                return
        self.automaton.add_word(token.decode("latin-1"), (len(token), rank))

    def _shorten(self, rank: int) -> None:
        token = self.token[rank]
        for n in range(len(token) - 1, 0, -1):
            shorter = self.ranks.get(token[:n])
            if shorter is not None and (n == 1 or shorter in self.halves):
                self.prefix[rank] = shorter
                return

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both from scratch leaves these two tokens."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Undo the merges on both sides, latest first.  ``before`` is the time of the merge last undone: a
        # pair that meets at the seam and would have merged earlier than that breaks the two tokens up.
        before = len(self.ranks) + 1
        while True:
            across = self.pair.get((left, right))
            if across is not None and across < before:
                return False
            undo_left = left in self.halves and (left > right or right not in self.halves)
            if undo_left:
                before, left = left, self.halves[left][1]
            elif right in self.halves:
                before, right = right + 1, self.halves[right][0]
            else:
                return True

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        longest: list[int] = [0] * n
        for end, (size, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - size] = rank
        size, prefix, fits = self.token, self.prefix, self.compatible
        out: list[int] = []
        given_up = set()
        at, rank = 0, longest[0]
        while True:
            end = at + len(size[rank])
            if end not in given_up:
                if not out or fits(out[-1], rank):
                    out.append(rank)
                    if end == n:
                        return tuple(out)
                    at, rank = end, longest[end]
                    continue
            shorter = prefix.get(rank)
            if shorter is None:
                given_up.add(at)
                rank = out.pop()
                at -= len(size[rank])
                shorter = prefix.get(rank, rank)
            rank = shorter

    def encode(self, text: str) -> np.ndarray:
        """The ids of the text."""
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.pieces.findall(text))), np.int32)


class _Known(dict):
    """Ids of the pieces met lately, as the bytes of their numbers, in two generations."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("i", self.encoder.encode_piece(piece.encode())).tobytes()
        if len(piece) < 64:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Decoder:
    """Bytes of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = {rank: token for token, rank in ranks.items()}
        self.unknown = max(tokens, default=-1) + 1
        parts = [tokens.get(i, b"") for i in range(self.unknown)]
        self.size = np.array([len(tokens[i]) if i in tokens else -1 for i in range(self.unknown + 1)], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(np.maximum(self.size, 0))])[:-1]
        self.data = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes | None:
        """None if the vocabulary lacks one of the ids."""
        out = []
        for k in range(0, len(ids), DECODED):
            x = ids[k : k + DECODED]
            x = np.where((x >= 0) & (x < self.unknown), x, self.unknown)
            n = self.size[x]
            if (n < 0).any():
                return None
            shift = np.repeat(self.begin[x] - np.concatenate([[0], np.cumsum(n)])[:-1], n)
            out.append(self.data[shift + np.arange(len(shift))].tobytes())
        return b"".join(out)


_made: dict[type, tuple] = {}


def _worker_own(kind: type, ranks: dict[bytes, int], *more):
    """The worker's encoder or decoder for the vocabulary it was given last: its tables take a while to make."""
    if kind not in _made or _made[kind][0] is not ranks or _made[kind][1] != more:
        _made[kind] = ranks, more, kind(ranks, *more)
    return _made[kind][2]


def bpe_encode(
    docs: DataFrame, ranks: dict[bytes, int], split: str, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with the token ids of every whole text as array<int>, in column ``ids``.

    With ``decoded``, a binary column of that name has the bytes that the ids decode to, made in the same pass.
    Null and empty texts have no ids.  Columns of these names are replaced.  Nothing is shuffled; the
    vocabulary, a fixed table, is broadcast.
    """
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    added = [ids] if decoded is None else [ids, decoded]
    kept = [c for c in docs.columns if c.lower() not in [a.lower() for a in added]]
    at = docs.columns.index(text)
    from_column = [docs.columns.index(c) for c in kept]
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded or "", T.BinaryType())]
    schema = T.StructType([docs.schema[c] for c in kept] + fields[: len(added)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_own(Encoder, shared.value, split)
        for batch in batches:
            for part in _bounded(batch, at):
                found = [encoder.encode(x.as_py() or "") for x in part.column(at)]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*found, np.empty(0, np.int32)])))]
                if decoded is not None:
                    decoder = _worker_own(Decoder, shared.value)
                    new.append(pa.array([decoder.decode(x) for x in found], pa.binary()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in from_column), *new], [*kept, *added])
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(encode, schema)


def _bounded(batch: pa.RecordBatch, at: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices whose texts take about ``most`` bytes, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(sizes)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def bpe_decode(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the bytes that the ids stand for in column ``to``, which replaces one of that name.

    No ids, null included, give no bytes; an id that the vocabulary lacks makes the result null.
    """
    shared = rows.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def decode(lists: pd.Series) -> pd.Series:
        decoder = _worker_own(Decoder, shared.value)
        return lists.map(lambda own: b"" if own is None else decoder.decode(np.nan_to_num(np.asarray(own, np.float64), nan=-1).astype(np.int64)))

    return rows.withColumn(to, decode(quoted(ids)))
