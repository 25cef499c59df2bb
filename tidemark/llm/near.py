"""Near-duplicate documents: SetSketch registers, bands, joint likelihood, then the full sets.

A document's set holds its distinct shingles of words.  Its sketch has registers K = floor(1 - log_B(h)), cut to
the range of 16 bits, where h is the least of exponential variables of rate A that a hash gives each
shingle for that register.  Sketches of two sets merge to that of their union by the larger register, and
registers of alike sets are equal about as often as their Jaccard similarity says.

Documents whose registers agree in one band at least are compared: the similarity most likely to give the
numbers of larger, smaller and equal registers, the sizes of both sets being known, must come near the
threshold, and then the full sets decide, of digests of the shingles' own words.  Documents with equal sets are one
class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .bloom import mixed
from .components import components, forest
from .shared import free, quoted, short_batches, stored, with_group
from .words import Words, combined, run_digests, words

#: Bands, and registers in each: 0.8 in common and all 40 bands missed has a chance of about 1e-7.
BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
#: Base and rate of the registers.
BASE, RATE = 1.001, 20.0
TOP = (1 << 16) - 1
#: Six standard deviations of the estimate at the threshold.
MARGIN = 0.17
#: Members of a bucket, and elements of their sets, that meet those of another block in one task.
BLOCK = 512
#: Sets of so few shingles are told apart by a digest of the shingles, larger ones by two sums of hashes.
FEW = 64
ELEMENTS = 1 << 20

_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(0, 1 << 31, REGISTERS, np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, REGISTERS, np.uint32)
_BAND_FACTOR = mixed(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` words; a shorter text is one shingle, an empty one has none."""
    if not len(hashes):
        return hashes
    n = max(len(hashes) - size + 1, 1)
    out = hashes[:n]
    for k in range(1, min(size, len(hashes))):
        out = combined(out, hashes[k : k + n])
    return np.unique(out)


def exact_shingles(text: Words, size: int) -> np.ndarray:
    """``shingles`` by a digest of each shingle's words, for the sets that decide."""
    if not len(text.hashes):
        return np.empty(0, np.int64)
    n = max(len(text.hashes) - size + 1, 1)
    found = run_digests(text, np.arange(n), min(size, len(text.hashes)), fold=True, bytes_of=8)
    return np.unique(np.frombuffer(b"".join(found), np.int64))


def _sums(own: np.ndarray, text: Words, size: int) -> tuple[int, int]:
    """What equal sets have in common, as two 64-bit numbers."""
    one = mixed(own).sum(dtype=np.uint64)
    if len(own) <= FEW:
        two = mixed(exact_shingles(text, size).view(np.uint64)).sum(dtype=np.uint64)
    else:
        two = mixed(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def sketch(own: np.ndarray) -> np.ndarray:
    """The registers of a set of hashes."""
    low = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    short = mixed(own).astype(np.uint32)
    for k in range(0, len(short), 256):
        values = short[k : k + 256, None] * _FACTOR
        values += _SHIFT
        np.minimum(low, values.min(0), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A key per band of each sketch (one per row)."""
    parts = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    keys = (mixed(parts + np.uint64(1)) * _BAND_FACTOR).sum(2, dtype=np.uint64)
    return mixed(keys + np.arange(BANDS, dtype=np.uint64))


def likeliest(larger: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of greatest likelihood, to a hundredth.

    ``larger`` and ``smaller`` count the registers in which the first sketch exceeds the second or falls below it.
    """
    grid = np.linspace(0, 1, 101)
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    above, below = _chance(np.maximum(u - v * grid, 1e-12)), _chance(np.maximum(v - u * grid, 1e-12))
    same = np.maximum(1 - above - below, 1e-12)
    equal = REGISTERS - larger - smaller
    likelihood = larger[:, None] * np.log(above) + smaller[:, None] * np.log(below) + equal[:, None] * np.log(same)
    possible = grid <= np.minimum(n_a / n_b, n_b / n_a)[:, None] + 0.005
    return grid[np.where(possible, likelihood, -np.inf).argmax(1)]


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def _registers(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, REGISTERS)


class Prepared(NamedTuple):
    """Rows (id, n, k1, k2, key) and classes of equal sets (c, k1, k2, n, n_rows, key, least, sketch)."""

    rows: DataFrame
    classes: DataFrame


def prepare(docs: DataFrame, id: str, text: str, size: int) -> Prepared:
    """Sets and sketches of all documents; ``key`` names one row of each class, whose text has its set."""
    short_batches(docs.sparkSession)
    keyed = docs.select(
        quoted(text).alias("text"), quoted(id).cast("long").alias("id"), F.xxhash64(quoted(id), quoted(text)).alias("key")
    )

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k1, k2, held = [], [], [], []
            for text in words(batch.column(0), fold=True):
                own = shingles(text.hashes, size)
                n.append(len(own))
                one, two = _sums(own, text, size)
                k1.append(one)
                k2.append(two)
                held.append(sketch(own).tobytes() if len(own) else None)
            sums = [pa.array(k, pa.int64()) for k in (k1, k2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(n, pa.int64()), *sums, pa.array(held, pa.binary())],
                ["id", "key", "n", "k1", "k2", "sketch"],
            )

    rows = stored(keyed.mapInArrow(sketches, "id long, key long, n long, k1 long, k2 long, sketch binary"), "near-rows")
    classes = (
        rows.filter("n > 0")
        .groupBy("k1", "k2")
        .agg(F.first("n").alias("n"), F.count("*").alias("n_rows"), F.min("key").alias("key"), F.min("id").alias("least"), F.first("sketch").alias("sketch"))
        .withColumn("c", F.monotonically_increasing_id())
    )
    return Prepared(rows.drop("sketch"), stored(classes, "near-classes"))


def _members(classes: DataFrame) -> DataFrame:
    """band, c, hub, size for every bucket of two classes or more; hub is its least class.

    The keys of all bands go through a Bloom filter first, and only those it has seen twice are shuffled.
    """

    def keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for k in range(0, batch.num_rows, 2048):
            yield band_keys(_registers(batch.column(1)[k : k + 2048].to_pylist())).ravel()

    sketches = classes.select("c", "sketch")
    twice = bloom.build(sketches, classes.count() * BANDS, repeated=True, keys_of=keys).shared  # freed below

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, at = batch.column(0).to_numpy(zero_copy_only=False), 0
            for bands in keys(batch):
                found = np.flatnonzero(bloom.holds(twice.value, bands))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bands[found].view(np.int64)), pa.array(c[at + found // BANDS])], ["band", "c"]
                )
                at += len(bands) // BANDS

    maybe = stored(sketches.mapInArrow(repeated, "band long, c long"), "near-bands")
    twice.destroy()
    buckets = stored(
        maybe.groupBy("band").agg(F.min("c").alias("hub"), F.count("*").alias("size")).filter("size > 1"), "near-buckets"
    )
    return stored(with_group(maybe, buckets, ["band"], "size"), "near-members")


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose sketches make a similarity near the threshold or above it likely."""
    own = classes.select("c", "n", "sketch")
    degree = pairs.groupBy("a").agg(F.count("*").alias("degree"))
    first = own.join(degree, own.c == degree.a).select("a", F.col("n").alias("n_a"), F.col("sketch").alias("of_a"), "degree")
    both = with_group(pairs, stored(first, "near-hubs"), ["a"], "degree").join(
        own.select(F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("of_b")), "b"
    )

    def estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for k in range(0, len(batch), 4096):
                part = batch.iloc[k : k + 4096]
                x, y = _registers(part.of_a), _registers(part.of_b)
                near = likeliest((x > y).sum(1), (x < y).sum(1), part.n_a.to_numpy(float), part.n_b.to_numpy(float))
                keep.append(near >= threshold - MARGIN)
            yield batch.loc[np.concatenate([*keep, np.empty(0, bool)]), ["a", "b"]]

    return both.mapInPandas(estimate, "a long, b long")


def _sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """c and its full set for the classes in ``nodes``, made from one document of each.

    Only documents that a Bloom filter takes for one of those are read word by word.
    """
    wanted = stored(classes.join(nodes, "c").select("c", "key", "k1", "k2"), "near-wanted")
    chosen = bloom.build(wanted.select("key"), wanted.count()).shared
    keyed = docs.select(quoted(text).alias("text"), F.xxhash64(quoted(id), quoted(text)).alias("key"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            batch = batch.filter(pa.array(bloom.holds(chosen.value, batch.column(1).to_numpy())))
            for key, text in zip(batch.column(1).to_pylist(), words(batch.column(0), fold=True)):
                if key not in seen:  # rows that repeat id and text
                    seen.add(key)
                    k1 = mixed(shingles(text.hashes, size)).sum(dtype=np.uint64).view(np.int64)
                    own = exact_shingles(text, size)
                    values = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.array(own))
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([int(k1)]), values], ["key", "k1", "own"])

    found = keyed.mapInArrow(sets, "key long, k1 long, own array<long>")
    out = stored(found.join(wanted, ["key", "k1"]).select("c", "own").dropDuplicates(["c"]), "near-sets")
    chosen.destroy()
    return out


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``percent`` of their union in common.

    The pairs of a hub ``a`` are dealt to parts of at most about ``BLOCK``, each of which gets the hub's set once, in front.
    """
    degree = stored(pairs.groupBy("a").agg(F.count("*").alias("degree")).withColumn("parts", F.ceil(F.col("degree") / BLOCK).cast("int")), "near-degrees")
    heads = degree.join(sets, degree.a == sets.c).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "own"
    )
    dealt = with_group(pairs, degree, ["a"], "degree").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    rows = heads.unionByName(dealt.join(sets, dealt.b == sets.c).select("a", "part", "b", "own"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            found = []
            for k, (a, b) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                own = batch.column(3)[k].values.to_numpy()
                if b is None:
                    head = own
                elif _alike(head, own, percent):
                    found.append((a, b))
            yield _pairs(np.array([a for a, _ in found], np.int64), np.array([b for _, b in found], np.int64))

    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return ordered.mapInArrow(compare, "a long, b long")


def _alike(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _across(docs: DataFrame, members: DataFrame, classes: DataFrame, labels: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    """Links between members of a bucket that no links connect yet.

    The hubs have been compared with all others.  Buckets whose other members are one component have nothing to
    add.  In the rest a first pass on the sketches finds the members that have a likely partner of another
    component; these meet once more with their full sets.  Pairs live within a task, in the first
    bucket that they share; what comes out are members and links.
    """
    others = members.filter("c <> hub").drop("hub", "size")
    labelled = others.join(labels, others.c == labels.node, "left").select("band", "c", F.coalesce("root", "c").alias("label"))
    labelled = stored(labelled, "near-labelled")
    apart = labelled.groupBy("band", "label").agg(F.count("*").alias("n_rows"), F.lit(0).alias("elements"))
    rest = with_group(labelled, stored(_blocks(apart), "near-apart"), ["band"], "size")
    rest = rest.join(classes.select("c", "n", "sketch"), "c")
    asked = _met(rest, percent, None).distinct()
    asked = stored(asked.select(F.col("a").alias("band"), F.col("b").alias("c")), "near-asked")
    sets = _sets(docs, classes, asked.select("c").distinct(), id, text, size)
    known = asked.join(labels, asked.c == labels.node, "left").select("band", "c", F.coalesce("root", "c").alias("label"))
    known = stored(known.join(classes.select("c", "n", "sketch"), "c"), "near-known")
    totals = known.groupBy("band", "label").agg(F.count("*").alias("n_rows"), F.sum("n").alias("elements"))
    full = with_group(known, stored(_blocks(totals), "near-totals"), ["band"], "size").join(sets, "c")
    return _met(full, percent, "own")


def _blocks(per_label: DataFrame) -> DataFrame:
    """band, size, most, mains, rests for the buckets of two labels or more, from the rows and elements of each label.

    The members of a bucket's largest component, ``most``, have nothing to find among themselves: where it takes fewer rows,
    they are dealt to ``mains`` blocks that meet the ``rests`` blocks of the other members only.  Otherwise there are
    no main blocks and all meet all.
    """

    def blocks(rows: Column, elements: Column) -> Column:
        return F.ceil(F.greatest(rows / BLOCK, elements / ELEMENTS)).cast("int")

    top = F.max(F.struct("n_rows", "label", "elements")).alias("top")
    buckets = per_label.groupBy("band").agg(top, F.sum("n_rows").alias("size"), F.sum("elements").alias("all")).filter("size > top.n_rows")
    others = F.col("size") - F.col("top.n_rows")
    counted = buckets.select(
        "band", "size", F.col("top.label").alias("most"), F.col("top.n_rows").alias("n_most"), others.alias("n_others"),
        blocks(F.col("top.n_rows"), F.col("top.elements")).alias("mains"),
        blocks(others, F.col("all") - F.col("top.elements")).alias("rests"),
        blocks(F.col("size"), F.col("all")).alias("blocks"),
    )
    fewer = F.expr("n_most * rests + n_others * (mains + rests) < size * blocks")
    return counted.select(
        "band", "size", "most", F.when(fewer, F.col("mains")).otherwise(0).alias("mains"), F.when(fewer, F.col("rests")).otherwise(F.col("blocks")).alias("rests")
    )


def _met(rows: DataFrame, percent: int, own: str | None) -> DataFrame:
    """Every two members of a bucket and of different labels meet in one task, which has two of the bucket's blocks.

    Without sets, (band, c) of those with a likely partner; with the column ``own`` of full sets, the links.
    """
    main, mains, rests = (F.col("mains") > 0) & (F.col("label") == F.col("most")), F.col("mains"), F.col("rests")
    at = F.xxhash64("c")
    placed = rows.withColumn("block", F.when(main, F.pmod(at, F.greatest(mains, F.lit(1)))).otherwise(mains + F.pmod(at, rests)).cast("int"))
    other = F.explode(F.sequence(F.when(main, mains).otherwise(0), mains + rests - 1)).alias("other")
    columns = ["band", "c", "label", "n", "sketch", *([own] if own else [])]
    placed = placed.select(*columns, "block", other).select(
        "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", *columns[1:]
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            keys = [rows.column(k).to_numpy() for k in range(3)]
            starts = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)])
            yield from _compared(rows, starts, percent)
            held = rows.slice(int(starts[-1])).to_batches()  # the last group may go on
        if held:
            rows = pa.Table.from_batches(held)
            yield from _compared(rows, np.array([0, rows.num_rows]), percent)

    ordered = placed.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return ordered.mapInArrow(compare, "a long, b long")


def _compared(rows: pa.Table, edges: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """What ``_met`` asks for, of each group of rows but the last one, which ``edges`` ends."""
    if not edges[-1]:
        return
    rows = rows.slice(0, int(edges[-1])).combine_chunks()
    band, i, j, block, c, label, n = (rows.column(k).to_numpy() for k in range(7))
    sketches = _registers(rows.column(7).to_pylist())
    bands = band_keys(sketches).view(np.int64)
    sets = rows.column(8) if rows.num_columns > 8 else None
    threshold = percent / 100
    least = int(REGISTERS * (threshold - MARGIN - 0.05))
    for a, b in zip(edges[:-1], edges[1:]):
        across = i[a] != j[a]
        other = np.arange(a, b)[block[a:b] == j[a]]
        pairs = []
        for k in np.arange(a, b)[block[a:b] == i[a]]:
            at = other[(label[other] != label[k]) & (across | (other > k))]
            if len(at):
                at = at[(bands[at] == bands[k]).argmax(1) == (bands[k] == band[k]).argmax()]
                at = at[(sketches[at] == sketches[k]).sum(1) >= least]
                pairs.append(np.stack([np.full(len(at), k), at]))
        if not pairs:
            continue
        x, y = np.concatenate(pairs, 1)
        likely = []
        for k in range(0, len(x), 4096):
            p, q = x[k : k + 4096], y[k : k + 4096]
            larger, smaller = (sketches[p] > sketches[q]).sum(1), (sketches[p] < sketches[q]).sum(1)
            likely.append(likeliest(larger, smaller, n[p].astype(float), n[q].astype(float)) >= threshold - MARGIN)
        keep = np.concatenate([*likely, np.empty(0, bool)])
        x, y = x[keep], y[keep]
        if sets is None:
            found = np.unique(np.concatenate([x, y]))
            yield _pairs(band[found], c[found])
        elif len(x):
            yield _pairs(*_verified(x, y, c, sets, percent))


def _verified(x: np.ndarray, y: np.ndarray, c: np.ndarray, sets: pa.ChunkedArray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the pairs whose full sets are alike enough."""
    own = {int(k): sets[int(k)].values.to_numpy() for k in np.unique(np.concatenate([x, y]))}
    linked = np.zeros(len(x), bool)
    for k, (p, q) in enumerate(zip(x.tolist(), y.tolist())):
        linked[k] = _alike(own[p], own[q], percent)
    return forest(c[x[linked]], c[y[linked]])


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _groups(docs: DataFrame, id: str, text: str, size: int, percent: int) -> DataFrame:
    """id, key, n, component_id for every row, and root, which all rows of a group share (null without words)."""
    threshold = percent / 100
    rows, classes = prepare(docs, id, text, size)
    members = _members(classes)
    stars = stored(
        members.filter("c <> hub").select(F.col("hub").alias("a"), F.col("c").alias("b")).distinct(), "near-stars"
    )
    likely = stored(_likely(stars, classes, threshold), "near-likely")
    nodes = likely.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    links = stored(_linked(likely, _sets(docs, classes, nodes, id, text, size), percent), "near-links")
    more = _across(docs, members, classes, components(links), id, text, size, percent)
    labels = components(links.unionByName(stored(more, "near-more")))

    joined = classes.join(labels, classes.c == labels.node, "left").select(
        "k1", "k2", "n_rows", "least", F.coalesce("root", "c").alias("root")
    )
    joined = stored(joined, "near-components")
    roots = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_classes"))
    per_class = with_group(joined, stored(roots, "near-roots"), ["root"], "n_classes").select("k1", "k2", "n_rows", "component_id", "root")
    grouped = with_group(rows.filter("n > 0"), stored(per_class, "near-per-class"), ["k1", "k2"], "n_rows")
    alone = rows.filter("n = 0").select("id", "key", "n", F.col("id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return grouped.select("id", "key", "n", "component_id", "root").unionByName(alone)


def near_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (the smallest id reachable), kept.

    Words are runs of other bytes than white space, A-Z taken as a-z.  Two documents are linked when their sets
    of ``size``-word shingles have ``percent`` of their union in common, and groups are what links connect.  Texts
    without words, null ones included, are linked with nothing.  A null id is reachable but never the smallest;
    a group of null ids alone has a null component_id and its rows are all kept.  Rows that repeat the
    smallest id of their group are all kept.

    Every bucket is first compared with its least member, which joins groups of copies at the price of
    one comparison for each member; whatever is still apart in a bucket is then compared across.
    """
    return _groups(docs, id, text, size, percent).select(
        quoted("id").alias(id), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def near_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group, by the links of ``near_groups``, and all without words.

    The row with the smallest id stays, a null id being larger than any other; of rows that repeat it, that of the
    smallest hash of id and text, once.  A Bloom filter of the rows that go lets others pass straight through; what it
    may hold is joined with them.
    """
    (key,) = free(docs, "key")
    rows = stored(_groups(docs.select(quoted(id), quoted(text)), id, text, size, percent).filter("n > 0").select("id", "key", "root"), "near-roots-of-rows")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    best = rows.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("size")).select("root", F.col("best.key").alias("best"), "size")
    tagged = with_group(rows, stored(best, "near-best"), ["root"], "size")
    tags = tagged.groupBy("key").agg(F.max(F.col("key") != F.col("best")).alias("goes"), F.count("*").alias("times")).filter("goes OR times > 1")
    tags = stored(tags.select(F.col("key").alias(key), "goes"), "near-gone")
    chosen = bloom.build(tags.select(key), tags.count())
    marked = docs.withColumn(key, F.xxhash64(quoted(id), quoted(text)))
    known = chosen.may_hold(quoted(key))
    asked = marked.filter(known)
    once = asked.join(tags.filter("NOT goes").select(key), key, "left_semi").dropDuplicates([key])
    others = asked.join(tags.select(key), key, "left_anti")
    return marked.filter(~known).unionByName(others.select(*marked.columns)).unionByName(once.select(*marked.columns)).drop(key)
