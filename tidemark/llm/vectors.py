"""Near-duplicate vectors by tiled comparison along principal axes.

Unit vectors are turned onto their principal axes, so that the leading coordinates carry most of a product.
Sorted by label, strip of the first coordinate and second coordinate they are cut into blocks; blocks meet in the
cells of a grid over these two axes, and those whose boxes on the leading axes lie
too far apart are not compared.  Within a tile of two blocks the leading axes are multiplied first: what
the remaining ones can add is at most the product of the remaining norms, and a pair that cannot reach the
threshold with it is dropped before the next axes are read.

Tiles report counts of links per vector and a spanning forest, never the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components, forest
from .shared import free, quoted, stored, with_group

#: Vectors that the axes are fitted on, at most; any axes give the same links.
SAMPLE = 10_000
#: Vectors in a block, at most.
BLOCK = 1024
#: Rows of a tile that are worked on together.
STRIPE = 128
#: Leading axes whose boxes decide which blocks meet.
BOX = 4
#: Least width of a cell on the first two axes.
CELL = 0.05
#: Axes that are read at a time.
STEP = 16
#: Allows for rounding where a bound drops a pair; the links are decided on the given numbers.
SLACK = 1e-9


def _valid(vector: Column, label: Column) -> Column:
    inf = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(raw: np.ndarray) -> np.ndarray:
    raw = raw.astype(np.float64)
    raw = raw / np.abs(raw).max(1, keepdims=True)  # squares neither overflow nor vanish
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes of a sample, for the vectors of its commonest length; others keep their own axes."""
    sample = rows.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).toPandas().vector
    if not len(sample):
        return {}
    size = sample.map(len).mode().iloc[0]
    units = _units(np.array([x for x in sample if len(x) == size]))
    return {int(size): np.linalg.eigh(units.T @ units)[1][:, ::-1].copy()}


def _turned(raw: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    units = _units(raw)
    return units @ axes[raw.shape[1]] if raw.shape[1] in axes else units


def _cell(threshold: float) -> float:
    """Width of a cell: unit vectors that reach the threshold are no further apart on any axis, or it is the least width."""
    return max((2 * (1 - threshold)) ** 0.5, CELL)


def _blocks(classes: DataFrame, axes, kind: str, threshold: float) -> DataFrame:
    """Packed blocks: block, label, size, low and high (the box on the leading axes), c, mult, vectors."""
    width = _cell(threshold)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch.vector.map(len)):
                raw = np.array(part.vector.tolist(), kind)
                packed = [row.tobytes() for row in raw]
                turned = _turned(raw, axes.value)
                strip = np.floor(turned[:, 0] / width).astype(np.int32)
                yield pd.DataFrame(
                    {"c": part.c, "label": part.label, "mult": part["mult"], "size": size, "strip": strip, "second": turned[:, min(1, size - 1)], "packed": packed}
                )

    schema = "c long, label string, mult long, size int, strip int, second double, packed binary"
    placed = stored(classes.select("c", F.col("label").cast("string").alias("label"), "mult", "vector").mapInPandas(place, schema), "vector-places")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            cuts = _cuts(held)
            for a, b in zip(cuts[:-1], cuts[1:-1]):
                yield _packed(held.iloc[a:b])
            held = held.iloc[cuts[-2] :]
        if held is not None and len(held):
            yield _packed(held)

    def _cuts(held: pd.DataFrame) -> list[int]:
        """Where blocks start: at every new label or size, and after so many vectors."""
        new = (held.label != held.label.shift()) | (held["size"] != held["size"].shift())
        starts = np.flatnonzero(new)
        return sorted({k for a, b in zip(starts, [*starts[1:], len(held)]) for k in range(a, b, BLOCK)} | {len(held)})

    def _packed(rows: pd.DataFrame) -> pd.DataFrame:
        size = int(rows["size"].iloc[0])
        data = b"".join(rows.packed)
        turned = _turned(np.frombuffer(data, kind).reshape(-1, size), axes.value)[:, :BOX]
        turned = np.pad(turned, ((0, 0), (0, max(0, BOX - size))))
        return pd.DataFrame(
            {
                "label": [rows.label.iloc[0]], "size": [size], "low": [turned.min(0).tolist()], "high": [turned.max(0).tolist()],
                "c": [rows.c.to_numpy(np.int64).tobytes()], "mult": [rows["mult"].to_numpy(np.int64).tobytes()], "vectors": [data],
            }
        )

    order = ["label", "size", "strip", "second"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    packed = ordered.mapInPandas(pack, "label string, size int, low array<double>, high array<double>, c binary, mult binary, vectors binary")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), "vector-blocks")


def _tiles(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs (i, j) of blocks, i <= j, that may hold a link: their boxes are as near as unit vectors must be.

    Blocks are listed in the cells of the first two axes that their boxes touch, one of the two widened by the distance
    allowed, and joined by cell, so that a frequent label does not bring all pairs of its blocks together.  A pair is
    taken in the first cell that both are in.
    """
    width, reach = _cell(threshold), (2 * (1 - threshold)) ** 0.5 + SLACK
    box = blocks.select("block", "label", "size", "low", "high")

    def listed(k: str, more: float) -> DataFrame:
        named = box.select("label", "size", *[F.col(c).alias(f"{c}_{k}") for c in ("block", "low", "high")])
        for axis in (0, 1):
            first = F.floor((F.col(f"low_{k}")[axis] - more) / width).cast("int")
            last = F.floor((F.col(f"high_{k}")[axis] + more) / width).cast("int")
            named = named.withColumn(f"from_{axis}_{k}", first).withColumn(f"cell_{axis}", F.explode(F.sequence(first, last)))
        return named

    one, two = listed("i", reach), listed("j", 0.0)
    apart = F.lit(0.0)
    for k in range(BOX):
        gap = F.greatest(
            F.col("low_j")[k] - F.col("high_i")[k], F.col("low_i")[k] - F.col("high_j")[k], F.lit(0.0)
        )
        apart = apart + gap * gap
    near = (F.col("block_i") <= F.col("block_j")) & (apart <= 2 * (1 - threshold) + SLACK)
    for axis in (0, 1):
        near = near & (F.col(f"cell_{axis}") == F.greatest(F.col(f"from_{axis}_i"), F.col(f"from_{axis}_j")))
    return one.join(two, ["label", "size", "cell_0", "cell_1"]).filter(near).select(F.col("block_i").alias("i"), F.col("block_j").alias("j"))


def near_pairs(x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of x and y, turned, whose cosine reaches the threshold; with ``same``, each pair once."""
    size = x.shape[1]
    edges = [*range(0, size, STEP), size]
    rest_x, rest_y = (np.sqrt(np.maximum(np.cumsum((z * z)[:, ::-1], 1)[:, ::-1], 0)) for z in (x, y))
    out = []
    for top in range(0, len(x), STRIPE):
        own = x[top : top + STRIPE]
        bound = own[:, :STEP] @ y[:, :STEP].T
        if size > STEP:
            reach = bound + rest_x[top : top + STRIPE, STEP, None] * rest_y[None, :, STEP]
        else:
            reach = bound
        i, j = np.nonzero(reach >= threshold - SLACK)
        if same:
            i, j = i[i + top < j], j[i + top < j]
        total = bound[i, j]
        for a, b in zip(edges[1:], edges[2:]):
            total += np.einsum("ij,ij->i", own[i, a:b], y[j, a:b])
            if b < size:
                keep = total + rest_x[i + top, b] * rest_y[j, b] >= threshold - SLACK
            else:
                keep = total >= threshold - SLACK
            i, j, total = i[keep], j[keep], total[keep]
        i = i + top
        exact = np.einsum("ij,ij->i", raw_x[i], raw_y[j]) >= threshold
        out.append((i[exact], j[exact]))
    return tuple(np.concatenate(z) for z in zip(*out)) if out else (np.empty(0, int), np.empty(0, int))


def _links(blocks: DataFrame, axes, kind: str, threshold: float) -> DataFrame:
    """Per tile: (a, b, null) for a spanning forest of its links, (a, null, n) for the vectors linked with a."""
    data = blocks.select("block", "size", "c", "mult", "vectors")
    one, two = (data.select(F.col("block").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("c", "mult", "vectors")]) for k in "ij")
    tiles = _tiles(blocks, threshold).join(one, "i").join(two, "j").join(data.select(F.col("block").alias("i"), "size"), "i")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for t in batch.itertuples():
                x, y = (np.frombuffer(v, kind).reshape(-1, t.size) for v in (t.vectors_i, t.vectors_j))
                c, d = (np.frombuffer(v, np.int64) for v in (t.c_i, t.c_j))
                m, n = (np.frombuffer(v, np.int64) for v in (t.mult_i, t.mult_j))
                i, j = near_pairs(_turned(x, axes.value), _turned(y, axes.value), _units(x), _units(y), threshold, t.i == t.j)
                count_c = np.bincount(i, n[j], len(c)).astype(np.int64)
                count_d = np.bincount(j, m[i], len(d)).astype(np.int64)
                nodes, counts = np.concatenate([c, d]), np.concatenate([count_c, count_d])
                a, b = forest(c[i], d[j])
                out = pd.DataFrame({"a": np.concatenate([a, nodes[counts > 0]])})
                out["b"] = pd.array([*b, *[None] * int((counts > 0).sum())], "Int64")
                out["n"] = pd.array([*[None] * len(a), *counts[counts > 0]], "Int64")
                yield out

    return tiles.mapInPandas(compare, "a long, b long, n long")


def vector_groups(
    rows: DataFrame, threshold: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per row: id, n_links, component_id (the smallest id reachable by links), kept.

    Vectors are compared if their labels are equal and they have as many components, and linked if their
    cosine in double precision reaches the threshold.  Null labels, null, empty and zero vectors and those with null or
    non-finite components are linked with nothing.  Equal vectors are one class, compared once and
    counted as often as they occur.  A null id is reachable but never the smallest, and a group of null ids has a null
    component_id.  Rows that repeat an id are rows of their own, and are all kept where they have the smallest.  An empty
    table gives an empty result.  Other columns are not looked at.
    """
    return _grouped(rows, threshold, id, vector, label).drop("key").withColumnRenamed("id", id)


def _grouped(rows: DataFrame, threshold: float, id: str, vector: str, label: str) -> DataFrame:
    """id, n_links, component_id, kept, and key, a hash of id, vector and label."""
    spark = rows.sparkSession
    key = F.xxhash64(quoted(id), quoted(vector), quoted(label)).alias("key")
    own = rows.select(quoted(id).alias("id"), quoted(vector).alias("vector"), quoted(label).alias("label"), key)
    valid = _valid(F.col("vector"), F.col("label"))
    good = own.filter(valid)
    classes = stored(
        good.groupBy("label", "vector")
        .agg(F.count("*").alias("mult"), F.min("id").alias("least"))
        .withColumn("c", F.monotonically_increasing_id()),
        "vector-classes",
    )
    kind = "float32" if dict(own.dtypes)["vector"] == "array<float>" else "float64"
    if kind == "float64":
        classes = classes.withColumn("vector", F.col("vector").cast("array<double>"))
        good = good.withColumn("vector", F.col("vector").cast("array<double>"))
    axes = spark.sparkContext.broadcast(_axes(classes))
    links = stored(_links(_blocks(classes, axes, kind, threshold), axes, kind, threshold), "vector-links")
    labels = components(links.filter("b IS NOT NULL").select("a", "b"))
    counts = links.filter("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("others"))
    known = stored(
        classes.join(labels, classes.c == labels.node, "left")
        .join(counts, F.col("c") == F.col("a"), "left")
        .select("label", "vector", "mult", "least", F.coalesce("root", "c").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("mult") - 1).alias("n_links")),
        "vector-known",
    )
    roots = stored(known.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n_classes")), "vector-roots")
    per_class = with_group(known, roots, ["root"], "n_classes").select("label", "vector", "mult", "n_links", "component_id")
    grouped = with_group(good, stored(per_class, "vector-per-class"), ["label", "vector"], "mult").select("id", "n_links", "component_id", "key")
    alone = own.filter(~valid).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), "key")
    return grouped.unionByName(alone).select(
        "id", "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"), "key"
    )


def vector_dedup(rows: DataFrame, threshold: float = 0.98, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The rows that stay, whole: those that ``vector_groups`` keeps, told apart by id, vector and label."""
    (key,) = free(rows, "key")
    gone = _grouped(rows.select(quoted(id), quoted(vector), quoted(label)), threshold, id, vector, label).filter("NOT kept")
    gone = stored(gone.select(F.col("key").alias(key)).distinct(), "vector-gone")
    return rows.withColumn(key, F.xxhash64(quoted(id), quoted(vector), quoted(label))).join(gone, key, "left_anti").drop(key)
