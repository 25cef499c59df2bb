"""Centroid clustering in whole numbers, with bounds that spare most distances.

Lloyd's rounds over vectors of integers: assign to the nearest centroid, replace centroids by the floor of their mean.
Each vector keeps an upper bound of the distance to its own centroid and a lower bound of that to all others.  When
centroids move, the upper bound grows by the way its own went.  The lower bound need not fall by the whole way of
another centroid: all vectors of a cluster lie in a sphere around its centroid, whose radius is the greatest upper
bound, and over that sphere the distance to a centroid that moves from p to q falls most in the plane of p, q and
the sphere's centre.  There

    |x-p| - |x-q|  =  2 d s / (|x-p| + |x-q|)  <=  d s / |x-m|  =  d cos(angle at m between q-p and x-m)

with d = |q-p|, m halfway between p and q, and s the part of x-m along q-p; so the fall is at most d times the cosine of
the angle between q-p and the sphere's centre less the angle that the sphere fills, seen from m, and nothing where
that is a right angle or more.  A vector whose upper bound stays below its lower bound keeps its centroid unseen; the others are
scanned against all centroids in exact integers.

Rounds write the vectors in packed blocks with their bounds, and the round before is removed then.  Clusters report sums of
the vectors that moved, counts and radii, so what reaches the driver depends on the number of clusters alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import drop, quoted, short_batches, stored, stored_at

#: Vectors in a block, at most.
BLOCK = 4096
#: Greatest component, so that a squared distance of 64 of them fits 64 bits.
LARGEST = 1 << 27
TOO_LARGE = f"a component beyond {LARGEST} in whole numbers: squared distances would not fit 64 bits"
#: Allows for rounding of bounds, which are doubles.
SLACK = 1e-9
_BLOCK = "ids binary, known binary, vectors binary, own binary, upper binary, lower binary"
_REPORT = "cluster int, place int, moved long, many long, radius double"


def usable(vector: Column, size: int) -> Column:
    """Vectors of ``size`` components, none of them null or not finite."""
    inf = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances; ``vectors`` are whole numbers."""
    apart = vectors - centroid
    if np.abs(apart).max(initial=0) < 1 << 20:
        apart = apart.astype(np.float64)  # sums of up to 2^12 squares stay below 2^53
        return np.einsum("ij,ij->i", apart, apart).astype(np.int64)
    return np.einsum("ij,ij->i", apart, apart)


def scanned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid (of equally near ones the first), the squared distance, and that to the nearest other one."""
    best = np.zeros(len(vectors), np.int64)
    first = squared(vectors, centroids[0])
    second = np.full(len(vectors), np.iinfo(np.int64).max)
    for k in range(1, len(centroids)):
        found = squared(vectors, centroids[k])
        nearer = found < first
        second = np.where(nearer, first, np.minimum(second, found))
        best[nearer], first = k, np.where(nearer, found, first)
    return best, first, second


def falls(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster the most that the distance from a vector in it to any other centroid can have fallen."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    out = np.zeros(len(old))
    for i, (centre, r) in enumerate(zip(old, radius)):
        if r < 0:
            continue  # no vector
        for j in range(len(old)):
            d = float(np.linalg.norm(new[j] - old[j]))
            if i != j and d:
                out[i] = max(out[i], d * _cosine(centre - (old[j] + new[j]) / 2, (new[j] - old[j]) / d, r))
    return out


def _cosine(to_centre: np.ndarray, way: np.ndarray, radius: float) -> float:
    """The greatest cosine of the angle with ``way`` of any point in the sphere, none below 0."""
    reach = float(np.linalg.norm(to_centre))
    if reach <= radius * (1 + SLACK):
        return 1.0
    along = float(to_centre @ way)
    angle = math.atan2(math.sqrt(max(reach * reach - along * along, 0.0)), along) - math.asin(radius / reach) - 1e-7
    return max(math.cos(max(angle, 0.0)), 0.0)


def _narrow(vectors: np.ndarray) -> bytes:
    """The numbers in the fewest bytes that hold them all, with that many in front."""
    top = np.abs(vectors).max(initial=0)
    kind = np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64
    return bytes([np.dtype(kind).itemsize]) + vectors.astype(kind).tobytes()


def _wide(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(packed[1:], f"i{packed[0]}").astype(np.int64).reshape(-1, size)


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, numbers) in blocks without bounds."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a in range(0, len(batch), BLOCK):
                part = batch.iloc[a : a + BLOCK]
                vectors = np.array(part.numbers.tolist(), np.float64)
                if np.abs(vectors).max() > LARGEST:
                    raise ValueError(TOO_LARGE)
                known = part.id.notna().to_numpy()
                n = len(part)
                yield pd.DataFrame(
                    {
                        "ids": [part.id.fillna(0).to_numpy(np.int64).tobytes()], "known": [known.tobytes()], "vectors": [_narrow(vectors)],
                        "own": [np.full(n, -1, np.int32).tobytes()], "upper": [np.full(n, np.inf).tobytes()], "lower": [np.zeros(n).tobytes()],
                    }
                )

    return rows.mapInPandas(pack, _BLOCK)


def _round(blocks: DataFrame, centroids, drift, fall, size: int) -> DataFrame:
    """The blocks after vectors went to the nearest of ``centroids``, which moved by ``drift`` since the last time."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, moved, fell = centroids.value, drift.value, fall.value
        for batch in batches:
            for block in batch.to_pylist():
                own = np.frombuffer(block["own"], np.int32).copy()
                upper, lower = (np.frombuffer(block[c], np.float64).copy() for c in ("upper", "lower"))
                if len(own) and own[0] >= 0:
                    upper = (upper + moved[own]) * (1 + SLACK)
                    lower = np.maximum(lower - fell[own], 0) * (1 - SLACK)
                before = own.copy()
                vectors = None
                open_ = np.flatnonzero(upper >= lower)
                if len(open_):
                    vectors = _wide(block["vectors"], size)
                    placed = open_[own[open_] >= 0]
                    for k in np.unique(own[placed]):  # the own centroid first, which settles most
                        of_k = placed[own[placed] == k]
                        upper[of_k] = np.sqrt(squared(vectors[of_k], at[k]).astype(np.float64)) * (1 + SLACK)
                    open_ = open_[upper[open_] >= lower[open_]]
                if len(open_):
                    best, first, second = scanned(vectors[open_], at)
                    own[open_] = best
                    upper[open_] = np.sqrt(first.astype(np.float64)) * (1 + SLACK)
                    lower[open_] = np.sqrt(second.astype(np.float64)) * (1 - SLACK)
                yield pa.RecordBatch.from_pylist(
                    [{**block, "own": own.tobytes(), "upper": upper.tobytes(), "lower": lower.tobytes(), "was": before.tobytes(), "n_scanned": len(open_)}],
                    pa.schema([*((f, pa.binary()) for f in ("ids", "known", "vectors", "own", "upper", "lower", "was")), ("n_scanned", pa.int64())]),
                )

    return blocks.mapInArrow(assign, f"{_BLOCK}, was binary, n_scanned long")


def _report(blocks: DataFrame, k: int, size: int) -> list:
    """Per cluster: how its sums changed by component, its number of vectors, and the greatest upper bound."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        sums, many, radius = np.zeros((k, size), np.int64), np.zeros(k, np.int64), np.full(k, -1.0)
        rows = 0
        for batch in batches:
            for block in batch.to_pylist():
                own, was = (np.frombuffer(block[c], np.int32) for c in ("own", "was"))
                many += np.bincount(own, minlength=k)
                np.maximum.at(radius, own, np.frombuffer(block["upper"], np.float64))
                changed = np.flatnonzero(own != was)
                if len(changed):
                    vectors, to, come = _wide(block["vectors"], size)[changed], own[changed], was[changed]
                    for c in range(k):
                        sums[c] += vectors[to == c].sum(0) - vectors[come == c].sum(0)
                    rows += len(changed)
                if rows * LARGEST > 1 << 61:
                    yield from _rows(sums, many, radius)
                    sums, many, rows = np.zeros_like(sums), np.zeros_like(many), 0
        yield from _rows(sums, many, radius)

    def _rows(sums: np.ndarray, many: np.ndarray, radius: np.ndarray) -> Iterator[pa.RecordBatch]:
        c, place = np.nonzero(sums)
        seen = np.flatnonzero(many)
        none = [None] * len(c)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*c, *seen], pa.int32()), pa.array([*place, *[-1] * len(seen)], pa.int32()), pa.array([*sums[c, place], *[None] * len(seen)], pa.int64()),
                pa.array([*none, *many[seen]], pa.int64()), pa.array([*none, *radius[seen]], pa.float64()),
            ],
            ["cluster", "place", "moved", "many", "radius"],
        )

    rows = blocks.select("own", "was", "upper", "vectors").mapInArrow(add, _REPORT)
    exact = F.sum(F.col("moved").cast("decimal(38,0)")).alias("moved")
    return rows.groupBy("cluster", "place").agg(exact, F.sum("many").alias("many"), F.max("radius").alias("radius")).collect()


def _start(rows: DataFrame, k: int, seed: int, size: int) -> list[list[int]]:
    """The ``k`` vectors of smallest hash of ``seed:id``, in that order."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    hashed = rows.withColumn("hash", F.sha2(named.cast("binary"), 256))
    return [[_whole(x) for x in r.numbers] for r in hashed.orderBy("hash", "numbers").limit(k).collect()]


def _whole(x: float) -> int:
    if abs(x) > LARGEST:
        raise ValueError(TOO_LARGE)
    return int(x)


def cluster(
    rows: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3, id: str = "vec_id", vector: str = "embedding",
    scans: list | None = None,
) -> tuple[DataFrame, list[list[int]]]:
    """Clusters of the vectors, (id, cluster, distance), and the final centroids.

    Kept are vectors of exactly ``size`` components, none null or non-finite; each component x becomes
    ``floor(scale x)``.  Centroids start as the ``k`` kept vectors with the smallest SHA-256 of ``seed:id`` (fewer if there are
    fewer; of vectors that repeat an id the smaller first; a null id counts as an empty one).  Each round takes every
    vector to the nearest centroid by squared distance, the smaller number on a tie, and then replaces every centroid
    that has vectors by the floor of their mean in each component.  After the rounds vectors are assigned once more;
    ``distance`` is the squared one.  Rows that repeat are clustered each.  No kept vector gives an empty result and no
    centroids.  A component beyond 2^27 after scaling is an error.  Other columns are not looked at.

    ``scans``, if given, gets the number of vectors that each round had to scan.
    """
    spark = rows.sparkSession
    short_batches(spark)
    own = rows.select(quoted(id).cast("long").alias("id"), quoted(vector).alias("vector")).filter(usable(F.col("vector"), size))
    numbers = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    own = own.select("id", numbers.alias("numbers"))
    centroids = np.array(_start(own, k, seed, size), np.int64).reshape(-1, size)
    if not len(centroids):
        return spark.createDataFrame([], "id long, cluster int, distance long").withColumnRenamed("id", id), []
    blocks, path = stored_at(_packed(own, size), "cluster-blocks")
    sums, drift, fall = np.zeros(centroids.shape, object), np.zeros(len(centroids)), np.zeros(len(centroids))
    for turn in range(rounds + 1):
        shared = [spark.sparkContext.broadcast(x) for x in (centroids, drift, fall)]
        after, new_path = stored_at(_round(blocks, *shared, size), "cluster-blocks")
        drop(spark, path)
        path = new_path
        for one in shared:
            one.destroy()
        if scans is not None:
            scans.append(after.agg(F.sum("n_scanned")).first()[0])
        blocks = after.drop("was", "n_scanned")
        if turn < rounds:
            many, radius = np.zeros(len(centroids), object), np.full(len(centroids), -1.0)
            for r in _report(after, len(centroids), size):
                if r.place < 0:
                    many[r.cluster], radius[r.cluster] = r.many, r.radius
                else:
                    sums[r.cluster, r.place] += int(r.moved)
            new = np.array([[s // n for s in own] if n else c for own, n, c in zip(sums.tolist(), many.tolist(), centroids.tolist())], np.int64)
            drift = np.linalg.norm((new - centroids).astype(np.float64), axis=1)
            fall = falls(centroids, new, radius)
            centroids = new
    found = _distances(spark, blocks, centroids, size)
    drop(spark, path)
    return found.withColumnRenamed("id", id), centroids.tolist()


def _distances(spark: SparkSession, blocks: DataFrame, centroids: np.ndarray, size: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(centroids)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                own = np.frombuffer(block["own"], np.int32)
                apart = _wide(block["vectors"], size) - shared.value[own]
                ids = pa.array(np.frombuffer(block["ids"], np.int64), mask=~np.frombuffer(block["known"], bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(own), pa.array(np.einsum("ij,ij->i", apart, apart))], ["id", "cluster", "distance"])

    found = blocks.select("ids", "known", "vectors", "own").mapInArrow(unpack, "id long, cluster int, distance long")
    return stored(found, "cluster-distances")


def cluster_report(
    rows: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``cluster`` with cluster_inertia and inertia (distance summed over the cluster and over all) and centroid_sha256.

    The digest is the lower-case hex SHA-256 of the final centroid's components in decimal, joined by commas.
    """
    found, centroids = cluster(rows, k, rounds, size, scale, seed, id, vector)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    spark = rows.sparkSession
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()  # a row per centroid
    all_of = sum(r.cluster_inertia for r in sums)
    facts = [(r.cluster, r.cluster_inertia, all_of, digests[r.cluster]) for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(quoted(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
