"""Quality classifier from positive and unlabelled texts.

Trusted positives and unlabelled web text are all it learns from.  With the class prior p, the share of
positives in the unlabelled text, the risk of a scorer is

    p E+[loss(g)] + max(0, Eu[loss(-g)] - p E+[loss(-g)])

where the second part, the risk of the negatives, is held at zero from below (non-negative risk estimation).  The
loss is logistic, so the score is the estimated probability of a positive, and the risk is convex: Newton's method
needs a few steps, each of which is one pass over the features of all unlabelled rows that adds up risk, slope and
curvature.
Only the trusted positives are a bounded sample.  The prior is estimated beforehand, from all rows too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bloom import mixed
from .shared import FILES_PER_CORE, drop, free, quoted, short_batches, stored_at
from .words import Words, words

#: Trusted positives that the model is fitted on, at most; unlabelled rows are all used.
SAMPLE = 10_000
#: Buckets of hashed pairs of neighbouring bytes.
PAIRS = 256
_PAIR = (mixed(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(PAIRS)).astype(np.int64)
_SHAPES = 9
#: Bytes in classes: all ASCII by itself, the others by their leading bits.
_CLASS = np.where(np.arange(256) < 128, np.arange(256), 128 + (np.arange(256) >> 3) - 16)
_CLASSES = 144
FEATURES = _SHAPES + _CLASSES + PAIRS
#: Newton steps at most, and the gain of a step below which the fit ends.
STEPS, GAIN = 12, 1e-4
#: How near to zero the negatives' risk is held where it would fall below, and how closely its share is looked for.
ZERO, SHARE = 1e-3, 1 / 64
#: Ridges of the three kinds of features, and the number of positives below which they grow noticeably.
RIDGE = (0.001, 0.01, 0.1)
FEW = 3000


def features(text: Words) -> np.ndarray:
    """Shares of bytes, byte pairs and repeated words of a whole text, and its length; zeros for an empty one."""
    out = np.zeros(FEATURES, np.float32)
    data, n = text.data, len(text.hashes)
    if not len(data):
        return out
    single = np.bincount(data, minlength=256)
    shape = out[:_SHAPES]
    shape[0] = np.log1p(len(data))
    shape[1] = 1
    if n:
        length = text.ends - text.starts
        first = data[text.starts]
        last = data[text.ends - 1]
        different = len(np.unique(text.hashes))
        shape[2] = length.mean() / 10
        shape[3] = (text.hashes[1:] == text.hashes[:-1]).sum() / n
        shape[4] = np.log(n / different)
        shape[5] = ((first >= 65) & (first <= 90)).mean()
        shape[6] = (length == 1).mean()
        shape[7] = (((last >= 33) & (last <= 47)) | (last == 58) | (last == 59) | (last == 63)).mean()
        shape[8] = min(length.max() / 100, 5)
    out[_SHAPES : _SHAPES + _CLASSES] = np.sqrt(np.bincount(_CLASS, single, _CLASSES)[:_CLASSES] / len(data))
    pairs = np.bincount(_PAIR[data[:-1].astype(np.int64) << 8 | data[1:]], minlength=PAIRS)
    out[_SHAPES + _CLASSES :] = np.sqrt(pairs / len(data))
    return out


def _featured(docs: DataFrame, id: str, text: str) -> tuple[DataFrame, str]:
    """Stored rows (id, half, x) with the packed features of every text, and their folder; halves are dealt by a hash."""
    short_batches(docs.sparkSession)
    rows = docs.select(quoted(id).alias("id"), F.pmod(F.xxhash64(F.lit(5), quoted(text)), F.lit(2)).cast("int").alias("half"), quoted(text).alias("text"))
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("x", T.BinaryType())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text).astype(np.float16).tobytes() for text in words(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.binary())], schema.names)

    return stored_at(rows.mapInArrow(make, schema), "quality-features")


def _unpacked(packed: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(packed.to_pylist()), np.float16).reshape(-1, FEATURES).astype(np.float64)


def _added_up(rows: DataFrame, of: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all rows of ``of(x, half)``, an array of ``size`` numbers for a batch of rows.

    Tasks add up their batches and groups of tasks their tasks, so that few arrays reach the driver.
    """
    tasks = FILES_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    groups = max(int(tasks**0.5), 1)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total += of(_unpacked(batch.column(1)), batch.column(0).to_numpy())
                some = True
        if some:
            part = TaskContext.get().partitionId() % groups
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "total"])

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size)
        for part in parts.total:
            total += np.frombuffer(part)
        return pd.DataFrame({"part": parts.part.iloc[:1], "total": [total.tobytes()]})

    sums = rows.select("half", "x").coalesce(tasks).mapInArrow(add, "part int, total binary")
    sums = sums.repartition(groups, "part").groupBy("part").applyInPandas(merge, "part int, total binary").collect()
    return sum((np.frombuffer(r.total) for r in sums), np.zeros(size))


def in_fold(id: Column) -> Column:
    """Rows that labels may be learnt from; the others are held out.  A null id is not held out."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 != 1, F.lit(True))


def positives(rows: DataFrame, labels: DataFrame, size: int) -> np.ndarray:
    """Features of up to ``size`` trusted positives from outside the held-out fold, chosen by a hash of their id.

    The chosen ids, of which there are at most ``size``, are broadcast.
    """
    order = F.xxhash64(F.lit(17), F.col("id"))
    trusted = labels.filter("quality = 1").select(F.col("doc_id").alias("id")).filter(in_fold(F.col("id")) & F.col("id").isNotNull()).distinct()
    chosen = rows.join(F.broadcast(trusted.orderBy(order, "id").limit(size)), "id").orderBy(order, "id", F.xxhash64("x")).limit(size)
    packed = b"".join(r.x for r in chosen.select("x").collect())
    return np.frombuffer(packed, np.float16).reshape(-1, FEATURES).astype(np.float32)


class Model:
    """Scores of texts between 0 and 1."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weight: np.ndarray, bias: float, prior: float):
        self.mean, self.scale, self.weight, self.bias, self.prior = mean, scale, weight, bias, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) * self.scale, -8, 8)
        return 1 / (1 + np.exp(-(z @ self.weight + self.bias)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def levels_of(positive: np.ndarray) -> np.ndarray:
    """Thresholds that keep a tenth of the positives or more."""
    return np.quantile(positive, np.linspace(0.0, 0.9, 46))


def estimated_prior(positive: np.ndarray, above: np.ndarray, n: int) -> float:
    """The largest share of positives that the scores of positives and unlabelled rows allow.

    ``above`` counts those of the ``n`` unlabelled rows that reach each of ``levels_of(positive)``.  Above any threshold
    they hold at least prior times what the positives hold, so the prior is at most the least quotient
    of both, taken with one standard error.  It is 1/n at least.
    """
    p = np.array([(positive >= t).mean() for t in levels_of(positive)])
    u = above / n
    error = np.sqrt(u * (1 - u) / n + u * u * (1 - p) / p / len(positive))
    return float(np.clip(((u + error) / p).min(), 1 / n, 0.99))


class _Unlabelled:
    """Sums over all unlabelled rows, standardised: every method is one pass over them."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        sums = _added_up(rows, lambda x, half: np.concatenate([[len(x), (half == 0).sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * FEATURES)
        self.n, self.of_half = int(sums[0]), np.array([sums[1], sums[0] - sums[1]])
        self.mean = sums[2 : 2 + FEATURES] / max(self.n, 1)
        spread = np.sqrt(np.maximum(sums[2 + FEATURES :] / max(self.n, 1) - self.mean**2, 0))
        self.scale = np.where(spread > 1e-4, 1 / np.maximum(spread, 1e-4), 0)

    def risks(self, weights: list[np.ndarray], halves: list[int | None]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Mean softplus of the scores by each of the weights over its half (or all rows), its slope and curvature."""
        mean, scale, n = self.mean, self.scale, FEATURES + 1
        size = 1 + n + n * n

        def of(x: np.ndarray, half: np.ndarray) -> np.ndarray:
            z, out = ready(x, mean, scale), []
            for w, own in zip(weights, halves):
                part = z if own is None else z[half == own]
                g = part @ w
                s = _sigmoid(g)
                narrow = (part * np.sqrt(s * (1 - s))[:, None]).astype(np.float32)  # curvature only sets the steps
                out += [[_softplus(g).sum()], part.T @ s, (narrow.T @ narrow).ravel()]
            return np.concatenate(out)

        sums = _added_up(self.rows, of, size * len(weights)).reshape(len(weights), size)
        many = [max(self.n if own is None else self.of_half[own], 1) for own in halves]
        return [(t[0] / m, t[1 : 1 + n] / m, t[1 + n :].reshape(n, n) / m) for t, m in zip(sums, many)]

    def above(self, weights: list[np.ndarray], levels: list[np.ndarray]) -> np.ndarray:
        """For each half the number of its rows whose scores by its weights reach its levels."""
        mean, scale = self.mean, self.scale

        def of(x: np.ndarray, half: np.ndarray) -> np.ndarray:
            z = ready(x, mean, scale)
            return np.concatenate([((z[half == k] @ weights[k])[:, None] >= levels[k]).sum(0) for k in (0, 1)])

        return _added_up(self.rows, of, sum(map(len, levels))).reshape(2, -1)


def ready(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features and a one."""
    return np.hstack([np.clip((x - mean) * scale, -8, 8), np.ones((len(x), 1))])


class _Positives:
    """Features of the trusted positives; standardised piece by piece, so that the driver holds them once."""

    def __init__(self, x: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        self.x, self.mean, self.scale = x, mean, scale

    def pieces(self) -> Iterator[np.ndarray]:
        for k in range(0, len(self.x), 1000):
            yield ready(self.x[k : k + 1000].astype(np.float64), self.mean, self.scale)

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.concatenate([z @ w for z in self.pieces()])

    def mean_of(self) -> np.ndarray:
        return sum(z.sum(0) for z in self.pieces()) / len(self.x)

    def risk(self, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean softplus of the negated scores, its slope and curvature."""
        value, slope, bend = 0.0, 0.0, 0.0
        for z in self.pieces():
            g = z @ w
            s = _sigmoid(-g)
            value, slope, bend = value + _softplus(-g).sum(), slope - z.T @ s, bend + (z * (s * (1 - s))[:, None]).T @ z
        return value / len(self.x), slope / len(self.x), bend / len(self.x)


def _apart(p: list[_Positives], unlabelled: _Unlabelled, keep: np.ndarray) -> list[np.ndarray]:
    """For each half the weights that tell its positives from its unlabelled rows; both fits share their passes."""
    n = len(keep)
    w, step, risk, done = [np.zeros(n)] * 2, [np.zeros(n)] * 2, [np.inf] * 2, [False] * 2
    for _ in range(STEPS):
        tried = [a + b for a, b in zip(w, step)]
        for k, (value, slope, bend) in enumerate(unlabelled.risks(tried, [0, 1])):
            if done[k]:
                continue
            own, own_slope, own_bend = p[k].risk(tried[k])
            value += own + keep @ tried[k] ** 2 / 2
            if value > risk[k]:  # too far
                step[k] = step[k] / 2
                continue
            done[k] = risk[k] - value < GAIN
            w[k], risk[k] = tried[k], value
            step[k] = -np.linalg.solve(bend + own_bend + np.diag(keep + 1e-9), slope + own_slope + keep * w[k])
        if all(done):
            break
    return w


def _least_risk(p: _Positives, prior: float, unlabelled: _Unlabelled, keep: np.ndarray) -> np.ndarray:
    """The weights of least non-negative risk.

    That risk is the greater of two convex ones: f, with the risk of the negatives, and h, without it.  Where the least
    of f has negatives of no less than zero, it is the least of both.  Otherwise the least of both lies where the
    risk of the negatives is zero, at the least of a mean of f and h, whose share is found by halving.
    """
    n, mean = len(keep), p.mean_of()

    def least_mean(share: float, w: np.ndarray) -> tuple[np.ndarray, float, float]:
        """The least of share f + (1 - share) h, from w on, its negatives and its non-negative risk."""
        step, risk, found = np.zeros(n), np.inf, None
        for _ in range(STEPS):
            tried = w + step
            ((value, slope, bend),) = unlabelled.risks([tried], [None])
            own, own_slope, own_bend = p.risk(tried)
            h = prior * own + keep @ tried**2 / 2
            negatives = value - prior * (own + mean @ tried)  # softplus(g) = softplus(-g) + g
            total = h + share * negatives
            if total > risk:  # too far
                step = step / 2
                continue
            gain, w, risk, found = risk - total, tried, total, (tried, negatives, h + max(negatives, 0))
            if gain < GAIN:
                break
            slope = share * (slope - prior * mean) + (1 - share) * prior * own_slope + keep * w
            bend = share * bend + (1 - share) * prior * own_bend
            step = -np.linalg.solve(bend + np.diag(keep + 1e-9), slope)
        return found

    w, negatives, risk = least_mean(1.0, np.zeros(n))
    best, low, high, start = (risk, w), 0.0, 1.0, w
    while (negatives < 0 or high < 1) and abs(negatives) > ZERO and high - low > SHARE:
        share = (low + high) / 2
        start, negatives, risk = least_mean(share, start)
        best = min(best, (risk, start), key=lambda x: x[0])
        low, high = (low, share) if negatives < 0 else (share, high)
    return best[1]


def fit(positive: np.ndarray, unlabelled: _Unlabelled, ridge: tuple[float, float, float] = RIDGE) -> Model:
    """The model of least non-negative risk.  Without any positive or unlabelled text every score is 0.5.

    ``ridge`` holds down the weights of shapes, bytes and byte pairs: the finer a feature, the more; and the fewer
    positives there are, the more.
    """
    if not len(positive) or not unlabelled.n:
        return Model(np.zeros(FEATURES), np.zeros(FEATURES), np.zeros(FEATURES), 0.0, 0.5)
    p = _Positives(positive, unlabelled.mean, unlabelled.scale)
    keep = np.append(np.repeat(ridge, (_SHAPES, _CLASSES, PAIRS)), 0) * (1 + FEW / len(positive))
    # the prior is read from scores of texts that their scorer has not seen
    if len(positive) > 1 and unlabelled.of_half.min() > 0:
        halves = [_Positives(positive[k::2], p.mean, p.scale) for k in (0, 1)]
        others = _apart(halves, unlabelled, keep)[::-1]
        scores = [h.scores(w) for h, w in zip(halves, others)]
        above = unlabelled.above(others, [levels_of(s) for s in scores])
        prior = float(np.mean([estimated_prior(s, a, int(n)) for s, a, n in zip(scores, above, unlabelled.of_half)]))
    else:
        prior = 0.5
    w = _least_risk(p, prior, unlabelled, keep)
    return Model(unlabelled.mean, unlabelled.scale, w[:-1], float(w[-1]), prior)


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", size: int = SAMPLE) -> Model:
    """A model fitted on up to ``size`` trusted positives and on all of ``docs`` as unlabelled texts.

    Only labels outside the held-out fold are read.  Features of all texts are made once and stored until the fit is done.
    """
    rows, path = _featured(docs, id, text)
    model = fit(positives(rows, labels, size), _Unlabelled(rows))
    drop(docs.sparkSession, path)
    return model


def with_score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score for every whole text, null and empty ones included; a column of that name is replaced."""
    short_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != score.lower()]
    from_column, at = [docs.columns.index(c) for c in kept], docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(score, T.DoubleType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            x = [features(text) for text in words(batch.column(at))]
            scores = model.score(np.array(x, np.float64).reshape(len(x), FEATURES))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in from_column), pa.array(scores, pa.float64())], [*kept, score])

    return docs.mapInArrow(judge, schema)


def keep_good(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose texts score ``least`` or more."""
    (score,) = free(docs, "score")
    return with_score(docs, model, text, score).filter(quoted(score) >= least).drop(score)
