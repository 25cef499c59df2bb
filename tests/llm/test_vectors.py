import math

import numpy as np
import pytest

from tests.llm.conftest import bag
from tidemark.llm import vectors
from tidemark.llm.vectors import near_pairs, vector_dedup, vector_groups


def brute(rows, threshold=0.98):
    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    links = [set() for _ in rows]
    units = [np.array(v, float) / np.abs(v).max() if usable(v, label) else None for _, v, label in rows]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    for a in range(n):
        for b in range(a):
            if units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]):
                if units[a] @ units[b] >= threshold:
                    links[a].add(b)
                    links[b].add(a)
    out, seen = [None] * n, set()
    for a in range(n):
        if a not in seen:
            group, todo = set(), [a]
            while todo:
                x = todo.pop()
                if x not in group:
                    group.add(x)
                    todo += links[x]
            seen |= group
            least = min((rows[x][0] for x in group if rows[x][0] is not None), default=None)
            for x in group:
                out[x] = (rows[x][0], len(links[x]), least, rows[x][0] == least)
    return out


def check(spark, rows, kind="float"):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"vec_id long, embedding array<{kind}>, label int, n_links int, root string")
    if kind == "float":
        rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    found = vector_groups(df.repartition(3))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert bag(found.collect()) == bag(brute(rows))


ODD = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [0.0, 0.0], 1),
    (8, [1.0, None], 1), (9, [math.nan, 1.0], 1), (10, [math.inf, 1.0], 1), (11, [], 1), (12, [1.0, 0.0, 0.0], 1), (13, [-1.0, 0.0], 1),
    (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1), (14, [1e-30, 1e-31], 1), (1, [1.0, 0.0], 1), (15, [1.0, 0.19], 1), (16, [1.0, -0.19], 1),
]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_odd_rows(spark, kind):
    rows = ODD + ([(17, [1e-200, 0.0], 1), (18, [1e200, 1e190], 1)] if kind == "double" else [])
    check(spark, rows, kind)


@pytest.mark.parametrize("size,block", [(3, 8), (40, 16), (64, 1024)])
def test_clusters(spark, monkeypatch, size, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(6, size))
    rows = []
    for i in range(240):
        v = centres[i % 6] + rng.normal(size=size) * rng.choice([0.02, 0.1, 1.0]) * np.linalg.norm(centres[i % 6]) / math.sqrt(size)
        rows.append((i, v.tolist(), int(i % 3 == 0)))
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(0, 90, 3)]
    check(spark, rows)


def test_no_pair_is_lost_or_made_up():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 50))
    x, y = (np.repeat(base, 10, 0) + rng.normal(size=(200, 50)) * 0.14 for _ in range(2))
    x, y = (z / np.linalg.norm(z, axis=1, keepdims=True) for z in (x, y))
    turn = np.linalg.qr(rng.normal(size=(50, 50)))[0]
    i, j = near_pairs(x @ turn, y @ turn, x, y, 0.98, False)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(x @ y.T >= 0.98))))
    i, j = near_pairs(x @ turn, x @ turn, x, x, 0.98, True)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(np.triu(x @ x.T >= 0.98, 1)))))


def test_nothing_and_what_stays(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_groups(empty).count() == 0
    rows = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [0.0, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    left = vector_dedup(rows)
    assert left.schema == rows.schema and sorted(r.vec_id for r in left.collect()) == [1, 3]


def test_rows_that_repeat_an_id_are_told_apart(spark):
    rows = [(3, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (5, [0.0, 1.0], 1), (5, [1.0, 0.0], None), (None, [1.0, 0.0], 2), (None, [1.0, 0.0], 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, key string").repartition(3)
    left = vector_dedup(df)
    assert left.schema == df.schema
    assert bag(tuple(r)[:3] for r in left.collect()) == bag([rows[0], *rows[2:]])
    assert vector_dedup(df.limit(0)).count() == 0


def test_blocks_meet_by_cell(spark):
    """Every two blocks whose boxes are near enough meet once, and no others."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(120):
        at = rng.uniform(-1, 1, vectors.BOX)
        side = rng.choice([0.01, 0.1, 0.5], vectors.BOX)
        rows.append((k, str(k % 2), 64, (at - side).tolist(), (at + side).tolist()))
    blocks = spark.createDataFrame(rows, "block long, label string, size int, low array<double>, high array<double>")
    for threshold in (0.98, 0.5, 0.9999):
        found = [(r.i, r.j) for r in vectors._tiles(blocks, threshold).collect()]
        expected = set()
        for a, la, _, low_a, high_a in rows:
            for b, lb, _, low_b, high_b in rows[a:]:
                gaps = np.maximum(np.maximum(np.array(low_b) - high_a, np.array(low_a) - high_b), 0)
                if la == lb and (gaps**2).sum() <= 2 * (1 - threshold) + 1e-9:
                    expected.add((a, b))
        assert len(found) == len(set(found)) and set(found) == expected
