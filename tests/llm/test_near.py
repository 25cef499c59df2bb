from collections import Counter, defaultdict
from itertools import combinations
from math import comb

import numpy as np
import pytest
from pyspark.sql.classic.dataframe import DataFrame

from tests.llm.conftest import THUE_MORSE, WORD, bag
from tidemark.llm import components as component_module
from tidemark.llm import near
from tidemark.llm.components import components, forest
from tidemark.llm.near import band_keys, likeliest, merged, near_dedup, near_groups, sketch

LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size, percent=80):
    """(id, n, component, kept) for (id, text) rows, by all pairs of different sets."""
    classes = defaultdict(list)
    for i, text in rows:
        classes[shingle_set(text, size)].append(i)
    sets = [s for s in classes if s]
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for a, b in combinations(sets, 2):
        both = len(a & b)
        if 100 * both >= percent * (len(a) + len(b) - both):
            root[find(a)] = find(b)
    least = {}
    for s in sets:
        for i in classes[s]:
            if i is not None:
                least[find(s)] = min(i, least.get(find(s), i))
    out = []
    for i, text in rows:
        s = shingle_set(text, size)
        c = least.get(find(s)) if s else i
        out.append((i, len(s), c, i == c))
    return out


def check(docs, size):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = near_groups(docs, size=size)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    expected = brute(rows, size)
    assert bag(found.collect()) == bag(expected)
    return expected


@pytest.mark.parametrize("size", [2, 5])
def test_odd_rows(odd_docs, size):
    check(odd_docs, size)


def test_documents(documents):
    expected = check(documents, 2)
    assert sum(not kept for *_, kept in expected) > 10


def words(*numbers):
    return " ".join(f"w{n}" for n in numbers)


def test_chains_and_the_threshold(docs_of):
    """Exactly 80 % is a link; chains of links are one group; case and white space do not matter."""
    base = list(range(100))
    texts = [words(*base[k : k + 91]) for k in range(0, 10)]  # neighbours differ by one shingle at either end
    texts += [words(*range(1000, 1010)), words(*range(1000, 1009)), words(*range(1000, 1008))]
    texts += ["The  Cat sat\tON", "the cat SAT on", "x", "X", "", None, " "]
    check(docs_of(*texts), 2)


def test_a_large_group_of_near_copies_and_outsiders(spark, monkeypatch):
    """A third of the rows are near copies; others share many of their shingles but are no links."""
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = np.random.default_rng(1)
    texts = []
    for k in range(360):
        own = list(range(60))
        if k % 3 == 0:
            own[int(rng.integers(60))] = 1000 + k
        elif k % 3 == 1:
            for _ in range(int(rng.integers(3, 9))):
                own[int(rng.integers(60))] = 1000 + k
        else:
            own = [int(x) for x in rng.integers(5000, 9000, 40)]
        texts.append((k, words(*own)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    expected = check(docs, 2)
    assert max(Counter(c for _, _, c, _ in expected).values()) >= 120


@pytest.mark.parametrize("copies", [200, 800])
def test_a_large_component_meets_only_the_others(spark, monkeypatch, copies):
    """Rows for the blocks grow with a group, not with its square; few blocks of others meet all of its members."""
    monkeypatch.setattr(near, "BLOCK", 16)
    per_label = spark.createDataFrame([(1, 5, copies, 0), *((1, 100 + k, 1, 0) for k in range(12)), (2, 5, 40, 0)], "band long, label long, n_rows long, elements long")
    (bucket,) = near._blocks(per_label).collect()
    assert (bucket.band, bucket.size, bucket.most) == (1, copies + 12, 5)
    assert (bucket.mains, bucket.rests) == (-(-copies // 16), 1)
    (even,) = near._blocks(spark.createDataFrame([(3, k, 1, 0) for k in range(50)], "band long, label long, n_rows long, elements long")).collect()
    assert (even.mains, even.rests) == (0, 4)
    sketches = [near.sketch(np.arange(k, k + 3, dtype=np.uint64)).tobytes() for k in range(copies + 12)]
    rows = [(1, k, 5 if k < copies else 100 + k, 3, sketches[k], 5, bucket.mains, bucket.rests) for k in range(copies + 12)]
    made = spark.createDataFrame(rows, "band long, c long, label long, n long, sketch binary, most long, mains int, rests int")
    plan, met = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda df, *by: plan.append(df.collect()) or met(df, *by))
    near._met(made, 80, None)
    held = [(r.i, r.j, r.block, r.c) for r in plan[0]]
    assert len(held) == copies + 12 * (bucket.mains + 1)
    meet = {}
    for i, j, block, c in held:
        meet.setdefault((i, j), set()).add(c)
    others = set(range(copies, copies + 12))
    assert all(others <= own for own in meet.values()) and set().union(*meet.values()) == set(range(copies + 12))


def test_words_of_equal_polynomial_hash_are_not_equal(docs_of):
    check(docs_of(*THUE_MORSE, *(f"{t} x {t}" for t in THUE_MORSE), THUE_MORSE[0].upper()), 2)


def test_rows_that_stay(odd_docs, documents, no_docs):
    for docs in (odd_docs, documents):
        left = near_dedup(docs, size=2)
        assert left.schema == docs.schema
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        with_words = [(i, t) for i, t in rows if shingle_set(t, 2)]
        without = [(i, t) for i, t in rows if not shingle_set(t, 2)]
        numbered = [(10**9 if i is None else i, t) for i, t in with_words]
        least = {c for *_, c, _ in brute(numbered, 2)}
        got = [(10**9 if r.doc_id is None else r.doc_id, r.text) for r in left.collect()]
        assert bag(x for x in got if shingle_set(x[1], 2)) == bag({(i, t) for i, t in numbered if i in least} & set(got)) and {
            i for i, t in got if shingle_set(t, 2)
        } == least
        assert bag((None if i == 10**9 else i, t) for i, t in got if not shingle_set(t, 2)) == bag(without)
    assert near_groups(no_docs).count() == 0 and near_dedup(no_docs).count() == 0


def test_one_row_stays_of_null_ids_and_of_repeated_ones(spark):
    a, b = words(*range(40)), words(*range(41))
    rows = [(None, a), (None, b), (7, words(*range(100, 140))), (7, words(*range(100, 141))), (7, words(*range(100, 141))), (9, words(*range(100, 140))), (None, None)]
    left = near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), size=2).collect()
    assert sorted(str(r.doc_id) for r in left) == ["7", "None", "None"]


def test_few_jobs_with_many_partitions(spark, documents):
    """One job for each filter, whatever the number of shuffle partitions."""
    spark.conf.set("spark.sql.shuffle.partitions", 211)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.sparkContext.setJobGroup("near-jobs", "jobs of near dedup")
        near_dedup(documents).count()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("near-jobs")) < 150
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# Sketches


def make_sets(jaccard, n, rng):
    both = round(2 * n * jaccard / (1 + jaccard))
    x = rng.integers(0, 1 << 63, 2 * n - both, np.uint64)
    return x[:n], x[n - both :]


@pytest.mark.parametrize("jaccard", [0.0, 0.3, 0.8, 0.95, 1.0])
@pytest.mark.parametrize("n", [5, 300, 20_000])
def test_likelihood_finds_the_similarity(jaccard, n):
    rng = np.random.default_rng(5)
    found = []
    for _ in range(30 if n < 20_000 else 6):
        a, b = make_sets(jaccard, n, rng)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = sketch(a), sketch(b)
        (estimate,) = likeliest(np.array([(x > y).sum()]), np.array([(x < y).sum()]), np.array([float(n)]), np.array([float(n)]))
        found.append(estimate - true)
    assert abs(np.mean(found)) < 0.03 and np.max(np.abs(found)) < near.MARGIN


def test_no_pair_at_the_threshold_is_missed():
    rng = np.random.default_rng(7)
    for _ in range(300):
        a, b = make_sets(0.8, 400, rng)
        x, y = band_keys(np.stack([sketch(a), sketch(b)]))
        assert (x == y).any()


def test_merged_sketch_is_that_of_the_union():
    rng = np.random.default_rng(9)
    a, b = make_sets(0.5, 300, rng)
    assert np.array_equal(merged(sketch(a), sketch(b)), sketch(np.union1d(a, b)))


# Components


@pytest.mark.parametrize("together", [0, 50, 1 << 20])
def test_components(spark, monkeypatch, together):
    """All links in turns over all executors, the last of them in one task, or all of them there."""
    monkeypatch.setattr(component_module, "TOGETHER", together)
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    links += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2000 + k) for k in range(1, 300)] + [(5, 5), (7000, 7000)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    expected = {x: find(x) for x in list(root)}
    found = components(spark.createDataFrame(links, "a long, b long").repartition(6))
    assert {r.node: r.root for r in found.collect()} == expected and found.count() == len(expected)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    nodes, roots = forest(np.array([3, 5, 9]), np.array([5, 3, 9]))
    assert list(zip(nodes, roots)) == [(5, 3)]


def test_margin_drops_a_borderline_pair_once_in_ten_million():
    equal = np.arange(near.REGISTERS + 1)
    larger = (near.REGISTERS - equal) // 2
    size = np.full(len(equal), 1000.0)
    kept = likeliest(larger, near.REGISTERS - equal - larger, size, size) >= 0.8 - near.MARGIN
    chance = [comb(near.REGISTERS, int(k)) * 0.8**k * 0.2 ** (near.REGISTERS - k) for k in equal[~kept]]
    assert sum(chance) < 1e-7
