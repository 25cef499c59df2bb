import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import LONG, ODD_TEXTS, THUE_MORSE, WORD
from tidemark.llm import bloom, words as words_module
from tidemark.llm.shared import free, with_group
from tidemark.llm.words import run_digests, words


def split(text):
    return WORD.findall(text or "")


def check(texts, **options):
    column = pa.array(texts, pa.string())
    found = list(words(column, **options))
    assert [len(w.hashes) for w in found] == [len(split(t)) for t in texts]
    seen = {}
    for text, own in zip(texts, found):
        cut = [bytes(own.data[a:b]).decode() for a, b in zip(own.starts, own.ends)]
        assert cut == split(text)
        for word, h in zip(cut, own.hashes.tolist()):
            if options.get("fold"):
                word = word.translate({c: c + 32 for c in range(65, 91)})
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_words_of_odd_texts():
    check(ODD_TEXTS)
    check(ODD_TEXTS, fold=True)
    check([])
    sliced = pa.array(["x", None, "a b", "c"], pa.string()).slice(1, 2)
    assert [len(w.hashes) for w in words(sliced)] == [0, 2]


def test_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(words_module, "CHUNK", 64)
    check(["short", "word " * 50, "y" * 1000 + " z", "a b " + "q" * 200, LONG[:3000], None, "end"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAB é\t\n\x0b\x1c ", max_size=30)), max_size=6))
def test_words_of_any_texts(texts):
    check(texts)


@pytest.mark.parametrize("max_bytes", [1 << 20, 256])
def test_filter_never_holds_back(spark, max_bytes):
    """Nor when it is far too small."""
    keys = spark.range(0, 30_000, 1, 7).select(F.xxhash64("id").alias("k"))
    some = keys.limit(5000)
    held = bloom.build(some, 5000, max_bytes=max_bytes)
    assert some.filter(held.may_hold(F.col("k"))).count() == 5000
    if max_bytes > 256:
        assert keys.filter(held.may_hold(F.col("k"))).count() < 6000


def test_filter_of_repeated_keys(spark):
    once = spark.range(0, 20_000, 1, 5).select(F.xxhash64("id").alias("k"))
    twice = spark.range(15_000, 15_100).select(F.xxhash64("id").alias("k"))
    held = bloom.build(once.unionByName(twice), 20_100, repeated=True)
    found = {r.k for r in once.filter(held.may_hold(F.col("k"))).collect()}
    assert {r.k for r in twice.collect()} <= found and len(found) < 800


@pytest.mark.parametrize("repeated", [False, True])
def test_reports_merged_in_shares(spark, monkeypatch, repeated):
    """The same filter, whether a segment's reports are merged by one task or by several first."""
    keys = spark.range(0, 40_000, 1, 9).select(F.xxhash64(F.col("id") % 30_000).alias("k"))
    whole = bloom.build(keys, 40_000, repeated=repeated)
    monkeypatch.setattr(bloom, "TOGETHER", 1 << 13)
    shared = bloom.build(keys, 40_000, repeated=repeated)
    assert np.array_equal(whole.words, shared.words) and whole.words.any()


def test_filter_of_nothing_and_nulls(spark):
    nothing = bloom.build(spark.createDataFrame([], "k long"), 0)
    rows = spark.createDataFrame([(None,), (1,)], "k long")
    assert [r[0] for r in rows.select(nothing.may_hold(F.col("k"))).collect()] == [None, False]
    assert bloom.build(rows, 2).words.any()


def test_mixed_is_a_bijection():
    values = np.arange(1 << 16, dtype=np.uint64)
    assert len(np.unique(bloom.mixed(values))) == len(values)


def test_groups_hot_and_cold(spark):
    rows = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    found = with_group(rows, groups, ["k"], "n")
    assert found.count() == 12_000 and found.filter("n = 4000").count() == 4000
    assert with_group(rows.limit(0), groups.limit(0), ["k"], "n").count() == 0


def test_free_names(spark):
    df = spark.range(1).select(F.lit(1).alias("KEY"), F.lit(1).alias("_key"))
    assert free(df, "key", "other") == ["__key", "other"]


def test_words_that_polynomials_take_for_equal():
    check([*THUE_MORSE, " ".join(THUE_MORSE), *(t[:k] for t in THUE_MORSE for k in (7, 8, 9, 16, 17, 255, 256, 257, 264))])


def test_digests_are_of_the_words_themselves():
    one, two = words(pa.array(["A  b\tc d", "x a b C d"]))
    assert run_digests(one, np.arange(2), 3) != run_digests(two, np.arange(1, 3), 3)
    assert run_digests(one, np.arange(2), 3, fold=True) == run_digests(two, np.arange(1, 3), 3, fold=True)
    (joined, apart) = words(pa.array(["ab c", "a bc"]))
    assert run_digests(joined, np.arange(1), 2) != run_digests(apart, np.arange(1), 2)
