import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import pytest

from tests.llm.conftest import ODD_TEXTS, bag
from tidemark.llm import resampling
from tidemark.llm.resampling import Vocabulary, frequent, importance_resample, n_runs, resampled, split_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, n=1, buckets=10_000, seed=2024, share=(10, 100), least=20):
    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    source, wanted = Counter(), Counter()
    for _, text in docs:
        source.update(map(bucket, features(text, n)[1]))
    for text in target:
        wanted.update(map(bucket, features(text, n)[1]))
    all_source, all_wanted = sum(source.values()), sum(wanted.values())
    out = []
    for id, text in docs:
        words, own = features(text, n)
        weight = sum(
            math.floor(1000 * math.log((wanted[b] + 1) * (all_source + buckets) / ((source[b] + 1) * (all_wanted + buckets)))) for b in map(bucket, own)
        )
        h = int(sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([id, len(words), len(own), weight, score, None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, row in enumerate(able[: len(able) * share[0] // share[1]]):
        row[5] = k + 1
    return out


@pytest.mark.parametrize("n,buckets,vocabulary", [(1, 10_000, 1 << 15), (2, 1000, 5), (3, 70_000, 0)])
def test_like_brute_force(spark, documents, n, buckets, vocabulary):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    target = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    found = importance_resample(
        documents.repartition(5), spark.createDataFrame([(t,) for t in target], "text string"), n=n, buckets=buckets, vocabulary=vocabulary
    )
    assert found.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert bag(found.collect()) == bag(brute(docs, target, n, buckets))
    assert found.filter("rank IS NOT NULL").count() > 10


def test_odd_rows(spark, odd_docs):
    target = spark.createDataFrame([(None, 1), ("", 2), ("one two 3 ünï", 3), ("one two 3 ünï", 3)], "text string, score int")
    found = importance_resample(odd_docs, target, share=(1, 2), least_words=1, n=2)
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert bag(found.collect()) == bag(brute(docs, [r.text for r in target.collect()], 2, share=(1, 2), least=1))


def test_empty_tables(spark, no_docs, docs_of):
    target = spark.createDataFrame([], "text string")
    assert importance_resample(no_docs, target).count() == 0
    docs = [(0, "a b c"), (1, "A B c d"), (2, None)]
    found = importance_resample(docs_of(*(t for _, t in docs)), target, share=(1, 1), least_words=2)
    assert bag(found.collect()) == bag(brute(docs, [], 2, share=(1, 1), least=2))
    assert resampled(no_docs, target).schema == no_docs.schema


def test_equal_scores_go_by_id(spark):
    rows = spark.createDataFrame([(7, "x " * 30)] * 3 + [(None, "x " * 30)] * 4, "doc_id long, text string").repartition(3)
    found = importance_resample(rows, rows, share=(5, 7), least_words=20).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3, 4, 5]
    assert bag(r[:5] for r in found) == bag(r[:5] for r in brute([tuple(r) for r in rows.collect()], [r.text for r in rows.collect()], 2))


def test_whole_rows_are_drawn(spark, documents):
    ranked = importance_resample(documents, documents.limit(20), share=(1, 4), n=1)
    wanted = {r.doc_id for r in ranked.filter("rank IS NOT NULL").collect()}
    drawn = resampled(documents, documents.limit(20), share=(1, 4), n=1)
    assert drawn.schema == documents.schema and {r.doc_id for r in drawn.collect()} == wanted


def test_target_texts_are_drawn_first(spark):
    plain = [(i, f"common words of every day number {i % 7} " * 5) for i in range(100)]
    rare = [(1000 + i, f"quark gluon hadron lepton boson {i % 3} " * 5) for i in range(10)]
    docs = spark.createDataFrame(plain + rare, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([("the hadron and the lepton, the quark and the boson; gluon",)], "text string")
    drawn = importance_resample(docs, target, share=(10, 110)).filter("rank IS NOT NULL")
    assert {r.doc_id for r in drawn.collect()} == {i for i, _ in rare}


@pytest.mark.parametrize("n", [1, 2, 4])
def test_buckets_do_not_depend_on_the_vocabulary(monkeypatch, n):
    monkeypatch.setattr(resampling, "STEP", 7)
    for text in [*ODD_TEXTS[:-4], "A b a B c ünï a b 12 c", "x " * 50]:
        own = split_words((text or "").encode())
        expected = sorted(zlib.crc32(f.encode()) % 1000 for f in features(text, n)[1])
        for known in ([], [b"a", b"x", b"one"], own):
            held = Vocabulary(known, list(zip(known, known[1:])), 1000)
            found = sorted(int(b) for part in held.of(own, n) for b in part)
            assert found == expected and len(found) == n_runs(len(own), n)


def test_frequent_words_are_counted_over_all_tasks(spark, monkeypatch):
    texts = spark.createDataFrame([(f"often seldom{i} again often",) for i in range(300)] + [("y" * 200 + " ",)] * 400, "text string").repartition(6)
    words, pairs = frequent(texts, 2, 2)
    assert words == [b"often", b"again"] and set(pairs) == {(b"again", b"often")} | set(pairs) and len(pairs) == 2


def test_files_grow_with_the_input(spark, monkeypatch, tmp_path):
    from tidemark.llm import shared

    spark.range(200_000).selectExpr("id", "sha2(string(id), 256) AS text").repartition(64).write.parquet(f"{tmp_path}/rows")
    monkeypatch.setattr(shared, "FILES_PER_CORE", 1)
    few = len(shared.stored(spark.read.parquet(f"{tmp_path}/rows"), "few").inputFiles())
    monkeypatch.setattr(shared, "FILE_BYTES", 1 << 18)
    monkeypatch.setattr(shared, "FILES_PER_CORE", 1)
    with_bytes = spark.read.option("maxPartitionBytes", 1 << 17).parquet(f"{tmp_path}/rows")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 18)
    try:
        many = len(shared.stored(with_bytes, "many").inputFiles())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert few <= 4 < many
