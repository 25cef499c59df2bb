"""The pipeline's stages, each against its own brute force on its own input, and the registered queries."""

import os

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.conftest import bag
from tests.llm.test_exact import brute as exact_brute
from tests.llm.test_near import brute as near_brute
from tidemark.llm import queries
from tidemark.llm.bpe import read_ranks


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        after = spark.read.parquet(f"{root}/{k}")
        out.append((docs, after))
        docs = after
    return out


def test_columns(stages):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [after.columns for _, after in stages] == [names] * 4 + [[*names, "ids"]]
    assert [s for s, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mixing", "byte-level BPE"]


def test_quality(stages, spark, sf_dir):
    before, after = stages[0]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = before.join(labels.filter("quality = 1"), "doc_id", "left_semi").count()
    assert after.join(labels.filter("quality = 1"), "doc_id", "left_semi").count() >= 0.95 * good
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}


def test_exact(stages):
    before, after = stages[1]
    kept = [r[0] for r in exact_brute(before.collect()) if r[3]]
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)


def test_near(stages):
    before, after = stages[2]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    kept = [i for i, _, _, stays in near_brute(rows, 5) if stays]
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)


def test_mixing(stages):
    before, after = stages[3]
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    total, mixed = (df.agg(F.sum(words)).first()[0] for df in (before, after))
    assert abs(mixed - 1.5 * total) < 0.03 * total
    assert after.groupBy("doc_id").count().filter("count > 2").count() == 0
    assert {tuple(r) for r in after.collect()} <= {tuple(r) for r in before.collect()}


def test_encoding(stages):
    before, after = stages[4]
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    known = tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert after.count() == before.count()
    assert all(r.ids == known.encode_ordinary(r.text) for r in after.collect())


def test_odd_documents_go_through(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, sf_dir)
            assert after.schema == docs.schema
        assert "ids" in corpus_pipeline.encode(spark, docs, sf_dir).columns


def test_run(spark, sf_dir, stages, tmp_path):
    """The same rows as stage by stage; of the tables on the way those of the stages alone are left."""
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(root))
    assert bag(corpus_pipeline.run(spark, sf_dir).select("doc_id", "ids").collect()) == bag(stages[-1][1].select("doc_id", "ids").collect())
    left = set(os.listdir(root)) - before
    assert len(left) == 5 and all(name.startswith("pipeline-") for name in left)


# The registered queries


def test_names():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert contract.queries().keys() >= queries.QUERIES.keys() | {"pipeline"} and queries.ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = con.sql(queries.ORACLES[name])
    found = contract.queries()[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(expected.columns)
    assert bag(found.select(*expected.columns).collect()) == bag(expected.fetchall())


def test_digests_without_sql(spark, sf_dir, documents):
    ids = {r.doc_id for r in documents.collect()}
    for name in set(queries.QUERIES) - set(queries.ORACLES) - {"op12_html"}:
        found = contract.queries()[name](spark, sf_dir)
        assert {r.doc_id for r in found.select("doc_id").collect()} == ids and found.count() == len(ids), name
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = contract.queries()["op12_html"](spark, sf_dir)
    assert sorted(r.page_id for r in found.collect()) == sorted(r.page_id for r in pages.collect())
