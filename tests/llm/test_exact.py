from collections import defaultdict
from hashlib import sha256

import pytest

from tests.llm.conftest import bag
from tidemark.llm.exact import exact_dedup, exact_groups


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        left = 1
        for i in ids:
            kept = i == best and left == 1
            left -= kept
            out.append((i, best, len(ids), kept, sha256(text.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("max_bytes", [1 << 20, 64])
def test_odd_rows(odd_docs, max_bytes):
    found = exact_groups(odd_docs, max_bytes=max_bytes)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert bag(found.collect()) == bag(brute(odd_docs.collect()))


def test_documents(documents):
    assert bag(exact_groups(documents).collect()) == bag(brute(documents.collect()))


def test_rows_that_stay(odd_docs, documents):
    for docs in (odd_docs, documents):
        left = exact_dedup(docs)
        assert left.schema == docs.schema
        kept = [(r[0], r[4]) for r in brute(docs.collect()) if r[3]]
        assert bag((r.doc_id, sha256((r.text or "").encode()).hexdigest()) for r in left.collect()) == bag(kept)


def test_one_text_has_a_third_of_all_rows(spark):
    docs = spark.range(6000).selectExpr("id doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) text")
    found = exact_groups(docs)
    assert found.filter("kept").count() == 4001
    assert [r.doc_id for r in found.filter("kept and group_size > 1").collect()] == [5997]
    assert exact_dedup(docs).count() == 4001


def test_nothing(no_docs):
    assert exact_groups(no_docs).count() == 0 and exact_dedup(no_docs).count() == 0
