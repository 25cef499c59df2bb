import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import ODD_TEXTS
from tidemark.llm.bpe import Decoder, Encoder, bpe_decode, bpe_encode, read_ranks

RANKS = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODER, DECODER = Encoder(RANKS, public_tokenizers.PATTERN), Decoder(RANKS)
KNOWN = tiktoken.Encoding("known", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def same(text):
    ids = ENCODER.encode(text)
    assert ids.tolist() == KNOWN.encode_ordinary(text)
    assert DECODER.decode(ids) == text.encode()


@pytest.mark.parametrize("text", [t or "" for t in ODD_TEXTS[:10]] + ["'s 're <|endoftext|> x'll", "1" * 9999, " " * 4000 + "x", "ab" * 3000])
def test_odd_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(text):
    same(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["th", "e", "ing", " ", "  ", "\n", "é", "'", "s", "12", "!!", "\x1c", "\xa0", "a" * 40]), max_size=30))
def test_pieces_side_by_side(parts):
    same("".join(parts))


def test_other_vocabulary():
    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    own = Encoder(ranks, public_tokenizers.PATTERN)
    known = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in [t or "" for t in ODD_TEXTS[:10]] + ["Привет мир, здравствуйте", "東京は日本の首都です"]:
        assert own.encode(text).tolist() == known.encode_ordinary(text)


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("tidemark.llm.bpe.REMEMBERED", 3)
    monkeypatch.setattr("tidemark.llm.bpe.PAIRS", 5)
    own = Encoder(RANKS, public_tokenizers.PATTERN)
    text = " ".join(f"word{i}xyz{i % 7}" for i in range(200))
    assert own.encode(text).tolist() == KNOWN.encode_ordinary(text)
    assert len(own.known) <= 3 and len(own.known.old) <= 3 and len(own.fits) <= 5


def test_tables(odd_docs, no_docs, documents):
    for docs in (odd_docs, documents):
        found = bpe_encode(docs, RANKS, public_tokenizers.PATTERN, decoded="back")
        assert found.columns == [c for c in docs.columns if c != "ids"] + ["ids", "back"]
        rows = found.select("doc_id", "text", "ids", "back").collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.ids == KNOWN.encode_ordinary(r.text or "") and bytes(r.back) == (r.text or "").encode()
        again = bpe_decode(found.select("text", "ids"), RANKS)
        assert again.filter(F.col("decoded") != F.coalesce("text", F.lit("")).cast("binary")).count() == 0
    assert bpe_encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_ids_that_are_unknown_or_missing(spark):
    rows = spark.createDataFrame([([0, 1],), ([50_256],), ([-1],), ([None],), (None,), ([],)], "ids array<int>")
    assert [r.decoded if r.decoded is None else bytes(r.decoded) for r in bpe_decode(rows, RANKS).collect()] == [b'!"', None, None, None, b"", b""]
