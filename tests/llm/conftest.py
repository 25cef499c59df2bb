"""Small tables with every odd value the operators must take, and tables that share a hot value."""

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(150_000))  # about 1.5 MB

ODD_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "One",
    "two words",
    "two  words",
    "ünï cödé 😀 \x1c \x85 　end",
    "a" * 5000,
    "\n" * 300,
    LONG,
    LONG,
    "same text here",
    "same text here",
]


#: The two texts of 1,024 letters that hash alike under every polynomial with an odd base modulo a power of two.
THUE_MORSE = ["".join("ab"[i.bit_count() % 2 ^ turned] for i in range(1024)) for turned in (0, 1)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids, repeated rows, null columns, and columns named like the operators' own."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, i) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[12], rows[5], (None, "no id", None, None, None), (None, "no id", None, None, None), (None, None, None, None, None)]
    extra = "kept boolean, keep_id long, sha string, key string, row string, score string, ids string, size string, rank string, hash string, doc string"
    rows = [(*r, True, 1, "s", "k", "r", "sc", "i", "z", "ra", "h", "d") for r in rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)

    return make


def bag(rows):
    return sorted(map(repr, (tuple(r) for r in rows)))


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
