import re

import pytest

from tests.llm.conftest import bag
from tidemark.llm.licence_texts import TEXTS, templates
from tidemark.llm.licences import _indexed, licence_units, normalised, scan_licences


def bigrams(text):
    words = normalised(text)
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def brute(text, threshold=0.8, known=None):
    text, found = text or "", []
    index = [(licence, set(own)) for licence, _, own, _ in _indexed(known or templates(), threshold)]
    for unit in {*text.split("\n"), *re.split(r"\n[ \t\r]*\n", text), text}:
        own = bigrams(unit)
        scores = [(-2 * len(own & other) / (len(own) + len(other)), licence) for licence, other in index if own]
        best = min(scores, default=(0, ""))
        if own and -best[0] >= threshold:
            found.append(best)
    best = min(found, default=(None, None))
    return len(found), ",".join(sorted({licence for _, licence in found})), best[1], None if best[0] is None else -best[0]


def check(docs, **options):
    found = scan_licences(docs, **options)
    assert found.columns == ["doc_id", "n_matches", "licences", "best_licence", "best_dice"]
    threshold, known = options.get("threshold", 0.8), options.get("templates")
    expected = [(r.doc_id, *brute(r.text, threshold, known)) for r in docs.select("doc_id", "text").collect()]
    assert bag(found.collect()) == bag(expected)
    return {row[0]: row[1:] for row in expected}


def test_documents(documents):
    assert sum(n for n, *_ in check(documents).values()) > 0


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert scan_licences(no_docs).count() == 0


def test_whole_licences_and_variants(docs_of):
    mit = TEXTS["MIT"]
    texts = [
        mit, "intro\n\n" + mit.strip() + "\n\nmore", mit.upper().replace("\n", "   "), mit.replace("Software", "Program", 3),
        mit[: len(mit) // 2], TEXTS["BSD-2-Clause"], TEXTS["BSD-3-Clause"], "Licensed under the Apache License, Version 2.0.",
        "licensed UNDER the apache-license version 2 0", "Licensed to nobody under the sun.", "MIT License", "MIT",
        "Released under the MIT License.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.", "",
    ]
    found = check(docs_of(*texts))
    assert [found[k][2] for k in (0, 1, 2, 3, 5, 6, 7, 8)] == ["MIT"] * 4 + ["BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "Apache-2.0"]
    assert found[9][0] == 0 and found[12][:2] == (2, "CC-BY-NC-4.0,MIT")


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.95])
def test_bounds_and_signs_lose_nothing(docs_of, threshold):
    own = [("a", "one two three four five"), ("b", "one two three"), ("c", "x y"), ("d", "five four three two one zero six")]
    texts = ["one two three four", "one two", "zero one two three four five six", "x y z", "x", "three two one zero", "y x y x y"]
    check(docs_of(*texts), templates=own, threshold=threshold)


def test_units(docs_of):
    _, units = licence_units(docs_of("some other text\nLicensed under CC BY 4.0.\nand still more of it"))
    assert [(u.unit, u.licence, u.dice) for u in units.collect()] == [("Licensed under CC BY 4.0.", "CC-BY-4.0", 1.0)]
