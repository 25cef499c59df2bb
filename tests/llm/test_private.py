import re
from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import bag
from tidemark.llm import private
from tidemark.llm.private import find_private, private_digest, sanitised
from tidemark.llm.queries import op5_pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def digest(i, text):
    spans = brute(text)
    joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (i, *[sum(s[0] == k for s in spans) for k in PLAIN], sha256(joined.encode()).hexdigest())


def check(docs):
    found = private_digest(find_private(docs)).drop("spans")
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]
    assert bag(found.collect()) == bag(digest(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())


CASES = [
    "x@y.com_z@w.org", "a@b@c.d", "a@b.c@d.e", "é😀 mail: o'neil+tag@sub.example.co.uk, 1.2.3.4.5.6.7.8",
    "1.2.3.256 1.2.3.4 01.002.000003.255 999.1.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 5", "4111111111111112",
    "+1 (386) 555-3733 and +49 30 1234567890123456", "+1-2", "++12345678", "1" * 6000, "1.1" * 3000, "a@b" + ".c" * 4000,
    "a" * 30_000, "@" * 2000, "4041894974608795 " * 50, "+1 (2) 3.4-5 6789 4111111111111111", "0.0.0.0", "", None, "\n\n",
]


def test_cases(docs_of):
    check(docs_of(*CASES))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert find_private(no_docs).count() == 0


def test_documents(documents):
    check(documents)


def test_many_random_texts(docs_of):
    texts = []

    @settings(max_examples=400, deadline=None, database=None)
    @given(st.lists(st.sampled_from(["a", "@", ".", "-", "+", " ", "1", "25", "4111111111111111", "(", ")", "é", "\n", "x.y", "_"]), max_size=25))
    def gather(parts):
        texts.append("".join(parts))

    gather()
    check(docs_of(*texts))


# Terms that disclose a value


def corpus():
    """Zanzibar stands beside one address in several lines and nowhere else; 'hello' stands everywhere."""
    noise = [f"hello line {k} of other things about topic{k % 9}" for k in range(300)]
    told = [f"hello Zanzibar wrote from zed@example.com about topic{k}" for k in range(4)]
    copied = ["Quixote wrote from qui@example.com once"] * 6
    return noise + told + copied


def test_disclosing_terms(docs_of):
    docs = docs_of(*corpus(), "Nothing said by Zanzibar here")
    found = {r.doc_id: r for r in find_private(docs).collect()}
    for k in range(300, 304):
        spans = found[k].spans
        assert [found[k].text[s.start : s.end] for s in spans] == ["zed@example.com", "Zanzibar"]
        assert spans[0].kind == "email" and spans[1].kind in ("general", "removed")
        assert len(found[k].base_spans) == 1
    # copies of one line are no evidence, and a document without the value keeps its words
    assert all([s.kind for s in found[k].spans] == ["email"] for k in range(304, 310))
    assert found[310].spans == [] and all(found[k].spans == [] for k in range(300))


def test_thresholds(docs_of):
    docs = docs_of(*corpus())
    none = find_private(docs, least_lines=5)
    assert none.filter(F.size("spans") > F.size("base_spans")).count() == 0
    every = find_private(docs, generalise=0.0, remove=2.0)
    kinds = {s.kind for r in every.collect() for s in r.spans}
    assert kinds == {"email", "general"}


def test_more_terms_than_are_broadcast(docs_of, monkeypatch):
    docs = docs_of(*corpus())
    expected = bag(find_private(docs).select("doc_id", "spans").collect())
    monkeypatch.setattr("tidemark.llm.private.BROADCAST_TERMS", 0)
    assert bag(find_private(docs).select("doc_id", "spans").collect()) == expected


@pytest.mark.parametrize(
    "text,clean",
    [
        ("mail zed@example.com or 1.2.3.4!", "mail [email] or [ip]!"),
        ("😀 +1 (386) 555-3733 é", "😀 [phone] é"),
        ("4111111111111111@x.yz overlaps", "[email] overlaps"),
        ("zed@example.com", "[email]"),
    ],
)
def test_sanitised_text(docs_of, text, clean):
    assert sanitised(find_private(docs_of(text))).first().sanitised == clean


def spanned(found):
    return {r.doc_id: [r.text[s.start : s.end] for s in r.spans if s.kind in ("general", "removed")] for r in found.collect()}


def test_terms_of_two_lines_and_of_neighbouring_lines(docs_of):
    noise = [f"hello line {k} of other things about topic{k % 9}" for k in range(1000)]
    twice = [f"hello Zanzibar wrote from zed@example.com about topic{k}" for k in range(2)]
    before = [f"hello topic{k}\nfrom Quixote\nqui@example.com\nbye" for k in range(3)]
    copied = ["hello topic1\nUlysses once\nuly@example.com\nbye"] * 6
    once = ["hello Penelope at pen@example.com"]
    found = spanned(find_private(docs_of(*noise, *twice, *before, *copied, *once)))
    assert all("Zanzibar" in found[k] for k in (1000, 1001))
    assert all("Quixote" in found[k] for k in (1002, 1003, 1004))
    assert all(found[k] == [] for k in range(1005, 1012))


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_terms_everywhere(docs_of, monkeypatch, broadcast):
    monkeypatch.setattr("tidemark.llm.private.BROADCAST_TERMS", broadcast)
    found = find_private(docs_of(*corpus(), "Nothing said by Zanzibar here", "Zanzibar at 1.2.3.4"), everywhere=True)
    rows = {r.doc_id: r for r in sanitised(found).collect()}
    assert [(s.kind in ("general", "removed"), s.start, s.end) for s in rows[310].spans] == [(True, 16, 24)]
    assert "Zanzibar" not in rows[310].sanitised and rows[310].sanitised.startswith("Nothing said by ")
    assert len(rows[311].base_spans) == 1 and len(rows[311].spans) == 2
    assert all(rows[k].spans == [] for k in range(300))


def test_query_covers_documents_without_the_value(spark, docs_of, tmp_path):
    docs_of(*corpus(), "Nothing said by Zanzibar here").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.spans for r in op5_pii(spark, str(tmp_path)).collect()}
    assert found[310].endswith(":16:24") and all(found[k] == "" for k in range(300))


def plain_spans(rows, everywhere, generalise=0.8, remove=0.95, least=2):
    """All spans of (id, text) rows by the definition, as ``private_digest`` writes them."""
    import math
    from collections import Counter, defaultdict

    def without(line):
        for pattern in PLAIN.values():
            line = re.sub(pattern, " ", line, flags=re.ASCII)
        return set(re.findall(r"[^\W_]+", line.lower()))

    def values(text):
        plain = {"email": str.lower, "ip": str, "card": lambda m: re.sub("[^0-9]", "", m), "phone": lambda m: re.sub("[^0-9]", "", m)}
        return {f"{k}:{plain[k](text[a:b])}" for k, a, b in brute(text)}

    n_term, n_value, n_both, units, total = Counter(), Counter(), Counter(), defaultdict(set), 0
    for _, text in rows:
        lines = (text or "").split("\n")
        held = [values(line) for line in lines]
        for k, line in enumerate(lines):
            total += 1
            n_term.update(set(re.findall(r"[^\W_]+", line.lower())))
            around = None if held[k] else (lines[k - 1] if k else None, lines[k + 1] if k + 1 < len(lines) else None)
            for value in held[k].union(*held[max(k - 1, 0) : k], *held[k + 1 : k + 2]):
                n_value[value] += 1
                for term in without(line):
                    n_both[value, term] += 1
                    units[value, term].add((line, around))
    told = defaultdict(dict)
    for (value, term), n in n_both.items():
        known = math.log2(total / n_value[value])
        if len(units[value, term]) >= least and known:
            share = math.log2(n * total / (n_value[value] * n_term[term])) / known
            if share >= generalise:
                told[value][term] = "removed" if share >= remove else "general"
    out = []
    for i, text in rows:
        text = text or ""
        base, wanted = brute(text), {}
        for value, terms in told.items():
            if everywhere or value in {f"{k}:{v}" for k, v in ((x.split(":", 1)) for x in values(text))}:
                for term, action in terms.items():
                    wanted[term] = max(action, wanted.get(term, ""))
        own = [(wanted[m[0].lower()], *m.span()) for m in re.finditer(r"[^\W_]+", text) if m[0].lower() in wanted]
        own = [s for s in own if not any(a < s[2] and b > s[1] for _, a, b in base)]
        spans = base + sorted(s for s in own if s[0] == "general") + sorted(s for s in own if s[0] == "removed")
        out.append((i, ",".join(f"{k}:{a}:{b}" for k, a, b in spans)))
    return out


@pytest.mark.parametrize("everywhere", [False, True])
def test_spans_by_brute_force(spark, docs_of, everywhere):
    quux = [f"Quuxley wrote to quux@example.com about item{k}" for k in range(2)] + ["Quuxley alone in the hall"]
    zan = ["ask zanzibarovich at zed@example.com now", "thing\nzanzibarovich again\nzed@example.com", "Zanzibarovich is gone, ZANZIBAROVICH!"]
    noise = [f"line {k} of other things about item{k % 40}" for k in range(200)]
    docs = docs_of(*corpus(), *quux, *zan, *noise, None, "", "1.2.3.4 Zanzibar\n1.2.3.4")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = private_digest(find_private(docs, everywhere=everywhere)).select("doc_id", "spans")
    expected = plain_spans(rows, everywhere)
    assert bag(found.collect()) == bag(expected)
    texts = {text[int(a) : int(b)] for (_, text), (_, spans) in zip(rows, expected) for _, a, b in (s.split(":") for s in spans.split(",") if s)}
    assert {"Quuxley", "zanzibarovich", "Zanzibar"} <= texts


@pytest.mark.parametrize("short", [0, 60, 1 << 16])
def test_only_long_texts_meet_their_terms_by_row(docs_of, monkeypatch, short):
    texts = [*corpus(), "Nothing said by Zanzibar here", "Zanzibar at 1.2.3.4", "so many other words " * 5 + "Zanzibar 1.2.3.4 ZANZIBAR"]
    expected = {(r.doc_id, r.spans) for r in private_digest(find_private(docs_of(*texts), everywhere=True)).collect()}
    shuffled, by_row = [], private._spans_by_row
    monkeypatch.setattr(private, "SHORT_TEXT", short)
    monkeypatch.setattr(private, "_spans_by_row", lambda found, wanted: shuffled.extend(found.collect()) or by_row(found, wanted))
    found = private_digest(find_private(docs_of(*texts), everywhere=True)).collect()
    assert sorted(r.text for r in shuffled) == sorted(t for t in texts if len(t) > short)
    assert {(r.doc_id, r.spans) for r in found} == expected
    assert any("removed" in r.spans or "general" in r.spans for r in found)


def test_spans_of_documents_by_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect() if (r.text or "").isascii()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = private_digest(find_private(docs, everywhere=True)).select("doc_id", "spans")
    assert bag(found.collect()) == bag(plain_spans(rows, True))
