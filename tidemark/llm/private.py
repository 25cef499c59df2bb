"""Personal data: fixed patterns, and terms that reveal the protected values by their co-occurrence.

All of it is DataFrame functions.  A protected value e is an address, number or card that a pattern found.
Its contexts are the lines that hold it and their neighbours, over the whole corpus.  With n lines in all, of which
n(e) are in a context of e, n(t) hold the term t and n(e, t) are both, the information e would disclose is
IC(e) = log2(n / n(e)) and what t discloses of it is PMI(e, t) = log2(n(e, t) n / (n(e) n(t))).  Where PMI reaches a
share of IC, the term all but names the value: it is generalised, and beyond a second share
removed, in the documents that hold e or, if asked for, wherever it stands.

Every term in a context is judged by these thresholds alone.  What meets a value in a single line, in whatever number of
copies, is no co-occurrence of the corpus but one text: ``least_lines`` asks for two different ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import free, quoted, stored

KINDS = ("email", "ip", "card", "phone")
TERM = r"[\p{L}\p{N}]+"
#: Terms that disclose are broadcast up to this number, and otherwise joined with the words of all documents.
BROADCAST_TERMS = 200_000
#: Texts of up to so many characters are searched for each of their terms that discloses, where they are.
SHORT_TEXT = 1 << 16

# The patterns allow what their plain forms allow.  Possessive quantifiers keep Java from recursing over long
# runs, and the look-behinds from trying every start within a run that cannot match: a match starts where
# the run does, or where the previous match ended.
_PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, r"[^0-9]", "")


def _is_ip(match: Column) -> Column:
    def small(part: Column) -> Column:
        plain = F.ltrim(part, F.lit("0"))
        return (F.length(plain) < 3) | ((F.length(plain) == 3) & (plain <= "255"))

    return F.forall(F.split(match, r"\."), small)


def _is_card(match: Column) -> Column:
    digits = _digits(match)
    size = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        """Luhn: every second digit from the right counts twice, less nine beyond nine."""
        digit = F.substring(digits, size - i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 0, digit).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    luhn = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add) % 10 == 0
    return F.when(size.between(16, 19), luhn).otherwise(False)


def _is_phone(match: Column) -> Column:
    return F.length(_digits(match)).between(8, 15)


_VALID = {"email": lambda match: F.lit(True), "ip": _is_ip, "card": _is_card, "phone": _is_phone}
_VALUE = {"email": F.lower, "ip": lambda match: match, "card": _digits, "phone": _digits}
#: What a text must contain for the pattern to be tried at all.
_SIGN = {"email": "@", "ip": ".", "card": "", "phone": "+"}


def _matches(text: Column, kind: str) -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.contains(text, F.lit(_SIGN[kind])), F.regexp_extract_all(text, F.lit(_PATTERN[kind]), F.lit(0))).otherwise(none)


def _gaps(text: Column, kind: str, matches: Column) -> Column:
    """Lengths of the texts before each match and after the last."""
    return F.when(F.size(matches) > 0, F.transform(F.split(text, _PATTERN[kind], -1), F.length))


def _judged(kind: str):
    return lambda m: F.struct(m.alias("match"), _VALID[kind](m).alias("valid"), _VALUE[kind](m).alias("value"))


def _named(kind: str):
    return lambda m: F.concat(F.lit(f"{kind}:"), _VALUE[kind](m))


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


def find_matches(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: row, id, text, matched and, where something matched, matches and gaps."""
    body = F.coalesce(quoted(text), F.lit(""))
    found = docs.select(quoted(id).alias("id"), body.alias("text")).withColumn("row", F.monotonically_increasing_id())
    found = found.withColumns({f"{k}_match": _matches(F.col("text"), k) for k in KINDS})
    found = found.withColumns({f"{k}_gap": _gaps(F.col("text"), k, F.col(f"{k}_match")) for k in KINDS})
    matched = F.exists(F.array(*[F.size(f"{k}_match") for k in KINDS]), lambda n: n > 0)
    return stored(found.withColumn("matched", matched), "private-matches")


def base_spans(found: DataFrame) -> DataFrame:
    """Valid matches: row, order, kind, start, end (code points, end exclusive), value."""
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("order"),
                    F.lit(k).alias("kind"),
                    F.transform(F.col(f"{k}_match"), _judged(k)).alias("match"),
                    F.col(f"{k}_gap").alias("gap"),
                )
                for i, k in enumerate(KINDS)
            ]
        )
    ).alias("of")
    size = F.length("match.match")
    until = F.sum(F.col("gap") + size).over(Window.partitionBy("row", "order").orderBy("at"))
    return (
        found.filter("matched")
        .select("row", each)
        .select("row", "of.order", "of.kind", "of.gap", F.posexplode("of.match").alias("at", "match"))
        .withColumn("gap", F.element_at("gap", F.col("at") + 1))
        .select("row", "order", "kind", (until - size).cast("long").alias("start"), until.cast("long").alias("end"), "match.valid", "match.value")
        .filter("valid")
        .drop("valid")
    )


def _terms(text: Column) -> Column:
    """The different terms of a text without what the patterns match."""
    for kind in KINDS:
        text = F.regexp_replace(text, _PATTERN[kind], " ")
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _values(line: Column) -> Column:
    """The different valid values of a line, each with its kind; all of them have a digit or an @."""
    none = F.array().cast("array<string>")
    found = F.flatten(F.array(*[F.transform(F.filter(_matches(line, k), _VALID[k]), _named(k)) for k in KINDS]))
    return F.when(line.rlike("[@0-9]"), F.array_distinct(found)).otherwise(none)


def _lines(found: DataFrame) -> DataFrame:
    """line, around (a hash of its neighbours, 0 where the line holds a value) and the values in all three."""
    none = F.array().cast("array<string>")
    end = F.lit("\n")  # stands before the first line and after the last

    def placed(line: Column, i: Column) -> Column:
        own, before, after = (F.coalesce(F.get("held", k), none) for k in (i, i - 1, i + 1))
        around = F.xxhash64(F.coalesce(F.get("lines", i - 1), end), F.coalesce(F.get("lines", i + 1), end))
        values = F.array_sort(F.array_distinct(F.concat(own, before, after)))
        return F.struct(line.alias("line"), F.when(F.size(own) > 0, F.lit(0)).otherwise(around).alias("around"), values.alias("values"))

    return (
        found.select("matched", F.split("text", "\n").alias("lines"))
        .withColumn("held", F.when(F.col("matched"), F.transform("lines", _values)))
        .select(F.explode(F.transform("lines", placed)).alias("of"))
        .select("of.line", "of.around", "of.values")
    )


def _term_lines(found: DataFrame) -> DataFrame:
    """term and the number of lines that hold it, over all documents; the empty term stands for the line itself."""
    line = found.select(F.explode(F.split("text", "\n")).alias("line"))
    terms = F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(TERM), F.lit(0)))
    return line.select(F.explode(F.array_append(terms, "")).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosing_terms(found: DataFrame, least_lines: int = 2, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """Terms and what they reveal: value, term, action (general or removed).

    Every term in a context of a value is judged that meets it in ``least_lines`` different lines.  Lines differ in their
    text or in their neighbours; those that hold a value themselves, in their text alone.
    """
    contexts = stored(
        _lines(found.filter("matched")).filter(F.size("values") > 0).groupBy("line", "around", "values").agg(F.count("*").alias("n")),
        "private-lines",
    )
    beside = contexts.select(F.explode("values").alias("value"), F.xxhash64("line", "around").alias("unit"), "line", "n")
    per_value = stored(beside.groupBy("value").agg(F.sum("n").alias("n_value")), "private-values")
    pairs = (
        beside.select("value", "unit", "n", F.explode(_terms(F.col("line"))).alias("term"))
        .groupBy("value", "term")
        .agg(F.sum("n").alias("n_both"), F.count_distinct("unit").alias("both_lines"))
        .filter(F.col("both_lines") >= least_lines)
    )
    per_term = stored(_term_lines(found), "private-terms")
    whole = per_term.filter("term = ''").first()
    total = F.lit(float(whole.n_term if whole else 0))
    told = F.log2(F.col("n_both") * total / (F.col("n_value") * F.col("n_term")))
    share = told / F.nullif(F.log2(total / F.col("n_value")), F.lit(0.0))
    return (
        pairs.join(per_term, "term")
        .join(per_value, "value")
        .withColumn("share", share)
        .filter(F.col("share") >= generalise)
        .select("value", "term", F.when(F.col("share") >= remove, "removed").otherwise("general").alias("action"))
    )


def _own_terms() -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))


def _word_spans(texts: DataFrame) -> DataFrame:
    """row, order, kind, start, end of the words of ``text`` whose lower case is in the map ``wanted`` of terms to actions."""
    entry = "array<struct<order:int,kind:string,start:bigint,end:bigint>>"
    gaps = F.transform(F.split("text", TERM, -1), F.length).alias("gap")
    words = F.arrays_zip(gaps, F.regexp_extract_all("text", F.lit(TERM), F.lit(0)).alias("word"))

    def step(done: Column, x: Column) -> Column:
        """One word further: where it ends, and the spans with that of the word if it is wanted."""
        start = done["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["word"]), F.lit(0))
        action = F.try_element_at("wanted", F.lower(x["word"]))
        order = F.when(action == "general", len(KINDS)).otherwise(len(KINDS) + 1)
        span = F.struct(order.cast("int").alias("order"), action.alias("kind"), start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(action.isNotNull(), F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).cast(entry).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(entry).alias("spans"))
    spans = F.aggregate("words", start, step, lambda done: done["spans"])
    return texts.select("row", "wanted", words.alias("words")).select("row", F.explode(spans).alias("of")).select("row", "of.order", "of.kind", "of.start", "of.end")


def _spans_by_row(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """Spans of the terms in ``wanted`` (row, term, action), which meet the texts by row."""
    per_row = wanted.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("wanted"))
    return _word_spans(found.select("row", "text").join(per_row, "row"))


def _spans_anywhere(found: DataFrame, told: DataFrame) -> DataFrame:
    """Spans wherever a document has a term that discloses any value, of the strictest action for each.

    While the terms can be broadcast, short texts are searched where they are, once for each such term, and stay out
    of the shuffle.  Long ones, which may hold very many, are searched once for all of theirs.
    """
    terms = stored(told.groupBy("term").agg(F.max("action").alias("action")), "private-anywhere")
    if terms.count() > BROADCAST_TERMS:
        wanted = found.select("row", F.explode(_own_terms()).alias("term")).join(terms, "term")
        return _spans_by_row(found, stored(wanted, "private-wanted"))
    terms, is_short = F.broadcast(terms), F.length("text") <= SHORT_TEXT
    each = found.filter(is_short).select("row", "text", F.explode(_own_terms()).alias("term")).join(terms, "term")
    short = _word_spans(each.select("row", "text", F.create_map("term", "action").alias("wanted")))
    long = found.filter(~is_short)
    wanted = long.select("row", F.explode(_own_terms()).alias("term")).join(terms, "term")
    return short.unionByName(_spans_by_row(long, stored(wanted, "private-wanted")))


def term_spans(found: DataFrame, base: DataFrame, told: DataFrame, everywhere: bool = False) -> DataFrame:
    """Where documents have terms that reveal a value they hold, or any value, outside the base spans."""
    if everywhere:
        spans = _spans_anywhere(found, told)
    else:
        held = base.select("row", F.concat_ws(":", "kind", "value").alias("value")).distinct()
        wanted = held.join(told, "value").groupBy("row", "term").agg(F.max("action").alias("action"))
        spans = _spans_by_row(found.filter("matched"), wanted)  # base spans are of matched rows only
    taken = base.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("taken"))
    covered = F.exists("taken", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    return spans.join(taken, "row", "left").filter(~F.coalesce(covered, F.lit(False))).drop("taken")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_private(docs: DataFrame, id: str = "doc_id", text: str = "text", everywhere: bool = False, **thresholds) -> DataFrame:
    """One row per row of ``docs``: id, text, base_spans and spans (arrays of order, kind, start, end).

    Texts come only with rows that a pattern matched or that have spans.  Both arrays are sorted by kind as listed
    and then start; spans has the base spans and those of terms, of kinds general and removed.  Terms go in the
    documents that hold a value they disclose; with ``everywhere`` they go in all documents, as there the
    term alone tells the value.  A null text counts as empty and has no spans; rows that repeat an id are each
    judged by their own text, and an empty table gives an empty result.  ``thresholds`` are those of
    ``disclosing_terms``.
    """
    found = find_matches(docs, id, text)
    base = stored(base_spans(found), "private-base")
    told = stored(disclosing_terms(found, **thresholds), "private-told")
    fields = ["row", "order", "kind", "start", "end"]
    spans = base.select(*fields).unionByName(term_spans(found, base, told, everywhere).select(*fields))
    entry = F.struct("order", "kind", "start", "end")
    per_row = spans.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("spans"))
    none = F.array().cast("array<struct<order:int,kind:string,start:bigint,end:bigint>>")
    shown = F.when(F.col("matched") | F.col("spans").isNotNull(), F.col("text")).alias("text")
    rows = found.select("row", "id", "text", "matched").join(per_row, "row", "left")
    return rows.select(F.col("id"), shown, F.coalesce("spans", none).alias("spans")).select(
        quoted("id").alias(id), "text", F.filter("spans", lambda s: s["order"] < len(KINDS)).alias("base_spans"), "spans"
    )


def private_digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """Counts per kind, the hash of the base spans and all spans as text, from ``find_private``."""
    counts = [
        F.size(F.filter("base_spans", _is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS
    ]
    return found.select(
        quoted(id), *counts, F.sha2(_joined(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


def sanitised(found: DataFrame) -> DataFrame:
    """``find_private`` with the text of matched rows in ``sanitised``: values and terms give way to their kind in brackets.

    Removed terms leave nothing.  Where spans overlap, the earlier one's kind stands for both.
    """
    ordered = F.array_sort(
        F.col("spans"), lambda a, b: F.when(a["start"] != b["start"], F.sign(a["start"] - b["start"]).cast("int")).otherwise((a["order"] - b["order"]).cast("int"))
    )
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(done: Column, s: Column) -> Column:
        mark = F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("["), s["kind"], F.lit("]")))
        fresh = s["start"] >= done["at"]
        gap = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(done["out"], gap, mark)).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], s["end"]).alias("at"),
        )

    rest = lambda d: F.concat(d["out"], F.substring(F.col("text"), (d["at"] + 1).cast("int"), F.length("text")))
    (name,) = free(found, "sanitised")
    return found.withColumn(name, F.aggregate(ordered, start, step, rest))
