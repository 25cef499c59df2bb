"""Licence scans: units of text against licence templates by the Dice coefficient of their word bigrams.

All of it is DataFrame functions.  A unit with n different bigrams can reach the threshold t with a template
of m only if m t / (2 - t) <= n <= m (2 - t) / t, and must have t (n + m) / 2 of the bigrams in common.  So it misses
few of the template's bigrams, and one of any m - t m / (2 - t) + 1 of them is in it.  That many are
picked from each template as its signs; a document without any sign is done with after one look.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .licence_texts import templates as known_templates
from .shared import quoted, stored

THRESHOLD = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str) -> list[str]:
    """Words of ASCII letters and digits, A-Z as a-z; everything else separates."""
    return re.sub("[^a-z0-9]+", " ", text.translate(str.maketrans(_UPPER, _LOWER))).split()


def _words(text: Column) -> Column:
    plain = F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+", " ")
    return F.split(F.trim(plain), " ")


def _bigrams(text: Column) -> Column:
    """The distinct bigrams of a text; none below two words."""
    words = _words(text)
    return F.array_distinct(
        F.transform(
            F.arrays_zip(words.alias("a"), F.slice(words, 2, F.size(words)).alias("b")),
            lambda pair: F.when(pair["b"].isNotNull(), F.concat_ws(" ", pair["a"], pair["b"])),
        )
    )


def _real(bigrams: Column) -> Column:
    return F.array_compact(bigrams)


def _indexed(templates: Sequence[tuple[str, str]], threshold: float) -> list[tuple[str, int, list[str], list[str]]]:
    """(licence, m, bigrams, signs); of equal bigram sets the first licence stays.

    The signs are the bigrams of the longest words, which ordinary text is least likely to have.
    """
    out, seen = [], set()
    for licence, text in templates:
        words = normalised(text)
        bigrams = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
        if bigrams and tuple(bigrams) not in seen:
            seen.add(tuple(bigrams))
            need = math.ceil(threshold * len(bigrams) / (2 - threshold) - 1e-9)
            out.append((licence, len(bigrams), bigrams, sorted(bigrams, key=lambda b: (-len(b), b))[: len(bigrams) - need + 1]))
    return out


def licence_units(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
    id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The rows (row, id) and their units that match: row, unit (the text), licence, dice.

    Units are every line, every block between blank lines and the whole text, equal ones of a document once.  A
    unit gets the licence of greatest Dice coefficient, among equals the first by name.
    """
    spark = docs.sparkSession
    index = _indexed(templates or known_templates(), threshold)
    signs = sorted({sign for *_, own in index for sign in own})
    body = F.coalesce(quoted(text), F.lit(""))
    found = stored(
        docs.select(quoted(id).alias("id"), body.alias("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("sign", F.coalesce(F.arrays_overlap(_real(_bigrams(F.col("text"))), F.array(*map(F.lit, signs))), F.lit(False)))
        .withColumn("text", F.when(F.col("sign"), F.col("text"))),
        "licence-rows",
    )
    split = F.concat(F.split("text", "\n"), F.split("text", r"\n[ \t\r]*\n"), F.array("text"))
    units = found.filter("sign").select("row", F.explode(F.array_distinct(split)).alias("unit"))
    units = units.withColumn("bigrams", _real(_bigrams(F.col("unit")))).withColumn("n", F.size("bigrams")).filter("n > 0")
    # the templates are a parameter of the scan, some hundreds of short texts
    table = spark.createDataFrame(
        [(k, licence, m, bigrams) for k, (licence, m, bigrams, _) in enumerate(index)], "template int, licence string, m int, own array<string>"
    )
    by_sign = spark.createDataFrame([(sign, k, m) for k, (_, m, _, own) in enumerate(index) for sign in own], "sign string, template int, m int")
    fits = (F.col("n") >= F.col("m") * threshold / (2 - threshold) - 1e-9) & (F.col("n") <= F.col("m") * (2 - threshold) / threshold + 1e-9)
    asked = (
        units.withColumn("signs", F.array_intersect("bigrams", F.array(*map(F.lit, signs))))
        .filter(F.size("signs") > 0)
        .select("row", "unit", "bigrams", "n", F.explode("signs").alias("sign"))
        .join(F.broadcast(by_sign), "sign")
        .filter(fits)
        .drop("sign", "m")
        .join(F.broadcast(table), "template")
    )
    dice = F.size(F.array_intersect("bigrams", "own")) * 2.0 / (F.col("n") + F.col("m"))
    matches = (
        asked.select("row", "unit", "licence", dice.alias("dice"))
        .filter(F.col("dice") >= threshold)
        .groupBy("row", "unit")
        .agg(F.min(F.struct((-F.col("dice")).alias("dice"), "licence")).alias("best"))
        .select("row", "unit", F.col("best.licence").alias("licence"), (-F.col("best.dice")).alias("dice"))
    )
    return found.select("row", "id"), stored(matches, "licence-units")


def scan_licences(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: id, n_matches, licences (sorted, comma-joined), best_licence, best_dice.

    n_matches counts the different units that match.  Null and empty texts match nothing; without a match licences is
    empty and the best ones are null.  Rows that repeat an id are each scanned; an empty table gives an empty
    result.  Other columns are not read.
    """
    rows, units = licence_units(docs, id=id, text=text, **options)
    per_row = units.groupBy("row").agg(
        F.count("*").alias("n_matches"),
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"),
        F.min(F.struct((-F.col("dice")).alias("dice"), "licence")).alias("best"),
    )
    return rows.join(per_row, "row", "left").select(
        quoted("id").alias(id),
        F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"),
        F.coalesce("licences", F.lit("")).alias("licences"),
        F.col("best.licence").alias("best_licence"),
        (-F.col("best.dice")).alias("best_dice"),
    )


def oracle_sql(threshold: float = THRESHOLD) -> str:
    """The scan of ``documents`` as SQL, every unit against every template."""
    values = ", ".join(
        "('{}', [{}])".format(licence, ", ".join(f"'{b}'" for b in bigrams))
        for licence, _, bigrams, _ in _indexed(known_templates(), threshold)
    )
    return f"""
WITH templates(licence, own) AS (VALUES {values}),
units AS (
    SELECT doc_id, unnest(list_distinct(list_concat(
        string_split(coalesce(text, ''), chr(10)),
        regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r]*\\n'),
        [coalesce(text, '')]))) AS unit
    FROM documents
), worded AS (
    SELECT doc_id, unit, string_split(trim(regexp_replace(
        translate(unit, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w
    FROM units
), paired AS (
    SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigrams
    FROM worded WHERE len(w) > 1
), judged AS (
    SELECT doc_id, unit, licence, len(list_intersect(bigrams, own)) * 2.0::DOUBLE / (len(bigrams) + len(own)) AS dice
    FROM paired JOIN templates
    ON len(bigrams) BETWEEN len(own) * {threshold} / (2 - {threshold}) - 1e-9 AND len(own) * (2 - {threshold}) / {threshold} + 1e-9
), matched AS (
    SELECT doc_id, unit, min({{'dice': -dice, 'licence': licence}}) AS best
    FROM judged WHERE dice >= {threshold} GROUP BY doc_id, unit
), per_doc AS (
    SELECT doc_id, count(*) AS n_matches, string_agg(DISTINCT best.licence, ',' ORDER BY best.licence) AS licences, min(best) AS best
    FROM matched GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_matches, 0) AS n_matches, coalesce(licences, '') AS licences,
       best.licence AS best_licence, -best.dice AS best_dice
FROM documents d LEFT JOIN per_doc USING (doc_id)
"""
