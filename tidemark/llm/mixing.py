"""Mixing sources to target weights by Pareto order sampling.

A source that is to give so many words takes each of its documents an expected number of times that rises with the
document's size, up to a most.  The whole part of that number are certain copies; what is left is the probability of
one more copy, different for different documents.  These are drawn by Pareto order sampling: documents are
ranked by random odds divided by inclusion odds and taken in that order while their words fit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import quoted, stored, with_group

#: What is counted as a word.
WORD = r"[^\x20\x09-\x0D]+"
#: Ranks are numbers below 2 to this power.
RANK_BITS = 52
#: Bits of the rank that one pass over the rows settles.
STEP_BITS = 8
#: Ranks of one source that may be added up by one task.
TOGETHER = 10_000
#: How often a source's order is gone through for documents that fit, and the share of its target from which what is
#: missing is worth another turn: only where a single document is a large part of the target.
TURNS, NEAR = 3, 0.02
#: Exchanges that bring a sample nearer to its target, at most.
CLOSINGS = 2
#: Expected copies rise with this power of a document's words.
POWER = 0.5


def _source_key(source: Column) -> Column:
    """Sorts as sources by code point with null last, and is never null."""
    return F.coalesce(F.concat(F.lit("a"), source.cast("string")), F.lit("b"))


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _chance(id: Column, text: Column, seed: int) -> Column:
    """A number between 0 and 1 that only the seed, the id and the text decide."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), id, text), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def source_targets(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Per source of ``rows`` (key, size): its size, number of rows and target.

    The targets add up to ``share`` of all sizes, by ``weights`` repeated along the sources in order.  A
    target above ``most`` times its source's size is lowered to that and the excess goes to the others by
    weight, until none is above.  Sources are numbered by a range partitioning and the lengths of
    its partitions, so there may be any number of them.
    """
    sources = rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    placed = stored(
        sources.repartitionByRange("key").sortWithinPartitions("key").withColumn("id", F.monotonically_increasing_id()),
        "mix-sources",
    )
    part, offset = F.shiftright("id", 33).cast("int"), F.col("id").bitwiseAND((1 << 33) - 1)
    before, first = 0, [F.lit(-1), F.lit(0).cast("long")]
    for number, length in sorted(placed.groupBy(part.alias("part")).count().collect()):
        first += [F.lit(number), F.lit(before).cast("long")]
        before += length
    weight = _weight_at(F.element_at(F.create_map(*first), part) + offset, weights)
    weighted = stored(placed.select("key", "source_size", "n", weight.alias("weight")), "mix-weights")

    total = share * (weighted.agg(F.sum("source_size")).first()[0] or 0)
    limit, level, capped = F.col("source_size") * most, 0.0, -1
    while True:
        over = F.col("weight") * level > limit
        n, full, free_weight = weighted.agg(
            F.sum(F.when(over, 1).otherwise(0)),
            F.sum(F.when(over, limit).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
        ).first()
        if n is None or n == capped or not free_weight:
            break
        capped, level = n, (total - full) / free_weight
    return weighted.select("key", "source_size", "n", F.least(F.col("weight") * level, limit).alias("target"))


def _weight_at(position: Column, weights: Sequence[float]) -> Column:
    out = F.lit(float(weights[-1]))
    for i, w in enumerate(weights[:-1]):
        out = F.when(position % len(weights) == i, float(w)).otherwise(out)
    return out


def _expected(level: Column, power: Column, most: Column) -> Column:
    """How often a document is taken on average; one without words counts as one word."""
    return F.least(level * F.pow(F.greatest("size", F.lit(1)).cast("double"), power), most)


def source_levels(sizes: DataFrame, targets: DataFrame, power: float = POWER, most: float = 2.0) -> DataFrame:
    """key and level, with which the documents' expected copies add up to the words of their source's target.

    ``sizes`` has a row per source and size of a document (key, size, n).  The largest documents are held at ``most``
    copies, as few sizes of them as will do: from the largest size down, the first whose documents are not over with the
    level that all larger ones being held would give is the level's.
    """
    weight = F.pow(F.greatest("size", F.lit(1)).cast("double"), F.lit(power))
    words = (F.col("size") * F.col("n")).cast("double")
    down = Window.partitionBy("key").orderBy(F.col("size").desc())
    full = F.coalesce(F.sum(words).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) * most
    free = F.sum(weight * words).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.col("target") - full) / F.nullif(free, F.lit(0.0))
    each = sizes.join(targets.select("key", "target"), "key").select("key", "size", level.alias("level"), weight.alias("weight"))
    fits = F.when(F.col("level") * F.col("weight") <= most, F.struct("size", "level"))
    return each.groupBy("key").agg(F.coalesce(F.max(fits)["level"], F.lit(float(1 << 60))).alias("level"))


def _with_rank(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's figures, their certain copies and the probability of one more, and their rank.

    The rank is the random odds divided by the inclusion odds.  The quotient q is kept as q / (1 + q), which
    orders alike and lies between 0 and 1; rows that have no part of a copy left have no rank.
    """
    rows = with_group(rows, sources, ["key"], "n")
    part = F.col("part")
    odds = F.col("chance") * (1 - part)
    place = odds / (odds + part * (1 - F.col("chance")))
    rank = F.least(F.floor(place * float(1 << RANK_BITS)), F.lit((1 << RANK_BITS) - 1)).cast("long")
    return (
        rows.withColumn("expected", _expected(F.col("level"), F.col("power"), F.col("most")))
        .withColumn("whole", F.floor("expected").cast("long"))
        .withColumn("part", F.col("expected") - F.col("whole"))
        .withColumn("rank", F.when(part > 0, rank))
    )


def _cutoffs(ranked: DataFrame) -> DataFrame:
    """Per source, the lowest rank that is not taken and the words that are still missing then.

    Words are added up by the leading bits of the rank, then, within the one group of ranks where a
    source's words run out, by the following bits, until those groups are short.
    """
    shift, left, found = RANK_BITS - STEP_BITS, ranked.select("key", "rank", "size", F.col("rest").alias("room")), None
    while True:
        own = Window.partitionBy("key").orderBy("bin")
        bins = (
            left.groupBy("key", F.shiftright("rank", shift).alias("bin"))
            .agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.max("room").alias("room"))
            .withColumn("until", F.sum("words").over(own))
        )
        over = F.col("until") > F.col("room")
        cut = stored(
            bins.groupBy("key").agg(
                F.min(F.when(over, F.col("bin"))).alias("bin"),
                F.max(F.when(~over, F.col("until"))).alias("taken"),
                F.max("room").alias("room"),
                F.min(F.when(over, F.struct("bin", "n"))).getField("n").alias("n"),
            )
            .withColumn("room", F.col("room") - F.coalesce("taken", F.lit(0)))
            .select("key", "bin", "room", "n"),
            "mix-cut",
        )
        done = cut.filter("bin IS NULL").select("key", F.lit(1 << RANK_BITS).cast("long").alias("cut"), "room")
        found = done if found is None else found.unionByName(done)
        rest = cut.filter("bin IS NOT NULL")
        longest = rest.agg(F.max("n")).first()[0] or 0
        if shift == 0 or longest <= TOGETHER:
            break
        left = left.drop("room").withColumn("bin", F.shiftright("rank", shift)).join(rest.drop("n"), ["key", "bin"])
        left, shift = left.drop("bin"), max(0, shift - STEP_BITS)
    if shift:
        own = Window.partitionBy("key").orderBy("rank")
        rows = (
            left.drop("room").withColumn("bin", F.shiftright("rank", shift)).join(rest.drop("n"), ["key", "bin"])
            .groupBy("key", "rank").agg(F.sum("size").alias("words"), F.max("room").alias("room"))
            .withColumn("until", F.sum("words").over(own))
        )
        over = F.col("until") > F.col("room")
        last = rows.groupBy("key").agg(
            F.min(F.when(over, F.col("rank"))).alias("cut"),
            (F.max("room") - F.coalesce(F.max(F.when(~over, F.col("until"))), F.lit(0))).alias("room"),
        )
    else:
        last = rest.select("key", F.col("bin").alias("cut"), "room")
    return found.unionByName(last)


def _closing(drawn: DataFrame, cuts: DataFrame) -> DataFrame:
    """Per source the ranks that leave and join the sample, so that its words come nearest to the target, and the words missing then.

    At most one document of each: of all sizes in the sample and outside it, with none as a size of 0, the two that
    make up best for the words still missing, the smaller ones on a tie.  Of a size the last in the sample leaves and
    the first outside joins.  Documents are counted by size first, so a source brings no more rows than it has sizes.
    """
    sizes = drawn.filter("size > 0").groupBy("key", "size", "first").agg(
        F.max("rank").alias("last"), F.min("rank").alias("next"), F.max("room").alias("room")
    )
    none = F.lit(None).cast("long")
    outs = sizes.filter("first").select("key", (F.col("room") + F.col("size")).alias("at"), F.struct("size", F.col("last").alias("rank")).alias("out"))
    outs = outs.unionByName(cuts.select("key", F.col("room").alias("at"), F.struct(F.lit(0).cast("long").alias("size"), none.alias("rank")).alias("out")))
    ins = sizes.filter("NOT first").select("key", F.col("size").cast("double").alias("at"), F.struct("size", F.col("next").alias("rank")).alias("joins"))
    ins = ins.unionByName(cuts.select("key", F.lit(0.0).alias("at"), F.struct(F.lit(0).cast("long").alias("size"), none.alias("rank")).alias("joins")))
    order = Window.partitionBy("key").orderBy("at")
    below = F.last("joins", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    above = F.first("joins", ignorenulls=True).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    pairs = outs.unionByName(ins, allowMissingColumns=True).withColumns({"below": below, "above": above}).filter("out IS NOT NULL")
    each = pairs.select("key", "at", "out", F.explode(F.array("below", "above")).alias("joins")).filter("joins IS NOT NULL")
    choice = F.struct(
        F.abs(F.col("at") - F.col("joins.size")).alias("far"), F.col("out.size").alias("o"), F.col("joins.size").alias("i"),
        F.col("out.rank").alias("leaves"), F.col("joins.rank").alias("joins"),
    )
    best = each.select("key", choice.alias("best"), (F.col("at") - F.col("joins.size")).alias("now"))
    return best.groupBy("key").agg(F.min_by(F.struct("best", "now"), "best").alias("of")).select("key", "of.best.leaves", "of.best.joins", "of.now")


def mixing_plan(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 20240229,
    power: float = POWER,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The rows (id, key, size, chance) and per source what decides how often each is taken.

    A document of s words is expected to be taken ``level * s ** power`` times, ``most`` at most, where its source's
    level is such that the words add up to the target.  The whole part of it are certain copies, the rest the
    probability of one more; the documents are ordered by random odds divided by inclusion odds and taken while
    their words fit (a fixed size in words).  Where one does not fit, those behind it that do are taken in turn, ``TURNS``
    times in all, while more than ``NEAR`` of the target is missing.  Then one document joins the sample, one leaves, or both do, where that brings it nearer
    to the target, ``CLOSINGS`` times at most while it is not within ``NEAR`` of it.
    """
    rows = stored(
        docs.select(
            quoted(id).alias("id"),
            _source_key(quoted(source)).alias("key"),
            _size(quoted(text)).alias("size"),
            _chance(quoted(id), quoted(text), seed).alias("chance"),
        ),
        "mix-rows",
    )
    targets = stored(source_targets(rows, weights, share, most), "mix-targets")
    sizes = stored(rows.groupBy("key", "size").agg(F.count("*").alias("n")), "mix-by-size")
    levels = source_levels(sizes, targets, power, most)
    certain = sizes.join(levels, "key").groupBy("key").agg(
        F.max("level").alias("level"), F.sum(F.floor(_expected(F.col("level"), F.lit(float(power)), F.lit(float(most)))) * F.col("size") * F.col("n")).alias("certain")
    )
    sources = stored(
        targets.join(certain, "key").select(
            "key", "source_size", "n", "target", "level", F.lit(float(power)).alias("power"), F.lit(float(most)).alias("most"),
            F.greatest(F.col("target") - F.col("certain"), F.lit(0.0)).alias("rest"),
        ),
        "mix-sources",
    )
    ranked = stored(_with_rank(rows, sources).filter("rank IS NOT NULL"), "mix-ranked")
    narrow = ranked.select("key", "rank", "size")
    step = "array<struct<from:bigint,until:bigint,room:double>>"
    drawn = sources.select("key", F.col("n").alias("rows"), F.lit(0).cast("long").alias("from"), F.col("rest").alias("room"), F.array().cast(step).alias("steps"), (F.col("target") * NEAR).alias("enough"))
    for turn in range(TURNS):
        drawn = stored(drawn, "mix-drawn")
        open_ = drawn.filter("room > enough")
        if turn and open_.isEmpty():
            break
        fits = (F.col("rank") >= F.col("from")) & (F.col("size") <= F.col("room"))
        left = with_group(narrow, open_, ["key"], "rows").filter(fits)
        cuts = _cutoffs(left.select("key", "rank", "size", F.col("room").alias("rest"))).withColumnRenamed("room", "now")
        until = F.coalesce("cut", "from")
        done = F.struct("from", until.alias("until"), "room")
        drawn = drawn.join(stored(cuts, "mix-cutoffs"), "key", "left").select(
            "key", "rows", "enough", until.alias("from"), F.coalesce("now", "room").alias("room"), F.concat("steps", F.array(done)).cast(step).alias("steps")
        )
    drawn = stored(drawn.withColumn("swapped", F.array().cast("array<bigint>")), "mix-drawn")
    for turn in range(CLOSINGS):
        open_ = drawn.filter(F.abs("room") > F.col("enough")) if turn else drawn
        if turn and open_.isEmpty():
            break
        closing = _closing(with_group(narrow, open_, ["key"], "rows").withColumn("first", _drawn()), open_.select("key", "room"))
        swapped = F.concat("swapped", F.array_compact(F.array("leaves", "joins")))
        drawn = drawn.join(closing, "key", "left").select("key", "rows", "enough", "steps", F.coalesce(swapped, "swapped").alias("swapped"), F.coalesce("now", "room").alias("room"))
        drawn = stored(drawn, "mix-drawn")
    plan = stored(sources.join(drawn.select("key", "steps", "swapped"), "key"), "mix-plan")
    return rows, plan


def _drawn() -> Column:
    """Whether a ranked row was taken in one of the turns, turned over as often as it was swapped afterwards."""
    rank, size = F.col("rank"), F.col("size")
    taken = F.exists("steps", lambda s: (rank >= s["from"]) & (rank < s["until"]) & (size <= s["room"]))
    return taken != (F.size(F.filter("swapped", lambda x: x == rank)) % 2 == 1)


def _copies() -> Column:
    return F.col("whole") + F.when(F.col("rank").isNotNull() & _drawn(), 1).otherwise(0)


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken (words, repeats counted).

    Size is the number of words; null and empty texts have none and are taken without adding any.  A null
    source is a source of its own, behind all others.  Rows equal in id and text are taken or left
    together.  The same rows and seed give the same result.  An empty table gives an empty result.
    """
    rows, plan = mixing_plan(docs, **options)
    return _with_rank(rows, plan).select(
        quoted("id").alias(options.get("id", "doc_id")), "size", "source_size", "target", (F.col("size") * _copies()).alias("taken")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, with their columns only.

    The plan per source is applied where the documents are: those of frequent sources do not move.
    """
    id, text, source = (options.get(k, d) for k, d in (("id", "doc_id"), ("text", "text"), ("source", "source")))
    seed = options.get("seed", 20240229)
    _, plan = mixing_plan(docs, **options)
    whole_row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    rows = docs.select(
        whole_row, _source_key(quoted(source)).alias("key"), _size(quoted(text)).alias("size"), _chance(quoted(id), quoted(text), seed).alias("chance")
    )
    taken = _with_rank(rows, plan).withColumn("copies", _copies().cast("int")).filter("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")
