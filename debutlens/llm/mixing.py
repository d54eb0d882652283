"""Mixing sources to target weights by capped water-filling.

Every source is to give words by its weight, but no more than its own words times a number of epochs: the level of
the water rises over the sources that aren't full until the budget is placed. A source's target is then met by
whole repetitions of all its documents and one fractional repetition, a seeded sample: documents in the order of a
seeded hash, as far as the words go, then those of the following that still fit. Where the order is cut is found by
a radix select over the hash, 4096 sums a source and round, so that no source's documents are ever ranked as a whole.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_side, stored

#: Fixed value: a word, for sizes.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a document's seeded hash, and those that one round of the select tells apart.
HASH_BITS, DIGIT_BITS = 60, 12


def measured(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int) -> DataFrame:
    """row (all of docs), source, size (words), h (place in the source's seeded order) and salt (tells equal rows apart).

    The salt is the row's number in the input: whoever uses the rows twice stores them first.
    """
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("string"), text), 64 - HASH_BITS)
    return docs.select(F.struct("*").alias("row"), F.col(source_col).cast("string").alias("source"), size.alias("size"), h.alias("h"), F.monotonically_increasing_id().alias("salt"))


def weight_of(weights: tuple | dict) -> Column:
    """A source's weight: by name, or by its place among the sources by code point (null last), repeating."""
    if isinstance(weights, dict):
        cases = [F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))) for name, w in weights.items()]
        return F.coalesce(*cases, F.lit(0.0))
    # One row per source is ranked here, never one per document.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return F.get(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int"))


def water_level(sources: DataFrame, budget: float) -> float:
    """Words per unit of weight at which the sources, each up to its cap, hold the budget.

    Starts with no source full; each round clamps those whose share at the present level exceeds their cap and
    shares what they leave among the rest by weight. The level only rises, so that a full source stays full.
    """
    level = 0.0
    while True:
        full = F.col("cap") < F.col("weight") * level
        held, weight = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        risen = (budget - (held or 0.0)) / weight if weight else level
        if risen <= level:
            return level
        level = risen


def targets(rows: DataFrame, weights: tuple | dict, max_epochs: float, share: float) -> DataFrame:
    """Per source: source, source_size, target, reps (whole repetitions) and want (words of the fractional one)."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stored(sums.select("source", "source_size", weight_of(weights).alias("weight"), (F.col("source_size") * float(max_epochs)).alias("cap")), "sources")
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    target = F.least("cap", F.col("weight") * F.lit(water_level(sources, budget)))
    # Rounding may fill a repetition, which then is a whole one.
    whole = F.coalesce(F.floor(F.try_divide(F.round("target"), F.col("source_size"))), F.lit(0))
    want = (F.round("target") - F.col("reps") * F.col("source_size")).cast("long")
    return sources.withColumn("target", target).withColumn("reps", whole.cast("long")).select("source", "source_size", "target", "reps", want.alias("want"))


def cuts(rows: DataFrame, plan: DataFrame) -> tuple[DataFrame, int]:
    """Per source with a fractional repetition: source, prefix (leading bits of the hash at which its order is cut),
    want (words still wanted within that prefix); and how many bits a prefix has.

    A round sums words by the next digit of the hash and goes on within the digit where the words wanted end, until
    no such digit holds more documents than one round has digits. Equal hashes are told apart by no further round.
    """
    state, bits = plan.filter("want > 0").select("source", F.lit(0).cast("long").alias("prefix"), "want"), 0
    while bits < HASH_BITS:
        inside = within(rows, state, bits)
        bits += DIGIT_BITS
        digit = F.shiftright("h", HASH_BITS - bits).alias("digit")
        sums = inside.groupBy("source", "want", digit).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("source").orderBy("digit")  # at most 4096 rows a source
        run = sums.withColumn("upto", F.sum("words").over(order)).filter("upto > want")
        first = run.groupBy("source").agg(F.min_by(F.struct("digit", "want", "upto", "words", "n"), "digit").alias("x"))
        state = stored(first.select("source", F.col("x.digit").alias("prefix"), F.expr("x.want - x.upto + x.words").alias("want"), F.col("x.n").alias("n")), "cuts")
        if (state.agg(F.max("n")).first()[0] or 0) <= 1 << DIGIT_BITS:
            break
    return state.select("source", "prefix", "want"), bits


def within(rows: DataFrame, state: DataFrame, bits: int) -> DataFrame:
    """The rows whose hash starts with their source's prefix of so many bits, with what their source wants."""
    side = state.select(F.col("source").alias("of"), "prefix", "want")
    met = rows.join(small_side(side), F.col("source").eqNullSafe(F.col("of")))
    return (met.filter(F.shiftright("h", HASH_BITS - bits) == F.col("prefix")) if bits else met).drop("of")


def first_fit(group: pd.DataFrame) -> pd.DataFrame:
    """One source's documents around the cut, at most 4096 hashes: taken up to `upto`, then those that still fit.

    Of equal documents at the cut, `copies` are taken; the last pick may exceed what is left, if it misses by less.
    """
    group = group.sort_values("h")
    left, upto, broken, picks = int(group["want"].iloc[0]), int(group["start"].iloc[0]) - 1, False, []
    edge, copies, spare = None, 0, None
    for h, words, n, most in zip(group["h"], group["words"], group["n"], group["most"]):
        fits = words <= left
        if fits and not broken:
            upto, left = int(h), left - int(words)
            continue
        if not broken and n > 1 and left >= most:
            edge, copies = int(h), int(left // most)
            left -= int(copies * most)
        elif fits:
            picks.append(int(h))
            left -= int(words)
        if not fits and (n == 1 or edge in (None, int(h))) and (spare is None or most < spare[0]):
            spare = (int(most), int(h), int(n))
        broken = True
    if spare and spare[0] < 2 * left:
        if spare[2] == 1:
            picks.append(spare[1])
        elif edge in (None, spare[1]):
            edge, copies = spare[1], copies + 1
            if copies == spare[2]:  # all of them
                picks, copies = [*picks, edge], 0
    return pd.DataFrame({"source": [group["source"].iloc[0]], "upto": [upto], "picks": [picks], "edge": pd.array([edge], dtype="Int64"), "copies": [copies]})


def fitted(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source with a fractional repetition: of (the source), upto, picks, edge and copies, stored."""
    state, bits = cuts(rows, plan)
    start = F.shiftleft("prefix", HASH_BITS - bits)
    sums = [F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.max("size").alias("most")]
    near = within(rows, state, bits).groupBy("source", "want", "h", start.alias("start")).agg(*sums)
    fit = near.groupBy("source").applyInPandas(first_fit, "source string, upto long, picks array<long>, edge long, copies long")
    return stored(fit.withColumnRenamed("source", "of"), "fit")


def mix_plan(rows: DataFrame, weights: tuple | dict, max_epochs: float, share: float) -> DataFrame:
    """Per source: source, source_size, target, reps, upto, picks, edge, last; stored. A document is taken `reps` times, and
    once more if its hash is at most `upto` or one of `picks`, or is `edge` and its salt is at most `last`."""
    plan = stored(targets(rows, weights, max_epochs, share), "targets")
    fit = fitted(rows, plan)
    joined = plan.join(small_side(fit), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    # Equal documents at a cut are dealt by salt, with the same select: one word each, as many as there are copies.
    split = stored(fit.filter("copies > 0").select(F.col("of").alias("at"), "edge", "copies"), "edges")
    if split.isEmpty():
        joined = joined.withColumn("last", F.lit(-1).cast("long"))
    else:
        same = F.col("source").eqNullSafe(F.col("at")) & (F.col("h") == F.col("edge"))
        equal = stored(rows.join(small_side(split), same).select("source", F.lit(1).cast("long").alias("size"), F.col("salt").alias("h"), F.col("copies").alias("want")), "equal")
        last = fitted(equal.drop("want"), equal.select("source", "want").distinct()).select("of", F.col("upto").alias("last"))
        joined = joined.join(small_side(last), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    none = F.lit(-1).cast("long")
    whole = [F.coalesce(c, none).alias(c) for c in ("upto", "edge", "last")]
    return stored(joined.select("source", "source_size", "target", "reps", *whole, F.coalesce("picks", F.array().cast("array<bigint>")).alias("picks")), "mix-plan")


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    side = plan.withColumnRenamed("source", "of")
    # The plan has a row per source; should there be more sources than may be broadcast, both sides are shuffled.
    met = rows.join(small_side(side), F.col("source").eqNullSafe(F.col("of")))
    more = (F.col("h") <= F.col("upto")) | F.array_contains("picks", F.col("h")) | ((F.col("h") == F.col("edge")) & (F.col("salt") <= F.col("last")))
    return met.select("row", "size", "source_size", "target", (F.col("reps") + F.when(more, 1).otherwise(0)).cast("int").alias("repeats"))


def mix_sources(docs: DataFrame, *, weights: tuple | dict = (5, 2, 1), max_epochs: float = 3, share: float = 1.0, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 20240229) -> DataFrame:
    """How often the mix takes each document: row (struct of all input columns, whatever their names), size (words),
    source_size, target (words wanted of its source), repeats.

    `weights` are given by source name (others weigh nothing) or repeat over the sources by code point, null last.
    The mix holds `share` of all words, or less where every source with a weight is full. A null source is a source;
    null and empty texts have no words and come along with their neighbours in the order; a source without words
    has the target 0. The order depends on id and text alone, so that reruns agree however the table is split; of
    repeated rows (equal id and text), which are interchangeable, as many are taken as fit. A source's taken words miss
    its target by no more than half of the least document left out around the cut. No document is taken more often than
    `max_epochs`, rounded up. An empty table gives no rows. The rows are stored once, with their sizes.
    """
    rows = stored(measured(docs, id_col, source_col, text_col, seed), "sizes")
    return taken(rows, mix_plan(rows.drop("row"), weights, max_epochs, share))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of `docs`, each as often as it is taken."""
    return mix_sources(docs, **options).select("row", F.explode(F.array_repeat(F.lit(0), F.col("repeats")))).select("row.*")


def mix_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    rows = measured(docs, "doc_id", "source", "text", 20240229)
    # Sizes are counted once: the rows that the plan is made from are the rows that it is applied to.
    slim = stored(rows.select(F.struct("row.doc_id").alias("row"), "source", "size", "h", "salt"), "sizes")
    out = taken(slim, mix_plan(slim, (5, 2, 1), 3, 1.0))
    return out.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))
