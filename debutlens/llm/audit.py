"""Filter interaction audit: what each of five filters removes in every order of applying them.

A table-driven transducer reads the UTF-8 bytes of the texts once: by its state (between words or inside one) and the
byte's class it moves on and emits events, from which words, capitals, code points and symbols are counted; the spans
of words go into a hash table that compares bytes. Documents become five-bit masks of failed filters, and masks are
counted: all 120 orders are read from at most 32 counts per part, whatever the number of documents.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Bytes that the transducer reads at a time.
BLOCK = 1 << 20

# Classes of bytes: space, capital, symbol, continuation of a code point, any other.
SPACE, CAPITAL, SYMBOL, CONTINUATION, OTHER = range(5)
#: What separates words, and the symbols that filter D looks for.
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#$%&*|"
CLASS_OF = np.full(256, OTHER, np.uint8)
CLASS_OF[np.frombuffer(SPACES, np.uint8)] = SPACE
CLASS_OF[ord("A") : ord("Z") + 1] = CAPITAL
CLASS_OF[np.frombuffer(SYMBOLS, np.uint8)] = SYMBOL
CLASS_OF[0x80:0xC0] = CONTINUATION

# States: between words, inside a word. Every class leads to one state from both, so that the states of a whole block
# are a table look-up, shifted by one byte.
BETWEEN, INSIDE = 0, 1
NEXT = np.array([BETWEEN, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
# Events, one bit each, emitted by state and class.
STARTS, ENDS, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8, 16
OF_CLASS = np.array([IS_POINT, IS_POINT | IS_CAPITAL, IS_POINT | IS_SYMBOL, 0, IS_POINT], np.uint8)
EMIT = np.stack([OF_CLASS | np.where(NEXT == INSIDE, STARTS, 0).astype(np.uint8), OF_CLASS | np.where(NEXT == BETWEEN, ENDS, 0).astype(np.uint8)])


class Counts:
    """What the transducer has counted of one text."""

    __slots__ = ("words", "capitals", "points", "symbols", "table")

    def __init__(self):
        self.words = self.capitals = self.points = self.symbols = 0
        #: The hash table of words: looked up by hash, compared byte by byte.
        self.table: set[bytes] = set()

    def fails(self) -> int:
        """The mask of failed filters A to D."""
        a = self.words < 200
        b = 100 * len(self.table) < 50 * self.words
        c = 100 * self.capitals > 3 * self.points
        return a * 1 + b * 2 + c * 4 + (self.symbols > 0) * 8


def transduce(text: bytes | memoryview) -> Counts:
    """One pass over a text, block by block; a word over the edge of blocks is one word."""
    out, state, begun = Counts(), BETWEEN, 0
    view = memoryview(text)
    for at in range(0, len(view), BLOCK):
        classes = CLASS_OF[np.frombuffer(view[at : at + BLOCK], np.uint8)]
        states = np.empty(len(classes), np.uint8)
        states[0], states[1:] = state, NEXT[classes[:-1]]
        events = EMIT[states, classes]
        inside, state = state == INSIDE, NEXT[classes[-1]]
        out.points += int(np.count_nonzero(events & IS_POINT))
        out.capitals += int(np.count_nonzero(events & IS_CAPITAL))
        out.symbols += int(np.count_nonzero(events & IS_SYMBOL))
        starts = (np.flatnonzero(events & STARTS) + at).tolist()
        ends = (np.flatnonzero(events & ENDS) + at).tolist()
        if inside:
            starts.insert(0, begun)  # the word that an earlier block began
        if len(starts) > len(ends):
            begun = starts.pop()
        out.words += len(ends)
        out.table.update([bytes(view[a:b]) for a, b in zip(starts, ends)])
    if state == INSIDE:
        out.words += 1
        out.table.add(bytes(view[begun:]))
    return out


def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, texts, by the masks of their failed filters A to D."""
    for batch in batches:
        *rest, texts = batch.columns
        found = pa.array([transduce(t.as_buffer() or b"").fails() if t.is_valid else transduce(b"").fails() for t in texts], pa.int32())
        yield pa.RecordBatch.from_arrays([*rest, found], names=[*batch.schema.names[:-1], "mask"])


def bits(order: str) -> int:
    return sum(1 << FILTERS.index(f) for f in order)


def steps() -> Column:
    """array<struct<filter_order, step, own, before>>: all orders' steps with the bits of their filter and of those before.

    Given as one JSON text, which the optimizer turns into one constant.
    """
    rows = [{"filter_order": o, "step": i + 1, "own": bits(o[i]), "before": bits(o[:i])} for o in ORDERS for i in range(len(o))]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, own: int, before: int>>")


def failed_filters(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Counts by part (null: empty string) and mask of failed filters: part, mask, n, good, toxic.

    A to D come from the transducer. E, a copy of a smaller id's text, needs no join of rows by text: copies are
    counted per (digest of text, part, labels) before they meet, with the smallest id and its rows, so that a group of
    copies that holds most rows is a few rows when it is shuffled; texts are equal if their SHA-256 digests and
    lengths are. Null texts are empty ones. Null ids are larger than all others and never have a label; rows
    that share id and text are no copies of each other. A label counts if any of an id's label rows has it.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.struct(F.sha2(text.cast("binary"), 256).alias("sha"), F.octet_length(text).alias("bytes"))
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), part.alias("part"), F.unhex(key["sha"]).alias("sha"), key["bytes"].alias("bytes"), text.alias("text"))
    read = rows.mapInArrow(masks, "id long, part string, sha binary, bytes int, mask int")
    said = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # Null ids meet no label; a second key deals them over the tasks of the join.
    salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("sha"), F.lit(4096))).otherwise(F.lit(0).cast("long"))
    known = read.withColumn("salt", salt).join(said.filter("id is not null").withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left")
    kind = ["sha", "bytes", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    per_id = known.groupBy("id", *kind).agg(F.count(F.lit(1)).alias("n"))
    # Nulls order last: (is null, id).
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("least")
    per_kind = per_id.groupBy("sha", "bytes", "part", "mask", "good", "toxic").agg(F.sum("n").alias("n"), least)
    # One row per part and labels of a text, however many copies it has.
    first = F.min(F.struct("least.none", "least.id")).over(Window.partitionBy("sha", "bytes"))
    originals = F.when(F.struct("least.none", "least.id") == first, F.col("least.n")).otherwise(F.lit(0))
    told = per_kind.select("part", "mask", "good", "toxic", "n", originals.alias("originals"))
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("originals").alias("n")), F.struct((F.col("mask") + bits("E")).alias("mask"), (F.col("n") - F.col("originals")).alias("n")))
    counted = told.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.*")
    n = F.col("n")
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"))


def audit_filters(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Rows as in `failed_filters`; zeros are rows too. `shapley`, a filter's removals over all orders, is read from the
    counts: a document that fails k filters falls to each of them in 120 / k orders. Other columns of either table may
    have any name. An empty table gives no rows.
    """
    counts = stored(failed_filters(docs, labels, **options), "masks")  # at most 32 rows per part
    mask, own, before, n = F.col("mask"), F.col("own"), F.col("before"), F.col("n")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    total = lambda when, what=n: F.sum(F.when(when, what).otherwise(0)).cast("long")
    orders = (F.lit(len(ORDERS)) / F.bit_count("mask")).cast("long")
    per_step = counts.select("part", "mask", "n", "good", "toxic", F.explode(steps()).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    return per_step.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == own).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        total(fails, n * orders).alias("shapley"),
    )


def audit_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    return audit_filters(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


AUDIT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  m AS (SELECT doc_id, part,
      (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
      + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT
      + 16 * coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, min(doc_id) OVER (PARTITION BY t) IS NOT NULL)::INT AS mask
    FROM d),
  l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
  c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
  f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS b),
  o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bs
    FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
  s AS (SELECT filter_order, i AS step, bs[i] AS own, list_sum(list_concat([0], bs[1 : i - 1])) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
  r AS (SELECT part, filter_order, step, own,
      sum(CASE WHEN mask & (own + before)::INT = 0 THEN n ELSE 0 END)::BIGINT AS kept,
      sum(CASE WHEN mask & own != 0 AND mask & before::INT = 0 THEN n ELSE 0 END)::BIGINT AS removed,
      sum(CASE WHEN mask & own != 0 AND mask & before::INT != 0 THEN n ELSE 0 END)::BIGINT AS redundant,
      sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
      sum(CASE WHEN mask & own != 0 AND mask & before::INT = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
      sum(CASE WHEN mask & own != 0 AND mask & before::INT = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
