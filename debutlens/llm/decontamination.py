"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts become word hashes; of every window of six 5-word grams the smallest gram hash is kept as fingerprint, so
two texts that share ten words share a fingerprint. Document fingerprints are joined with those of the
benchmark; the places of hits meet the document's words again, and each is extended to all 10-word windows around
it, which are looked up whole. Items shorter than a window are sought where their first word stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, stored

#: What separates words once A-Z are lower-cased; letters of either case may pass before that.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered_words(text: Column) -> Column:
    """array<string>, A-Z lower-cased (whole-ASCII words by the faster function)."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")
    return F.transform(words, lambda w: F.when(F.length(w) == F.octet_length(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER)))


def word_hashes(text: Column) -> Column:
    """array<long>, a hash for each word."""
    return F.transform(lowered_words(text), lambda w: F.xxhash64(w))


def windows(hashes: str, size: int) -> Column:
    """array<long>, a hash for each run of `size` words; empty for shorter texts."""
    at = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)])
    return F.when(F.size(hashes) >= size, F.transform(F.sequence(F.lit(0), F.size(hashes) - size), at)).otherwise(F.array().cast("array<bigint>"))


def winnowed(grams: str, size: int) -> Column:
    """array<struct<pos, fp>>: grams that are the smallest of some window of `size` consecutive grams."""
    lows = F.transform(F.sequence(F.lit(0), F.size(grams) - size), lambda i: F.least(*[F.get(grams, i + j) for j in range(size)]))
    pairs = F.transform(grams, lambda g, p: F.struct(p.alias("pos"), g.alias("fp")))
    # F.greatest passes over the nulls that stand for windows outside the text
    kept = lambda lows: F.filter(pairs, lambda x: F.greatest(*[F.get(lows, x["pos"] - j) for j in range(size)]) == x["fp"])
    one = F.transform(F.array(lows), kept)[0]
    return F.when(F.size(grams) >= size, one).otherwise(F.filter(pairs, lambda _: F.lit(False)))


#: First words of short items that a predicate may list.
FIRST_WORDS = 10_000


class Benchmark:
    """Item windows and fingerprints as stored tables: windows(w, len, said, first, items), grams(fp)."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, window: int, gram: int):
        texts = items.select(F.col(id_col).alias("item"), lowered_words(F.col(text_col)).alias("words")).filter(F.size("words") > 0)
        rows = texts.select("item", "words", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
        own = windows("h", window)
        for size in range(1, window):
            own = F.when(F.size("h") == size, windows("h", size)).otherwise(own)
        length = F.least(F.size("h"), F.lit(window))
        first = F.when(length < window, F.get("h", F.lit(0)))
        said = F.transform(own, lambda w, i: F.struct(w.alias("w"), F.array_join(F.slice("words", i + 1, length), " ").alias("said")))
        cut = rows.select("item", length.alias("len"), first.alias("first"), F.explode_outer(said).alias("x")).select("item", "len", "first", "x.*").filter("w is not null")
        self.windows = stored(cut.groupBy("w", "len", "said").agg(F.min("first").alias("first"), F.collect_set("item").alias("items")), "item-windows")
        #: How many items the windows name in all, which bounds the table's bytes.
        self.named = self.windows.agg(F.sum(F.size("items"))).first()[0] or 0
        grams = rows.filter(F.size("h") >= window).select(windows("h", gram).alias("g")).select(F.explode_outer(winnowed("g", window - gram + 1)).alias("x"))
        self.grams = stored(grams.select(F.col("x.fp").alias("fp")).filter("fp is not null").distinct(), "item-grams")
        short = self.windows.filter(F.col("len") < window)
        #: Lengths of items too short for a window: at most window - 1 numbers.
        self.short = sorted(r["len"] for r in short.select("len").distinct().collect())
        firsts = short.select("first").distinct()
        #: Their first words, if they are few enough for a predicate.
        self.firsts = [r["first"] for r in firsts.collect()] if self.short and firsts.count() <= FIRST_WORDS else None


def hash_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row (all columns), place (the row's number), id, n_words and h, the words' hashes: numbered and stored once for all
    that follows."""
    hashes = word_hashes(F.col(text_col).cast("string")).alias("h")
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place"), F.col(id_col).alias("id"), hashes)
    return stored(rows.select("row", "place", "id", F.size("h").cast("long").alias("n_words"), "h"), "word-hashes")


def find_contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, gram: int = 5) -> DataFrame:
    """Per input row: row (struct of all input columns, whatever their names), place, id, n_words, spans
    array<struct<start, len>>, items array.

    A span is a hit window of the document in words (half-open from start), items are the ids of items with a
    hit; both are null without one. An item of fewer words than `window`, but not none, is one window. Null and
    empty texts have no words and no hits; repeated rows are judged each; an empty table on either side gives no
    rows or no hits. The item side is broadcast while counted small, else both sides are shuffled by hash; the
    document side then sends a place and a number per fingerprint. The input is read once, numbered and stored; all
    later steps read that table.
    """
    bench = Benchmark(items, item_id, item_text, window, gram)
    rows = hash_words(docs, id_col, text_col)
    marked = rows.select("place", windows("h", gram).alias("g")).select("place", winnowed("g", window - gram + 1).alias("marks"))
    # Outer explodes: for an inner one the optimizer would test the arrays' sizes first, computing them twice.
    hits = marked.select("place", F.explode_outer("marks").alias("m")).select("place", F.col("m.pos").alias("pos"), F.col("m.fp").alias("fp"))
    near = stored(hits.join(small_side(bench.grams), "fp").groupBy("place").agg(F.collect_set("pos").alias("at")), "gram-hits")
    # Extension: every window that holds a gram hit, cut from the document's own words.
    around = F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(F.greatest(p - (window - gram), F.lit(0)), F.least(p, F.col("n_words").cast("int") - window)))))
    cut = lambda i, size: F.struct(i.cast("int").alias("start"), F.lit(size).alias("len"), F.xxhash64(*[F.get("h", i + j) for j in range(size)]).alias("w"))
    places = small_side(near, rows=near.agg(F.sum(F.size("at"))).first()[0] or 0)
    spread = rows.filter(F.col("n_words") >= window).join(places, "place").select("place", F.transform(around, lambda i: cut(i, window)).alias("x"))
    if bench.short:
        whole = F.lit(True) if bench.firsts is None else None
        may = lambda i: whole if whole is not None else F.get("h", i).isin(bench.firsts)
        starts = F.filter(F.transform("h", lambda _, i: i), may)
        of = lambda size: F.transform(F.filter("starts", lambda i: i <= F.col("n_words") - size), lambda i: cut(i, size))
        spread = spread.union(rows.select("place", "n_words", "h", starts.alias("starts")).select("place", F.concat(*[of(size) for size in bench.short])))
    spread = spread.select("place", F.explode_outer("x").alias("x")).select("place", "x.*")
    met = spread.join(small_side(bench.windows.drop("first"), rows=bench.named), ["w", "len"]).groupBy("place").agg(F.collect_list(F.struct("start", "len", "said", "items")).alias("met"))
    # Hashes only lead here: the windows met are compared with the document's own words, cut anew for these documents.
    met = stored(met, "met")
    texts = rows.select("place", F.col("row")[text_col].cast("string").alias("t"))
    told = texts.join(small_side(met, rows=met.agg(F.sum(F.size("met"))).first()[0] or 0), "place").select("place", "met", lowered_words(F.col("t")).alias("words"))
    same = F.filter("met", lambda x: F.array_join(F.slice("words", x["start"] + 1, x["len"]), " ") == x["said"])
    found = told.select("place", F.inline(same)).select("place", F.struct("start", "len").alias("span"), "items")
    per_row = stored(found.groupBy("place").agg(F.array_sort(F.collect_set("span")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items")), "hits")
    named = per_row.agg(F.sum(F.size("spans") + F.size("items"))).first()[0] or 0
    return rows.select("row", "place", "id", "n_words").join(small_side(per_row, rows=named), "place", "left")


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no window of an item."""
    return find_contamination(docs, items, **options).filter("spans is null").select("row.*")


def covered(spans: Column) -> Column:
    """Words that the sorted spans cover together."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["len"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(F.lit(0), end - F.greatest(s["start"], acc["end"]))).alias("n"))

    return F.aggregate(F.coalesce(spans, F.array().cast("array<struct<start:int,len:int>>")), zero, add, lambda a: a["n"]).cast("long")


def contamination_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    names = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda i: i.cast("string")))
    out = found.select(F.col("id").alias("doc_id"), "n_words", covered(F.col("spans")).alias("n_hit"), names.alias("names"))
    return out.select("doc_id", "n_words", "n_hit", F.size("names").cast("long").alias("n_items"), F.sha2(F.array_join("names", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


CONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
    FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
  dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS s
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
  hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN bw USING (s, n)),
  word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
  it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN it USING (doc_id)
"""
