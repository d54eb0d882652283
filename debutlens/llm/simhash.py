"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments, and each segment has a table of buckets keyed by (segment, value). Fingerprints
a few bits apart differ little in some segment, so each one enumerates the small Hamming ball of its own segment
values, fetches the buckets met and verifies the complete distances. Equal fingerprints are one node. A bucket with
too many members is not fetched: whoever could meet it enumerates a ball of half the distance over the whole 64 bits
instead, where two fingerprints within the distance share a point and few lie around a point, whatever the data.
Components come from alternating star joins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import numbered, small_side, stored

BITS, SEED = 64, 42
#: Fingerprints that a bucket may have to be fetched.
BUCKET = 32
#: Bytes of a text whose words are held at a time.
HELD = 1 << 18
SPACE = re.compile(rb"[ \t-\r]")


def word_blocks(text: bytes, overlap: int) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, in blocks; each starts with the last `overlap` words before it."""
    at, held = 0, []
    while at < len(text):
        cut = SPACE.search(text, at + HELD)
        end = cut.start() if cut else len(text)
        words = held + text[at:end].lower().split()
        yield words
        at, held = end, words[len(words) - overlap :] if len(words) > overlap else words


def shingle_codes(text: bytes, size: int) -> np.ndarray:
    """Hashes of the shingles of `size` words, repeats included; of all words if they are fewer; empty without words."""
    digest, blocks, words = xxhash.xxh64_intdigest, [], []
    for words in word_blocks(text, size - 1):
        if len(words) >= size:
            joined = b" ".join(words)
            at = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
            blocks.append(np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(at, at[size:])), np.uint64, len(words) - size + 1))  # noqa: B905
    if not blocks and words:
        blocks.append(np.array([digest(b" ".join(words), SEED)], np.uint64))
    return np.concatenate(blocks) if blocks else np.zeros(0, np.uint64)


def fingerprint(codes: np.ndarray) -> int:
    """A bit is set where over half the codes have it; 0 without codes."""
    bits, own = np.zeros(BITS, np.int64), codes.view(np.uint8).reshape(-1, 8)
    for i in range(0, len(own), 8192):
        bits += np.unpackbits(own[i : i + 8192], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(codes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, place: Column | None = None) -> DataFrame:
    """place (the row's number, or the one given), id and fp long (the 64 bits, signed) of each row. Null and empty texts have 0."""
    schema = T.StructType([T.StructField("place", T.LongType()), T.StructField("id", docs.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = (fingerprint(shingle_codes(t.as_py() or b"", shingle_words)) for t in batch.column("t"))
            told = np.fromiter(own, np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("id"), pa.array(told)], names=["place", "id", "fp"])

    number = F.monotonically_increasing_id() if place is None else place
    rows = docs.select(number.alias("place"), F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(run, schema)


def ball(value: Column, bits: int, radius: int) -> Column:
    """array<long>, the values at most `radius` bits from `value` within its lowest `bits` bits."""
    masks = [sum(1 << i for i in flips) for r in range(radius + 1) for flips in combinations(range(bits), r)]
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    return F.transform(F.lit(signed).cast("array<long>"), lambda m: value.bitwiseXOR(m))


def neighbour_links(fps: DataFrame, *, max_distance: int = 2, segments: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) of fingerprints that differ in 1 to `max_distance` bits, enough for all components.

    fps: distinct fp long. Of `segments` segments one differs in at most max_distance // segments bits, and only the
    first few need the whole of that radius. Distances are even: at a point, all fingerprints around it are then
    within the distance of each other, and a chain of them stands for their pairs.
    """
    if max_distance not in (2, 4) or BITS % segments:
        raise ValueError("distances are 2 or 4, and segments divide 64 bits")
    width, radius, more = BITS // segments, max_distance // segments, max_distance % segments
    radii = [radius if s <= more else radius - 1 for s in range(segments)]
    value = lambda s: F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))
    table = fps.select("fp", F.inline(F.array(*[F.struct(F.lit(s).alias("s"), value(s).alias("v")) for s in range(segments)])))
    around = lambda v: F.coalesce(*[F.when(F.col("s") == s, ball(v, width, r)) for s, r in enumerate(radii) if r >= 0], F.array().cast("array<long>"))
    full = stored(table.groupBy("s", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket).select("s", "v"), "full-buckets")
    some = not full.isEmpty()
    small = table.join(small_side(full), ["s", "v"], "left_anti") if some else table
    near = (F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_distance)
    probes = small.select("fp", "s", F.explode(around(F.col("v"))).alias("v"))
    met = probes.join(small.select(F.col("fp").alias("other"), "s", "v"), ["s", "v"]).filter(near).select("fp", "other")
    if some:
        # members of full buckets and of all that their balls touch
        touched = stored(full.select("s", F.explode(around(F.col("v"))).alias("v")).union(full).distinct(), "touched")
        rest = table.join(small_side(touched), ["s", "v"], "left_semi").select("fp").distinct()
        points = rest.select("fp", F.explode(ball(F.col("fp"), BITS, max_distance // 2)).alias("point"))
        chain = points.withColumn("other", F.lag("fp").over(Window.partitionBy("point").orderBy("fp"))).filter(F.col("other").isNotNull() & near)
        met = met.union(chain.select("fp", "other"))
    return met.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root: the smallest node reachable, for the nodes of `links` (a, b) that aren't their own root.

    Alternating stars: the larger neighbours of each node are hung on its smallest one, then the smaller
    neighbours, until nothing changes. Both steps are an aggregate and a join; each round is stored. The rounds
    grow with the logarithm of a component's size; if so many don't settle it, an error is raised.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(low.select("u", F.col("m").alias("v")))
        edges = stored(small.distinct(), "links")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3, max_distance: int = 2, segments: int = 2, bucket: int = BUCKET, place: Column | None = None) -> DataFrame:
    """Per input row: place, id, fp long, component long (smallest fingerprint reachable), component_id (smallest id reachable).

    Rows of equal fingerprints are one node, so copies cost one row each. Null and empty texts share the
    fingerprint 0, which links like any other; null ids link too, but don't count for component_id unless a group
    has no other; repeated rows fall into one group; an empty table gives no rows. Ids have any type with an
    order. Other input columns stay with the caller, who numbers the rows in a stored table and gives that number as
    `place`; else rows are numbered here, once.
    """
    rows = stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, place=place), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(neighbour_links(distinct.select("fp"), max_distance=max_distance, segments=segments, bucket=bucket))
    rooted = stored(distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("component")), "rooted")
    class_of = rooted.select("fp", "component").join(rooted.groupBy("component").agg(F.min("least").alias("component_id")), "component")
    return rows.join(class_of, "fp").select("place", "id", "fp", "component", "component_id")


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stay: of each group the one with the smallest id (of repeated ids the first row; null ids come last).

    The rows that stay are told by an aggregate with partial sums and joined by their place, so a group of any
    size is spread over tasks.
    """
    rows = numbered(docs)
    texts = rows.select(F.col("row")[id_col].alias("id"), F.col("row")[text_col].alias("t"), F.col("place").alias("number"))
    found = near_duplicates(texts, id_col="id", text_col="t", place=F.col("number"), **options)
    stays = found.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("m")).select("m.place")
    return rows.join(stays, "place", "left_semi").select("row.*")


def simhash_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
