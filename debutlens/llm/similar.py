"""Near copies by the Jaccard similarity of their word shingles: all pairs at or above a bound, none by chance.

SimHash fingerprints come first: pairs that multi-index hashing finds are compared, and those similar enough are
links. At a similarity of 0.8 about 10 of 64 bits differ, which no table of fingerprints finds for sure, so the pairs
still missing come from the shingles themselves.

Two sets of that similarity share one of their first n - c + 1 shingles in any common order, where c is the least
overlap that n shingles need. The order is rarest first, so the shared first ones are few. Shingles are counted
over the corpus by 40 bits of their hash; a shingle of one document only is never a key. Neighbours at a key are
compared first and their components told; then each pair at a key whose components still differ, at the least of the
keys that it shares. A key with too many such pairs is split by its next common shingle, of which the first n - c + 2
hold one, and so on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, numbered, small_side, stored
from .keyed import narrow, packed, packed_keys, plan, range_edges, spread, unpacked, unpacked_keys
from .simhash import components, fingerprint, neighbour_links, shingle_codes

#: Bits of a hash by which it is counted.
COUNTED = np.uint64((1 << 64) - (1 << 24))
#: The shingles that a split key may have. Sets of fewer shingles are at 0.8 similar only to equal ones.
DEEPEST = 3
#: Rounds in which only neighbours at a key are compared.
ROUNDS = 2
#: Bits of a set's signature.
SIGNATURE = 1024
#: The least keys of a member by which a pair is told at the first key of those it shares.
LEAST_KEYS = 32
#: Keeps the rounding of a product from moving a bound.
EXACT = 1e-9


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    return np.unique(shingle_codes(text or b"", size))


def needed(n: int, similarity: float) -> int:
    """The least overlap of a set of n with any set that similar."""
    return math.ceil(similarity * n - EXACT)


def signature(own: np.ndarray) -> np.ndarray:
    """How often each residue occurs, modulo 2: two sets differ in at least as many elements as their bits differ."""
    odd = np.bincount((own % np.uint64(SIGNATURE)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def digests(rows: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Of numbered rows: place, id, fingerprint fp and the digest of the set of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, fps = [], np.zeros(b.num_rows, np.uint64)
            for i, t in enumerate(b.column("t")):
                codes = shingle_codes(t.as_py() or b"", size)
                fps[i] = fingerprint(codes)
                own.append(xxhash.xxh3_128_digest(np.unique(codes).tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("place"), b.column("id"), pa.array(fps.view(np.int64)), pa.array(own, pa.binary())], names=["place", "id", "fp", "digest"])

    read = rows.select("place", F.col("row")[id_col].cast("long").alias("id"), F.col("row")[text_col].cast("binary").alias("t"))
    return read.mapInArrow(run, "place long, id long, fp long, digest binary")


def fingerprint_pairs(sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes whose fingerprints are equal or at most two bits apart, enough to connect them all."""
    by_fp = stored(sets.groupBy("fp").agg(F.min("node").alias("lead")), "leads-of-fingerprints")
    links = neighbour_links(by_fp.select("fp"))
    lead = lambda of, name: by_fp.select(F.col("fp").alias(of), F.col("lead").alias(name))
    across = links.join(lead("a", "x"), "a").join(lead("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return sets.select("fp", "node").join(by_fp, "fp").filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).union(across)


def leads(texts: DataFrame, *, size: int, similarity: float, chunk_bytes: int, range_bytes: int) -> DataFrame:
    """Of each text (node, t): node, n, its signature, codes and their places at, for its first shingles that another text may hold."""
    n_chunks, bits = plan(texts, "t", chunk_bytes, range_bytes)
    dealt = spread(texts.select("node", F.pmod(F.xxhash64("node"), F.lit(n_chunks)).cast("int").alias("chunk"), "t"), "chunk", n_chunks)

    def read(table: pa.Table) -> tuple[list[np.ndarray], pa.Table]:
        table = table.sort_by("node")
        return [shingle_set(t, size) for t in table["t"].to_pylist()], table

    def emit(table: pa.Table) -> pa.Table:
        sets, table = read(table)
        keys, counts = np.unique(np.concatenate(sets) & COUNTED, return_counts=True)
        edges, chunk = range_edges(keys, bits), table["chunk"][0].as_py()
        rows = [(chunk, r, packed_keys(keys[a:b]), packed(narrow(counts[a:b]))) for r, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]  # noqa: B905
        cols = zip(*rows, strict=True) if rows else [()] * 4
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "range", "keys", "counts"])

    def meet(table: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x) for x in table["keys"].to_pylist()]
        edges = np.cumsum([0, *map(len, keys)])
        distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
        counts = np.concatenate([unpacked(x).astype(np.int64) for x in table["counts"].to_pylist()])
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, of, counts)
        told = [packed(narrow(total[of[a:b]])) for a, b in zip(edges, edges[1:])]  # noqa: B905
        return pa.Table.from_arrays([table["chunk"], table["range"], pa.array(told, pa.binary())], names=["chunk", "range", "counts"])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        sets, left = read(left)
        keys = np.unique(np.concatenate(sets) & COUNTED) if sets else np.zeros(0, np.uint64)
        got = sorted(zip(right["range"].to_pylist(), right["counts"].to_pylist(), strict=True))
        counts = np.concatenate([unpacked(x).astype(np.int64) for _, x in got]) if got else np.zeros(0, np.int64)
        rows = []
        for node, own in zip(left["node"].to_pylist(), sets, strict=True):
            held = counts[np.searchsorted(keys, own & COUNTED)]
            order = np.lexsort((own, held))[: len(own) - needed(len(own), similarity) + DEEPEST]
            at = np.flatnonzero(held[order] > 1)
            if len(at):
                rows.append((node, len(own), signature(own), own[order[at]].view(np.int64), at.astype(np.int32)))
        cols = list(zip(*rows, strict=True)) or [()] * 5
        types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["node", "n", "signature", "codes", "at"])

    sent = dealt.groupBy("chunk").applyInArrow(emit, "chunk int, range int, keys binary, counts binary")
    told = spread(sent, "range", 1 << bits).groupBy("range").applyInArrow(meet, "chunk int, range int, counts binary")
    return dealt.groupBy("chunk").cogroup(spread(told, "chunk", n_chunks).groupBy("chunk")).applyInArrow(answer, "node long, n int, signature array<long>, codes array<long>, at array<int>")


def verified(pairs: DataFrame, texts: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, t) are that similar."""
    pairs = stored(pairs.distinct(), "pairs")
    asked = small_side(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
    held = stored(texts.join(asked, "node", "left_semi"), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for one, two in zip(batch.column("t0").to_pylist(), batch.column("t1").to_pylist(), strict=True):
                x, y = shingle_set(one, size), shingle_set(two, size)
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= similarity * (len(x) + len(y) - both) - EXACT)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], names=["a", "b", "near"])

    first = pairs.join(held.select(F.col("node").alias("a"), F.col("t").alias("t0")), "a")
    return first.join(held.select(F.col("node").alias("b"), F.col("t").alias("t1")), "b").select("a", "b", "t0", "t1").mapInArrow(run, "a long, b long, near boolean").filter("near").select("a", "b")


def similar_groups(texts: DataFrame, first: DataFrame, *, size: int, similarity: float, most: int, chunk_bytes: int, range_bytes: int) -> DataFrame:
    """node, root for the nodes of distinct sets (node, t) that aren't the smallest of those they reach by similar pairs.

    first: pairs (a, b) to compare before all others; they spare work, and change no result.
    """
    lead = stored(leads(texts, size=size, similarity=similarity, chunk_bytes=chunk_bytes, range_bytes=range_bytes), "leads")
    # of a set of n, the first n - c + level shingles hold `level` common ones
    spare = (F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - EXACT)).cast("int")
    exploded = lead.select("node", "n", spare.alias("spare"), F.explode(F.arrays_zip("at", "codes")).alias("x")).select("node", "n", "spare", "x.at", F.col("x.codes").alias("code"))
    keyed = exploded.filter("at <= spare").select(F.col("code").alias("key"), "node", "n", "at")
    fits = (F.least("n", "n0") >= F.lit(similarity) * F.greatest("n", "n0") - EXACT) & F.col("n0").isNotNull()
    # sets of the bound differ in (n + n0)(1 - s) / (1 + s) shingles; their signatures tell most others without the texts
    differ = F.aggregate(F.zip_with("s", "s0", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    close = differ <= (F.col("n") + F.col("n0")) * F.lit((1 - similarity) / (1 + similarity)) + EXACT
    signed = lead.select("node", F.col("signature").alias("s"))
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))

    # each row carries its node's least keys; if two nodes' lists meet, they do so at the least key that both have
    shared = F.array_min(F.array_intersect("least", "least0"))
    first_met = F.coalesce(F.col("key") <= shared, F.lit(True))

    def with_least(members: DataFrame) -> DataFrame:
        least = members.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LEAST_KEYS).alias("least"))
        return members.join(least, "node")

    def contested(members: DataFrame) -> DataFrame:
        """Members of keys whose components differ: big (the most frequent one there) and full (too many pairs of others)."""
        each = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("m"))
        of_key = each.groupBy("key").agg(F.sum("m").alias("m"), F.max(F.struct("m", "root")).alias("big")).filter("m > big.m")
        told = of_key.select("key", F.col("big.root").alias("big"), ((F.col("m") - F.col("big.m")) * F.col("m") > most * most).alias("full"))
        return stored(members.join(told, "key"), "keyed")

    near, live = stored(verified(first, texts, size, similarity), "near"), stored(keyed, "keyed")
    for order in range(ROUNDS):
        # neighbours by size first; then, where a key is still full, by an order of its own, so that each key gives other ones
        beside = Window.partitionBy("key").orderBy(*([F.xxhash64("key", "node", F.lit(order))] if order else []), "n", "node")
        chain = live.withColumn("n0", F.lag("n").over(beside)).withColumn("node0", F.lag("node").over(beside)).filter(fits)
        fresh = verified(chain.select(*ordered("node", "node0")), texts, size, similarity)
        near = stored(near.union(fresh), "near")
        roots = components(near)
        met = contested(keyed.join(roots, "node", "left").select("key", "node", "n", "at", F.coalesce("root", "node").alias("root")))
        live = met.filter("full").select("key", "node", "n", "at")
        if live.isEmpty():
            break
    found = None
    for level in range(1, DEEPEST + 1):
        # of each pair of two components, one at least is not the big one
        ready = with_least(met if level == DEEPEST else met.filter("not full")).join(signed, "node")
        one = ready.filter("root <> big").select("key", F.col("node").alias("a"), F.col("n").alias("n0"), F.col("s").alias("s0"), F.col("root").alias("r0"), F.col("least").alias("least0"))
        pairs = one.join(ready.select("key", F.col("node").alias("b"), "n", "s", F.col("root").alias("r1"), "least"), "key").filter((F.col("r0") != F.col("r1")) & fits & close & first_met)
        pairs = pairs.select(*ordered("a", "b"))
        found = pairs if found is None else found.union(pairs)
        full = met.filter("full").select("key", "node", "n", F.col("at").alias("at0"), "root")
        if level == DEEPEST or full.isEmpty():
            break
        further = exploded.select("node", "spare", "at", "code")
        met = contested(full.join(further, "node").filter((F.col("at") > F.col("at0")) & (F.col("at") <= F.col("spare") + level)).select(F.xxhash64("key", "code").alias("key"), "node", "n", "at", "root"))
    return components(near.union(verified(found, texts, size, similarity)))


def one_of_each_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, similarity: float = 0.8, most: int = 1000, chunk_bytes: int = 8 << 20, range_bytes: int = 8 << 20) -> DataFrame:
    """The rows of `docs` that stay: of each group the one with the smallest id (of repeated ids, the first row).

    A group is what pairs of at least that similarity reach, over the sets of shingles of `shingle_words` words
    (case set aside, a shorter text is one shingle). Null and empty texts are copies of each other; null ids come
    after all others; an empty table gives no rows. Ids are longs; other columns may have any name. The input is read
    once and numbered; that table is removed when the distinct texts, with the rows that stand for them, are stored.
    """
    if similarity < 0.8:
        raise ValueError("below 0.8, sets of fewer shingles than a split key may be similar")
    rows = numbered(docs)
    own = stored(digests(rows, id_col, text_col, shingle_words), "digests")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "place")).alias("first")
    sets = stored(own.groupBy("digest").agg(F.min("fp").alias("fp"), first).select("fp", "first", F.col("first.place").alias("node")), "sets")
    # A set's node is the row that would stay, so that these rows are all that is needed from here on.
    held = stored(rows.select(F.col("place").alias("node"), "row").join(sets.select("node"), "node", "left_semi"), "texts")
    discard(rows)
    texts = held.select("node", F.col("row")[text_col].cast("binary").alias("t"))
    roots = similar_groups(texts, fingerprint_pairs(sets), size=shingle_words, similarity=similarity, most=most, chunk_bytes=chunk_bytes, range_bytes=range_bytes)
    stays = sets.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first")).select(F.col("first.place").alias("node"))
    return held.join(stays, "node", "left_semi").select("row.*")
