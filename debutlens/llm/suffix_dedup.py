"""Removal of byte strings that an earlier document holds, by suffix sorting in shards.

A string of 50 bytes is sought by its anchor, the smallest 24-byte hash inside it, which equal strings choose
alike; so documents are cut into regions, one per anchor, that hold every 50-byte string of that anchor, and
all occurrences of a string meet at one key. A region that also lies whole in an earlier document is removed
outright. Where one anchor has different regions, the earliest document's copy of each goes to a shard of the
anchors' range, and the shard's suffixes are sorted by external induced sorting; neighbours in suffix order
with a common prefix of 50 bytes are one string. An anchor of too many different regions, such as a line that
stands in many documents between changing neighbours, is split: its 50-byte strings are keys of their own, grouped
whole, so that none of its fragments have to meet in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .induced import repeated_windows
from .keyed import chunk_of, narrow, packed, packed_keys, plan, range_edges, spread, unpacked, unpacked_keys

GRAM = 24
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_CODE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
PLACE = np.uint64((1 << 28) - 1)
NO_ID = (1 << 63) - 1


class Powers:
    """Powers of a number modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.values = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            with np.errstate(over="ignore"):  # the product is meant modulo 2**64
                self.values = np.concatenate([self.values, self.values * (self.values[-1] * self.base)])
        return self.values[:n]


POWERS, INVERSES = Powers(BASE), Powers(INVERSE)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def regions(text: bytes, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, region hash, first and last window start of each region of a text."""
    n = len(text)
    if n < size:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    power = POWERS.upto(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[np.frombuffer(text, np.uint8)] * INVERSES.upto(n), out=prefix[1:])
    grams = mixed((prefix[GRAM:] - prefix[:-GRAM]) * power[: n - GRAM + 1])
    wide = size - GRAM + 1
    low = (grams & ~PLACE) | (np.arange(len(grams), dtype=np.uint64) & PLACE)
    reach = 1
    while reach * 2 <= wide:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < wide:
        low = np.minimum(low[: len(low) - (wide - reach)], low[wide - reach :])
    anchor = low & PLACE
    first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    last = np.append(first[1:], len(anchor)) - 1
    spot = first + ((anchor[first].astype(np.int64) - first) & int(PLACE))
    region = mixed((prefix[last + size] - prefix[first]) * power[first]) + (last - first).astype(np.uint64)
    # the anchors are minima and so lie low; mixed once more they fill all key ranges evenly
    return mixed(grams[spot] + np.uint64(BASE)), region, first, last


def pair_order(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Order by (first, second): by first alone, then the few equal ones among themselves."""
    order = np.argsort(first)
    same = first[order][1:] == first[order][:-1]
    several = np.flatnonzero(np.append(False, same) | np.append(same, False))
    own = order[several]
    order[several] = own[np.lexsort((second[own], first[own]))]
    return order


def region_table(texts: list[bytes], ids: np.ndarray, size: int):
    """Regions of a chunk, sorted by anchor and region: their fields, their place among the distinct ones, and those."""
    own = [regions(t, size) for t in texts]
    anchor, region, first, last = (np.concatenate(x) if x else np.zeros(0) for x in zip(*own, strict=True))
    row = np.repeat(np.arange(len(texts)), [len(x[0]) for x in own])
    order = pair_order(anchor, region)
    anchor, region, first, last, row = (x[order] for x in (anchor, region, first, last, row))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (region[1:] != region[:-1])
    starts = np.flatnonzero(new)
    earliest = np.minimum.reduceat(ids[row], starts) if len(starts) else np.zeros(0, np.int64)
    return anchor, region, first, last, row, np.cumsum(new) - 1, starts, earliest


def spans_of(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Spans joined where they touch or overlap: an array of rows (start, end)."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return np.stack([starts[new], ends[np.append(new[1:], True)]], 1).astype(np.int64)


def whole_characters(text: bytes, spans: np.ndarray) -> str:
    """The text without the spans, but with every character of which a byte stays."""
    out, at = [], 0
    for a, b in spans.tolist():
        while a < len(text) and text[a] & 0xC0 == 0x80:
            a += 1
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append(text[at:a])
            at = b
    return b"".join([*out, text[at:]]).decode()


def split_regions(docs: DataFrame, *, id_col: str, text_col: str, size: int, chunk_bytes: int, range_bytes: int, most: int) -> DataFrame:
    """Rows of two kinds: documents (place long, doc_id, rest: the other columns, z: compressed text, spans: removed
    outright) and fragments (place, doc_id, anchor, start, z: the bytes of a contested region, hot: its anchor has over `most` regions)."""
    n_chunks, bits = plan(docs, text_col, chunk_bytes, range_bytes)
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(None).cast("int").alias("none")]
    rest = T.StructField("rest", docs.select(F.struct(*others).alias("rest")).schema["rest"].dataType)
    long, binary = T.LongType(), T.BinaryType()
    schema = T.StructType([T.StructField("place", long), T.StructField("doc_id", long), rest, T.StructField("chunk", T.IntegerType()), T.StructField("z", binary)])

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for b in batches:
            z = pa.array([packer.compress(t) for t in b.column("t").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("place", "doc_id", "rest", "chunk")), z], names=["place", "doc_id", "rest", "chunk", "z"])

    numbered = docs.select(F.monotonically_increasing_id().alias("place"), F.col(id_col).cast("long").alias("doc_id"), F.struct(*others).alias("rest"), chunk_of(n_chunks).alias("chunk"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    texts = spread(numbered.mapInArrow(squeeze, schema), "chunk", n_chunks)

    def read(table: pa.Table) -> tuple[list[bytes], np.ndarray, pa.Table]:
        table = table.sort_by("place")
        opener = zstandard.ZstdDecompressor()
        ids = np.array([NO_ID if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
        return [opener.decompress(z) for z in table["z"].to_pylist()], ids, table

    def emit(table: pa.Table) -> pa.Table:
        texts, ids, table = read(table)
        anchor, region, _, _, _, _, starts, earliest = region_table(texts, ids, size)
        keys, region = anchor[starts], region[starts]
        edges = range_edges(keys, bits)
        chunk = table["chunk"][0].as_py()
        rows = [(chunk, r, packed_keys(keys[a:b]), packed(region[a:b]), packed(earliest[a:b])) for r, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]  # noqa: B905
        cols = zip(*rows, strict=True) if rows else [()] * 5
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["chunk", "range", "keys", "regions", "earliest"])

    def meet(table: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x) for x in table["keys"].to_pylist()]
        edges = np.cumsum([0, *map(len, keys)])
        key = np.concatenate(keys)
        region = np.concatenate([unpacked(x) for x in table["regions"].to_pylist()])
        ids = np.concatenate([unpacked(x) for x in table["earliest"].to_pylist()])
        order = pair_order(key, region)
        k, r, i = key[order], region[order], ids[order]
        new_key = np.append(True, k[1:] != k[:-1])
        new = np.append(True, new_key[1:] | (r[1:] != r[:-1]))
        first = np.minimum.reduceat(i, np.flatnonzero(new))[np.cumsum(new) - 1]
        of_key, at_key = np.cumsum(new_key) - 1, np.flatnonzero(new_key)
        several = np.add.reduceat(new.astype(np.int64), at_key)[of_key]
        across = (np.maximum.reduceat(i, at_key) != np.minimum.reduceat(i, at_key))[of_key]
        told, contested = np.zeros(len(order), np.int64), np.zeros(len(order), np.uint8)
        told[order], contested[order] = i - first, across * np.where(several > most, 2, several > 1)
        cut = lambda x: [packed(narrow(x[a:b])) for a, b in zip(edges, edges[1:])]  # noqa: B905, E731
        return pa.Table.from_arrays([table["chunk"], table["range"], pa.array(cut(told), pa.binary()), pa.array(cut(contested), pa.binary())], names=["chunk", "range", "told", "contested"])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, ids, left = read(left)
        anchor, _, first, last, row, distinct, _, earliest = region_table(texts, ids, size)
        got = sorted(zip(right["range"].to_pylist(), right["told"].to_pylist(), right["contested"].to_pylist(), strict=True))
        told = np.concatenate([unpacked(x).astype(np.int64) for _, x, _ in got]) if got else np.zeros(0, np.int64)
        contested = np.concatenate([unpacked(x) for _, _, x in got]) if got else np.zeros(0, np.uint8)
        gone = ids[row] > (earliest - told)[distinct]
        ask = np.flatnonzero(~gone & (contested[distinct] > 0))
        at = np.flatnonzero(gone)
        at = at[np.argsort(row[at], kind="stable")]
        cut = np.searchsorted(row[at], np.arange(len(texts) + 1))
        spans = [spans_of(first[x], last[x] + size).tobytes() for x in (at[cut[i] : cut[i + 1]] for i in range(len(texts)))]
        n, places, docs = len(texts), left["place"].to_pylist(), left["doc_id"].to_pylist()
        frag = [(places[row[x]], docs[row[x]], int(anchor[x].view(np.int64)), int(first[x]), texts[row[x]][first[x] : last[x] + size], bool(contested[distinct[x]] > 1)) for x in ask]
        f = list(zip(*frag, strict=True)) or [()] * 6
        cols = [(places + list(f[0]), pa.int64()), (docs + list(f[1]), pa.int64()), ([None] * n + list(f[2]), pa.int64()), ([None] * n + list(f[3]), pa.int64()), (left["z"].to_pylist() + list(f[4]), pa.binary()), (spans + [None] * len(frag), pa.binary()), ([None] * n + list(f[5]), pa.bool_())]
        own = pa.chunked_array([*left["rest"].chunks, pa.nulls(len(frag), left["rest"].type)], left["rest"].type)
        return pa.Table.from_arrays([*(pa.array(c, t) for c, t in cols), own], names=["place", "doc_id", "anchor", "start", "z", "spans", "hot", "rest"])

    sent = texts.groupBy("chunk").applyInArrow(emit, "chunk int, range int, keys binary, regions binary, earliest binary")
    told = spread(sent, "range", 1 << bits).groupBy("range").applyInArrow(meet, "chunk int, range int, told binary, contested binary")
    both = texts.groupBy("chunk").cogroup(spread(told, "chunk", n_chunks).groupBy("chunk"))
    told_of = [("place", long), ("doc_id", long), ("anchor", long), ("start", long), ("z", binary), ("spans", binary), ("hot", T.BooleanType())]
    return both.applyInArrow(answer, T.StructType([*(T.StructField(n, t) for n, t in told_of), rest]))


def repeated_strings(fragments: DataFrame, *, size: int) -> DataFrame:
    """place, found as `repeated_spans` gives them, each string of the fragments (place, doc_id, start, z) being a key."""
    strings = F.transform(F.sequence(F.lit(0), F.length("z") - size), lambda i: F.struct((F.col("start") + i).alias("at"), F.substring(F.col("z"), i + 1, F.lit(size)).alias("w")))
    rows = fragments.select("place", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.inline(strings))
    first = rows.groupBy("w").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("w", "first")
    return rows.join(first, "w").filter("id > first").select("place", F.array("at", F.col("at") + size).alias("found"))


def repeated_spans(fragments: DataFrame, *, size: int, shard_bytes: int, memory: int) -> DataFrame:
    """place, found (start, end, start, end, ...) of the contested fragments (place, doc_id, anchor, start, z) whose strings an earlier document holds."""
    total = fragments.agg(F.sum(F.length("z"))).first()[0] or 0
    n = max(1, math.ceil(total / shard_bytes))
    shards = fragments.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(n)).cast("int"))
    dealt = shards.repartition(max(n, int(fragments.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "shard").sortWithinPartitions("shard")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def told() -> pa.RecordBatch:
            ids = np.array([NO_ID if x[1] is None else x[1] for x in held], np.int64)
            places, out = [], []
            for x, at in zip(held, repeated_windows([x[3] for x in held], ids, size, memory), strict=True):
                if len(at):
                    places.append(x[0])
                    out.append((spans_of(at, at + size) + x[2]).ravel().tolist())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(out, pa.list_(pa.int64()))], names=["place", "found"])

        shard = None
        for batch in batches:
            for own, *x in zip(*(batch.column(c).to_pylist() for c in ("shard", "place", "doc_id", "start", "z")), strict=True):
                if own != shard and held:
                    yield told()
                shard = own
                held.append(x)
        if held:
            yield told()

    return dealt.select("shard", "place", "doc_id", "start", "z").mapInArrow(sort, "place long, found array<long>")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 50, chunk_bytes: int = 8 << 20, range_bytes: int = 8 << 20, shard_bytes: int = 1 << 20, memory: int = 256 << 20, most: int = 4096) -> DataFrame:
    """Per input row: place (its number), rest (struct of the columns beside the text, whatever their names), doc_id,
    n_bytes, n_removed, n_spans, kept (binary), kept_text (string, with every character of which a byte stays), spans.

    Removes each byte covered by a `size`-byte string that also starts in a document with a smaller id; strings
    are judged on the input. Null and too short texts lose nothing; rows that repeat an id are one document to
    each other; null ids come after all others; an empty table gives no rows. Other input columns go along in `rest`,
    so that nothing has to be joined to the input again. Ids are longs.
    """
    both = stored(split_regions(docs, id_col=id_col, text_col=text_col, size=size, chunk_bytes=chunk_bytes, range_bytes=range_bytes, most=most), "regions")
    texts, fragments = both.filter("anchor is null"), both.filter("anchor is not null")
    found = repeated_spans(fragments.filter("not hot"), size=size, shard_bytes=shard_bytes, memory=memory)
    found = found.union(repeated_strings(fragments.filter("hot"), size=size)).groupBy("place").agg(F.flatten(F.collect_list("found")).alias("found"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, gone, runs, kept, whole, out = [], [], [], [], [], []
            for z, spans, found in zip(*(batch.column(c).to_pylist() for c in ("z", "spans", "found")), strict=True):
                text = opener.decompress(z)
                every = np.concatenate([np.frombuffer(spans, np.int64), np.array(found or (), np.int64)]).reshape(-1, 2)
                joined = spans_of(every[:, 0], every[:, 1])
                edges = [0, *joined.ravel().tolist(), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                whole.append(whole_characters(text, joined))
                sizes.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                runs.append(len(joined))
                out.append([{"start": a, "end": b} for a, b in joined.tolist()])
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("rest"), batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, gone, runs)), pa.array(kept, pa.binary()), pa.array(whole, pa.string()), pa.array(out, span)], names=["place", "rest", "doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_text", "spans"])

    joined = texts.select("place", "rest", "doc_id", "z", "spans").join(found, "place", "left")
    made = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string, spans array<struct<start: long, end: long>>")
    return joined.mapInArrow(cut, T.StructType([joined.schema["place"], joined.schema["rest"], *made.fields]))


def suffix_query(spark, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
