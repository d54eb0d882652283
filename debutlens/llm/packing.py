"""Best-fit packing of token sequences, bulk-synchronously.

Pieces are dealt evenly to slices, and a slice runs rounds on its own task. Its pieces and gaps lie sorted by size,
and since sizes are whole numbers up to the capacity, each size is one class of any number of members. In a round
every class of pieces seeks its successor, the smallest gap that holds it, in one sweep over both; where several
seek one class of gaps, the larger go first and the k-th piece takes the k-th gap; gaps are updated and the rest tries
again. Of the pieces without a successor, those above half the capacity open a sequence each; where none is so large,
the class of the largest opens as many as it fills. So a slice needs no more sequences than best fit by falling size,
but for a few. A task sees only its slice's two histograms, `capacity` classes at most; pieces are ranked and placed by
distributed windows and joins.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Words whose ids a task remembers; the memory is emptied when full, which changes no result.
REMEMBERED = 1 << 18
#: Pieces of a slice; a slice leaves at most a few sequences unfilled.
SLICE_PIECES = 1 << 16
PIECES = "doc_id long, piece int, start long, length int, ids binary, ids_crc32 long"


class Words(dict):
    """Ids of a space and the word, coded on first sight; words of 64 characters and more aren't remembered."""

    def __init__(self, code: Callable[[str], bytes]):
        self.code = code

    def __missing__(self, word: str) -> bytes:
        got = self.code(" " + word)
        if len(word) < 64:
            self[word] = got
        return got


class ByteBpe:
    """Ids of a public byte-level BPE file, as little-endian unsigned 32-bit bytes.

    A word and the single space before it are coded apart from other words, so words are remembered; a text
    with two white-space characters in a row, or a special token's string, is coded whole.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
        self.coder = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.whole = re.compile(r"\s\s|" + "|".join(map(re.escape, self.special)))
        self.known = Words(self.plain)

    def plain(self, text: str) -> bytes:
        """Ids of a text without a special token's string."""
        ids = self.coder.encode_ordinary(text)
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        if self.whole.search(text):
            ids = self.coder.encode(text, allowed_special="all")
            return struct.pack(f"<{len(ids)}I", *ids)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        first, *words = text.split(" ")
        return self.plain(first) + b"".join(map(self.known.__getitem__, words))


@lru_cache(maxsize=1)
def coder_of(path: str) -> ByteBpe:
    """The coder of a file, kept with its words for a worker's later tasks."""
    return ByteBpe(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (binary, little-endian unsigned 32 bits), ids_crc32.

    Each document's ids end with `end_id`. Longer ones than `capacity` are cut into whole pieces; the rest is
    the first piece. Null texts are empty; every row, repeated ones too, gives at least one piece. Ids are longs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("t").to_pylist(), strict=True):
                ids = coder.ids(text) + end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):  # noqa: B905
                    own = ids[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, own, zlib.crc32(own)))
            cols = zip(*rows, strict=True) if rows else [()] * 6
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["doc_id", "piece", "start", "length", "ids", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).mapInArrow(run, PIECES)


def best_fit_rounds(sizes: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """Places classes {size: pieces}: (size, first rank, first sequence, offset), by size and rank.

    Pieces of a size from that rank on take the sequences from there on, one each, up to the next entry's rank.
    """
    left = np.array(sorted(sizes.items(), reverse=True), np.int64).reshape(-1, 2)
    rank = np.zeros(len(left), np.int64)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, how many)
    placed, opened = [], 0
    while len(left):
        known = np.array(sorted(gaps), np.int64)
        successor = np.searchsorted(known, left[:, 0])  # the sweep; pieces lie by falling size, so larger ones go first
        made: dict[int, list[tuple[int, int]]] = defaultdict(list)
        stuck = successor == len(known)
        need = int(left[stuck & (left[:, 0] > capacity // 2), 1].sum())  # no two of these share a sequence
        if stuck.any() and not need:  # then the largest get as many as they fill, and the rest sees what these leave
            size, n = left[stuck][0]
            need = -(-int(n) // (capacity // int(size)))
        if need:  # the gaps of new sequences hold all; the largest of the stuck take them
            gaps[capacity], known, opened = [(opened, need)], np.append(known, capacity), opened + need
        for k in range(len(left)):
            size, gap = int(left[k, 0]), int(known[successor[k]]) if successor[k] < len(known) else 0
            runs = gaps.get(gap)
            while left[k, 1] and runs:
                first, n = runs.pop()
                take = min(n, int(left[k, 1]))
                placed.append((size, int(rank[k]), first, capacity - gap))
                if take < n:
                    runs.append((first + take, n - take))
                if gap > size:
                    made[gap - size].append((first, take))
                rank[k] += take
                left[k, 1] -= take
        for gap, runs in made.items():
            gaps[gap] = gaps.get(gap, []) + runs
        gaps = {gap: runs for gap, runs in gaps.items() if runs}
        live = left[:, 1] > 0
        left, rank = left[live], rank[live]
    return sorted(placed)


def pack(pieces: DataFrame, *, capacity: int = 1024, slice_pieces: int = SLICE_PIECES) -> DataFrame:
    """Adds sequence_id long and offset long to rows with an int `length` of 1 to `capacity`.

    Sequences hold at most `capacity`, their pieces lie gapless from 0; an empty table gives no rows. `pieces`
    must be a stored table with a row_key: its rows are ranked by size and slice, never by size alone. Sequences
    are numbered within slices, the slice in the upper bits.
    """
    slices = max(1, -(-pieces.count() // slice_pieces))
    rows = pieces.withColumn("slice", F.pmod(F.xxhash64("row_key"), F.lit(slices)).cast("int"))
    counts = rows.groupBy("slice", "length").agg(F.count(F.lit(1)).alias("n"))

    def fit(table: pa.Table) -> pa.Table:
        runs: dict[int, list[dict]] = defaultdict(list)
        for size, rank, first, offset in best_fit_rounds(dict(zip(table["length"].to_pylist(), table["n"].to_pylist(), strict=True)), capacity):
            runs[size].append({"rank": rank, "first": first, "offset": offset})
        own = pa.array(list(runs.values()), pa.list_(pa.struct([("rank", pa.int64()), ("first", pa.int64()), ("offset", pa.int64())])))
        return pa.Table.from_arrays([pa.repeat(table["slice"][0], len(runs)), pa.array(list(runs), pa.int32()), own], names=["slice", "length", "runs"])

    runs = stored(counts.groupBy("slice").applyInArrow(fit, "slice int, length int, runs array<struct<rank: long, first: long, offset: long>>"), "runs")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("slice", "length").orderBy("row_key")).cast("long") - 1)
    run = F.element_at(F.filter("runs", lambda r: r["rank"] <= F.col("rank")), -1)
    at = ranked.join(runs, ["slice", "length"]).withColumn("run", run)
    sequence = F.shiftleft(F.col("slice").cast("long"), 40) + F.col("run.first") + F.col("rank") - F.col("run.rank")
    return at.withColumn("sequence_id", sequence).withColumn("offset", F.col("run.offset")).select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of `token_pieces`, ids included, with sequence_id and offset. Other input columns are left out."""
    pieces = token_pieces(docs, tokenizer_path, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col)
    table = stored(pieces.withColumn("row_key", F.monotonically_increasing_id()), "pieces")
    return pack(table, capacity=capacity)


def packing_query(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if docs is None else docs
    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")
