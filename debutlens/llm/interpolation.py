"""Language-model scores by deleted interpolation of word n-grams.

P(w | h) mixes the maximum-likelihood bigram c(h w) / c(h), the unigram c(w) / N and the uniform 1 / (V + 1).
The weights depend on the bucket of the context's frequency and come from expectation-maximisation on held-out
counts: one fold of the training documents is deleted from the counts, and its events are predicted from the rest.
The final estimates count all training documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .keyed import chunk_of, narrow, packed, packed_keys, plan, range_edges, spread, unpacked, unpacked_keys

END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
BUCKETS = 48
#: Held-out events are counted by the logarithms of their two estimates, in eighths of an octave.
STEPS, MOST_STEPS = 8, 255
#: What a document is for: scored only, its events counted, or counted and deleted once to learn the weights.
SCORED, TRAINING, DELETED = 0, 1, 2


class Words(dict):
    """Hashes of a chunk's words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = xxhash.xxh64_intdigest(word)
        return code


def events(texts: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    """Token hashes and bigram hashes of the texts one after another, and each text's token count."""
    codes, sizes, flat = Words(), np.zeros(len(texts), np.int64), []
    for i, text in enumerate(texts):
        words = (text.as_py() or b"").lower().split()
        flat.append(np.fromiter(map(codes.__getitem__, words), np.uint64, len(words)))
        flat.append(np.array([END]))
        sizes[i] = len(words) + 1
    tokens = np.concatenate(flat) if flat else np.zeros(0, np.uint64)
    del flat, codes  # large, and no longer needed
    pairs = np.roll(tokens, 1)
    pairs[np.cumsum(sizes) - sizes] = START
    pairs *= np.uint64(0xBF58476D1CE4E5B9)
    pairs ^= tokens + np.uint64(0x94D049BB133111EB)
    pairs ^= pairs >> np.uint64(31)
    pairs *= np.uint64(0xFF51AFD7ED558CCD)
    pairs ^= pairs >> np.uint64(33)
    return [tokens, pairs], sizes


def places(own: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key lies among the sorted distinct ones."""
    out = np.empty(len(keys), np.int32)
    for a in range(0, len(keys), 1 << 18):
        out[a : a + (1 << 18)] = np.searchsorted(own, keys[a : a + (1 << 18)])
    return out


def count_events(docs: DataFrame, *, id_col: str, text_col: str, role: F.Column, chunk_bytes: int, range_bytes: int) -> DataFrame:
    """Per document: its tokens' global training counts and those of its bigrams, packed; and rows of totals.

    doc_id, role, n_tokens, uni, bi; of deleted documents also rest_uni and rest_bi, the counts without any deleted
    document. In rows with null n_tokens total_n, total_v and rest_n add up to N, V, and N without the deleted.
    """
    n_chunks, bits = plan(docs, text_col, chunk_bytes, range_bytes)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"), role.cast("int").alias("role"), chunk_of(n_chunks).alias("chunk"))
    texts = spread(texts, "chunk", n_chunks)

    def emit(table: pa.Table) -> pa.Table:
        streams, sizes = events(table["t"])
        roles = np.repeat(table["role"].to_numpy().astype(np.int8), sizes)
        chunk, rows = table["chunk"][0].as_py(), []
        for kind in range(2):
            stream = streams.pop(0)
            keys = np.unique(stream)
            counts, deleted = (np.bincount(places(keys, stream[some]), minlength=len(keys)) for some in (roles > SCORED, roles == DELETED))
            del stream
            edges = range_edges(keys, bits)
            rows += [(chunk, kind, r, packed_keys(keys[a:b]), packed(narrow(counts[a:b])), packed(narrow(deleted[a:b]))) for r, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]  # noqa: B905
        cols = zip(*rows, strict=True)
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["chunk", "kind", "range", "keys", "counts", "deleted"])

    def total(table: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x) for x in table["keys"].to_pylist()]
        edges = np.cumsum([0, *map(len, keys)])
        own, at = np.unique(np.concatenate(keys), return_inverse=True)
        summed = lambda col: np.bincount(at, np.concatenate([unpacked(x) for x in table[col].to_pylist()]), len(own)).astype(np.int64)
        cut = lambda x: pa.array([packed(narrow(x[at[a:b]])) for a, b in zip(edges, edges[1:])], pa.binary())  # noqa: B905, E731
        sums, deleted = summed("counts"), summed("deleted")
        unigram = table["kind"][0].as_py() == 0
        more = [[int(x) * unigram, *[0] * (len(keys) - 1)] for x in (sums.sum(), (sums > 0).sum(), (sums - deleted).sum())]
        return pa.Table.from_arrays([table["chunk"], table["kind"], table["range"], cut(sums), cut(deleted), *(pa.array(x, pa.int64()) for x in more)], names=["chunk", "kind", "range", "told", "deleted", "total_n", "total_v", "rest_n"])

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        streams, sizes = events(left["t"])
        got = sorted(zip(right["kind"].to_pylist(), right["range"].to_pylist(), right["told"].to_pylist(), right["deleted"].to_pylist(), strict=True))
        edges, roles = np.cumsum([0, *sizes]), left["role"].to_pylist()
        cut = []
        for kind in range(2):
            stream = streams.pop(0)
            at = places(np.unique(stream), stream)
            del stream
            counts, deleted = (np.concatenate([narrow(unpacked(x[i]).astype(np.uint32)) for x in got if x[0] == kind]) for i in (2, 3))
            parts = [at[a:b] for a, b in zip(edges, edges[1:])]  # noqa: B905
            cut.append([packed(narrow(counts[x])) for x in parts])
            cut.append([packed(narrow(counts[x].astype(np.int64) - deleted[x])) if r == DELETED else None for x, r in zip(parts, roles, strict=True)])
        totals = [sum(right[c].to_pylist()) for c in ("total_n", "total_v", "rest_n")]
        n, types = len(sizes), (pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4, *[pa.int64()] * 3)
        cols = [left["doc_id"].to_pylist(), roles, sizes.tolist(), *cut, *[[None] * n] * 3]
        last = [*[None] * 7, *totals]
        return pa.Table.from_arrays([pa.array([*c, x], t) for c, x, t in zip(cols, last, types, strict=True)], names=["doc_id", "role", "n_tokens", "uni", "rest_uni", "bi", "rest_bi", "total_n", "total_v", "rest_n"])

    sent = texts.groupBy("chunk").applyInArrow(emit, "chunk int, kind int, range int, keys binary, counts binary, deleted binary")
    told = spread(sent, "range", 1 << bits).groupBy("range", "kind").applyInArrow(total, "chunk int, kind int, range int, told binary, deleted binary, total_n long, total_v long, rest_n long")
    both = texts.groupBy("chunk").cogroup(spread(told, "chunk", n_chunks).groupBy("chunk"))
    return both.applyInArrow(answer, "doc_id long, role int, n_tokens long, uni binary, rest_uni binary, bi binary, rest_bi binary, total_n long, total_v long, rest_n long")


def contexts(uni: np.ndarray, documents: int) -> np.ndarray:
    """c(h) of each token: the count of the token before it; of the start, the number of training documents."""
    out = np.empty(len(uni), np.int64)
    out[0], out[1:] = documents, uni[:-1]
    return out


def bucket(c: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the binary logarithm of its frequency."""
    return np.where(c > 0, np.frexp(np.maximum(c, 1).astype(float))[1], 0).clip(0, BUCKETS - 1)


def bins(p: np.ndarray) -> np.ndarray:
    """0 for an estimate of 0, else one more than its distance from 1 in steps."""
    return np.where(p > 0, 1 + np.rint(-np.log2(np.where(p > 0, p, 1)) * STEPS).clip(0, MOST_STEPS - 1), 0).astype(np.int64)


def held_out_counts(deleted: DataFrame, rest_n: int) -> DataFrame:
    """Deleted events by context bucket and binned estimates: at most 48 * 256 * 256 rows, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS * (MOST_STEPS + 1) ** 2, np.int64)
        for batch in batches:
            for uni, bi in zip(batch.column("rest_uni").to_pylist(), batch.column("rest_bi").to_pylist(), strict=True):
                c, pair = unpacked(uni).astype(np.int64), unpacked(bi).astype(np.int64)
                h = contexts(c, int(c[-1]))  # a text ends once, so the end's count is the number of documents
                key = (bucket(h) * (MOST_STEPS + 1) + bins(pair / np.maximum(h, 1))) * (MOST_STEPS + 1) + bins(c / max(rest_n, 1))
                some, times = np.unique(key, return_counts=True)
                sums[some] += times
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["key", "n"])

    return deleted.select("rest_uni", "rest_bi").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def mixture_weights(key: np.ndarray, n: np.ndarray, v: int, rounds: int = 60) -> np.ndarray:
    """Weights [bucket, (bigram, unigram, uniform)] by expectation-maximisation on the held-out counts."""
    whole = np.array([0.4, 0.5, 0.1])
    weights = np.tile(whole, (BUCKETS, 1))
    if len(key):
        b, i, j = key // (MOST_STEPS + 1) ** 2, key // (MOST_STEPS + 1) % (MOST_STEPS + 1), key % (MOST_STEPS + 1)
        value = lambda k: np.where(k > 0, 2.0 ** (-(k - 1) / STEPS), 0.0)
        p = np.stack([value(i), value(j), np.full(len(key), 1 / (v + 1))], 1)
        mass = np.bincount(b, n, BUCKETS)
        for _ in range(rounds):
            share = weights[b] * p
            share *= (n / share.sum(1))[:, None]
            new = np.stack([np.bincount(b, share[:, k], BUCKETS) for k in range(3)], 1)
            whole = new.sum(0) / new.sum()
            # one pseudo-event per bucket keeps every weight above zero and gives unseen buckets the overall mixture
            weights = (new + whole) / (mass + 1)[:, None]
    weights[0] = [0, *(weights[0, 1:] / weights[0, 1:].sum())]
    return weights


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_out_fold: int = 2, deleted_fold: int = 3, chunk_bytes: int = 24 << 20, range_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row's whole text.

    Learns from documents whose crc32(id as text) mod `folds` isn't `held_out_fold`, the weights from
    `deleted_fold` of them. Null and empty texts are one end token; a null id counts as the text ''; repeated rows
    count and are scored each; with nothing to learn from, every token has the uniform probability, and without
    a deleted document the weights keep their start; an empty table gives no rows. Ids are longs. Other input
    columns are left out. A chunk sends its keys in one row per key range and both are bounded by their bytes, so
    beyond about 1 TB raise both together.
    """
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds
    role = F.when(fold == held_out_fold, SCORED).when(fold == deleted_fold, DELETED).otherwise(TRAINING)
    counted = stored(count_events(docs, id_col=id_col, text_col=text_col, role=role, chunk_bytes=chunk_bytes, range_bytes=range_bytes), "event-counts")
    n, v, rest_n = (int(x or 0) for x in counted.filter("n_tokens is null").agg(F.sum("total_n"), F.sum("total_v"), F.sum("rest_n")).first())
    rows = counted.filter("n_tokens is not null").withColumn("held_out", F.col("role") == SCORED)
    table = held_out_counts(rows.filter(F.col("role") == DELETED), rest_n).toPandas()
    weights = mixture_weights(table["key"].to_numpy(np.int64), table["n"].to_numpy(np.float64), v)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known, base, score = [], [], []
            for uni, bi in zip(batch.column("uni").to_pylist(), batch.column("bi").to_pylist(), strict=True):
                c, pair = unpacked(uni).astype(np.int64), unpacked(bi).astype(np.int64)
                h = contexts(c, int(c[-1]))
                w = weights[bucket(h)]
                p = w[:, 0] * pair / np.maximum(h, 1) + w[:, 1] * c / max(n, 1) + w[:, 2] / (v + 1)
                known.append(int((c > 0).sum()))
                base.append(float(np.log10((c + 1) / (n + v + 1)).sum()))
                score.append(float(np.log10(p).sum()) if n else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), batch.column("n_tokens"), pa.array(known, pa.int64()), pa.array([n] * len(known), pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.select("doc_id", "held_out", "n_tokens", "uni", "bi").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def scoring_query(spark, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
