"""Token counts without tokens: the best unigram segmentation's score and number of pieces.

Aho-Corasick enumerates every vocabulary piece inside a word; a dynamic programme over its characters carries
the best score and the count of pieces alone. Ties and unknown characters follow the unigram tokenizer: of
equal scores the path found first, from the earlier start, stays; a character that no piece covers alone may
be an unknown piece at 10 below the lowest score, runs of unknown pieces count as one unless bytes stand for
them. Words are cut as its Metaspace splits them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN_PENALTY = 10.0
SPACE = "▁"
#: Words whose counts a task remembers; the memory is emptied when full, which changes no result.
REMEMBERED = 1 << 19


def load_vocabulary(model_path: str) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) by id, and the unknown id, of a public sentencepiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class CountingViterbi:
    """Counts the pieces of a word's best segmentation under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown_id: int, byte_fallback: bool = True):
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            if piece:
                self.machine.add_word(piece, (len(piece), score, i == unknown_id))
        self.machine.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.pieces = {p for p, _ in vocabulary}
        self.bytes = byte_fallback and len({p for p in self.pieces if len(p) == 6 and p.startswith("<0x")}) == 256

    def count(self, word: str) -> tuple[int, float]:
        n = len(word)
        starts: list[list[tuple[int, float, bool]]] = [[] for _ in range(n)]
        for end, (size, score, unknown) in self.machine.iter(word):
            starts[end - size + 1].append((end + 1, score, unknown))
        best = [0.0] + [None] * n
        # of the best path to each place: its pieces before a run of unknowns that ends there, and where that run starts
        known, run = [0] * (n + 1), list(range(n + 1))
        for at in range(n):
            here, alone = best[at], False
            for end, score, unknown in starts[at]:  # shorter pieces come first: their match ends first
                alone |= end == at + 1
                if best[end] is None or here + score > best[end]:
                    best[end] = here + score
                    known[end], run[end] = (known[at], run[at]) if unknown else (known[at] + self.spent(word[run[at] : at]) + 1, end)
            if not alone and (best[at + 1] is None or here + self.unknown > best[at + 1]):
                best[at + 1] = here + self.unknown
                known[at + 1], run[at + 1] = known[at], run[at]
        return known[n] + self.spent(word[run[n] :]), best[n]

    def spent(self, run: str) -> int:
        """Pieces that a run of unknown characters takes."""
        return len(run.encode()) if self.bytes and run not in self.pieces else min(len(run), 1)


def count_tokens(docs: DataFrame, model_path: str, *, text_col: str = "text", byte_fallback: bool = True) -> DataFrame:
    """Adds to row (struct of all input columns): n_tokens long and best_score double of the text.

    Spaces become the mark U+2581, one is put before the text unless it starts with one, and each mark starts
    a word. Null and empty texts have no tokens and score 0. Rows are independent: no shuffle, repeated rows
    get equal counts, an empty table gives no rows, input columns keep their names inside row.
    """
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("n_tokens", T.LongType()), T.StructField("best_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        viterbi = CountingViterbi(*load_vocabulary(model_path), byte_fallback)
        memory: dict[str, tuple[int, float]] = {}
        for batch in batches:
            counts, scores = [], []
            for text in batch.column("t").to_pylist():
                n, total = 0, 0.0
                if text:
                    text = text.replace(" ", SPACE)
                    for part in (text if text[0] == SPACE else SPACE + text).split(SPACE)[1:]:
                        got = memory.get(part)
                        if got is None:
                            if len(memory) >= REMEMBERED:
                                memory.clear()
                            got = viterbi.count(SPACE + part)
                            if len(part) < 64:
                                memory[part] = got
                        n += got[0]
                        total += got[1]
                counts.append(n)
                scores.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())], names=["row", "n_tokens", "best_score"])

    return docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)


def token_query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    counted = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "n_tokens", "best_score", F.coalesce(F.length("row.text"), F.lit(0)).cast("long").alias("n_chars"))
