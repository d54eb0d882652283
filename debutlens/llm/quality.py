"""Quality rules: basic text measures, and the distance of a document from its language's references.

The references of a language are two histograms over all its documents: character classes, and its most common
words with one bin for all others. A document far from a reference in Jensen-Shannon distance is rejected; too
short a document, or too small a reference, gives no verdict.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_side, stored

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "other", "beyond_ascii")
N_CLASSES = len(CLASSES)
#: Distinct words that a task counts before it passes its counts on.
COUNTED = 1 << 18
#: Counts in a batch that a task passes on.
TOLD = 1 << 16


def _class_of_byte() -> np.ndarray:
    out = np.full(256, 6)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", SPACES, b".,;:!?'\"()-", SYMBOLS)):
        out[list(chars)] = k
    out[128:192] = -1  # continuation bytes: a character counts once, by its first byte
    out[192:] = 7
    return out


CLASS_OF_BYTE = _class_of_byte()


@dataclass(frozen=True)
class Rules:
    """Thresholds. Distances are square roots of the divergence in bits, 0 to 1."""

    min_words: int = 20
    max_repeat_percent: int = 30
    top_words: int = 100
    min_class_chars: int = 200
    max_class_distance: float = 0.27
    min_common_words: int = 40
    max_common_distance: float = 0.34
    common_base: float = 0.28
    common_noise: float = 1.55
    min_reference_words: int = 1000

    def common_limit(self, n_words: int) -> float:
        """Few words lie far from any reference by chance alone: the limit falls with the root of their number."""
        return max(self.max_common_distance, self.common_base + self.common_noise / n_words**0.5)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence (base 2) of two count vectors with positive sums."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    kl = lambda x: float(np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])))
    return max(0.0, (kl(p) + kl(q)) / 2) ** 0.5


def class_counts(of_byte: np.ndarray) -> np.ndarray:
    return np.bincount(CLASS_OF_BYTE + 1, weights=of_byte, minlength=N_CLASSES + 1)[1:]


def repeated_words(words: list[bytes], size: int = 8) -> int:
    """Words inside windows of `size` words that occur twice or more in the text, the first included.

    Windows of one text are told apart by 64-bit hashes of their words, and not compared word by word.
    """
    n = len(words) - size + 1
    if n < 2 or len(set(words)) == len(words):
        return 0
    code = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    window = np.zeros(n, np.uint64)
    for i in range(size):
        window = window * np.uint64(0x9E3779B97F4A7C15) + code[i : i + n]
    window ^= window >> np.uint64(29)
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, np.flatnonzero(twice), 1)
    np.add.at(edge, np.flatnonzero(twice) + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_measures(text: bytes, words: list[bytes], of_byte: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(text) - int(of_byte[128:192].sum()) - int(of_byte[list(SPACES)].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), chars, int(of_byte[list(SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words)


def language_references(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """One row per language: lang, classes array<double>, words array<string>, counts array<double>, total double.

    Counted over the whole texts of all documents, each task adding up its own before the shuffle; a null
    language is the language ''. `words` are the `top_words` most common (ties: by word), lower-cased in A-Z.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for lang in list(words):
                c, own = words.pop(lang), classes.pop(lang)
                for keys, n, is_class in ((c.keys(), c.values(), False), ([str(k).encode() for k in range(N_CLASSES)], own, True)):
                    size = len(keys)
                    cols = [pa.repeat(lang, size), pa.array(keys, pa.binary(), size=size), pa.repeat(is_class, size), pa.array(np.fromiter(n, np.float64, size))]
                    whole = pa.RecordBatch.from_arrays(cols, names=["lang", "key", "is_class", "n"])
                    yield from (whole.slice(k, TOLD) for k in range(0, size, TOLD))

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(text.lower().split())
                of_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
                classes[lang] = classes.get(lang, 0) + class_counts(of_byte)
            if sum(map(len, words.values())) > COUNTED:
                yield from told()
        yield from told()

    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    summed = texts.mapInArrow(count, "lang string, key binary, is_class boolean, n double").groupBy("lang", "key", "is_class").agg(F.sum("n").alias("n"))
    summed = stored(summed, "word-counts")
    ranked = summed.filter("not is_class").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))).filter(F.col("rank") <= rules.top_words)
    top = ranked.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "key", "n"))).alias("top"))
    whole = summed.groupBy("lang").agg(
        F.sum(F.when(~F.col("is_class"), F.col("n"))).alias("total"),
        F.array_sort(F.collect_list(F.when(F.col("is_class"), F.struct(F.col("key").cast("string").cast("int").alias("k"), "n")))).alias("classes"),
    )
    return whole.join(top, "lang", "left").select(
        "lang",
        F.transform("classes", lambda x: x["n"]).alias("classes"),
        F.coalesce(F.transform("top", lambda x: x["key"]), F.array().cast("array<binary>")).alias("words"),
        F.coalesce(F.transform("top", lambda x: x["n"]), F.array().cast("array<double>")).alias("counts"),
        F.coalesce("total", F.lit(0.0)).alias("total"),
    )


def judge_quality(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """Per input row: row (struct of all input columns) and its measures and verdict.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words long; class_distance, common_distance double
    (null where a length guard leaves them out); base_failed, kept boolean. Null texts count as empty and fail
    by their words; null languages share the reference ''; repeated rows get equal verdicts; an empty table
    gives no rows. References are one row per language: broadcast while few, else joined by shuffle.
    """
    refs = stored(language_references(docs, text_col=text_col, lang_col=lang_col, rules=rules), "references")
    fields = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("class_distance", "double"), ("common_distance", "double"), ("base_failed", "boolean"), ("kept", "boolean")]
    schema = T.StructType([T.StructField("row", docs.schema), *(T.StructField(n, {"long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}[t]) for n, t in fields)])
    types = [{"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[t] for _, t in fields]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple] = {}
        for batch in batches:
            out = []
            langs, ref = batch.column("lang").to_pylist(), batch.column("ref")
            texts = batch.column("row").field(text_at).cast(pa.binary())
            for i, value in enumerate(texts):
                text = value.as_py() or b""
                if (lang := langs[i]) not in known:
                    r = ref[i].as_py()
                    known[lang] = r and (np.array(r["classes"]), {w: k for k, w in enumerate(r["words"])}, np.array([*r["counts"], r["total"] - sum(r["counts"])]), r["total"])
                of_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
                words = text.split()
                base = base_measures(text, words, of_byte)
                n, failed = base[0], base[0] < rules.min_words or 100 * base[4] > rules.max_repeat_percent * base[0]
                far = common = None
                if known[lang] and known[lang][3] >= rules.min_reference_words:
                    classes, place, counts, _ = known[lang]
                    if (own := class_counts(of_byte)).sum() >= rules.min_class_chars:
                        far = js_distance(own, classes)
                    if n >= rules.min_common_words:
                        at = np.fromiter((place.get(w, len(place)) for w in text.lower().split()), np.int64, n)
                        common = js_distance(np.bincount(at, minlength=len(place) + 1), counts)
                verdict = not failed and (far is None or far <= rules.max_class_distance) and (common is None or common <= rules.common_limit(n))
                out.append((*base, far, common, failed, verdict))
            cols = zip(*out, strict=True) if out else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=[f.name for f in schema])

    text_at = [c.lower() for c in docs.columns].index(text_col.lower())
    texts = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"))
    joined = texts.join(small_side(refs.select("lang", F.struct("classes", "words", "counts", "total").alias("ref")), most=1000), "lang", "left")
    return joined.mapInArrow(judge, schema)


def quality_query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    judged = judge_quality(docs)
    return judged.select(F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "common_distance", "base_failed", "kept")
