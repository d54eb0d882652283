"""Edge cases and brute-force versions of the training-data operators."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from debutlens.llm import chat, counting, decontamination, induced, interpolation, packing, quality, sharding, simhash, similar, suffix_dedup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, place long, chunk int, shard int, fp long, items string"


def frame(spark, rows):
    """Documents with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, lang, "s", None, "r", 1, 2, 3, 4, "x") for i, t, lang in rows], SCHEMA)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    long = words(rng, 3000)
    out = [(1, None, "en"), (2, "", None), (3, "  \n ", "en"), (4, long, "en"), (5, long, "en"), (5, long, "en"), (6, long[:4000] + " new " + long[4100:], None), (None, long[100:300], "fr")]
    return out + [(10 + i, words(rng, rng.randint(1, 120)), rng.choice(["en", "fr"])) for i in range(40)] + [(60, long[50:250] + words(rng, 30), "en")]


@pytest.mark.parametrize("few", [True, False])
def test_decontamination_equals_brute_force(spark, rows, few, monkeypatch):
    if not few:  # the forms for large benchmarks
        monkeypatch.setattr(decontamination, "FIRST_WORDS", 0)
        monkeypatch.setattr(decontamination, "small_side", lambda df, **_: df)
    texts = [t for _, t, _ in rows if t and len(t) > 200]
    items = [(1, " ".join(texts[0].split()[5:30]).upper().replace("É", "é")), (2, None), (3, "one two"), (4, " ".join(texts[3].split()[:3])), (5, "")]
    word = lambda t: __import__("re").findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
    got = decontamination.find_contamination(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    text = frame(spark, rows).select(F.monotonically_increasing_id().alias("place"), "text")
    got = got.join(text, "place").select("id", "text", "n_words", decontamination.covered(F.col("spans")).alias("n"), F.array_sort("items").alias("i")).collect()
    assert len(got) == len(rows)
    for r in got:
        own, hit, names = word(r["text"]), set(), set()
        for item, text in items:
            w = word(text)
            n = min(10, len(w))
            if n:
                keys = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
                for i in range(len(own) - n + 1):
                    if tuple(own[i : i + n]) in keys:
                        hit |= set(range(i, i + n))
                        names.add(item)
        assert (r["n_words"], r["n"], r["i"] or []) == (len(own), len(hit), sorted(names))
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.find_contamination(frame(spark, rows), none).filter("spans is not null").isEmpty()
    assert decontamination.find_contamination(frame(spark, rows).limit(0), none).isEmpty()


def test_coder_equals_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, coder = Tokenizer.from_file(path), packing.ByteBpe(path)
    rng = random.Random(4)
    texts = ["a  b", "a   b \n c", "\n\n x", " lead", "tail ", "<|endoftext|> a b", "it's we'll 12", "", "é  b", "x \x1cy", "한 국", "\U0001f600 a"]
    texts += ["".join(rng.choices("ab é한\n\t .,'1|<>", k=rng.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(chr(c) for c in range(a, a + 64)) for a in [*range(0, 0xD800, 64), *range(0xE000, 0x11000, 64)]]
    for t in texts:
        assert np.frombuffer(coder.ids(t), np.uint32).tolist() == plain.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("slice_pieces", [1 << 16, 20])
def test_packing_equals_brute_force(spark, rows, slice_pieces, tmp_path):
    """Pieces of the query's shape by the tokenizer itself, and their places by the law of a sequence."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    want = Counter()
    for i, t, _ in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 64 or 64, len(ids) + 1, 64)]
        want.update((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))  # noqa: B905
    pieces = packing.token_pieces(frame(spark, rows), path, capacity=64).withColumn("row_key", F.monotonically_increasing_id())
    pieces.write.parquet(f"{tmp_path}/pieces")
    packed = packing.pack(spark.read.parquet(f"{tmp_path}/pieces"), capacity=64, slice_pieces=slice_pieces)
    assert Counter(map(tuple, packed.select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == want
    out = packed.toPandas()
    for _, own in out.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.length.sum() <= 64 and (own.length.cumsum() - own.length == own.offset).all()
    slices = math.ceil(len(out) / slice_pieces)
    assert out.sequence_id.nunique() <= math.ceil(out.length.sum() / 64) + 2 * slices
    assert packing.pack_documents(frame(spark, rows).limit(0), path).count() == 0


def test_rounds_place_every_piece_once():
    rng = random.Random(3)
    for _ in range(200):
        capacity = rng.choice([1, 5, 64])
        sizes = Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 300)))
        spots, runs = {}, packing.best_fit_rounds(sizes, capacity)
        for k, (size, rank, first, offset) in enumerate(runs):
            end = runs[k + 1][1] if k + 1 < len(runs) and runs[k + 1][0] == size else sizes[size]
            for i in range(end - rank):
                spots.setdefault(first + i, []).append((offset, size))
        assert Counter(size for own in spots.values() for _, size in own) == sizes
        for own in spots.values():
            assert all(a + n == b for (a, n), (b, _) in zip(sorted(own), sorted(own)[1:])) and sum(n for _, n in own) <= capacity  # noqa: B905
        assert len(spots) <= math.ceil(sum(s * n for s, n in sizes.items()) / max(1, capacity)) * 1.25 + 2


def test_induced_sorting_equals_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        size, letters = rng.choice([2, 5, 8]), rng.choice([1, 2, 26])
        parts = [bytes(rng.choices(range(97, 97 + letters), k=rng.randint(0, 30))) for _ in range(rng.randint(1, 12))]
        parts += [rng.choice(parts) + rng.choice(parts) for _ in range(3)]
        owner = np.array([rng.randint(0, 5) for _ in parts])
        first = {}
        for p, o in zip(parts, owner, strict=True):
            for i in range(len(p) - size + 1):
                first[p[i : i + size]] = min(o, first.get(p[i : i + size], 9))
        want = [[i for i in range(len(p) - size + 1) if first[p[i : i + size]] < o] for p, o in zip(parts, owner, strict=True)]
        for memory in (1 << 28, 200):  # all in memory, all on disk
            assert [x.tolist() for x in induced.repeated_windows(parts, owner, size, memory)] == want


@pytest.mark.parametrize("most", [4096, 3])
def test_suffix_dedup_equals_brute_force(spark, rows, most):
    rng = random.Random(6)
    line = words(rng, 30)[:55]  # between changing neighbours: one anchor, many regions
    rows = rows + [(200 + i, words(rng, 20) + line + words(rng, 20), "en") for i in range(40)]
    got = suffix_dedup.remove_repeats(frame(spark, rows), chunk_bytes=4000, range_bytes=4000, shard_bytes=1000, most=most).collect()
    assert len(got) == len(rows)
    key = lambda i: math.inf if i is None else i
    first = {}
    for i, t, _ in rows:
        b = (t or "").encode()
        for a in range(len(b) - 49):
            first[b[a : a + 50]] = min(key(i), first.get(b[a : a + 50], math.inf))
    want = Counter()
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - 49):
            if first[b[a : a + 50]] < key(i):
                gone[a : a + 50] = b"\1" * 50
        want[(i, len(b), bytes(c for c, g in zip(b, gone, strict=True) if not g))] += 1
    assert Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"])) for r in got) == want
    assert suffix_dedup.remove_repeats(frame(spark, rows).limit(0)).count() == 0


def interpolated(tokens, fold):
    """Scores by plain dictionaries: counts, binned held-out events, expectation-maximisation, mixture."""
    steps, most = interpolation.STEPS, interpolation.MOST_STEPS
    start = object()
    counts = lambda some: (Counter(w for own in some for w in own), Counter(p for own in some for p in zip([start, *own], own)))  # noqa: B905, E731
    rounded = lambda p: 2.0 ** -(min(round(-math.log2(p) * steps), most - 1) / steps) if p > 0 else 0.0
    size = lambda h: h.bit_length()
    trained = [own for i, own in tokens if fold(i) != 2]
    rest = [own for i, own in tokens if fold(i) not in (2, 3)]
    deleted = [own for i, own in tokens if fold(i) == 3]
    (c, pairs), (rc, rpairs) = counts(trained), counts(rest)
    n, v, rn = sum(c.values()), len(c), sum(rc.values())
    h_of = lambda a, c, docs: docs if a is start else c[a]
    events = Counter()
    for own in deleted:
        for a, w in zip([start, *own], own):  # noqa: B905
            h = h_of(a, rc, len(rest))
            events[size(h), rounded(rpairs[a, w] / max(h, 1)), rounded(rc[w] / max(rn, 1))] += 1
    weights, whole = {}, (0.4, 0.5, 0.1)
    for _ in range(60 if events else 0):
        new = {}
        for (b, p2, p1), m in events.items():
            parts = [x * p for x, p in zip(weights.get(b, whole), (p2, p1, 1 / (v + 1)), strict=True)]
            new.setdefault(b, [0.0] * 3)
            for k in range(3):
                new[b][k] += m * parts[k] / sum(parts)
        whole = tuple(sum(x[k] for x in new.values()) / sum(map(sum, new.values())) for k in range(3))
        weights = {b: [(x[k] + whole[k]) / (sum(x) + 1) for k in range(3)] for b, x in new.items()}
    first = weights.get(0, whole)
    weights[0] = [0, first[1] / (first[1] + first[2]), first[2] / (first[1] + first[2])]
    out = []
    for i, own in tokens:
        score = 0.0
        for a, w in zip([start, *own], own):  # noqa: B905
            h = h_of(a, c, len(trained))
            x = weights.get(size(h), whole)
            score += math.log10(x[0] * pairs[a, w] / max(h, 1) + x[1] * c[w] / n + x[2] / (v + 1))
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)
        out.append((str(i), fold(i) == 2, len(own), sum(c[w] > 0 for w in own), n, round(base, 6), round(score, 4)))
    return sorted(out)


@pytest.mark.parametrize("vocabulary", ["wide", "narrow"])
def test_interpolation_equals_brute_force(spark, rows, vocabulary):
    rng = random.Random(12)
    own = rows if vocabulary == "wide" else rows + [(500 + i, " ".join(rng.choices("abcdefgh", [9, 7, 5, 4, 3, 2, 1, 1], k=rng.randint(5, 60))), "en") for i in range(150)]
    docs = frame(spark, own)
    got = interpolation.score_documents(docs, chunk_bytes=4000, range_bytes=4000).collect()
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t, _ in own]
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    want = interpolated(tokens, fold)
    told = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 4)) for r in got)
    assert [x[:6] for x in told] == [x[:6] for x in want]
    assert [x[6] for x in told] == pytest.approx([x[6] for x in want], rel=1e-4)
    assert interpolation.score_documents(docs.limit(0)).count() == 0


def test_mixture_weights_find_the_mixture():
    side = interpolation.MOST_STEPS + 1
    key = np.array([(5 * side + 9) * side + 0, (5 * side + 0) * side + 17])  # only the bigram, only the unigram explains them
    w = interpolation.mixture_weights(key, np.array([3000.0, 1000.0]), 10**9)
    assert w[5][0] == pytest.approx(0.75, abs=0.01) and w[5].sum() == pytest.approx(1)
    assert w[0][0] == 0


def test_chat_folds_edits_and_regenerations(spark):
    log = [(1, "a", 1, "message", "user", "hi <|im_end|>\\<|"), (1, "b", 2, "message", "assistant", "no"), (1, "b", 3, "delta", None, "pe"), (1, "b", 4, "regenerate", "assistant", "y"), (1, "b", 5, "delta", None, "es"), (1, "a", 6, "edit", None, "hey <|im_start|>"), (2, "c", 1, "delta", None, None), (1, "z", 9, "unknown", "user", "x")]
    done = chat.render(chat.fold_events(spark.createDataFrame(log, "conv_id long, message string, seq int, kind string, role string, text string")))
    got = {r["conv_id"]: r for r in done.select("conv_id", chat.parse(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("l")).collect()}
    assert [tuple(t) for t in got[1]["t"]] == [("user", "hey <|im_start|>"), ("assistant", "yes")] and got[1]["l"] == "yes"
    assert [tuple(t) for t in got[2]["t"]] == [("", "")]


def test_quality_measures(spark, rows):
    got = quality.judge_quality(frame(spark, rows + [(99, "a b c d e f g h a b c d e f g h\nx #\nx #\n", "en")])).collect()
    assert len(got) == len(rows) + 1
    r = next(r for r in got if r["row"]["doc_id"] == 99)
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["kept"]) == (20, 20, 2, 1, 16, True, False)
    assert all(r["base_failed"] for r in got if not (r["row"]["text"] or "").strip())
    assert quality.judge_quality(frame(spark, rows).limit(0)).count() == 0
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 2.0])) == 1.0


def groups_by_fingerprint(fps, ids, distance):
    """The smallest id that each row reaches, by comparing all pairs."""
    fp = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance
    label = np.arange(len(fp))
    while not np.array_equal(label, new := np.array([label[n].min() for n in near])):
        label = new
    return [min((i for i, x in zip(ids, label, strict=True) if x == own and i is not None), default=None) for own in label]


def test_simhash_equals_brute_force(spark, rows):
    import xxhash

    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    text = {i: t for i, t, _ in rows}
    for r in got:
        w = (text[r["id"]] or "").encode().lower().split()
        codes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        bits = sum(1 << k for k in range(64) if 2 * sum(c >> k & 1 for c in codes) > len(codes))
        assert r["fp"] % (1 << 64) == bits
    assert [r["component_id"] for r in got] == groups_by_fingerprint([r["fp"] for r in got], [r["id"] for r in got], 2)
    kept = simhash.one_of_each_group(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns and kept.filter("doc_id = 5").count() == 0 and kept.filter("doc_id = 4").count() == 1
    assert simhash.near_duplicates(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize(("distance", "segments", "bucket"), [(2, 2, 32), (2, 2, 1), (2, 4, 2), (4, 4, 3), (4, 2, 1)])
def test_index_finds_all_neighbours(spark, distance, segments, bucket):
    rng = random.Random(distance + segments)
    fps = {0, -1, 1 << 62, -(1 << 63)}
    for _ in range(60 if distance == 2 else 25):
        own = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            for b in rng.sample(range(64), rng.randint(0, 4)):
                own ^= 1 << b
            fps.add(own - (1 << 64) if own >> 63 else own)
    links = simhash.neighbour_links(spark.createDataFrame([(x,) for x in fps], "fp long"), max_distance=distance, segments=segments, bucket=bucket)
    assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > distance).isEmpty()
    root = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    order = sorted(fps)
    assert [root.get(x, x) for x in order] == groups_by_fingerprint(order, order, distance)


def test_a_null_id_links_others(spark, monkeypatch):
    """Fingerprints 0, 3 and 15: the row between has no id."""
    rows = spark.createDataFrame([(0, "a", 0), (1, None, 3), (2, "c", 15)], "place long, id string, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, **_: rows)
    assert [r["component_id"] for r in simhash.near_duplicates(rows).collect()] == ["a"] * 3


def test_long_texts_are_read_in_blocks(monkeypatch):
    rng = random.Random(9)
    text = ("  \n".join(words(rng, rng.randint(1, 40)) for _ in range(30)) + " \t").encode()
    whole = simhash.shingle_codes(text, 5).tolist()
    monkeypatch.setattr(simhash, "HELD", 7)
    assert simhash.shingle_codes(text, 5).tolist() == whole and len(simhash.shingle_codes(b"a b", 5)) == 1 and len(simhash.shingle_codes(b" \n ", 5)) == 0


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert simhash.components(links).agg(F.count(F.lit(1)), F.max("root")).first() == (199, 1)


def edited(rng, text, n):
    own = text.split()
    for i in rng.sample(range(len(own)), n):
        own[i] = words(rng, 1) + "x"
    return " ".join(own)


def groups_by_similarity(rows, size=5, similarity=0.8):
    """Ids that stay, by comparing all pairs."""
    held = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        held.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(rows)))
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if held[i] == held[j] or 5 * len(held[i] & held[j]) >= 4 * len(held[i] | held[j]) > 0]
    for _ in rows:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0, i)
    return sorted((rows[min((i for i in label_of if label[i] == g), key=order)][0] or -1) for label_of in [range(len(rows))] for g in set(label))


@pytest.mark.parametrize("most", [1000, 2])
def test_near_copies_equal_brute_force(spark, rows, most):
    rng = random.Random(11)
    own = [(i, t) for i, t, _ in rows] + [(70, "a b c d e f g h i"), (71, "a b c d e f g h"), (72, "a a a a a a"), (73, "a a a a a a a")]
    for i in range(12):
        first = words(rng, rng.choice([60, 150, 400]))
        own += [(100 + 10 * i, first)] + [(100 + 10 * i + k, edited(rng, first, max(1, len(first.split()) * k // 150))) for k in range(1, 5)]
    crowd = words(rng, 200)
    own += [(300 + i, edited(rng, crowd, 1 + i % 7)) for i in range(40)]
    docs = spark.createDataFrame(own, "doc_id long, text string")
    got = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in similar.one_of_each_group(docs, most=most, chunk_bytes=4000, range_bytes=2000).collect())
    assert got == groups_by_similarity(own)
    assert similar.one_of_each_group(docs.limit(0)).count() == 0
    # such copies lie further apart than fingerprints tell
    assert len(got) < simhash.one_of_each_group(docs).count()


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_counts_equal_the_tokenizer(spark, rows, byte_fallback):
    vocabulary, unknown = counting.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    plain = Tokenizer(models.Unigram(vocabulary, unknown, byte_fallback))
    plain.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    texts = [t for _, t, _ in rows] + ["a  b   c", " x", "☃☃ ☃a\U0001f600", "<unk> x<unk>", "\n\n", "한국 새글 "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n_tokens int, text string")
    got = counting.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), byte_fallback=byte_fallback).collect()
    for r in got:
        t = (r["row"]["text"] or "").replace(" ", "▁")
        assert r["n_tokens"] == (len(plain.encode(r["row"]["text"]).ids) if t else 0)


def test_warc_round_trip_over_small_ranges(spark, tmp_path):
    rng = random.Random(2)
    pages = [(i, f"http://x/{i} é", None if i == 3 else "" if i == 4 else "same " * 50 if i % 4 == 0 else words(rng, 60)) for i in range(40)] + [(None, None, "same " * 50)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = f"file://{tmp_path}/w"
    assert warc.write_warc(warc.with_revisits(df), path).agg(F.sum("records")).first()[0] == 41
    for size in (97, 1 << 20):  # ranges smaller than a record, and whole files
        got = {r["record_id"]: r for r in warc.read_warc(spark, path, range_bytes=size).collect()}
        assert len(got) == 41 and all(r["digest_ok"] for r in got.values())
        for i, url, html in pages:
            r, body = got[None if i is None else str(i)], (html or "").encode()
            revisit = body == b"same " * 50 and i != 0 and i != 4
            assert r["payload_digest"] == hashlib.sha256(body).hexdigest() and r["target_uri"] == (url or "")
            assert (r["record_type"], r["refers_to"]) == (("revisit", "0") if revisit else ("response", None))


@pytest.mark.parametrize("hot_share", [1, 10, 10**6])  # all lookups by a shuffle, hot ones by broadcast, all by broadcast
def test_revisits_of_hot_and_seldom_payloads(spark, hot_share):
    rng = random.Random(8)
    bodies = ["hot " * 40] * 30 + ["rare " * 30] * 3 + ["short"] * 20 + [None, ""] * 5 + ["x" * 99] * 2 + ["y" * 100] * 2 + [words(rng, 40) for _ in range(9)]
    rng.shuffle(bodies)
    pages = list(enumerate(bodies)) + [(None, "hot " * 40), (None, "lost " * 30), (None, "lost " * 30), (0, bodies[0])]
    df = spark.createDataFrame([(i, t, "clash") for i, t in pages], "page_id long, html string, often string").withColumn("url", F.lit("u")).repartition(3)
    ids = {}
    for i, t in pages:
        ids.setdefault(t or "", []).append(i)
    want = []
    for i, t in pages:
        known = [j for j in ids[t or ""] if j is not None]
        size = len((t or "").encode())
        again = size >= 100 and known and i != min(known)
        want.append((i, size, "revisit" if again else "response", min(known) if again else None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        got = warc.with_revisits(df, hot_share=hot_share).select("record_id", "payload_bytes", "record_type", "refers_to").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_shards(spark, rows, tmp_path):
    out = sharding.write_shards(frame(spark, rows * 5), 8, f"file://{tmp_path}/s", bucket_bytes=20_000).collect()
    assert Counter((r["row"]["doc_id"], r["row"]["text"]) for r in out) == Counter((i, t) for i, t, _ in rows * 5)
    sizes = Counter(r["shard"] for r in out)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in out if r["shard"] == s) == list(range(n)) for s, n in sizes.items())
    assert sharding.write_shards(frame(spark, rows).limit(0), 8, f"file://{tmp_path}/e").count() == 0


def test_shard_query_equals_brute_force(spark, rows, tmp_path):
    frame(spark, rows * 5).write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    out, again = (sorted(map(str, sharding.shard_query(spark, str(tmp_path)).select(columns).collect())) for _ in range(2))
    assert out == again  # the seed tells the order
    got = sharding.shard_query(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows * 5)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    counts = Counter(r["shard"] for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
    # equal texts are not kept together, nor in their order
    assert len({r["shard"] for r in got if r["size"] == 1}) > 2 and [r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))] != [i for i, _, _ in rows * 5]


def test_best_scores_equal_brute_force():
    vocabulary, unknown = counting.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    score = dict(vocabulary)
    least = min(score.values()) - counting.UNKNOWN_PENALTY
    viterbi, rng = counting.CountingViterbi(vocabulary, unknown), random.Random(3)
    for _ in range(300):
        word = "▁" + "".join(rng.choices("etaoin shé☃".replace(" ", ""), k=rng.randint(0, 12)))
        best = [0.0] + [-math.inf] * len(word)
        for end in range(1, len(word) + 1):
            for at in range(end):
                piece = word[at:end]
                own = score.get(piece, least if end == at + 1 else -math.inf)
                best[end] = max(best[end], best[at] + own)
        assert viterbi.count(word)[1] == pytest.approx(best[-1])


def test_texts_of_megabytes(spark):
    rng = random.Random(1)
    long = words(rng, 200_000)
    docs = spark.createDataFrame([(1, long, "en"), (2, long + " tail", "en"), (3, "", "en")], "doc_id long, text string, lang string")
    assert [r["component_id"] for r in simhash.near_duplicates(docs).orderBy("id").collect()] == [1, 1, 3]
    assert {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs).collect()} == {1: 0, 2: len(long.encode()), 3: 0}
    item = spark.createDataFrame([(7, " ".join(long.split()[-12:]))], "item_id long, text string")
    assert {r["id"]: r["n_words"] for r in decontamination.find_contamination(docs, item).filter("spans is not null").collect()} == {1: 200_000, 2: 200_001}
    assert quality.judge_quality(docs).filter("n_words >= 200000").count() == 2
    assert interpolation.score_documents(docs).agg(F.max("n_tokens")).first()[0] == 200_002
    assert packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").isEmpty()


def plain_quality(rows, rules=quality.Rules()):  # noqa: B008
    """Per row: base columns, both distances and the verdict, in plain Python."""
    def of_char(c):
        for name, some in (("lower", "abcdefghijklmnopqrstuvwxyz"), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", "0123456789"), ("space", " \t\n\v\f\r"), ("stop", ".,;:!?'\"()-"), ("symbol", "#*$%&|<>")):
            if c in some:
                return name
        return "beyond_ascii" if ord(c) > 127 else "other"

    def distance(p, q):
        keys, a, b = set(p) | set(q), sum(p.values()), sum(q.values())
        kl = lambda x, n: sum(v / n * math.log2(v / n / ((p.get(k, 0) / a + q.get(k, 0) / b) / 2)) for k, v in x.items() if v)
        return math.sqrt(max(0, (kl(p, a) + kl(q, b)) / 2)) if keys else 0

    split = lambda t: __import__("re").findall(r"[^\x20\x09-\x0D]+", t)
    lower = lambda w: w.translate({i: i + 32 for i in range(65, 91)})
    counts, classes = {}, {}
    for _, t, lang in rows:
        counts.setdefault(lang or "", Counter()).update(map(lower, split(t or "")))
        classes.setdefault(lang or "", Counter()).update(map(of_char, t or ""))
    out = []
    for _, t, lang in rows:
        t, c, total = t or "", counts[lang or ""], sum(counts[lang or ""].values())
        w = split(t)
        runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if split(x)]
        base = (len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(again))
        failed = len(w) < rules.min_words or 100 * len(again) > rules.max_repeat_percent * len(w)
        far = common = None
        if total >= rules.min_reference_words:
            if len(t) >= rules.min_class_chars:
                far = distance(Counter(map(of_char, t)), classes[lang or ""])
            if len(w) >= rules.min_common_words:
                top = [k for k, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[: rules.top_words]]
                fold = lambda x: Counter({k: x[k] for k in top if x[k]}) + Counter({"\0": sum(x.values()) - sum(x[k] for k in top)})
                common = distance(fold(Counter(map(lower, w))), fold(c))
        kept = not failed and (far is None or far <= rules.max_class_distance) and (common is None or common <= rules.common_limit(len(w)))
        out.append((*base, far, common, failed, kept))
    return out


def test_quality_equals_brute_force(spark, rows):
    rng = random.Random(8)
    prose = lambda n: " ".join(rng.choices("the of and to in is that was he for it with as his on be at by".split(), k=n))
    own = rows + [(100 + i, prose(rng.randint(5, 300)) + rng.choice([".", " #1\n", " É\t", "|"]), rng.choice(["en", "fr", "xx"])) for i in range(60)]
    own += [(300 + i, "".join(rng.choices("#|$%x 7", k=600)), "en") for i in range(5)] + [(310, "x y\nx y\n \nz", "en")]
    got = quality.judge_quality(frame(spark, own)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "common_distance", "base_failed", "kept"]
    key = lambda x: str((x[0], x[1]))
    told = sorted(((r["row"]["doc_id"], r["row"]["text"], *(r[n] for n in names)) for r in got), key=key)
    want = sorted(((i, t, *x) for (i, t, _), x in zip(own, plain_quality(own), strict=True)), key=key)
    for a, b in zip(told, want, strict=True):
        assert a[:7] == b[:7] and a[9:] == b[9:]
        assert [x if x is None else pytest.approx(x, abs=1e-9) for x in b[7:9]] == list(a[7:9])
    assert {x[-1] for x in want} == {True, False} and any(x[7] for x in want) and any(x[8] for x in want)


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(7)
    text = [words(rng, 80) for _ in range(12)]
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(text)] + [(20, text[0], "en", "s", 1), (21, None, "en", "s", None), (22, text[1][:150] + words(rng, 60), None, None, None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(text[5].split()[:15]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, out, str(tmp_path))
        assert kept.columns == out.columns
        out = spark.createDataFrame(kept.collect(), out.schema)
        names.append({r["doc_id"] for r in out.select("doc_id").collect()})
    assert 21 not in names[0] and 20 not in names[1] and 5 not in names[3]
    assert set(corpus_pipeline.run(spark, str(tmp_path)).toPandas().doc_id) == names[3]


def plain_pipeline(docs, items):
    """Pieces of all five stages, each in plain Python over all pairs, strings and windows. docs: (id, text, lang), ids differ."""
    docs = [d for d, q in zip(docs, plain_quality(docs), strict=True) if q[-1]]
    stay = set(groups_by_similarity([(i, t) for i, t, _ in docs]))
    docs = [(i, t) for i, t, _ in docs if i in stay]
    first = {}
    for i, t in docs:
        b = t.encode()
        for a in range(len(b) - 49):
            first[b[a : a + 50]] = min(i, first.get(b[a : a + 50], i))
    cut = []
    for i, t in docs:
        b, gone = t.encode(), set()
        for a in range(len(b) - 49):
            if first[b[a : a + 50]] < i:
                gone |= set(range(a, a + 50))
        at, kept = 0, ""
        for c in t:
            kept += "" if set(range(at, at + len(c.encode()))) <= gone else c
            at += len(c.encode())
        cut.append((i, kept))
    word = lambda t: __import__("re").findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({i: i + 32 for i in range(65, 91)}))
    keys = {}
    for _, t in items:
        w = word(t)
        n = min(10, len(w))
        keys.setdefault(n, set()).update(tuple(w[k : k + n]) for k in range(len(w) - n + 1) if n)
    hit = lambda w: any(tuple(w[k : k + n]) in own for n, own in keys.items() for k in range(len(w) - n + 1))
    plain, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Counter()
    for i, t in cut:
        if not hit(word(t)):
            ids = [*plain.encode(t, add_special_tokens=False).ids, 2]
            cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
            out.update((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))  # noqa: B905
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(13)
    base = [words(rng, rng.choice([30, 120, 400])) for _ in range(14)]
    passage = words(rng, 30)
    texts = list(base)
    texts += [edited(rng, t, max(1, len(t.split()) // 60)) for t in base[:5]]  # near copies
    texts += [base[6], base[7] + " " + words(rng, 2), words(rng, 40) + passage + words(rng, 40), words(rng, 50) + passage, "É" + passage + "é" + words(rng, 60)]
    texts += ["", None, "too short", "#|$ %" * 120, " ".join(["again and again we go to"] * 20), words(rng, 3000)]
    texts += [words(rng, 60) + " " + " ".join(base[9].split()[3:15]), words(rng, 40) + " only four words here " + words(rng, 30)]
    docs = [(k * 7 % 101 + 1, t, rng.choice(["aa", "aa", None])) for k, t in enumerate(texts)]
    items = [(1, " ".join(base[9].split()[:20])), (2, "ONLY four words, here!"), (3, "")]
    rows = [(i, t, lang, "s", None if t is None else len(t), 1, 2) for i, t, lang in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, place int, kept_text int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = plain_pipeline(docs, items)
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(map(tuple, out.select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == want
    assert len({i for i, *_ in want}) < len({i for i, t, _ in docs if t})
    none = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0


def test_a_pair_of_near_copies_is_compared_once_however_many_shingles_it_shares(spark, monkeypatch):
    """Texts just below the bound, so that no link spares any pair; each shares dozens of first shingles with the others."""
    base, asked, docs = [f"w{i}" for i in range(200)], [], []
    for i in range(12):
        words, a, b = list(base), 6 + 7 * i, 104 + 7 * i
        words[a], words[b], words[b + 1] = f"a{i}", f"b{i}", f"c{i}"
        docs.append((i + 1, " ".join(words)))
    plain = similar.verified

    def seen(pairs, *more):
        kept = similar.stored(pairs, "seen")
        asked.append((kept.count(), kept.distinct().count()))
        return plain(kept, *more)

    monkeypatch.setattr(similar, "verified", seen)
    got = sorted(r["doc_id"] for r in similar.one_of_each_group(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == groups_by_similarity(docs)
    rows, distinct = asked[-1]
    assert 10 < distinct and rows <= 2 * distinct  # both orders at most
