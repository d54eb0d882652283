"""Mixing, manifest and audit against brute force, with the edge cases of their tables."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from debutlens.llm import audit, merkle, mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, size long, mask int, grp string, at long, h long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "r", 1, 2, "g", 3, 4) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    say = lambda n: "".join(rng.choice(["ab", "Éa", "AB", "c#", "d"]) + rng.choice([" ", "\t", "\n", " ", "  "]) for _ in range(n))
    long = say(400_000)
    out = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n ", "en", "a", 3), (4, long, "en", "b", 9), (5, long, "fr", "b", 9), (5, long, "fr", "b", 9), (None, long, "en", "c", 7), (None, "only here", None, "c", 9)]
    out += [(10 + i, say(rng.randint(1, 300)), rng.choice(["en", "fr", "日本", ""]), rng.choice(["a", "b", "c", "日", None]), i) for i in range(120)]
    return out + [(200 + i, "the same copy " * 80, "en", "a", 80) for i in range(30)]


def test_mix_meets_targets_and_repeats_itself(spark, rows):
    docs = frame(spark, rows)
    got = mixing.mix_sources(docs, seed=3).select("row.doc_id", "row.text", "row.source", "row.h", "size", "source_size", "target", "repeats").collect()
    assert len(got) == len(rows) and all(r["h"] == 4 for r in got)
    sizes, words = Counter(), Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, full = {}, set()
    while True:  # plain water-filling
        left, share = sum(sizes.values()) - sum(3 * sizes[s] for s in full), sum(weight[s] for s in order if s not in full)
        want = {s: 3.0 * sizes[s] if s in full else weight[s] * left / share for s in order}
        above = {s for s in order if want[s] > 3 * sizes[s] + 1e-6}
        if not above:
            break
        full |= above
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and 0 <= r["repeats"] <= 3
        words[r["source"]] += r["size"] * r["repeats"]
    long = len(WORD.findall(rows[3][1]))
    for s in order:  # a source of a few long texts can miss by half of one
        assert abs(words[s] - want[s]) <= (20 if s in ("日", None) else long / 2 + 20)
    again = mixing.mix_sources(docs.repartition(7, "lang"), seed=3).select("row.doc_id", "row.text", "size", "repeats")
    key = lambda r: (str(r["doc_id"]), r["text"] or "", r["repeats"])
    assert sorted(map(key, got)) == sorted(map(key, again.collect()))
    assert mixing.mixed(docs, seed=3).count() == sum(r["repeats"] for r in got)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_select_over_several_rounds_equals_plain_order(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DIGIT_BITS", 6)
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "w " * rng.randint(0, 9), rng.choice("ab")) for i in range(800)] + [(None, "w " * 50, "a")] * 400, "doc_id long, text string, source string")
    rows = mixing.measured(docs, "doc_id", "source", "text", 1)
    slim = mixing.stored(rows, "slim")
    plan = {r["source"]: r for r in mixing.targets(slim, {"a": 0.7, "b": 1.1}, 3, 1.0).collect()}
    got = mixing.taken(slim, mixing.mix_plan(slim, {"a": 0.7, "b": 1.1}, 3, 1.0)).select("row.source", "row.doc_id", "size", "repeats").collect()
    groups = defaultdict(lambda: defaultdict(int))
    for r in slim.collect():
        groups[r["source"]][r["h"]] += r["size"]
    for s, by_hash in groups.items():
        taken, left, whole = 0, plan[s]["want"], plan[s]["reps"] * plan[s]["source_size"]
        for h in sorted(by_hash):  # the prefix of the order; what still fits comes from the last part only
            if by_hash[h] > left:
                break
            left -= by_hash[h]
            taken += by_hash[h]
        total = sum(r["size"] * r["repeats"] for r in got if r["source"] == s) - whole
        assert taken <= total and abs(plan[s]["want"] - total) <= 25  # half of the least text left out


def plain_manifest(leaves, shown):
    """[(group, id, leaf)] and the leaves shown: by leaf, (subroot, root, proof, folded)."""
    h = lambda s: sha256(s.encode()).hexdigest()

    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, path in enumerate(paths):
                j = at[i] ^ 1
                path.append("-" if j >= len(nodes) else ("L" if j < at[i] else "R") + nodes[j])
                at[i] >>= 1
            nodes = [h("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        return nodes[0], paths

    groups = defaultdict(list)
    for i, (group, key, leaf) in enumerate(leaves):
        groups[group].append((key is not None, key or 0, leaf, i))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    root, tops = tree([trees[g][0] for g in order])
    out = {}
    for g, top in zip(order, tops):
        for (_, _, leaf, i), path in zip(sorted(groups[g]), trees[g][1]):
            fold = shown[i]
            for step in path + top:
                fold = h(step[1:] + fold if step[0] == "L" else fold + step[1:])
            out[i] = (leaf, trees[g][0], root, tuple(path + top), fold)
    return out


@pytest.mark.parametrize("bits", [2, 3, 12])
def test_manifest_equals_plain_tree(spark, rows, bits):
    docs = frame(spark, rows)
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda i, t, lang, source, n: sha256("".join(map(said, (i, source, lang, n, t))).encode()).hexdigest()
    bad = [i is not None and zlib.crc32(str(i).encode()) % 7 == 0 for i, *_ in rows]
    leaves = [(lang, i, leaf(i, t, lang, source, n)) for i, t, lang, source, n in rows]
    shown = [leaf(i, t, lang, source, None if n is None else n + b) for (i, t, lang, source, n), b in zip(rows, bad)]
    want = plain_manifest(leaves, shown)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.build_manifest(docs, shown={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, bits=bits).collect()
    assert sorted((r["leaf"], r["subroot"], r["root"], tuple(r["proof"]), r["folded_root"]) for r in got) == sorted(want.values())
    for r in got:
        assert r["proof_sha256"] == sha256("".join(x[1:] for x in r["proof"]).encode()).hexdigest()
        assert r["verified"] == (r["folded_root"] == r["root"])
    assert any(not r["verified"] for r in got) and {r["grp"] for r in got} == {lang for _, _, lang, *_ in rows}
    assert merkle.build_manifest(docs.limit(0)).count() == 0
    one = merkle.build_manifest(docs.filter("doc_id = 12")).first()
    assert one["root"] == one["subroot"] == one["leaf"] and one["proof"] == [] and one["verified"]


def test_transducer_equals_patterns(rows, monkeypatch):
    texts = [t for _, t, *_ in rows if t and len(t) < 5000] + ["", "é", "a" * 50, " a", "a ", "日本 語#", "\x1f\x85 　x"]
    for block in (1, 3, 7, 1 << 20):
        monkeypatch.setattr(audit, "BLOCK", block)
        for t in texts:
            got, found = audit.transduce(t.encode()), WORD.findall(t)
            assert (got.words, got.points, got.capitals) == (len(found), len(t), len(re.findall("[A-Z]", t)))
            assert got.symbols == len(re.findall("[#$%&*|]", t)) and got.table == {w.encode() for w in found}


def test_audit_equals_brute_force(spark, rows):
    rng = random.Random(3)
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i, *_ in rows if i and rng.random() < 0.6] + [(12, 1, 0), (12, None, 1), (None, 1, 1)]
    got = audit.audit_filters(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    of = defaultdict(lambda: [0, 0])
    for i, good, toxic in labels:
        of[i] = [of[i][0] or int(good == 1), of[i][1] or int(toxic == 1)]
    least = {}
    for i, t, *_ in rows:
        key = (i is None, i or 0)
        least[t or ""] = min(least.get(t or "", key), key)
    docs = []
    for i, t, lang, *_ in rows:
        t, w = t or "", WORD.findall(t or "")
        a, b = len(w) < 200, 100 * len(set(w)) < 50 * len(w)
        c, d = 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search("[#$%&*|]", t))
        fails = {f for f, bad in zip("ABCDE", (a, b, c, d, least[t] < (i is None, i or 0))) if bad}
        docs.append((lang or "", fails, of[i] if i is not None else [0, 0]))
    parts = {p for p, *_ in docs}
    want, shap = {}, Counter()
    for part in parts:
        for order in map("".join, permutations("ABCDE")):
            left = [x for x in docs if x[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                alone = sum(x[0] == part and x[1] == {f} for x in docs)
                want[part, order, step] = (len(left), len(out), sum(f in x[1] for x in gone), alone, sum(x[2][0] for x in out), sum(x[2][1] for x in out))
                shap[part, f] += len(out)
                gone += out
    found = {(r["part"], r["filter_order"], r["step"]): r for r in got.collect()}
    assert set(found) == set(want)
    for (part, order, step), values in want.items():
        r = found[part, order, step]
        assert (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"]) == values
        assert r["shapley"] == shap[part, order[step - 1]]


def test_audit_of_empty_tables(spark, rows):
    docs, none = frame(spark, rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_filters(docs.limit(0), none).count() == 0
    assert audit.audit_filters(docs, none).agg(F.sum("good_lost")).first()[0] == 0
