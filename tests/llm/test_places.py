"""Rows keep their numbers when the number of cores changes between two jobs of one run."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from debutlens.llm import decontamination, simhash
from debutlens.sources.store import scratch

SETTING = "spark.sql.leafNodeDefaultParallelism"


@pytest.fixture(scope="module")
def sf_dir(spark):
    """Documents with columns named like the operators' own, in several files, and a benchmark of passages of theirs."""
    say = lambda i: " ".join(f"w{(i * 31 + j * j * 7) % 997}" for j in range(60 + i % 9))
    rows = [(i, say(i if i % 5 else 5), "en", f"s{i % 3}", i, i, 2 * i, f"k{i}") for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, __place long, place long, __kept string")
    path = scratch(spark, "places")
    docs.repartition(12, "n_chars").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(say(7).split()[3:20])), (2, "w1 w2")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def collected(spark, sf_dir, make, action_cores):
    """What `make` returns, with other cores known when its last job runs than when the operator's own jobs ran."""
    spark.conf.set(SETTING, "8")
    try:
        out = make(spark.read.parquet(f"{sf_dir}/documents.parquet"))
        spark.conf.set(SETTING, str(action_cores))
        return sorted(map(tuple, out.collect()), key=repr)
    finally:
        spark.conf.unset(SETTING)


@pytest.mark.parametrize("name", ["near_duplicates", "repeats", "benchmark"])
def test_stages_keep_rows_together(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    one, other = (collected(spark, sf_dir, lambda docs: stage(spark, docs, sf_dir), cores) for cores in (8, 2))
    assert one == other and one
    names = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    for row in one:
        r = dict(zip(names, row))
        assert r["__place"] == r["doc_id"] and r["place"] == 2 * r["doc_id"] and r["__kept"] == f"k{r['doc_id']}"
        assert r["text"] == "" or r["text"].split()[-1] == f"w{((r['doc_id'] if r['doc_id'] % 5 else 5) * 31 + (59 + (r['doc_id'] if r['doc_id'] % 5 else 5) % 9) ** 2 * 7) % 997}" or name == "repeats"


def test_operators_keep_rows_together(spark, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = lambda docs: decontamination.find_contamination(docs, items).select("id", "row.doc_id", "n_words", F.size("spans").alias("n"))
    one, other = (collected(spark, sf_dir, found, cores) for cores in (8, 2))
    assert one == other and sum((r[3] or 0) > 0 for r in one) >= 1 and all(r[0] == r[1] for r in one)
    one, other = (collected(spark, sf_dir, simhash.one_of_each_group, cores) for cores in (8, 2))
    assert one == other and one
