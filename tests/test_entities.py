"""Entity decoding against the standard decoder."""

import html
import random
import re

from pyspark.sql import functions as F

from debutlens.functions import entities, extract


def test_references_equal_the_standard_decoder(spark):
    rng = random.Random(9)
    parts = ["&", "amp", "lt;", "&notit;", "&notin;", "&copyx", "&#", "&#x", "41;", "x1F600;", "#0;", "&#128;", "&#x81", "&#13;", "&#11;", "&#xD800;", "&#99999999999999999999999;", "&#x110000;", "&#xFFFE;", "&#xfdd0;"]
    parts += ["&NotEqualTilde;", "&ngE;", "&eacute", "&nbsp;", "&#x000041;", "&#X3b;", "가", "😀", " ", "\n", "a", ";", "<", "&" + "z" * 40 + ";", "&#44032;", "&#1;", "&#x;", "&#x0;", "&x;", "&gt", "&#00065"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(600)] + [None, "", "&", "a&"] + [f"&{n}" for n in list(html.entities.html5)[::17]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["u"] for r in df.select("i", entities.unescaped(F.col("t")).alias("u")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == (None if t is None else html.unescape(t)), t
    plan = df.select(extract.plain_text(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan  # names of arrows are in the table


def test_texts_of_all_pages_equal_the_standard_decoder(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in pages.select("html", extract.plain_text(F.col("html")).alias("t")).collect():
        want = None if r["html"] is None else re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", r["html"]))).strip()
        assert r["t"] == want
