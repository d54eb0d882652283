"""Patterns of a text are searched once, and numbers are not made texts."""

from pyspark.sql import functions as F

from debutlens.functions import extract
from debutlens.functions.cleaning import number, number_of


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_field_is_searched_once(spark):
    texts = spark.createDataFrame([(1, "경쟁률 5.5 : 1 합계 40 주 6개월 10 주"), (2, "합계 0 주"), (3, None)], "i int, t string")
    demand = extract.with_demand_fields(texts, F.col("t"), ["i"])
    assert plan_of(demand).count("regexp_extract(") == 7
    assert sorted(map(tuple, demand.collect()), key=str) == sorted(map(tuple, texts.select("i", *[c.alias(k) for k, c in extract.demand_fields(F.col("t")).items()]).collect()), key=str)
    offers = extract.with_offering_fields(texts, F.col("t"), ["i"])
    want = texts.select("i", *[c.alias(k) for k, c in extract.offering_fields(F.col("t")).items()])
    assert offers.columns == want.columns and sorted(map(tuple, offers.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_numbers_are_not_made_texts(spark):
    rows = spark.createDataFrame([(float("nan"), 3, "1,5", 0.1, True), (-0.0, None, "x", None, None), (None, 2**62 + 1, "NaN", 2.5, False)], "d double, n long, s string, f float, b boolean")
    for c in rows.columns:
        got = [(r[0], r[1]) for r in rows.select(number_of(rows, c), number(F.col(c))).collect()]
        assert [a for a, _ in got] == [b for _, b in got], c
    assert "as string" not in plan_of(rows.select(number_of(rows, "d"), number_of(rows, "n")))
