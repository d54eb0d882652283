"""Boosted trees against a plain version, and the registered queries of small trees against their SQL."""

import math
import random

import duckdb
import pytest

import __spark_entry__ as entry
from debutlens.operators import model

SF = "/root/testdata/sf0.001"


def grown(rows, values, depth):
    """A tree over rows (tuples) as a function of a row: each split leaves the least squares, leaves give means."""
    mean = sum(values) / len(values)
    best = None
    for f in range(len(rows[0])) if depth else ():
        for cut in sorted({r[f] for r in rows})[:-1]:
            sides = [[v for r, v in zip(rows, values, strict=True) if (r[f] <= cut) is low] for low in (True, False)]
            gain = sum(sum(s) ** 2 / len(s) for s in sides) - sum(values) ** 2 / len(values)
            if gain > 1e-12 and (best is None or gain > best[0]):
                best = gain, f, cut
    if best is None:
        return lambda row: mean
    _, f, cut = best
    low, high = (grown(*zip(*[(r, v) for r, v in zip(rows, values, strict=True) if (r[f] <= cut) is side], strict=True), depth - 1) for side in (True, False))
    return lambda row: low(row) if row[f] <= cut else high(row)


def boosted(rows, labels, rounds, depth, step, gradient):
    sums = [0.0] * len(rows)
    for i in range(rounds):
        tree = grown(rows, [y if i == 0 else gradient(y, p) for y, p in zip(labels, sums, strict=True)], depth)
        sums = [p + (step if i else 1.0) * tree(r) for p, r in zip(sums, rows, strict=True)]
    return sums


@pytest.mark.parametrize("depth", [1, 3])
def test_both_fits_equal_plain_boosting(spark, depth):
    rng = random.Random(depth)
    rows = [(float(rng.randrange(9)), float(rng.randrange(6)), float(rng.randrange(20))) for _ in range(400)]
    returns = [3 * a - b * b + (c > 11) * 8 + rng.gauss(0, 4) for a, b, c in rows]
    df = spark.createDataFrame([(i, *r, y) for i, (r, y) in enumerate(zip(rows, returns, strict=True))], "id long, a double, b double, c double, y double")
    fitted = model.ReturnModel(["a", "b", "c"], "y", maxIter=5, maxDepth=depth, stepSize=0.3, subsamplingRate=1.0).fit(df)
    got = {r["id"]: r for r in fitted.predict(df).collect()}
    plain = boosted(rows, returns, 5, depth, 0.3, lambda y, p: 2 * (y - p))
    signs = boosted(rows, [1.0 if y > 0 else -1.0 for y in returns], 5, depth, 0.3, lambda y, p: 4 * y / (1 + math.exp(2 * y * p)))
    errors = sorted(abs(y - p) for y, p in zip(returns, plain, strict=True))
    at = 0.9 * (len(errors) - 1)
    q90 = errors[int(at)] + (at - int(at)) * (errors[int(at) + 1] - errors[int(at)])
    assert fitted.q90 == pytest.approx(q90)
    for i, (p, s) in enumerate(zip(plain, signs, strict=True)):
        assert got[i]["pred"] == pytest.approx(p, abs=0.00501)
        assert got[i]["up_prob"] == pytest.approx(1 / (1 + math.exp(-2 * s)), abs=0.0000501)
        assert got[i]["ci_90_high"] == pytest.approx(p + q90, abs=0.00501)


def plain_rows(name):
    with duckdb.connect() as con:
        for table in ("orders", "lineitem", "customer", "events"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        found = con.execute(entry.oracle_sql()[name])
        return [c[0] for c in found.description], found.fetchall()


@pytest.mark.parametrize("name", ["boosted_importance", "boosted_final"])
def test_queries_of_small_trees_equal_their_sql(spark, name):
    columns, rows = plain_rows(name)
    got = [tuple(r) for r in entry.queries()[name](spark, SF).select(*columns).collect()]
    assert got and sorted(got) == sorted(rows)
