"""Boosted trees of one split each, whose every step SQL can say too: final model, back-test, folds, importances.

The features have few values, so that the trees' thresholds are the middles between neighbouring values, and all rows
train every tree. The operators are those of the larger ensembles; only their settings differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import model
from ..sources.store import scratch, stored
from . import proxies as P
from .queries import query, returns

FEATURES = ["demand", "season", "tenth"]
ROUNDS, STEP = 3, 0.5
STUMPS = {"maxIter": ROUNDS, "maxDepth": 1, "stepSize": STEP, "subsamplingRate": 1.0}


def rows_of(spark, d) -> DataFrame:
    """Listings with the number of lines of their offer, their month, and tenths of a commitment that some lack."""
    lines = P.offers(spark, d).select("listing_id", F.col("institutional_demand_ratio").alias("demand"), (F.floor(F.col("lockup_3m_ratio") * 10) / 10).alias("tenth"))
    listed = returns(spark, d).select("listing_id", "listing_date", "open_return_pct", F.month("listing_date").cast("double").alias("season"))
    return stored(listed.join(lines, "listing_id"), "few-valued")


ROWS_SQL = """
, b AS MATERIALIZED (SELECT listing_id AS id, listing_date AS day, ret AS y, institutional_demand_ratio AS demand, month(listing_date)::DOUBLE AS season, floor(lockup_3m_ratio * 10) / 10 AS tenth
  FROM p_listings JOIN p_offer USING (listing_id))
"""


def boosted_sql(name: str, source: str, rest: str) -> str:
    """Tables {name}{ROUNDS}: the rows of `source` (g, train, id, y, features) with p, their boosted sums by group g.

    The first tree fits `first`, the later ones `rest`, with STEP as their weight; {name}_best{i} are the trees.
    """
    out = []
    for i in range(ROUNDS):
        before = f"(SELECT *, 0.0::DOUBLE AS p FROM {source})" if i == 0 else f"{name}{i}"
        sums = "\n    UNION ALL ".join(f"SELECT g, '{f}' AS f, {f} AS v, count(*) AS n, sum(r) AS s FROM {name}_r{i} WHERE train GROUP BY g, {f}" for f in FEATURES)
        value = "CASE f " + " ".join(f"WHEN '{f}' THEN {f}" for f in FEATURES) + " END"
        out.append(f"""
, {name}_r{i} AS MATERIALIZED (SELECT *, {"y" if i == 0 else rest} AS r FROM {before})
, {name}_c{i} AS (SELECT g, f, (v + lead(v) OVER w) / 2 AS cut, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER a AS n, sum(s) OVER a AS s
  FROM ({sums}) WINDOW w AS (PARTITION BY g, f ORDER BY v), a AS (PARTITION BY g, f))
, {name}_best{i} AS MATERIALIZED (SELECT g, unnest(max_by({{f: f, cut: cut, low: sl / nl, high: (s - sl) / (n - nl), gain: sl * sl / nl + (s - sl) ** 2 / (n - nl) - s * s / n}},
  sl * sl / nl + (s - sl) ** 2 / (n - nl))) FROM {name}_c{i} WHERE cut IS NOT NULL GROUP BY g)
, {name}{i + 1} AS MATERIALIZED (SELECT {name}_r{i}.* EXCLUDE (p, r), p + {1 if i == 0 else STEP} * CASE WHEN {value} <= cut THEN low ELSE high END AS p FROM {name}_r{i} JOIN {name}_best{i} USING (g))""")
    return "".join(out)


def both_sql(source: str) -> str:
    """Tables reg{ROUNDS} and cls{ROUNDS}: sums of the regressor and of the classifier, whose labels are 1 and -1."""
    signs = f", signs AS MATERIALIZED (SELECT * REPLACE (CASE WHEN y > 0 THEN 1.0 ELSE -1.0 END::DOUBLE AS y) FROM {source})"
    return boosted_sql("reg", source, "2 * (y - p)") + "\n" + signs + boosted_sql("cls", "signs", "4 * y / (1 + exp(2 * y * p))")


#: Rows with part 'score' as the model finishes them, intervals by the errors of part 'calibrate'.
FINISHED_SQL = f"""
, q AS (SELECT g, quantile_cont(abs(y - p), 0.5) AS q50, quantile_cont(abs(y - p), 0.9) AS q90 FROM reg{ROUNDS} WHERE part = 'calibrate' GROUP BY g)
, m AS (SELECT g, id, r.y, round(r.p, 2) AS pred, round(1 / (1 + exp(-2 * c.p)), 4) AS up_prob, round(r.p - q90, 2) AS ci_90_low, round(r.p + q90, 2) AS ci_90_high,
  round(r.p - q50, 2) AS ci_50_low, round(r.p + q50, 2) AS ci_50_high FROM reg{ROUNDS} r JOIN cls{ROUNDS} c USING (g, id, part) JOIN q USING (g) WHERE part = 'score')
"""
GRADE = "CASE WHEN ci_90_high - ci_90_low < 30 AND up_prob > 0.65 THEN 'A' WHEN ci_90_high - ci_90_low < 60 AND up_prob > 0.5 THEN 'B' ELSE 'C' END AS risk_grade"
OUT = ["pred", "up_prob", "ci_90_low", "ci_90_high", "ci_50_low", "ci_50_high", "risk_grade"]

#: All listings are scored; of those with a return the last 15 %, 10 at least, calibrate and the others train. NULL is 0.
FINAL_SQL = ROWS_SQL + """
, z AS (SELECT * REPLACE (coalesce(tenth, 0) AS tenth) FROM b)
, k AS (SELECT *, row_number() OVER (ORDER BY day DESC, id DESC) AS back, greatest(10, floor(0.15::DOUBLE * count(*) OVER ())) AS held FROM z WHERE y IS NOT NULL)
, t AS MATERIALIZED (SELECT 0 AS g, CASE WHEN back <= held THEN 'calibrate' ELSE 'train' END AS part, back > held AS train, id, y, demand, season, tenth FROM k
  UNION ALL SELECT 0, 'score', false, id, y, demand, season, tenth FROM z)
"""
ORDER = ["listing_date", "listing_id"]


def final_of(rows: DataFrame) -> model.ReturnModel:
    return model.final_model(rows, FEATURES, "open_return_pct", ORDER, **STUMPS)


#: Features by their share in what all splits gain.
GAINS_SQL = ", gains AS (" + " UNION ALL ".join(f"SELECT f, gain FROM reg_best{i}" for i in range(ROUNDS)) + ")"


@query(FINAL_SQL + both_sql("t") + FINISHED_SQL + GAINS_SQL + f"""
, best AS (SELECT f FROM gains GROUP BY f ORDER BY sum(gain) DESC LIMIT 1)
SELECT id AS listing_id, {", ".join(OUT[:-1])}, {GRADE}, f AS top_feature, CASE f WHEN 'demand' THEN demand WHEN 'season' THEN season ELSE tenth END AS top_value
FROM m JOIN z USING (id), best
""")
def boosted_final(spark, d):
    """The final model of all listings, saved and loaded, scores every listing; the feature that matters most, explained."""
    rows, path = rows_of(spark, d), scratch(spark, "final-model")
    final_of(rows).save(path)
    fitted = model.ReturnModel.load(path)
    scored = fitted.explain(fitted.predict(rows.fillna(0.0, FEATURES)), 1)
    top = F.col("top_features")[0]
    return scored.select("listing_id", *OUT, top["feature"].alias("top_feature"), top["value"].alias("top_value"))


@query(FINAL_SQL + boosted_sql("reg", "t", "2 * (y - p)") + GAINS_SQL + """
SELECT feature, round(sum(coalesce(gain, 0)) / (SELECT sum(gain) FROM gains), 6) AS importance, round(100 * sum(coalesce(gain, 0)) / (SELECT sum(gain) FROM gains), 2) AS importance_pct
FROM (VALUES ('demand'), ('season'), ('tenth')) AS x(feature) LEFT JOIN gains ON f = feature GROUP BY 1
""")
def boosted_importance(spark, d):
    """The importance of the final model's features."""
    return final_of(rows_of(spark, d)).importance(spark).select("feature", F.round("importance", 6).alias("importance"), "importance_pct")


MEDIANS = ", ".join(f"median({f}) AS {f}_fill" for f in FEATURES)
FILLED = ", ".join(f"coalesce({f}, {f}_fill) AS {f}" for f in FEATURES)


@query(ROWS_SQL + f"""
, k AS (SELECT * FROM b WHERE y IS NOT NULL)
, e AS (SELECT min(day) AS a, max(day) AS z FROM k)
, s AS (SELECT u::DATE AS split FROM e, unnest(generate_series((a + 1095)::TIMESTAMP, (z - 180)::TIMESTAMP, INTERVAL 90 DAY)) AS x(u))
, c AS (SELECT split, count(*) FILTER (day < split) AS n_train, count(*) FILTER (day >= split) AS n_valid FROM s JOIN k ON day < split + 180 GROUP BY 1)
, w AS (SELECT *, (row_number() OVER (ORDER BY split) - 1)::INTEGER AS g FROM c WHERE n_train >= 20 AND n_valid >= 5)
, j AS MATERIALIZED (SELECT g, day >= split AS late, n_train, k.* FROM k JOIN w ON day < split + 180)
, f AS (SELECT g, {MEDIANS} FROM j WHERE NOT late GROUP BY g)
, o AS (SELECT g, id, y, {FILLED}, late, NOT late AND row_number() OVER (PARTITION BY g, late ORDER BY day DESC, id DESC) <= greatest(5, floor(0.15::DOUBLE * n_train)) AS held FROM j JOIN f USING (g))
, t AS MATERIALIZED (SELECT *, CASE WHEN late THEN 'score' WHEN held THEN 'calibrate' ELSE 'train' END AS part, NOT late AND NOT held AS train FROM o)
""" + both_sql("t") + FINISHED_SQL + f"""
SELECT g AS "window", id AS listing_id, round(y, 4) AS actual, {", ".join(OUT[:-1])}, {GRADE}, abs(round(y - pred, 4)) AS abs_error FROM m
""")
def boosted_windows(spark, d):
    """The predictions of all walk-forward windows, each trained, filled and calibrated on what lies before its split."""
    out = model.walk_forward(rows_of(spark, d), FEATURES, threads=4, whole=True, **STUMPS)
    return out.select("window", "listing_id", F.round("actual", 4).alias("actual"), *OUT, F.round("abs_error", 4).alias("abs_error"))


@query(ROWS_SQL + f"""
, k AS (SELECT * REPLACE (coalesce(tenth, 0) AS tenth), ntile(5) OVER (ORDER BY day, id) AS fold FROM b WHERE y IS NOT NULL)
, t AS MATERIALIZED (SELECT g, fold <> g AS train, id, y, demand, season, tenth FROM k, range(1, 6) AS x(g))
""" + boosted_sql("reg", "t", "2 * (y - p)") + f"""
SELECT round(avg(e), 3) AS mae_mean, round(stddev_pop(e), 3) AS mae_std FROM (SELECT avg(abs(y - round(p, 2))) AS e FROM reg{ROUNDS} WHERE NOT train GROUP BY g)
""")
def boosted_folds(spark, d):
    """Five consecutive folds, each scored by the trees of the others."""
    rows = rows_of(spark, d).fillna(0.0, FEATURES)
    return model.cross_validate(rows, FEATURES, "open_return_pct", ORDER, 5, threads=3, **STUMPS)
