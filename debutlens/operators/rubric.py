"""Financial attractiveness of a listing: four blocks of ratios, four scores, a total and a grade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: sectors' median PER and PBR, with the last row for any other sector.
SECTOR_MEDIANS = [("IT", 28.0, 3.5), ("바이오", 45.0, 5.0), ("제조", 12.0, 1.1), ("소비재", 18.0, 2.0), ("금융", 10.0, 0.7), ("화학", 11.0, 1.0), ("에너지", 9.0, 0.9), ("건설", 8.0, 0.8), ("통신", 14.0, 1.5), ("유통", 15.0, 1.2), ("기타", 16.0, 1.3)]
OTHER = SECTOR_MEDIANS[-1]
WEIGHTS = {"valuation": 0.40, "growth": 0.30, "profitability": 0.20, "stability": 0.10}
INPUTS = ["revenue_t0", "revenue_t1", "revenue_t2", "operating_income_t0", "operating_income_t1", "operating_income_t2", "net_income_t0", "total_liabilities", "equity", "eps", "ebitda", "interest_expense", "offering_price", "total_shares"]


def present(c: Column) -> Column:
    """The value, NULL for zero."""
    return F.nullif(c, F.lit(0.0))


def cagr(newest: Column, oldest: Column, years: int = 2) -> Column:
    return F.when((newest > 0) & (oldest > 0), F.round(F.pow(newest / oldest, F.lit(1 / years)) - 1, 4))


def total_score(scores: dict[str, Column]) -> Column:
    return F.round(sum((scores[k] * w for k, w in WEIGHTS.items()), F.lit(0.0)), 1)


def grade(total: Column) -> Column:
    return F.when(total >= 75, "A").when(total >= 60, "B").when(total >= 45, "C").otherwise("D")


def rubric(df: DataFrame, sectors: DataFrame | None = None, legacy_cagr: bool = False) -> DataFrame:
    """Adds the blocks, scores, total and grade; rows without price or shares carry analysis_error.

    `sectors`: sector, per, pbr (its rows are few and broadcast); unknown sectors take the default row. Scores
    are made of the rounded ratios. `legacy_cagr` swaps the ends of the growth rates.
    """
    spark = df.sparkSession
    table = sectors if sectors is not None else sector_medians(spark)
    have = set(df.columns)
    d = df.withColumns({c: F.col(c).cast("double") if c in have else F.lit(None).cast("double") for c in INPUTS})
    d = d.join(F.broadcast(table.select(F.col("sector").alias("__s"), F.col("per").alias("__per"), F.col("pbr").alias("__pbr"))), F.col("sector") == F.col("__s"), "left")
    c = {n: F.col(n) for n in INPUTS}
    cap = c["offering_price"] * c["total_shares"]
    per = F.when(c["eps"] > 0, c["offering_price"] / c["eps"]).when((c["net_income_t0"] > 0) & (c["total_shares"] > 0), cap / c["net_income_t0"])
    flag = F.when(c["eps"] > 0, "normal").when((c["net_income_t0"] > 0) & (c["total_shares"] > 0), "calculated").otherwise("deficit")
    earning = F.coalesce(present(c["ebitda"]), c["operating_income_t0"])
    ends = (lambda a, b: cagr(b, a)) if legacy_cagr else cagr
    yoy = lambda now, then: F.when((then > 0) & (now != 0), F.round(now / then - 1, 4))
    over = lambda a, b, r: F.when(b > 0, F.round(a / b, r))
    raw_per, pbr = per, F.when(c["equity"] > 0, cap / c["equity"])
    d = d.withColumns({
        "market_cap_100m": present(F.round(cap / 1e8, 1)),
        "per": present(F.round(raw_per, 1)),
        "per_flag": flag,
        "pbr": present(F.round(pbr, 2)),
        "ev_ebitda": present(F.when(earning > 0, F.round((cap + F.coalesce(c["total_liabilities"], F.lit(0.0))) / earning, 1))),
        "per_vs_sector": F.round(raw_per / F.coalesce("__per", F.lit(OTHER[1])), 2),
        "pbr_vs_sector": F.round(pbr / F.coalesce("__pbr", F.lit(OTHER[2])), 2),
        "revenue_cagr": ends(c["revenue_t0"], c["revenue_t2"]),
        "revenue_yoy": yoy(c["revenue_t0"], c["revenue_t1"]),
        "income_cagr": ends(c["operating_income_t0"], c["operating_income_t2"]),
        "income_yoy": yoy(c["operating_income_t0"], c["operating_income_t1"]),
        "operating_margin": over(c["operating_income_t0"], c["revenue_t0"], 4),
        "net_margin": over(c["net_income_t0"], c["revenue_t0"], 4),
        "roe": over(c["net_income_t0"], c["equity"], 4),
        "is_profitable": F.coalesce(c["net_income_t0"] > 0, F.lit(False)),
        "debt_to_equity": over(c["total_liabilities"], c["equity"], 2),
        "interest_coverage": F.when(c["operating_income_t0"] != 0, over(c["operating_income_t0"], c["interest_expense"], 1)),
    })
    z = lambda x: F.coalesce(x, F.lit(0.0))
    # at 15 decimals first: the last bit of a sum of few digits doesn't tell on which side of a tie it is
    score = lambda x: F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), x)).cast("decimal(38,15)"), 1).cast("double")
    by_per = F.when(F.col("per_vs_sector").isNotNull(), (1 - F.col("per_vs_sector")) * 30).when(F.col("per_flag") == "deficit", -20.0)
    d = d.withColumns({
        "valuation_score": score(50 + z(by_per) + z((1 - F.col("pbr_vs_sector")) * 10)),
        "growth_score": score(50 + z(F.col("revenue_cagr") * 100) + z(F.col("revenue_yoy") * 50)),
        "profitability_score": score(50 + z(F.col("operating_margin") * 100) + z(F.col("roe") * 50) - F.when(F.col("is_profitable"), 0.0).otherwise(20.0)),
        "stability_score": score(70 - z(F.least(F.lit(30.0), F.col("debt_to_equity") * 10)) + z(F.when(F.col("interest_coverage") > 0, F.least(F.lit(20.0), F.col("interest_coverage") * 2)))),
    })
    d = d.withColumn("total_score", total_score({k: F.col(f"{k}_score") for k in WEIGHTS})).withColumn("grade", grade(F.col("total_score")))
    return d.withColumn("analysis_error", F.col("offering_price").isNull() | F.col("total_shares").isNull()).drop("__s", "__per", "__pbr")


def sector_medians(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SECTOR_MEDIANS, "sector string, per double, pbr double")


def accounts_wide(accounts: DataFrame, listings: DataFrame, names: list[str], years: int = 4) -> DataFrame:
    """Accounts by age before the listing: <name>_t0 is the last fiscal year before its date, _t1 the one before."""
    aged = accounts.join(listings.select("listing_id", "corp_code", F.year("listing_date").alias("__y")), "corp_code").withColumn("t", F.col("__y") - 1 - F.col("year")).filter(F.col("t").between(0, years - 1))
    labels = [f"{n}_t{k}" for n in names for k in range(years)]
    return aged.withColumn("label", F.concat("account", F.lit("_t"), F.col("t").cast("string"))).groupBy("listing_id").pivot("label", labels).agg(F.sum("amount"))
