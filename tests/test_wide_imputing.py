"""The imputer of many columns: short enough for Java to compile, its columns made without decimals."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from debutlens.operators import catalog
from debutlens.plans import jobs


def test_the_imputer_is_short_enough_to_be_compiled(spark):
    rows = spark.range(50).select(F.col("id").alias("listing_id"), *[jobs.raw_column(i, f).alias(f.name) for i, f in enumerate(jobs.WIDE)])
    out = catalog.FittedImputer(jobs.WIDE, {f.name: 0.25 for f in jobs.WIDE}).transform(rows, ["listing_id"])
    with contextlib.redirect_stdout(io.StringIO()) as told:
        out.select("listing_id", *[F.round(f.name, 5) for f in jobs.WIDE]).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", told.getvalue())]
    assert sizes and max(sizes) < 8000  # Java interprets longer ones


def test_columns_without_decimals_equal_those_of_the_sql(spark):
    rows = spark.range(30_000).withColumnRenamed("id", "listing_id")
    for i, f in enumerate(jobs.WIDE):
        assert rows.filter(~F.expr(jobs.raw_value(i, f)).cast("double").eqNullSafe(jobs.raw_column(i, f))).count() == 0, f.name
