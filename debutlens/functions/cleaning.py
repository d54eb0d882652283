"""Column expressions that clean raw values. Nothing here raises on bad input: it becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Company forms removed from names, and the title of an equity filing.
COMPANY_FORMS = "주식회사|㈜|\\(주\\)|\\(株\\)"
EQUITY_TITLE = "증권신고서.*지분증권|지분증권.*증권신고서"


def number(c: Column) -> Column:
    """A number, with or without thousands commas; NaN and bad input are NULL. The text is read once."""
    return known(F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast("double"))


def known(c: Column) -> Column:
    """A double, NaN as NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def number_of(df: DataFrame, name: str) -> Column:
    """`number` of a column; one whose type says that it is a whole number or a double isn't made a text first."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DoubleType):
        return known(F.col(name))
    return F.col(name).cast("double") if isinstance(kind, T.IntegralType) else number(F.col(name))


def clip(c: Column, low: float | None, high: float | None) -> Column:
    """`c` held between bounds; NULL stays NULL (least and greatest alone would pass it over)."""
    out = c
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(c.isNotNull(), out)


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is above zero."""
    return F.when(b > 0, a / b)


def rounded(c: Column, digits: int) -> Column:
    """Rounds the double times a power of ten, half away from zero, as the queries' SQL does. `F.round` rounds the number
    as it is written, which is another one next to a tie."""
    return F.round(c * 10.0**digits) / 10.0**digits


def day(c: Column, pattern: str = "yyyyMMdd") -> Column:
    return F.try_to_timestamp(c, F.lit(pattern)).cast("date")


def clean_name(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, COMPANY_FORMS, ""), "(?U)^\\s+|\\s+$", "")


def is_equity_title(c: Column) -> Column:
    return c.rlike(EQUITY_TITLE)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """`df` with the columns and types of `schema`: absent columns are NULL, values that don't cast too."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])



def first_column(df: DataFrame, names: list[str], kind: str = "string") -> Column:
    """The first of these columns that the table has, else NULL."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(None).cast(kind))
