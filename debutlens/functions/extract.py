"""Fields of filing texts as one native projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cleaning import clip, first_column, number
from .entities import unescaped

#: The labels and patterns of the filings' fields, and the underwriters of either tier.
BAND = "희망\\s*공모가[^0-9]*([0-9,]+)\\s*[~～]\\s*([0-9,]+)"
CONFIRMED = "확정\\s*공모가[^0-9]*([0-9,]+)"
NEW_SHARES = "신주모집|신주발행|모집주식수"
SECONDARY_SHARES = "구주매출|매출주식수"
TOTAL_SHARES = "상장예정주식수|상장\\s*예정\\s*주식수|상장\\s*후\\s*총\\s*발행주식수|발행주식총수"
UNDERWRITER = "(?:대표\\s*주관\\s*회사|대표주관회사|공동주관회사|주관회사|인수회사)[^가-힣A-Za-z0-9]{0,20}([가-힣A-Za-z0-9&().\\s·]+?증권)"
LOCKUP = "최대주주.{0,120}?(\\d+\\s*년\\s*\\d+\\s*개월|\\d+\\s*년|\\d+\\s*개월)"
RISKS = "(?:투자위험요소|위험요소)(.{0,20000})"
RISK_MARK = "(?:^|\\s)(?:[가-하]\\.|[0-9]{1,2}\\.|[①-⑳])"
LISTING = "상장\\s*예정일[^0-9]*(\\d{4})\\s*[.\\-년]\\s*(\\d{1,2})\\s*[.\\-월]\\s*(\\d{1,2})"
DEMAND = "경쟁률[^0-9]*([0-9,]+(?:\\.[0-9]+)?)\\s*(?::|대)\\s*1"
LOCKUP_LABELS = {"lockup_6m_ratio": "6개월", "lockup_3m_ratio": "3개월", "lockup_1m_ratio": "1개월", "lockup_15d_ratio": "15일", "lockup_none_ratio": "확약없음|미확약"}
UNDERWRITER_COLUMNS = ("lead_underwriter", "underwriter", "underwriters", "manager")
RISK_TEXT_COLUMNS = ("risk_factor_text", "risk_factors", "prospectus_risk_text")
TIER_1 = ("NH투자증권", "한국투자증권", "미래에셋증권", "KB증권", "삼성증권", "신한투자증권", "하나증권")
TIER_2 = ("대신증권", "키움증권", "신영증권", "유안타증권", "교보증권", "하이투자증권", "IBK투자증권", "DB금융투자", "메리츠증권", "현대차증권", "유진투자증권", "한화투자증권", "SK증권")


def plain_text(c: Column) -> Column:
    """Tags to spaces, entities decoded, white space (no-break spaces too) collapsed and trimmed."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(c, "<[^>]+>", " ")), "(?U)\\s+", " "))


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, NULL without one."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def whole(c: Column) -> Column:
    """A whole number with or without commas; of anything else, no text too, NULL."""
    return F.replace(c, F.lit(","), F.lit("")).try_cast("long")


def shares_after(text: Column, labels: str, unit: str = "주", skip_count_column: bool = False) -> Column:
    """The number before `unit` that follows a label; optionally past one whole number in between."""
    between = "[^0-9]{0,120}(?:[0-9,]+\\s+)?" if skip_count_column else "[^0-9]{0,120}"
    return whole(F.regexp_extract(text, f"(?:{labels}){between}([0-9,]+)\\s*{unit}", 1))


def lockup_months(text: Column) -> Column:
    part = lambda x, unit: F.coalesce(F.regexp_extract(x, f"(\\d+)\\s*{unit}", 1).try_cast("int"), F.lit(0))
    terms = F.regexp_extract_all(text, F.lit(LOCKUP), F.lit(1))
    return F.array_max(F.transform(terms, lambda x: F.least(part(x, "년") * 12 + part(x, "개월"), F.lit(36))))


def risk_marks(text: Column, mark: str = RISK_MARK) -> Column:
    """Numbered items of a text, 60 at most; none is NULL."""
    n = F.regexp_count(text, F.lit(mark))
    return F.nullif(F.when(n.isNotNull(), F.least(n, F.lit(60))), F.lit(0))


def offering_fields(text: Column) -> dict[str, Column]:
    date = F.concat_ws("-", *[F.regexp_extract(text, LISTING, g) for g in (1, 2, 3)])
    fields = {
        "price_band_low": whole(F.regexp_extract(text, BAND, 1)),
        "price_band_high": whole(F.regexp_extract(text, BAND, 2)),
        "offering_price": whole(F.regexp_extract(text, CONFIRMED, 1)),
        "new_shares": shares_after(text, NEW_SHARES),
        "secondary_shares": shares_after(text, SECONDARY_SHARES),
        "total_post_listing_shares": shares_after(text, TOTAL_SHARES),
        "lead_underwriter": F.trim(F.regexp_replace(found(text, UNDERWRITER), "(?U)\\s+", " ")),
        "listing_date": F.try_to_timestamp(date, F.lit("y-M-d")).cast("date"),
        "major_shareholder_lockup_months": lockup_months(text),
        "risk_factor_count": risk_marks(found(text, RISKS)),
    }
    return fields | {"parse_success": F.coalesce(*[c.cast("string") for c in fields.values()]).isNotNull()}


def with_offering_fields(df: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """Columns `keep` and `offering_fields`; parse_success reads the fields, so that no pattern is searched twice."""
    fields = offering_fields(text)
    own = [c for c in fields if c != "parse_success"]
    told = df.select(*keep, *[fields[c].alias(c) for c in own])
    return told.withColumn("parse_success", F.coalesce(*[F.col(c).cast("string") for c in own]).isNotNull())


def demand_numbers(text: Column, skip_count_column: bool = False) -> dict[str, Column]:
    """The numbers that a demand table gives: the ratio of demand, the shares of all, and those of each period."""
    labels = {"total": "합계"} | LOCKUP_LABELS
    return {"demand": number(F.regexp_extract(text, DEMAND, 1))} | {k: shares_after(text, v, skip_count_column=skip_count_column) for k, v in labels.items()}


def demand_of(numbers: dict[str, Column]) -> dict[str, Column]:
    total, demand = numbers["total"], numbers["demand"]
    share = lambda n: F.bround(clip(F.when(total != 0, F.try_divide(n, total)), 0.0, 1.0), 6)
    return {"institutional_demand_ratio": demand} | {k: share(numbers[k]) for k in LOCKUP_LABELS} | {"parse_success": demand.isNotNull() | F.coalesce(total != 0, F.lit(False))}


def demand_fields(text: Column, skip_count_column: bool = False) -> dict[str, Column]:
    return demand_of(demand_numbers(text, skip_count_column))


def with_demand_fields(df: DataFrame, text: Column, keep: list[str], skip_count_column: bool = False) -> DataFrame:
    """Columns `keep` and `demand_fields`, which read the numbers as columns, so that no pattern is searched twice."""
    numbers = demand_numbers(text, skip_count_column)
    read = df.select(*keep, *[c.alias(f"__{k}") for k, c in numbers.items()])
    return read.select(*keep, *[c.alias(k) for k, c in demand_of({k: F.col(f"__{k}") for k in numbers}).items()])


def underwriter_tier(name: Column, tier_1: tuple[str, ...] = TIER_1, tier_2: tuple[str, ...] = TIER_2) -> Column:
    squeezed = F.regexp_replace(name, "(?U)\\s+", "")
    any_of = lambda names: F.coalesce(*[F.when(F.contains(squeezed, F.lit(n)), True) for n in names], F.lit(False))
    return F.when(name.isNotNull(), F.when(any_of(tier_1), 1).when(any_of(tier_2), 2).otherwise(3))


def with_underwriter_tier(df: DataFrame, names: tuple[str, ...] = UNDERWRITER_COLUMNS, out: str = "underwriter_tier") -> DataFrame:
    """A given tier is kept as a number held between 1 and 3; else it is told by the first name column that is there."""
    given = clip(number(F.col(out)), 1.0, 3.0).cast("int") if out in df.columns else underwriter_tier(first_column(df, list(names)))
    return df.withColumn(out, given)


def with_risk_count(df: DataFrame, texts: tuple[str, ...] = RISK_TEXT_COLUMNS, out: str = "risk_factor_count") -> DataFrame:
    """A given count is kept as a number held between 0 and 60; else marks are counted in the first text column that is
    there, and none is NULL."""
    given = clip(number(F.col(out)), 0.0, 60.0).cast("int") if out in df.columns else risk_marks(first_column(df, list(texts))).cast("int")
    return df.withColumn(out, given)
