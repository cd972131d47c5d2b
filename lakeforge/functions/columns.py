"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def canonical_symbol(c: Column | str) -> Column:
    """``CODE.EX`` of any spelling (case, blanks, exchange first, no dot); what has no code stays, trimmed and upper-case."""
    s = F.upper(F.regexp_replace(c, r"\s", ""))
    code, ex = F.regexp_extract(s, r"(\d{6})", 1), F.regexp_extract(s, r"(SH|SZ|BJ)", 1)
    return F.when((code != "") & (ex != ""), F.concat_ws(".", code, ex)).otherwise(s)


def version_number(c: Column | str) -> Column:
    """The number of a data_version such as ``v2``; null without one."""
    return F.try_to_number(F.nullif(F.regexp_extract(c, r"(\d{1,9})", 1), F.lit("")), F.lit("999999999")).cast("bigint")


def relative_gap_over(a: Column, b: Column, tolerance: float) -> Column:
    """Whether one side alone is null, or the values differ by more than ``tolerance`` of the larger absolute value."""
    a, b = a.cast("double"), b.cast("double")
    both = a.isNotNull() & b.isNotNull()
    return F.when(both, F.abs(a - b) > tolerance * F.greatest(F.abs(a), F.abs(b))).otherwise(a.isNull() != b.isNull())


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions, F.lit(False))


#: The exchange's time zone, and when a session's bars are settled.
ZONE, SETTLED = "Asia/Shanghai", "15:30:00"


def local_date(instant: Column | str, zone: str = ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))


def session_final(day: Column | str, now: Column | str, settled: str = SETTLED, zone: str = ZONE) -> Column:
    """Whether a session's rows were settled at an instant: any day but the local one, and that one from ``settled`` on."""
    day = F.col(day) if isinstance(day, str) else day
    local = F.from_utc_timestamp(now, zone)
    return (day != F.to_date(local)) | (F.date_format(local, "HH:mm:ss") >= settled)


def factor_of(value: Column | str, adjust_type: Column | str) -> Column:
    """A vendor's cumulative factor as a multiplier: qfq values are divisors; null for what is not positive and finite."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    kind = F.col(adjust_type) if isinstance(adjust_type, str) else adjust_type
    good = ~F.isnan(v) & (v > 0) & (v < float("inf"))
    return F.when(good, F.when(kind == "qfq", F.try_divide(F.lit(1.0), v)).otherwise(v))


def tone(probability: Column | str) -> Column:
    """A probability of good news as a score from -1 to 1."""
    return 2 * (F.col(probability) if isinstance(probability, str) else probability) - 1


#: Code prefixes of the two smaller groups of exchanges; other codes are SZ's.
SH_PREFIXES, BJ_PREFIXES = ("60", "68"), ("92", "43", "83", "87")


def symbol_of(code: Column | str) -> Column:
    """``CODE.EX`` of a bare code: six digits, zeros in front, and the exchange its prefix says."""
    c = F.lpad(F.trim(F.col(code).cast("string") if isinstance(code, str) else code.cast("string")), 6, "0")
    ex = F.when(F.substring(c, 1, 2).isin(*SH_PREFIXES), "SH").when(F.substring(c, 1, 2).isin(*BJ_PREFIXES), "BJ").otherwise("SZ")
    return F.concat_ws(".", c, ex)


def price_divisor(symbol: Column | str) -> Column:
    """What a wire's integer price is divided by: 100 for stocks, 1,000 for funds, 10,000 for bonds; null for what is unknown."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    head = F.substring(s, 1, 2)
    return F.when(head.isin("51", "52", "56", "58", "15", "16"), 1000).when(head.isin("10", "11", "12", "13"), 10_000).when(head.isin("60", "68", "00", "30", *BJ_PREFIXES), 100)
