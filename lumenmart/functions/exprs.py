"""Scalar expressions shared by all builders. All of them stay inside codegen."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Member row that stands for "no such dimension row".
UNKNOWN_SK = -1


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(c: Column | str) -> Column:
    """First 60 bits of md5(text) as a non-negative bigint."""
    if isinstance(c, str):
        return F.expr(f"cast(conv(substring(md5(cast({c} as string)), 1, 15), 16, 10) as bigint)")
    return F.conv(F.substring(F.md5(c.cast("string")), 1, 15), 16, 10).cast("bigint")


def surrogate_key_of(text: str) -> int:
    """The same key for a text known on the driver (lookup arguments)."""
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def date_key(c: str) -> Column:
    """YYYYMMDD as int, for dates and both timestamp types."""
    return F.expr(f"year({c}) * 10000 + month({c}) * 100 + day({c})")


def key_to_date(c: str) -> Column:
    return F.expr(f"make_date({c} div 10000, cast({c} div 100 % 100 as int), {c} % 100)")


def month_key(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def json_field(payload: Column | str, *names: str) -> Column:
    """First non-null of the named top-level fields, as text."""
    return F.coalesce(*[F.get_json_object(_col(payload), f"$.{n}") for n in names])


def json_int(payload: Column | str, name: str) -> Column:
    return json_field(payload, name).try_cast("int")


def clean_name(c: Column | str) -> Column:
    """Trim and fold every whitespace run into one blank."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def ratio(num: Column | str, den: Column | str, scale: int = 4) -> Column:
    """Exact decimal num/den, rounded half up; null when den is 0 or null."""
    if isinstance(num, str) and isinstance(den, str):
        exact = f"cast({num} as decimal(20,0)) / nullif(cast({den} as decimal(20,0)), 0)"
        return F.expr(f"cast(round({exact}, {scale}) as double)")
    n = _col(num).cast("decimal(20,0)")
    d = _col(den).cast("decimal(20,0)")
    return F.round(n / F.nullif(d, F.lit(0).cast("decimal(20,0)")), scale).cast("double")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds, rounded half up from microseconds (end >= start)."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return F.floor((micros + 500000) / 1000000).cast("bigint")
