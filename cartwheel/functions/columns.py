"""Scalar column expressions (all built-in, JVM-side, codegen-friendly)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwheel.schemas import AMOUNT, MONEY

# Fixed value: purchase-time text format (UTC).
PURCHASE_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def money(c: Column | str) -> Column:
    """decimal(12,2): rounds HALF_UP, null on overflow (table coercion)."""
    return F.col(c).try_cast(MONEY) if isinstance(c, str) else c.try_cast(MONEY)


def event_value(price: str = "price", freight: str = "freight_value") -> Column:
    """Order value: price + freight, a missing part counts as 0."""
    zero = F.lit(Decimal("0")).cast(AMOUNT)
    return F.coalesce(F.col(price), zero) + F.coalesce(F.col(freight), zero)


def parse_purchase_ts(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text (UTC session) -> timestamp; null when empty or unparsable."""
    return F.try_to_timestamp(F.nullif(F.trim(c), F.lit("")), F.lit(PURCHASE_TS_FORMAT))


def parse_amount(c: Column) -> Column:
    """Trimmed decimal text with all its digits; a bad or missing amount becomes 0 (not null)."""
    return F.coalesce(F.trim(c).try_cast(AMOUNT), F.lit(Decimal("0")).cast(AMOUNT))


def amount_text(c: Column) -> Column:
    """An amount as plain text: two digits after the point, more only where they are not zero."""
    return F.regexp_replace(c.cast("string"), "(\\.\\d{2}\\d*?)0+$", "$1")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def half_up_average(total: Column, count: Column, scale: int = 2) -> Column:
    """total / count rounded HALF_UP at ``scale``, null for a count of 0.

    A decimal quotient is itself rounded to some scale, so rounding it would round twice. Here the result
    counts whole steps of ``scale``: (2 * |total| + count) div (2 * count) in units of the inputs, with the
    remainder taken off first, so the division is exact."""
    step = 10 ** (6 - scale)     # AMOUNT has six digits after the point
    units = (total * F.lit(Decimal(1_000_000))).cast("decimal(38,0)")
    per = count.cast("decimal(19,0)") * F.lit(Decimal(step))
    doubled = F.abs(units) * F.lit(Decimal(2)) + per
    whole = ((doubled - doubled % (per * F.lit(Decimal(2)))) / (per * F.lit(Decimal(2)))).cast("decimal(30,0)")
    return F.when(count > 0, (F.signum(units).cast("decimal(1,0)") * whole / F.lit(Decimal(10 ** scale))).cast(f"decimal(38,{scale})"))


def epoch_seconds(ts: Column) -> Column:
    """Instant as decimal epoch seconds with nanosecond digits, e.g. 1704067200.000000000."""
    return (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(20,9)")


def span_microseconds(span: str) -> int:
    """'5 minutes' / '1 day' / '30 seconds' -> microseconds (plain Python, parsed once on the driver)."""
    units = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
             "hour": 3_600_000_000, "day": 86_400_000_000}
    parts = span.strip().split()
    if len(parts) != 2:
        raise ValueError(f"span must be '<n> <unit>': {span!r}")
    n, unit = int(parts[0]), parts[1].lower().rstrip("s")
    if unit not in units:
        raise ValueError(f"unknown unit in span {span!r}")
    return n * units[unit]


def span_text(span: str) -> str:
    """Span as used in alert descriptions: whole minutes ('5 minutes', '1440 minutes')."""
    us = span_microseconds(span)
    if us % 60_000_000 == 0:
        m = us // 60_000_000
        return f"{m} minute" if m == 1 else f"{m} minutes"
    s = us / 1_000_000
    return f"{s:g} seconds"
