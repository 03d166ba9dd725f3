"""Shared column expressions: SLA rules, guarded ratios, rounding, buckets and
text formatting. All built-in functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "days_between", "guarded_pct", "r2", "installment_bucket", "clip",
    "fmt_fixed", "count_true", "NOISE_DECIMALS", "on_time_counts", "is_valid_delivery",
]

SECONDS_PER_DAY = 86400


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Fractional days from exact whole seconds; NULL if either side is NULL."""
    return F.timestamp_diff("SECOND", _c(earlier), _c(later)).cast("double") / SECONDS_PER_DAY


def guarded_pct(num: Column, den: Column, decimals: int | None = 2) -> Column:
    """round(100 * num / NULLIF(den, 0), decimals); NULL on a zero denominator."""
    v = F.try_divide(F.lit(100.0) * num, den)
    return r2(v, decimals) if decimals is not None else v


NOISE_DECIMALS = 12


def r2(c: Column | str, decimals: int = 2) -> Column:
    """HALF_UP rounding of a double to ``decimals`` places.

    The value is first snapped to 12 decimals, so binary floating-point noise
    (a mean that is exactly -3.825 computed as -3.8249999999999997, depending on
    summation order) never decides a tie: the result is the HALF_UP rounding of
    the decimal value, the same on every engine and every partitioning."""
    return F.round(F.round(_c(c), NOISE_DECIMALS), decimals)


def count_true(cond: Column) -> Column:
    """COUNT of rows where cond is TRUE (NULL counts as not true)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def on_time_counts(flag: Column | str = "on_time_flag"):
    """(on-time count, orders with an SLA outcome) for an on_time_flag column."""
    f = _c(flag)
    return count_true(f == 1), F.count(f)


def is_valid_delivery(delivered: Column | str, anomaly: Column | str) -> Column:
    return _c(delivered).isNotNull() & ~_c(anomaly)


def installment_bucket(inst: Column | str) -> Column:
    """1 / 2-3 / 4-6 / 7+; a NULL installment count falls through to '7+'."""
    i = _c(inst)
    return (F.when(i <= 1, "1").when(i <= 3, "2-3").when(i <= 6, "4-6").otherwise("7+"))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL."""
    x = _c(c)
    return F.when(x.isNull(), x).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def fmt_fixed(c: Column | str, decimals: int) -> Column:
    """Fixed-point text with HALF_UP rounding, e.g. 2.25 -> '2.3' for 1 decimal.

    Rounding first makes the formatter's own rounding irrelevant, so the same
    text is produced wherever the number is formatted (narrative and validator)."""
    return F.format_string(f"%.{decimals}f", r2(c, decimals))


def _c(c):
    return F.col(c) if isinstance(c, str) else c
