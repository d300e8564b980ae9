"""Column expressions (P-operators). All are built-in Spark functions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x, precision: int = 18, scale_: int = 2) -> Column:
    """Money as an exact decimal, so sums do not depend on addition order."""
    return _c(x).cast(f"decimal({precision},{scale_})")


def money_sum(x, where: Column | None = None) -> Column:
    """Exact sum of a 2-decimal amount, returned as double.

    NULL when no row qualifies, like SQL SUM over nothing.
    """
    v = money(x)
    if where is not None:
        v = F.when(where, v)
    return F.sum(v).cast("double")


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise instead)."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def treated(time, event) -> Column:
    """P5: event time known and time >= event time; never NULL."""
    t, e = _c(time), _c(event)
    return F.when(e.isNotNull() & (t >= e), F.lit(True)).otherwise(F.lit(False))


def years_since(time, event) -> Column:
    """Time since the event, floored at 0; 0 when there is no event."""
    t, e = _c(time), _c(event)
    return F.when(e.isNotNull(), F.greatest(F.lit(0), t - e)).otherwise(F.lit(0))


def share(part, total) -> Column:
    """Part / total only when total > 0, else NULL."""
    return F.when(_c(total) > 0, _c(part) / _c(total))


def trend_label(pct, hi: float = 10, lo: float = -10) -> Column:
    """P8: 'high_growth' above hi, 'high_decline' below lo, else 'stable'
    (a NULL percentage is 'stable')."""
    p = _c(pct)
    return (
        F.when(p > hi, F.lit("high_growth"))
        .when(p < lo, F.lit("high_decline"))
        .otherwise(F.lit("stable"))
    )


def post_dummy(time, t0: int) -> Column:
    """Uniform treatment dummy, 1 from t0 on."""
    return (_c(time) >= F.lit(t0)).cast("int")


def to_ds(year) -> Column:
    """Year number -> first day of that year."""
    return F.make_date(_c(year), F.lit(1), F.lit(1))


def scale(x, factor: float) -> Column:
    """Unit change, e.g. kt -> Mt with factor 1e-3. A factor that is one
    over a whole number divides by it, which rounds once."""
    inverse = 1 / factor if factor else 0.0
    if 0 < factor < 1 and abs(inverse - round(inverse)) < 1e-9 * inverse:
        return _c(x) / F.lit(round(inverse))
    return _c(x) * F.lit(factor)


def fill_zero(x) -> Column:
    """NULL -> 0, as double."""
    return F.coalesce(_c(x).cast("double"), F.lit(0.0))


def parse_codes(text) -> Column:
    """P18: 'usa, chn,,ind ' -> ['USA', 'CHN', 'IND'] (trim, upper, drop blanks)."""
    s = F.lit(text) if isinstance(text, str) else text
    return F.filter(
        F.transform(F.split(s, ","), lambda v: F.upper(F.trim(v))),
        lambda v: v != F.lit(""),
    )


def direction_label(first, last, flat_band: float = 1.0) -> Column:
    """P16: 'flat' when |last - first| < band, else 'up' / 'down'."""
    d = _c(last) - _c(first)
    return (
        F.when(F.abs(d) < flat_band, F.lit("flat"))
        .when(d > 0, F.lit("up"))
        .otherwise(F.lit("down"))
    )


def verdict(ci_lower, ci_upper) -> Column:
    """Interval entirely below 0 / above 0 / crossing 0."""
    lo, hi = _c(ci_lower), _c(ci_upper)
    return (
        F.when(hi < 0, F.lit("reduces"))
        .when(lo > 0, F.lit("increases"))
        .otherwise(F.lit("inconclusive"))
    )
