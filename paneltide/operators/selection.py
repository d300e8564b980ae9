"""Exact order statistics by narrowing brackets: counting passes, no sort.

A pass sketches the values (``percentile_approx``, merged from the map tasks)
and takes a narrow bracket around each wanted place; the next pass counts,
exactly, the rows below and inside each bracket. A place that its bracket
missed gets the rest of the bracket before back, so the sketch's error costs a
pass and never a wrong value; a bracket's ends leave it, so it always shrinks. Once the brackets hold at most ``HELD`` rows in
all, or one value each, their distinct values with counts (made in the map
tasks) are read and the places are looked up. A pass narrows a bracket by a
factor of some thousands: two passes for a million rows, three for a billion,
four beyond. No row is moved to another task and nothing is written.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD = 100_000       # rows within all brackets that are read back, at most
ACCURACY = 10_000    # of the sketch: places are off by at most 1 / ACCURACY of the rows


def _key(v) -> tuple:
    """Spark's order of numbers: NaN is the largest and equals itself."""
    nan = isinstance(v, float) and math.isnan(v)
    return (nan, 0 if nan else v)


@dataclass(frozen=True)
class Bracket:
    """The values between ``low`` and ``high`` (None: no bound), the bounds
    only if ``one`` says that both are the same value: ``inside`` rows of them,
    and ``below`` rows before them."""

    low: object
    high: object
    below: int
    inside: int
    one: bool = False

    def has(self, c: Column) -> Column:
        if self.one:
            return c == F.lit(self.low)
        out = F.lit(True) if self.low is None else c > F.lit(self.low)
        return out if self.high is None else out & (c < F.lit(self.high))

    def holds(self, v) -> bool:
        return (self.low is None or _key(v) > _key(self.low)) and (self.high is None or _key(v) < _key(self.high))


def _ends(place: int, within: Bracket) -> tuple[float, float]:
    """Shares of the bracket's rows a little before and after the place."""
    at, step = (place - within.below) / max(within.inside - 1, 1), 2.0 / ACCURACY
    return max(0.0, at - step), min(1.0, at + step)


def _narrowed(place: int, old: Bracket, low, high, under: int, at_low: int, between: int, at_high: int) -> Bracket:
    """Where the place is: before, at, between, at or after the two values."""
    upto = under
    if place < upto:  # the sketch missed
        return Bracket(old.low, low, old.below, under - old.below)
    upto += at_low
    if place < upto:
        return Bracket(low, low, under, at_low, True)
    if place < upto + between:
        return Bracket(low, high, upto, between)
    upto += between
    if place < upto + at_high:
        return Bracket(high, high, upto, at_high, True)
    upto += at_high
    return Bracket(high, old.high, upto, old.below + old.inside - upto)


def select(df: DataFrame, col: str, places_of, n: int | None = None) -> tuple[int, dict[int, object]]:
    """(rows with a value, place -> value) for the 0-based places, in rising
    order, that ``places_of(rows)`` asks for; ``n`` spares counting the rows
    with a value where that is known."""
    c = F.col(col)
    rows = df.select(c).where(c.isNotNull())
    n = rows.count() if n is None else n
    of = {p: Bracket(None, None, 0, n) for p in places_of(n) if 0 <= p < n}
    while sum(b.inside for b in {b for b in of.values() if not b.one}) > HELD:
        wide = sorted({b for b in of.values() if not b.one}, key=lambda b: b.below)
        ends = {b: sorted({e for p in of if of[p] == b for e in _ends(p, b)}) for b in wide}
        found = rows.agg(*[F.percentile_approx(F.when(b.has(c), c), ends[b], ACCURACY) for b in wide]).first()
        value = {(b, e): v for b, values in zip(wide, found) for e, v in zip(ends[b], values)}
        tried = {p: tuple(value[b, e] for e in _ends(p, b)) for p, b in of.items() if not b.one}
        counts = {}
        for p, (low, high) in tried.items():
            one = _key(low) == _key(high)
            parts = (c < F.lit(low), c == F.lit(low), (c > F.lit(low)) & (c < F.lit(high)), F.lit(False) if one else c == F.lit(high))
            counts[p] = [F.count_if(x) for x in parts]
        row = rows.agg(*[x for xs in counts.values() for x in xs]).first()
        for i, p in enumerate(counts):
            of[p] = _narrowed(p, of[p], *tried[p], *row[4 * i:4 * i + 4])
    out = {p: b.low for p, b in of.items() if b.one}
    rest = sorted({b for b in of.values() if not b.one}, key=lambda b: b.below)
    if rest:
        held = F.lit(False)
        for b in rest:
            held = held | b.has(c)
        values = sorted(((r[0], r[1]) for r in rows.where(held).groupBy(c).count().collect()), key=lambda r: _key(r[0]))
        for p, b in ((p, b) for p, b in of.items() if not b.one):
            at = b.below
            for v, count in values:
                at += count if b.holds(v) else 0
                if p < at:
                    out[p] = v
                    break
    return n, out


def quantiles(df: DataFrame, col: str, probs: list[float], n: int | None = None) -> list[float | None]:
    """Exact linearly interpolated quantiles of one column over the whole
    table (numpy 'linear' / SQL percentile_cont); None without a value. NULLs
    are ignored."""
    def around(n: int) -> list[int]:
        return [p for q in probs for p in (math.floor((n - 1) * q), math.ceil((n - 1) * q))] if n else []

    n, at = select(df, col, around, n)
    out = []
    for q in probs:
        if not n:
            out.append(None)
            continue
        h = (n - 1) * q
        low, high = float(at[math.floor(h)]), float(at[math.ceil(h)])
        out.append(low if low == high else low + (h - math.floor(h)) * (high - low))
    return out


def exact_quantiles(df: DataFrame, col: str, probs: list[float]) -> DataFrame:
    """``quantiles`` as rows (prob, value); no rows without a value."""
    rows = [(float(p), v) for p, v in zip(probs, quantiles(df, col, probs)) if v is not None]
    return df.sparkSession.createDataFrame(rows, "prob double, value double")
