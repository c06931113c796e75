"""Scalar maths with NumPy's IEEE conventions, as native column expressions.

Spark's own ``log1p`` returns NULL at and below -1, and NULL is silently
skipped by aggregates, so the series maths must produce NaN / -Inf instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's numeric conventions.
MAX_DOUBLE = 1.7976931348623157e308   # np.nan_to_num replacement for +Inf (negated for -Inf)
ZERO_GAP = 0.0001                     # added to a time difference that is exactly 0

def NAN() -> Column:
    return F.lit(float("nan"))


def POS_INF() -> Column:
    return F.lit(float("inf"))


def NEG_INF() -> Column:
    return F.lit(float("-inf"))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(fn, *cols) -> Column:
    """Evaluate each column once and hand ``fn`` lambda variables bound to them.

    ``transform(array(c), v -> fn(v))[0]``: without this, a function that
    uses its input several times (size, slice, ...) duplicates the input's
    whole expression tree, and nesting such functions grows the plan
    exponentially (higher-order functions get no common-subexpression
    elimination).
    """
    if len(cols) == 1:
        return F.transform(F.array(cols[0]), fn)[0]
    packed = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(cols)])
    return F.transform(F.array(packed), lambda s: fn(*[s[f"_{i}"] for i in range(len(cols))]))[0]


def np_log1p(c) -> Column:
    """log(1 + c) with -1 -> -Inf and c < -1 -> NaN (NaN/Inf pass through)."""
    c = _c(c)
    return (F.when(c < -1, NAN()).when(c == -1, NEG_INF())
            .otherwise(F.log1p(c)))


def nan_to_num(c) -> Column:
    """NaN -> 0, +Inf -> MAX_DOUBLE, -Inf -> -MAX_DOUBLE."""
    c = _c(c)
    return (F.when(F.isnan(c), F.lit(0.0))
            .when(c == POS_INF(), F.lit(MAX_DOUBLE))
            .when(c == NEG_INF(), F.lit(-MAX_DOUBLE))
            .otherwise(c))


def zero_gap(c) -> Column:
    """A difference that is exactly 0 becomes 0.0001 (time deltas only)."""
    c = _c(c)
    return F.when(c == 0, F.lit(ZERO_GAP)).otherwise(c)


def euclid2(dx, dy) -> Column:
    """sqrt(dx^2 + dy^2) with plain multiplication (bit-equal to NumPy)."""
    dx, dy = _c(dx), _c(dy)
    return F.sqrt(dx * dx + dy * dy)


# Comparison grid: (upper magnitude, scale). Scales are powers of two, so the
# scaling is exact, and a value whose binary denominator is small (decimals
# such as k/100 or k/3200, halves of integers) never sits exactly on a
# rounding boundary, where last-bit noise between engines would flip it.
SETTLE_GRID = [(1e6, 2.0 ** 20), (2.0 ** 42, 2.0 ** 10)]


def _half_away(c: Column, scale: float) -> Column:
    """Round |c| * scale half away from zero with plain IEEE steps (floor of x + 0.5),
    so that Spark and DuckDB produce bit-identical results."""
    a = F.floor(F.abs(c) * scale + 0.5).cast("double") / scale
    # 0.0 - a (not -a): a rounded-away negative tiny value becomes +0.0, not -0.0
    return F.when(c < 0, F.lit(0.0) - a).otherwise(a)


def settle(c) -> Column:
    """Round a double for cross-engine comparison (not used by the library).

    For inexact statistics only: last-bit differences between engines (summation
    order, ln(1+x) vs log1p) vanish after rounding to a grid of 2^-20 below 1e6 and
    2^-10 below 2^42; NaN, +-Inf and larger values (e.g. MAX_DOUBLE) are kept as they
    are, and -0.0 becomes 0.0. Exact values (coordinates, times, their differences,
    counts) are returned as they are.
    """
    c = _c(c).cast("double")
    a = F.abs(c)
    r = F.when(c.isNull() | F.isnan(c) | (a == POS_INF()) | (a >= SETTLE_GRID[-1][0]), c)
    for bound, scale in SETTLE_GRID:
        r = r.when(a < bound, _half_away(c, scale))
    return r


def settle_expr(name: str, bind: bool = False) -> Column:
    """:func:`settle` as one Spark SQL expression on column ``name``.

    Built from text (a single JVM call) with the same arithmetic steps.
    ``bind=True`` evaluates it through a lambda so that very wide outputs keep
    their generated code small.
    """
    v = "v" if bind else f"CAST(`{name}` AS DOUBLE)"

    def half(scale: float) -> str:
        a = f"(CAST(floor(abs({v}) * {scale!r}D + 0.5D) AS DOUBLE) / {scale!r}D)"
        return f"(CASE WHEN {v} < 0 THEN 0.0D - {a} ELSE {a} END)"
    body = (f"CASE WHEN {v} IS NULL OR isnan({v}) OR abs({v}) = CAST('Infinity' AS DOUBLE) "
            f"OR abs({v}) >= {SETTLE_GRID[-1][0]!r}D THEN {v} "
            + " ".join(f"WHEN abs({v}) < {b!r}D THEN {half(sc)}" for b, sc in SETTLE_GRID)
            + " END")
    if bind:
        body = f"transform(array(CAST(`{name}` AS DOUBLE)), v -> {body})[0]"
    return F.expr(body)
