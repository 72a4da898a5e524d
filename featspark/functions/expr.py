"""Null-aware scalar expressions.

The reference relies on R semantics that differ from Spark's defaults; each
helper states the rule it implements:

* ``x / 0`` gives ``Inf``/``NaN`` in R; here it is NULL (``try_divide``).
* ``sqrt`` of a negative is ``NaN`` in R and Spark; here it is NULL so no
  ``NaN`` ever enters a feature table.
* ``sum``/``max``/``min`` without ``na.rm`` are null-contagious in R while
  Spark's ``greatest``/``least`` skip nulls; the ``contagious_*`` helpers
  restore the R rule.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """``num / den`` as double; NULL when ``den`` is 0 or either side NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def safe_sqrt(x) -> Column:
    """``sqrt(x)`` for ``x >= 0``, NULL otherwise (never NaN)."""
    x = _c(x)
    return F.when(x >= 0, F.sqrt(x))


def sentinel_to_null(x, sentinel) -> Column:
    """``NULL`` where ``x == sentinel`` (e.g. 365243 for 'not employed')."""
    return F.nullif(_c(x), F.lit(sentinel))


def null_count(cols) -> Column:
    """Number of NULL values among ``cols`` in each row (O-B16)."""
    cols = list(cols)
    if not cols:
        return F.lit(0)
    return reduce(lambda a, b: a + b, [_c(c).isNull().cast("int") for c in cols])


def contagious_sum(cols) -> Column:
    """Row sum that is NULL if any input is NULL (R ``sum`` without na.rm)."""
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [_c(c).isNull() for c in cols])


def contagious_max(cols) -> Column:
    return F.when(~_any_null(cols), F.greatest(*[_c(c) for c in cols]))


def contagious_min(cols) -> Column:
    return F.when(~_any_null(cols), F.least(*[_c(c) for c in cols]))


def row_mean_skipna(cols) -> Column:
    """Mean of the non-null values of ``cols`` in a row; NULL if none."""
    s = reduce(lambda a, b: a + b, [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [_c(c).isNotNull().cast("int") for c in cols])
    return F.try_divide(s, n.cast("double"))


def row_sd_skipna(cols) -> Column:
    """Sample standard deviation of the non-null values (NULL if < 2)."""
    m = row_mean_skipna(cols)
    n = reduce(lambda a, b: a + b, [_c(c).isNotNull().cast("int") for c in cols])
    ss = reduce(lambda a, b: a + b,
                [F.coalesce(F.pow(_c(c).cast("double") - m, 2), F.lit(0.0)) for c in cols])
    return F.when(n >= 2, F.sqrt(ss / (n - 1)))


def bucket(x, edges: list[tuple[str, float | None, float | None]], default: str) -> Column:
    """Label by half-open ranges ``lo <= x < hi`` checked in order.

    ``None`` for ``lo``/``hi`` means unbounded.  NULL input and anything not
    covered gets ``default`` (R ``case_when(..., TRUE ~ default)``).
    """
    x = _c(x)
    expr = None
    for label, lo, hi in edges:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= lo)
        if hi is not None:
            cond = cond & (x < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def replace_inf(x, replacement) -> Column:
    """Replace +/-Infinity (and NaN) by ``replacement`` (O-B22)."""
    x = _c(x)
    rep = replacement if isinstance(replacement, Column) else F.lit(replacement)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), rep).otherwise(x)


def all_pair_ratios(cols: list[str], name=lambda i, j: f"{i}_{j}") -> list[Column]:
    """Every ordered pair ``i / j`` (i != j) as a null-aware ratio (O-B14/B15)."""
    return [ratio(i, j).alias(name(i, j)) for i, j in permutations(cols, 2)]


TIE_NUDGE = 1e-13


def _d(v: float) -> str:
    """A Spark SQL double literal."""
    return f"{v:.1e}D"


def round_ladder(places: int, coarse: bool = False) -> list[tuple[float, int]]:
    """(magnitude bound, places) steps used by ``stable_round``.

    Fine: one place less for every 10x past ``10**(12 - places)``, so at least
    twelve digits stay and the unit is far above double noise (~1e-14
    relative); from 1e12 on values are left as they are.  Coarse: ``places``
    below 1e8, cents below 1e10, whole numbers below 1e16 (presentation).
    """
    if coarse:
        return [(1e8, places), (1e10, 2), (1e16, 0)]
    return [(10.0 ** (12 - p), p) for p in range(places, -1, -1)]


def stable_round_sql(x: str, places: int, coarse: bool = False) -> str:
    """Spark SQL text of ``stable_round`` for the SQL expression ``x``.

    Building wide projections from SQL text costs one JVM parse per column
    instead of dozens of Python API calls.
    """
    xd = f"CAST({x} AS DOUBLE)"
    y = f"({xd} + {xd} * {_d(TIE_NUDGE)})"
    parts = []
    for bound, p in round_ladder(places, coarse):
        f = _d(10.0 ** p)
        parts.append(f"WHEN abs({xd}) < {_d(bound)} THEN sign({y}) * floor(abs({y} * {f}) + 0.5D) / {f}")
    return f"(CASE {' '.join(parts)} ELSE {xd} END)"


def stable_round(x, places: int, coarse: bool = False) -> Column:
    """Rounding that gives the same digits every run and on every engine.

    * Exact decimal ties (a mean of cents ending in 5 at the rounding place)
      would round either way depending on last-bit summation noise, which
      changes with the partitioning.  A relative nudge of 1e-13 (hundreds of
      ulps, far below any decimal grid of the data) settles them.
    * The number of places drops with magnitude (``round_ladder``) so the
      unit always stays far above the noise of a double.
    * Plain arithmetic (half away from zero), written the same way in the
      SQL oracle.

    ``x`` is a column name or a Column.
    """
    if isinstance(x, str):
        return F.expr(stable_round_sql(f"`{x}`", places, coarse))
    x = x.cast("double")
    y = x + x * F.lit(TIE_NUDGE)
    a = F.abs(x)
    out = None
    for bound, p in round_ladder(places, coarse):
        f = F.lit(10.0 ** p)
        r = F.signum(y) * F.floor(F.abs(y * f) + F.lit(0.5)) / f
        out = F.when(a < F.lit(bound), r) if out is None else out.when(a < F.lit(bound), r)
    return out.otherwise(x)
