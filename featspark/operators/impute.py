"""Imputation (O-D9, O-K1).

Fit: one value per column (mean, median or mode).  Means are one aggregate;
medians and modes are exact and distributed (``quantile``), never one buffer of
a whole column.  The fitted values are one per column.  Apply:
``coalesce(col, value)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featspark.operators.quantile import exact_medians, exact_modes

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def fit_impute(source: DataFrame, cols: Sequence[str],
               stat: str | Callable[[Column], Column] = "mean") -> dict[str, object]:
    """One fitted value per column (NULLs skipped)."""
    cols = list(cols)
    if stat == "median":
        return exact_medians(source, cols)
    if stat == "mode":
        return _modes(source, cols)
    fn = stat if callable(stat) else F.avg
    row = source.agg(*[fn(F.col(c)).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def _modes(source: DataFrame, cols: list[str]) -> dict[str, object]:
    """Most frequent value per column, ties to the smallest; of the column's type."""
    kinds = {c: source.schema[c].dataType for c in cols}
    text = [c for c in cols if isinstance(kinds[c], T.StringType)]
    out = {c: None for c in cols}
    numbers = [c for c in cols if c not in text]
    if numbers:
        for r in exact_modes(source, numbers).collect():
            v = r["mode"]
            out[r["variable"]] = int(v) if isinstance(kinds[r["variable"]], _INTEGRAL) else v
    for c in text:
        counts = source.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
        best = counts.orderBy(F.desc("_n"), c).limit(1).first()
        out[c] = best[c] if best else None
    return out


def apply_impute(target: DataFrame, values: dict[str, object], suffix: str | None = None,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Fill NULLs of ``target`` with fitted values.

    With ``suffix`` the result holds ``keep`` columns plus imputed copies
    ``<col><suffix>`` (the reference's suffix frames, e.g. ``.trmean``);
    without it the columns are filled in place.
    """
    fill = {c: _filled(target, c, v) for c, v in values.items()}
    if suffix is None:
        return target.withColumns(fill)
    return target.select(*keep, *[e.alias(f"{c}{suffix}") for c, e in fill.items()])


def _filled(target: DataFrame, c: str, v: object) -> Column:
    if v is None:
        return F.col(c)
    t = target.schema[c].dataType
    if isinstance(v, float) and isinstance(t, _INTEGRAL):
        return F.coalesce(F.col(c).cast("double"), F.lit(v))
    return F.coalesce(F.col(c), F.lit(v).cast(t))


def impute_variants(target: DataFrame, source: DataFrame, cols: Sequence[str],
                    stats: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Imputed copies for several statistics (statistic -> suffix) in one projection."""
    fitted = {st: fit_impute(source, cols, st) for st in stats}
    return target.select(*keep, *[_filled(target, c, fitted[st][c]).alias(f"{c}{suffix}")
                                  for st, suffix in stats.items() for c in cols])


def impute(target: DataFrame, source: DataFrame, cols: Sequence[str], stat="mean",
           suffix: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``imputationFunction``: fit ``stat`` on ``source``, fill ``target``."""
    return apply_impute(target, fit_impute(source, cols, stat), suffix, keep)
