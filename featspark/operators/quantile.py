"""Exact global quantiles and modes without a one-task buffer.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer: fine per client, not for a column of a 100 TB table.
Here values are first counted per distinct value (a distributed ``groupBy``
that collapses duplicates map-side), cumulative counts come from range
offsets (``ranking.running_sum``), and only the few rows whose cumulative
interval covers a target rank are kept.  Result: exact
linear-interpolated quantiles (pandas / numpy / DuckDB ``quantile_cont``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.operators.ranking import running_sum


def _long_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value"))
                    for c in cols])
    lf = df.select(F.explode(arr).alias("kv")).select("kv.*")
    lf = lf.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return lf.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("cnt"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """(variable, p, value) for each column and probability; NULLs skipped."""
    return _quantiles_from_counts(_long_counts(df, cols), probs)


def exact_quantiles_long(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``exact_quantiles`` of a long frame (variable, x): one result per variable."""
    lf = long.select("variable", F.col("x").cast("double").alias("value"))
    lf = lf.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return _quantiles_from_counts(
        lf.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("cnt")), probs)


def _quantiles_from_counts(cnt: DataFrame, probs: Sequence[float]) -> DataFrame:
    cum = running_sum(cnt, ["variable"], ["value"], "cnt", "_before")
    totals = cnt.groupBy("variable").agg(F.sum("cnt").alias("_n"))
    # target ranks (0-based) of the two order statistics around (n-1)p
    parr = F.array(*[F.lit(float(p)) for p in probs])
    tgt = (totals.select("variable", "_n", F.explode(parr).alias("p"))
                 .withColumn("_h", (F.col("_n") - 1) * F.col("p"))
                 .withColumn("_lo", F.floor("_h"))
                 .withColumn("_hi", F.ceil("_h")))
    ranks = (tgt.select("variable", "p", "_h", "_lo", F.col("_lo").alias("_k"))
                .unionByName(tgt.select("variable", "p", "_h", "_lo", F.col("_hi").alias("_k"))))
    # the target table has 2 rows per (column, p): broadcast it so the
    # cumulative counts are matched where they are, without a shuffle
    r = F.broadcast(ranks.withColumnRenamed("variable", "_var"))
    hit = cum.join(r, (F.col("variable") == F.col("_var")) & (F.col("_before") <= F.col("_k"))
                   & (F.col("_k") < F.col("_before") + F.col("cnt")), "inner"
                   ).select("variable", "p", "_h", "_lo", "_k", "value")
    g = hit.groupBy("variable", "p", "_h", "_lo").agg(
        F.min_by("value", "_k").alias("_vlo"), F.max_by("value", "_k").alias("_vhi"))
    val = F.col("_vlo") + (F.col("_h") - F.col("_lo")) * (F.col("_vhi") - F.col("_vlo"))
    return g.select("variable", "p", val.alias("value"))


def exact_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    """Median per column (one small result row per column to the driver)."""
    rows = exact_quantiles(df, cols, [0.5]).collect()
    got = {r["variable"]: r["value"] for r in rows}
    return {c: got.get(c) for c in cols}


def exact_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, mode): most frequent non-null value, ties to the smallest.

    Counted per distinct value, then ``min_by`` over (-count, value): both
    steps aggregate partially before their shuffle.
    """
    cnt = _long_counts(df, cols)
    order = F.struct((-F.col("cnt")).alias("a"), F.col("value").alias("b"))
    return cnt.groupBy("variable").agg(F.min_by("value", order).alias("mode"))
