"""Profiling and drift (O-B19, O-D17..D26, O-C9, O-C10).

Results are long-form DataFrames (variable, statistic, ...), computed by a
single aggregate over all requested columns where possible.  Only one-row
fitted values (min/max for histogram edges) reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featspark.operators.quantile import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def _stack(agg_row: DataFrame, items: list[tuple[str, str, str]], value_type: str = "double",
           ) -> DataFrame:
    """Turn a one-row aggregate into (variable, statistic, value) rows."""
    arr = F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(s).alias("statistic"),
                             F.col(c).cast(value_type).alias("value")) for v, s, c in items])
    return agg_row.select(F.explode(arr).alias("r")).select("r.*")


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(variable, n_missing) for every column with at least one NULL (O-B19)."""
    cols = list(cols or df.columns)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    st = _stack(row, [(c, "n_missing", f"_m{i}") for i, c in enumerate(cols)], "bigint")
    return st.filter(F.col("value") > 0).select("variable", F.col("value").alias("n_missing"))


def missing_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Names of columns holding NULLs (one aggregate, one row to the driver)."""
    return [r["variable"] for r in missing_counts(df, cols).collect()]


def value_frequencies(df: DataFrame, col: str, name: str = "freq") -> DataFrame:
    """(value, n, freq) with freq = n / non-null rows; NULL excluded (O-D18)."""
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # the total is one number: summed from the (small) grouped counts
    tot = g.agg(F.sum("n")).first()[0] or 0
    return g.select(F.col(col), "n", F.try_divide(F.col("n"), F.lit(float(tot))).alias(name))


def category_drift(a: DataFrame, b: DataFrame, col: str,
                   names: tuple[str, str] = ("freq_a", "freq_b")) -> DataFrame:
    """Relative frequencies of ``col`` in two frames, full outer join (O-D19)."""
    fa = value_frequencies(a, col, names[0]).select(F.col(col).alias("category"), names[0])
    fb = value_frequencies(b, col, names[1]).select(F.col(col).alias("category"), names[1])
    return fa.join(fb, "category", "full")


DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """pandas ``describe()`` in long form: (variable, statistic, value) (O-D20).

    Moments come from one aggregate; quartiles are exact linear-interpolated
    percentiles from the distributed ``exact_quantiles`` (or a fixed-size
    sketch with ``approx``).
    """
    aggs, items = [], []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"_n{i}"), F.avg(v).alias(f"_a{i}"),
                 F.stddev_samp(v).alias(f"_s{i}"), F.min(v).alias(f"_lo{i}"),
                 F.max(v).alias(f"_hi{i}")]
        items += [(c, "count", f"_n{i}"), (c, "mean", f"_a{i}"), (c, "std", f"_s{i}"),
                  (c, "min", f"_lo{i}"), (c, "max", f"_hi{i}")]
        if approx:
            aggs.append(F.percentile_approx(v, [0.25, 0.5, 0.75], 10000).alias(f"_q{i}"))
            items += [(c, "25%", f"_q{i}[0]"), (c, "50%", f"_q{i}[1]"), (c, "75%", f"_q{i}[2]")]
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(v).alias("variable"), F.lit(s).alias("statistic"),
                             F.expr(e).cast("double").alias("value")) for v, s, e in items])
    moments = row.select(F.explode(arr).alias("r")).select("r.*")
    if approx:
        return moments
    names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    qs = exact_quantiles(df, list(cols), list(names))
    lab = F.when(F.col("p") == 0.25, "25%").when(F.col("p") == 0.5, "50%").otherwise("75%")
    return moments.unionByName(qs.select("variable", lab.alias("statistic"), "value"))


def describe_compare(a: DataFrame, b: DataFrame, cols: Sequence[str],
                     names: tuple[str, str] = ("value_a", "value_b")) -> DataFrame:
    """Two summaries side by side, inner-joined on (variable, statistic) (O-D21, O-C9)."""
    da = describe(a, cols).withColumnRenamed("value", names[0])
    db = describe(b, cols).withColumnRenamed("value", names[1])
    return da.join(db, ["variable", "statistic"], "inner")


def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness (pandas ``skew``) per column (O-D22)."""
    aggs, items = [], []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        n = F.count(v).cast("double")
        g1 = F.skewness(v)
        aggs.append(F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias(f"_k{i}"))
        items.append((c, "skew", f"_k{i}"))
    st = _stack(df.agg(*aggs), items)
    return st.select("variable", F.col("value").alias("skew"))


def corr_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations (var1, var2, corr) (O-D23)."""
    cols = list(cols)
    aggs, items = [], []
    for i, a in enumerate(cols):
        for j in range(i, len(cols)):
            b = cols[j]
            aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}_{j}"))
            items.append((a, b, f"_c{i}_{j}"))
            if i != j:
                items.append((b, a, f"_c{i}_{j}"))
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"),
                             F.col(c).alias("corr")) for a, b, c in items])
    return row.select(F.explode(arr).alias("r")).select("r.*")


def histogram(df: DataFrame, col: str, bins: int = 10, where=None,
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram like ``numpy.histogram`` (O-D24).

    Edges from min/max (one row to the driver); the top edge is closed;
    empty bins are present with count 0.
    """
    src = df.filter(where) if where is not None else df
    v = F.col(col).cast("double")
    src = src.select(v.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    if lo is None or hi is None:
        r = src.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    spark = df.sparkSession
    if lo is None:  # no values at all
        return spark.range(bins).select(F.col("id").cast("int").alias("bin"),
                                        F.lit(None).cast("double").alias("lower"),
                                        F.lit(None).cast("double").alias("upper"),
                                        F.lit(0).cast("bigint").alias("n"))
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo)
    b = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width) * F.lit(bins)),
                F.lit(bins - 1)).cast("int")
    counts = (src.filter((F.col("x") >= lo) & (F.col("x") <= hi))
                 .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    edges = spark.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(lo) + F.col("id") * F.lit(width) / F.lit(bins)).alias("lower"),
        (F.lit(lo) + (F.col("id") + 1) * F.lit(width) / F.lit(bins)).alias("upper"))
    return (edges.join(counts, "bin", "left")
                 .select("bin", "lower", "upper", F.coalesce("n", F.lit(0)).alias("n")))


def column_center_and_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, median, low, high) ignoring NULL and non-finite values (O-D26).

    Median exact and distributed; low/high from one aggregate.
    """
    cols = list(cols)
    fin = df.select(*[F.when(~F.isnan(F.col(c).cast("double"))
                             & (F.abs(F.col(c).cast("double")) != float("inf")),
                             F.col(c).cast("double")).alias(c) for c in cols])
    aggs, items = [], []
    for i, c in enumerate(cols):
        aggs += [F.min(c).alias(f"_l{i}"), F.max(c).alias(f"_h{i}")]
        items.append((c, f"_l{i}", f"_h{i}"))
    row = fin.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(lo).alias("low"),
                             F.col(hi).alias("high")) for c, lo, hi in items])
    rng = row.select(F.explode(arr).alias("r")).select("r.*")
    med = exact_quantiles(fin, cols, [0.5]).select("variable", F.col("value").alias("median"))
    return rng.join(med, "variable", "left").select("variable", "median", "low", "high")
