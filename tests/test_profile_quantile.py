"""Profiling, exact quantiles and ordered running sums against numpy/pandas."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from featspark.operators import profile as PR
from featspark.operators.quantile import exact_modes, exact_quantiles
from featspark.operators.ranking import row_number_in_groups, running_sum
from featspark.operators.split import hash_folds, stratified_folds


def _skewed(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.normal(50, 10, n)
    a[: n // 3] = 42.0                      # one value holds a third of the rows
    b = rng.exponential(2.0, n)
    b[::11] = np.nan
    return pd.DataFrame({"k": np.arange(n), "a": a, "b": b, "g": rng.integers(0, 2, n)})


def test_exact_quantiles_match_pandas(spark):
    pdf = _skewed()
    df = spark.createDataFrame(pdf)
    got = {(r["variable"], r["p"]): r["value"]
           for r in exact_quantiles(df, ["a", "b"], [0.1, 0.25, 0.5, 0.9]).collect()}
    for c in ["a", "b"]:
        for p in [0.1, 0.25, 0.5, 0.9]:
            assert math.isclose(got[(c, p)], pdf[c].quantile(p), rel_tol=1e-12)
    modes = {r["variable"]: r["mode"] for r in exact_modes(df, ["a"]).collect()}
    assert modes["a"] == 42.0


def test_running_sum_and_row_numbers(spark):
    pdf = _skewed(2000)
    df = spark.createDataFrame(pdf)
    rs = running_sum(df, ["g"], ["a", "k"], "b", "cum", inclusive=True).toPandas()
    exp = pdf.sort_values(["g", "a", "k"]).assign(
        cum=lambda t: t.groupby("g")["b"].transform(lambda s: s.fillna(0).cumsum()))
    m = rs.merge(exp[["k", "cum"]], on="k", suffixes=("", "_e"))
    assert np.allclose(m["cum"], m["cum_e"])
    rn = row_number_in_groups(df, ["g"], ["a", "k"], "rn").toPandas()
    for _, grp in rn.groupby("g"):
        assert sorted(grp["rn"]) == list(range(1, len(grp) + 1))


def test_running_sum_of_many_groups_and_of_nothing(spark):
    # 400 groups, one with a third of all rows, one NULL
    pdf = pd.DataFrame({"k": range(6000)})
    pdf["g"] = [7 if i < 2000 else i % 400 for i in range(6000)]
    df = spark.createDataFrame(pdf).withColumn("g", F.expr("nullif(g, 11)"))
    got = row_number_in_groups(df, ["g"], ["k"]).toPandas()
    for _, grp in got.groupby("g", dropna=False):
        assert list(grp.sort_values("k")["rn"]) == list(range(1, len(grp) + 1))
    assert got["g"].isna().sum() == 10 and len(got) == 6000
    whole = row_number_in_groups(df, [], ["k"]).toPandas().sort_values("k")
    assert list(whole["rn"]) == list(range(1, 6001))
    assert row_number_in_groups(df.limit(0), ["g"], ["k"]).count() == 0


def test_folds_balanced(spark):
    pdf = _skewed(1000)
    df = spark.createDataFrame(pdf[["k", "g"]])
    f = stratified_folds(df, "k", "g", 5).toPandas()
    sizes = f.groupby(["g", "fold"]).size().unstack()
    assert (sizes.max(axis=1) - sizes.min(axis=1)).max() <= 1
    h = hash_folds(df, "k", 5).toPandas()
    assert set(h["fold"]) == {1, 2, 3, 4, 5}
    # stable under repartitioning
    h2 = hash_folds(df.repartition(7), "k", 5).toPandas().sort_values("k")
    assert list(h.sort_values("k")["fold"]) == list(h2["fold"])


def test_describe_skew_corr_hist(spark):
    pdf = _skewed(1500)
    df = spark.createDataFrame(pdf)
    d = {(r["variable"], r["statistic"]): r["value"] for r in PR.describe(df, ["b"]).collect()}
    ref = pdf["b"].describe()
    for st in PR.DESCRIBE_STATS:
        assert math.isclose(d[("b", st)], ref[st], rel_tol=1e-9)
    sk = {r["variable"]: r["skew"] for r in PR.skewness(df, ["a", "b"]).collect()}
    assert math.isclose(sk["b"], pdf["b"].skew(), rel_tol=1e-9)
    c = {(r["var1"], r["var2"]): r["corr"] for r in PR.corr_long(df, ["a", "b"]).collect()}
    assert math.isclose(c[("a", "b")], pdf[["a", "b"]].corr().loc["a", "b"], rel_tol=1e-9)
    assert c[("a", "b")] == c[("b", "a")]
    h = PR.histogram(df, "b", 20).orderBy("bin").toPandas()
    cnt, edges = np.histogram(pdf["b"].dropna(), bins=20)
    assert list(h["n"]) == list(cnt)
    assert np.allclose(h["lower"], edges[:-1])


def test_missing_and_drift(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1.0), (3, "x", 2.0)],
                              "id int, c string, v double")
    b = spark.createDataFrame([(4, "x", 1.0), (5, "z", 1.0)], "id int, c string, v double")
    assert PR.missing_columns(a) == ["v"]
    d = {r["category"]: (r["freq_a"], r["freq_b"]) for r in PR.category_drift(a, b, "c").collect()}
    assert d["y"] == (1 / 3, None) and d["z"] == (None, 0.5)
    assert math.isclose(d["x"][0], 2 / 3) and d["x"][1] == 0.5
