"""Encoders, imputation, AUC, models and explanation on small frames."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from featspark.operators import columns as C
from featspark.operators import encode as E
from featspark.operators import explain as XP
from featspark.operators import impute as I
from featspark.operators import metrics as M
from featspark.operators import model as ML
from featspark.operators import weights as WT
from featspark.operators.split import stratified_folds


def test_one_hot_and_label_codes(spark):
    tr = spark.createDataFrame([(1, "M"), (2, "F"), (3, None), (4, "XNA")],
                               "SK_ID_CURR long, CODE_GENDER string")
    te = spark.createDataFrame([(5, "M"), (6, "F")], "SK_ID_CURR long, CODE_GENDER string")
    vocab = E.fit_one_hot(tr, ["CODE_GENDER"], other=te)      # XNA seen in train only
    assert vocab == {"CODE_GENDER": ["F", "M"]}
    r = {x["SK_ID_CURR"]: x for x in E.one_hot(tr, vocab).collect()}
    assert (r[3]["CODE_GENDER_F"], r[3]["CODE_GENDER_M"]) == (0, 0)   # NULL -> zeros
    codes = E.fit_label_codes(tr, ["CODE_GENDER"])
    assert {r["value"]: r["code"] for r in codes.collect()} == {"F": 1, "M": 2, "XNA": 3}
    le = {x["SK_ID_CURR"]: x["CODE_GENDER"] for x in E.label_encode(tr, codes, ["CODE_GENDER"]).collect()}
    assert le == {1: 2, 2: 1, 3: None, 4: 3}


def test_impute_fit_on_train_apply_to_test(spark):
    tr = spark.createDataFrame([(1, 1.0, 1), (2, 3.0, 1), (3, None, 0), (4, 10.0, None)],
                               "SK_ID_CURR long, EXT_SOURCE_1 double, FLAG int")
    te = spark.createDataFrame([(5, None, None)], "SK_ID_CURR long, EXT_SOURCE_1 double, FLAG int")
    for st, e1, fl in [("mean", 14 / 3, 2 / 3), ("median", 3.0, 1.0), ("mode", 1.0, 1)]:
        r = I.impute(te, tr, ["EXT_SOURCE_1", "FLAG"], st, f".tr{st}", keep=["SK_ID_CURR"]).first()
        assert math.isclose(r[f"EXT_SOURCE_1.tr{st}"], e1)
        assert math.isclose(r[f"FLAG.tr{st}"], fl)


def test_column_agreement(spark):
    df = spark.createDataFrame([(1,) * 6], "a int, `a.trmedian` int, `a.trmean` int, b int, `c.trmode` int, c int")
    kept = C.keep_statistic(df, {"a": ["mean", "median"], "c": ["mode"]}, "median")
    assert kept.columns == ["a.trmedian", "b", "c"]
    assert C.column_differences(["x", "y", "TARGET"], ["y", "x", "z"]) == (["TARGET"], ["z"])


def test_fold_auc_table_without_and_with_model_column(spark):
    data = [(i, i % 3 + 1, float(i % 2), ((i * 7) % 10) / 10) for i in range(30)] + [(99, None, 1.0, 0.0)]
    df = spark.createDataFrame(data, "i int, fold int, y double, s double")
    one = {r["Fold_Name"]: r for r in M.fold_auc_table(df, "y", "s", None, k=3).collect()}
    assert set(one) == {"fold_1", "fold_2", "fold_3", "fold_AVG"}
    for f in (1, 2, 3):
        for col, part in (("Validation_AUC", [r for r in data if r[1] == f]),
                          ("Train_AUC", [r for r in data if r[1] not in (f, None)])):
            pos, neg = [r[3] for r in part if r[2]], [r[3] for r in part if not r[2]]
            exp = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
            assert abs(one[f"fold_{f}"][col] - exp) < 1e-12
    mean = sum(one[f"fold_{f}"]["Train_AUC"] for f in (1, 2, 3)) / 3
    assert abs(one["fold_AVG"]["Train_AUC"] - mean) < 1e-12
    scored = df.crossJoin(spark.range(1, 4).select(F.col("id").cast("int").alias("m")))
    many = {r["Fold_Name"]: r for r in M.fold_auc_table(scored, "y", "s", None, k=3, model_col="m").collect()}
    assert {k: tuple(r) for k, r in many.items()} == {k: tuple(r) for k, r in one.items()}


def test_weighted_auc_matches_pair_count(spark):
    rng = np.random.default_rng(5)
    n = 400
    pdf = pd.DataFrame({"y": rng.integers(0, 2, n), "s": rng.integers(0, 30, n).astype(float),
                        "w": rng.uniform(0.5, 2.0, n), "f": rng.integers(1, 3, n)})
    got = {r["f"]: r["auc"] for r in M.weighted_auc(spark.createDataFrame(pdf), "y", "s", "w",
                                                     ["f"]).collect()}
    for f, g in pdf.groupby("f"):
        pos, neg = g[g.y == 1], g[g.y == 0]
        num = sum(wp * wn * (1.0 if sp > sn else 0.5 if sp == sn else 0.0)
                  for sp, wp in zip(pos.s, pos.w) for sn, wn in zip(neg.s, neg.w))
        assert math.isclose(got[f], num / (pos.w.sum() * neg.w.sum()), rel_tol=1e-9)


def _toy(spark, n=300):
    rng = np.random.default_rng(11)
    x1 = rng.normal(size=n)
    x2 = rng.normal(size=n)
    x2[::9] = np.nan
    y = (x1 + 0.5 * np.nan_to_num(x2) + rng.normal(scale=0.5, size=n) > 0).astype(int)
    pdf = pd.DataFrame({"SK_ID_CURR": np.arange(n), "x1": x1, "x2": x2, "TARGET": y,
                        "Weights": rng.uniform(0.5, 1.5, n), "is_test": (np.arange(n) % 4 == 0)})
    return spark.createDataFrame(pdf).withColumn("x2", F.nanvl("x2", F.lit(None)))


def test_cross_validation_and_explain(spark):
    df = _toy(spark)
    tr = stratified_folds(df.filter(~F.col("is_test")), "SK_ID_CURR", "TARGET", 3)
    table, models = ML.cross_validate(tr, "SK_ID_CURR", ["x1", "x2"], "TARGET", "Weights",
                                      "fold", 3, {"maxIter": 5, "maxDepth": 2})
    t = {r["Fold_Name"]: r for r in table.collect()}
    assert set(t) == {"fold_1", "fold_2", "fold_3", "fold_AVG"}
    assert all(0.5 < r["Validation_AUC"] <= 1.0 for r in t.values())
    prep = ML.fit_features(tr, ["x1", "x2"])
    assert prep.indicators == ["x2"]
    imp = XP.importance_table(spark, models[0], prep.vector_cols)
    assert imp.filter("feature = 'x1'").first()["splits"] > 0
    pdp = XP.partial_dependence(models[0], prep, tr, ["x1"], 20).toPandas()
    assert len(pdp) == 20 and pdp["prediction"].between(0, 1).all()
    assert math.isclose(pdp["value"].max(), tr.agg(F.max("x1")).first()[0])


def test_shift_weights(spark):
    df = _toy(spark)
    tr, te = df.filter(~F.col("is_test")), df.filter(F.col("is_test"))
    w = WT.shift_weights(tr, te, "SK_ID_CURR", ["x1", "x2"], n_iter=2, fraction=0.5,
                         params={"maxIter": 3, "maxDepth": 2})
    assert w.count() == tr.count()
    assert w.filter("Weights IS NULL OR Weights <= 0").count() == 0


def test_loss_per_round_and_save_load(spark):
    from featspark.session import shared_dir
    df = _toy(spark)
    prep = ML.fit_features(df, ["x1", "x2"])
    x = prep.transform(df).select("TARGET", "Weights", "features")
    m = ML.fit_gbt(x, "TARGET", "Weights", {"maxIter": 4, "maxDepth": 2})
    loss = ML.loss_per_round(m, x)
    assert len(loss) == 4 and loss[-1] <= loss[0]
    path = shared_dir(spark, "model-test")
    ML.save_model(m, path)
    p1 = ML.predict_proba(m, x).collect()
    p2 = ML.predict_proba(ML.load_model(path), x).collect()
    assert [r[0] for r in p1] == [r[0] for r in p2]


def test_per_fold_feature_prep_matches_separate_fits(spark):
    df = _toy(spark)
    tr = stratified_folds(df, "SK_ID_CURR", "TARGET", 3)
    preps = ML.fit_features_per_fold(tr, ["x1", "x2"], "fold", 3)
    for f in (1, 2, 3):
        one = ML.fit_features(tr.filter(F.col("fold") != f), ["x1", "x2"])
        assert preps[f].indicators == one.indicators
        for c in ["x1", "x2"]:
            assert math.isclose(preps[f].fill[c], one.fill[c], rel_tol=1e-12)


def test_resamples_differ_and_overlap_by_chance(spark):
    from featspark.operators import split as S
    keys = spark.range(1, 20_001).withColumnRenamed("id", "k")
    r = S.repeated_subsamples(keys, "k", 0.3, 15).groupBy("iteration").agg(F.collect_set("k").alias("ks")).collect()
    sets = [set(x["ks"]) for x in r]
    assert len(sets) == 15 and all(abs(len(s) / 20_000 - 0.3) < 0.02 for s in sets)
    for i in range(15):
        for j in range(i):
            assert abs(len(sets[i] & sets[j]) / 20_000 - 0.09) < 0.02
    hold = {x["k"] for x in S.holdout_split(keys, "k", 0.33, 42)[1].collect()}
    assert abs(len(sets[0] & hold) / 20_000 - 0.099) < 0.02
    a, b = ({x["k"]: x["fold"] for x in S.hash_folds(keys, "k", 5, seed).collect()} for seed in (1234, 99))
    assert sum(a[k] == b[k] for k in a) / 20_000 < 0.25


def test_label_codes_of_many_categories(spark):
    df = spark.range(6001).select(F.format_string("v%05d", "id").alias("c"))
    got = E.label_encode(df.withColumn("was", F.col("c")), E.fit_label_codes(df, ["c"]), ["c"])
    assert got.filter(F.col("c") != F.substring("was", 2, 5).cast("int") + 1).count() == 0
    assert got.agg(F.max("c")).first()[0] == 6001
