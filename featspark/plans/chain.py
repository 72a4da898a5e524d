"""Rank, select, validate, refit and score on the engineered table (§3.1 to §3.3).

One registered query runs the whole chain that the reference spreads over its
scripts: the assembled train and test sets, imputed copies and the choice among
them, a ranking fit on a hold-out split, the top features as a manifest, cross-validation
with a loss for every round in the metric log, a final fit with the round found
there, save and reload, and the scored test set.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featspark.functions.expr import replace_inf
from featspark.operators import columns as C
from featspark.operators import explain as XP
from featspark.operators import impute as I
from featspark.operators import joins as J
from featspark.operators import metrics as M
from featspark.operators import model as ML
from featspark.operators import split as S
from featspark.operators.packed import Packed
from featspark.plans import features as FT
from featspark.plans.common import finalize
from featspark.session import in_tasks, materialize, shared_dir, written

KEY = FT.KEY
SCORES = ["score_1", "score_2", "score_3"]
STATS = ["mean", "median", "mode"]
#: Rows of all features and their indicators (20 KB) that one task of the ranking holds.
VECTORS_A_TASK = 10_000
ROUNDS = {"maxIter": 6, "maxDepth": 3}


def engineered(spark: SparkSession, d: str) -> Packed:
    """Train and test rows with the whole feature table: scores imputed by three
    statistics of the train rows, the median copies kept (O-B3, O-D9); no infinite
    values (O-B22).  The written sets with a projection, wide numbers in arrays."""
    a = FT.assembled(spark, d)
    filled = I.impute_variants(a.df, a.df.filter("is_test = 0"), SCORES, {s: f"_tr{s}" for s in STATS}, keep=a.df.columns)
    kept = C.keep_statistic(filled, dict.fromkeys(SCORES, STATS), "median", suffix="_tr{}")
    numbers = [f.name for f in kept.schema.fields if f.dataType.simpleString() in ("double", "float")]
    kept = kept.withColumns({c: replace_inf(c, F.lit(None).cast("double")) for c in numbers})
    copies = [c for c in kept.columns if c not in a.df.columns]
    return replace(a, df=kept, columns=[*(c for c in a.columns if c not in SCORES), *copies], finite=True)


def ranked(train: Packed, features: list[str], top: int) -> list[str]:
    """Names of the ``top`` features by splits of a model fitted on 67 % of the rows
    (O-I2, O-I12, O-F2); of equals by gain, then name."""
    fit = replace(train, df=S.holdout_split(train.df, KEY, 0.33, 42)[0])
    prep = ML.fit_features(fit, features, "mean")
    vectors = in_tasks(written(prep.transform(fit).select("TARGET", "Weights", "features"), "ranking"), VECTORS_A_TASK)
    m = ML.fit_gbt(vectors, "TARGET", "Weights", ROUNDS)
    table = XP.importance_table(train.sparkSession, m, prep.vector_cols).filter(F.col("feature").isin(features))
    return [r["feature"] for r in table.orderBy(F.desc("splits"), F.desc("gain_importance"), "feature").limit(top).collect()]


def model_chain(spark: SparkSession, d: str, top: int = 40, k: int = 5) -> DataFrame:
    """One row per test client: TARGET within 0..1 after reload, the same as before, and
    what the chain left behind: features in the manifest, rounds in the metric log."""
    table = engineered(spark, d)
    train, test = table.filter("is_test = 0"), table.filter("is_test = 1")
    features = [c for c in C.columns_of_type(table, "numeric") if c not in (KEY, "TARGET", "fold", "Weights", "is_test")]
    manifest = ranked(train, features, top)
    train = materialize(in_tasks(C.select_manifest(train, manifest, [KEY, "TARGET", "Weights", "fold"]).unpack()))
    test = C.select_manifest(test, manifest, [KEY]).unpack()
    models, preps = ML.fit_folds(train, manifest, "TARGET", "Weights", "fold", k, ROUNDS)
    log = shared_dir(spark, "metric_log")
    M.log_metrics(ML.watch_list(train, models, preps, "TARGET", "Weights"), log, "cv")
    watched = M.read_metrics(spark, log)
    best = round(ML.stopping_rounds(watched).agg(F.avg("best_round")).first()[0])
    prep = ML.fit_features(train, manifest)
    final = ML.fit_gbt(prep.transform(train).select("TARGET", "Weights", "features"), "TARGET", "Weights",
                       {**ROUNDS, "maxIter": best})
    path = shared_dir(spark, "model")
    ML.save_model(final, path)
    scored = ML.predict_many([final, ML.load_model(path)], prep.beside(test, "features"))
    scored = scored.select(KEY, F.col("ps")[1].alias("TARGET"), (F.col("ps")[0] == F.col("ps")[1]).cast("int").alias("same"))
    out = J.merge_template(test.select(KEY), scored, KEY)
    logged = watched.groupBy("fold", "set", "round").count().filter("count = 1").count()
    return finalize(out.select(KEY, F.col("TARGET").between(0, 1).cast("int").alias("in_range"), "same",
                               F.lit(len(manifest)).alias("n_features"), F.lit(logged).alias("n_logged")))
