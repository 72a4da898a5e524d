"""Weighted gradient-boosted trees: features, fit, cross-validation, scoring
(O-I6..I9, O-I14, O-A6, O-A7).

Spark ML's ``GBTClassifier`` stands in for the reference's boosted trees
(same role, different learner: no score parity is promised).  GBT rejects
NULL/NaN features, so missing values are filled with a fitted statistic
(exact median by default) and a 0/1 missing-indicator column is added for
every column that had NULLs.  Fits run as driver-coordinated Spark jobs;
scoring is a distributed ``transform``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featspark.operators.impute import apply_impute, fit_impute
from featspark.operators.metrics import auc_of_counts, fold_auc_table
from featspark.operators.packed import Packed, filled, means_and_nulls
from featspark.operators.profile import missing_columns
from featspark.session import materialize

# Learner defaults for the registered plans (caller options; the reference's
# 2000 rounds of depth-29 trees are not practical for Spark's GBT).
DEFAULT_PARAMS = {"maxIter": 20, "maxDepth": 4, "stepSize": 0.1, "subsamplingRate": 0.995,
                  "minInstancesPerNode": 5, "seed": 42}


@dataclass
class FeaturePrep:
    """Fitted fill values and indicator columns for a feature list."""
    features: list[str]
    fill: dict[str, object]
    indicators: list[str] = field(default_factory=list)

    @property
    def vector_cols(self) -> list[str]:
        return self.features + [f"{c}_isna" for c in self.indicators]

    def transform(self, df: DataFrame | Packed, out: str = "features") -> DataFrame:
        if isinstance(df, Packed):  # the ordinary columns and the vector
            fill = [float(self.fill.get(c) or 0.0) for c in self.features]
            return filled(df, self.features, fill, self.indicators, out).withColumn(out, array_to_vector(out))
        d = df.withColumns({f"{c}_isna": F.col(c).isNull().cast("int") for c in self.indicators})
        d = apply_impute(d, {c: v for c, v in self.fill.items() if v is not None})
        # a column that was entirely NULL in the fit frame stays NULL: use 0
        d = d.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
                           for c in self.features})
        return VectorAssembler(inputCols=self.vector_cols, outputCol=out).transform(d)

    def beside(self, df: DataFrame, out: str) -> DataFrame:
        """``transform`` that leaves the columns of ``df`` as they are, so that several
        preparations can stand side by side on one scan."""
        filled = {f"{out}:{c}": F.coalesce(F.col(c).cast("double"), F.lit(float(self.fill.get(c) or 0.0)))
                  for c in self.features}
        isna = {f"{out}:{c}:isna": F.col(c).isNull().cast("int") for c in self.indicators}
        d = df.withColumns({**filled, **isna})
        return VectorAssembler(inputCols=[*filled, *isna], outputCol=out).transform(d).drop(*filled, *isna)


def fit_features(df: DataFrame | Packed, features: Sequence[str], stat: str = "median") -> FeaturePrep:
    features = list(features)
    if isinstance(df, Packed):
        if stat != "mean":
            df = df.select(*features).unpack()
        else:
            got = means_and_nulls(df, features)
            return FeaturePrep(features, {c: m for c, (m, _) in got.items()}, [c for c, (_, n) in got.items() if n])
    miss = missing_columns(df, features)
    return FeaturePrep(features, fit_impute(df, features, stat), miss)


def fit_features_per_fold(df: DataFrame, features: Sequence[str], fold_col: str, k: int
                          ) -> dict[int, FeaturePrep]:
    """``fit_features`` on the training rows of every fold, in one pass each.

    Null counts come from one aggregate per fold.  Values are counted per (fold,
    column, value) first; only these counts are added over the k - 1 folds that
    each training set holds, and the medians read off them.
    """
    from featspark.operators.quantile import _quantiles_from_counts
    features = list(features)
    nulls = {r[fold_col]: r for r in df.groupBy(fold_col).agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in features]).collect()}
    arr = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("value")) for c in features])
    long = df.select(F.col(fold_col).alias("_f"), F.explode(arr).alias("kv")).select("_f", "kv.*")
    long = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    cnt = long.groupBy("_f", "c", "value").agg(F.count(F.lit(1)).alias("cnt"))
    folds = F.array(*[F.lit(i) for i in range(1, k + 1)])
    cnt = cnt.select("c", "value", "cnt", F.explode(F.filter(folds, lambda f: f != F.col("_f"))).alias("_tf"))
    # one "variable" per (training fold, column)
    cnt = cnt.groupBy(F.concat(F.col("_tf").cast("string"), F.lit(":"), F.col("c")).alias("variable"), "value").agg(
        F.sum("cnt").alias("cnt"))
    med = {r["variable"]: r["value"] for r in _quantiles_from_counts(cnt, [0.5]).collect()}
    out = {}
    for f in range(1, k + 1):
        miss = [c for c in features
                if sum((r[c] or 0) for fo, r in nulls.items() if fo != f) > 0]
        out[f] = FeaturePrep(features, {c: med.get(f"{f}:{c}") for c in features}, miss)
    return out


def gbt(label: str = "label", weight: str | None = "weight", params: dict | None = None,
        features: str = "features") -> GBTClassifier:
    p = dict(DEFAULT_PARAMS, **(params or {}))
    est = GBTClassifier(labelCol=label, featuresCol=features, **p)
    if weight:
        est = est.setWeightCol(weight)
    return est


def fit_gbt(df: DataFrame, label: str = "label", weight: str | None = "weight",
            params: dict | None = None) -> GBTClassificationModel:
    """Weighted boosted-tree fit on an assembled frame (O-I6)."""
    return gbt(label, weight, params).fit(df)


def predict_proba(model: GBTClassificationModel, df: DataFrame, name: str = "p",
                  keep: Sequence[str] = ()) -> DataFrame:
    """P(label = 1) per row (O-I9)."""
    out = model.transform(df)
    return out.select(*keep, vector_to_array(F.col("probability"))[1].alias(name))


def predict_many(models: Sequence[GBTClassificationModel], df: DataFrame, out: str = "ps",
                 features: Sequence[str] | str = "features") -> DataFrame:
    """``df`` with ``out``: P(label = 1) by each model, as an array; one scan for all.

    ``features``: the vector column of all models, or one for each.
    """
    cols = [features] * len(models) if isinstance(features, str) else list(features)
    names = [f"{out}_{i}" for i in range(len(models))]
    d = df
    for m, x, n in zip(models, cols, names):
        one = m.copy().setFeaturesCol(x).setPredictionCol("").setRawPredictionCol("").setProbabilityCol(n)
        d = one.transform(d)
    return d.withColumn(out, F.array(*[vector_to_array(F.col(n))[1] for n in names])).drop(*names)


def round_margins(model: GBTClassificationModel, df: DataFrame, features: str, out: str) -> DataFrame:
    """``df`` with ``out``: the margin after each boosting round, as an array.

    Every tree is evaluated once per row; margins are running sums of the trees'
    weighted predictions, so all rounds come out of one scan.
    """
    d, names = df, []
    for j, (tree, w) in enumerate(zip(model.trees, model.treeWeights)):
        n = f"{out}_{j}"
        d = tree.copy().setFeaturesCol(features).setPredictionCol(n).transform(d)
        term = F.col(n) * F.lit(float(w))
        d = d.withColumn(n, term + F.col(names[-1]) if names else term)
        names.append(n)
    return d.withColumn(out, F.array(*names)).drop(*names)


def loss_per_round(model: GBTClassificationModel, df: DataFrame) -> list[float]:
    """Loss after each boosting round on ``df``, as the learner gives it (twice the log-loss)."""
    return list(model.evaluateEachIteration(df))


def watch_list(df: DataFrame, models: dict[int, GBTClassificationModel], preps: dict[int, FeaturePrep],
               label: str = "label", weight: str | None = "weight", fold_col: str = "fold") -> DataFrame:
    """Every round of every fold's model on its train and validation rows (O-I7):
    (fold, set, round from 1, n_rows, loss, auc), losses and AUC weighted.

    One scan: all folds' preparations and trees stand side by side on a row.
    """
    d = df
    for f, m in models.items():
        d = round_margins(m, preps[f].beside(d, f"_x{f}"), f"_x{f}", f"_m{f}").drop(f"_x{f}")
    per = F.array(*[F.struct(F.lit(f).alias("mf"), F.col(f"_m{f}").alias("ms")) for f in models])
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    d = d.select(F.col(label).cast("double").alias("y"), w.alias("w"), F.col(fold_col).alias("f"), F.explode(per).alias("e"))
    d = d.select("y", "w", F.col("e.mf").alias("fold"), F.when(F.col("f") == F.col("e.mf"), "valid").otherwise("train").alias("set"),
                 F.posexplode("e.ms").alias("at", "margin"))
    # rows with one margin are alike: sums per distinct margin carry loss and AUC
    d = d.groupBy("fold", "set", (F.col("at") + 1).alias("round"), F.col("margin").alias("_s")).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("w") * F.col("y")).alias("_wp"),
        F.sum(F.col("w") * (1 - F.col("y"))).alias("_wn"))
    loss = lambda z: F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
    g, z = ["fold", "set", "round"], 2 * F.col("_s")
    d = materialize(d)
    losses = d.groupBy(*g).agg(F.sum("_n").alias("n_rows"), F.try_divide(
        F.sum(F.col("_wp") * loss(-z) + F.col("_wn") * loss(z)), F.sum(F.col("_wp") + F.col("_wn"))).alias("loss"))
    return losses.join(auc_of_counts(d.drop("_n"), g, "auc"), g)


def stopping_rounds(watched: DataFrame, patience: int = 3) -> DataFrame:
    """(fold, best_round, stopped): the round of least validation loss before ``patience``
    rounds in a row bring no better one, and whether training would have ended there."""
    w = Window.partitionBy("fold").orderBy("round")
    v = watched.filter("set = 'valid'").withColumn("low", F.min("loss").over(w))
    v = v.withColumn("since", F.col("round") - F.max(F.when(F.col("loss") == F.col("low"), F.col("round"))).over(w))
    # rounds up to the first that is `patience` rounds without a new low
    v = v.withColumn("late", F.max((F.col("since") >= patience).cast("int")).over(w))
    return v.groupBy("fold").agg(F.min_by("round", F.struct("late", "loss", "round")).alias("best_round"),
                                 (F.max("late") == 1).alias("stopped"))


def fit_folds(df: DataFrame, features: Sequence[str], label: str, weight: str | None, fold_col: str, k: int,
              params: dict | None = None) -> tuple[dict[int, GBTClassificationModel], dict[int, FeaturePrep]]:
    """A model and a preparation per fold, fitted on the rows of the other folds."""
    preps = fit_features_per_fold(df, features, fold_col, k)
    models = {}
    for f, prep in preps.items():
        x = prep.transform(df.filter(F.col(fold_col) != f)).select(label, *([weight] if weight else []), "features")
        models[f] = fit_gbt(x, label, weight, params)
    return models, preps


def cross_validate(df: DataFrame, key: str, features: Sequence[str], label: str = "label",
                   weight: str | None = "weight", fold_col: str = "fold", k: int = 5,
                   params: dict | None = None) -> tuple[DataFrame, list[GBTClassificationModel]]:
    """k-fold CV: fit on fold != f, score every row by all models in one scan,
    weighted AUC table (O-I8).

    Feature preparation is fitted on the training rows of each fold only.
    Returns (table Fold_Name / Validation_AUC / Train_AUC, models).
    """
    keep = [key, label, fold_col] + ([weight] if weight else [])
    df = materialize(df.select(*keep, *features))  # read by every fold's jobs
    models, preps = fit_folds(df, features, label, weight, fold_col, k, params)
    d = df
    for f, prep in preps.items():
        d = prep.beside(d, f"_x{f}")
    d = predict_many(list(models.values()), d, "_ps", [f"_x{f}" for f in models])
    scored = d.select(*keep, F.posexplode("_ps").alias("_i", "p")).withColumn(
        "model_fold", F.element_at(F.array(*[F.lit(f) for f in models]), F.col("_i") + 1))
    return fold_auc_table(scored, label, "p", weight, fold_col, k, model_col="model_fold"), list(models.values())


def save_model(model: GBTClassificationModel, path: str) -> None:
    """Persist a fitted model (O-A6)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> GBTClassificationModel:
    return GBTClassificationModel.load(path)
