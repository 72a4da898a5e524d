"""Weighted ROC AUC and fold tables (O-D27, O-D28, O-A7).

AUC = P(score_pos > score_neg) + 0.5 P(equal), weighted: the trapezoid
rule over the ROC points at every distinct score, which is what
``roc_auc_score(..., sample_weight=w)`` computes.  Plan: weights are summed
per (group, distinct score) (a hot score collapses to one row), the
negative weight below each score is an exclusive prefix sum from range
offsets (``ranking.running_sum``: no window over a whole fold), and one
aggregate per group finishes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featspark.operators.ranking import running_sum


def _score_counts(df: DataFrame, label: str, score: str, weight: str | None, group_cols: Sequence) -> DataFrame:
    """(group..., _s, _wp, _wn): positive and negative weight per distinct score."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    y = F.col(label).cast("double")
    return (df.filter(F.col(score).isNotNull())
              .groupBy(*group_cols, F.col(score).cast("double").alias("_s"))
              .agg(F.sum(w * y).alias("_wp"), F.sum(w * (1 - y)).alias("_wn")))


def auc_of_counts(pre: DataFrame, group_cols: Sequence[str], name: str) -> DataFrame:
    """Weighted AUC per group from (group..., _s, _wp, _wn), one row per distinct score."""
    cum = running_sum(pre, group_cols, ["_s"], "_wn", "_below")
    num = F.sum(F.col("_wp") * (F.col("_below") + 0.5 * F.col("_wn")))
    den = F.sum("_wp") * F.sum("_wn")
    return cum.groupBy(*group_cols).agg(F.try_divide(num, den).alias(name))


def weighted_auc(df: DataFrame, label: str, score: str, weight: str | None = None,
                 group_cols: Sequence[str] = (), name: str = "auc") -> DataFrame:
    """Weighted AUC per group (one row per group, or one row overall)."""
    return auc_of_counts(_score_counts(df, label, score, weight, group_cols), list(group_cols), name)


def fold_auc_table(df: DataFrame, label: str, score: str, weight: str | None,
                   fold_col: str = "fold", k: int = 5, model_col: str | None = None
                   ) -> DataFrame:
    """Validation and train AUC per fold plus their average (O-D27, O-D28).

    Without ``model_col`` one score column serves every fold: validation rows
    of fold f have ``fold == f``, training rows are the others.  With
    ``model_col`` the frame holds every row scored by every fold model
    (``model_col`` = the model's fold), as cross-validation produces it.
    Weights are summed per (fold, score) first; only those sums are repeated
    for the k - 1 folds they train.  Rows without a fold are in no set.
    """
    valid = F.col(fold_col) == F.col("_mf")
    if model_col is None:
        folds = F.array(*[F.lit(i) for i in range(1, k + 1)])
        pre = (_score_counts(df, label, score, weight, [fold_col])
               .select("*", F.explode(folds).alias("_mf")).withColumn("_valid", valid)
               .groupBy("_mf", "_valid", "_s").agg(F.sum("_wp").alias("_wp"), F.sum("_wn").alias("_wn")))
    else:
        scored = df.withColumn("_mf", F.col(model_col)).withColumn("_valid", valid)
        pre = _score_counts(scored, label, score, weight, ["_mf", "_valid"])
    auc = auc_of_counts(pre.filter("_valid IS NOT NULL"), ["_mf", "_valid"], "_auc")
    # one row per fold and, from the same rows, their sum over all folds
    both = auc.rollup("_mf").agg(F.grouping("_mf").alias("_all"),
                                 F.sum(F.when(F.col("_valid"), F.col("_auc"))).alias("_v"),
                                 F.sum(F.when(~F.col("_valid"), F.col("_auc"))).alias("_t"))
    n = F.when(F.col("_all") == 1, F.lit(float(k))).otherwise(1.0)
    fold = F.when(F.col("_all") == 1, "fold_AVG").otherwise(F.concat(F.lit("fold_"), F.col("_mf").cast("string")))
    return both.select(fold.alias("Fold_Name"), (F.col("_v") / n).alias("Validation_AUC"),
                       (F.col("_t") / n).alias("Train_AUC"))


def log_metrics(table: DataFrame, path: str, run: str) -> None:
    """Add the rows of one run to the metric log at ``path`` (O-A7).

    The log is partitioned by run and only this run's partition is replaced, when
    the job commits: a run that is written again, or whose tasks were retried, is
    there once, and other runs are not touched.
    """
    (table.withColumn("run", F.lit(run)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn("run", F.col("run").cast("string"))
