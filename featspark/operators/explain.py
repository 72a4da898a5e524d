"""Model explanation: importance ranking, top-k, partial dependence
(O-I12, O-I13, O-F1, O-F2, O-C13, O-H10, O-D26).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featspark.operators.model import FeaturePrep, predict_proba
from featspark.operators.profile import column_center_and_range

_SPLIT = re.compile(r"feature (\d+) ")


def split_counts(model: GBTClassificationModel, names: Sequence[str]) -> dict[str, int]:
    """Number of splits on each feature over all trees (the reference's
    ``get_fscore``), read from the fitted model's tree description."""
    c = Counter()
    for line in model.toDebugString.splitlines():
        s = line.strip()
        if s.startswith("If ("):
            m = _SPLIT.search(s)
            if m:
                c[names[int(m.group(1))]] += 1
    return dict(c)


def importance_table(spark: SparkSession, model: GBTClassificationModel,
                     names: Sequence[str]) -> DataFrame:
    """(feature, splits, gain_importance) for every feature (O-I12)."""
    sc = split_counts(model, names)
    imp = model.featureImportances.toArray()
    rows = [(n, int(sc.get(n, 0)), float(imp[i])) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "feature string, splits long, gain_importance double")


def top_k(df: DataFrame, score: str, k: int, tie: str) -> DataFrame:
    """Highest ``k`` rows by ``score``, ties by ``tie`` (a top-n, not a sort) (O-F2)."""
    return df.orderBy(F.col(score).desc(), F.col(tie).asc()).limit(k)


def pd_grid(df: DataFrame, columns: Sequence[str], explore: Sequence[str],
            points: int = 100) -> DataFrame:
    """Partial-dependence grid (O-I13, O-C13, O-H10, O-D26).

    For each explored variable, ``points`` rows where it runs evenly from
    its low to its high value (NULL and non-finite values ignored; the last
    point is the high value exactly) and every other column is at its median.
    Only one (median, low, high) triple per column reaches the driver.
    """
    stats = {r["variable"]: r for r in column_center_and_range(df, list(columns)).collect()}
    spark = df.sparkSession
    grid = spark.range(points).select(
        F.col("id").cast("int").alias("point"),
        F.explode(F.array(*[F.struct(F.lit(v).alias("v"),
                                     F.lit(stats[v]["low"]).cast("double").alias("lo"),
                                     F.lit(stats[v]["high"]).cast("double").alias("hi"))
                            for v in explore])).alias("e"))
    lo, hi, i = F.col("e.lo"), F.col("e.hi"), F.col("point")
    step = (hi - lo) / F.lit(points - 1)
    val = F.when(i == points - 1, hi).otherwise(lo + i * step)
    cols = [F.when(F.col("e.v") == c, val).otherwise(F.lit(stats[c]["median"]).cast("double"))
             .alias(c) for c in columns]
    return grid.select(F.col("e.v").alias("Batch_Var"), "point", *cols)


def partial_dependence(model: GBTClassificationModel, prep: FeaturePrep, df: DataFrame,
                       explore: Sequence[str], points: int = 100) -> DataFrame:
    """Score the grid in one batch job: (Batch_Var, point, value, prediction)."""
    grid = pd_grid(df, prep.features, explore, points)
    x = prep.transform(grid)
    scored = predict_proba(model, x, "prediction", keep=["Batch_Var", "point", *prep.features])
    value = F.coalesce(*[F.when(F.col("Batch_Var") == v, F.col(v)) for v in explore])
    return scored.select("Batch_Var", "point", value.alias("value"), "prediction")
