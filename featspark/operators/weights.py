"""Covariate-shift row weights (O-I10, O-I11, O-D29, O-H11).

A classifier learns to tell test rows from train rows on stacked data; each
train row's weight is the odds p / (1 - p) of P(test | x), averaged over
models fitted on repeated subsamples.  Predictions stay in long form
(row, iteration, p) and are averaged with a ``groupBy`` (no wide
per-iteration columns, no driver-side frame).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.operators.joins import rows_without_match, union_with_origin
from featspark.operators.model import fit_features, fit_gbt, predict_many
from featspark.operators.split import resample_cuts, subsample
from featspark.session import materialize


class MissingWeights(ValueError):
    pass


def odds_weights(preds: DataFrame, key: str, p_col: str = "p_test",
                 name: str = "Weights") -> DataFrame:
    """Average P(test) per row over iterations, then odds (O-D29, O-H11).

    NULL when the average reaches 1 (the reference would divide by zero).
    """
    avg = preds.groupBy(key).agg(F.avg(p_col).alias("_p"))
    return avg.select(key, F.try_divide(F.col("_p"), 1 - F.col("_p")).alias(name))


def check_all_weighted(train: DataFrame, weights: DataFrame, key: str) -> None:
    """Every train row has a weight (O-I11): no left-anti match may exist."""
    if rows_without_match(train, weights, key).limit(1).count() > 0:
        raise MissingWeights("some train rows have no weight")


def shift_weights(train: DataFrame, test: DataFrame, key: str, features: Sequence[str],
                  n_iter: int = 15, fraction: float = 0.3, params: dict | None = None,
                  seed: int = 7) -> DataFrame:
    """Density-ratio weights for the train rows (O-I10)."""
    stacked = union_with_origin(train.select(key, *features), test.select(key, *features),
                                "is_test")
    prep = fit_features(stacked, features)
    # every fit and the scoring pass read the assembled rows: cut their lineage
    x = materialize(prep.transform(stacked).select(key, "is_test", "features"))
    cuts = resample_cuts(x, key, fraction, n_iter, seed)
    models = [fit_gbt(subsample(x, key, i, cuts, seed).select("is_test", "features"), "is_test", None, params)
              for i in range(n_iter)]
    # all models on one scan; long form, as odds_weights takes it
    scored = predict_many(models, x.filter(F.col("is_test") == 0), "ps")
    w = odds_weights(scored.select(key, F.explode("ps").alias("p_test")), key)
    check_all_weighted(train, w, key)
    return w
