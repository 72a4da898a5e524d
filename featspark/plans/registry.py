"""Name -> query and name -> oracle SQL tables of the registered plans."""

from __future__ import annotations

from featspark.plans import chain as CH
from featspark.plans import features as FT
from featspark.plans import oracle as O
from featspark.plans import queries as Q
from featspark.plans import sections as SE
from featspark.plans import sections_sql as SQ

_NAMES = [
    "client_basic_stats", "client_category_counts", "client_status_counts_proportions",
    "client_time_since_status", "client_overdue_buckets", "client_credit_gap", "credit_gap_rows",
    "client_filtered_counts", "loan_client_two_level", "two_level_ratios",
    "loan_mode_stats", "ever_late_count",
    "affordability_block", "pair_ratios", "row_null_and_flag_counts", "row_score_stats",
    "impute_mean_median_mode", "one_hot", "label_encode_query", "union_with_origin",
    "suffix_join", "duplicate_keys", "category_drift", "describe_compare", "skewness",
    "corr_matrix", "corr_all", "histogram", "group_size_histogram", "missing_counts",
    "fold_assign", "weighted_auc", "density_odds", "pd_grid", "top_k", "column_agreement",
    "submission_merge", "csv_round_trip", "csv_inferred", "metric_log", "holdout_split",
    "bootstrap_samples", "preview", "natural_join",
    "gbt_cv_scores", "gbt_watch_list", "model_reload", "gbt_submission", "shift_weights", "importance_and_pd",
]

QUERIES = {"client_feature_table": FT.client_feature_table}
QUERIES.update({n: getattr(Q, n) for n in _NAMES})
ORACLE = {n: getattr(O, n) for n in _NAMES if hasattr(O, n)}
_SECTIONS = ["pos_features", "card_features", "previous_application_features"]
QUERIES.update({n: getattr(SE, n) for n in _SECTIONS})
QUERIES["train_test_assembly"] = FT.train_test_assembly
QUERIES["model_chain"] = CH.model_chain
ORACLE["model_chain"] = SQ.model_chain
ORACLE.update({n: getattr(SQ, n) for n in [*_SECTIONS, "client_feature_table", "train_test_assembly"]})
FLAGSHIP = "client_feature_table"
