"""Registered queries: each reads the driver tables (through the role
mapping of ``featspark.sources.roles``) and runs one group of operators.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose
column names equal those of the matching SQL in ``featspark.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featspark.functions import expr as X
from featspark.operators import agg as A
from featspark.operators import joins as J
from featspark.operators import pivot as P
from featspark.operators import windows as W
from featspark.plans import sections as SE
from featspark.plans.common import finalize
from featspark.sources import roles as R

KEY = "client_id"

BUREAU_NUM = ["o_totalprice", "days_credit"]
BUREAU_CAT = ["o_orderstatus", "o_orderpriority"]


def spine(spark: SparkSession, d: str) -> DataFrame:
    return R.application(spark, d).select(KEY)


# ---- per-client statistics -------------------------------------------------

def bureau_basic_stats_frame(spark, d):
    return A.basic_stats(R.bureau(spark, d), KEY, BUREAU_NUM, "_bureau")


def client_basic_stats(spark, d):
    """O-D3, O-D4, O-C1: five statistics per client, all clients kept."""
    return finalize(J.attach(spine(spark, d), [bureau_basic_stats_frame(spark, d)], KEY,
                             verify=False))


def bureau_category_frame(spark, d):
    b = R.bureau(spark, d)
    return b.groupBy(KEY).agg(F.count(F.lit(1)).alias("bureau_count"),
                              *P.category_count_exprs(b, BUREAU_CAT, "_bureau", taken={KEY, "bureau_count"}))


def client_category_counts(spark, d):
    """O-D1, O-D10, O-D11: record count and category count pivots."""
    return finalize(J.attach(spine(spark, d), [bureau_category_frame(spark, d)], KEY,
                             verify=False))


def status_frame(spark, d):
    cw = R.bureau(spark, d).select(KEY, "credit_id")
    return P.crosswalk_status_counts(cw, R.bureau_balance(spark, d), KEY, "credit_id", "status")


def client_status_counts_proportions(spark, d):
    """O-D13, O-E4, O-C4: status counts and shares through the credit crosswalk."""
    return finalize(J.attach(spine(spark, d), [status_frame(spark, d)], KEY, verify=False))


def time_since_frame(spark, d):
    cw = R.bureau(spark, d).select(KEY, "credit_id")
    return P.crosswalk_max_by_category(cw, R.bureau_balance(spark, d), KEY, "credit_id",
                                       "status", "months_balance")


def client_time_since_status(spark, d):
    """O-D14, O-C5: latest month per status (inner crosswalk join, no fill)."""
    return finalize(J.attach(spine(spark, d), [time_since_frame(spark, d)], KEY, verify=False))


def overdue_frame(spark, d):
    return P.bucket_sums(R.bureau(spark, d), KEY, "days_credit", "o_totalprice")


def client_overdue_buckets(spark, d):
    """O-B12, O-D12: amount per day bucket, fill 0 inside the table."""
    return finalize(J.attach(spine(spark, d), [overdue_frame(spark, d)], KEY, verify=False))


def gap_frame(spark, d):
    return W.gap_stats(R.bureau(spark, d), KEY, "days_credit")


def client_credit_gap(spark, d):
    """O-E5, O-D16: mean/sd of days between consecutive credits."""
    return finalize(gap_frame(spark, d))


def credit_gap_rows(spark, d):
    """O-E1, O-E2, O-E3 in row form: every credit with its last-row flag, the next
    credit's day, the gap, and the client's mean and sd of gaps."""
    b = R.bureau(spark, d).select(KEY, "credit_id", "days_credit")
    return finalize(W.gap_rows(b, KEY, "days_credit", ["credit_id"]))


def filtered_frame(spark, d):
    b = R.bureau(spark, d)
    dc = F.col("days_credit")
    return A.filtered_counts(b, KEY, {
        "Bureau_Past_Credit_Count": dc < R.PAST_CREDIT_DAYS,
        "Bureau_Current_Credit_Count": dc >= R.PAST_CREDIT_DAYS,
        "Completed_Count_bureau": F.col("o_orderstatus") == "F",
    })


def client_filtered_counts(spark, d):
    """O-D2, O-B5, O-B6: filtered counts fused in one aggregate."""
    return finalize(J.attach(spine(spark, d), [filtered_frame(spark, d)], KEY, verify=False))


def two_level_frame(spark, d):
    return SE.two_level(SE.month_rows(spark, d, "installments"), "installments")


def loan_client_two_level(spark, d):
    """O-D5, O-D6, O-D7: statistics of per-loan statistics per client."""
    return finalize(two_level_frame(spark, d))


def two_level_ratio_frame(spark, d):
    names = SE.section_names("installments")
    tl = A.two_level_stats(SE.month_rows(spark, d, "installments"), KEY, "loan_id", list(names), names,
                           stats=["sum"], stats2=["mean"])
    cols = [c for c in tl.columns if "_sum_mean" in c]
    return tl.select(KEY, *X.all_pair_ratios(cols))


def two_level_ratios(spark, d):
    """O-B15: ordered pair ratios of the ``_sum_mean`` columns."""
    return finalize(two_level_ratio_frame(spark, d))


def mode_frame(spark, d):
    rows = written(R.installments(spark, d).select(KEY, "loan_id", "cnt_units"), "units",
                   tasks_for(R.table(spark, d, "lineitem")))
    return A.mode_then_stats(rows, KEY, "loan_id", "cnt_units", "CNT_UNITS_MODE", "_POS_CASH", rows)


def loan_mode_stats(spark, d):
    """O-D7, O-D8: mode per loan, then five statistics per client."""
    return finalize(mode_frame(spark, d))


def ever_late_frame(spark, d):
    return A.ever_flag_count(R.installments(spark, d), KEY, "loan_id", "dpd",
                             "Ever_DPD_Count_POS_CASH")


def ever_late_count(spark, d):
    """O-D15: loans ever past due per client (null-contagious)."""
    return finalize(ever_late_frame(spark, d))


# ---- application row-wise features ----------------------------------------

from featspark.operators import columns as C  # noqa: E402
from featspark.operators import comoments as CM  # noqa: E402
from featspark.operators import encode as E  # noqa: E402
from featspark.operators import impute as I  # noqa: E402
from featspark.operators import profile as PR  # noqa: E402
from featspark.operators import rowwise as RW  # noqa: E402

NA_COLS = R.APP_RATIO_COLS + R.DOC_FLAGS + R.ADDRESS_FLAGS + ["c_mktsegment", "NATION"]
SCORES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def affordability_frame(spark, d):
    return RW.affordability(R.application_wide(spark, d), KEY, NA_COLS)


def affordability_block(spark, d):
    """O-B8..B11, O-B16, O-H2: affordability ratios with sentinel clean-up."""
    return finalize(affordability_frame(spark, d))


def pair_ratio_frame(spark, d):
    return RW.pair_ratios(R.application_wide(spark, d), R.APP_RATIO_COLS, KEY)


def pair_ratios(spark, d):
    """O-B14: all ordered ratios of 13 application columns (156 columns)."""
    return finalize(pair_ratio_frame(spark, d))


def flag_frame(spark, d):
    return RW.flag_counts(R.application_wide(spark, d),
                          {"Document_Count_application": R.DOC_FLAGS,
                           "Reg_mismatch_count_application": R.ADDRESS_FLAGS}, KEY, NA_COLS)


def row_null_and_flag_counts(spark, d):
    """O-B16, O-B17: row null count and null-contagious flag sums."""
    return finalize(flag_frame(spark, d))


def score_frame(spark, d):
    return RW.score_stats(R.application_wide(spark, d), SCORES, KEY)


def row_score_stats(spark, d):
    """O-B18: row mean/sd/missing/max/min/range of the three scores."""
    return finalize(score_frame(spark, d))


def impute_mean_median_mode(spark, d):
    """O-B19, O-D9, O-K1: fit on train, fill test, suffix copies per statistic."""
    app = R.application_wide(spark, d)
    train, test = app.filter(~F.col("is_test")), app.filter(F.col("is_test"))
    cand = PR.numeric_columns(app, exclude=[KEY, "label", "weight"])
    miss = PR.missing_columns(train, cand)
    return finalize(I.impute_variants(test, train, miss, {
        st: f"_tr{st}" for st in ("mean", "median", "mode")}, keep=[KEY]))


def one_hot_frame(spark, d):
    app = R.application_wide(spark, d)
    train, test = app.filter(~F.col("is_test")), app.filter(F.col("is_test"))
    vocab = E.fit_one_hot(train, ["c_mktsegment", "NATION"], other=test)
    return E.one_hot(train.select(KEY, "c_mktsegment", "NATION"), vocab)


def one_hot(spark, d):
    """O-I4, O-B21: one-hot with a vocabulary shared by train and test."""
    return finalize(one_hot_frame(spark, d))


def label_encode_query(spark, d):
    """O-I5: alphabetical integer codes from 1 for string columns."""
    b = R.bureau(spark, d).select(KEY, "credit_id", *BUREAU_CAT)
    return finalize(E.label_encode(b, E.fit_label_codes(b, BUREAU_CAT), BUREAU_CAT))


def union_with_origin(spark, d):
    """O-G1, O-G2: train (without label/weight) stacked on test with a flag."""
    app = R.application(spark, d)
    train = app.filter(~F.col("is_test")).drop("is_test")
    test = app.filter(F.col("is_test")).drop("is_test", "label", "weight")
    return finalize(J.union_with_origin(train, test, "is_test", drop=["label", "weight"]))


def suffix_join(spark, d):
    """O-C7, O-C2: joining two application-derived frames; shared names get _x/_y."""
    app = R.application_wide(spark, d)
    left = app.select(KEY, *SCORES, "DAYS_EMPLOYED")
    right = I.impute(app.select(KEY, *SCORES, "DAYS_EMPLOYED"), app, SCORES, "mean")
    return finalize(J.join_with_suffix(left, right, [KEY], "left"))


def duplicate_keys(spark, d):
    """O-D17, O-C8: keys present more than once (line item order x line number)."""
    li = R.table(spark, d, "lineitem")
    return finalize(J.duplicate_keys(li, ["l_orderkey", "l_linenumber"]))


def category_drift(spark, d):
    """O-D18, O-D19, O-C10: market-segment shares in train vs test."""
    app = R.application(spark, d)
    return finalize(PR.category_drift(app.filter(~F.col("is_test")), app.filter(F.col("is_test")),
                                      "c_mktsegment", ("freq_train", "freq_test")))


def _orders_by_period(spark, d):
    b = R.bureau(spark, d)
    early = b.filter(F.col("days_credit") < -1200)
    late = b.filter(F.col("days_credit") >= -1200)
    return early, late


def describe_compare(spark, d):
    """O-D20, O-D21, O-C9: describe() of two periods side by side (exact quartiles)."""
    early, late = _orders_by_period(spark, d)
    return finalize(PR.describe_compare(early, late, ["o_totalprice", "days_credit"],
                                        ("early", "late")))


def skewness(spark, d):
    """O-D22: bias-corrected skewness per numeric column."""
    li = R.table(spark, d, "lineitem")
    return finalize(PR.skewness(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


def corr_matrix(spark, d):
    """O-D23: pairwise-complete Pearson correlations in long form."""
    app = R.application_wide(spark, d)
    return finalize(PR.corr_long(app, ["AMT_INCOME_TOTAL", "AMT_CREDIT", "EXT_SOURCE_1",
                                       "EXT_SOURCE_2", "DAYS_BIRTH"]))


def corr_all(spark, d):
    """O-D23 for a wide table: all pairs of the 156 ratio columns."""
    r = pair_ratio_frame(spark, d).drop(KEY)
    return finalize(CM.corr_all(r, r.columns))


def histogram(spark, d):
    """O-D24: 20 equal-width bins of order value."""
    return finalize(PR.histogram(R.bureau(spark, d), "o_totalprice", 20))


def group_size_histogram(spark, d):
    """O-D25, O-D24: non-null counts per client, then a 10-bin histogram of them."""
    sizes = A.nonnull_counts(R.bureau(spark, d), KEY, ["credit_id", "o_totalprice"])
    return finalize(PR.histogram(sizes, "credit_id", 10))


def missing_counts(spark, d):
    """O-B19: NULL count per column of the application table."""
    return finalize(PR.missing_counts(R.application_wide(spark, d)))


# ---- splits, metrics, models ------------------------------------------------

from featspark.operators import explain as XP  # noqa: E402
from featspark.operators import metrics as M  # noqa: E402
from featspark.operators import model as ML  # noqa: E402
from featspark.operators import split as S  # noqa: E402
from featspark.operators import weights as WT  # noqa: E402
from featspark.session import materialize, shared_dir, tasks_for, written  # noqa: E402
from featspark.sources import io as IO  # noqa: E402


def _train(spark, d):
    return R.application_wide(spark, d).filter(~F.col("is_test"))


def fold_assign(spark, d):
    """O-I1, O-B7: stratified 5-fold assignment over train clients."""
    tr = _train(spark, d).select(KEY, "label")
    return finalize(S.stratified_folds(tr, KEY, "label", 5, 1234))


def _scored_train(spark, d):
    """Train clients with a score (total order value), label, weight, fold."""
    tr = _train(spark, d).select(KEY, "label", "weight", F.coalesce("AMT_CREDIT", F.lit(0.0))
                                 .alias("score"))
    return S.stratified_folds(tr, KEY, "label", 5, 1234)


def weighted_auc(spark, d):
    """O-D27, O-D28, O-A7: weighted AUC of a score per fold, train and validation."""
    return finalize(M.fold_auc_table(_scored_train(spark, d), "label", "score", "weight"))


def density_odds(spark, d):
    """O-D29, O-H11, O-I11: average P(test) over 15 resample scores, odds per row.

    The per-iteration probabilities are a fixed logistic of the balance, so
    the averaging and odds steps can be checked exactly.
    """
    tr = R.application(spark, d).filter(~F.col("is_test")).select(KEY, "c_acctbal")
    it = F.explode(F.sequence(F.lit(0), F.lit(14))).alias("iteration")
    long = tr.select(KEY, "c_acctbal", it).select(
        KEY, "iteration",
        (1 / (1 + F.exp(-(F.col("c_acctbal") / 5000 + F.col("iteration") / 15 - 0.5))))
        .alias("p_test"))
    w = WT.odds_weights(long, KEY)
    WT.check_all_weighted(tr, w, KEY)
    return finalize(w)


PD_COLS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "EXT_SOURCE_1",
           "EXT_SOURCE_3"]
PD_EXPLORE = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "DAYS_BIRTH"]


def pd_grid(spark, d):
    """O-I13 grid, O-D26, O-C13, O-H10: 100-point grids, other columns at median."""
    return finalize(XP.pd_grid(_train(spark, d), PD_COLS, PD_EXPLORE, 100))


def top_k(spark, d):
    """O-F1, O-F2: the 10 clients with the highest total order value."""
    app = R.application_wide(spark, d).select(KEY, "AMT_CREDIT")
    return finalize(XP.top_k(app, "AMT_CREDIT", 10, KEY))


def column_agreement(spark, d):
    """O-B1..B4, O-B13, O-B20, O-B21, O-I14: per-set one-hot, name differences,
    trim to shared columns, manifest selection, suffix."""
    app = R.application_wide(spark, d)
    train, test = app.filter(~F.col("is_test")), app.filter(F.col("is_test"))
    cats = C.columns_of_type(app, "string")
    tr = E.one_hot(train, E.fit_one_hot(train, cats)).drop("is_test")
    te = E.one_hot(test, E.fit_one_hot(test, cats)).drop("is_test", "label", "weight")
    tr, te = C.align_train_test(tr, te, train_only=["label", "weight"], strict=False)
    feats = C.names_matching(C.columns_of_type(te, "numeric"), include=r"^(AMT_|DAYS_|c_mkt)",
                             exclude=["DAYS_LAST"])
    out = C.select_manifest(tr, feats, extra=[KEY, "label", "weight"])
    return finalize(C.add_suffix(out, "_app", exclude=[KEY, "label", "weight"]))


def submission_merge(spark, d):
    """O-C11, O-I15: template of test clients left-merged with predictions."""
    app = R.application(spark, d)
    template = app.filter(F.col("is_test")).select(KEY, F.lit(0.5).alias("TARGET"))
    preds = app.filter(F.col("is_test")).select(
        KEY, (1 / (1 + F.exp(-F.col("c_acctbal") / 1000))).alias("TARGET"))
    return finalize(J.merge_template(template, preds, KEY, drop=["TARGET"]))


def csv_round_trip(spark, d):
    """O-A1..A5: write CSV (no index) to the shared checkpoint folder, read it
    back with an explicit schema and the NA rule."""
    app = R.application(spark, d).select(KEY, "c_nationkey", "c_mktsegment", "c_acctbal",
                                         "score_1", "is_test")
    path = shared_dir(spark, "csv")
    IO.write_csv(app, path)
    schema = ("client_id bigint, c_nationkey int, c_mktsegment string, c_acctbal double, "
              "score_1 double, is_test boolean")
    return finalize(IO.read_csv(spark, path, schema, na_token="NA"))


def metric_log(spark, d):
    """O-A7: fold metrics of two runs appended to a log, the first run twice."""
    path = shared_dir(spark, "metric_log")
    table = M.fold_auc_table(_scored_train(spark, d), "label", "score", "weight")
    for run in ("first", "second", "first"):
        M.log_metrics(table, path, run)
    return finalize(M.read_metrics(spark, path).select("run", "Fold_Name", "Validation_AUC", "Train_AUC"))


def csv_inferred(spark, d):
    """O-A1, O-A2: CSV with blanks, NA, a flag column and a row index, read back with
    inferred types and without the index."""
    app, k = R.application(spark, d), F.col(KEY)
    app = app.select(
        KEY, "c_nationkey", F.when(k % 9 == 0, "").when(k % 11 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(k % 4 != 0, F.col("c_acctbal")).alias("balance"),
        F.when(k % 6 != 0, F.col("c_nationkey") % 2 == 0).alias("even"), (k % 5).alias("step"))
    path = shared_dir(spark, "csv")
    IO.write_csv(IO.with_row_index(app, KEY), path, na_token="NA")
    return finalize(IO.read_csv_inferred(spark, path))


def holdout_split(spark, d):
    """O-I2: exactly 33 % of the train clients held out by least hash."""
    tr = _train(spark, d).select(KEY)
    fit, hold = S.holdout_split(tr, KEY, 0.33, 42)
    return finalize(fit.withColumn("holdout", F.lit(0)).unionByName(
        hold.withColumn("holdout", F.lit(1))))


def bootstrap_samples(spark, d):
    """O-I3: 15 subsamples of exactly 30 % of all clients, one pass."""
    app = R.application(spark, d).select(KEY)
    return finalize(S.repeated_subsamples(app, KEY, 0.3, 15, 7))


def preview(spark, d):
    """O-A8, O-F3: first five clients by key."""
    return finalize(IO.preview(R.application(spark, d).select(KEY, "c_mktsegment", "c_acctbal"),
                               KEY, 5))


def natural_join(spark, d):
    """O-C6: join on all shared column names."""
    return finalize(J.natural_join(bureau_basic_stats_frame(spark, d),
                                   filtered_frame(spark, d), "inner"))


MODEL_FEATURES = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
                  "CNT_CHILDREN", "CNT_FAM_MEMBERS", "DAYS_BIRTH", "DAYS_EMPLOYED",
                  "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "OWN_CAR_AGE"]


def _model_frame(spark, d):
    """Model columns per client, computed once: the fits and splits read them many times."""
    app = R.application_wide(spark, d)
    cols = [KEY, "label", "weight", "is_test", *MODEL_FEATURES]
    aff = affordability_frame(spark, d).select(KEY, "INCOME_CREDIT_PERC", "ANNUITY_LENGTH")
    return materialize(app.select(*cols).join(aff, KEY, "left"))


FEATS = MODEL_FEATURES + ["INCOME_CREDIT_PERC", "ANNUITY_LENGTH"]


def gbt_cv_scores(spark, d):
    """O-I6..I9, O-I8, O-A7: weighted 5-fold CV of boosted trees, AUC table."""
    mf = _model_frame(spark, d)
    tr = S.stratified_folds(mf.filter(~F.col("is_test")), KEY, "label", 5, 1234)
    table, _ = ML.cross_validate(tr, KEY, FEATS, "label", "weight", "fold", 5,
                                 {"maxIter": 10, "maxDepth": 3})
    return finalize(table)


def gbt_watch_list(spark, d):
    """O-I7: loss and AUC of every fold, set and round, with the round of least
    validation loss."""
    mf = _model_frame(spark, d)
    tr = S.stratified_folds(mf.filter(~F.col("is_test")), KEY, "label", 5, 1234)
    tr = materialize(tr.select(KEY, "label", "weight", "fold", *FEATS))
    models, preps = ML.fit_folds(tr, FEATS, "label", "weight", "fold", 5, {"maxIter": 10, "maxDepth": 3})
    watched = materialize(ML.watch_list(tr, models, preps))
    return finalize(watched.join(ML.stopping_rounds(watched), "fold"))


def model_reload(spark, d):
    """O-A6, O-I9: a saved model gives the same scores after reload, all within 0..1."""
    mf = _model_frame(spark, d)
    tr, te = mf.filter(~F.col("is_test")), mf.filter(F.col("is_test"))
    prep = ML.fit_features(tr, FEATS)
    m = ML.fit_gbt(prep.transform(tr).select("label", "weight", "features"), "label", "weight",
                   {"maxIter": 3, "maxDepth": 3})
    path = shared_dir(spark, "model")
    ML.save_model(m, path)
    d = ML.predict_many([m, ML.load_model(path)], prep.beside(te, "features"))
    return finalize(d.select(KEY, (F.col("ps")[0] == F.col("ps")[1]).cast("int").alias("same"),
                             F.col("ps")[1].between(0, 1).cast("int").alias("in_range")))


def gbt_submission(spark, d):
    """O-I6, O-I9, O-A6, O-I15: final fit on all train rows, save/load, score test."""
    mf = _model_frame(spark, d)
    tr, te = mf.filter(~F.col("is_test")), mf.filter(F.col("is_test"))
    prep = ML.fit_features(tr, FEATS)
    m = ML.fit_gbt(prep.transform(tr).select("label", "weight", "features"), "label", "weight",
                   {"maxIter": 10, "maxDepth": 3})
    path = shared_dir(spark, "model")
    ML.save_model(m, path)
    m2 = ML.load_model(path)
    preds = ML.predict_proba(m2, prep.transform(te), "TARGET", keep=[KEY])
    template = te.select(KEY)
    return finalize(J.merge_template(template, preds, KEY))


def shift_weights(spark, d):
    """O-I10, O-I3, O-G2, O-I11: covariate-shift weights from resampled fits."""
    mf = _model_frame(spark, d)
    tr, te = mf.filter(~F.col("is_test")), mf.filter(F.col("is_test"))
    w = WT.shift_weights(tr, te, KEY, FEATS, n_iter=15, fraction=0.3,
                         params={"maxIter": 10, "maxDepth": 3})
    return finalize(w)


def importance_and_pd(spark, d):
    """O-I12, O-I13, O-F2: split-count ranking, top 3, partial dependence."""
    mf = _model_frame(spark, d).filter(~F.col("is_test"))
    fit, hold = S.holdout_split(mf, KEY, 0.33, 42)
    prep = ML.fit_features(fit, FEATS)
    m = ML.fit_gbt(prep.transform(fit).select("label", "weight", "features"), "label", "weight",
                   {"maxIter": 10, "maxDepth": 3})
    imp = XP.importance_table(spark, m, prep.vector_cols)
    top = [r["feature"] for r in XP.top_k(imp.filter(F.col("feature").isin(FEATS)),
                                          "splits", 3, "feature").collect()]
    return finalize(XP.partial_dependence(m, prep, fit, top, 100))
