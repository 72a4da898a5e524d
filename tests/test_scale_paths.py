"""Operators whose plan depends on sizes, each way against the other or brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featspark.operators import agg as A
from featspark.operators import comoments as CM
from featspark.operators import encode as E
from featspark.operators import joins as J
from featspark.operators import metrics as M
from featspark.operators import model as ML
from featspark.operators import split as S
from featspark.operators import windows as W
from featspark.operators.ranking import PIECE
from featspark.session import shared_dir
from featspark.sources import io as IO


def plan_of(df):
    return df._jdf.queryExecution().toString()


def rows_of(df):
    return sorted([tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect()], key=repr)


@pytest.fixture
def many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


# --- row-level windows

@pytest.fixture
def credits(spark):
    """A client with a third of all rows, ties, NULLs, single rows and a NULL client."""
    rows = [(1, (i * 37) % 500, i) for i in range(400)] + [(c, -c * i, i) for c in range(2, 80) for i in range(c % 11)]
    rows += [(90, None, 1), (90, None, 2), (91, 5, 1), (91, 5, 2), (91, None, 3), (92, 7, 1), (None, 3, 1), (None, 9, 2)]
    return spark.createDataFrame(rows, "client long, day long, id long")


def test_gap_rows_against_pandas(credits, many_partitions):
    got = W.gap_rows(credits, "client", "day", ["id"])
    want = []
    for client, g in credits.toPandas().astype(object).groupby("client", dropna=False):
        g = [(None if pd.isna(d) else int(d), int(i)) for d, i in zip(g.day, g.id)]
        g.sort(key=lambda r: (r[0] is None, -(r[0] or 0), -r[1]))
        gaps = [None if a[0] is None or b[0] is None else a[0] - b[0] for a, b in zip(g, g[1:])] + [None]
        known = [x for x in gaps if x is not None]
        mean = float(np.mean(known)) if known else None
        sd = float(np.std(known, ddof=1)) if len(known) > 1 else None
        for k, (d, i) in enumerate(g):
            last = k == len(g) - 1
            want.append((None if pd.isna(client) else int(client), i, d, int(last), None if last else g[k + 1][0], gaps[k], mean, sd))
    cols = ["client", "id", "day", "first_record", "next_value", "gap", "Avg_Time_Btwn_Credit", "SDev_Time_Btwn_Cred"]
    got = {r[:2]: r[2:] for r in rows_of(got.select(*cols))}
    assert len(got) == len(want)
    for w in want:
        g = got[w[:2]]
        assert g[:4] == w[2:6]
        for a, b in zip(g[4:], w[6:]):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9))


def test_a_large_client_spans_partitions(credits, many_partitions):
    pieces = W.ordered_pieces(credits, "client", ["day", "id"])
    assert pieces.filter("client = 1").select(PIECE).distinct().count() >= 3


# --- two levels

def test_two_level_in_place_equals_the_path_for_large_keys(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(int(c), int(l), float(v) if v < 8 else None, float(w)) for c, l, v, w in zip(
        np.where(rng.random(900) < 0.34, 0, rng.integers(0, 30, 900)), rng.integers(0, 40, 900),
        rng.integers(0, 10, 900), rng.normal(size=900))] + [(None, 1, 2.0, 3.0), (7, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "c long, l long, x double, y double")
    frames = []
    for most in (10**6, 200, 0):  # all in place, the large client apart, all apart
        monkeypatch.setattr(A, "ROWS_IN_PLACE", most)
        t = A.two_level_stats(df, "c", "l", ["x", "y"], "_s")
        frames.append({r["c"]: r.asDict() for r in t.collect()})
    assert set(frames[0]) == set(frames[1]) == set(frames[2]) and len(frames[0]) == 31
    for key, row in frames[0].items():
        for other in frames[1:]:
            for name, v in row.items():
                assert (v is None) == (other[key][name] is None), (key, name)
                assert v is None or v == pytest.approx(other[key][name], rel=1e-7, abs=1e-7), (key, name)


def test_two_level_moves_rows_once(spark):
    df = spark.range(100).selectExpr("id % 7 AS c", "id % 20 AS l", "cast(id % 5 AS double) AS x")
    t = A.two_level_stats(df, "c", "l", ["x"], "_s")
    t.collect()
    final = plan_of(t).split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    assert final.count("Exchange") == final.count("Exchange hashpartitioning(c") == 1


# --- label codes

def test_codes_by_value_equal_broadcast_codes(spark, monkeypatch):
    values = ["hot"] * 500 + [f"v{i % 40}" for i in range(200)] + [None] * 300 + [""] * 3
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, s string")
    codes = E.fit_label_codes(df.filter("s IS NULL OR s <> 'v3'"), ["s"])
    small = E.label_encode(df, codes, ["s"])
    want = rows_of(small)
    assert "hashpartitioning(s" not in plan_of(small) and [r[1] for r in want if r[0] == 0] == [2]
    monkeypatch.setattr(E, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(E, "FREQUENT", 5)
    assert rows_of(E.label_encode(df, codes, ["s"])) == want


# --- exact samples

def test_samples_have_exact_sizes(spark):
    df = spark.range(1003).select(F.col("id").alias("k"))
    fit, hold = S.holdout_split(df, "k", 0.33, 42)
    assert hold.count() == math.ceil(0.33 * 1003) and fit.count() + hold.count() == 1003
    assert fit.join(hold, "k").count() == 0
    all_ = S.repeated_subsamples(df, "k", 0.3, 4, 7)
    sizes = {r["iteration"]: r["count"] for r in all_.groupBy("iteration").count().collect()}
    assert sizes == dict.fromkeys(range(4), round(0.3 * 1003))
    cuts = S.resample_cuts(df, "k", 0.3, 4, 7)
    for i in range(4):
        assert rows_of(S.subsample(df, "k", i, cuts, 7)) == rows_of(all_.filter(F.col("iteration") == i).select("k"))
    assert all_.select("k").distinct().count() > 700  # the four differ
    empty = S.holdout_split(df.filter("false"), "k")
    assert [x.count() for x in empty] == [0, 0]


def test_samples_of_equal_keys_have_exact_sizes(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"))
    assert S.repeated_subsamples(df, "k", 0.3, 2).groupBy("iteration").count().select("count").collect() == [(30,), (30,)]


# --- correlations

def test_corr_all_against_pandas(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 9)) @ rng.normal(size=(9, 9)) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7], x[:, 8] = 3.5, np.nan
    x[5, 0] = np.inf
    frame = pd.DataFrame(x, columns=[f"a{i}" for i in range(9)])
    df = spark.createDataFrame(frame).repartition(13)
    want = frame.replace(np.inf, np.nan).corr()
    for block, fan in ((256, 32), (4, 2)):
        monkeypatch.setattr(CM, "BLOCK", block)
        monkeypatch.setattr(CM, "FAN", fan)
        got = {(r.var1, r.var2): (r.n_both, r.corr) for r in CM.corr_all(df, frame.columns).collect()}
        assert len(got) == 81
        for (a, b), (n, c) in got.items():
            assert n == (np.isfinite(frame[a]) & np.isfinite(frame[b])).sum()
            assert (c is None) == bool(np.isnan(want.loc[a, b])), (a, b)
            assert c is None or c == pytest.approx(want.loc[a, b], abs=1e-9)


# --- guard

def test_attach_fails_on_a_repeated_key_when_it_runs(spark):
    spine = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    good = spark.createDataFrame([(1, 5), (None, 6), (None, 7)], "k long, v long")
    assert J.attach(spine, [good], "k", verify="run").count() == 3
    bad = J.attach(spine, [good, good.filter("k = 1").unionByName(good)], "k", verify="run")
    with pytest.raises(Exception, match="duplicate key k = 1 in feature frame 1"):
        bad.collect()


# --- models

@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        a, b = rng.normal(), rng.normal()
        rows.append((i, float(a) if i % 9 else None, float(b), int(a + b + 0.3 * rng.normal() > 0), 1.0 + i % 3, 1 + i % 3))
    df = spark.createDataFrame(rows, "k long, a double, b double, label int, weight double, fold int").cache()
    models, preps = ML.fit_folds(df, ["a", "b"], "label", "weight", "fold", 3, {"maxIter": 6, "maxDepth": 2})
    return df, models, preps


def test_watch_list_per_round(spark, scored):
    df, models, preps = scored
    got = {(r.fold, r.set, r.round): r for r in ML.watch_list(df, models, preps).collect()}
    assert set(got) == {(f, s, r) for f in (1, 2, 3) for s in ("train", "valid") for r in range(1, 7)}
    for f, m in models.items():
        x = preps[f].transform(df).withColumn("label", F.col("label").cast("double"))
        # the learner's own loss is twice the log-loss, by its weight column
        for name, part in (("valid", x.filter(F.col("fold") == f)), ("train", x.filter(F.col("fold") != f))):
            own = ML.loss_per_round(m, part)
            assert [2 * got[f, name, r].loss for r in range(1, 7)] == pytest.approx(own, rel=1e-9)
        valid = x.filter(F.col("fold") == f)
        auc = M.weighted_auc(ML.predict_proba(m, valid, keep=["label", "weight"]), "label", "p", "weight").first().auc
        assert got[f, "valid", 6].auc == pytest.approx(auc, abs=1e-9) and got[f, "valid", 6].n_rows == 200


def test_stopping_round(spark):
    losses = {1: [5, 4, 3, 3.5, 3.6, 3.7, 1], 2: [5, 4, 3, 2, 1, 0.5, 0.4]}
    rows = [(f, s, i + 1, v if s == "valid" else 0.0) for f, x in losses.items() for i, v in enumerate(x) for s in ("valid", "train")]
    d = spark.createDataFrame([(f, s, r, float(v)) for f, s, r, v in rows], "fold int, set string, round int, loss double")
    assert rows_of(ML.stopping_rounds(d, 3)) == [(1, 3, True), (2, 7, False)]


def test_many_models_on_one_scan(spark, scored):
    df, models, preps = scored
    d = df
    for f, p in preps.items():
        d = p.beside(d, f"x{f}")
    d = ML.predict_many(list(models.values()), d, "ps", [f"x{f}" for f in models])
    got = {r.k: r.ps for r in d.collect()}
    for i, (f, m) in enumerate(models.items()):
        for r in ML.predict_proba(m, preps[f].transform(df), keep=["k"]).collect():
            assert got[r.k][i] == pytest.approx(r.p, abs=1e-12)
    assert plan_of(d).split("== Physical")[-1].count("Scan") <= 2


# --- metric log, CSV

def test_metric_log_holds_a_run_once(spark):
    path = shared_dir(spark, "log")
    a = spark.createDataFrame([("fold_1", 0.5), ("fold_2", 0.75)], "Fold_Name string, auc double")
    for table, run in ((a, "1"), (a, "2"), (a.limit(1), "1"), (a, "2")):
        M.log_metrics(table, path, run)
    got = rows_of(M.read_metrics(spark, path).select("run", "Fold_Name", "auc"))
    assert got == [("1", "fold_1", 0.5), ("2", "fold_1", 0.5), ("2", "fold_2", 0.75)]


def test_csv_types_are_inferred(spark, tmp_path):
    text = ('"",i,d,s,b,none,late,near\n'
            "1,1,1,x,TRUE,NA,1,1\n2,NA,2.5,,F,,2,2\n3,-7,1e3,NA,NA,NA,3,2\n4,,NA,12,T,NA,x,4\n")
    (tmp_path / "t.csv").write_text(text)
    df = IO.read_csv_inferred(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"i": "bigint", "d": "double", "s": "string", "b": "boolean", "none": "boolean",
                               "late": "string", "near": "bigint"}
    assert [tuple(r) for r in df.select("i", "d", "s", "b").collect()] == [
        (1, 1.0, "x", True), (None, 2.5, "", False), (-7, 1000.0, None, None), (None, None, "12", True)]
    # a column of that name with a gap is data
    (tmp_path / "u.csv").write_text("X,v\n1,a\n3,b\n")
    assert IO.read_csv_inferred(spark, str(tmp_path / "u.csv")).columns == ["X", "v"]


def test_csv_with_index_comes_back(spark):
    rows = [(i, "" if i % 3 == 0 else None if i % 3 == 1 else "w", None if i % 4 == 0 else i / 8) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, s string, v double")
    path = shared_dir(spark, "csv")
    IO.write_csv(IO.with_row_index(df, "k"), path, na_token="NA")
    back = IO.read_csv_inferred(spark, path)
    assert back.columns == ["k", "s", "v"] and rows_of(back) == rows_of(df)


# --- memory of one task: partitions by row count

def test_two_level_partitions_follow_the_rows(spark, monkeypatch):
    from featspark import session
    monkeypatch.setattr(session.tasks_for, "__defaults__", (100,))
    df = spark.range(2000).selectExpr("id % 97 AS c", "id % 400 AS l", "cast(id % 5 AS double) AS x")
    t = A.two_level_stats(df, "c", "l", ["x"], "_s")
    assert "hashpartitioning(c" in plan_of(t) and ", 20)" in plan_of(t) and "Window" not in plan_of(t)
    m = A.mode_then_stats(df, "c", "l", "x", "M", "_s")
    assert ", 20)" in plan_of(m) and m.count() == 97


def test_two_level_chunks_keep_keys_whole(spark, monkeypatch):
    import pyarrow as pa

    from featspark.operators import twolevel as TL
    rng = np.random.default_rng(2)
    keys = np.sort(rng.integers(0, 12, 400)).tolist()
    keys = [None] * 90 + keys + [12] * 200  # a key that fills many batches, and no key at all
    t = pa.table({"k": pa.array(keys, pa.int64()), "v": range(len(keys))})
    monkeypatch.setattr(TL, "CHUNK", 50)
    for size in (1, 7, 64, 1000):
        chunks = list(TL.whole_keys(iter(t.to_batches(max_chunksize=size)), "k"))
        assert [v for c in chunks for v in c["v"].to_pylist()] == list(range(len(keys)))
        seen = [k for c in chunks for k in set(c["k"].to_pylist())]
        assert len(seen) == len(set(seen)) == 14 and len(chunks) > 1 or size == 1000


def test_grouped_stats_count_nan_as_the_largest_value():
    from featspark.operators.twolevel import grouped_stats
    x = np.array([np.nan, 1.0, np.nan, 0.0, 5.0])
    got = grouped_stats(x, np.array([True, True, True, False, True]), np.array([0, 0, 0, 1, 2]), 3,
                        ["Mode", "min", "max", "n_distinct", "sum", "sd", "n_null"])
    mode, least, most, distinct, total, sd, nulls = got
    assert np.isnan(mode[0][0]) and least[0][0] == 1.0 and np.isnan(most[0][0]) and distinct[0].tolist() == [2, 0, 1]
    assert mode[1].tolist() == [True, False, True] and sd[1].tolist() == [True, False, False]
    assert total[0][1] == 0 and total[1].all() and nulls[0].tolist() == [0, 1, 0]


def test_wide_frames_are_rounded_like_narrow_ones(spark, monkeypatch):
    from featspark.plans import common
    values = [None, 0.0, -0.00005, 0.00005, 2.00005, -3.14159265, 1e8 + 0.005, 123456789.126, 4e10 + 0.5, -7.5e15, 1e300,
              float("inf"), float("nan")]
    df = spark.createDataFrame([(i, f"t{i}", v, None if v is None else -v) for i, v in enumerate(values)],
                               "id int, t string, `a.b` double, c double")
    want = common.finalize(df)
    monkeypatch.setattr(common, "WIDE", 1)
    got = common.finalize(df)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert [str(r) for r in got.orderBy("id").collect()] == [str(r) for r in want.orderBy("id").collect()]
    assert got.filter("`a.b` = 2.0001").count() == 1


def test_attach_partitions_by_the_given_number(spark):
    from featspark.operators import joins as J
    spine = spark.range(50).withColumnRenamed("id", "k")
    out = J.attach(spine, [spine.selectExpr("k", "k * 2 AS x")], "k", verify="run", tasks=9)
    assert "hashpartitioning(k" in plan_of(out) and ", 9)" in plan_of(out) and out.filter("x = 2 * k").count() == 50


def test_model_frame_is_computed_once(spark, tmp_path):
    from featspark.plans import queries as Q
    spark.range(20).selectExpr("id AS c_custkey", "cast(id % 3 AS int) AS c_nationkey", "'A' AS c_mktsegment",
                               "cast(id - 5 AS double) AS c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(60).selectExpr("id AS o_orderkey", "id % 18 AS o_custkey", "'F' AS o_orderstatus", "'5-LOW' AS o_orderpriority",
                               "cast(id AS double) AS o_totalprice", "timestamp '2000-01-01' AS o_orderdate"
                               ).write.parquet(f"{tmp_path}/orders.parquet")
    mf = Q._model_frame(spark, str(tmp_path))
    assert mf.count() == 20 and "Join" not in plan_of(mf) and "FileScan" not in plan_of(mf)
