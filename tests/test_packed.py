"""Wide statistics in arrays: the same values as in columns, made after all shuffles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featspark.operators import agg as A
from featspark.operators import packed as PK
from tests.conftest import rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def loans(spark, tmp_path):
    rng = np.random.default_rng(8)
    data = [(int(c) if c < 30 else None, int(l), float(v) if v < 8 else None, float(w)) for c, l, v, w in zip(
        np.where(rng.random(900) < 0.3, 0, rng.integers(0, 32, 900)), rng.integers(0, 40, 900),
        rng.integers(0, 10, 900), rng.normal(size=900))]
    spark.createDataFrame(data, "k long, l long, x double, y double").write.parquet(f"{tmp_path}/loans")
    return spark.read.parquet(f"{tmp_path}/loans")


@pytest.mark.parametrize("most", [10**6, 100, 0])
def test_two_level_onto_equals_the_join(spark, monkeypatch, loans, most):
    monkeypatch.setattr(A, "ROWS_IN_PLACE", most)
    # a client without loans, one that comes twice, none at all; loans of clients that are not wanted
    target = spark.createDataFrame([(0, "a", 1.5, 1), (3, "b", None, 2), (3, "c", 2.5, None), (77, "d", 3.5, 4),
                                    (None, "e", 4.5, 5)], "k long, s string, u double, v int")
    values = {"x": F.col("x"), "z": F.col("x") + F.col("y")}
    p = A.two_level_onto(PK.pack(target, ["k"]), loans, "k", "l", values, "_q", 6)
    want = target.join(A.two_level_stats(loans.withColumn("z", values["z"]), "k", "l", ["x", "z"], "_q"), "k", "left")
    got = p.unpack()
    assert got.schema.simpleString() == want.schema.simpleString()
    for a, b in zip(rows(got, ["s"]), rows(want, ["s"])):
        for c, v in b.items():
            assert (v is None) == (a[c] is None), c
            assert v == a[c] or v == pytest.approx(a[c], rel=1e-7, abs=1e-7), c


def _tables(spark, d, clients=40):
    spark.range(clients).selectExpr("id AS c_custkey", "cast(id % 3 AS int) AS c_nationkey", "concat('S', id % 2) AS c_mktsegment",
                                    "cast(id % 7 - 3 AS double) AS c_acctbal").write.parquet(f"{d}/customer.parquet")
    spark.range(4 * clients).selectExpr(
        "id AS o_orderkey", f"id % {clients - 3} AS o_custkey", "IF(id % 2 = 0, 'F', 'O') AS o_orderstatus",
        "IF(id % 3 = 0, '1-URGENT', '5-LOW') AS o_orderpriority", "cast(100 + id % 13 AS double) AS o_totalprice",
        "timestamp '2000-01-01' + make_dt_interval(cast(id % 50 AS int)) AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.range(13 * clients).selectExpr(
        f"id % {4 * clients - 5} AS l_orderkey", "cast(id % 7 AS int) AS l_linenumber", "cast(1 + id % 11 AS double) AS l_quantity",
        "cast(id % 17 * 10 AS double) AS l_extendedprice", "(id % 5) / 100D AS l_discount", "0.01D AS l_tax",
        "IF(id % 3 = 0, 'R', 'N') AS l_returnflag", "IF(id % 2 = 0, 'F', 'O') AS l_linestatus",
        "timestamp '2000-03-01' + make_dt_interval(cast(id % 90 AS int)) AS l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    return str(d)


def above_statistics(df):
    """The part of the plan that reads the two-level statistics."""
    plan = plan_of(df)
    assert "MapInArrow" in plan
    return plan[:plan.rindex("MapInArrow")]


def test_wide_features_are_not_shuffled(spark, tmp_path):
    from featspark.plans import features as FT
    df = FT.client_feature_table(spark, _tables(spark, tmp_path))
    assert not any(x in above_statistics(df) for x in ("Exchange", "Sort", "Join", "Window")) and df.count() == 40


def test_shuffle_files_go_with_the_write(spark):
    from featspark.session import CLEANUP, written
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = manager.shuffleStatuses().size()
    t = written(spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count(), "few")
    assert t.count() == 10 and manager.shuffleStatuses().size() <= before + 1  # the count's own
    assert spark.conf.get(CLEANUP) == "false"


def test_both_sets_are_written_in_one_pass(spark, tmp_path, monkeypatch):
    from featspark.plans import features as FT
    seen, written = {}, FT.written
    monkeypatch.setattr(FT, "written", lambda df, what, **more: seen.update({what: above_statistics(df)}) or written(df, what, **more))
    df = FT.train_test_assembly(spark, _tables(spark, tmp_path))
    assert list(seen) == ["modified"] and not any(x in seen["modified"] for x in ("Exchange", "Sort", "Join", "Window"))
    assert {r["is_test"]: r["n"] for r in df.groupBy("is_test").agg(F.count("*").alias("n")).collect()} == {0: 32, 1: 8}
    assert df.filter("is_test = 0 AND (fold IS NULL OR Weights IS NULL OR TARGET IS NULL)").count() == 0
    assert df.filter("is_test = 1 AND (fold IS NOT NULL OR Weights IS NOT NULL OR TARGET IS NOT NULL)").count() == 0


def test_assembly_without_test_clients(spark, tmp_path):
    from featspark.plans import features as FT
    d = _tables(spark, tmp_path)
    spark.read.parquet(f"{d}/customer.parquet").filter("c_custkey % 5 <> 0").write.parquet(f"{d}/few.parquet")
    (tmp_path / "customer.parquet").rename(tmp_path / "all.parquet")
    (tmp_path / "few.parquet").rename(tmp_path / "customer.parquet")
    df = FT.train_test_assembly(spark, d)
    assert df.filter("is_test = 0").count() == df.count() == 32


@pytest.fixture()
def wide(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(1, 0.5, 1.0, None, 4, None), (2, None, inf, None, None, 2), (3, 1.5, nan, None, 6, 7),
                                (4, 2.5, -inf, None, 2**40, None)], "k long, own double, a double, `b.c` double, n long, m int")
    p = PK.pack(df, ["k", "own"])
    clean = df.withColumn("a", F.lit(None).cast("double")).withColumn("a", F.when(F.col("k") == 1, 1.0))
    return PK.Packed(p.df, p.at, df.columns, finite=True), clean


def test_packed_columns_come_back(wide):
    p, clean = wide
    assert p.schema.simpleString() == p.unpack().schema.simpleString() == clean.schema.simpleString()
    assert rows(p.unpack(), ["k"]) == rows(clean, ["k"])
    assert p.select("m", "k").unpack().columns == ["m", "k"] and p.drop("m", "n").columns == ["k", "own", "a", "b.c"]


def test_preparation_of_arrays_equals_that_of_columns(wide):
    from featspark.operators import model as ML
    p, clean = wide
    names = ["m", "own", "a", "n"]
    one, two = ML.fit_features(p, names, "mean"), ML.fit_features(clean, names, "mean")
    assert one.vector_cols == two.vector_cols and one.fill == pytest.approx(two.fill)
    for a, b in zip(rows(one.transform(p), ["k"]), rows(two.transform(clean), ["k"])):
        assert a["features"].toArray().tolist() == pytest.approx(b["features"].toArray().tolist())
    assert PK.means_and_nulls(p, ["b.c", "a"]) == {"b.c": (None, 4), "a": (1.0, 3)}
    assert PK.means_and_nulls(p.filter("k > 9"), ["a"]) == {"a": (None, 0)}


def test_median_preparation_of_arrays(wide):
    from featspark.operators import model as ML
    p, clean = wide
    names = ["own", "a", "n"]
    assert ML.fit_features(p, names).fill == ML.fit_features(clean, names).fill


def test_chain_keeps_its_wide_table_in_arrays(spark, tmp_path, monkeypatch):
    from featspark.plans import chain as CH
    written = []
    monkeypatch.setattr(CH, "written", lambda df, what: written.append(what))
    t = CH.engineered(spark, _tables(spark, tmp_path))
    assert len(t.columns) > 1000 and len(t.df.columns) < 20 and not written
    plan = plan_of(t.df)
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and t.df.count() == 40
    few = t.select("score_1_trmedian", "na", "cnt_units_Mode_max_installments").unpack()
    assert few.filter("score_1_trmedian IS NULL").count() == 0 and few.count() == 40


def test_settings_come_back_and_tasks_follow_rows(spark):
    from featspark import session as S
    spark.conf.set(S.ARROW, "300")
    try:
        assert S.batches(spark) == {S.ARROW: "300"}
        with S.settings(spark, {S.ARROW: "7", "spark.sql.some.thing": "x"}):
            assert spark.conf.get(S.ARROW) == "7" and spark.conf.get("spark.sql.some.thing") == "x"
        assert spark.conf.get(S.ARROW) == "300" and spark.conf.get("spark.sql.some.thing", None) is None
    finally:
        spark.conf.unset(S.ARROW)
    assert S.batches(spark) == {S.ARROW: str(S.BATCH)}
    assert S.in_tasks(spark.range(0, 1000, 1, 50), 100).rdd.getNumPartitions() == 10
    assert S.in_tasks(spark.range(0, 10, 1, 50), 100).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
