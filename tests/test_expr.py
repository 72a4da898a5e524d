import math

from pyspark.sql import functions as F

from featspark.functions import expr as X
from featspark.functions.names import clean_token, sanitize_names


def test_null_aware_scalars(spark):
    df = spark.createDataFrame([(1, 4.0, 0.0, -1.0), (2, None, 2.0, 9.0)],
                               "id int, a double, b double, c double")
    r = {x["id"]: x for x in df.select(
        "id", X.ratio("a", "b").alias("r"), X.safe_sqrt("c").alias("s"),
        X.sentinel_to_null(F.col("c"), 9.0).alias("n")).collect()}
    assert r[1]["r"] is None            # x / 0 -> NULL, not Inf
    assert r[2]["r"] is None            # NULL numerator
    assert r[1]["s"] is None            # sqrt(<0) -> NULL, not NaN
    assert r[2]["s"] == 3.0
    assert r[2]["n"] is None and r[1]["n"] == -1.0


def test_contagious_row_ops(spark):
    df = spark.createDataFrame([(1, 1, 0, 1), (2, 1, None, 1)], "id int, a int, b int, c int")
    r = {x["id"]: x for x in df.select(
        "id", X.contagious_sum(["a", "b", "c"]).alias("s"),
        X.contagious_max(["a", "b", "c"]).alias("mx"),
        X.null_count(["a", "b", "c"]).alias("na")).collect()}
    assert r[1]["s"] == 2 and r[2]["s"] is None
    assert r[1]["mx"] == 1 and r[2]["mx"] is None
    assert r[1]["na"] == 0 and r[2]["na"] == 1


def test_row_mean_sd_skip_nulls(spark):
    data = [(0, 0.2, 0.4, 0.9), (1, None, 0.5, 0.7), (2, None, None, 0.3), (3, None, None, None)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double")
    r = {x["id"]: x for x in df.select(
        "id", X.row_mean_skipna(["a", "b", "c"]).alias("m"),
        X.row_sd_skipna(["a", "b", "c"]).alias("s")).collect()}
    assert math.isclose(r[0]["m"], 0.5)
    assert math.isclose(r[0]["s"], 0.36055512754639896)
    assert math.isclose(r[1]["s"], 0.1414213562373095)
    assert r[2]["m"] == 0.3 and r[2]["s"] is None     # one value: sd NULL
    assert r[3]["m"] is None and r[3]["s"] is None     # no value


def test_bucket_null_falls_to_default(spark):
    df = spark.createDataFrame([(1, -10.0), (2, -100.0), (3, None), (4, -1000.0)],
                               "id int, d double")
    edges = [("1Q", -90, None), ("2Q", -180, -90)]
    r = {x["id"]: x["b"] for x in df.select("id", X.bucket("d", edges, "GT").alias("b")).collect()}
    assert r == {1: "1Q", 2: "2Q", 3: "GT", 4: "GT"}


def test_stable_round_ties_and_magnitudes(spark):
    df = spark.createDataFrame([(0.00125,), (160954.70375,), (977349204638.0738,), (-2.5e-5,)],
                               "x double")
    got = [r[0] for r in df.select(X.stable_round("x", 4)).collect()]
    assert got[0] == 0.0013 and got[1] == 160954.7038
    assert got[2] == 977349204638.0        # 0 places at this magnitude
    assert got[3] == 0.0


def test_names():
    assert clean_token("4-NOT SPECIFIED") == "4_NOTSPECIFIED"
    assert clean_token(None) == "NA" and clean_token("") == ""
    assert sanitize_names(["a_x", "A_x", "b"]) == ["a_x", "A_x_2", "b"]


def test_replace_inf_and_pair_ratios(spark):
    df = spark.createDataFrame([(float("inf"), 2.0), (float("-inf"), 0.0), (3.0, 4.0)],
                               "a double, b double")
    got = [r[0] for r in df.select(X.replace_inf("a", 0.0)).collect()]
    assert got == [0.0, 0.0, 3.0]
    pr = df.select(*X.all_pair_ratios(["a", "b"]))
    assert pr.columns == ["a_b", "b_a"]
