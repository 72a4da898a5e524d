"""CSV/Parquet I/O rules and plan-time column handling."""

import pytest
from pyspark.sql import functions as F

from featspark.operators import columns as C
from featspark.session import shared_dir
from featspark.sources import io as IO


def test_csv_na_rule_and_index(spark):
    path = shared_dir(spark, "csvtest")
    df = spark.createDataFrame([(1, "Cash loans", 1.5), (2, None, None), (3, "", 2.0)],
                               "SK_ID_CURR long, NAME_CONTRACT_TYPE string, AMT double")
    IO.write_csv(df, path)
    back = IO.read_csv(spark, path, "SK_ID_CURR long, NAME_CONTRACT_TYPE string, AMT double")
    r = {x["SK_ID_CURR"]: x for x in back.collect()}
    assert r[1]["NAME_CONTRACT_TYPE"] == "Cash loans" and r[1]["AMT"] == 1.5
    assert r[2]["AMT"] is None
    assert r[3]["NAME_CONTRACT_TYPE"] == ""          # blank string is a category
    assert r[2]["NAME_CONTRACT_TYPE"] == ""          # documented: NA and blank merge
    # a serialised row index column is dropped on read
    idx = shared_dir(spark, "csvidx")
    df.withColumn("Unnamed: 0", F.col("SK_ID_CURR") - 1).select(
        "Unnamed: 0", "SK_ID_CURR", "AMT").write.option("header", True).csv(idx)
    assert IO.read_csv(spark, idx).columns == ["SK_ID_CURR", "AMT"]


def test_manifest_and_preview(spark):
    df = spark.createDataFrame([(3, 1.0), (1, 2.0), (2, 3.0)], "SK_ID_CURR long, X double")
    m = [tuple(r) for r in IO.schema_manifest(df).collect()]
    assert m == [(1, "SK_ID_CURR", "bigint"), (2, "X", "double")]
    assert [r[0] for r in IO.preview(df, "SK_ID_CURR", 2).collect()] == [1, 2]


def test_train_test_alignment(spark):
    tr = spark.createDataFrame([(1, 0, 1.0, 5)], "SK_ID_CURR long, TARGET int, A double, B int")
    te = spark.createDataFrame([(2, 2.0, 7, 9)], "SK_ID_CURR long, A double, B int, Z int")
    with pytest.raises(C.SchemaMismatch):
        C.align_train_test(tr, te, train_only=["TARGET"])
    a, b = C.align_train_test(tr, te, train_only=["TARGET"], strict=False)
    assert a.columns == ["SK_ID_CURR", "A", "B", "TARGET"] and b.columns == ["SK_ID_CURR", "A", "B"]
    with pytest.raises(C.SchemaMismatch):
        C.align_train_test(tr, te, required=["MISSING"])
    assert C.select_matching(tr, r"^[AB]$", keep=["SK_ID_CURR"]).columns == ["SK_ID_CURR", "A", "B"]
    assert C.names_matching(["FLAG_DOCUMENT_2", "FLAG_OWN_CAR", "X"], include="FLAG_DOCUMENT_") \
        == ["FLAG_DOCUMENT_2"]
    assert C.columns_of_type(tr, "numeric") == ["SK_ID_CURR", "TARGET", "A", "B"]
    assert C.add_suffix(tr, "_app", exclude=["SK_ID_CURR"]).columns[1] == "TARGET_app"
