"""The driver's Parquet tables cast in the reference's table roles.

The reference reads a credit-risk star schema (applications, bureau credits,
monthly balances, instalments).  The test data is a TPC-H-like schema; this
module maps it onto those roles (see FIXTURES.md, part B) so every operator
runs on the given tables and scales with them.  Column selection is done
here so Parquet scans read only the columns a role needs.

Fixed values of the mapping: reference day ``2001-08-02`` for credit day
offsets, ``2002-01-01`` for month offsets (30-day months), test set =
``client_id % 5 = 0``, label = ``c_acctbal < 0``, row weight =
``1 + (client_id % 4) / 4``, nullable scores blank every 7th / 5th / 3rd
client, days past due = days late - 90, past credit = older than 365 days.
The paid amount is left unrounded (rounding half-way cases differs between
engines and would only add noise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featspark.sources.io import read_parquet

CREDIT_DAY0 = "2001-08-02"
MONTH_DAY0 = "2002-01-01"
DPD_GRACE = 90          # days past due = days late beyond this grace period
PAST_CREDIT_DAYS = -365  # a credit older than this is "past", else "current"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per client: categoricals, label, scores with NULLs, test flag."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bal = F.col("c_acctbal")
    return c.select(
        k.alias("client_id"),
        "c_nationkey", "c_mktsegment", "c_acctbal",
        (bal < 0).cast("int").alias("label"),
        F.when(k % 7 != 0, bal).alias("score_1"),
        F.when(k % 5 != 0, bal).alias("score_2"),
        F.when(k % 3 != 0, bal).alias("score_3"),
        (k % 5 == 0).alias("is_test"),
        (F.lit(1.0) + (k % 4) / F.lit(4.0)).alias("weight"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per external credit (orders)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderkey").alias("credit_id"),
        "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.datediff(F.col("o_orderdate"), F.lit(CREDIT_DAY0).cast("date")).alias("days_credit"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit x month status rows (line items)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("credit_id"),
        F.col("l_returnflag").alias("status"),
        (-F.floor(F.datediff(F.lit(MONTH_DAY0).cast("date"), F.col("l_shipdate")) / F.lit(30)))
        .cast("bigint").alias("months_balance"),
    )


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan x instalment rows: line items with the client of their order."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("client_id"),
        F.col("l_orderkey").alias("loan_id"),
        "l_linenumber",
        F.col("l_extendedprice").alias("amt_due"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amt_paid"),
        F.col("l_quantity").alias("cnt_units"),
        F.col("l_linestatus").alias("status"),
        F.datediff(F.col("l_shipdate"), F.col("o_orderdate")).alias("days_late"),
        (F.datediff(F.col("l_shipdate"), F.col("o_orderdate")) - DPD_GRACE).alias("dpd"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


# Application columns used by the reference's row-wise features, taken from
# the customer row and a per-client aggregate of its orders (fixed mapping).
APP_RATIO_COLS = [
    "CNT_CHILDREN", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
    "DAYS_BIRTH", "DAYS_EMPLOYED", "OWN_CAR_AGE", "CNT_FAM_MEMBERS",
    "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_LAST_PHONE_CHANGE",
]
DOC_FLAGS = ["FLAG_DOCUMENT_2", "FLAG_DOCUMENT_3", "FLAG_DOCUMENT_4"]
ADDRESS_FLAGS = ["REG_REGION_NOT_LIVE_REGION", "REG_CITY_NOT_LIVE_CITY",
                 "LIVE_CITY_NOT_WORK_CITY"]
EMPLOYED_SENTINEL = 365243


def orders_per_client_exprs() -> list:
    """Per-client order aggregates behind the application view (fixed mapping)."""
    return [
        F.sum("o_totalprice").alias("AMT_CREDIT"),
        F.avg("o_totalprice").alias("AMT_ANNUITY"),
        F.max("o_totalprice").alias("AMT_GOODS_PRICE"),
        F.count_if(F.col("o_orderstatus") == "O").alias("CNT_CHILDREN"),
        F.count(F.lit(1)).alias("CNT_FAM_MEMBERS"),
        F.min("days_credit").alias("DAYS_BIRTH"),
        F.max("days_credit").alias("_last"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("_urgent"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("_low"),
        F.count_if(F.col("o_orderstatus") == "F").alias("_done"),
    ]


ORDERS_PER_CLIENT = ["AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_CHILDREN",
                     "CNT_FAM_MEMBERS", "DAYS_BIRTH", "_last", "_urgent", "_low", "_done"]


def application_wide(spark: SparkSession, sf_dir: str, per: DataFrame | None = None
                     ) -> DataFrame:
    """One row per client with the reference's application column names.

    Orders are aggregated per client first, then joined to the customer row
    (aggregate before join).  ``per`` may pass a per-client orders
    aggregate that already holds ``orders_per_client_exprs()`` (so a caller
    computing other per-client order features shares one aggregate).
    Clients whose nation key is 0 carry the ``DAYS_EMPLOYED`` sentinel
    365243; document flags are NULL where the matching score is NULL, so row
    sums see missing values.
    """
    app = application(spark, sf_dir)
    if per is None:
        per = bureau(spark, sf_dir).groupBy("client_id").agg(*orders_per_client_exprs())
    j = app.join(per.select("client_id", *ORDERS_PER_CLIENT), "client_id", "left")
    return j.select(
        "client_id", "label", "is_test", "weight", "c_mktsegment",
        F.col("c_nationkey").cast("string").alias("NATION"),
        F.col("c_acctbal").alias("AMT_INCOME_TOTAL"),
        "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
        "DAYS_BIRTH",
        F.when(F.col("c_nationkey") == 0, F.lit(EMPLOYED_SENTINEL))
         .otherwise(F.col("_last")).alias("DAYS_EMPLOYED"),
        F.col("score_1").alias("EXT_SOURCE_1"),
        F.col("score_2").alias("EXT_SOURCE_2"),
        F.col("score_3").alias("EXT_SOURCE_3"),
        F.col("c_nationkey").alias("OWN_CAR_AGE"),
        (F.col("_last") - F.col("DAYS_BIRTH")).alias("DAYS_LAST_PHONE_CHANGE"),
        F.when(F.col("score_1").isNotNull(), (F.col("_urgent") > 0).cast("int"))
         .alias("FLAG_DOCUMENT_2"),
        F.when(F.col("score_2").isNotNull(), (F.col("_low") > 0).cast("int"))
         .alias("FLAG_DOCUMENT_3"),
        F.when(F.col("score_3").isNotNull(), (F.col("_done") > 0).cast("int"))
         .alias("FLAG_DOCUMENT_4"),
        (F.col("_urgent") > F.col("_low")).cast("int").alias("REG_REGION_NOT_LIVE_REGION"),
        (F.col("_done") > F.col("CNT_CHILDREN")).cast("int").alias("REG_CITY_NOT_LIVE_CITY"),
        (F.col("c_acctbal") < 0).cast("int").alias("LIVE_CITY_NOT_WORK_CITY"),
    )
