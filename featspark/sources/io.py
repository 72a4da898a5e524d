"""Readers and writers (O-A1..A8).

CSV is read with an explicit schema (no inference pass over 100 TB) and the
reference's missing-value rules: the token ``NA`` is NULL in numeric columns;
a blank string field is the category ``''`` (not missing), a blank numeric
field is NULL.  With an explicit schema Spark's CSV reader cannot tell a blank from ``NA`` in a
string column, so both become ``''`` there (documented deviation);
``read_csv_inferred`` keeps them apart.
Parquet is the default sink; CSV is written without a row index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             na_token: str = "NA", drop_index: Sequence[str] = ("", "X", "Unnamed: 0"),
             blank_string_is_category: bool = True) -> DataFrame:
    """CSV with header and explicit schema (O-A1, O-A2); without one, ``read_csv_inferred``."""
    if schema is None:
        return read_csv_inferred(spark, path, na_token, drop_index)
    df = spark.read.option("header", True).option("nullValue", na_token).schema(schema).csv(path)
    df = df.drop(*[c for c in drop_index if c in df.columns])
    if blank_string_is_category:
        df = df.withColumns({f.name: F.coalesce(F.col(f.name), F.lit(""))
                             for f in df.schema.fields if isinstance(f.dataType, T.StringType)})
    return df


#: Types from the narrowest on; a column gets the first that all its values fit.
_FITS = [("boolean", r"^(?i:true|false|t|f)$"), ("bigint", r"^[+-]?[0-9]{1,18}$"),
         ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity|nan)$")]


def infer_types(raw: DataFrame, na_token: str = "NA") -> dict[str, str]:
    """Type of every column of a frame of strings, in one pass over all rows.

    Missing are the NA token and blanks (NULL or empty); of a column with text,
    blanks are a value of their own.  A column with nothing but missing is boolean,
    as in R.  Mixed columns get the narrowest type that fits all values.
    """
    aggs = []
    for i, c in enumerate(raw.columns):
        v = F.trim(F.col(c))
        there = v.isNotNull() & (v != "") & (v != na_token)
        aggs += [F.count_if(there).alias(f"n{i}"), *[F.count_if(there & v.rlike(p)).alias(f"n{i}_{t}") for t, p in _FITS]]
    r = raw.agg(*aggs).first()
    return {c: next((t for t, _ in _FITS if r[f"n{i}_{t}"] == r[f"n{i}"]), "string") for i, c in enumerate(raw.columns)}


def is_row_index(df: DataFrame, col: str) -> bool:
    """Whether the integers of ``col`` are 0..n-1 or 1..n, each once, in any order:
    the sum of their hashes is that of the sequence."""
    total = F.sum(F.xxhash64("x").cast("decimal(38,0)"))
    n, low, high, got = df.select(F.col(col).alias("x")).agg(F.count(F.lit(1)), F.min("x"), F.max("x"), total).first()
    if not n or low not in (0, 1) or high != low + n - 1:
        return False
    return df.sparkSession.range(low, high + 1).select(F.col("id").alias("x")).agg(total).first()[0] == got


def read_csv_inferred(spark: SparkSession, path: str, na_token: str = "NA",
                      index_names: Sequence[str] = ("", "_c0", "X", "Unnamed: 0")) -> DataFrame:
    """CSV with header and types inferred from all rows (O-A1), without the row
    index that other programs write (O-A2): a column of one of these names is dropped
    if it numbers the rows without gaps.

    The file is read as strings, where a blank is NULL and the NA token is itself, so the
    two stay apart: in a string column a blank is the category '' and NA is NULL.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    types, out = infer_types(raw, na_token), []
    for c, t in types.items():
        v = F.trim(F.col(c))
        if t == "string":
            out.append(F.when(F.coalesce(F.col(c), F.lit("")) != na_token, F.coalesce(F.col(c), F.lit(""))).alias(c))
        elif t == "boolean":
            out.append(F.when(F.lower(v).isin("true", "t"), True).when(F.lower(v).isin("false", "f"), False).alias(c))
        else:
            out.append(F.when((v != "") & (v != na_token), v).try_cast(t).alias(c))
    df = raw.select(*out)
    index = [c for c in df.columns if c in index_names and types[c] == "bigint" and is_row_index(df, c)]
    return df.drop(*index)


def with_row_index(df: DataFrame, order_col: str, name: str = "Unnamed: 0") -> DataFrame:
    """``df`` behind a column 0, 1, 2, ... in the order of ``order_col``."""
    from featspark.operators.ranking import row_number_in_groups
    d = row_number_in_groups(df, [], [order_col], name)
    return d.select((F.col(name) - 1).alias(name), *df.columns)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; its splits follow the session's ``spark.sql.files.*`` settings."""
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", na_token: str = "") -> None:
    """CSV with header, no row index (O-A3, O-A4); NULL as ``na_token``, '' as a blank."""
    w = df.write.mode(mode).option("header", True)
    if na_token:
        w = w.option("nullValue", na_token).option("emptyValue", "")
    w.csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def schema_manifest(df: DataFrame) -> DataFrame:
    """(position, name, dtype) of every output column (O-A5)."""
    spark = df.sparkSession
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, dtype string")


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by key (O-A8, O-F3): a top-n, not a full sort."""
    return df.orderBy(key).limit(n)
