"""Ordered running sums and row numbers without a one-task window.

A window ordered over a whole table (or over a 2-valued label) runs in one
task.  Here rows are range-partitioned by (group, order): Spark's own split
points cut a large group into as many partitions as its share of the rows
asks for, and small groups share one.  A *piece* is what one partition holds
of one group.  Only the first and the last group of a partition can go on in
another, so at most two pieces per partition belong to a group that spans
partitions: their totals (``spanning``) are a table of no more than twice the
number of partitions whatever the data, and that is what is broadcast.  No
number of groups or ranges is fixed, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = "_p"


def _key(group_cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in group_cols]) if group_cols else F.struct(F.lit(0).alias("all"))


def range_pieces(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned by (group, order), the partition number in ``_p``.

    Written once (``session.written``): the split points come from a sample,
    and several steps must see the same ones.
    """
    from featspark.session import written
    d = df.repartitionByRange(*group_cols, *order_cols)
    return written(d.withColumn(PIECE, F.spark_partition_id()), "pieces")


def with_spanning(d: DataFrame, group_cols: Sequence[str], sums: dict[str, Column],
                  tops: dict[str, Column] | None = None) -> DataFrame:
    """Adds to the rows of groups that span partitions (NULL for all others),
    per entry of ``sums``: ``<name>_before``, the sum over the group's earlier
    pieces, and ``<name>_all``, the sum over all; per entry of ``tops`` the
    maximum ``<name>_all``.
    """
    tops = tops or {}
    ends = d.groupBy(PIECE).agg(F.min(_key(group_cols)).alias("_a"), F.max(_key(group_cols)).alias("_b"))
    pieces = (d.join(F.broadcast(ends.withColumnRenamed(PIECE, "_q")), F.col(PIECE) == F.col("_q"))
               .withColumn("_k", _key(group_cols))
               .filter(F.col("_k").eqNullSafe(F.col("_a")) | F.col("_k").eqNullSafe(F.col("_b")))
               .groupBy("_q", "_k").agg(*[F.sum(x).alias(n) for n, x in sums.items()],
                                        *[F.max(x).alias(n) for n, x in tops.items()]))
    whole = Window.partitionBy("_k")
    before = whole.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    span = (pieces.select(
        "_q", "_k", F.count(F.lit(1)).over(whole).alias("_pieces"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in sums],
        *[F.sum(n).over(whole).alias(f"{n}_all") for n in sums],
        *[F.max(n).over(whole).alias(f"{n}_all") for n in tops])
        .filter("_pieces > 1").drop("_pieces"))
    on = (F.col(PIECE) == F.col("_q")) & _key(group_cols).eqNullSafe(F.col("_k"))
    return d.join(F.broadcast(span), on, "left").drop("_q", "_k")


def running_sum(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                value_col: str, out: str, inclusive: bool = False) -> DataFrame:
    """Prefix sum of ``value_col`` in ``order_cols`` order within ``group_cols``.

    ``inclusive=False`` gives the sum over strictly earlier rows; NULL values
    add nothing, and NULL group keys are a group.  Rows that tie in all order
    columns share a partition: collapse large ties before.
    """
    g = list(group_cols)
    d = with_spanning(range_pieces(df, g, order_cols), g, {"_t": F.col(value_col)})
    w = (Window.partitionBy(PIECE, *g).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    total = F.coalesce(F.col("_t_before"), F.lit(0)) + F.coalesce(F.sum(value_col).over(w), F.lit(0))
    return d.withColumn(out, total).drop(PIECE, "_t_before", "_t_all")


def row_number_in_groups(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                         out: str = "rn") -> DataFrame:
    """1-based row number in ``order_cols`` order within ``group_cols``."""
    d = df.withColumn("_one", F.lit(1))
    return running_sum(d, group_cols, order_cols, "_one", out, inclusive=True).drop("_one")
