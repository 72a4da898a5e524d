"""Key-safe joins, unions and row-count guards (O-C*, O-G*, O-I11).

Every feature frame is keyed by the client id; joins are equi-joins on it.
Broadcasting is left to Spark/AQE, which broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise a
sort-merge join on the key runs, and frames that come out of a
``groupBy(key)`` are already partitioned on it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts (O-D17 rows)."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def assert_unique_key(df: DataFrame, key: str | Sequence[str], what: str = "") -> None:
    """Raise if ``key`` is not unique in ``df`` (the reference's join guard, O-C8).

    The check runs before the join on the right side, as a distributed
    aggregate that stops at the first duplicate found.
    """
    if duplicate_keys(df, key).limit(1).count() > 0:
        raise DuplicateKeyError(f"duplicate keys {key} in {what or 'right side'}: "
                                "a left join would add rows")


def guarded(df: DataFrame, key: str, what: str = "") -> DataFrame:
    """``df`` that fails when it runs if a key occurs more than once (O-C8).

    The rows of a key are counted by a window over the key, on the partitioning
    and order that a join on the key needs anyway, so the guard is part of the join's
    own job.  Rows without a key match nothing and may repeat.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    fail = F.raise_error(F.concat(F.lit(f"duplicate key {key} = "), F.col(key).cast("string"),
                                  F.lit(f" in {what or 'right side'}: a left join would add rows"))).cast("boolean")
    return df.withColumn("_rows", n).filter(
        F.when((F.col("_rows") == 1) | F.col(key).isNull(), F.lit(True)).otherwise(fail)).drop("_rows")


def attach(spine: DataFrame, frames: Sequence[DataFrame], key: str,
           verify: bool | str = True, tasks: int = 0, dealt: bool = False) -> DataFrame:
    """Left-join feature frames to the key spine; unmatched -> NULL (O-C1/C2/C3).

    The spine keeps its row count (O-C8): with ``verify`` each frame's key is checked
    for uniqueness at once, by an aggregate of its own; with ``verify="run"`` the
    frames are ``guarded`` and the job that reads the result fails instead.  With
    ``tasks`` all sides are partitioned by key so many times (wide rows: what one task
    sorts and joins is set by the caller's row count, not by the session); ``dealt``:
    the frames are so already and stay where they are.
    """
    out = spine.repartition(tasks, key) if tasks else spine
    for i, f in enumerate(frames):
        if tasks and not dealt:
            f = f.repartition(tasks, key)
        if verify == "run":
            f = guarded(f, key, f"feature frame {i}")
        elif verify:
            assert_unique_key(f, key, f"feature frame {i}")
        out = out.join(f, on=key, how="left")
    return out


def join_with_suffix(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                     suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Join where non-key columns present on both sides get suffixes (O-C7)."""
    on = list(on)
    both = (set(left.columns) & set(right.columns)) - set(on)
    lren = {c: c + suffixes[0] for c in left.columns if c in both}
    rren = {c: c + suffixes[1] for c in right.columns if c in both}
    return left.withColumnsRenamed(lren).join(right.withColumnsRenamed(rren), on=on, how=how)


def natural_join(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on all shared column names (O-C6)."""
    on = [c for c in left.columns if c in set(right.columns)]
    if not on:
        raise ValueError("no shared columns for a natural join")
    return left.join(right, on=on, how=how)


def union_with_origin(train: DataFrame, test: DataFrame, flag: str = "is_test",
                      drop: Sequence[str] = ()) -> DataFrame:
    """Stack train (flag 0) and test (flag 1) by name (O-G1, O-G2)."""
    t = train.drop(*drop)
    return (t.withColumn(flag, F.lit(0))
             .unionByName(test.withColumn(flag, F.lit(1)), allowMissingColumns=True))


def full_merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join on ``key`` with the key coalesced (O-C10)."""
    l, r = left.alias("l"), right.alias("r")
    cols = [F.coalesce(F.col(f"l.{key}"), F.col(f"r.{key}")).alias(key)]
    cols += [F.col(f"l.{c}") for c in left.columns if c != key]
    cols += [F.col(f"r.{c}") for c in right.columns if c != key]
    return l.join(r, F.col(f"l.{key}") == F.col(f"r.{key}"), "full").select(*cols)


def rows_without_match(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows with no key in ``right`` (left-anti), e.g. train rows
    without a weight (O-I11 counts these and expects 0)."""
    return left.join(right.select(key), on=key, how="left_anti")


def merge_template(template: DataFrame, values: DataFrame, key: str,
                   drop: Sequence[str] = ()) -> DataFrame:
    """Left merge of a template (e.g. sample submission) with values (O-C11)."""
    return template.drop(*drop).join(values, on=key, how="left")


def and_all(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)
