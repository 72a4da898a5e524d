"""Shared pieces of the registered plans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featspark.functions.expr import TIE_NUDGE, round_ladder, stable_round_sql
from featspark.operators.packed import Packed, map_doubles
from featspark.operators.twolevel import rounded

_INT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLT = (T.FloatType, T.DoubleType, T.DecimalType)


#: More doubles than this are rounded as arrays: hundreds of CASE expressions make
#: code that the JVM does not compile, some microseconds a value.
WIDE = 100


def finalize(df: DataFrame, places: int = 4) -> DataFrame:
    """Presentation for comparison: doubles rounded, integers as bigint.

    Built as SQL text (one ``selectExpr``): a few hundred columns cost one
    JVM parse each instead of many Python API calls.  Frames with over ``WIDE``
    doubles are rounded batch by batch, by the same rule (``twolevel.rounded``).
    """
    if sum(isinstance(f.dataType, _FLT) for f in df.schema.fields) > WIDE:
        return _finalize_wide(df, places)
    return df.selectExpr(*[_final(f, places) for f in df.schema.fields])


def _final(f: T.StructField, places: int) -> str:
    n = "`" + f.name.replace("`", "``") + "`"
    if isinstance(f.dataType, _FLT):
        return f"{stable_round_sql(n, places, coarse=True)} AS {n}"
    return f"CAST({n} AS BIGINT) AS {n}" if isinstance(f.dataType, _INT) else n


def _finalize_wide(df: DataFrame, places: int) -> DataFrame:
    name = lambda f: "`" + f.name.replace("`", "``") + "`"
    fields = df.schema.fields
    # all doubles travel as one array: Spark measures a batch column by column after every row
    doubles = [f for f in fields if isinstance(f.dataType, _FLT)]
    others = [(f"CAST({name(f)} AS BIGINT)" if isinstance(f.dataType, _INT) else name(f), f) for f in fields if f not in doubles]
    d = df.selectExpr(*[f"{e} AS _o{i}" for i, (e, _) in enumerate(others)],
                      f"array({', '.join(f'CAST({name(f)} AS DOUBLE)' for f in doubles)}) AS _doubles")
    ladder, nudge = round_ladder(places, coarse=True), TIE_NUDGE

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for b in batches:
                a = b.column("_doubles")
                v = a.flatten()
                x = pa.array(rounded(v.fill_null(0.0).to_numpy(), ladder, nudge), mask=v.is_null().to_numpy(zero_copy_only=False))
                ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * len(doubles))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(ends, x)], b.schema.names)

    at = {f.name: f"get(_doubles, {i})" for i, f in enumerate(doubles)} | {f.name: f"_o{i}" for i, (_, f) in enumerate(others)}
    return d.mapInArrow(step, d.schema).selectExpr(*[f"{at[f.name]} AS {name(f)}" for f in fields])


def finalize_packed(p: Packed, places: int = 4) -> DataFrame:
    """``finalize`` of ``p.unpack()``, the arrays rounded as they are."""
    ladder, nudge = round_ladder(places, coarse=True), TIE_NUDGE
    p = map_doubles(p, lambda x: rounded(x, ladder, nudge))
    name = lambda c: "`" + c.replace("`", "``") + "`"
    kind = lambda c: "double" if p.at[c][2] in ("double", "float") else "bigint"
    return p.df.selectExpr(*[f"{p.text(c, kind(c))} AS {name(c)}" if c in p.at else _final(p.df.schema[c], places)
                             for c in p.columns])
