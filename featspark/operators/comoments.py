"""Correlations of all pairs of many columns (O-D23) from blocked co-moment matrices.

Each task turns its rows into matrices over blocks of columns (one matrix product per
batch and block pair instead of an expression per pair of columns); the tasks' matrices are added in a
tree, ``FAN`` at a time and in order, so no task holds more than that many and reruns agree.
Values are taken about a centre (the column's mean), so sums of squares do not cancel.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.session import written

# the functions below travel with their jobs, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK, FAN = 256, 32
_PARTS = "bi int, bj int, part long, m binary"
#: A column counts as constant over a pair's rows under this spread against its size.
FLAT = 1e-6


def block_moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(6, columns of x, columns of y): over the rows where both are there the count,
    sums of x and y, of their squares and of their products; missing is NaN."""
    a, b = np.isfinite(x), np.isfinite(y)
    u, v = np.where(a, x, 0.0), np.where(b, y, 0.0)
    a, b = a.astype(np.float64), b.astype(np.float64)
    return np.stack([a.T @ b, u.T @ b, a.T @ v, (u * u).T @ b, a.T @ (v * v), u.T @ v])


def correlations(m: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, Pearson correlation) from ``block_moments``; NaN where there is none."""
    n, sx, sy, sxx, syy, sxy = m
    with np.errstate(all="ignore"):
        mx, my = sx / n, sy / n
        vx, vy = sxx / n - mx * mx, syy / n - my * my
        flat = (vx <= FLAT ** 2 * (vx + (mx + cx[:, None]) ** 2)) | (vy <= FLAT ** 2 * (vy + (my + cy[None, :]) ** 2))
        r = (sxy / n - mx * my) / np.sqrt(vx * vy)
    return n, np.where(flat | (n < 2), np.nan, np.clip(r, -1.0, 1.0))


def _spans(p: int) -> list[tuple[int, int]]:
    return [(lo, min(p, lo + BLOCK)) for lo in range(0, p, BLOCK)]


def corr_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(var1, var2, n_both, corr) for all ordered pairs of ``cols``, each over the rows
    where both are there (NULL, NaN and infinite values are not); corr is NULL where
    fewer than two rows are left or a column does not vary on them.

    The table is read once for the means and once per block row (256 columns).
    """
    cols, spans, fan, names_schema = list(cols), _spans(len(cols)), FAN, "var1 string, var2 string, n_both long, corr double"
    finite = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double"))
    d = df.select(*[finite(c).alias(f"c{i}") for i, c in enumerate(cols)])
    means = d.agg(*[F.avg(c).alias(c) for c in d.columns]).first()
    centre = np.array([0.0 if v is None else v for v in means], dtype=np.float64)

    def moments_of(row: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            total, (lo, hi) = {}, spans[row]
            for b in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns]) - centre[lo:]
                for j in range(row, len(spans)):
                    m = block_moments(x[:, :hi - lo], x[:, spans[j][0] - lo:spans[j][1] - lo])
                    total[j] = total[j] + m if j in total else m
            part = TaskContext.get().partitionId()
            for j, m in total.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row], pa.int32()), pa.array([j], pa.int32()), pa.array([part], pa.int64()),
                     pa.array([m.tobytes()], pa.binary())], names=["bi", "bj", "part", "m"])
        return run

    def add(group: pd.DataFrame) -> pd.DataFrame:
        g = group.sort_values("part")
        m = sum(np.frombuffer(x) for x in g["m"])
        return pd.DataFrame({"bi": g["bi"].iloc[:1], "bj": g["bj"].iloc[:1], "part": g["part"].iloc[:1] // fan,
                             "m": [m.tobytes()]})

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for bi, bj, raw in zip(frame["bi"], frame["bj"], frame["m"]):
                (a, b), (c, e) = spans[bi], spans[bj]
                n, r = correlations(np.frombuffer(raw).reshape(6, b - a, e - c), centre[a:b], centre[c:e])
                one, two = np.repeat(cols[a:b], e - c), np.tile(cols[c:e], b - a)
                out = [(one, two)] if bi == bj else [(one, two), (two, one)]
                for v1, v2 in out:
                    yield pd.DataFrame({"var1": v1, "var2": v2, "n_both": n.ravel().astype(np.int64), "corr": r.ravel()})

    parts = None
    for row in range(len(spans)):
        new = d.select(d.columns[spans[row][0]:]).mapInArrow(moments_of(row), _PARTS)
        parts = new if parts is None else parts.unionByName(new)
    parts = written(parts, "comoments")
    most = parts.agg(F.max("part")).first()[0]
    while most:
        parts = parts.groupBy("bi", "bj", F.expr(f"part DIV {fan}")).applyInPandas(add, _PARTS)
        most //= fan
    out = parts.mapInPandas(pairs, names_schema)
    return out.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))
