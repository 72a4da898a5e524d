"""Two levels of grouped statistics on sorted Arrow batches (O-D6).

Spark partitions the rows by key and sorts them by (key, sub-key); a task sees its
partition as a stream of batches and holds the rows of a few keys at a time.  The
statistics are array operations over all groups of such a chunk: one sort by
(group, value), then differences of running positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

COUNTS = {"n_distinct", "n_null"}
#: Rows that are worked on together (more only where one key has more).
CHUNK = 32_768

Stat = tuple[np.ndarray, np.ndarray]  # value and "is not NULL" per group


def grouped_stats(x: np.ndarray, there: np.ndarray, group: np.ndarray, n: int, stats: Sequence[str]) -> list[Stat]:
    """``stats`` of ``x`` where ``there`` per group 0 .. n - 1.  NaN is a value, above all others."""
    nulls = np.bincount(group[~there], minlength=n)
    x, g = x[there], group[there]
    order = np.lexsort((x, g))
    x, g = x[order], g[order]
    count = np.bincount(g, minlength=n)
    some = np.flatnonzero(count)
    c = count[some]
    start = np.cumsum(c) - c

    def spread(v: np.ndarray, where: np.ndarray = some, valid: np.ndarray | None = None) -> Stat:
        out = np.zeros(n)
        out[where] = v
        return out, (count > 0 if valid is None else valid)

    every = np.ones(n, bool)
    if not len(x):
        empty = spread(np.zeros(0))
        return [(nulls.astype(float), every) if s == "n_null" else (empty[0], every) if s in ("sum", "n_distinct") else empty
                for s in stats]
    total = np.add.reduceat(x, start)
    mean = total / c
    out = {"n_null": (nulls.astype(float), every), "mean": spread(mean), "sum": spread(total, valid=every),
           "min": spread(x[start]), "max": spread(x[start + c - 1])}
    if "sd" in stats:
        square = np.add.reduceat((x - np.repeat(mean, c)) ** 2, start)
        out["sd"] = spread(np.sqrt(square / np.maximum(c - 1, 1)), valid=count >= 2)
    if "median" in stats:
        out["median"] = spread((x[start + (c - 1) // 2] + x[start + c // 2]) / 2)
    if "Mode" in stats or "n_distinct" in stats:
        # runs of equal values; the first of the longest in a group is the Mode
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) & ~(np.isnan(x[1:]) & np.isnan(x[:-1]))
        new[start] = True
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(x)))
        first = np.searchsorted(at, start)
        runs = np.diff(np.append(first, len(at)))
        longest = np.repeat(np.maximum.reduceat(length, first), runs)
        top = np.minimum.reduceat(np.where(length == longest, np.arange(len(at)), len(at)), first)
        out["n_distinct"], out["Mode"] = spread(runs, valid=every), spread(x[at[top]])
    return [out[s] for s in stats]


def rounded(x: np.ndarray, ladder: Sequence[tuple[float, int]], nudge: float) -> np.ndarray:
    """``expr.stable_round`` of an array."""
    if not ladder:
        return x
    step = np.searchsorted([b for b, _ in ladder], np.abs(x), side="right")
    f = np.array([10.0 ** p for _, p in ladder] + [1.0])[step]
    y = x + x * nudge
    return np.where(step < len(ladder), np.copysign(np.floor(np.abs(y * f) + 0.5), y) / f, x)


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)


def whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of sorted ``batches`` in chunks that no key goes beyond."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = _codes(b.column(key))
        last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
        if held and sum(h.num_rows for h in held) + last >= CHUNK:
            before = held[-1].column(key)
            if last or not before[len(before) - 1].equals(b.column(key)[0]):
                yield pa.Table.from_batches([*held, b.slice(0, last)]).combine_chunks()
                held, b = [], b.slice(last)
        held.append(b)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _levels(t: pa.Table, key: str, sub_key: str, cols: Sequence[str], stats: Sequence[str], stats2: Sequence[str],
            ladder: Sequence[tuple[float, int]], nudge: float) -> tuple[np.ndarray, list[Stat]]:
    """Of sorted whole keys: the row where each key begins, and ``stats2`` of ``stats`` by column."""
    k, s = _codes(t.column(key).chunk(0)), _codes(t.column(sub_key).chunk(0))
    new_key = np.append(True, k[1:] != k[:-1])
    new_sub = new_key | np.append(True, s[1:] != s[:-1])
    sub = np.cumsum(new_sub) - 1
    of_sub = (np.cumsum(new_key) - 1)[new_sub]
    n = int(of_sub[-1]) + 1
    group2 = np.concatenate([of_sub + i * n for i in range(len(stats))])
    out = []
    for c in cols:
        v = t.column(c).chunk(0)
        there = v.is_valid().to_numpy(zero_copy_only=False)
        x = v.fill_null(0.0).to_numpy(zero_copy_only=False)
        first = grouped_stats(x, there, sub, len(of_sub), stats)
        x = rounded(np.concatenate([y for y, _ in first]), ladder, nudge)
        second = grouped_stats(x, np.concatenate([ok for _, ok in first]), group2, n * len(stats), stats2)
        out += [(y[i * n:(i + 1) * n], ok[i * n:(i + 1) * n]) for i in range(len(stats)) for y, ok in second]
    return np.flatnonzero(new_key), out


def both_levels(key: str, sub_key: str, cols: Sequence[str], names: Sequence[str], stats: Sequence[str],
                stats2: Sequence[str], ladder: Sequence[tuple[float, int]]) -> Callable:
    """A function for ``mapInArrow`` over rows partitioned by ``key`` and sorted by (key,
    sub_key): one row per key, ``stats2`` over the sub-keys of ``stats`` of every column
    (rounded by ``ladder``), columns ``names`` after the key."""
    from featspark.functions.expr import TIE_NUDGE
    nudge = TIE_NUDGE
    whole = [s2 in COUNTS for _ in cols for _ in stats for s2 in stats2]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for t in whole_keys(batches, key):
                at, values = _levels(t, key, sub_key, cols, stats, stats2, ladder, nudge)
                arrays = [pa.array(y.astype(np.int64) if w else y, mask=~ok) for (y, ok), w in zip(values, whole)]
                yield pa.RecordBatch.from_arrays([t.column(key).chunk(0).take(pa.array(at)), *arrays], [key, *names])

    return step


def both_levels_onto(key: str, sub_key: str, cols: Sequence[str], carried: Sequence[str], flag: str, out: str,
                     stats: Sequence[str], stats2: Sequence[str], ladder: Sequence[tuple[float, int]]) -> Callable:
    """As ``both_levels`` over rows and, between them (``flag`` is true), the rows that get the
    statistics: these come out, ``carried`` as they are, with ``out``: the statistics of
    their key as one array (all NULL where the key has no rows, or is NULL)."""
    from featspark.functions.expr import TIE_NUDGE
    from featspark.operators.packed import SLICE, rows_of
    nudge, width = TIE_NUDGE, len(cols) * len(stats) * len(stats2)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for t in whole_keys(batches, key):
                to = t.column(flag).chunk(0).fill_null(False).to_numpy(zero_copy_only=False)
                if not to.any():
                    continue
                k = _codes(t.column(key).chunk(0))
                group = np.cumsum(np.append(True, k[1:] != k[:-1])) - 1
                known = t.column(key).chunk(0).is_valid().to_numpy(zero_copy_only=False)
                x, null = np.zeros((int(group[-1]) + 1, width)), np.ones((int(group[-1]) + 1, width), bool)
                # rows without a key, and keys that get nothing, are not counted
                wanted = np.zeros(len(x), bool)
                wanted[group[to & known]] = True
                rows = np.flatnonzero(~to & wanted[group])
                if len(rows):
                    part = t.select([key, sub_key, *cols]).take(pa.array(rows)).combine_chunks()
                    at, values = _levels(part, key, sub_key, cols, stats, stats2, ladder, nudge)
                    of = group[rows[at]]
                    for j, (y, ok) in enumerate(values):
                        x[of, j], null[of, j] = y, ~ok
                take = np.flatnonzero(to)
                for i in range(0, len(take), SLICE):
                    part = pa.array(take[i:i + SLICE])
                    here = group[take[i:i + SLICE]]
                    yield pa.RecordBatch.from_arrays([*[t.column(c).chunk(0).take(part) for c in (key, *carried)],
                                                      rows_of(x[here], null[here])], [key, *carried, out])

    return step
