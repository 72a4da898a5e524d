"""Conflict-constrained best-fit packing (operator 4).

Documents (their sizes in words) are packed into bins of ``capacity``.  A text
longer than the capacity is cut into full bins and a rest, so whole texts are
packed.  A bin may hold at most one piece of a source and at most one of a
duplicate cluster (texts equal after lower-casing A-Z); full-bin pieces have a
bin of their own.

Rows are dealt by a hash of the key to blocks of about ``BLOCK_ROWS`` pieces,
so a source or cluster with a third of all rows is spread over all blocks; the
blocks are packed independently, each in bounded memory, and only ids, sizes
and two small keys are shuffled.  Inside a block pieces go in by falling size.
Open bins are kept ordered by residual in a tree over 0..capacity; every node
carries the intersection of its bins' source bitmaps, so a subtree in which all
bins already hold the source is skipped; the search runs from the tightest
residual that fits upwards until a bin is found whose source and cluster
bitmaps are both free of the piece's bits.  That is best fit under conflicts,
the same bin that a scan over all bins would choose.

Defined cases: a null text has size 0 (an empty document takes a place, no
room); a null source is a source of its own; repeated rows are separate pieces
of one cluster; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import Scratch, lower_ascii_col, word_count

CAPACITY = 2048
BLOCK_ROWS = 8192


class OpenBins:
    """Open bins in order of residual; each with a source and a cluster bitmap."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.common = [-1] * (2 * self.width)  # -1: no bin (all bits set)
        # residual -> source bitmap -> bins (number, cluster bitmap), oldest first
        self.at: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(self.width)]

    def _refresh(self, residual: int) -> None:
        common = -1
        for mask in self.at[residual]:
            common &= mask
        i = residual + self.width
        self.common[i] = common
        while i > 1:
            i >>= 1
            self.common[i] = self.common[2 * i] & self.common[2 * i + 1]

    def put(self, residual: int, number: int, sources: int, clusters: int) -> None:
        bisect.insort(self.at[residual].setdefault(sources, []), (number, clusters))
        self._refresh(residual)

    def take(self, size: int, source: int, cluster: int) -> tuple[int, int, int, int] | None:
        """Remove and return the tightest compatible bin (residual, number, bitmaps);
        of equal residuals the one opened first."""
        r = self._successor(size, source)
        while r is not None:
            best = None
            for mask, bins in self.at[r].items():
                if not mask & source:
                    b = next((b for b in bins if not b[1] & cluster), None)
                    if b is not None and (best is None or b[0] < best[1][0]):
                        best = (mask, b)
            if best is not None:
                mask, b = best
                bins = self.at[r][mask]
                bins.remove(b)
                if not bins:
                    del self.at[r][mask]
                self._refresh(r)
                return r, b[0], mask, b[1]
            r = self._successor(r + 1, source)
        return None

    def _successor(self, low: int, source: int) -> int | None:
        """Least residual >= low some bin of which may lack the source."""
        if low >= self.width:
            return None
        i = low + self.width
        while self._taken(i, source):
            while i & 1:  # last child: the next subtree hangs from an ancestor
                i >>= 1
            if i == 0:
                return None
            i += 1
        while i < self.width:
            i *= 2
            if self._taken(i, source):
                i += 1
        return i - self.width

    def _taken(self, i: int, source: int) -> bool:
        """No bin below node ``i``, or the source is in all of them."""
        return self.common[i] == -1 or bool(self.common[i] & source)


def pack_block(sizes: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of every piece, in the order given; bins count from 0.

    ``sources`` and ``clusters`` are bits; 0 conflicts with nothing.
    """
    bins, out, opened = OpenBins(capacity), [], 0
    for z, sb, cb in zip(sizes, sources, clusters):
        got = bins.take(z, sb, cb)
        if got is None:
            r, number, sm, cm = capacity, opened, 0, 0
            opened += 1
        else:
            r, number, sm, cm = got
        out.append((number, capacity - r))
        bins.put(r - z, number, sm | sb, cm | cb)
    return out


def best_fit_pack(docs: DataFrame, capacity: int = CAPACITY, block_rows: int = BLOCK_ROWS,
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: doc_id, source, piece, pieces, size, bin_id, bin_offset, residual.

    ``residual`` is the room left in the piece's bin when all is packed.
    """
    scratch = Scratch(docs.sparkSession, "pack")
    z = F.col("words")
    pieces = F.greatest(F.lit(1), F.ceil(z / F.lit(capacity))).cast("int")
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    word_count(text_col).alias("words"), F.xxhash64(lower_ascii_col(text_col)).alias("cluster"))
    d = d.withColumn("pieces", pieces)
    d = d.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    d = d.withColumn("size", F.least(F.lit(capacity), z - F.col("piece") * capacity))
    d = scratch.write("pieces", d.select("doc_id", "source", "cluster", "piece", "pieces", "size"))
    full = F.col("size") == capacity
    blocks = max(1, -(-d.filter(~full).count() // block_rows))
    d = d.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "size", "cluster", "source",
                                                F.lit("block")), F.lit(blocks)))

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["size", "doc_id", "piece", "cluster", "source"], ascending=[False] + [True] * 4,
                          kind="stable", na_position="first")
        src = pd.factorize(g["source"], use_na_sentinel=False)[0]
        clu = pd.factorize(g["cluster"])[0]
        # clusters of one piece cannot conflict: they have no bit
        twice = np.bincount(clu) > 1
        bits = [1 << b if t else 0 for b, t in zip((np.cumsum(twice) - 1)[clu].tolist(), twice[clu].tolist())]
        placed = pack_block(g["size"].tolist(), [1 << s for s in src.tolist()], bits, capacity)
        out = g[["doc_id", "source", "piece", "pieces", "size"]].copy()
        number = np.array([p[0] for p in placed], dtype=np.int64)
        out["bin_id"] = g["block"].to_numpy() * 2**32 + number
        out["bin_offset"] = np.array([p[1] for p in placed], dtype=np.int64)
        used = np.bincount(number, weights=out["size"].to_numpy())
        out["residual"] = (capacity - used[number]).astype(np.int64)
        return out

    schema = ("doc_id long, source string, piece int, pieces int, size long, bin_id long, "
              "bin_offset long, residual long")
    packed = d.filter(~full).groupBy("block").applyInPandas(pack, schema)
    # a full piece is a bin by itself: numbered by its partition, after all blocks
    alone = d.filter(full).select(
        "doc_id", "source", "piece", "pieces", "size",
        (F.lit(blocks * 2**32) + F.monotonically_increasing_id()).alias("bin_id"),
        F.lit(0).cast("bigint").alias("bin_offset"), F.lit(0).cast("bigint").alias("residual"))
    return packed.unionByName(alone)
