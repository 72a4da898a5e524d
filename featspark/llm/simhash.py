"""SimHash near-dedup over a Gray-order hierarchical index (operator 9).

Fingerprints: the text is lower-cased (A-Z), cut into words, and each 4-word
shingle (repeats included; the whole sequence where there are fewer words) is
hashed with XXH64, seed 42.  A bit is 1 if it is set in over half the hashes;
no words give fingerprint zero.

Two fingerprints link at ``max_bits`` (4) or fewer differing bits; components
of links are the groups.  Copies collapse to distinct fingerprints first.  The
64 bits are divided into m fields; fingerprints that differ in at most 4 bits
agree exactly on some m - 4 fields, so each choice of m - 4 fields is a table
whose top nodes are the masked patterns of these fields (m = 5 and more as
fingerprints grow in number, such that a top node keeps a bounded number of
them on average; every choice of m finds every link).  Below a top node:

* fingerprints are sorted by Gray rank, so neighbours share most bits;
* runs of 16 form a node that factors out the bits they share (mask and
  pattern), runs of 16 nodes the next level, and so on;
* a search compares the query with a node's pattern under its mask.  Over 4
  differences prune the whole group; if even its free bits cannot bring it over
  4, the whole group links at once; a group already in the query's component is
  passed by, so dense groups of near copies cost no square of their size.

A top node with more than ``split`` fingerprints is dealt to pairs of slices,
so every pair of its members still meets in one task and no task holds more
than two slices.

Defined cases: null and empty texts have fingerprint zero and link like any
other; null doc_ids play no part in component_id (null if all are null);
repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import WORD_RE, Scratch, lower_ascii, map_rows
from featspark.llm.components import components

FANOUT = 16
TOP_NODE = 4096
SPLIT = 20_000
TASK_ROWS = 30_000


def fingerprint(text: str, shingle: int = 4) -> int:
    words = WORD_RE.findall(text)
    if not words:
        return 0
    b = " ".join(words).encode("utf-8", "surrogatepass")
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b, 42)
    gaps = np.flatnonzero(np.frombuffer(b, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(b)][shingle - 1:]
    digest = xxhash.xxh64_intdigest
    n = len(ends)
    h = np.fromiter((digest(b[s:e], 42) for s, e in zip(starts, ends)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, 4096):
        part = h[lo:lo + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_sha256): fp as signed long; the hash is of the lower-cased text."""
    def run(b: dict) -> dict:
        fp, sha = [], []
        for t in b["text"]:
            t = lower_ascii(t or "")
            f = fingerprint(t, shingle)
            fp.append(f - 2**64 if f >= 2**63 else f)
            sha.append(hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest())
        return {"doc_id": b["doc_id"], "fp": fp, "text_sha256": sha}

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(src, run, "doc_id long, fp long, text_sha256 string")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each fingerprint in the reflected Gray sequence."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Index over distinct fingerprints (uint64); ``link`` gives each the least
    fingerprint position of its component."""

    def __init__(self, fps: np.ndarray, max_bits: int = 4):
        self.fps, self.max_bits = fps[np.argsort(gray_rank(fps), kind="stable")], max_bits
        self.label = np.arange(len(fps))
        # levels from the fingerprints up: bits common to all below, and their values
        self.masks, self.patterns = [np.full(len(fps), ~np.uint64(0))], [self.fps]
        low, high = self.fps, self.fps
        while len(low) > FANOUT:
            at = np.arange(0, len(low), FANOUT)
            low, high = np.bitwise_and.reduceat(low, at), np.bitwise_or.reduceat(high, at)
            self.masks.append(~(low ^ high))
            self.patterns.append(low)

    def _uniform(self) -> list[np.ndarray]:
        """Per level: the one component of all fingerprints below a node, or -1."""
        lo = hi = self.label
        out = [lo]
        for m in self.masks[1:]:
            at = np.arange(0, len(lo), FANOUT)
            lo, hi = np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at)
            out.append(np.where(lo == hi, lo, -1))
        return out

    def link(self, block: int = 256) -> np.ndarray:
        n, top = len(self.fps), len(self.masks) - 1
        for lo in range(0, n, block):
            uniform = self._uniform()
            q = np.arange(lo, min(n, lo + block))
            width = len(self.masks[top])
            qs, nodes = np.repeat(q, width), np.tile(np.arange(width), len(q))
            a, b = [], []
            for level in range(top, -1, -1):
                differ = np.bitwise_count((self.fps[qs] ^ self.patterns[level][nodes]) & self.masks[level][nodes])
                near = (differ <= self.max_bits) & (uniform[level][nodes] != self.label[qs])
                qs, nodes, differ = qs[near], nodes[near], differ[near]
                if level == 0:
                    a.append(qs)
                    b.append(nodes)
                    break
                free = np.bitwise_count(~self.masks[level][nodes])
                whole = differ + free <= self.max_bits
                if whole.any():
                    span = FANOUT ** level
                    first = nodes[whole] * span
                    size = np.minimum(n - first, span)
                    a.append(np.repeat(qs[whole], size))
                    b.append(np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                             + np.arange(size.sum()))
                    qs, nodes = qs[~whole], nodes[~whole]
                below = len(self.masks[level - 1])
                child = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                qs = np.repeat(qs, FANOUT)[child < below]
                nodes = child[child < below]
            self._union(np.concatenate(a), np.concatenate(b))
        return self.label

    def _union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Least label over the given links, and over what earlier ones joined."""
        if not len(a):
            return
        lab = self.label
        while True:
            la, lb = lab[a], lab[b]
            if (la == lb).all():
                break
            m = np.minimum(la, lb)
            new = lab.copy()
            np.minimum.at(new, la, m)
            np.minimum.at(new, lb, m)
            while True:  # labels are positions: follow them to their ends
                jump = new[new]
                if (jump == new).all():
                    break
                new = jump
            lab = new
        self.label = lab


def local_links(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, representative) for all that link to another of ``fps``."""
    index = GrayIndex(fps, max_bits)
    label = index.link()
    moved = np.flatnonzero(label != np.arange(len(label)))
    return index.fps[moved], index.fps[label[moved]]


def fields(count: int) -> list[tuple[int, int]]:
    """(first bit, width) of ``count`` nearly equal fields of 64 bits."""
    ends = [round(64 * i / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def table_masks(distinct: int, max_bits: int) -> list[int]:
    """Masks of the tables: all choices of m - max_bits of m fields, with the
    least m at which a top node keeps ``TOP_NODE`` fingerprints on average."""
    m = max_bits + 1
    while distinct / 2 ** (64 * (m - max_bits) / m) > TOP_NODE:
        m += 1
    parts = [((1 << w) - 1) << a for a, w in fields(m)]
    return [sum(c) for c in itertools.combinations(parts, m - max_bits)]


def links(distinct: DataFrame, max_bits: int = 4, split: int = SPLIT) -> DataFrame:
    """(u, v): star edges that join all linked fingerprints of ``distinct`` (fp)."""
    n = distinct.count()
    masks = [m - 2**64 if m >= 2**63 else m for m in table_masks(n, max_bits)]
    t = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("bigint")) for m in masks]))
                        .alias("t", "top"))
    full = t.groupBy("t", "top").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    full = full.withColumn("slices", F.ceil(F.col("n") / F.lit(split)).cast("int"))
    t = t.join(full, ["t", "top"])
    mine = F.pmod(F.xxhash64("fp", F.lit("slice")), F.col("slices")).cast("int")
    t = t.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    t = t.filter("slices = 1 OR other <> mine")
    t = t.withColumn("group", F.xxhash64("t", "top", F.least("mine", "other"), F.greatest("mine", "other")))
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(n * len(masks) / TASK_ROWS))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(g["group"].to_numpy(), kind="stable")
        key, fp = g["group"].to_numpy()[order], g["fp"].to_numpy()[order].view(np.uint64)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        u, v = [], []
        for lo, hi in zip(cuts, cuts[1:]):
            if hi - lo == 2:  # most groups
                if int(fp[lo] ^ fp[lo + 1]).bit_count() <= max_bits:
                    u.append(fp[lo:lo + 1])
                    v.append(fp[lo + 1:hi])
            elif hi - lo > 2:
                a, b = local_links(fp[lo:hi], max_bits)
                u.append(a)
                v.append(b)
        none = np.zeros(0, np.uint64)
        return pd.DataFrame({"u": np.concatenate(u or [none]).view(np.int64),
                             "v": np.concatenate(v or [none]).view(np.int64)})

    return t.select("group", "fp", F.pmod("group", F.lit(tasks)).alias("task")).groupBy("task").applyInPandas(
        run, "u long, v long")


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, fingerprint (hex), component_id,
    component_fp (a fingerprint that names the component), text_sha256."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.write("prints", fingerprints(docs, shingle, id_col, text_col))
    distinct = scratch.write("distinct", prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    comp = components(links(distinct.select("fp"), max_bits), scratch)
    named = distinct.join(comp, distinct["fp"] == comp["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component_fp"))
    named = scratch.write("named", named)
    least = named.groupBy("component_fp").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "component_fp").join(least, "component_fp")
    return prints.join(by_fp, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id", "component_fp", "text_sha256")


def one_per_component(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """Rows of ``docs`` that stay: of each component the one with the least
    (doc_id, text hash); a null doc_id stays only where all are null."""
    from featspark.llm.exact_dedup import keep_rows
    c = simhash_components(docs, shingle, max_bits)
    best = c.groupBy("component_fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_sha256")).alias("b"))
    return keep_rows(docs, best.select("b.doc_id", "b.text_sha256"))
