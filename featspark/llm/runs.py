"""Periodic runs of words (operator 11), found by an enhanced suffix array.

A *run* is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends, at least ``least`` words and ``times`` periods
long.  Each text is one problem; the texts of a batch share the numpy calls:

1. Prefix doubling names every block of 1, 2, 4, ... words (text by text); the
   last names are the inverse suffix array, and the names of all lengths answer
   "how far do these two places agree", forwards and backwards, in a few steps.
   A run of the wanted length makes two suffixes agree on at least
   ``least * (times - 1) / times`` words, so texts whose suffixes all differ
   before that are done here.
2. LCP intervals come as arrays (nearest smaller values), without tree nodes.
   For an interval of depth d, every suffix i of all its children but the largest
   looks up ISA[i+d] and ISA[i-d]: inside the interval and outside the child, it
   gives a branching square (two equal blocks of d words, different words after).
3. Such a square ends its run.  Rotating it to the left as far as words agree
   gives the run's start; squares of the same stretch are merged to the least
   period.

Defined cases: a null or empty text has no words and no runs; repeated rows are
judged each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import WORD_RE, map_rows, text_of

#: Words that are worked on at once (a longer text is worked on alone).
TOGETHER = 200_000


def block_names(key: np.ndarray, end: np.ndarray, least_depth: int = 0) -> tuple[list[np.ndarray], np.ndarray]:
    """Names of the blocks of 1, 2, 4, ... words from each place, in their order.

    ``key`` orders single words (places of different texts never have the same),
    ``end`` is the end of each place's text.  Stops when all names differ, or
    after the first length over ``least_depth / 2`` if that is set; also returns the places
    whose last name is not the only one.
    """
    n = len(key)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    new[1:] = key[order][1:] != key[order][:-1]
    where = np.arange(n)
    name = np.empty(n + 1, np.int64)
    name[order] = np.maximum.accumulate(np.where(new, where, 0))
    name[n] = -1
    levels, length = [name], 1
    alone = new & np.append(new[1:], True)
    shared = order[~alone]
    while len(shared) and not (least_depth and 2 * length > least_depth):
        after = shared + length
        second = np.where(after < end[shared], name[np.minimum(after, n)], -1)
        rank = name[shared]
        by = np.lexsort((second, rank))
        shared, second, rank = shared[by], second[by], rank[by]
        at = np.arange(len(shared))
        old = np.ones(len(shared), bool)
        old[1:] = rank[1:] != rank[:-1]
        new = old.copy()
        new[1:] |= second[1:] != second[:-1]
        name = name.copy()
        in_group = at - np.maximum.accumulate(np.where(old, at, 0))
        name[shared] = rank + in_group[np.maximum.accumulate(np.where(new, at, 0))]
        levels.append(name)
        alone = new & np.append(new[1:], True)
        shared, length = shared[~alone], 2 * length
    return levels, shared


def agree_after(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from places a and b on are equal."""
    a, b, start = a.copy(), b.copy(), a
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][a] == levels[k][b]).astype(np.int64) << k
        a, b = a + step, b + step
    return a - start


def agree_before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """How many words just before places a < b are equal (a's stay at ``begin`` or after)."""
    a, b, start = a.copy(), b.copy(), a
    for k in range(len(levels) - 1, -1, -1):
        inside = a - (1 << k) >= begin
        same = inside & (levels[k][np.where(inside, a - (1 << k), 0)] == levels[k][np.where(inside, b - (1 << k), 1)])
        step = same.astype(np.int64) << k
        a, b = a - step, b - step
    return start - a


def smaller_before(v: np.ndarray, or_equal: bool) -> np.ndarray:
    """For each place the last one before it that is smaller (or equal); the first if there is none.

    Candidates jump along each other's candidates; the few long walks left are
    done from left to right, when all they lead over are known.
    """
    p = np.arange(-1, len(v) - 1)
    p[0] = 0
    todo = np.arange(1, len(v))
    for _ in range(64):
        todo = todo[(p[todo] > 0) & ((v[p[todo]] > v[todo]) if or_equal else (v[p[todo]] >= v[todo]))]
        if len(todo) < 50:
            break
        p[todo] = p[p[todo]]
    for x in todo.tolist():
        j = p[x]
        while j and (v[j] > v[x] or (not or_equal and v[j] == v[x])):
            j = p[j]
        p[x] = j
    return p


def smaller_after(v: np.ndarray, or_equal: bool) -> np.ndarray:
    return len(v) - 1 - smaller_before(v[::-1], or_equal)[::-1]


def branching_squares(isa: np.ndarray, lcp: np.ndarray, deepest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of all squares whose words after both halves differ.

    ``lcp`` has -1 at both ends; ``deepest``, by suffix rank, is the longest
    period of interest in its text.
    """
    n = len(isa) - 1
    sa = np.empty(n, np.int64)
    sa[isa[:n]] = np.arange(n)
    low, high = smaller_before(lcp, False), smaller_after(lcp, False)
    near, next_ = smaller_before(lcp, True), smaller_after(lcp, True)
    j = np.flatnonzero(lcp[:n] > 0)
    j = j[lcp[j] <= deepest[j]]
    first = j[near[j] == low[j]]
    # children of the intervals: right of each place of least LCP, left of the first such place
    of, begin, stop = np.append(j, first), np.append(j, low[first]), np.append(next_[j], first)
    size, interval = stop - begin, low[of] * (n + 1) + high[of]
    by = np.lexsort((size, interval))
    largest = np.append(interval[by][1:] != interval[by][:-1], True)
    take = by[~largest]
    of, begin, stop, size = of[take], begin[take], stop[take], size[take]
    child = np.repeat(np.arange(len(of)), size)
    rank = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + begin[child]
    i, d = sa[rank], lcp[of][child]
    lo, hi, a, b = low[of][child], high[of][child], begin[child], stop[child]

    def other_child(place: np.ndarray) -> np.ndarray:
        r = isa[place]
        return (r >= lo) & (r < hi) & ~((r >= a) & (r < b))

    right = other_child(np.minimum(i + d, n))
    left = (i >= d) & other_child(np.maximum(i - d, 0))
    at, period = np.append(i[right], i[left] - d[left]), np.append(d[right], d[left])
    both = np.unique(at * (n + 1) + period)
    return both // (n + 1), both % (n + 1)


def find_runs(codes: np.ndarray, sizes: np.ndarray, least: int, times: int) -> np.ndarray:
    """Runs of several texts laid end to end: rows (text, start in it, length, period), ordered."""
    none = np.zeros((0, 4), np.int64)
    if not len(codes):
        return none
    text, ends = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes)
    key = text * (int(codes.max()) + 1) + codes
    # two suffixes of a run's text agree on this many words or more
    agreed = least * (times - 1) // times
    if agreed:
        _, shared = block_names(key, ends[text], agreed)
        live = np.unique(text[shared])
        if not len(live):
            return none
        if len(live) < len(sizes):
            found = find_runs(codes[np.isin(text, live)], sizes[live], least, times)
            found[:, 0] = live[found[:, 0]]
            return found
    levels, _ = block_names(key, ends[text])
    isa, n = levels[-1], len(codes)
    sa = np.empty(n, np.int64)
    sa[isa[:n]] = np.arange(n)
    lcp = np.full(n + 1, -1, np.int64)
    lcp[1:n] = agree_after(levels, sa[:-1], sa[1:])
    at, period = branching_squares(isa, lcp, (sizes // times)[text][sa])
    start = at - agree_before(levels, at, at + period, (ends - sizes)[text[at]])
    length = at + 2 * period - start
    keep = (length >= least) & (length >= times * period)
    start, length, period = start[keep], length[keep], period[keep]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    one = np.ones(len(start), bool)  # of equal stretches the least period
    one[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[one], length[one], period[one]
    t = text[start]
    by = np.lexsort((period, start))
    return np.stack([t, start - (ends - sizes)[t], length, period], axis=1)[by]


def runs_of_texts(texts: list[str], least: int, times: int) -> list[tuple[list, list, list, str]]:
    """Per text: starts, lengths and periods of its runs, and its words without repeats."""
    split = [WORD_RE.findall(t) for t in texts]
    sizes = np.fromiter((len(w) for w in split), np.int64, len(split))
    codes = pd.factorize(np.array([w for ws in split for w in ws], dtype=object))[0] if sizes.sum() else np.zeros(0, int)
    found = find_runs(codes.astype(np.int64), sizes, least, times)
    cut = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
    out = []
    for k, words in enumerate(split):
        r = found[cut[k]:cut[k + 1], 1:]
        if len(r):
            inside = np.zeros(len(words) + 1, np.int64)
            np.add.at(inside, r[:, 0] + r[:, 2], 1)
            np.add.at(inside, r[:, 0] + r[:, 1], -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(inside[:-1]) == 0)]
        out.append((r[:, 0].tolist(), r[:, 1].tolist(), r[:, 2].tolist(), " ".join(words)))
    return out


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, runs (start, length, period by start,
    then period), collapsed: the words left when of each run only the first
    period stays, joined by one space."""
    def find(b: dict) -> dict:
        done, wait, words = [], [], 0
        for t in b["text"]:
            wait.append(t)
            words += len(t) // 6
            if words >= TOGETHER:
                done += runs_of_texts(wait, least, times)
                wait, words = [], 0
        done += runs_of_texts(wait, least, times)
        return {"doc_id": b["doc_id"], **{c: [x[i] for x in done] for i, c in enumerate(("s", "l", "p", "collapsed"))}}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    out = map_rows(d, find, "doc_id long, s array<long>, l array<long>, p array<long>, collapsed string")
    runs = F.arrays_zip(F.col("s").alias("start"), F.col("l").alias("length"), F.col("p").alias("period"))
    return out.select("doc_id", runs.alias("runs"), "collapsed")


def repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the texts of which one in ten is made periodic.

    With h = crc32 of the decimal doc_id, g = floor(h / 10) and n words, texts of
    h % 10 = 0 have word i >= a replaced by word a + (i - a) % p of the original,
    a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).  A null doc_id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"), h.alias("h"))
    d = d.withColumn("w", F.expr(r"CASE WHEN h % 10 = 0 THEN regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0) END"))
    d = d.withColumns({"n": F.size("w"), "g": F.expr("h DIV 10")})
    d = d.withColumn("a", F.expr("CASE WHEN n > 0 THEN cast(g % n AS int) END"))
    d = d.withColumn("p", F.expr("cast(1 + (n - a) DIV (3 + g % 8) AS int)"))
    made = F.expr("""array_join(transform(w, (x, i) -> CASE WHEN i < a THEN x ELSE w[a + (i - a) % p] END), ' ')""")
    return d.select("doc_id", F.when(F.col("a").isNotNull(), made).otherwise(F.col("text")).alias("text"))
