"""Removal of repeated byte strings with deep-shallow suffix sorting (operator 10).

A byte goes when it is covered by a ``length``-byte (400) string that also
starts anywhere else, in the same document or another one.  Texts are UTF-8
bytes; matches never cross documents; strings are judged on the input.

Sorting every suffix of the corpus would move each byte many times.  Only
suffixes at *anchors* are sorted instead, chosen so that none that matters is
missed: of the 150-byte grams in a 400-byte window the one with the least hash
(the leftmost of equals) is the window's anchor.  Equal windows have equal
anchors at equal offsets, so a window can only equal windows whose anchors
begin the same gram.  Consecutive windows with one anchor form a segment.

1. Equal texts collapse; a text of 400 bytes or more that has a copy goes whole.
2. Segments are counted by 128 bits: the gram hash and a 64-bit digest of bytes
   and geometry; equal segments are repeated whole.
3. Where different segments share a gram, their bytes meet: the suffixes from
   the anchor onwards, and the reversed prefixes before it, are ordered by
   multikey quicksort to a shallow depth and by blind tries below it.  Windows
   at offset x match where two suffixes agree on 400 - x bytes and the same two
   prefixes on x bytes, read off the neighbours' common prefixes.
4. A gram shared by more than ``group_limit`` different segments (a passage in
   a large part of all documents) is not gathered: its windows are counted one
   by one by digest, which partial aggregates spread over all tasks.

Defined cases: null and empty texts have 0 bytes and nothing to remove; texts
under 400 bytes are kept whole; repeated rows are copies of one another; a null
doc_id stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import Scratch, bounded_batches, map_rows, text_of

GRAM = 150
SHALLOW = 32
GROUP_LIMIT = 20_000
PIECE = 1 << 23
_BITS = np.uint64(0xFFFFFF)
_VALUES = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse mod 2^64, at least ``n`` of each."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        _powers[size] = tuple(tables)
    return _powers[size]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` bytes (a wrapping polynomial, then mixed)."""
    up, down = _power_tables(len(data))
    p = np.empty(len(data) + 1, np.uint64)
    p[0] = 0
    np.cumsum(_VALUES[data] * up[:len(data)], out=p[1:])
    h = (p[gram:] - p[:-gram]) * down[:len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: bytes, length: int, gram: int) -> list[tuple[int, int, int, int]]:
    """(gram hash, anchor, first window, last window) of each segment."""
    out, w = [], length - gram + 1
    for lo in range(0, len(data) - length + 1, PIECE):
        part = np.frombuffer(data[lo:lo + PIECE + length - 1], np.uint8)
        h = gram_hashes(part, gram)
        pos = np.arange(len(h), dtype=np.uint64)
        key = (h & ~_BITS) | pos
        n = len(key) - w + 1
        padded = np.full(-(-len(key) // w) * w, ~np.uint64(0))
        padded[:len(key)] = key
        rows = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        pick = (np.minimum(behind[:n], ahead[w - 1:w - 1 + n]) & _BITS).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(pick[1:] != pick[:-1]) + 1])
        last = np.concatenate([first[1:] - 1, [n - 1]])
        at = pick[first]
        out += zip(h[at].view(np.int64).tolist(), (at + lo).tolist(), (first + lo).tolist(), (last + lo).tolist())
    return out


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] equals b[:lo]; a[:hi] differs from b[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def blind_trie_order(strings: list[bytes], group: list[int]) -> list[int]:
    """``group`` in order of its strings, through a trie that keeps branch
    positions only: an insertion follows branch bytes without looking at what
    lies between, compares once with the leaf it reaches, and splits there."""
    def byte(s: bytes, at: int) -> int:
        return s[at] if at < len(s) else -1

    # a node is (branch position, {byte: node}), a leaf ("leaf", equal strings)
    root = ("leaf", [group[0]])
    for i in group[1:]:
        s = strings[i]
        path, node = [], root
        while node[0] != "leaf":
            path.append(node)
            nxt = node[1].get(byte(s, node[0]))
            node = nxt if nxt is not None else next(iter(node[1].values()))
        other = strings[node[1][0]]
        at = common_prefix(s, other)
        if at == len(s) == len(other):
            node[1].append(i)
            continue
        depth = 0  # the first node on the path that branches at or below the difference
        while depth < len(path) and path[depth][0] < at:
            depth += 1
        if depth < len(path) and path[depth][0] == at:
            path[depth][1][byte(s, at)] = ("leaf", [i])
            continue
        below = path[depth] if depth < len(path) else node
        new = (at, {byte(other, at): below, byte(s, at): ("leaf", [i])})
        if depth == 0:
            root = new
        else:
            up = path[depth - 1]
            up[1][byte(s, up[0])] = new
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if node[0] == "leaf":
            out += node[1]
        else:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, common prefix of each with its predecessor): multikey quicksort on
    eight bytes at a time down to ``shallow``, blind tries below."""
    out, todo = [], [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) == 1:
            out += group
        elif depth >= shallow:
            out += blind_trie_order(strings, group)
        else:
            pivot = strings[group[len(group) // 2]][depth:depth + 8]
            less, same, more = [], [], []
            for i in group:
                k = strings[i][depth:depth + 8]
                (same if k == pivot else less if k < pivot else more).append(i)
            parts = [(less, depth), (same, depth + 8 if len(pivot) == 8 else shallow), (more, depth)]
            todo += [p for p in reversed(parts) if p[0]]
    return out, [0] + [common_prefix(strings[i], strings[j]) for i, j in zip(out, out[1:])]


def repeated_windows(segments: list[bytes], at: list[int], length: int) -> list[list[tuple[int, int]]]:
    """For each segment the offsets (first, last) from the anchor back to starts of
    windows that another segment has too.  ``at`` is the anchor in the segment."""
    n = len(segments)
    high = np.array(at)                                   # offset of the first window
    low = np.array([a - (len(s) - length) for s, a in zip(segments, at)])  # of the last
    sides = []
    for strings in ([s[a:] for s, a in zip(segments, at)], [s[:a][::-1] for s, a in zip(segments, at)]):
        order, shared = deep_shallow_order(strings)
        sides.append((np.array(order), np.array(shared)))
    (ro, rl), (lo_, ll) = sides
    marks = np.unique(np.concatenate([low, high + 1, length - rl, ll + 1]))
    marks = marks[(marks >= low.min()) & (marks <= high.max())]
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    right, left = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, x in enumerate(marks.tolist()):
        end = marks[k + 1] - 1 if k + 1 < len(marks) else high.max()
        right[ro] = np.cumsum(rl < length - x)
        left[lo_] = np.cumsum(ll < x)
        has = np.flatnonzero((low <= x) & (x <= high))
        if len(has) < 2:
            continue
        _, back, count = np.unique(right[has] * (n + 1) + left[has], return_inverse=True, return_counts=True)
        for i in has[count[back] > 1].tolist():
            out[i].append((x, int(end)))
    return out


def _signed(b: bytes) -> tuple[int, int]:
    return struct.unpack(">qq", b)


def anchor_segments(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(tid, kh, d, a, lo, hi) of every segment of every text."""
    schema = pa.schema([(c, pa.int64()) for c in ("tid", "kh", "d", "a", "lo", "hi")])

    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in schema]
            unpack = zstandard.ZstdDecompressor().decompress
            for tid, data in zip(b["tid"].to_pylist(), b["data"]):
                data = unpack(data.as_py())
                for kh, a, lo, hi in anchors(data, length, gram):
                    d = hashlib.blake2b(data[lo:hi + length], digest_size=8, salt=struct.pack(">II", a - lo, hi - lo))
                    for c, v in zip(cols, (tid, kh, int.from_bytes(d.digest(), "big", signed=True), a, lo, hi)):
                        c.append(v)
                if len(cols[0]) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)
                    cols = [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    return texts.select("tid", "data").mapInArrow(run, "tid long, kh long, d long, a long, lo long, hi long")


def _segment_bytes(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Rows of ``wanted`` (kh, n, tid, a, lo, hi) with the bytes of their segments."""
    lists = wanted.groupBy("tid").agg(F.collect_list(F.struct("kh", "n", "a", "lo", "hi")).alias("l"))

    def cut(b: dict) -> dict:
        unpack = zstandard.ZstdDecompressor().decompress
        seg = [[d[x["lo"]:x["hi"] + length] for x in l] for d, l in zip(map(unpack, b["data"]), b["l"])]
        return {"tid": b["tid"], "seg": seg,
                **{k: [[x[k] for x in l] for l in b["l"]] for k in ("kh", "n", "a", "lo", "hi")}}

    longs = ", ".join(f"{k} array<long>" for k in ("kh", "n", "a", "lo", "hi"))
    got = map_rows(texts.select("tid", "data").join(lists, "tid"), cut, f"tid long, seg array<binary>, {longs}")
    return got.select("tid", F.explode(F.arrays_zip("seg", "kh", "n", "a", "lo", "hi")).alias("x")).select("tid", "x.*")


def _sorted_spans(rows: DataFrame, tasks: int, length: int) -> DataFrame:
    """(tid, s, e): repeated bytes found by sorting the segments of each gram."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.iloc[np.argsort(g["kh"].to_numpy(), kind="stable")]
        kh, n, tid, a, lo = (g[c].to_numpy() for c in ("kh", "n", "tid", "a", "lo"))
        seg = g["seg"].tolist()
        cuts = [0, *(np.flatnonzero(kh[1:] != kh[:-1]) + 1).tolist(), len(kh)]
        out = []
        for i, j in zip(cuts, cuts[1:]):
            if j - i < 2:
                continue
            found = repeated_windows([bytes(s) for s in seg[i:j]], (a[i:j] - lo[i:j]).tolist(), length)
            for k, spans in enumerate(found, i):
                if n[k] == 1:
                    out += [(tid[k], a[k] - x2, a[k] - x1 + length) for x1, x2 in spans]
        return pd.DataFrame(out, columns=["tid", "s", "e"]).astype("int64")

    task = F.pmod(F.xxhash64("kh"), F.lit(tasks)).alias("task")
    return rows.select("*", task).groupBy("task").applyInPandas(run, "tid long, s long, e long")


def _counted_spans(rows: DataFrame, length: int) -> DataFrame:
    """(tid, s, e) for grams too common to gather: every window by its digest."""
    def windows(b: dict) -> dict:
        d1, d2, s = [], [], []
        for seg, lo, hi in zip(b["seg"], b["lo"], b["hi"]):
            ds = [_signed(hashlib.blake2b(seg[i:i + length], digest_size=16).digest()) for i in range(hi - lo + 1)]
            d1.append([d[0] for d in ds])
            d2.append([d[1] for d in ds])
            s.append(list(range(lo, hi + 1)))
        return {"tid": b["tid"], "n": b["n"], "d1": d1, "d2": d2, "s": s}

    w = map_rows(rows.select("tid", "n", "lo", "hi", "seg"), windows,
                 "tid long, n long, d1 array<long>, d2 array<long>, s array<long>")
    w = w.select("tid", "n", F.explode(F.arrays_zip("d1", "d2", "s")).alias("x")).select("tid", "n", "x.*")
    often = w.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return w.filter("n = 1").join(often, ["d1", "d2"], "left_semi").select(
        "tid", "s", (F.col("s") + length).alias("e"))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def repeated_spans(texts: DataFrame, scratch: Scratch, length: int = 400, gram: int = GRAM,
                   group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(tid, s, e) of bytes in strings that start twice or more among ``texts``
    (tid, data: different texts of at least ``length`` bytes, packed)."""
    found = scratch.write("anchors", anchor_segments(texts, length, gram))
    key = ["kh", "d"]
    kinds = scratch.write("kinds", found.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("tid", "a", "lo", "hi")]))
    scratch.release()
    grams = kinds.groupBy("kh").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    grams = grams.filter("kinds > 1 AND least = 1").select("kh", "kinds")
    mixed = kinds.join(grams, "kh")
    rows = scratch.write("mixed", _segment_bytes(texts, mixed, length).join(grams, "kh"))
    scratch.release()
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // 20_000))
    few = _sorted_spans(rows.filter(F.col("kinds") <= group_limit).drop("kinds"), tasks, length)
    many = _counted_spans(rows.filter(F.col("kinds") > group_limit), length)
    parts = scratch.write("parts", few.unionByName(many))
    scratch.drop("mixed")
    scratch.release()
    whole = found.join(kinds.filter("n > 1").select(*key), key, "left_semi")
    whole = whole.select("tid", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    return whole.unionByName(parts)


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = GRAM, group_limit: int = GROUP_LIMIT,
                   id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    spans (array of start, end); with ``keep_text`` also kept, the remaining bytes."""
    scratch = Scratch(docs.sparkSession, "suffix")
    data = text_of(text_col).cast("binary")
    d = docs.select(F.col(id_col).alias("doc_id"), data.alias("data"), F.octet_length(data).cast("bigint").alias("n_bytes"),
                    F.sha2(data, 256).alias("sha"))
    texts = d.filter(F.col("n_bytes") >= length).groupBy("sha").agg(
        F.count(F.lit(1)).alias("copies"), F.first("data").alias("data"))

    def pack(b: dict) -> dict:  # texts are moved twice more: compressed
        squeeze = zstandard.ZstdCompressor(level=3).compress
        return {**b, "data": [squeeze(x) for x in b["data"]]}

    texts = scratch.write("texts", map_rows(
        texts.select(F.monotonically_increasing_id().alias("tid"), "sha", "copies", "data"), pack,
        "tid long, sha string, copies long, data binary"))
    scratch.release()
    spans = repeated_spans(texts, scratch, length, gram, group_limit)
    lists = spans.distinct().groupBy("tid").agg(F.collect_list(F.struct("s", "e")).alias("l"))
    lists = scratch.write("spans", lists)
    scratch.drop("anchors", "kinds", "parts")
    scratch.release()

    def cut(b: dict) -> dict:
        out = {k: [] for k in ("n_removed", "n_spans", "kept_sha256", "s", "e", "kept")}
        unpack = zstandard.ZstdDecompressor().decompress
        for data, l, copies in zip(map(unpack, b["data"]), b["l"], b["copies"]):
            spans = [(0, len(data))] if copies > 1 else merge([(x["s"], x["e"]) for x in l or []])
            kept, last = [], 0
            for s, e in spans:
                kept.append(data[last:s])
                last = e
            kept = b"".join(kept + [data[last:]])
            out["n_removed"].append(len(data) - len(kept))
            out["n_spans"].append(len(spans))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["s"].append([s for s, _ in spans])
            out["e"].append([e for _, e in spans])
            out["kept"].append(kept if keep_text else None)
        return {"sha": b["sha"], **out}

    touched = texts.filter("copies = 1").join(lists, "tid").unionByName(
        texts.filter("copies > 1").withColumn("l", F.lit(None).cast(lists.schema["l"].dataType)))
    done = scratch.write("done", map_rows(
        touched.select("sha", "data", "copies", "l"), cut,
        "sha string, n_removed long, n_spans long, kept_sha256 string, s array<long>, e array<long>, kept binary"))
    out = d.select("doc_id", "n_bytes", "sha", *([F.col("data")] if keep_text else [])).join(done, "sha", "left")
    none = F.expr("cast(array() as array<bigint>)")
    cols = [F.col("doc_id"), F.col("n_bytes"), F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"),
            F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
            F.arrays_zip(F.coalesce("s", none).alias("start"), F.coalesce("e", none).alias("end")).alias("spans")]
    return out.select(*cols, *([F.coalesce("kept", "data").alias("kept")] if keep_text else []))
