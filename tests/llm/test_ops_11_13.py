"""Runs, fingerprints and prefix trie against brute force and odd inputs."""

import collections
import hashlib
import random
import re
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from featspark.llm import prefix_trie, queries, runs, syncmers
from featspark.llm.common import Scratch

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- 11

def brute_runs(w, least, times):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(least, times * q):
                out.setdefault((s, i + q - s), q)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        least, times = rng.choice([(24, 3), (6, 2), (4, 2), (8, 3), (2, 2), (5, 4)])
        texts = []
        for _ in range(rng.randint(1, 8)):
            kind = rng.random()
            if kind < 0.3:
                w = [rng.choice("ab") for _ in range(rng.randint(0, 80))]
            elif kind < 0.5:
                w = ["a"] * rng.randint(0, 100)
            elif kind < 0.8:
                block = [rng.choice("abc") for _ in range(rng.randint(1, 20))]
                w = [rng.choice("abcd") for _ in range(rng.randint(0, 9))] + block * rng.randint(1, 9) + block[:3]
                w += [rng.choice("abcd") for _ in range(rng.randint(0, 9))]
            else:
                w = [str(rng.randint(0, 1000)) for _ in range(100)]
            texts.append(" ".join(w))
        for t, (s, n, p, left) in zip(texts, runs.runs_of_texts(texts, least, times)):
            want = brute_runs(t.split(), least, times)
            assert list(zip(s, n, p)) == want
            drop = {i for a, b, q in want for i in range(a + q, a + b)}
            assert left == " ".join(x for i, x in enumerate(t.split()) if i not in drop)


def test_long_run_is_found_quickly():
    got = runs.runs_of_texts([" ".join(["a", "b", "c"] * 50_000)], 24, 3)
    assert got[0][:3] == ([0], [150_000], [3]) and got[0][3] == "a b c"


def op11_row(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w, 24, 3)
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_op11_whole_table(spark):
    got = [tuple(r) for r in queries.op11_branching_tandem_runs(spark, SF).collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    # brute force is quadratic: all short texts, and the made ones
    short = {d.doc_id for d in docs if len(d.text or "") < 6000}
    want = [op11_row(*d) for d in docs if d.doc_id in short]
    assert len(got) == len(docs) and len(want) > 800
    assert collections.Counter(r for r in got if r[0] in short) == collections.Counter(want)
    assert sum(r[1] > 0 for r in want) > 50


def test_op11_odd_rows(odd_docs, no_docs):
    got = runs.periodic_runs(runs.repeated_tails(odd_docs)).collect()
    assert len(got) == odd_docs.count() and runs.periodic_runs(runs.repeated_tails(no_docs)).count() == 0
    long = [r for r in got if r.doc_id == 5]
    assert [tuple(x) for x in long[0].runs][0][2] == 1 and long[0].collapsed == "word"
    assert all(r.collapsed == "" and not r.runs for r in got if r.doc_id in (3, 4, 6))


# --- 12

def xx(v, seed=42):
    raw = v.encode() if isinstance(v, str) else struct.pack("<q", v)
    h = xxhash.xxh64(raw, seed=seed & (2**64 - 1)).intdigest()
    return h - 2**64 if h >= 2**63 else h


def chain(values):
    h = 42
    for v in values:
        h = xx(v, h)
    return h


def brute_anchors(text, k=syncmers.K, s=syncmers.S):
    w = [xx(x) for x in WORD.findall(text)]
    out = {}
    if 0 < len(w) < k:
        return {chain(w) & 0xFFFFFFFF: 0}
    inner = [chain(w[i:i + s]) for i in range(len(w) - s + 1)]
    for i in range(len(w) - k + 1):
        part = inner[i:i + k - s + 1]
        if min(part) in (part[0], part[-1]):
            out.setdefault(chain(w[i:i + k]) & 0xFFFFFFFF, i)
    return out


def written(anchors):
    return ",".join(f"{h:08x}@{p}" for h, p in sorted(anchors.items(), key=lambda x: x[1]))


def brute_likeness(a, b):
    if not a and not b:
        return 1.0
    m = sorted((a[h], b[h] - a[h]) for h in a.keys() & b.keys())
    n = sum(d == 0 or (i > 0 and m[i - 1][1] == d) or (i + 1 < len(m) and m[i + 1][1] == d) for i, (_, d) in enumerate(m))
    return 2.0 * n / (len(a) + len(b))


def test_op12_whole_table(spark):
    got = sorted(map(tuple, queries.op12_closed_syncmers(spark, SF).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next").collect()))
    docs = sorted(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()), reverse=True)
    want = []
    for i, (doc_id, text) in enumerate(docs):
        text, after = text or "", docs[(i + 1) % len(docs)][1] or ""
        m = len(text) // 2
        edited = text[:len(text) - m] + after[:m]
        own, new = brute_anchors(text), brute_anchors(edited)
        want.append((doc_id, len(text), sha(edited), written(own), written(new), brute_likeness(own, new),
                     brute_likeness(own, brute_anchors(after))))
    assert got == sorted(want)
    usual = [r for r in got if r[1] > 1000]
    assert sum(0.3 < r[5] < 0.9 for r in usual) > 0.9 * len(usual)
    assert sum(r[5] > r[6] for r in usual) > 0.9 * len(usual)


def test_syncmers_leave_no_gap(spark):
    text = " ".join(str(i) for i in range(500))
    d = syncmers.anchors(spark.createDataFrame([(text,)], "t string"), "t", "a").first().a
    at = sorted(x & (2**31 - 1) for x in d)
    assert max(b - a for a, b in zip(at, at[1:])) <= syncmers.K - syncmers.S + 1


def test_likeness_of_a_shifted_text_is_high(spark):
    rng = random.Random(5)
    words = [f"w{rng.randint(0, 5000)}" for _ in range(400)]
    rows = [(" ".join(words), " ".join(["new"] * 3 + words)), ("a b", "a b"), ("a b", "a c"), ("", ""), ("", "a")]
    d = spark.createDataFrame(rows, "x string, y string")
    d = syncmers.likeness(syncmers.anchors(syncmers.anchors(d, "x", "ax"), "y", "ay"), "ax", "ay", "near")
    near = [r.near for r in d.collect()]
    assert near[0] > 0.95 and near[1:] == [1.0, 0.0, 1.0, 0.0]


def test_op12_odd_rows(odd_docs, no_docs):
    got = syncmers.edited_fingerprints(odd_docs).collect()
    assert len(got) == odd_docs.count() and syncmers.edited_fingerprints(no_docs).count() == 0
    twice = [r for r in got if r.doc_id == 1]
    assert len(twice) == 2 and {r.near_next for r in twice} >= {1.0}
    one = syncmers.edited_fingerprints(odd_docs.filter("doc_id = 5")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_next_documents_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        rows = [(i // 2 if i % 7 else None, f"text {i % 40}") for i in range(300)] + [(3, "same")] * 50
        d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("bigint"))
        d = d.withColumn("rk", F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "text"))))
        got = syncmers.next_documents(d).collect()
        keys = d.select("doc_id", "rk").collect()
        order = sorted(keys, key=lambda r: (r.doc_id is None, -(r.doc_id or 0), bytes(r.rk)))
        want = collections.Counter((bytes(a.rk), bytes(b.rk)) for a, b in zip(order, order[1:] + order[:1]))
        have = collections.Counter()
        for r in got:
            have[bytes(r.rk), bytes(r.next)] += r.times
        assert have == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


# --- 13

def brute_trie(seqs, n_bytes):
    """seqs: conv -> list of turns (any hashable), n_bytes: turn -> bytes."""
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * n_bytes(p[-1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   sha(",".join(map(str, sorted(ends.get(p, [])))))) for p, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes_of(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*COLUMNS).collect())


def rebuilt(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), text))
    own = {c: [(r, x) for _, r, _, x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + t[h:]
    return out


def test_op13_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute_trie(rebuilt(rows), lambda t: len(t[1].encode()))
    assert nodes_of(queries.op13_van_emde_boas_trie(spark, SF)) == want


def test_op13_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(c, t, "user", f"{t}") for c in range(10, 14) for t in range(5)] + [
        (20, None, None, None), (20, None, None, None), (20, 1, "x", "é😀"), (None, 1, "a", "b"), (7, 1, "", ""),
        (8, 2, "q", "r"), (8, 2, "q", "r"), (8, 2, "q", "a")] + [(c, 0, "hot", "same") for c in range(100, 160)]
    d = spark.createDataFrame(rows, schema).withColumn("depth", F.lit("x")).withColumn("owner", F.lit("y"))
    want = brute_trie(rebuilt(rows), lambda t: len(t[1].encode()))
    assert nodes_of(prefix_trie.prefix_trie(prefix_trie.rebuilt_turns(d))) == want
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt_turns(d.filter("false"))).count() == 0


def test_trie_of_long_conversations(spark, monkeypatch):
    """Blocks of 4 turns, so that names go through three levels; expansions and lists in small pieces."""
    for name, value in (("LEVELS", 2), ("BLOCK", 4), ("STEP", 4), ("PIECE_IDS", 2), ("HOT", 20)):
        monkeypatch.setattr(prefix_trie, name, value)
    rng = random.Random(11)
    base = [rng.choice("abc") for _ in range(70)]
    seqs = {c: base[:rng.randint(0, 70)] + [rng.choice("abc") for _ in range(rng.randint(0, 3))] for c in range(40)}
    seqs.update({c: [] for c in (90, 91)})
    turns = [(c, i + 1, bytearray(x.encode()), len(x) * 3, len(s)) for c, s in seqs.items() for i, x in enumerate(s)]
    d = spark.createDataFrame(turns, "conv_id long, depth long, turn_id binary, bytes long, n_turns long")
    sizes = spark.createDataFrame([(c, len(s)) for c, s in seqs.items()], "conv_id long, n_turns long")
    got = prefix_trie.prefix_trie(prefix_trie.with_roots(d, sizes))
    assert nodes_of(got) == brute_trie(seqs, lambda t: 3)


def test_list_digest_does_not_depend_on_pieces(spark):
    d = spark.range(30_000).select(F.lit(1).cast("long").alias("owner"), F.lit(2).cast("long").alias("depth"), F.col("id").alias("conv_id"))
    assert prefix_trie.list_digests(d.repartition(7)).first().ends_sha256 == sha(",".join(map(str, range(30_000))))
    assert Scratch(spark, "x").root
