"""Exact dedup by content-defined chunk recipes (operator 7).

Every text (A-Z lower-cased, UTF-8) is cut where a rolling hash of the last 32
bytes asks for it, so equal passages give equal chunks wherever they stand.
The text itself is read once and never shuffled; what moves is, per chunk, a
64-bit hash and 128 bits of its SHA-256:

1. chunks are deduplicated to *verified identifiers*: (hash, variant), where
   chunks that share the hash but not the SHA-256 bits get different variants;
2. each document becomes its ordered list of identifiers, and documents are
   equal when these lists are equal, element by element.

Of equal documents the row with the largest doc_id stays.  Defined cases: a
null text counts as empty, and all empty texts are one group; a null doc_id is
smaller than any other; of rows equal in doc_id and text, one stays; other
columns play no part; an empty table gives an empty result.

Hot groups: the groups are counted by partial aggregates, and the join back to
the rows is an equi-join that adaptive execution splits where one list holds
many rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featspark.llm.common import Scratch, lower_ascii, map_rows

_GEAR = np.random.default_rng(20240607).integers(0, 2**32, 256, dtype=np.uint32)


def cut_points(data: bytes, average: int = 1024, least: int = 256, most: int = 8192) -> list[int]:
    """Ends of the chunks of ``data`` (the last is its length; none if empty)."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    h = _GEAR[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):
        step = h[:-k] << np.uint32(k)
        h[k:] += step
    wanted = np.flatnonzero(h >> np.uint32(32 - (average - 1).bit_length()) == 0) + 1
    ends, last = [], 0
    for e in wanted.tolist() + [n]:
        while e - last > most:
            last += most
            ends.append(last)
        if e - last >= least or (e == n and e > last):
            ends.append(e)
            last = e
    return ends


def _signed(b: bytes) -> int:
    return int.from_bytes(b, "big", signed=True)


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, text_sha256, n_bytes, h, d1, d2): the chunk hashes of every row."""
    def cut(batch: dict) -> dict:
        out = {k: [] for k in ("text_sha256", "n_bytes", "h", "d1", "d2")}
        for t in batch["text"]:
            data = lower_ascii(t or "").encode("utf-8", "surrogatepass")
            out["text_sha256"].append(hashlib.sha256(data).hexdigest())
            out["n_bytes"].append(len(data))
            h, d1, d2, lo = [], [], [], 0
            for hi in cut_points(data):
                c = data[lo:hi]
                digest = hashlib.sha256(c).digest()
                h.append(xxhash.xxh3_64_intdigest(c) - 2**63)
                d1.append(_signed(digest[:8]))
                d2.append(_signed(digest[8:16]))
                lo = hi
            for k, v in (("h", h), ("d1", d1), ("d2", d2)):
                out[k].append(v)
        return {"row": batch["row"], "doc_id": batch["doc_id"], **out}

    src = docs.select(F.monotonically_increasing_id().alias("row"),
                      F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return map_rows(src, cut, "row long, doc_id long, text_sha256 string, n_bytes long, "
                              "h array<long>, d1 array<long>, d2 array<long>")


def identifier_lists(recipes: DataFrame) -> DataFrame:
    """(row, recipe): each row's ordered list of verified chunk identifiers."""
    chunks = recipes.select("row", F.posexplode(F.arrays_zip("h", "d1", "d2")).alias("seq", "c"))
    chunks = chunks.select("row", "seq", "c.h", "c.d1", "c.d2")
    # hashes that several contents share (as a rule none)
    shared = chunks.groupBy("h").agg(F.min("d1").alias("a1"), F.max("d1").alias("b1"),
                                     F.min("d2").alias("a2"), F.max("d2").alias("b2"))
    shared = shared.filter("a1 <> b1 OR a2 <> b2").select("h")
    w = Window.partitionBy("h").orderBy("d1", "d2")
    variants = (chunks.join(shared, "h", "left_semi").select("h", "d1", "d2").distinct()
                .withColumn("variant", F.row_number().over(w)))
    named = chunks.join(variants, ["h", "d1", "d2"], "left")
    item = F.struct("seq", "h", F.coalesce("variant", F.lit(0)).alias("variant"))
    lists = named.groupBy("row").agg(F.sort_array(F.collect_list(item)).alias("l"))
    return lists.select("row", F.transform("l", lambda x: F.struct(x["h"].alias("h"), x["variant"].alias("v"))).alias("recipe"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, n_bytes, n_chunks."""
    scratch = Scratch(docs.sparkSession, "exact")
    recipes = scratch.write("recipes", chunk_recipes(docs, id_col, text_col))
    lists = recipes.select("row", "doc_id", "text_sha256", "n_bytes").join(
        identifier_lists(recipes), "row", "left")
    lists = scratch.write("lists", lists.withColumn("key", F.xxhash64("recipe")))
    rows = lists.withColumn("recipe", F.coalesce("recipe", F.expr("array()").cast(lists.schema["recipe"].dataType)))
    groups = rows.groupBy("key", "recipe").agg(
        F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, ["key", "recipe"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256", "n_bytes",
        F.size("recipe").cast("bigint").alias("n_chunks"))


def keep_rows(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_sha256 of the lower-cased text) is in
    ``keys``; of several rows with one such pair the first by the other columns."""
    from featspark.llm.common import lower_ascii_col
    sha = F.sha2(lower_ascii_col().cast("binary"), 256)
    d = docs.withColumn("_sha", sha)
    k = keys.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_key")).distinct()
    d = d.join(k, (d["_sha"] == k["_key"]) & d["doc_id"].eqNullSafe(k["_id"]), "left_semi")
    others = [c for c in docs.columns if c != "text"]
    w = Window.partitionBy("_sha", "doc_id").orderBy(*others)
    return d.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(*docs.columns)
