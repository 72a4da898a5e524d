"""Sharding by sampled splitters (operator 5).

Records are ordered by (hash of the text, hash of the doc_id, a record's own
number): equal texts stand together, and a text with very many copies, or one record repeated
very often, can still be divided.

1. A size-weighted sample of keys is drawn (a record of z bytes with
   probability min(1, z * wanted / total), decided by a hash, so reruns agree).
2. Its quantiles become splitters, ``RANGES_PER_SHARD`` a shard or more: one for every
   ``ROWS_PER_RANGE`` rows; records are range-partitioned by them and every range is measured.
3. Ranges with more than twice the mean bytes or rows are subdivided by
   splitters sampled inside them (by their greatest key where the sample holds none),
   until none is overfull or its records share one key.
4. Range totals are added up in order, which gives every record its position in
   bytes and rows; shard = the sixteenth of all bytes in which it begins.

Shards therefore hold equal bytes up to one record.  No task sees more than one
range, and only the splitters (a few per range) pass through the driver.

Defined cases: a null text has no bytes (size 1) and the key of an empty text;
a null doc_id has the key of an empty one; repeated rows are separate records; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featspark.llm.common import Scratch, hash63, text_of

RANGES_PER_SHARD = 8
ROWS_PER_RANGE = 500_000
SAMPLES_PER_RANGE = 12
#: Splitters that one expression searches; of more, it finds the block of this many.
BLOCK = 512
KEY = ["k1", "k2", "k3"]

Splitter = tuple[int, int, int]


def _search(array: str, n: int) -> Column:
    """How many of the first n entries of the sorted array (SQL) are <= the record's key."""
    steps = ",".join(str(1 << i) for i in range(n.bit_length() - 1, -1, -1))
    key = "named_struct('a', k1, 'b', k2, 'c', k3)"
    return F.expr(f"aggregate(array({steps}), 0, (at, step) -> if(at + step <= size({array}) "
                  f"AND get({array}, at + step - 1) <= {key}, at + step, at))")


def with_range(d: DataFrame, splitters: list[Splitter]) -> DataFrame:
    """``d`` with range: the number of splitters <= its key, by binary search."""
    if not splitters:
        return d.withColumn("range", F.lit(0))
    firsts = splitters[::BLOCK]
    rows = ",".join(f"named_struct('a',{a}L,'b',{b}L,'c',{c}L)" for a, b, c in firsts)
    d = d.withColumn("_block", _search(f"array({rows})", len(firsts)))
    table = [(i + 1, splitters[i * BLOCK:(i + 1) * BLOCK]) for i in range(len(firsts))]
    table = d.sparkSession.createDataFrame(table, "_block int, _s array<struct<a:bigint,b:bigint,c:bigint>>")
    d = d.join(F.broadcast(table), "_block", "left")  # a record before all splitters has block 0
    at = (F.col("_block") - 1) * BLOCK + _search("_s", min(BLOCK, len(splitters)))
    return d.withColumn("range", F.when(F.col("_block") == 0, 0).otherwise(at).cast("int")).drop("_block", "_s")


def _chance(turn: int) -> Column:
    return hash63(F.lit(turn), *map(F.col, KEY)) / F.lit(2.0**60)


def sampled_splitters(d: DataFrame, ranges: int) -> list[Splitter]:
    """Splitters such that no range is overfull (or is a single key)."""
    size, rows = d.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not rows:
        return []
    ranges = max(ranges, -(-rows // ROWS_PER_RANGE))
    order = Window.orderBy(*KEY)

    def quantiles(s: DataFrame, step: int) -> set[Splitter]:
        s = s.select(*KEY).withColumn("n", F.row_number().over(order))  # a bounded sample
        return {tuple(r) for r in s.filter(F.col("n") % step == 0).select(*KEY).collect()}

    wanted = ranges * SAMPLES_PER_RANGE
    found = quantiles(d.filter(_chance(0) < F.col("size") * F.lit(wanted / size)), SAMPLES_PER_RANGE)
    turn = 0
    while True:
        turn += 1
        r = with_range(d, sorted(found))
        key = F.struct(*KEY)
        full = r.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
                                      F.min(key).alias("low"), F.max(key).alias("high"))
        over = full.filter((F.col("bytes") > 2 * size / ranges) | (F.col("n") > 2 * rows / ranges))
        over = over.filter("low < high").select("range", "high").collect()
        if not over:
            return sorted(found)
        inside = r.filter(F.col("range").isin([x[0] for x in over]))
        # by rows here: what is overfull in rows holds small records
        p = F.greatest(F.col("size") / F.lit(size), F.lit(1.0 / rows)) * F.lit(4.0 * ranges)
        more = quantiles(inside.filter(_chance(turn) < p), 2) - found
        found |= more or {tuple(x[1]) for x in over}


def shard_by_splitters(docs: DataFrame, shards: int = 16, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot, range."""
    scratch = Scratch(docs.sparkSession, "shard")
    text = text_of(text_col).cast("binary")
    d = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
                    F.crc32(text).alias("text_crc32"),
                    F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint").alias("k1"))
    d = d.withColumns({"k2": hash63(F.col("doc_id")), "k3": F.monotonically_increasing_id()})
    d = scratch.write("keys", d)
    ranged = scratch.write("ranged", with_range(d, sampled_splitters(d, shards * RANGES_PER_SHARD)))
    scratch.drop("keys")

    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    totals = ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    totals = totals.select("range", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("byte0"),
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("row0"),
                           F.sum("b").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("range").orderBy(*KEY)
    r = ranged.withColumn("byte", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    r = r.withColumn("place", F.row_number().over(inside) - 1).join(totals, "range")
    shard = F.floor((F.col("byte0") + F.col("byte")) * F.lit(shards).cast("decimal(20,0)") / F.col("total"))
    r = scratch.write("placed", r.select("doc_id", "size", "text_crc32", "range", shard.cast("int").alias("shard"),
                                         (F.col("row0") + F.col("place")).alias("at")))
    scratch.drop("ranged")
    first = F.broadcast(r.groupBy("shard").agg(F.min("at").alias("first")))  # one row a shard
    return r.join(first, "shard").select("doc_id", "size", "text_crc32", "shard",
                                         (F.col("at") - F.col("first")).cast("bigint").alias("slot"), "range")
