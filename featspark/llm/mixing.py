"""Mixing sources to target weights by weighted fair queueing (operator 2).

Each source is a queue.  Its documents are shuffled by a hash, and copy ``k``
(0, 1, 2 when a source may repeat three times) of a document finishes at

    (k * words of the source + words up to and with this document) / target

All copies are range-sorted by finish time over the whole corpus, and the
sequence is cut where the total budget of words is full.  As every queue
advances in proportion to its target, each source's share of what was taken is
its target up to one document.

Running sums never need a source in one task: the shuffle key's leading bits
divide every source into blocks of some thousand rows, block sums are added up
in a small table, and only rows of one block are summed in a window.  The cut
is found the same way over the range-sorted copies: sums per range partition,
then a running sum inside the one partition where the budget ends.

Defined cases: a null text has size 0 and is taken 0 times; a null source is a
source of its own; repeated rows are separate documents; a source without words
has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featspark.llm.common import Scratch, hash63, word_count

ROWS_PER_BLOCK = 4096


def cycle_weight(position: Column) -> Column:
    """Weights 1, 2, 3, 1, 2, 3, ... by position from 1."""
    return (F.pmod(position - 1, F.lit(3)) + 1).cast("double")


def source_targets(sizes: DataFrame, repeats: int = 3) -> DataFrame:
    """(source, source_size, target): the budget (all words) dealt by weight, no
    target above ``repeats`` times its source, the excess dealt again.

    Closed form: with sources ordered by cap / weight, the level L at which
    the rest of the budget is dealt is the first one that the next source's
    cap does not undercut; then target = least(weight * L, cap).
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    s = s.withColumn("weight", cycle_weight(F.row_number().over(by_name)))
    s = s.withColumn("cap", (F.col("source_size") * repeats).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("budget", F.sum("source_size").over(whole).cast("double"))
    s = s.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(rest))
    s = s.withColumn("place", F.row_number().over(order))
    fits = F.col("level") <= F.col("cap") / F.col("weight")
    s = s.withColumn("level", F.min(F.when(fits, F.struct("place", "level"))).over(whole)["level"])
    return s.select("source", "source_size",
                    F.least(F.col("weight") * F.col("level"), F.col("cap")).alias("target"))


def fair_queue_mix(docs: DataFrame, repeats: int = 3, seed: int = 17,
                   id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target,
    copies, taken (= copies * size) and finish, the first copy's finish time."""
    scratch = Scratch(docs.sparkSession, "mix")
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    word_count(text_col).alias("size"))
    d = scratch.write("sizes", d.withColumn("key", hash63(F.lit(seed), F.col("doc_id"))))
    n = d.count()
    blocks = max(1, -(-n // ROWS_PER_BLOCK))
    d = d.withColumn("block", F.floor(F.col("key") * F.lit(blocks / 2.0**60)).cast("bigint"))

    # words before each block of a source, and before each row of a block
    sums = d.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "block", F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("offset"))
    sums = _with_targets(sums, source_targets(d, repeats))
    sums = scratch.write("blocks", sums)
    inside = Window.partitionBy("source", "block").orderBy("key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    q = d.withColumn("inside", F.sum("size").over(inside))
    b = sums.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "offset", "source_size", "target")
    q = q.join(b, q["source"].eqNullSafe(b["_s"]) & (q["block"] == b["_b"]))
    q = scratch.write("queued", q.select("doc_id", "source", "size", "key", "source_size", "target",
                                         (F.col("offset") + F.col("inside")).alias("upto")))

    cut = _budget_cut(q, scratch, repeats)
    copies = F.lit(0).cast("bigint")
    if cut is not None:
        for k in range(repeats):
            at = [_finish(F.lit(k)), F.lit(k), F.col("key"), F.coalesce("doc_id", F.lit(-2**63)), F.col("size")]
            copies = copies + F.when((F.col("size") > 0) & _not_after(at, cut), 1).otherwise(0)
    return q.select("doc_id", "source", "size", "source_size", "target",
                    copies.cast("bigint").alias("copies"), (copies * F.col("size")).cast("bigint").alias("taken"),
                    _finish(F.lit(0)).alias("finish"))


def _with_targets(sums: DataFrame, targets: DataFrame) -> DataFrame:
    t = targets.withColumnRenamed("source", "_s")
    return sums.join(t, sums["source"].eqNullSafe(t["_s"])).drop("_s")


def _finish(k: Column) -> Column:
    words = (k * F.col("source_size") + F.col("upto")).cast("double")
    return F.when(F.col("target") > 0, words / F.col("target"))


def _not_after(at: list[Column], cut: list) -> Column:
    """Lexicographic ``at <= cut``."""
    ok = F.lit(True)
    for c, v in reversed(list(zip(at, cut))):
        ok = (c < F.lit(v)) | ((c == F.lit(v)) & ok)
    return ok


def _budget_cut(q: DataFrame, scratch: Scratch, repeats: int) -> list | None:
    """Position of the last copy inside the budget, in the order of finish times."""
    copies = q.filter("size > 0").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    copies = copies.select(_finish(F.col("k")).alias("finish"), "k", "key",
                           F.coalesce("doc_id", F.lit(-2**63)).alias("id"), "size")
    order = ["finish", "k", "key", "id", "size"]
    parts = int(q.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = scratch.write("ranged", copies.repartitionByRange(parts, *order).withColumn(
        "part", F.spark_partition_id()))
    budget = q.agg(F.sum("size")).first()[0]
    if not budget:
        return None
    upto = Window.orderBy("part")  # one row a partition
    totals = ranged.groupBy("part").agg(F.sum("size").alias("words")).withColumn(
        "upto", F.sum("words").over(upto))
    full = totals.filter(F.col("upto") >= F.lit(budget)).orderBy("part").first()
    local = ranged.filter(F.col("part") == full["part"]).withColumn(
        "upto", F.sum("size").over(Window.partitionBy("part").orderBy(*order).rowsBetween(
            Window.unboundedPreceding, 0)) + F.lit(full["upto"] - full["words"]))
    last = local.filter(F.col("upto") <= F.lit(budget)).orderBy(*[F.desc(c) for c in order]).first()
    if last is None:  # the budget ends exactly where this partition begins
        last = ranged.filter(F.col("part") < full["part"]).orderBy(*[F.desc(c) for c in order]).first()
    return None if last is None else [last[c] for c in order]


def mixed_documents(docs: DataFrame, repeats: int = 3, seed: int = 17) -> DataFrame:
    """The mix itself: every document as often as it was taken, columns unchanged.

    Documents that share a doc_id are taken as one entry each, matched by
    (doc_id, source, size), the fields that decide about them.
    """
    mix = fair_queue_mix(docs, repeats, seed).filter("copies > 0")
    m = mix.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_s"), F.col("size").alias("_z")).agg(
        F.sort_array(F.collect_list("copies")).alias("_list"))
    d = docs.withColumn("_words", word_count())
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    w = Window.partitionBy("doc_id", "source", "_words").orderBy(*others)
    d = d.withColumn("_n", F.row_number().over(w))
    j = d.join(m, d["doc_id"].eqNullSafe(m["_id"]) & d["source"].eqNullSafe(m["_s"]) & (d["_words"] == m["_z"]))
    j = j.withColumn("_copies", F.try_element_at("_list", F.col("_n")))
    return j.filter("_copies > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies")))).select(*docs.columns)
