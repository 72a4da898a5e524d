"""Prefix trie of conversations by van Emde Boas recursion (operator 13).

A node is a distinct sequence of first turns; conversations that start with it are
its members.  Sequences are cut at half their depth, again and again:

* *names*: blocks of 2, 4, 8, ... turns get an identifier (128 bits of a digest of
  their halves).  The prefix before a cut is named first; the pieces after the cut
  form one lower forest per such name, and all forests are cut at their own half
  depth at the same time.  ``BLOCK`` turns of a conversation are worked on in one
  row; a longer conversation is a sequence of such blocks, which is named by the
  same function one level up, so no row grows with a conversation.
* *totals*: going back up, the roots of lower forests hand their subtree totals to
  the nodes of the upper trie above them: one aggregate per halving, all forests in
  parallel.

A node is known by its smallest member and its depth.  A conversation that is the
smallest member of a node is so for all its deeper nodes.

Defined cases: turns go by turn (null first), then role, then identifier of the
turn; repeated rows are turns each; null or missing role and text are empty; rows
without conv_id belong to no conversation; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import Scratch
from featspark.operators.ranking import row_number_in_groups

LEVELS = 8
BLOCK = 1 << LEVELS
#: Ancestors that one row of a grafting step is expanded to at once.
STEP = 4096
#: Identifiers in one piece of a node's list.
PIECE_IDS = 4096
#: A node with more than one in this many of all rows is joined as a broadcast row:
#: rows are counted once per depth, so there are at most this many of these.
HOT = 2000


def digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, turn_id, bytes) of every row with a conv_id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    parts = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.unhex(F.md5(parts)).alias("turn_id"), F.octet_length(text).cast("bigint").alias("bytes"))


def numbered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """Turns with at: 0, 1, 2, ... in their conversation."""
    rows = scratch.write("turns", turn_ids(conversations))
    n = row_number_in_groups(rows, ["conv_id"], ["turn", "role", "turn_id"], "rn")
    return n.select("conv_id", (F.col("rn") - 1).cast("bigint").alias("at"), "turn_id", "bytes")


def with_roots(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sequences as ``prefix_trie`` takes them: (conv_id, depth, turn_id, bytes, n_turns),
    a row of depth 0 for every conversation of ``sizes`` (conv_id, n_turns)."""
    roots = sizes.select("conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("turn_id"),
                         F.lit(0).cast("bigint").alias("bytes"), "n_turns")
    return roots.unionByName(turns)


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """Sequences of rebuilt conversations: conversation c is the first h turns of
    conversation c - c % 5, then its own after its first h; h = crc32(decimal c) % 9."""
    scratch = Scratch(conversations.sparkSession, "rebuilt")
    own = scratch.write("numbered", numbered_turns(conversations, scratch))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    size = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    base = size.filter("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    plan = size.withColumns({"base": F.expr("conv_id - conv_id % 5"), "h": h}).join(base, "base", "left")
    plan = plan.withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0))))
    plan = plan.withColumn("n_turns", F.col("taken") + F.greatest(F.col("size") - F.col("h"), F.lit(0)))
    plan = scratch.write("plan", plan.select("conv_id", "base", "h", "taken", "n_turns"))
    first = own.filter("conv_id % 5 = 0 AND at < 8").withColumnRenamed("conv_id", "base").join(plan, "base")
    first = first.filter("at < taken").select("conv_id", (F.col("at") + 1).alias("depth"), "turn_id", "bytes", "n_turns")
    rest = own.join(plan, "conv_id").filter("at >= h").select(
        "conv_id", F.expr("at - h + taken + 1").alias("depth"), "turn_id", "bytes", "n_turns")
    return with_roots(first.unionByName(rest), plan)


def prefix_names(turns: DataFrame, scratch: Scratch, deepest: int, level: int = 0) -> DataFrame:
    """(conv_id, depth, name) for ``turns`` (conv_id, depth from 1, turn_id): the same
    name exactly for the same first turns."""
    rows = turns.groupBy("conv_id", F.expr(f"(depth - 1) DIV {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "turn_id"))).alias("t"))
    rows = rows.select("conv_id", "block", F.expr("transform(t, x -> x.turn_id)").alias("b0"))
    for k in range(LEVELS):
        rows = rows.withColumn(f"b{k + 1}", F.expr(f"""CASE WHEN size(b{k}) < 2 THEN array() ELSE
            transform(sequence(1, size(b{k}) DIV 2), i -> unhex(md5(concat(b{k}[2 * i - 2], b{k}[2 * i - 1])))) END"""))
    root = F.unhex(F.md5(F.lit("").cast("binary")))
    if deepest > BLOCK:
        rows = scratch.write(f"blocks{level}", rows)
        whole = rows.filter(f"size(b{LEVELS}) = 1").select(
            "conv_id", (F.col("block") + 1).alias("depth"), F.col(f"b{LEVELS}")[0].alias("turn_id"))
        above = prefix_names(whole, scratch, deepest // BLOCK, level + 1)
        above = above.select("conv_id", F.col("depth").alias("block"), F.col("name").alias("forest"))
        rows = rows.join(above, ["conv_id", "block"], "left").withColumn("forest", F.coalesce("forest", root))
    else:
        rows = rows.withColumn("forest", root)
    # names after 0, 2^k, 2 * 2^k, ... turns, from those after multiples of twice as many
    rows = rows.withColumn(f"p{LEVELS + 1}", F.array("forest"))
    for k in range(LEVELS, -1, -1):
        rows = rows.withColumn(f"p{k}", F.expr(f"""transform(sequence(0, size(b{k})), i -> CASE WHEN i % 2 = 0
            THEN p{k + 1}[i DIV 2] ELSE unhex(md5(concat(p{k + 1}[i DIV 2], b{k}[i - 1]))) END)"""))
    # outer: the other form has a filter on size(p0) pushed through all steps above, which multiplies them
    named = rows.select("conv_id", "block", F.posexplode_outer("p0").alias("i", "name")).filter("i > 0")
    return named.select("conv_id", (F.col("block") * BLOCK + F.col("i")).cast("bigint").alias("depth"), "name")


def smallest_members(named: DataFrame, n_rows: int, scratch: Scratch) -> DataFrame:
    """``named`` with owner (smallest member of the row's node) and n_convs.

    Nodes with many members are a bounded number of rows and are broadcast; the
    others are joined by name.
    """
    nodes = scratch.write("members", named.groupBy("name").agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs")))
    many = F.col("n_convs") * HOT > F.lit(n_rows)
    hot = F.broadcast(nodes.filter(many))
    few = named.join(F.broadcast(nodes.filter(many).select("name")), "name", "left_anti")
    both = named.join(hot, "name").unionByName(few.join(nodes.filter(~many), "name"))
    return both.drop("name")


def _piece_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (owner, depth, conv_id) -> comma-joined lists of a bounded size."""
    key, ids, number = None, [], 0
    for b in batches:
        rows = []
        for *of, conv in zip(*[c.to_pylist() for c in b.columns]):
            if of != key or len(ids) >= PIECE_IDS:
                if ids:
                    rows.append((*key, number, ",".join(ids)))
                key, ids, number = of, [], number + 1
            ids.append(str(conv))
        yield _pieces(rows)
    if ids:
        yield _pieces([(*key, number, ",".join(ids))])


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 5
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=["owner", "depth", "part", "piece", "ids"])


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> one digest of the whole list per (owner, depth); a list is never held."""
    key, state = None, None
    for b in batches:
        out = []
        for owner, depth, ids in zip(*[b.column(c).to_pylist() for c in ("owner", "depth", "ids")]):
            if (owner, depth) != key:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (owner, depth), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield _digests(out)
    if key:
        yield _digests([(*key, state.hexdigest())])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string()))],
                                      names=["owner", "depth", "ends_sha256"])


def list_digests(ends: DataFrame) -> DataFrame:
    """(owner, depth, ends_sha256) from ``ends`` (owner, depth, conv_id): a long list is cut
    into pieces over many tasks; only the digest itself has to see them one after another."""
    cut = ends.repartitionByRange("owner", "depth", "conv_id").sortWithinPartitions("owner", "depth", "conv_id")
    cut = cut.select("owner", "depth", F.spark_partition_id().cast("bigint").alias("part"), "conv_id")
    pieces = cut.mapInArrow(_piece_lists, "owner long, depth long, part long, piece long, ids string")
    pieces = pieces.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "part", "piece")
    return pieces.mapInArrow(_list_digests, "owner long, depth long, ends_sha256 string")


def grafted_totals(nodes: DataFrame, path: DataFrame, root: int, deepest: int, columns: list[str],
                   scratch: Scratch) -> DataFrame:
    """Sums of ``columns`` over every node's subtree.

    ``nodes`` has owner, depth and the columns, ``path`` (conv_id, depth, owner) the
    nodes each conversation passes.  Halving k joins subtries of 2^k depths: their
    lower roots hand their totals to the 2^k nodes above them.
    """
    keys, sums = ["owner", "depth"], [F.sum(c).alias(c) for c in columns]
    parts = [nodes.select(*keys, *columns)]
    above = path.select(F.col("conv_id").alias("owner"), F.col("depth").alias("up"), F.col("owner").alias("to"))
    for k in range(deepest.bit_length()):
        half = 1 << k
        lower = F.col("depth") % (2 * half) == half
        roots = parts[0].filter(lower)
        for p in parts[1:]:
            roots = roots.unionByName(p.filter(lower))
        if k:
            roots = roots.groupBy(*keys).agg(*sums)
        roots = roots.withColumn("low", F.col("depth") - half)
        if half > STEP:
            roots = roots.withColumn("low", F.explode(F.sequence("low", F.col("depth") - 1, F.lit(STEP)))).repartition(
                "owner", "low")
        last = F.least(F.col("low") + (min(half, STEP) - 1), F.col("depth") - 1)
        up = roots.select("owner", *columns, F.explode(F.sequence(F.col("low"), last)).alias("up"))
        to_root = up.filter("up = 0").select(F.lit(root).cast("bigint").alias("owner"), F.col("up").alias("depth"), *columns)
        up = up.filter("up > 0").join(above, ["owner", "up"]).select(F.col("to").alias("owner"), F.col("up").alias("depth"),
                                                                   *columns)
        parts.append(scratch.write(f"graft{k}", up.unionByName(to_root).groupBy(*keys).agg(*sums)))
    total = parts[0]
    for p in parts[1:]:
        total = total.unionByName(p)
    return total.groupBy(*keys).agg(*sums)


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie of ``sequences`` (see ``with_roots``): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over its
    subtree: members but one, times bytes of the last text), ends_sha256 (of the members
    that end here, comma-joined)."""
    scratch = Scratch(sequences.sparkSession, "trie")
    seq = scratch.write("sequences", sequences)
    n_rows, deepest, root, n_all = seq.agg(
        F.count(F.lit(1)), F.max("depth"), F.min("conv_id"), F.count_if(F.col("depth") == 0)).first()
    turns = seq.filter("depth > 0")
    named = scratch.write("named", prefix_names(turns, scratch, deepest or 0))
    path = scratch.write("path", smallest_members(named, n_rows, scratch).join(
        turns.select("conv_id", "depth", "bytes", "n_turns"), ["conv_id", "depth"]))
    root_row = sequences.sparkSession.createDataFrame(
        [(root, 0, n_all, 0)] if n_all else [], "owner long, depth long, n_convs long, bytes long")
    nodes = path.filter("owner = conv_id").select("owner", "depth", "n_convs", "bytes")
    parent = path.select(F.col("conv_id").alias("owner"), (F.col("depth") + 1).alias("depth"),
                         F.col("owner").alias("parent_conv_id"))
    parent = nodes.join(parent, ["owner", "depth"], "left").withColumn(
        "parent_conv_id", F.when(F.col("depth") == 1, F.lit(root)).otherwise(F.col("parent_conv_id")))
    nodes = scratch.write("nodes0", parent.unionByName(
        root_row.withColumn("parent_conv_id", F.lit(None).cast("bigint"))))
    children = nodes.filter("depth > 0").groupBy(
        F.col("parent_conv_id").alias("owner"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["owner", "depth"], "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "n_leaves": F.col("n_children").isNull().cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    nodes = scratch.write("nodes", nodes)
    total = grafted_totals(nodes, path, root or 0, deepest or 0, ["n_leaves", "saved_tokens"], scratch)
    none = seq.filter("depth = 0 AND n_turns = 0").select(F.lit(root).cast("bigint").alias("owner"), "depth", "conv_id")
    ends = list_digests(path.filter("depth = n_turns").select("owner", "depth", "conv_id").unionByName(none))
    out = nodes.drop("n_leaves", "saved_tokens").join(total, ["owner", "depth"]).join(ends, ["owner", "depth"], "left")
    return out.select(F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
