"""Document fingerprints of closed syncmers (operator 12).

Words are hashed; a window of ``k`` words is chosen when the least hash among its
inner pairs of ``s`` words stands at its first or last place.  The choice looks at
nothing outside the window (context-free), so an edit changes only the windows
that hold it, and no stretch of ``k - s + 1`` windows goes without a choice.  Each
distinct chosen window is one anchor: 32 bits of its hash and the number of the
word where it first stands.

Likeness of two fingerprints: anchors of equal hash are matched; a match counts
if it is in line, i.e. the two places are the same or are as far apart as those of
the match before or after it in the text.  Twice the counted matches, by the
anchors of both, gives 0 to 1.

All of it is DataFrame work; an array that a lambda reads is referred to twice or
more in its step, so that the optimizer computes it once per row.

Defined cases: a null or empty text has no anchors (two such fingerprints are alike
1.0, one such and another 0.0); fewer than ``k`` words are one window; equal texts have equal
fingerprints.  Documents go by doc_id descending (null last), equal ones by digest
of id and text; repeated rows follow each other and are rows each; the only document
is its own next; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featspark.llm.common import WORD, Scratch, text_of
from featspark.operators.ranking import PIECE, range_pieces

K, S = 8, 2
_PLACE = 2**31 - 1


def anchors(d: DataFrame, text: str, out: str, k: int = K, s: int = S) -> DataFrame:
    """``d`` with ``out``: anchors of the text as longs (32 bits of hash, 31 of place), ordered by hash."""
    keep, inner = list(d.columns), k - s + 1
    word = WORD.replace("\\", "\\\\")
    d = d.withColumn("_w", F.expr(f"transform(regexp_extract_all(coalesce({text}, ''), '{word}', 0), x -> xxhash64(x))"))
    pair = ", ".join(f"_w[i + {j}]" for j in range(s))
    d = d.withColumn("_m", F.expr(f"""CASE WHEN size(_w) < {k} THEN array()
        ELSE transform(sequence(0, size(_w) - {s}), i -> xxhash64({pair})) END"""))
    d = d.select(*keep, F.expr(f"""sort_array(CASE WHEN size(_w) = 0 THEN array()
        WHEN size(_w) < {k} THEN array(shiftleft(xxhash64(_w) & 4294967295L, 31))
        ELSE transform(
            filter(sequence(0, size(_w) - {k}),
                   i -> array_min(slice(_m, i + 1, {inner})) IN (_m[i], _m[i + {inner - 1}])),
            i -> shiftleft(xxhash64(slice(_w, i + 1, {k})) & 4294967295L, 31) | i) END)""").alias("_a"))
    return d.select(*keep, F.expr("filter(_a, (x, i) -> i = 0 OR x DIV 2147483648 <> _a[i - 1] DIV 2147483648)").alias(out))


def fingerprint(anchor_col: str) -> Column:
    """Anchors in order of place: 8 hex digits of hash @ word number, comma-joined."""
    return F.expr(f"""array_join(transform(
        sort_array(transform({anchor_col}, x -> shiftleft(x & {_PLACE}L, 32) | x DIV 2147483648)),
        y -> concat(lpad(lower(hex(y & 4294967295L)), 8, '0'), '@', y DIV 4294967296)), ',')""")


def likeness(d: DataFrame, one: str, other: str, out: str) -> DataFrame:
    """``d`` with ``out``: share of the anchors of both columns that match in line."""
    keep = list(d.columns)
    d = d.withColumn("_u", F.expr(f"""sort_array(concat(transform({one}, x -> shiftleft(x, 1)),
        transform({other}, x -> shiftleft(x, 1) | 1)))"""))
    # equal hashes are neighbours, one of each side: place in the first, distance to that in the other
    place = lambda x: f"(shiftright({x}, 1) & {_PLACE}L)"
    d = d.withColumn("_v", F.expr(f"""CASE WHEN size(_u) < 2 THEN array() ELSE sort_array(transform(
        filter(sequence(0, size(_u) - 2), i -> shiftrightunsigned(_u[i] ^ _u[i + 1], 32) = 0),
        i -> CASE WHEN _u[i] & 1 = 0
            THEN shiftleft({place("_u[i]")}, 32) | ({place("_u[i + 1]")} - {place("_u[i]")} + {_PLACE}L)
            ELSE shiftleft({place("_u[i + 1]")}, 32) | ({place("_u[i]")} - {place("_u[i + 1]")} + {_PLACE}L) END)) END"""))
    d = d.withColumn("_n", F.expr(f"""size(filter(_v, (x, i) -> x & 4294967295L = {_PLACE}L
        OR (i > 0 AND (x & 4294967295L) = (_v[i - 1] & 4294967295L))
        OR (i < size(_v) - 1 AND (x & 4294967295L) = (get(_v, i + 1) & 4294967295L))))"""))
    both = F.size(one) + F.size(other)
    return d.select(*keep, F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.col("_n") / both).alias(out))


def next_documents(d: DataFrame) -> DataFrame:
    """(rk, next, times, n_chars, doc_id) from ``d`` (doc_id, n_chars, rk: digest of id and text).

    Rows are counted per digest and range-partitioned; the row after the last of a
    partition is in a table of one row per partition.  Of n equal rows n - 1 are
    followed by an equal one.
    """
    once = d.groupBy("doc_id", "rk").agg(F.count(F.lit(1)).alias("copies"), F.max("n_chars").alias("n_chars"))
    order = ["no_id", "down", "rk"]
    rows = range_pieces(once.withColumns({"no_id": F.col("doc_id").isNull(), "down": F.bitwise_not("doc_id")}), [], order)
    firsts = rows.groupBy(PIECE).agg(F.min(F.struct(*order))["rk"].alias("rk"))
    by_piece = Window.orderBy(PIECE)
    after = firsts.select(PIECE, F.coalesce(F.lead("rk").over(by_piece), F.first("rk").over(by_piece)).alias("after"))
    lead = F.lead("rk").over(Window.partitionBy(PIECE).orderBy(*order))
    rows = rows.withColumn("next", lead).join(F.broadcast(after), PIECE).withColumn("next", F.coalesce("next", "after"))
    pick = lambda nxt, times: rows.select("rk", F.col(nxt).alias("next"), times.alias("times"), "n_chars", "doc_id")
    return pick("next", F.lit(1).cast("bigint")).unionByName(pick("rk", F.col("copies") - 1).filter("times > 0"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, and of its edited text: the last floor(n_chars / 2)
    code points replaced by the first as many of the next document.

    Texts move once by digest and their first halves once more; the two reads of
    the digest exchange share it.
    """
    scratch = Scratch(docs.sparkSession, "syncmers")
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    d = d.withColumns({"n_chars": F.length("text").cast("bigint"), "rk": F.unhex(F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text"))))})
    edges = scratch.write("next", next_documents(d.drop("text")))
    texts = d.groupBy("rk").agg(F.first("text").alias("text"))
    given = texts.join(edges.withColumnRenamed("rk", "to"), F.col("rk") == F.col("next"))
    given = given.select("to", "times", "n_chars", "doc_id", "text",
                         F.expr("substring(text, 1, cast(n_chars DIV 2 AS int))").alias("tail"))
    given = anchors(given, "text", "next_anchors").drop("text")
    both = texts.join(given, F.col("rk") == F.col("to"))
    edited = F.concat(F.expr("substring(text, 1, cast(n_chars - n_chars DIV 2 AS int))"), F.col("tail"))
    both = both.select("doc_id", "n_chars", "times", "text", "next_anchors", edited.alias("edited"))
    both = anchors(both, "text", "own").drop("text")
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    both = anchors(both, "edited", "edited_anchors").drop("edited")
    both = likeness(likeness(both, "own", "edited_anchors", "near_edited"), "own", "next_anchors", "near_next")
    out = both.select("doc_id", "n_chars", "edited_sha256", fingerprint("own").alias("fingerprint"),
                      fingerprint("edited_anchors").alias("edited_fingerprint"), "near_edited", "near_next", "times")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("_copy", "times")
