"""Quality rules with robust multivariate outliers (operator 8).

Counts per text, then a verdict: documents that fail the base rules go, and so
do outliers among the others.  An outlier is a document whose vector of
transformed statistics lies far (Mahalanobis) from the robust centre of its
language and source, estimated by minimum covariance determinant:

* start from medians and quartile ranges, read off counts in fine fixed bins;
* C-steps: distances are counted in fixed bins of their logarithm; the bin in which a
  group's nearest 75 % end is taken by the share it needs, the bins before it
  whole; mean and covariance of these rows are the next estimate.  A group stops when
  its determinant no longer falls and keeps its best; the others go on, and
  every step lowers a determinant that the floors bound, so all stop;
* a group's moments, and its median distance, are averaged with ``prior_rows`` rows'
  worth of its language's, and those with all rows': a group of few rows is judged
  much like its language, and this fades as it grows;
* scale the covariance, up or down, so that the median distance is that of a
  chi-square law.  Only where over half of a group's rows are all but the same
  (copies) does that median say nothing: there the scale stops at ``LEAST_SCALE``.

The statistics have longer tails than a normal law (most documents repeat no
line or word window at all), so the cut is not a chi-square quantile: it is
the one that rejects under 1 % of the good documents.  There is one start; no
determinants of several starts are compared.

All of it is DataFrame work.  Rows never move: a step is two partial aggregates
(counts per group and bin, moments per group), and the estimates of groups come to
the rows as a broadcast table of at most ``GROUPS`` rows; beyond that many groups,
those with more than one row in ``GROUPS`` are broadcast and rows of the others are joined.
Nothing depends on the order of partial results, so reruns agree.

Defined cases: a null text has no words and fails the base rules, as any text
under 50 words; null lang or source is a group of its own; repeated rows count
each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featspark.llm.common import WORD, Scratch, text_of

SYMBOLS = "#*$%&|<>"
STATS = ["x1", "x2", "x3", "x4", "x5"]
# added to the diagonal, so that a statistic that never varies in a group (no
# symbols at all, say) does not turn its first small value into an outlier; the
# spread of good documents is about 0.84, 0.047, 0, 0.014 and 0.066; the last three
# are 0 in most documents, and floors of 0.002 and 0.01 for the last two reject 6 to
# 14 % of the good documents at cuts from 300 to 20
FLOOR = [0.10, 0.02, 0.02, 0.03, 0.07]
CHI2_MEDIAN_5 = 4.351
LEAST_SCALE = 0.25
# a group goes on while its log determinant falls by more
SETTLED = 1e-3
# bins: of the statistics by this width, of distances by this many a factor of e
WIDTH, BINS = 0.002, 32
GROUPS = 20_000
# figures of other cuts: README
CUT = 100.0


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words).

    n_repeat_words counts words in 3-word windows that occur twice or more:
    windows are sorted as 33 bits of hash and 31 of position in one long (a
    primitive sort), neighbours with equal hash bits are then compared by their
    words, so the count is exact.  Array columns are referred to twice or more
    in the next step, so the optimizer computes each once.
    """
    t = text_of(text_col)
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    d = docs.select(F.col(id_col).alias("doc_id"), "lang", "source",
                    F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("w"),
                    F.length(F.regexp_replace(t, r"[\x20\x09-\x0D]+", "")).cast("bigint").alias("word_chars"),
                    symbols.cast("bigint").alias("n_symbols"), lines.alias("lines"))
    keep = ["doc_id", "lang", "source", "word_chars", "n_symbols"]
    d = d.select(*keep, "w", F.size("w").cast("bigint").alias("n_words"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"))
    keep += ["n_words", "n_dup_lines"]
    low = 2**31 - 1
    windows = F.expr(f"""CASE WHEN n_words > 3 THEN sort_array(transform(sequence(0, size(w) - 3),
        i -> ((xxhash64(w[i], w[i + 1], w[i + 2]) & {~low}L) | i))) ELSE array() END""")
    d = d.select(*keep, "w", windows.alias("s"))
    # positions whose hash bits a neighbour shares
    near = F.expr(f"""array_distinct(flatten(filter(zip_with(s, slice(s, 2, greatest(size(s), 1)),
        (a, b) -> CASE WHEN ((a ^ b) & {~low}L) = 0 THEN array(cast(a & {low}L AS int), cast(b & {low}L AS int)) END),
        x -> x IS NOT NULL)))""")
    d = d.select(*keep, "w", near.alias("near"))
    named = F.expr("""sort_array(transform(near, p -> named_struct('a', w[p], 'b', w[p + 1], 'c', w[p + 2], 'p', p)))""")
    d = d.select(*keep, named.alias("v"))
    dups = F.expr("""sort_array(array_distinct(flatten(filter(zip_with(v, slice(v, 2, greatest(size(v), 1)),
        (x, y) -> CASE WHEN x.a = y.a AND x.b = y.b AND x.c = y.c THEN array(x.p, y.p) END), x -> x IS NOT NULL))))""")
    d = d.select(*keep, dups.alias("dups"))
    covered = F.expr("""aggregate(dups, named_struct('last', -3, 'n', 0L),
        (acc, p) -> named_struct('last', p, 'n', acc.n + least(3, p - acc.last)), acc -> acc.n)""")
    return d.select("doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    covered.cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vectors(d: DataFrame) -> DataFrame:
    n = F.greatest(F.lit(1.0), F.col("n_words").cast("double"))
    c = F.greatest(F.lit(1.0), F.col("word_chars").cast("double"))
    x = [F.log1p(F.col("n_words").cast("double")), F.log(c / n), F.sqrt(F.col("n_symbols") / c),
         F.sqrt(F.col("n_dup_lines") / n), F.sqrt(F.col("n_repeat_words") / n)]
    return d.withColumns({f"x{i + 1}": v for i, v in enumerate(x)})


def _groups(d: DataFrame) -> DataFrame:
    """Adds g, the (language, source) each row is judged with, and l, its language."""
    return d.withColumns({"g": F.to_json(F.struct("lang", "source")), "l": F.to_json(F.struct("lang"))})


def _shrunk(t: DataFrame, cols: list[str], prior_rows: int) -> DataFrame:
    """``t`` (g, l, n, cols: one row per group) with each group's values averaged with
    ``prior_rows`` rows' worth of its language's, and those likewise with all rows'."""
    by_l, by_all = Window.partitionBy("l"), Window.partitionBy(F.lit(0))
    t = t.withColumns({"_nl": F.sum("n").over(by_l), "_na": F.sum("n").over(by_all)})
    t = t.withColumns({f"_{c}{k}": F.sum(F.col("n") * F.col(c)).over(w) / F.col(f"_n{k}")
                       for c in cols for k, w in (("l", by_l), ("a", by_all))})
    own, lang = (F.col(n) / (F.col(n) + F.lit(prior_rows)) for n in ("n", "_nl"))
    return t.select("g", "l", "n", *[
        (own * F.col(c) + (1 - own) * (lang * F.col(f"_{c}l") + (1 - lang) * F.col(f"_{c}a"))).alias(c) for c in cols])


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(5) for j in range(i + 1)]


def _cholesky(params: DataFrame) -> DataFrame:
    """(g, l, n, m0..m4, l<i><j>, scale, logdet) from means and covariances c<i><j>, the floor added."""
    p = params
    for i, j in _pairs():
        dot = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        if i == j:
            p = p.withColumn(f"l{i}{i}", F.sqrt(F.greatest(F.col(f"c{i}{i}"), F.lit(0.0)) + FLOOR[i] ** 2 - dot))
        else:
            p = p.withColumn(f"l{i}{j}", (F.col(f"c{i}{j}") - dot) / F.col(f"l{j}{j}"))
    logdet = 2 * sum(F.log(F.col(f"l{i}{i}")) for i in range(5))
    return p.select("g", "l", "n", *[f"m{i}" for i in range(5)], *[f"l{i}{j}" for i, j in _pairs()],
                    F.lit(1.0).alias("scale"), logdet.alias("logdet"))


def _with_groups(d: DataFrame, params: DataFrame, few: bool, n_rows: int) -> DataFrame:
    """``d`` with the columns of ``params`` (one row per g, with n, its rows)."""
    if few:
        return d.join(F.broadcast(params), "g")
    large = F.col("n") * GROUPS > F.lit(n_rows)
    rest = d.join(F.broadcast(params.filter(large).select("g")), "g", "left_anti")
    return d.join(F.broadcast(params.filter(large)), "g").unionByName(rest.join(params.filter(~large), "g"))


def _distances(d: DataFrame) -> DataFrame:
    """``d``, with its group's estimates, with d2, the squared Mahalanobis distance
    (forward substitution), in their place."""
    for i in range(5):
        part = sum((F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))
        d = d.withColumn(f"z{i}", (F.col(STATS[i]) - F.col(f"m{i}") - part) / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(5)), F.lit(0.0)) / F.col("scale")
    return d.withColumn("d2", d2).drop(*[f"z{i}" for i in range(5)])


def _bin(d2: Column) -> Column:
    return F.floor(F.log(F.greatest(d2, F.lit(1e-12))) * BINS).cast("int")


def _quantile(counts: DataFrame, share: float, by: list[str]) -> DataFrame:
    """Per ``by``: bin in which the nearest ``share`` of its rows end, and part, the
    share of that bin needed; ``counts`` has by, bin, c."""
    w = Window.partitionBy(*by)
    upto = F.sum("c").over(w.orderBy("bin"))
    t = counts.select(*by, "bin", "c", upto.alias("upto"), (F.sum("c").over(w) * share).alias("need"))
    t = t.filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("c") < F.col("need")))
    return t.select(*by, "bin", ((F.col("need") - F.col("upto") + F.col("c")) / F.col("c")).alias("part"))


def _start(d: DataFrame, prior_rows: int) -> DataFrame:
    """(g, l, n, m*, c*): medians and quartile ranges per group from binned counts."""
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.floor(F.col(x) / WIDTH).cast("int").alias("bin"))
                             for i, x in enumerate(STATS)]))
    counts = d.select("g", "l", at.alias("x")).groupBy("g", "l", "x.i", "x.bin").agg(F.count(F.lit(1)).alias("c"))
    size = d.groupBy("g", "l").agg(F.count(F.lit(1)).alias("n"))
    for name, share in (("low", 0.25), ("mid", 0.5), ("high", 0.75)):
        value = ((F.col("bin") + F.col("part")) * WIDTH).alias("v")
        q = _quantile(counts, share, ["g", "i"]).select("g", "i", value)
        q = q.groupBy("g").pivot("i", list(range(5))).agg(F.first("v"))
        size = size.join(q.toDF("g", *[f"{name}{i}" for i in range(5)]), "g")
    spread = [F.pow((F.col(f"high{i}") - F.col(f"low{i}")) / 1.349, F.lit(2.0)) for i in range(5)]
    t = size.select("g", "l", "n", *[F.col(f"mid{i}").alias(f"m{i}") for i in range(5)],
                    *[(spread[i] if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _pairs()])
    return _shrunk(t, t.columns[3:], prior_rows)


def _moments(near: DataFrame, prior_rows: int) -> DataFrame:
    """(g, l, n, m*, c*) of the rows of ``near`` by their weight, about the old mean."""
    dx = [F.col(x) - F.col(f"m{i}") for i, x in enumerate(STATS)]
    w = F.col("weight")
    t = near.groupBy("g", "l").agg(
        F.max("n").alias("n"), F.sum(w).alias("w"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(5)],
        *[F.sum(w * dx[i]).alias(f"s{i}") for i in range(5)], *[F.sum(w * dx[i] * dx[j]).alias(f"c{i}{j}") for i, j in _pairs()])
    t = t.select("g", "l", "n", *[(F.col(f"m{i}") + F.col(f"s{i}") / F.col("w")).alias(f"m{i}") for i in range(5)],
                 *[(F.col(f"c{i}{j}") / F.col("w") - F.col(f"s{i}") * F.col(f"s{j}") / (F.col("w") * F.col("w")))
                   .alias(f"c{i}{j}") for i, j in _pairs()])
    # shrunk as second moments, as if rows of the language's core had joined the group's
    t = t.withColumns({f"c{i}{j}": F.col(f"c{i}{j}") + F.col(f"m{i}") * F.col(f"m{j}") for i, j in _pairs()})
    t = _shrunk(t, [f"m{i}" for i in range(5)] + [f"c{i}{j}" for i, j in _pairs()], prior_rows)
    return t.withColumns({f"c{i}{j}": F.col(f"c{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in _pairs()})


def robust_outliers(docs: DataFrame, cut: float = CUT, keep_share: float = 0.75, prior_rows: int = 100,
                    report: list | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, distance2, kept.

    ``report`` takes one (step, groups that went on) per C-step.
    """
    scratch = Scratch(docs.sparkSession, "rules")
    d = text_counts(docs).withColumn("base_failed", base_failed())
    d = scratch.write("vectors", _groups(_vectors(d)))
    x = d.select("g", *STATS)

    params = _cholesky(_start(d, prior_rows)).withColumns({"best": F.lit(float("inf")), "on": F.lit(True)})
    params = scratch.write("params0", params)
    n_groups, n_rows = params.agg(F.count(F.lit(1)), F.sum("n")).first()
    few = n_groups <= GROUPS
    step, going = 0, n_groups

    def measured(estimates: DataFrame) -> DataFrame:
        far = _distances(_with_groups(x, estimates, few, n_rows or 0))
        return far.withColumn("bin", F.floor(F.log(F.greatest("d2", F.lit(1e-12))) * BINS).cast("int"))

    while going:
        step += 1
        counts = measured(params).groupBy("g", "bin").agg(F.count(F.lit(1)).alias("c"))
        limit = params.join(_quantile(counts, keep_share, ["g"]).withColumnRenamed("bin", "last_bin"), "g")
        near = measured(limit).withColumn("weight", F.when(F.col("bin") < F.col("last_bin"), F.lit(1.0)).when(
            F.col("bin") == F.col("last_bin"), F.col("part")).otherwise(F.lit(0.0)))
        # written before it is filtered: a filter on the determinant would be pushed through
        # the steps of the factorisation, multiplying its expressions
        new = scratch.write(f"new{step}", _cholesky(_moments(near, prior_rows)))
        new = new.join(params.select("g", "best", F.col("on").alias("was")), "g")
        new = new.filter(F.col("was") & (F.col("logdet") < F.col("best") - SETTLED)).drop("was").withColumn("on", F.lit(True))
        # a group that no longer falls keeps the estimate it had
        stay = params.join(new.select("g"), "g", "left_anti").withColumn("on", F.lit(False))
        params = scratch.write(f"params{step}", new.withColumn("best", F.col("logdet")).unionByName(stay))
        scratch.drop(f"params{step - 1}", f"new{step}")
        going = params.filter("on").count()
        if report is not None:
            report.append((step, going))
    middle = _quantile(measured(params).groupBy("g", "bin").agg(F.count(F.lit(1)).alias("c")), 0.5, ["g"])
    middle = params.select("g", "l", "n").join(middle, "g").withColumn(
        "middle", F.exp((F.col("bin") + F.col("part")) / BINS))
    middle = _shrunk(middle, ["middle"], prior_rows).select("g", "middle")
    scaled = params.drop("scale").join(middle, "g").withColumn(
        "scale", F.greatest(F.lit(LEAST_SCALE), F.col("middle") / CHI2_MEDIAN_5)).drop("middle")
    scaled = scratch.write("scaled", scaled.drop("l"))
    scratch.drop(f"params{step}")
    far = _distances(_with_groups(d, scaled, few, n_rows or 0))
    return far.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", F.col("d2").alias("distance2"),
                      (~F.col("base_failed") & (F.col("d2") <= cut)).alias("kept"))
