"""Personal data by weak-supervision aggregation (operator 3).

Base spans are found by patterns and checks, per kind: e-mail addresses, IP
addresses, card numbers (Luhn) and phone numbers.  They always stay.

Further candidates come from looser patterns (e-mails written out with "at" and
"dot", phone numbers without a plus) and from base matches that failed their
check.  Labelers of three sorts vote on every candidate: patterns (the check,
the shape), gazetteers (top-level domains, card prefixes, country codes) and
context (telling words before it, counter-telling words, what it touches).
Expectation-maximisation over the votes estimates how reliable each labeler is
and how likely each vote pattern is personal data; a logistic classifier is
trained on these posteriors.  Candidates it gives one half or more become spans,
unless they overlap a base span, or failed the check of their kind (a card
number without a valid last digit) and no telling word stands before them.

All of it is DataFrame and SQL work.  A text is scanned once for each pattern;
positions come from the lengths of the pieces between matches; what is written
afterwards are matches with a little context, never texts.  The model sees
counts of vote patterns only, a table bounded by the labelers (each has three
votes), whatever the corpus.

Patterns are the given ones in a linear-time form: a run that cannot start a
match is skipped by a look-behind instead of being tried from every character
(\\G keeps matches that begin where the last one ended).

Defined cases: a null text counts as empty; repeated rows get the same spans;
no candidates at all means no model and no added spans; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import operator

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featspark.llm.common import Scratch, text_of

KINDS = ["email", "ip", "card", "phone"]

# fixed values: the base patterns
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# looser patterns of the same kinds
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]++ ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z]++",
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}
# gazetteers and context words
DOMAINS = "com org net edu gov io info de fr es uk eu us co".split()
CARD_PREFIX = "^(4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
COUNTRY_CODE = r"^\+?\(?(1|7|20|27|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CONTEXT = {"email": "mail|contact|write|reach", "ip": "ip|host|server|address|from",
           "card": "card|visa|master|credit|pay", "phone": "call|phone|tel|fax|mobile|ring"}
COUNTER = "version|license|release|isbn|order|number|page|section|token|password|key|hash"
LABELERS = ["check", "shape", "gazetteer", "context", "counter", "touch"]


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, found): per text all matches with the gap before each."""
    t = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                    text_of(text_col).alias("t"))
    sources = [(k, "base", p) for k, p in BASE.items()] + [(k, "loose", p) for k, p in LOOSE.items()]
    t = t.withColumns({f"m{i}": _all(F.col("t"), p) for i, (_, _, p) in enumerate(sources)})
    t = t.withColumns({f"p{i}": F.when(F.size(f"m{i}") > 0, F.split("t", p, -1)).otherwise(F.array().cast("array<string>"))
                       for i, (_, _, p) in enumerate(sources)})
    lists = []
    for i, (kind, via, _) in enumerate(sources):
        lists.append(F.expr(f"""transform(m{i}, (s, i) -> named_struct('kind', {KINDS.index(kind)}, 'via', '{via}',
            'i', i, 'gap', length(p{i}[i]), 's', s, 'before', right(p{i}[i], 24), 'after', left(p{i}[i + 1], 1)))"""))
    return t.select("row", "doc_id", F.concat(*lists).alias("found"))


def luhn(digits: str) -> Column:
    """Luhn check of the column ``digits``, a string of digits."""
    return F.expr(f"""aggregate(sequence(1, length({digits})), 0, (sum, i) -> sum +
        CASE WHEN i % 2 = 1 THEN int(substr({digits}, -i, 1))
             WHEN int(substr({digits}, -i, 1)) > 4 THEN 2 * int(substr({digits}, -i, 1)) - 9
             ELSE 2 * int(substr({digits}, -i, 1)) END) % 10 = 0""")


def checked() -> Column:
    """Does a match (s, its digits) pass the check of its kind?"""
    n = F.length("digits")
    ip = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
    return (F.when(F.col("kind") == 0, True)
            .when(F.col("kind") == 1, F.col("s").rlike(ip))
            .when(F.col("kind") == 2, F.when(n.between(14, 19), luhn("digits")).otherwise(False))
            .otherwise(n.between(10, 15)))


def _by_kind(values: dict[str, Column]) -> Column:
    out = F.lit(0)
    for k, v in values.items():
        out = F.when(F.col("kind") == KINDS.index(k), v).otherwise(out)
    return out


def _vote(yes: Column, no: Column | None = None) -> Column:
    v = F.when(yes, 1)
    return (v.when(no, -1) if no is not None else v).otherwise(0)


def votes() -> dict[str, Column]:
    """One column of 1 (personal), -1 (not) or 0 (no vote) per labeler."""
    s, digits, before = F.col("s"), F.col("digits"), F.col("before")
    n = F.length(digits)
    tld = F.regexp_extract(F.lower("s"), r"([a-z]+)$", 1)
    same = digits.rlike(r"^(.)\1*$")
    return {
        "check": _by_kind({"email": F.when(F.col("via") == "base", 1).otherwise(0),
                           "ip": _vote(F.col("ok"), ~F.col("ok")), "card": _vote(F.col("ok"), ~F.col("ok")),
                           "phone": _vote(F.col("ok"), ~F.col("ok"))}),
        "shape": _by_kind({"email": _vote(F.length("s") <= 64, F.length("s") > 120),
                           "ip": _vote(F.length("s") >= 9, F.length("s") > 15),
                           "card": _vote(n == 16, (n < 14) | (n > 19) | same),
                           "phone": _vote(s.rlike(r"[ ().-]"), same)}),
        "gazetteer": _by_kind({"email": _vote(tld.isin(DOMAINS), ~tld.isin(DOMAINS)),
                               "ip": _vote(~s.rlike(r"^0*(0|127|22[4-9]|2[3-5][0-9])\."), s.rlike(r"^0*0\.")),
                               "card": _vote(digits.rlike(CARD_PREFIX), ~digits.rlike(CARD_PREFIX)),
                               "phone": _vote(s.rlike(COUNTRY_CODE))}),
        "context": _by_kind({k: _vote(before.rlike(rf"\b({w})")) for k, w in CONTEXT.items()}),
        "counter": F.when(before.rlike(rf"\b({COUNTER})"), -1).otherwise(0),
        "touch": _vote(~F.col("after").rlike(r"[\p{L}\p{N}_]") & ~before.rlike(r"[\p{L}\p{N}_]$"),
                       F.col("after").rlike(r"[\p{L}\p{N}_]") | before.rlike(r"[\p{L}\p{N}_]$")),
    }


def fit_reliabilities(patterns: DataFrame, rounds: int = 15) -> Column:
    """EM over vote patterns (labelers, n); the posterior as a column expression.

    Every round is one aggregate over the pattern table; the estimates enter
    the next round as literals.
    """
    total = sum((F.col(x) for x in LABELERS), F.lit(0))
    posterior = F.when(total >= 2, 0.95).when(total <= 0, 0.05).otherwise(0.5)
    for _ in range(rounds):
        sums = []
        for t, q in ((1, posterior), (0, 1.0 - posterior)):
            w = F.col("n") * q
            sums.append(F.sum(w).alias(f"w{t}"))
            sums += [F.sum(F.when(F.col(x) == v, w).otherwise(0.0)).alias(f"{x}{t}{v}") for x in LABELERS for v in (-1, 0, 1)]
        r = patterns.agg(*sums).first()
        rate = {(x, t, v): (r[f"{x}{t}{v}"] + 0.5) / (r[f"w{t}"] + 1.5) for x in LABELERS for t in (0, 1) for v in (-1, 0, 1)}
        odds = F.log(F.lit((r["w1"] + 1.0) / (r["w0"] + 1.0)))
        for x in LABELERS:
            for v in (-1, 0, 1):
                odds = odds + F.when(F.col(x) == v, F.log(F.lit(rate[x, 1, v] / rate[x, 0, v]))).otherwise(0.0)
        posterior = 1.0 / (1.0 + F.exp(-odds))
    return posterior


def _features() -> dict[str, Column]:
    out = {f"{x}_{'yes' if v > 0 else 'no'}": (F.col(x) == v).cast("double") for x in LABELERS for v in (1, -1)}
    out |= {f"is_{k}": (F.col("kind") == i).cast("double") for i, k in enumerate(KINDS)}
    out["loose"] = (F.col("via") == "loose").cast("double")
    return out


def train_classifier(patterns: DataFrame, posterior: Column) -> Column:
    """Logistic regression on posterior labels; its probability as an expression."""
    f = _features()
    p = patterns.withColumn("q", posterior).withColumns(f)
    both = p.withColumn("label", F.lit(1.0)).withColumn("weight", F.col("n") * F.col("q")).unionByName(
        p.withColumn("label", F.lit(0.0)).withColumn("weight", F.col("n") * (1 - F.col("q"))))
    x = VectorAssembler(inputCols=list(f), outputCol="x").transform(both.filter("weight > 0")).coalesce(1)
    m = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=1e-3, maxIter=40).fit(x)
    z = sum((F.lit(float(c)) * e for c, e in zip(m.coefficients, f.values())), F.lit(float(m.intercept)))
    return 1.0 / (1.0 + F.exp(-z))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (array of start, kind, end,
    base, probability; code points, end exclusive) by start, then kind."""
    scratch = Scratch(docs.sparkSession, "pii")
    found = scratch.write("found", candidates(docs, id_col, text_col))
    c = found.select("row", F.explode("found").alias("x")).select("row", "x.*")
    upto = Window.partitionBy("row", "kind", "via").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("end", F.sum(F.col("gap") + F.length("s")).over(upto)).withColumn("start", F.col("end") - F.length("s"))
    c = c.withColumn("digits", F.regexp_replace("s", "[^0-9]", "")).withColumn("before", F.lower("before"))
    c = c.withColumn("ok", checked())
    c = c.withColumn("base", (F.col("via") == "base") & F.col("ok")).withColumns(votes())
    c = scratch.write("votes", c.select("row", "kind", "via", "start", "end", "base", *LABELERS))

    patterns = scratch.write("patterns", c.groupBy("kind", "via", *LABELERS).agg(F.count(F.lit(1)).alias("n")))
    probability = F.lit(0.0)
    if patterns.limit(1).count():
        probability = train_classifier(patterns, fit_reliabilities(patterns))
    taken = (F.col("probability") >= 0.5) & ((F.col("check") >= 0) | (F.col("context") == 1))
    c = c.withColumn("probability", probability).filter(F.col("base") | taken)
    ahead = Window.partitionBy("row").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("row").orderBy(F.desc("end"), F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    c = c.withColumn("reach", F.max(F.when(F.col("base"), F.col("end"))).over(ahead))
    c = c.withColumn("next", F.min(F.when(F.col("base"), F.col("start"))).over(behind))
    clear = (F.coalesce("reach", F.col("start")) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    c = c.filter(F.col("base") | clear)
    spans = c.groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("start", "kind", "end", "base", "probability"))).alias("spans"))
    none = F.expr("array()").cast(spans.schema["spans"].dataType)
    return found.select("row", "doc_id").join(spans, "row", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans"))


def span_digest(spans: Column) -> Column:
    """'kind:start:end' of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    i = KINDS.index(kind)
    return F.size(F.filter(spans, lambda x: x["base"] & (x["kind"] == i))).cast("bigint")
