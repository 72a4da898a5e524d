"""Toxicity by weak supervision (operator 6).

Voters look at one text each and say toxic, clean or nothing:

* lexicon voters: a short fixed list of English insults, and word beginnings
  found in labelled training rows (so other languages have a lexicon as well);
* pattern voters: several different insults; an insult after "you"; no word of
  any lexicon;
* the training label, a voter with a fixed accuracy (``LABEL_ACCURACY``).

A generative label model is fitted to the votes by expectation-maximisation:
each voter's accuracy (how often it says toxic, clean or nothing given the
truth), and from the posteriors the correlations among voters given the truth.
A voter that repeats others counts for less (its log-odds are divided by one
plus its correlations with the others), so many voices with one opinion do not
outvote the rest.  A linear classifier over hashed words, word beginnings and
the number of lexicon entries present is then trained on the posterior labels,
and it scores every whole text.

Labels are read only for rows whose crc32(doc_id) mod 5 is not 0, at most
``bound`` of them (a documented parameter); doc_id, lang, source and labels are
no inputs of a score.

Defined cases: null or empty text has no features; its score is that of the
bias.  With no labelled rows only the fixed voters and the bias remain and all
scores are the prior.  Repeated rows get the same score; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import (Hasher, bounded_batches, held_out, labelled_sample, lower_ascii, map_rows, sigmoid,
                                  stack, text_of)

BITS = 18
BOUND = 4_000
INSULTS = ("clown disgusting idiot imbecile jerk loser moron pathetic scum stupid trash worthless").split()
_TOKEN = re.compile(r"[^\W\d_]+")
_ADDRESSED = re.compile(r"\byou\W+(?:\w+\W+){0,3}(?:" + "|".join(INSULTS) + r")\b", re.I)
TOXIC, CLEAN, SILENT = 1, 0, -1
LABEL_ACCURACY = 0.98


def tokens(text: str | None) -> set[str]:
    return set(_TOKEN.findall(lower_ascii(text or "")))


def beginnings(words: set[str]) -> set[str]:
    """Words as they are and their first four and five letters ('^' marks these)."""
    out = set(words)
    for w in words:
        if len(w) > 4:
            out.add("^" + w[:4])
            out.add("^" + w[:5])
        elif len(w) == 4:
            out.add("^" + w)
    return out


def mine_lexicon(rows: list[np.ndarray], labels: list[int], names: list[str], most: int = 64,
                 precision: float = 0.9, least: int = 4) -> list[str]:
    """Word beginnings that stand almost only in toxic training rows: greedily the
    one that covers most toxic rows no earlier one does (the longer of equals).

    ``rows`` hold positions in ``names``.
    """
    def rows_with(y: int) -> np.ndarray:
        held = [r for r, label in zip(rows, labels) if label == y]
        return np.bincount(np.concatenate(held), minlength=len(names)) if held else np.zeros(len(names), np.int64)

    toxic, clean = rows_with(TOXIC), rows_with(CLEAN)
    good = (toxic >= least) & (toxic >= precision * (toxic + clean))
    holders = {i: r[good[r]].tolist() for i, (r, y) in enumerate(zip(rows, labels)) if y}
    at: dict[int, list[int]] = {}
    for i, found in holders.items():
        for w in found:
            at.setdefault(w, []).append(i)
    gain, out = {w: len(x) for w, x in at.items()}, []
    while gain and len(out) < most:
        best = max(gain.values())
        if best < least:
            break
        w = max((w for w, g in gain.items() if g == best), key=lambda w: (len(at[w]), len(names[w]), names[w]))
        out.append(names[w])
        for i in at[w]:  # rows that count no more for any other
            for x in holders.pop(i, ()):
                gain[x] -= 1
    return out


def features_of(slots: np.ndarray, n_words: int, hits: int, slot: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text: a word or beginning counts one by the root of
    the number of words, whether one or two lexicon entries are present one each."""
    values = np.full(len(slots) + 2, max(1, n_words) ** -0.5, np.float32)
    values[-2:] = hits > 0, hits > 1
    return np.concatenate([slots, np.array([slot("+1"), slot("+2")], np.int32)]), values


def votes_of(hits: list[bool], label: int | None, addressed: bool) -> list[int]:
    """One vote per voter: fixed insults, mined beginnings (``hits``, in this
    order), the patterns, the label.

    ``addressed``: the text says "you" shortly before an insult.
    """
    patterns = [TOXIC if sum(hits[:len(INSULTS)]) >= 2 else SILENT,
                TOXIC if sum(hits) >= 2 else SILENT,
                TOXIC if addressed else SILENT,
                CLEAN if not any(hits) else SILENT,
                SILENT if label is None else label]
    return [TOXIC if h else SILENT for h in hits] + patterns


@dataclass
class LabelModel:
    prior: float
    rates: np.ndarray       # voter x truth x (silent, clean, toxic)
    correlation: np.ndarray  # voter x voter, given the truth
    posterior: np.ndarray   # per training row


def fit_label_model(votes: np.ndarray, rounds: int = 25) -> LabelModel:
    """EM over (rows x voters) votes in {-1, 0, 1}; the last voter, the label,
    starts it and keeps its fixed accuracy."""
    n, m = votes.shape
    onehot = np.stack([votes == k for k in (SILENT, CLEAN, TOXIC)], axis=2).astype(float)
    says_toxic = (votes == TOXIC).sum(1) - 2.0 * (votes == CLEAN).sum(1)
    q = np.where(votes[:, -1] == SILENT, sigmoid(says_toxic - 0.5), np.where(votes[:, -1] == TOXIC, 0.95, 0.05))
    discount, corr = np.ones(m), np.zeros((m, m))
    prior, rates = 0.5, np.zeros((m, 2, 3))
    for _ in range(rounds):
        prior = float(np.clip(q.mean(), 1e-3, 1 - 1e-3))
        for t, weight in ((0, 1 - q), (1, q)):
            rates[:, t] = (np.einsum("nmk,n->mk", onehot, weight) + 0.1) / (weight.sum() + 0.3)
        rates[-1] = [[0, LABEL_ACCURACY, 1 - LABEL_ACCURACY], [0, 1 - LABEL_ACCURACY, LABEL_ACCURACY]]
        rates = np.maximum(rates, 1e-6)
        corr = _correlations(votes, q)
        discount = 1.0 / (1.0 + np.clip(corr, 0, 1).sum(1) - np.clip(np.diag(corr), 0, 1))
        discount[-1] = 1.0
        odds = np.log(rates[:, 1] / rates[:, 0])
        score = np.einsum("nmk,mk,m->n", onehot, odds, discount) + np.log(prior / (1 - prior))
        q = sigmoid(score)
    return LabelModel(prior, rates, corr, q)


def _correlations(votes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Correlation of voters' speaking, given the truth (mean over both truths by weight)."""
    x = np.where(votes == SILENT, 0.0, np.where(votes == TOXIC, 1.0, -1.0))
    total = np.zeros((x.shape[1], x.shape[1]))
    for w in (q, 1 - q):
        s = w.sum()
        if s < 2:
            continue
        c = x - (w @ x) / s
        cov = (c * w[:, None]).T @ c / s
        sd = np.sqrt(np.diag(cov)) + 1e-6
        total += cov / sd[:, None] / sd[None, :] * (s / len(q))
    return total


def fit_linear(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, bits: int = BITS,
               rounds: int = 200, rate: float = 0.05, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels over sparse rows (slots, values)."""
    size, n = 1 << bits, len(rows)
    w, b = np.zeros(size), 0.0
    if not n:
        return w, b
    at, slot, val = stack(rows)
    # slots of a single row cannot be told from noise
    common = np.bincount(slot, minlength=size) >= 3
    keep = common[slot]
    at, slot, val = at[keep], slot[keep], val[keep]
    p = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    b = float(np.log(p / (1 - p)))
    used, slot = np.unique(slot, return_inverse=True)
    v, m1, m2, mb, vb = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    weight = np.where(target > 0.5, 0.5 / p, 0.5 / (1 - p)) / n  # both classes count alike
    for step in range(1, rounds + 1):
        e = (sigmoid(np.bincount(at, val * v[slot], n) + b) - target) * weight
        g, gb = np.bincount(slot, val * e[at], len(used)) + l2 * v, e.sum()
        m1 += 0.1 * (g - m1)
        m2 += 0.001 * (g * g - m2)
        mb += 0.1 * (gb - mb)
        vb += 0.001 * (gb * gb - vb)
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        v -= rate * (m1 / c1) / (np.sqrt(m2 / c2) + 1e-8)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    w[used] = v
    return w, b


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    lexicon: list[str]
    label_model: LabelModel | None


def train(docs: DataFrame, labels: DataFrame, bound: int = BOUND, bits: int = BITS) -> ToxicityModel:
    sample = labelled_sample(docs, labels, ["toxic"], bound)

    def known(b: dict) -> dict:
        words = [sorted(tokens(t)) for t in b["text"]]
        you = [_ADDRESSED.search(t) is not None for t in b["text"]]
        return {"_id": b["_id"], "toxic": [int(x) for x in b["toxic"]],
                "words": ["\n".join(w) for w in words], "you": you}

    got = map_rows(sample, known, "_id long, toxic long, words string, you boolean").toArrow()
    got = got.sort_by([("_id", "ascending"), ("words", "ascending")])
    y = got["toxic"].to_pylist()
    if not y:
        return ToxicityModel(np.zeros(1 << bits), -2.0, [], None)
    number: dict[str, int] = {}  # every feature is kept once
    rows, n_words = [], []
    for text in got["words"]:
        words = set(text.as_py().split("\n")) - {""}
        n_words.append(len(words))
        rows.append(np.array([number.setdefault(f, len(number)) for f in sorted(beginnings(words))], np.int32))
    names = list(number)
    lexicon = mine_lexicon(rows, y, names)
    voters = [*INSULTS, *lexicon]
    known_as = np.array([number.get(w, -1) for w in voters])
    hits = [np.isin(known_as, r) for r in rows]
    votes = np.array([votes_of(h.tolist(), t, you) for h, t, you in zip(hits, y, got["you"].to_pylist())])
    model = fit_label_model(votes)
    slot = Hasher(bits)
    slots = np.array([slot(f) for f in names], np.int32)
    w, b = fit_linear([features_of(slots[r], n, len({voters[i] for i in np.flatnonzero(h)}), slot)
                       for r, n, h in zip(rows, n_words, hits)], model.posterior, bits)
    return ToxicityModel(w, b, lexicon, model)


def score_documents(docs: DataFrame, model: ToxicityModel, bits: int = BITS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score in 0..1, predicted."""
    score = text_scorer(model, bits)
    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    out = map_rows(d, lambda b: {"doc_id": b["doc_id"], "score": score(b["text"])}, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: Weights are summed as whole multiples of this, so that no order of words changes a score.
UNIT = 2.0 ** -36
#: Bytes of remembered words after which a scorer starts anew.
REMEMBER = 32 << 20


class _Words(dict):
    """Word -> number; what a word brings to a score stands in arrays at that number:
    its own weight and the numbers of its weighted beginnings (0: none)."""

    def __init__(self, model: ToxicityModel, bits: int):
        super().__init__()
        at = np.flatnonzero(model.weights)
        self.used = dict(zip(at.tolist(), np.rint(model.weights[at] / UNIT).astype(np.int64).tolist()))
        self.lexicon, self.mask = {*INSULTS, *model.lexicon}, (1 << bits) - 1
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.bytes, self.begin, self.begin_weight, self.entries = 0, {}, [0], {}
        self.own, self.first, self.second = (np.zeros(1 << 12, np.int64) for _ in range(3))

    def weight(self, feature: str) -> int:
        return self.used.get(zlib.crc32(feature.encode("utf-8", "surrogatepass")) & self.mask, 0)

    def beginning(self, feature: str) -> int:
        n = self.begin.get(feature)
        if n is None:
            w = self.weight(feature)
            n = self.begin[feature] = len(self.begin_weight) if w else 0
            if w:
                self.begin_weight.append(w)
        return n

    def __missing__(self, word: str) -> int:
        n = len(self)
        if n == len(self.own):
            self.own, self.first, self.second = (np.concatenate([a, np.zeros_like(a)])
                                                 for a in (self.own, self.first, self.second))
        self[word] = n
        self.own[n] = self.weight(word)
        features = beginnings({word}) - {word}
        self.first[n], self.second[n] = (*(self.beginning(f) for f in sorted(features)), 0, 0)[:2]
        found = [f for f in (*features, word) if f in self.lexicon]
        if found:
            self.entries[word] = found
        self.bytes += 400 + 4 * len(word)
        return n


def text_scorer(model: ToxicityModel, bits: int) -> Callable[[list[str]], list[float]]:
    """Texts -> scores.  Words are looked up once per text, their weights summed by array."""
    known = _Words(model, bits)
    one, two = known.weight("+1") * UNIT, known.weight("+2") * UNIT

    def score(texts: list[str]) -> list[float]:
        if known.bytes > REMEMBER:
            known.forget()
        z = []
        for t in texts:
            words = tokens(t)
            at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            begin = np.unique(np.concatenate([known.first[at], known.second[at]]))
            total = int(known.own[at].sum()) + sum(map(known.begin_weight.__getitem__, begin.tolist()))
            hits = {f for w in known.entries.keys() & words for f in known.entries[w]}
            z.append(model.bias + one * (len(hits) > 0) + two * (len(hits) > 1) + total * UNIT / max(1, len(words)) ** 0.5)
        return sigmoid(np.array(z, np.float64)).tolist()

    return score


def keep_clean(docs: DataFrame, model: ToxicityModel, bits: int = BITS) -> DataFrame:
    """Rows of ``docs`` scored under 0.5, columns unchanged, in one pass."""
    score = text_scorer(model, bits)
    bounded_batches(docs.sparkSession)
    scored = F.pandas_udf(lambda s: pd.Series(score(s.tolist())), "double")
    return docs.filter(scored(text_of()) < 0.5)
