"""Quality classifier: ordinal cumulative-link regression (operator 1).

Ratings are grades 0..K-1.  One weight vector over hashed text features is
shared by all grades; ordered thresholds t_1 < ... < t_{K-1} cut its score:

    P(grade >= k) = sigmoid(w . x - t_k)

The expected grade is the sum of these tail probabilities.  A document is
selected when the tail probability of the wanted grade reaches ``cut``.

Features: every word's count and every token shape's count (letters -> a or A,
digits -> 9, runs shortened, so marks, capitals and tables show), damped by
log, plus the shares of repeated lines and words; all divided by their length.

The fit uses at most ``bound`` labelled rows (a documented parameter, see
``common.labelled_sample``): hashed counts of those come to the driver and are
fitted there by full-batch Adam with numpy, weights on four fifths, then scale
and thresholds on the rest, which calibrates the tail probabilities.  Scoring
reads every whole text.

Defined cases: null or empty text has no features but the bias, and is scored;
documents without a label are scored; with no labelled rows all weights are 0;
repeated rows get the same score; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featspark.llm.common import (Hasher, held_out, labelled_sample, lower_ascii, map_rows, sigmoid,
                                  stack, text_of, word_counts)

BITS = 16
BOUND = 6_000


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k), one column per k = 1..K-1."""
        return sigmoid(np.asarray(scores)[:, None] - self.thresholds[None, :])


_DIGITS, _LOW, _UP = re.compile(r"\d+"), re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+")


def _shape(word: str) -> str:
    return "\x02" + _UP.sub("A", _LOW.sub("a", _DIGITS.sub("9", word)))[:12]


class TextFeatures:
    """Text -> (slots, values) of unit length."""

    def __init__(self, bits: int = BITS):
        self.slot, self.shapes = Hasher(bits), {}

    def __call__(self, text: str | None) -> tuple[list[int], list[float]]:
        words = word_counts(text or "")
        n = sum(words.values())
        if not n:
            return [], []
        acc: dict[int, float] = {}
        for w, c in words.items():
            s = self.shapes.get(w)
            if s is None:
                if len(self.shapes) > 100_000:
                    self.shapes.clear()
                s = self.shapes[w] = (self.slot("\x01" + lower_ascii(w)), self.slot(_shape(w)))
            acc[s[0]] = acc.get(s[0], 0) + c
            acc[s[1]] = acc.get(s[1], 0) + c
        lines = [x for x in text.split("\n") if x.strip()]
        marks = {"\x03lines": 1 - len(set(lines)) / max(1, len(lines)), "\x03words": 1 - len(words) / n}
        slots = list(acc)
        v = np.log1p(np.fromiter(acc.values(), float, len(acc)))
        v /= math.sqrt(float(v @ v))
        return slots + [self.slot(k) for k in marks], v.tolist() + list(marks.values())


def _ordinal_gradients(score: np.ndarray, y: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the mean negative log likelihood: by score, by threshold."""
    n, rows = len(y), np.arange(len(y))
    tail = np.hstack([np.ones((n, 1)), sigmoid(score[:, None] - cuts), np.zeros((n, 1))])
    p = np.maximum(tail[rows, y] - tail[rows, y + 1], 1e-9)
    d = tail * (1 - tail)
    dcut = np.zeros(len(cuts) + 2)
    np.add.at(dcut, y, d[rows, y] / p / n)
    np.add.at(dcut, y + 1, -d[rows, y + 1] / p / n)
    return -(d[rows, y] - d[rows, y + 1]) / p / n, dcut[1:-1]


class _Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.step, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def move(self, x: np.ndarray, g: np.ndarray) -> None:
        self.step += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        x -= self.rate * (self.m / (1 - 0.9 ** self.step)) / (np.sqrt(self.v / (1 - 0.999 ** self.step)) + 1e-8)


def _cuts(t: np.ndarray) -> np.ndarray:
    """Ordered thresholds: the first one and the logs of the gaps."""
    return np.concatenate([t[:1], t[0] + np.cumsum(np.exp(t[1:]))])


def _cut_gradient(t: np.ndarray, dcut: np.ndarray) -> np.ndarray:
    return np.concatenate([[dcut.sum()], [np.exp(t[j]) * dcut[j:].sum() for j in range(1, len(t))]])


def fit_ordinal(rows: list[tuple[list[int], list[float]]], grades: list[int], n_grades: int,
                bits: int = BITS, rounds: int = 200, rate: float = 0.05, l2: float = 1e-5) -> OrdinalModel:
    """Maximum likelihood with ordered thresholds, calibrated on every fifth row."""
    size, y = 1 << bits, np.asarray(grades, dtype=np.int64)
    w, t = np.zeros(size), np.zeros(n_grades - 1)
    if not len(y):
        return OrdinalModel(w, np.arange(n_grades - 1, dtype=float))
    fit = np.arange(len(y)) % 5 > 0 if len(y) >= 50 else np.ones(len(y), bool)
    at, slot, val = stack([r for r, f in zip(rows, fit) if f])
    for_w, for_t = _Adam(size, rate), _Adam(len(t), rate)
    for _ in range(rounds):
        ds, dc = _ordinal_gradients(np.bincount(at, val * w[slot], fit.sum()), y[fit], _cuts(t))
        for_w.move(w, np.bincount(slot, val * ds[at], size) + l2 * w)
        for_t.move(t, _cut_gradient(t, dc))
    rest = ~fit if (~fit).any() else fit
    at, slot, val = stack([r for r, f in zip(rows, rest) if f])
    score = np.bincount(at, val * w[slot], rest.sum())
    a, for_a, for_t = np.ones(1), _Adam(1, 0.02), _Adam(len(t), 0.02)
    for _ in range(600):
        ds, dc = _ordinal_gradients(a[0] * score, y[rest], _cuts(t))
        for_a.move(a, np.array([ds @ score + 1e-3 * (a[0] - 1)]))
        for_t.move(t, _cut_gradient(t, dc))
    return OrdinalModel(w * max(a[0], 0.0), _cuts(t))


def train(docs: DataFrame, labels: DataFrame, grade: str, n_grades: int, bound: int = BOUND,
          bits: int = BITS) -> OrdinalModel:
    """Fit on at most ``bound`` labelled rows; ``grade`` is a SQL expression over ``labels``."""
    lab = labels.select("doc_id", F.expr(grade).cast("bigint").alias("grade"))
    sample = labelled_sample(docs, lab, ["grade"], bound)
    features = TextFeatures(bits)

    def hashed(b: dict) -> dict:
        f = [features(t) for t in b["text"]]
        return {"_id": b["_id"], "grade": b["grade"], "slots": [x[0] for x in f], "vals": [x[1] for x in f]}

    got = map_rows(sample, hashed, "_id long, grade long, slots array<long>, vals array<double>").toArrow()
    got = got.sort_by("_id").to_pydict()
    return fit_ordinal(list(zip(got["slots"], got["vals"])), got["grade"], n_grades, bits)


def grade_documents(docs: DataFrame, model: OrdinalModel, wanted: int = 1, cut: float = 0.5,
                    bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, expected_grade,
    tail_1..tail_{K-1}, kept (tail of ``wanted`` >= cut)."""
    w, features, n = model.weights.astype(np.float32), TextFeatures(bits), len(model.thresholds)

    def score(b: dict) -> dict:
        f = [features(t) for t in b["text"]]
        s = np.array([float(w[i] @ np.asarray(v, np.float32)) if i else 0.0 for i, v in f])
        tails = model.tails(s)
        return {"doc_id": b["doc_id"], "score": s, "expected_grade": tails.sum(axis=1),
                **{f"tail_{k + 1}": tails[:, k] for k in range(n)}}

    d = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    tails = [f"tail_{k + 1}" for k in range(n)]
    out = map_rows(d, score, "doc_id long, score double, expected_grade double, "
                             + ", ".join(f"{t} double" for t in tails))
    return out.select("doc_id", held_out().alias("held_out"), "score", "expected_grade", *tails,
                      (F.col(f"tail_{wanted}") >= cut).alias("kept"))
