"""Document quality from line labels: a linear-chain conditional random field over lines.

Every line has two labels, good and bad. Its scores come from shape features of the line and of its
neighbours; a transition matrix joins adjacent lines. Training maximises the likelihood of the lines of
labelled documents, each line with its document's label. A document's score is the mean of the
forward-backward marginals of its lines, weighted by their lengths.

Scale: weights are fitted by the driver on the whole texts of at most ``SAMPLE`` labelled documents of either
label. Scoring is one pass over whole texts, without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked

_SYMBOL = re.compile(r"[#*$%&|<>=@^~{}\[\]\\_+]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]{2,}")
_DIGIT = re.compile(r"[0-9]")
_STOP = re.compile(r"[.!?]")
N_OWN = 14
#: Labelled documents that are learned from, at most, for each label.
SAMPLE = 400


def line_features(line: str) -> list[float]:
    """Shape of one line: bounded numbers, mostly ratios by words or characters."""
    words = line.split()
    n = len(words)
    if not n:
        return [0.0] * (N_OWN - 1) + [1.0]
    chars = sum(map(len, words))
    symbols = len(_SYMBOL.findall(line))
    upper = sum(map(len, _UPPER.findall(line)))
    distinct = len(set(words))
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        1.0,
        min(1.0, n / 50),
        min(3.0, chars / n / 5),
        min(2.0, symbols / n),
        min(1.0, upper / chars),
        same / n,
        distinct / n,
        min(1.0, line.count("!") / n),
        min(1.0, line.count("|") / n),
        sum(len(w) <= 3 for w in words) / n,
        min(1.0, len(_STOP.findall(line)) / n),
        min(1.0, line.count(",") / n),
        min(1.0, len(_DIGIT.findall(line)) / chars),
        0.0,
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines of a text with those of both neighbours, and the weights of the lines."""
    lines = text.split("\n")
    own = np.array([line_features(x) for x in lines])
    edge = np.zeros((1, N_OWN))
    rows = np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])])
    return rows, np.array([len(x) + 1.0 for x in lines])


def marginals(scores: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Label marginals of each line, summed pair marginals, and the log partition, by forward-backward."""
    n = len(scores)
    peak = scores.max(axis=1, keepdims=True)
    local = np.exp(scores - peak).tolist()
    (a, b), (c, d) = np.exp(trans).tolist()
    forward, backward, scale = [None] * n, [None] * n, [0.0] * n
    x, y = local[0]
    for i in range(n):
        if i:
            p, q = forward[i - 1]
            x, y = (p * a + q * c) * local[i][0], (p * b + q * d) * local[i][1]
        scale[i] = x + y
        forward[i] = (x / scale[i], y / scale[i])
    x = y = 1.0
    backward[n - 1] = (x, y)
    for i in range(n - 1, 0, -1):
        u, v = local[i][0] * x / scale[i], local[i][1] * y / scale[i]
        x, y = a * u + b * v, c * u + d * v
        backward[i - 1] = (x, y)
    f, g = np.array(forward), np.array(backward)
    single = f * g
    pair = np.zeros((2, 2))
    if n > 1:
        after = np.array(local)[1:] * g[1:] / np.array(scale)[1:, None]
        pair = np.exp(trans) * (f[:-1].T @ after)
    return single, pair, float(peak.sum() + np.log(scale).sum())


class LineModel:
    """Weights of the random field: features by label, and transitions."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        self.weights, self.trans = weights, trans

    def score(self, text: str | None) -> float:
        """Probability-like quality of a document: the length-weighted mean of the lines' marginals."""
        rows, weight = document_features(text or "")
        single, _, _ = marginals(rows @ self.weights, self.trans)
        return float(single[:, 1] @ weight / weight.sum())


def fit(samples: list[tuple[str, int]], steps: int = 80, rate: float = 0.1, decay: float = 1e-3) -> LineModel:
    """Weights by gradient ascent (Adam) on the regularised likelihood; labels weigh alike in sum."""
    weights, trans = np.zeros((3 * N_OWN, 2)), np.zeros((2, 2))
    data = [(document_features(t)[0], y) for t, y in samples]
    counts = np.array([sum(y == k for _, y in data) for k in (0, 1)], float)
    if not counts.all():  # one label only: answer it, with the certainty that its count gives
        known = 0.5 if not counts.sum() else (counts[1] + 1) / (counts.sum() + 2)
        weights[0] = [np.log(1 - known), np.log(known)]
        return LineModel(weights, trans)
    scale = counts.sum() / 2 / counts
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(trans), np.zeros_like(trans)]
    total = sum(len(r) * scale[y] for r, y in data)
    for step in range(1, steps + 1):
        gw, gt = -decay * weights, -decay * trans
        for rows, y in data:
            single, pair, _ = marginals(rows @ weights, trans)
            want = np.zeros_like(single)
            want[:, y] = 1
            gw = gw + scale[y] / total * (rows.T @ (want - single))
            goal = np.zeros((2, 2))
            goal[y, y] = len(rows) - 1
            gt = gt + scale[y] / total * (goal - pair)
        for x, g, k in ((weights, gw, 0), (trans, gt, 2)):
            moments[k] = 0.9 * moments[k] + 0.1 * g
            moments[k + 1] = 0.999 * moments[k + 1] + 0.001 * g * g
            x += rate * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 1] / (1 - 0.999**step)) + 1e-8)
        np.clip(trans, -2, 2, out=trans)  # lines share their document's label; keep them able to differ
    return LineModel(weights, trans)


def sample_labels(labels: DataFrame, label: str = "quality", key: str = "doc_id") -> DataFrame:
    """``(key, label)`` of at most ``SAMPLE`` rows of label 0 and of label 1, in hash order of the key."""
    some = labels.select(F.col(key), F.col(label).cast("int").alias(label)).where(F.col(key).isNotNull())
    picked = [some.where(F.col(label) == y).orderBy(F.xxhash64(key), key).limit(SAMPLE) for y in (0, 1)]
    return picked[0].union(picked[1])


def score_quality(docs: DataFrame, learn: DataFrame, text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1, higher is better) and ``predicted`` (1 from 0.5 on).

    ``learn`` has a text and a label of 0 or 1 a row; rows with a null in either are left out, and at most
    ``SAMPLE`` of either label are learned from, in hash order of their texts. Whole texts are read in both.
    Null texts are scored as empty ones, repeated rows alike; without labels every score is 0.5, and an
    empty table gives an empty table. Other columns pass through; old columns of the result names (in
    any case) are replaced.
    """
    rows = learn.select(F.col(text).alias("body"), F.col(label).cast("int").alias("y")).where("body IS NOT NULL")
    picked = []
    for y in (0, 1):
        picked += [tuple(r) for r in rows.where(F.col("y") == y).orderBy(F.xxhash64("body"), "body").limit(SAMPLE).collect()]
    model = fit(picked)
    passed, row = packed(docs, ["score", "predicted"], text)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    scored = docs.select(row.alias("row"), F.col(text).alias("text"), score(F.col(text)).alias("score"))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    return scored.select(*unpacked(passed, "row", text, F.col("text")), "score", predicted)
