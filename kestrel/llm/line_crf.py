"""Document quality by a linear-chain CRF over lines (operator 8).

Every line of a document that has a word gets features of itself and of its
neighbouring lines; a two-state linear-chain conditional random field labels
lines good or bad. A document's raw quality is the mean of its lines'
forward-backward marginals, weighted by line length; isotonic regression on
the training documents turns it into a calibrated score.

The CRF is fitted on a bounded sample of labelled training documents
(``MAX_TRAIN_DOCS``): lines first take their document's label, then the lines
of bad documents are labelled again by the fitted chain (its worst line stays
bad), and the chain is fitted once more.

Defined cases: null, empty and blank texts have no line and get the rate of
good among all training documents; null labels are left out; of several labels
of a doc_id the largest counts; one line is a chain of one; repeated rows get
equal scores; without labels of both kinds every score is the smoothed rate; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.text import split_words
from kestrel.llm.toxicity import fold, training_sample

FOLDS, HELD_OUT_FOLD = 4, 2
MAX_TRAIN_DOCS = 4000
ITERATIONS, RATE, RIDGE = 80, 0.1, 1e-3
CUT = 0.7
SYMBOLS = "#*$%&<>"
OWN = 11  # features of a line itself
N_FEATURES = 3 * OWN + 1


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT_FOLD, F.lit(False))


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, line lengths) of a text's lines with a word."""
    own, size, seen = [], [], set()
    for line in (text or "").split("\n"):
        words = split_words(line)
        if not words:
            continue
        n, chars = len(words), len(line)
        runs = sum(map(str.__eq__, words[1:], words[:-1]))
        own.append((1.0, min(n, 40) / 40, min(1.0, sum(map(line.count, SYMBOLS)) / n), min(1.0, line.count("|") / n),
                    min(1.0, line.count("!") / n), sum(map(str.isupper, words)) / n, 1 - len(set(words)) / n, runs / n,
                    min(1.0, chars / n / 20), float(line in seen), min(1.0, sum(map(line.count, "0123456789")) / chars)))
        size.append(chars)
        seen.add(line)
    x = np.zeros((len(own), N_FEATURES), dtype=np.float32)
    if own:
        x[:, :OWN] = own
        x[1:, OWN:2 * OWN] = x[:-1, :OWN]
        x[:-1, 2 * OWN:3 * OWN] = x[1:, :OWN]
        x[:, -1] = 1.0 / len(own)
    return x, np.array(size, dtype=np.float64)


def _padded(seqs: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(positions, docs x lines x features, lengths) in batches of like length."""
    order = sorted((i for i in range(len(seqs)) if len(seqs[i])), key=lambda i: len(seqs[i]))
    at = 0
    while at < len(order):
        end, cells = at, 0
        while end < len(order) and (end == at or (end - at + 1) * len(seqs[order[end]]) <= 20_000) and len(seqs[order[end]]) <= 2 * len(seqs[order[at]]):
            end += 1
        ids = order[at:end]
        n = np.array([len(seqs[i]) for i in ids])
        x = np.zeros((len(ids), n.max(), N_FEATURES), dtype=np.float32)
        for k, i in enumerate(ids):
            x[k, :n[k]] = seqs[i]
        yield ids, x, n
        at = end


class LineCrf:
    """Two states (0 bad, 1 good): a weight vector for good and a 2 x 2 table
    of transition scores."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.w = np.zeros(N_FEATURES) if weights is None else weights
        self.t = np.zeros((2, 2)) if moves is None else moves

    def forward_backward(self, x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(good) docs x lines, expected transitions 2 x 2 summed over docs)
        of padded documents, by scaled forward and backward messages."""
        docs, longest, _ = x.shape
        good = np.clip(x @ self.w, -30, 30)
        emit = np.stack([np.ones_like(good), np.exp(good)], axis=2)
        emit /= emit.sum(2, keepdims=True)
        move = np.exp(self.t - self.t.max())
        a = np.empty((docs, longest, 2))
        a[:, 0] = emit[:, 0]
        for j in range(1, longest):
            f = (a[:, j - 1] @ move) * emit[:, j]
            a[:, j] = f / f.sum(1, keepdims=True)
        b = np.ones((docs, longest, 2))
        for j in range(longest - 2, -1, -1):
            f = (emit[:, j + 1] * b[:, j + 1]) @ move.T
            f /= f.sum(1, keepdims=True)
            b[:, j] = np.where((j + 1 < n)[:, None], f, 1.0)
        p = a * b
        p /= p.sum(2, keepdims=True)
        pair = a[:, :-1, :, None] * move * (emit * b)[:, 1:, None, :]
        pair /= np.maximum(pair.sum((2, 3), keepdims=True), 1e-300)
        inside = np.arange(1, longest) < n[:, None]
        return p[:, :, 1], (pair * inside[:, :, None, None]).sum((0, 1))

    def marginals(self, seqs: list[np.ndarray]) -> list[np.ndarray]:
        out = [np.empty(0)] * len(seqs)
        for ids, x, n in _padded(seqs):
            p, _ = self.forward_backward(x, n)
            for k, i in enumerate(ids):
                out[i] = p[k, :n[k]]
        return out

    def fit(self, seqs: list[np.ndarray], labels: list[np.ndarray]) -> LineCrf:
        """Maximum conditional likelihood with a ridge, by Adam on all rows."""
        batches = []
        for ids, x, n in _padded(seqs):
            y = np.zeros(x.shape[:2])
            for k, i in enumerate(ids):
                y[k, :n[k]] = labels[i]
            mask = np.arange(x.shape[1]) < n[:, None]
            state = np.stack([1 - y, y], axis=2)
            pairs = np.einsum("dla,dlb,dl->ab", state[:, :-1], state[:, 1:], mask[:, 1:].astype(float))
            batches.append((x, n, y, mask, pairs))
        lines = sum(b[3].sum() for b in batches)
        theta = np.concatenate([self.w, self.t.ravel()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, ITERATIONS + 1):
            self.w, self.t = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
            g = np.zeros_like(theta)
            for x, n, y, mask, pairs in batches:
                p, expected = self.forward_backward(x, n)
                g[:N_FEATURES] += np.tensordot((y - p) * mask, x, axes=((0, 1), (0, 1)))
                g[N_FEATURES:] += (pairs - expected).ravel()
            g = g / lines - RIDGE * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        self.w, self.t = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        return self


class QualityModel:
    """CRF, calibration steps and the rate for texts without lines."""

    def __init__(self, rate: float, crf: LineCrf | None = None):
        self.rate, self.crf = rate, crf
        self.edges, self.levels = np.array([0.0]), np.array([rate])

    def raw(self, texts: list[str | None]) -> list[float | None]:
        found = [line_features(t) for t in texts]
        return self.raw_of(found)

    def raw_of(self, found: list[tuple[np.ndarray, np.ndarray]]) -> list[float | None]:
        p = self.crf.marginals([x for x, _ in found])
        return [float((q * s).sum() / s.sum()) if len(q) else None for q, (_, s) in zip(p, found, strict=True)]

    def calibrate(self, raw: list[float | None], y: list[int]) -> None:
        pooled: list[list[float]] = []
        for r, label in sorted((round(r, 4), label) for r, label in zip(raw, y, strict=True) if r is not None):
            if pooled and pooled[-1][0] == r:
                pooled[-1][2] += label
                pooled[-1][3] += 1
            else:
                pooled.append([r, r, label, 1])
        out: list[list[float]] = []
        for b in pooled:
            out.append(b)
            while len(out) > 1 and out[-2][2] * out[-1][3] >= out[-1][2] * out[-2][3]:
                _, top, s, c = out.pop()
                out[-1][1] = top
                out[-1][2] += s
                out[-1][3] += c
        if out:  # levels at the middle of each step's raw scores, straight lines between
            self.edges = np.array([(b[0] + b[1]) / 2 for b in out])
            self.levels = np.array([(b[2] + 0.1) / (b[3] + 0.2) for b in out])

    def scores(self, texts: list[str | None]) -> list[float]:
        if self.crf is None:
            return [self.rate] * len(texts)
        return [self.rate if r is None else float(np.interp(r, self.edges, self.levels)) for r in self.raw(texts)]


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """From about MAX_TRAIN_DOCS labelled documents at most; line features
    are made by the tasks, only they come to the driver."""
    sample = training_sample(labels, "quality", ~held_out(), MAX_TRAIN_DOCS)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            f = [line_features(t) for t in texts]
            yield pd.DataFrame({"x": [a.tobytes() for a, _ in f], "size": [b.tobytes() for _, b in f]})

    picked = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # about MAX_TRAIN_DOCS rows at most
    rows = picked.select("doc_id", "y", F.pandas_udf(run, "x binary, size binary")("text").alias("f")).select("doc_id", "y", "f.x", "f.size").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    y = [r["y"] for r in rows]
    rate = (sum(y) + 0.5) / (len(y) + 1)
    if len(set(y)) < 2:
        return QualityModel(rate)
    found = [(np.frombuffer(r["x"], dtype=np.float32).reshape(-1, N_FEATURES), np.frombuffer(r["size"])) for r in rows]
    seqs = [x for x, _ in found]
    line_y = [np.full(len(x), float(label)) for x, label in zip(seqs, y, strict=True)]
    crf = LineCrf().fit(seqs, line_y)
    for i, p in enumerate(crf.marginals(seqs)):
        if not y[i] and len(p):
            line_y[i] = (p > 0.5).astype(float)
            line_y[i][p.argmin()] = 0.0
    model = QualityModel(rate, crf.fit(seqs, line_y))
    model.calibrate(model.raw_of(found), y)
    return model


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = fit(docs, labels)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([s for at in range(0, len(texts), 500) for s in model.scores(list(texts.iloc[at:at + 500]))])

    s = docs.select("doc_id", F.pandas_udf(run, "double")(F.col("text")).alias("score"))
    return s.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
