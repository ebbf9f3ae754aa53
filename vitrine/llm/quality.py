"""Quality rules: two fixed rules and gradient-boosted trees over document statistics.

Statistics are computed per text in NumPy (``statistics``), over whole texts.  The trees (``fit_trees``) are
trained on at most ``MAX_LABELS`` labelled documents, those with the smallest id hash, with logistic loss,
histogram splits and monotonic constraints: more symbols, repetition or upper case never raise the score.
They are stored as flat arrays, one row a tree in heap order, and scored for a whole batch at once.

Defined results.  Null or wordless text: all counts 0, fails the base rule.  Repeated rows are judged alike;
the verdict depends on the text only.  Without labels of both kinds the trees keep everything.  Empty
table: no rows.  Columns named like a result column are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import with_computed

MAX_LABELS = 20_000     # labelled documents to learn from, at most
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5         # probability of good quality from which a document stays
TREES, DEPTH, RATE, BINS, RIDGE, LEAF = 60, 3, 0.2, 64, 1.0, 10

#: Statistics that the trees see, and the sign of their effect on quality (0: free).
FEATURES = {"words_log": 0, "mean_word": 0, "symbols_per_word": -1, "dup_lines": -1, "repeats": -1, "upper": -1,
            "exclaims": -1, "bars": -1, "digits": 0, "periods": 0, "distinct": 0, "lines_per_word": 0}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL, _UPPER, _LOWER, _DIGIT, _EXCLAIM, _PERIOD, _NEWLINE, _WHITE, _TAIL, _OTHER = range(10)
_KIND = np.full(256, _OTHER, np.int64)
_KIND[0x80:0xC0] = _TAIL
_KIND[65:91], _KIND[97:123], _KIND[48:58] = _UPPER, _LOWER, _DIGIT
_KIND[[9, 11, 12, 13, 32]] = _WHITE
_KIND[10] = _NEWLINE
_KIND[ord("!")], _KIND[ord(".")] = _EXCLAIM, _PERIOD
_KIND[[ord(c) for c in "#*$%&|<>"]] = _SYMBOL


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(counts, features)`` of every text: the columns of ``COUNTS`` and of ``FEATURES``."""
    counts, features = [], []
    for lo, hi, data, off in W.slices(texts):
        nd = hi - lo
        size = np.diff(off)
        doc = np.repeat(np.arange(nd), size)
        kinds = np.bincount(doc * 10 + _KIND[data], minlength=nd * 10).reshape(nd, 10)
        keys, first = W.word_keys(data, off, False)
        n_words = np.diff(first)
        word_doc = np.repeat(np.arange(nd), n_words)
        # words in 3-word windows that occur twice or more
        window = W.combine(keys, 3)
        inside = np.arange(len(window)) + 3 <= first[1:][word_doc[: len(window)]]
        own = W.mix(window ^ W.mix(word_doc[: len(window)].astype(np.uint64)))
        at = np.flatnonzero(inside)
        at = at[np.argsort(own[at])]
        same = own[at[1:]] == own[at[:-1]]
        covered = np.zeros(len(keys) + 3, bool)
        twice = np.union1d(at[1:][same], at[:-1][same])
        for j in range(3):
            covered[twice + j] = True
        n_repeat = np.bincount(word_doc[covered[: len(keys)]], minlength=nd)
        # lines with a word, and those that repeat an earlier one
        breaks = np.flatnonzero(data == 10)
        docs, splits = np.arange(nd), doc[breaks]
        starts, line_doc = np.concatenate([off[:-1], breaks + 1]), np.concatenate([docs, splits])
        ends, end_doc = np.concatenate([off[1:], breaks]), np.concatenate([docs, splits])
        order = np.lexsort((starts, line_doc))
        starts, line_doc, ends = starts[order], line_doc[order], ends[np.lexsort((ends, end_doc))]
        solid = np.concatenate([[0], np.cumsum(~W._SPACE[data])])
        worded = solid[ends] > solid[starts]
        line_key, line_doc = W.span_keys(data, starts[worded], ends[worded], False), line_doc[worded]
        n_lines = np.bincount(line_doc, minlength=nd)
        n_dup = n_lines - W.distinct(line_key, line_doc, nd)[1]
        chars = size - kinds[:, _TAIL] - kinds[:, _WHITE] - kinds[:, _NEWLINE]
        counts.append(np.stack([n_words, chars, kinds[:, _SYMBOL], n_dup, n_repeat], axis=1))
        w, letters = np.maximum(n_words, 1), np.maximum(kinds[:, _UPPER] + kinds[:, _LOWER], 1)
        bars = np.bincount(doc[data == ord("|")], minlength=nd)
        features.append(np.stack([
            np.log1p(n_words), chars / w, kinds[:, _SYMBOL] / w, n_dup / np.maximum(n_lines, 1), n_repeat / w, kinds[:, _UPPER] / letters,
            kinds[:, _EXCLAIM] / w, bars / w, kinds[:, _DIGIT] / w, kinds[:, _PERIOD] / w, W.distinct(keys, word_doc, nd)[1] / w, n_lines / w], axis=1))
    if not counts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate(counts).astype(np.int64), np.concatenate(features)


class Trees(NamedTuple):
    """Flat trees in heap order (children of ``i``: ``2i+1``, ``2i+2``): inner nodes, then leaf values."""

    feature: np.ndarray     # trees x (2**depth - 1)
    threshold: np.ndarray
    value: np.ndarray       # trees x 2**depth
    base: float


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Boosted trees for logistic loss; a feature of sign +1 / -1 can only raise / lower the score."""
    if not len(y) or y.min() == y.max():
        return Trees(np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1)), np.zeros((0, 2**depth)), 0.0)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    score = np.full(len(y), base)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        low, high = np.full(2 ** (depth + 1) - 1, -np.inf), np.full(2 ** (depth + 1) - 1, np.inf)
        node = np.zeros(len(y), np.int64)
        for k in range(2**depth - 1):
            rows = np.flatnonzero(node == k)
            best = (1e-6, 0, np.inf, 0.0)
            for f, e in enumerate(edges):
                if not len(e) or len(rows) < 2 * LEAF:
                    continue
                b = binned[rows, f]
                gs, hs, ns = (np.cumsum(np.bincount(b, v, len(e) + 1)) for v in (g[rows], h[rows], np.ones(len(rows))))
                gl, hl, nl = gs[:-1], hs[:-1], ns[:-1]
                gr, hr, nr = gs[-1] - gl, hs[-1] - hl, ns[-1] - nl
                vl, vr = np.clip(gl / (hl + RIDGE), low[k], high[k]), np.clip(gr / (hr + RIDGE), low[k], high[k])
                gain = (gl * vl - (hl + RIDGE) * vl**2 / 2) + (gr * vr - (hr + RIDGE) * vr**2 / 2)
                v0 = np.clip(gs[-1] / (hs[-1] + RIDGE), low[k], high[k])
                gain -= gs[-1] * v0 - (hs[-1] + RIDGE) * v0**2 / 2
                gain[(nl < LEAF) | (nr < LEAF) | (signs[f] * (vr - vl) < 0)] = -1
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), f, float(e[i]), float(vl[i] + vr[i]) / 2)
            _, feature[k], threshold[k], middle = best
            right = x[rows, feature[k]] > threshold[k]
            node[rows] = 2 * k + 1 + right
            for child, sign in ((2 * k + 1, 1), (2 * k + 2, -1)):
                low[child], high[child] = low[k], high[k]
                s = signs[feature[k]] * sign
                if threshold[k] < np.inf and s > 0:
                    high[child] = min(high[child], middle)
                elif threshold[k] < np.inf and s < 0:
                    low[child] = max(low[child], middle)
        leaf = node - (2**depth - 1)
        value = np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + RIDGE)
        value = rate * np.clip(value, low[2**depth - 1:], high[2**depth - 1:])
        score += value[leaf]
        made.append((feature, threshold, value))
    return Trees(*(np.stack(c) for c in zip(*made)), base)


def score_trees(model: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of good quality of every row."""
    total = np.full(len(x), model.base)
    depth = int(np.log2(model.value.shape[1]))
    rows = np.arange(len(x))
    for feature, threshold, value in zip(model.feature, model.threshold, model.value):
        node = np.zeros(len(x), np.int64)
        for _ in range(depth):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        total += value[node - (2**depth - 1)]
    return 1 / (1 + np.exp(-total))


def train(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> Trees:
    """Trees from at most ``max_labels`` labelled documents (smallest id hashes)."""
    known = (labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    fields = ", ".join(f"f{i} double" for i in range(len(FEATURES)))
    got = np.array(with_computed(rows, "text", fields, lambda t: list(statistics(t)[1].T)).drop("doc_id", "text").toPandas(), np.float64)
    got = got.reshape(-1, len(FEATURES) + 1)
    return fit_trees(got[:, 1:], (got[:, 0] > 0).astype(float), list(FEATURES.values()))


def judged(docs: DataFrame, model: Trees, keep_from: float = KEEP_FROM, min_words: int = MIN_WORDS,
           max_repeat_percent: int = MAX_REPEAT_PERCENT, prefix: str = "") -> DataFrame:
    """``docs`` with counts, ``base_failed``, ``quality_score`` and ``kept`` (names begin with ``prefix``)."""
    def compute(texts: pa.Array) -> list:
        counts, x = statistics(texts)
        failed = (counts[:, 0] < min_words) | (100 * counts[:, 4] > max_repeat_percent * counts[:, 0])
        score = score_trees(model, x)
        return [*counts.T, failed, score, ~failed & (score >= keep_from)]
    fields = ", ".join([*(f"{prefix}{c} bigint" for c in COUNTS), f"{prefix}base_failed boolean", f"{prefix}quality_score double", f"{prefix}kept boolean"])
    return with_computed(docs, "text", fields, compute)
