"""Language ID with error-correcting output codes.

Every language has a codeword of +1/-1 bits; for every bit one linear classifier over hashed byte trigrams
predicts its sign (regularised least squares, trained here on at most ``PER_LANGUAGE`` documents a language,
those with the smallest hashes of id and text).  A text is decoded by loss: the language whose codeword has the smallest
total hinge loss against the bits' margins wins.  ``score`` is the soft-min share of the winner (0 to 1);
a text whose two smallest losses are closer than ``AMBIGUITY`` a bit is flagged ``ambiguous``.

Up to 8 languages get the exhaustive code (all ``2**(k-1) - 1`` splits), more get the best of some random codes.
Predictions see the text alone.

Defined results.  Null text, or a text without any letter: ``und``, score 0, not ambiguous.  Repeated rows get
equal results.  Ties go to the first language in alphabetical order.  No training text: every row is ``und``.
Empty table: no rows.  Columns named like a result column are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import crc32_of_id, with_computed

PER_LANGUAGE = 800      # training documents of a language, at most
DIMS = 2048             # hashed trigrams
RIDGE = 1e-3
FIT_ROWS = 256          # vectors that the fit holds in doubles at once
AMBIGUITY = 0.03
SHARPNESS = 4.0
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)


def trigram_vectors(texts: pa.Array, dims: int = DIMS) -> np.ndarray:
    """Unit vectors of square-rooted trigram counts, one row a text (``dims`` a power of two)."""
    out, shift = [np.zeros((0, dims), np.float32)], np.uint32(33 - dims.bit_length())
    for lo, hi, data, off in W.slices(texts):
        b = _FOLD[data]
        doc = np.repeat(np.arange(hi - lo, dtype=np.int64), np.diff(off))
        h = ((b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(2654435761)) >> shift
        inside = doc[2:] == doc[:-2]
        counts = np.bincount((doc[2:] * dims + h)[inside], minlength=(hi - lo) * dims).reshape(hi - lo, dims)
        v = np.sqrt(counts, dtype=np.float32)
        out.append(v / np.maximum(np.sqrt(counts.sum(axis=1, keepdims=True)), 1).astype(np.float32))
    return np.concatenate(out)


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """``k`` rows of +1/-1 bits, far apart."""
    if k <= 8:
        bits = np.array([[(c >> r) & 1 for c in range(1, 2 ** (k - 1))] for r in range(k - 1)] + [[0] * (2 ** max(k - 1, 0) - 1)])
        return (2 * bits - 1).reshape(k, -1).astype(np.float32)
    rng, length = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(k)))
    codes = [np.where(rng.random((k, length)) < 0.5, -1, 1).astype(np.float32) for _ in range(50)]
    return max(codes, key=lambda c: -(c @ c.T - length * np.eye(k)).max())


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray       # languages x bits
    weights: np.ndarray     # dims + 1 x bits


def fit(vectors: np.ndarray, languages: list[str], ridge: float = RIDGE) -> Model:
    names = sorted(set(languages))
    codes = codewords(len(names)) if names else np.zeros((0, 0), np.float32)
    which = np.searchsorted(names, languages) if names else np.zeros(0, int)
    weight = (1 / np.bincount(which, minlength=len(names)))[which] if names else np.zeros(0)
    n = vectors.shape[1] + 1
    a, b = np.zeros((n, n)), np.zeros((n, codes.shape[1]))
    for lo in range(0, len(vectors), FIT_ROWS):  # tiles: the driver holds the normal equations, no copy of all vectors
        own = slice(lo, lo + FIT_ROWS)
        x = np.concatenate([vectors[own], np.ones((len(vectors[own]), 1))], axis=1, dtype=np.float64)
        weighted = x * weight[own, None]
        b += weighted.T @ codes[which[own]]
        for at in range(0, n, FIT_ROWS):
            a[at: at + FIT_ROWS] += weighted[:, at: at + FIT_ROWS].T @ x
    a.flat[:: n + 1] += ridge
    return Model(names, codes, np.linalg.solve(a, b).astype(np.float32) if names and codes.shape[1] else np.zeros((n, 0), np.float32))


def decode(model: Model, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(language index, score, ambiguous)`` of every row."""
    margins = vectors @ model.weights[:-1] + model.weights[-1]
    loss = np.maximum(0, 1 - margins[:, None, :] * model.codes[None]).sum(axis=2) / max(model.codes.shape[1], 1)
    best = loss.argmin(axis=1)
    share = np.exp(-SHARPNESS * (loss - loss.min(axis=1, keepdims=True)))
    near = np.sort(loss, axis=1)
    gap = near[:, 1] - near[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
    return best, 1 / share.sum(axis=1), gap < AMBIGUITY


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``docs(doc_id, text, lang)``; rows without text or language are left out, equal rows count once.

    The ``per_language`` rows of a language with the smallest hashes of id and text are taken, by rank: neither
    repeated ids nor repeated rows make the sample larger, or smaller than the language's distinct rows allow.
    """
    known = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang").withColumn("h", F.xxhash64("doc_id", "text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, DIMS), np.float32), [])
    # (twice as many as wanted pass a first filter without a shuffle; the rank decides)
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2.0 * per_language / max(n, 1)))])
    uniform = F.pmod(F.xxhash64("h"), F.lit(1 << 30)) / (1 << 30)
    once = known.where(uniform < share[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("h"), "h"))
    picked = once.withColumn("rank", rank).where(F.col("rank") <= per_language)
    rows = with_computed(picked, "text", "vector binary", lambda t: [[v.tobytes() for v in trigram_vectors(t).astype(np.float16)]])
    chosen = sorted((r["lang"], r["rank"], r["vector"]) for r in rows.select("lang", "rank", "vector").toArrow().to_pylist())
    vectors = np.frombuffer(b"".join(v for _, _, v in chosen), np.float16).reshape(-1, DIMS)
    return fit(vectors, [lang for lang, _, _ in chosen])


def predicted(docs: DataFrame, model: Model, prefix: str = "") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous`` (names begin with ``prefix``)."""
    def compute(texts: pa.Array) -> list:
        lettered = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], bool)
        if not model.languages:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)]
        lang, score, ambiguous = [], [], []
        at = 0
        for lo, hi, _, _ in W.slices(texts):
            best, s, a = decode(model, trigram_vectors(texts.slice(lo, hi - lo)))
            lang += [model.languages[i] for i in best]
            score.append(s), ambiguous.append(a)
            at = hi
        score, ambiguous = (np.concatenate(x) if x else np.zeros(0) for x in (score, ambiguous))
        return [[x if ok else UNKNOWN for x, ok in zip(lang, lettered)], np.where(lettered, score, 0.0).astype(float)[:at], (ambiguous.astype(bool) & lettered)]
    return with_computed(docs, "text", f"{prefix}lang_pred string, {prefix}score double, {prefix}ambiguous boolean", compute)


def held_out(doc_id) -> F.Column:
    return F.pmod(crc32_of_id(doc_id), F.lit(4)) == 2
