"""Encoders: text / image -> unit vector.

The default is a deterministic hashed bag-of-words text encoder written as
JVM-side expressions: lower-case, split on single spaces, drop empty
tokens, bucket each token by ``md5`` hex prefix mod ``dim``, count per
bucket, L2-normalise.  It is lexical, not semantic; a learned model plugs
in through :func:`model_encoder` (``predict_batch_udf``: the model is
loaded once per Python worker and fed Arrow batches).
"""

from __future__ import annotations

from typing import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from .vectors import l2_normalize


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tokens(text) -> Column:
    return F.filter(F.split(F.lower(_c(text)), " "), lambda t: t != "")


def token_bucket(tok: Column, dim: int = config.HASH_DIM) -> Column:
    hexp = F.substring(F.md5(tok), 1, config.HASH_HEX_CHARS)
    return F.pmod(F.conv(hexp, 16, 10).cast("bigint"), F.lit(dim))


def bucket_counts(text, dim: int = config.HASH_DIM) -> Column:
    """Counts per bucket in one pass over the tokens (each token hashed once)."""
    buckets = F.transform(tokens(text), lambda t: token_bucket(t, dim))
    zero = F.array_repeat(F.lit(0.0).cast("double"), dim)
    return F.aggregate(buckets, zero,
                       lambda acc, b: F.transform(acc, lambda x, i: F.when(i == b, x + 1.0).otherwise(x)))


def hashed_text_vector(text, dim: int = config.HASH_DIM) -> Column:
    """Unit vector of a text (all-zero for a text without tokens)."""
    return l2_normalize(bucket_counts(text, dim))


def embed_text(spark, text: str, dim: int = config.HASH_DIM) -> list[float]:
    """One text -> unit vector (E3); a blank text is an error."""
    if text is None or not text.strip():
        raise ValueError("text to embed must not be empty")
    row = spark.range(1).select(hashed_text_vector(F.lit(text.strip()), dim).alias("v")).first()
    return list(row["v"])


def hashed_text_vectors(df: DataFrame, id_col: str, text_col: str, dim: int = config.HASH_DIM) -> DataFrame:
    """Same vectors as :func:`hashed_text_vector`, built in tall form for long
    texts: explode tokens -> bucket -> ``(id, bucket)`` counts (combined
    map-side, so at most ``dim`` rows per text leave a task) -> one array per
    id.  Every input row gets a vector (all-zero when it has no tokens).
    Hashing runs in generated code; no per-element lambda is interpreted."""
    from ..session import spread
    toks = spread(df.select(id_col, text_col), id_col).select(
        F.col(id_col).alias("_id"), F.explode(tokens(F.col(text_col))).alias("_t"))
    counts = (toks.groupBy("_id", token_bucket(F.col("_t"), dim).alias("_b"))
                  .agg(F.count(F.lit(1)).cast("double").alias("_n")))
    per_id = counts.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("_b", "_n"))).alias("_m"))
    dense = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(dim - 1).cast("bigint")),
                        lambda b: F.coalesce(F.element_at(F.col("_m"), b), F.lit(0.0)))
    vecs = per_id.select(F.col("_id").alias(id_col), l2_normalize(dense).alias("embedding"))
    zero = F.array_repeat(F.lit(0.0).cast("double"), dim)
    return (df.select(id_col).join(vecs, id_col, "left")
              .select(id_col, F.coalesce(F.col("embedding"), zero).alias("embedding")))


def model_encoder(make_predict_fn: Callable, dim: int, batch_size: int = 32,
                  input_type: str = "string", decode: Callable | None = None,
                  on_error: str = "null") -> Callable[[Column], Column]:
    """Wrap a user model factory as a batched Arrow UDF.

    ``make_predict_fn()`` returns ``predict(inputs: np.ndarray) -> np.ndarray``
    of shape ``(n, dim)``.  ``decode`` (optional) turns one raw input (e.g.
    image bytes) into a model input and may raise for unreadable content:
    with ``on_error="null"`` such items (and null inputs) become zero
    vectors, with ``on_error="raise"`` the task fails.  Every output row is
    L2-normalised (zero stays zero).
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    if on_error not in ("null", "raise"):
        raise ValueError("on_error must be 'null' or 'raise'")

    def factory():
        predict = make_predict_fn()

        def run(x: np.ndarray) -> np.ndarray:
            items = list(x)
            if decode is not None:
                dec = []
                for v in items:
                    if v is None:
                        dec.append(None)
                        continue
                    try:
                        dec.append(decode(v))
                    except Exception:
                        if on_error == "raise":
                            raise
                        dec.append(None)
                items = dec
            ok = np.array([v is not None for v in items], dtype=bool)
            out = np.zeros((len(items), dim), dtype=np.float32)
            if ok.any():
                good = np.empty(int(ok.sum()), dtype=object)
                good[:] = [v for v in items if v is not None]
                out[ok] = np.asarray(predict(good), dtype=np.float32)
            n = np.linalg.norm(out, axis=1, keepdims=True)
            n[n == 0] = 1.0
            return out / n
        return run

    return predict_batch_udf(factory, return_type=ArrayType(FloatType()), batch_size=batch_size)


def byte_histogram_model(dim: int = config.HASH_DIM) -> Callable:
    """Tiny deterministic stand-in model for binary content (tests/examples):
    histogram of byte values folded into ``dim`` buckets."""
    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            out = np.zeros((len(x), dim), dtype=np.float32)
            for i, b in enumerate(x):
                arr = np.frombuffer(bytes(b), dtype=np.uint8)
                out[i] = np.bincount(arr % dim, minlength=dim)[:dim]
            return out
        return predict
    return make
