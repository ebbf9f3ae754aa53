"""Array-column vector functions (JVM-side higher-order functions, so they
stay inside whole-stage codegen; no Python in the row path)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sq_norm(v) -> Column:
    """Sum of squares, accumulated in double."""
    return F.aggregate(_c(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def norm(v) -> Column:
    return F.sqrt(sq_norm(v))


def _normalize_bound(a: Column) -> Column:
    """Normalise a vector bound to a lambda variable: the squared norm is
    the accumulator of one pass and the division runs in its finish step,
    so nothing is recomputed per element."""
    return F.aggregate(a, F.lit(0.0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"),
                       lambda s: F.transform(a, lambda x: x.cast("double") / F.when(s == 0, F.lit(1.0)).otherwise(F.sqrt(s))))


def l2_normalize(v) -> Column:
    """Divide by the L2 norm; a zero vector is divided by 1 (stays zero).

    ``v`` may be an expensive expression: it is evaluated once (bound to a
    lambda variable through a one-element array), never once per element.
    """
    return F.element_at(F.transform(F.array(_c(v)), _normalize_bound), 1)


def dot(a, b) -> Column:
    """Inner product in double (= cosine for unit vectors)."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def clip01(x) -> Column:
    return F.least(F.greatest(_c(x), F.lit(0.0)), F.lit(1.0))


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0).cast("float"), dim)


def with_zero_fill(catalog: DataFrame, vecs: DataFrame, dim: int, id_col: str = "id",
                   vec_col: str = "embedding") -> DataFrame:
    """Every catalog row with its vector, a zero vector when it has none (V6)."""
    j = catalog.join(vecs.select(id_col, F.col(vec_col).alias("_v")), id_col, "left")
    return j.withColumn(vec_col, F.coalesce(F.col("_v"), zeros(dim))).drop("_v")


def validate_vectors(vecs: DataFrame, catalog: DataFrame | None = None, id_col: str = "id",
                     vec_col: str = "embedding") -> DataFrame:
    """One-row check (V7): row count, distinct dimensions, null vectors,
    duplicate ids and (with a catalog) ids that have no catalog row."""
    aggs = [
        F.count(F.lit(1)).alias("n_vectors"),
        F.count_distinct(F.size(vec_col)).alias("n_dims"),
        F.min(F.size(vec_col)).cast("bigint").alias("dim"),
        F.count_if(F.col(vec_col).isNull()).alias("n_null"),
        (F.count(F.lit(1)) - F.count_distinct(id_col)).alias("n_dup_ids"),
    ]
    if catalog is not None:
        known = catalog.select(id_col).distinct().withColumn("_known", F.lit(True))
        vecs = vecs.join(known, id_col, "left")
        aggs.append(F.count_if(F.col("_known").isNull()).alias("n_orphans"))
    return vecs.agg(*aggs)


def assert_valid(stats: DataFrame) -> DataFrame:
    """Fail the job (not the driver) when the validation row is bad."""
    cond = (F.col("n_dims") <= 1) & (F.col("n_null") == 0) & (F.col("n_dup_ids") == 0)
    if "n_orphans" in stats.columns:
        cond = cond & (F.col("n_orphans") == 0)
    return stats.withColumn("ok", F.assert_true(cond, F.lit("vector table failed validation")).isNull())


def vector_tall(df: DataFrame, id_col: str, vec_col: str, keep_zeros: bool = False) -> DataFrame:
    """Tall form ``(id, dim, value)`` of a vector column."""
    t = df.select(id_col, F.posexplode(vec_col).alias("dim", "value"))
    t = t.select(id_col, F.col("dim").cast("bigint").alias("dim"), F.col("value").cast("double").alias("value"))
    return t if keep_zeros else t.where(F.col("value") != 0)
