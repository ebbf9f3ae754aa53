"""Embedding projection data (O3-O5): sample, PCA, label colours.

t-SNE (a single-machine solver) is not built; the projection is the first
two principal components of mean-centred vectors, computed by Spark ML
(the covariance is aggregated across partitions; only the D x D matrix
reaches the driver).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from .clean import sample_key


def label_colours(df: DataFrame, label_col: str) -> DataFrame:
    """Sorted distinct labels -> palette index ``i mod 10`` and colour (O3).
    The window runs over the distinct labels only (a category vocabulary)."""
    labels = df.select(F.col(label_col).alias("label")).where(F.col("label").isNotNull()).distinct()
    idx = ((F.dense_rank().over(Window.orderBy("label")) - 1) % len(config.COLOR_PALETTE)).cast("bigint")
    pal = F.array(*[F.lit(c) for c in config.COLOR_PALETTE])
    return labels.select("label", idx.alias("palette_index")).withColumn(
        "colour", F.element_at(pal, (F.col("palette_index") + 1).cast("int")))


def subsample(df: DataFrame, n: int | None = None, seed: int = config.SAMPLE_SEED) -> DataFrame:
    """Seeded sample of at most n rows for display (O4; ``None``: all rows)."""
    return df if n is None else df.orderBy(sample_key(seed), F.col("id")).limit(n)


def principal_components(vectors: DataFrame, k: int = config.PCA_COMPONENTS, vec_col: str = "embedding"):
    """PCA of mean-centred vectors, fitted on all rows (O5): ``(model, centred rows)``."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector

    v = vectors.withColumn("v", array_to_vector(F.col(vec_col).cast("array<double>")))
    centred = StandardScaler(inputCol="v", outputCol="c", withMean=True, withStd=False).fit(v).transform(v)
    return PCA(k=k, inputCol="c", outputCol="p").fit(centred), centred


def explained_variance(vectors: DataFrame, k: int = config.PCA_COMPONENTS, vec_col: str = "embedding") -> DataFrame:
    """Share of the variance of the first ``k`` components: ``(component, share)``, k rows."""
    model, _ = principal_components(vectors.where(F.col(vec_col).isNotNull()).select(vec_col), k, vec_col)
    rows = [(i, float(x)) for i, x in enumerate(model.explainedVariance.toArray())]
    return vectors.sparkSession.createDataFrame(rows, "component BIGINT, share DOUBLE")


def pca_checks(vectors: DataFrame, k: int = config.PCA_COMPONENTS, vec_col: str = "embedding", tolerance: float = 1e-8) -> DataFrame:
    """One row of checks of the fitted components, from the rows themselves: ``dims``, ``total_variance`` (trace of the
    covariance), and whether every component v has unit length and is orthogonal to the others, whether
    ``|C v - lambda v|`` is below ``tolerance`` of the total (C v by covariances of every dimension with the projected
    rows), and whether the stated shares are lambda / total."""
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    model, centred = principal_components(vectors.where(F.col(vec_col).isNotNull()).select(vec_col), k, vec_col)
    v, share = model.pc.toArray(), model.explainedVariance.toArray()
    rows = model.transform(centred).select(vector_to_array("c").alias("c"), vector_to_array("p").alias("p"))
    tall = rows.select("p", F.posexplode("c").alias("dim", "x"))
    found = tall.groupBy("dim").agg(F.var_samp("x").alias("var"), *[F.covar_samp("x", F.col("p")[i]).alias(f"c{i}") for i in range(v.shape[1])]).orderBy("dim").collect()  # D rows
    total = sum(r["var"] for r in found)
    cv = np.array([[r[f"c{i}"] for i in range(v.shape[1])] for r in found])
    value = (v * cv).sum(axis=0)
    checks = (len(found), float(total), bool(np.abs(v.T @ v - np.eye(v.shape[1])).max() < tolerance),
              bool(np.abs(cv - v * value).max() < tolerance * total), bool(np.abs(share - value / total).max() < tolerance))
    return vectors.sparkSession.createDataFrame([checks], "dims BIGINT, total_variance DOUBLE, orthonormal BOOLEAN, residual_small BOOLEAN, shares_hold BOOLEAN")


def project_embeddings(catalog: DataFrame, n: int | None = None, label_col: str = "articleType",
                       vec_col: str = "embedding") -> DataFrame:
    """C4: centre -> PCA over all vectors -> (id, x, y, label, colour), of all rows or a display sample of ``n``."""
    from pyspark.ml.functions import vector_to_array

    known = catalog.where(F.col(vec_col).isNotNull()).select("id", F.col(label_col).alias("label"), vec_col)
    model, centred = principal_components(known, 2, vec_col)
    arr = vector_to_array(F.col("p"))
    out = subsample(model.transform(centred).select("id", "label", arr[0].alias("x"), arr[1].alias("y")), n)
    return out.join(label_colours(out, "label").select("label", "colour"), "label", "left")
