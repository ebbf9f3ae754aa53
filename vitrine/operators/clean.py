"""Catalog cleaning.

Order (as in the reference): strip column names -> null tokens -> drop
rows with a null required column -> numeric id (unparsable dropped,
fraction truncated) -> one row per id, first by position -> trim every
string -> fill display defaults.  Row position (``src_pos``) replaces the
implicit frame order for "keep first" and ties.

Deliberate deviation (documented): a null optional string stays NULL and
then receives its default, instead of becoming the text "nan"; pass
``nan_text=True`` for the reference's literal behaviour.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import config
from ..functions.text import strip, truncate

FILL_DEFAULTS = {"brand": "Unknown", "baseColour": "Unknown", "usage": "Unknown"}


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def missing_required(df: DataFrame, required=config.REQUIRED_COLUMNS) -> list[str]:
    """Required columns absent from the frame (P21; reported, not fatal)."""
    return [c for c in required if c not in df.columns]


def null_tokens_to_null(df: DataFrame, tokens=config.NULL_TOKENS) -> DataFrame:
    toks = list(tokens)
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            cols.append(F.when(F.col(f.name).isin(toks), F.lit(None).cast("string")).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def drop_null_required(df: DataFrame, required=config.REQUIRED_COLUMNS) -> DataFrame:
    present = [c for c in required if c in df.columns]
    return df.dropna(subset=present) if present else df


def numeric_id(c: Column) -> Column:
    """String/number -> BIGINT like ``to_numeric`` + ``astype(int)``: exact
    integers first, else via double with the fraction truncated; NULL when
    unparsable, NaN or out of range."""
    s = c.cast("string")
    as_long = s.try_cast("bigint")
    d = s.try_cast("double")
    ok = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(9.2e18))
    return F.coalesce(as_long, F.when(ok, d.cast("bigint")))


def coerce_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.withColumn(id_col, numeric_id(F.col(id_col))).where(F.col(id_col).isNotNull())


def first_per_id(df: DataFrame, id_col: str = "id", pos_col: str = "src_pos") -> DataFrame:
    """One row per id, the one with the smallest position.

    An aggregate (min_by over the whole row) rather than a window: it is
    combined map-side, so one id holding a third of all rows is no hot task.
    """
    others = [c for c in df.columns if c != id_col]
    agg = df.groupBy(id_col).agg(F.min_by(F.struct(*others), F.col(pos_col)).alias("_r"))
    return agg.select(id_col, *[F.col(f"_r.{c}").alias(c) for c in others])


def trim_strings(df: DataFrame) -> DataFrame:
    return df.select(*[strip(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
                       for f in df.schema.fields])


def fill_defaults(df: DataFrame, nan_text: bool = False) -> DataFrame:
    if "brand" not in df.columns:
        df = df.withColumn("brand", F.lit("Unknown"))
    if nan_text:
        df = df.select(*[F.coalesce(F.col(f.name), F.lit("nan")).alias(f.name) if isinstance(f.dataType, StringType)
                         else F.col(f.name) for f in df.schema.fields])
    return df.fillna({k: v for k, v in FILL_DEFAULTS.items() if k in df.columns})


def clean(raw: DataFrame, apply_null_tokens: bool = True, nan_text: bool = False) -> DataFrame:
    """Full cleaning pipeline (P1).  ``raw`` needs ``src_pos`` (row order)."""
    df = strip_column_names(raw)
    if apply_null_tokens:
        df = null_tokens_to_null(df)
    df = drop_null_required(df)
    df = coerce_id(df)
    df = first_per_id(df)
    df = trim_strings(df)
    df = fill_defaults(df, nan_text)
    if "year" in df.columns:
        df = df.withColumn("year", F.col("year").cast("string").try_cast("double").cast("int"))
    return df


def resolve_images(inventory: DataFrame, exts=config.IMAGE_EXTENSIONS, image_dir: str = "images") -> DataFrame:
    """``(id, ext, image_bytes[, path])`` listing -> one row per id with the first
    extension in priority order (case-sensitive): ``(id, image_path, image_bytes)``.
    ``image_path`` is the listed path, or made from folder, id and extension
    where the listing has none."""
    order = F.array(*[F.lit(e) for e in exts])
    pri = F.array_position(order, F.col("ext"))
    inv = inventory.where(pri > 0).withColumn("_pri", pri)
    made = F.concat(F.lit(image_dir + "/"), F.col("id").cast("string"), F.col("ext"))
    inv = inv.withColumn("_path", F.col("path") if "path" in inventory.columns else made)
    best = inv.groupBy("id").agg(F.min_by(F.struct("_path", "image_bytes"), F.col("_pri")).alias("_b"))
    return best.select("id", F.col("_b._path").alias("image_path"),
                       F.col("_b.image_bytes").cast("bigint").alias("image_bytes"))


def inventory_from_files(files: DataFrame, path_col: str = "path", size_col: str = "length", keep: tuple[str, ...] = ()) -> DataFrame:
    """File listing (e.g. ``binaryFile`` without ``content``) -> ``(id, ext, image_bytes)``.
    The stem must be exactly an integer id; the extension keeps its case."""
    name = F.regexp_extract(F.col(path_col), r"([^/]+)$", 1)
    stem = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)
    ext = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    idv = stem.try_cast("bigint")
    return (files.select(idv.alias("id"), stem.alias("_stem"), ext.alias("ext"), F.col(size_col).cast("bigint").alias("image_bytes"), *keep)
                 .where(F.col("id").isNotNull() & (F.col("id").cast("string") == F.col("_stem"))).drop("_stem"))


def keep_with_image(df: DataFrame, images: DataFrame) -> DataFrame:
    """Products whose image exists, with its path and size (P7): an equi-join."""
    base = df.drop(*[c for c in ("image_path", "image_bytes") if c in df.columns])
    return base.join(images, "id")


def sample_key(seed: int, id_col: str = "id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def cap_rows(df: DataFrame, n: int | None = None, seed: int = config.SAMPLE_SEED) -> DataFrame:
    """Deterministic uniform sample of exactly min(n, N) rows (P8; ``None``: all rows): hash order,
    executed as a bounded top-n (TakeOrderedAndProject), not a sort of all rows."""
    if n is None:
        return df
    return df.orderBy(sample_key(seed), F.col("id")).limit(n)


def display_sample(df: DataFrame, n: int = config.SAMPLE_DISPLAY, seed: int = config.DISPLAY_SEED) -> DataFrame:
    """n readable images with short labels."""
    ok = df.where(F.col("image_path").isNotNull() & (F.coalesce(F.col("image_bytes"), F.lit(0)) > 0))
    s = ok.orderBy(sample_key(seed), F.col("id")).limit(n)
    return s.select("id", "image_path", truncate(F.col("productDisplayName"), config.NAME_LABEL_CHARS).alias("label"))


def dq_counters(raw: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Rows in/out per cleaning stage (A8) in one aggregate over the raw frame."""
    df = null_tokens_to_null(strip_column_names(raw))
    present = [c for c in config.REQUIRED_COLUMNS if c in df.columns]
    nn = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in present]) if present else F.lit(True)
    idv = numeric_id(F.col("id"))
    valid = nn & idv.isNotNull()
    ann = df.select(nn.alias("nn"), valid.alias("valid"), F.when(valid, idv).alias("vid"))
    # One shuffle on the id (partial aggregation, so all invalid rows are one
    # row a task), the image join on the aggregated rows, then plain sums: no
    # distinct aggregates, so no Expand that multiplies the rows.
    per_id = ann.groupBy("vid").agg(F.count(F.lit(1)).alias("rows"), F.count_if("nn").alias("nn"), F.count_if("valid").alias("ok"))
    if images is not None:
        per_id = per_id.join(images.select(F.col("id").alias("vid"), F.lit(True).alias("img")), "vid", "left")
        per_id = per_id.withColumn("img", F.coalesce("img", F.lit(False)))
    else:
        per_id = per_id.withColumn("img", F.lit(True))
    a = per_id.agg(F.sum("rows").alias("raw"), F.sum("nn").alias("non_null"), F.sum("ok").alias("id_ok"),
                   F.count_if(F.col("vid").isNotNull()).alias("unique_ids"),
                   F.count_if(F.col("vid").isNotNull() & F.col("img")).alias("with_image"))
    return a.select(F.expr(
        "stack(4, 'drop_null_required', raw, non_null, 'coerce_id', non_null, id_ok, "
        "'first_per_id', id_ok, unique_ids, 'keep_with_image', unique_ids, with_image) AS (stage, rows_in, rows_out)")
    ).select("stage", F.col("rows_in").cast("bigint").alias("rows_in"), F.col("rows_out").cast("bigint").alias("rows_out"),
             (F.col("rows_in") - F.col("rows_out")).cast("bigint").alias("dropped"))


def load_catalog(raw: DataFrame, inventory: DataFrame, cap: int | None = None,
                 image_dir: str = "images") -> DataFrame:
    """Clean -> keep products with an image -> optional cap."""
    return cap_rows(keep_with_image(clean(raw), resolve_images(inventory, image_dir=image_dir)), cap)
