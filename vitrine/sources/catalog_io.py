"""Sources and sinks (S1-S12): tolerant catalog CSV reader, image file
inventory, vector / search-table store (Parquet), CSV exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import config
from ..operators.clean import inventory_from_files, null_tokens_to_null
from ..session import stored
from .split_csv import read_records

EXTRA = "_extra_field"


class CatalogNotFound(FileNotFoundError):
    pass


def _header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.option("lineSep", "\n").text(path).limit(1).collect()  # one line, on purpose
    if not first:
        return []
    import csv
    return [c.strip() for c in next(csv.reader([first[0][0]]))]


def read_catalog_csv(spark: SparkSession, path: str, null_tokens=config.NULL_TOKENS, splittable: bool = True) -> DataFrame:
    """Catalog CSV (S1-S3): UTF-8, header, quoted fields with embedded
    newlines; rows with too many fields are skipped, short rows are kept
    null-padded; null tokens become NULL; ``src_pos`` keeps file order.

    Files are read in splits (:mod:`.split_csv`); ``splittable=False`` uses
    Spark's multi-line reader, one task a file, with the same rows and order.
    Blank lines are no records; line ends are ``\\n`` or ``\\r\\n``.

    Too-long rows are detected with a sentinel column appended to the
    schema (set only when a row has an extra field); ``DROPMALFORMED``
    would also drop the short rows.
    """
    try:
        cols = _header(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise CatalogNotFound(f"catalog CSV not found at {path!r}: download the catalog and place it there") from e
    schema = StructType([StructField(c, StringType()) for c in cols] + [StructField(EXTRA, StringType())])
    if splittable:
        found = read_records(spark, path).where("record > 0")  # record 0 is the header
        parsed = F.from_csv("text", F.lit(", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema)), {"mode": "PERMISSIVE", "escape": '"'})
        df = found.select(parsed.alias("r"), (F.col("record") - 1).alias("_row"), F.col("file").alias("_file")).select("r.*", "_row", "_file")
    else:
        df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
              .option("multiLine", True).option("escape", '"').option("nullValue", None).csv(path))
        # A multi-line file is one split, so the low bits of the increasing id count up inside it.
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        df = df.withColumn("_row", row).withColumn("_file", F.input_file_name())
    # Order over several files: by file name, then by row; the file list (one row a file) gives the files' order.
    files = sorted(spark.read.text(path).inputFiles())
    rank = spark.createDataFrame(list(enumerate(files)), "_rank BIGINT, _file STRING")
    df = df.where(F.col(EXTRA).isNull()).drop(EXTRA).join(rank, "_file")
    df = df.withColumn("src_pos", F.shiftleft("_rank", 33) + F.col("_row")).drop("_file", "_row", "_rank")
    return null_tokens_to_null(df, null_tokens) if null_tokens else df


def image_inventory(spark: SparkSession, image_dir: str) -> DataFrame:
    """File listing of an image folder (S4) as ``(id, ext, image_bytes)``;
    with the real path; the ``content`` column is never selected, so no image is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(image_dir).select("path", "length")
    return inventory_from_files(files, keep=("path",))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with a header, one part file per partition."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def export_unique_catalog(unique: DataFrame, path: str) -> None:
    write_csv(unique.select(*[c for c in config.EXPORT_COLUMNS if c in unique.columns]), path)


def export_duplicate_report(report: DataFrame, path: str) -> None:
    """Per-member duplicate report (S12); an empty report still gets its header."""
    write_csv(report, path)


def content_hash(text_col: str = "productDisplayName"):
    """Hash of what a vector was made from; a changed product gets another one."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def save_vectors(vecs: DataFrame, path: str, model: str = "hashed-bow", mode: str = "overwrite") -> None:
    """One self-describing table ``(id, embedding, model[, content_hash])``."""
    extra = ["content_hash"] if "content_hash" in vecs.columns else []
    vecs.select("id", "embedding", F.lit(model).alias("model"), *extra).write.mode(mode).parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    """S8; raises when absent (Spark's path-not-found error)."""
    return spark.read.parquet(path)


def save_search_table(catalog: DataFrame, vecs: DataFrame, path: str, buckets: int | None = None) -> None:
    """Catalog joined to its vectors, stored as Parquet."""
    t = catalog.drop("embedding").join(vecs.select("id", "embedding"), "id")
    if buckets:
        t = t.repartition(buckets, "id")
    t.write.mode("overwrite").parquet(path)


def vectors_to_refresh(catalog: DataFrame, cache: DataFrame, text_col: str = "productDisplayName") -> DataFrame:
    """Rows whose vector is missing from the cache or, where the cache keeps
    content hashes, was made from another text (S10): an anti-join, so a
    refresh embeds only new or changed products."""
    if "content_hash" not in cache.columns:
        return catalog.join(cache.select("id"), "id", "left_anti")
    return (catalog.withColumn("content_hash", content_hash(text_col))
            .join(cache.select("id", "content_hash"), ["id", "content_hash"], "left_anti").drop("content_hash"))


#: Up to so many paths of distinct images are broadcast to the scan that reads them; more are joined by a shuffle.
BROADCAST_PATHS = 200_000


def embed_images(spark: SparkSession, image_dir: str, make_predict_fn, dim: int, batch_size: int = 32,
                 decode=None, on_error: str = "null") -> DataFrame:
    """Batch image embedding (E1): file content -> model -> unit vector, with
    the path of the file it came from.  Only files named ``<id><ext>`` with a
    known extension count, the best extension per id; unreadable content
    (NULL) becomes a zero vector.

    Content-addressed: a first scan hashes the contents, and each distinct
    image is embedded once, however many products show it; the vectors come
    back by hash.  Contents stay in the tasks that read them.  A path of one
    file embeds that file (E2)."""
    from ..functions.encoder import model_encoder
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(image_dir)
    udf = model_encoder(make_predict_fn, dim, batch_size, "binary", decode=decode, on_error=on_error)
    pri = F.array_position(F.array(*[F.lit(e) for e in config.IMAGE_EXTENSIONS]), F.col("ext"))
    known = inventory_from_files(files, keep=("path", "content")).withColumn("_pri", pri).where("_pri > 0")
    hashed = known.select("id", "_pri", "path", F.sha2("content", 256).alias("hash"))
    best = stored(hashed.groupBy("id").agg(F.min_by(F.struct("hash", "path"), "_pri").alias("b")).select("id", "b.hash", "b.path"), "image-hashes")
    first = best.groupBy("hash").agg(F.min("path").alias("path"))
    wanted = first.select("path")
    if best.count() <= BROADCAST_PATHS:  # (there are no more distinct images than products)
        wanted = F.broadcast(wanted)
    vectors = stored(known.join(wanted, "path", "left_semi").select("path", udf(F.col("content")).alias("embedding")), "image-vectors")
    return (best.withColumnRenamed("path", "image_path").join(first.join(vectors, "path").select("hash", "embedding"), "hash")
            .select("id", "embedding", "image_path"))


def assert_images(products: DataFrame, images: DataFrame) -> DataFrame:
    """One row with the number of products that have an image; the job fails
    when a product has none (S6, strict form)."""
    j = products.select("id").distinct().join(images.select("id", F.lit(True).alias("img")), "id", "left")
    c = j.agg(F.count("img").alias("with_image"), F.count_if(F.col("img").isNull()).alias("missing"), F.min(F.when(F.col("img").isNull(), F.col("id"))).alias("first"))
    return c.select(F.when(F.col("missing") > 0, F.raise_error(F.concat(
        F.col("missing").cast("string"), F.lit(" products without an image, the first is "), F.col("first").cast("string"))).cast("bigint"))
        .otherwise(F.col("with_image")).alias("with_image"))
