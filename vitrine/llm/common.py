"""Reading, shared intermediate tables and Arrow passes for the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove_path


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One supplied table, its scan pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``: a lost executor re-reads the table, it recomputes nothing.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Remove a table of ``shared`` that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, folder)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binary_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary rows cut from one array at item positions ``bounds`` (no copy of each row)."""
    off = (np.asarray(bounds, np.int64) * values.itemsize)
    return pa.Array.from_buffers(pa.large_binary(), len(off) - 1,
                                 [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def unpack(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """``(values, bounds)`` of binary rows that hold items of one NumPy type."""
    rows = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(rows), kind), np.concatenate([[0], np.cumsum([len(r) // size for r in rows])]).astype(np.int64)


def with_computed(df: DataFrame, text_column: str, fields: str, compute: Callable[[pa.Array], list]) -> DataFrame:
    """Append columns computed from one text column, batch by batch, without a shuffle.

    ``fields`` is a DDL list; ``compute`` maps a string array to one list or array per field.  A column of
    ``df`` that has the name of a computed one is replaced.
    """
    added = df.sparkSession.createDataFrame([], fields).schema
    names = {f.name.lower() for f in added}
    keep = [c for c in df.columns if c.lower() not in names]
    base = df.select(*[df[c] for c in keep], df[text_column].cast("string").alias("__text"))
    schema = base.select(*[base[c] for c in keep]).schema
    for f in added:
        schema = schema.add(f)
    arrow = [pa_type(f.dataType.simpleString()) for f in added]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            computed = compute(b.column(len(keep)))
            arrays = [c if isinstance(c, pa.Array) and c.type == t else pa.array(c, t) for c, t in zip(computed, arrow)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + arrays,
                                             names=keep + [f.name for f in added])
    return base.mapInArrow(run, schema)


def pa_type(name: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary()}[name]


def crc32_of_id(doc_id) -> F.Column:
    """crc32 of the id written as decimal text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def total_bytes(docs: DataFrame, text_column: str = "text") -> int:
    """UTF-8 bytes of all texts (one cheap pass; sizes bucket counts, never results)."""
    return int(docs.select(F.sum(F.octet_length(text_column)).alias("b")).first()["b"] or 0)
