"""Session helpers: building a local session for tests/bench and resolving
the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cpus: int | str = "*", app: str = "vitrine", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local session with the settings the library is tuned for.

    On a cluster, create the session the usual way; only the Arrow batch
    byte cap (block kernels move one block pair per row) and AQE matter.
    """
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 * 1024 * 1024))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets it to shared storage (without it this raises); only a
    local master falls back to a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):  # local[..] only; local-cluster and clusters need a shared folder
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="vitrine-ckpt-", dir=os.environ.get("VITRINE_LOCAL_TMP", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def stored(df, name: str):
    """Write ``df`` once under the shared checkpoint folder and read it back: lineage ends here, like ``checkpoint()``."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table that a job wrote under the checkpoint folder and no longer needs."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(int(spark.sparkContext.defaultParallelism), 1)
    except Exception:  # pragma: no cover - connect sessions
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


def spread(df, key: str):
    """Hash-repartition by ``key`` only when the input has fewer partitions
    than the session's parallelism (e.g. one large file read by one task),
    so CPU-heavy per-row work is spread; a no-op for well-split inputs."""
    want = default_parallelism(df.sparkSession)
    try:
        have = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover - connect sessions
        return df
    return df.repartition(want, key) if have < want else df
