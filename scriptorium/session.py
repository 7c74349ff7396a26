"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder that operators use to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins from runtime sizes,
# splits skewed shuffle partitions and coalesces tiny ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "scriptorium") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "16g")
        .config("spark.scriptorium.textPartitions", str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder.

    On a cluster this must be a shared folder named by ``spark.checkpoint.dir``
    (or set with ``setCheckpointDir``). Only a local-mode session without one
    gets a fresh folder under the system temp dir, as in tests.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    if sc is None:
        if conf_dir:
            return conf_dir
        raise RuntimeError("spark.checkpoint.dir is not set; a Spark Connect session needs a shared folder")
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so lineage cuts survive executor loss")
    local_dir = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh table path inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables that ``materialize`` writes inside the block, at its end."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def sparing_disk(spark: SparkSession):
    """Inside the block, the shuffle files of an action are deleted when it ends, and stored tables are packed tighter.
    Otherwise shuffle files stay until the driver collects its garbage, so a job of many stored steps holds those of
    all its steps at once."""
    before = {key: spark.conf.get(key, None) for key in SPARING}
    for key, value in SPARING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def discard(df) -> None:
    """Delete the table that ``materialize`` wrote for ``df``; nothing may read it any more."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/") + "/tables/"
    for path in {f[:f.rindex("/")] for f in df.inputFiles()}:
        if base.split(":", 1)[-1] in path:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(df, name: str = "stage"):
    """Cut lineage by writing a Parquet table into the shared checkpoint folder
    and reading it back. Columnar and compressed, so cheaper to write and to
    re-read than an RDD checkpoint; it survives executor loss the same way."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_parts(parts, name: str = "stage"):
    """``materialize`` for a table whose rows are made in parts, one after the other: ``parts`` gives their frames, of one schema."""
    path = None
    for df in parts:
        if path is None:
            path = scratch_path(df.sparkSession, name)
            if _scopes:
                _scopes[-1].append(path)
        df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
