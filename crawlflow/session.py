"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of a batch that goes to a Python worker, unless the session names its own bound. Spark's default
#: of 64 MB takes a multiple of that on both sides, in each of an executor's tasks.
BATCH_BYTES = 4 << 20
#: Whether the shuffle files of a query are removed when it has ended.
_CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_SETTING, _SPARK_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def get_session(app: str = "crawlflow", master: str | None = None, **conf: object) -> SparkSession:
    """A session with UTC time and adaptive execution; cluster settings are left alone."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    Read from ``spark.checkpoint.dir``, then from the context. Only a local session without
    either gets a temporary folder: on a cluster that would not be shared.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="crawlflow-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Survives the loss of executors, and every later branch sees the very same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_compact(df: DataFrame, name: str, spent: DataFrame | None = None) -> DataFrame:
    """``materialize`` for tables far larger than their input: packed tighter, and what was needed to make them leaves the disk.

    That is the shuffle files of the write, and ``spent``, a table of ``materialize`` that nothing reads any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP_SETTING, None)
    spark.conf.set(_CLEANUP_SETTING, "true")
    try:
        df.write.option("compression", "zstd").option("parquet.writer.version", "v2").parquet(path)
    finally:
        spark.conf.set(_CLEANUP_SETTING, before) if before else spark.conf.unset(_CLEANUP_SETTING)
    if spent is not None:
        for folder in {file.rsplit("/", 1)[0] for file in spent.inputFiles()}:
            folder = spark._jvm.org.apache.hadoop.fs.Path(folder)
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a table of few files to all cores before work that is heavy per row.

    For scans only. A table with a split for every core, as any large one, is left as it is.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, *keys) if df.rdd.getNumPartitions() < wanted else df


def once(array: str | Column) -> Column:
    """An array without its nulls, to be exploded without being computed twice.

    For a bare column Spark adds a filter on its size before the explode and pushes it down to
    where the column is computed, which then happens for the filter and again for the rows.
    """
    return F.array_compact(array)


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH_SETTING, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
