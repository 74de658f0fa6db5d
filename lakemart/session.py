"""Session factory and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings every job wants. Partition counts stay a caller's choice: AQE merges
#: small shuffle partitions, splits skewed ones (even where that costs one more shuffle) and
#: turns a join into a broadcast one only when the measured side is below the threshold.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording a call site for every column expression slows down building wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name="lakemart", master=None, shuffle_partitions=None, **settings) -> SparkSession:
    """Create or get a session. Keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``. Only a local master may go without."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="lakemart-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


#: Work paths handed out, by application.
_handed_out: dict[str, list[str]] = {}


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Delete what this application stored on the way; returns the number of paths. To be called once the
    results that read from there have been written or collected."""
    paths = _handed_out.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times to the shared folder and read it back.

    Cuts the lineage, is computed once, survives lost executors, and keeps column pruning and
    file sizes for the planner.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As :func:`materialize`, in buckets of ``key``, so that joins and aggregates by the key read it without
    shuffling it. The name in the catalog goes at once; the frame keeps files and buckets."""
    spark, table = df.sparkSession, f"stored_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", work_path(spark, name)).saveAsTable(table)
    stored = spark.table(table)
    spark.sql("DROP TABLE IDENTIFIER(:name)", args={"name": table})
    return stored
