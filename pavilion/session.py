"""Session defaults and the shared folder that lineage cuts are written to."""

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus="*", memory="8g"):
    """A session for tests and benches; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pavilion")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor reaches: spark.checkpoint.dir, as the cluster set it, else one in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        spark.sparkContext.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch-{uuid.uuid4().hex[:12]}")
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and go on from the files.

    Cuts the lineage, fixes values that must not change between two uses
    (range bounds, partition numbers), and outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """materialize() of frames of one schema that are made one after the other, at least one; each is written before the next is made."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(*written: DataFrame) -> None:
    """Remove what materialize() wrote, once nothing reads it any more."""
    for df in written:
        spark = df.sparkSession
        home = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/"
        path = spark._jvm.org.apache.hadoop.fs.Path
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            # Never anything but a folder of this session's own.
            if path(folder).toUri().getPath().startswith(path(home).toUri().getPath()):
                path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(folder), True)
