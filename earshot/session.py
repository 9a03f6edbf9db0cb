"""Session settings and the shared workspace in which lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: What the library expects of a session. Sizes follow the cluster and are left to its operator.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "earshot", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for the dots of a Spark setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`, or in local mode, where it is unset, one of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = getattr(spark, "_earshot_workspace", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="earshot-")
        atexit.register(shutil.rmtree, folder, True)
        spark._earshot_workspace = folder
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _own(spark: SparkSession) -> str:
    return f"{workspace(spark)}/earshot-{spark.sparkContext.applicationId}"


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write `df` as Parquet into the workspace and read it back: lineage ends here, and a lost executor costs nothing before it."""
    path = f"{_own(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> bool:
    """Delete what this application has cut. Frames made before can't be read afterwards. True if there was anything."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
