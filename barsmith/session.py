"""Session settings and the shared scratch folder."""

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Streaming state lives in RocksDB, as it outgrows memory. AQE splits hot keys, coalesces small partitions and turns small sides into broadcasts at
# run time; a skewed join is worth an extra shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time options this package relies on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per context, so that executors need no installation of it."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    if not getattr(context, "_barsmith_shipped", False) and root.is_dir():
        folder = tempfile.mkdtemp(prefix="barsmith-ship-")  # the driver's own; Spark copies the archive from there
        shutil.copytree(root, f"{folder}/tree/barsmith", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/barsmith", "zip", f"{folder}/tree"))
        context._barsmith_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which every executor can reach.

    Only a local session may go without: there a temporary folder is set in its place.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="barsmith-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to this path has been completed."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(mark)


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/barsmith/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts the lineage: later reads survive lost executors and no longer depend on tables that
    the job goes on to change.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_freed(df: DataFrame, label: str) -> DataFrame:
    """As `stage`; the shuffle files that the write needed go as soon as it is done, not when the driver happens to collect its garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return stage(df, label)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
