"""Shared folder for written tables, and session settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}


def session(master: str = "local[*]", name: str = "wearline", **settings: str) -> SparkSession:
    """A session for tests and local runs; clusters bring their own."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its
    own: on a cluster a machine-local folder is not visible to executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="wearline-")
    return _local_folders[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder path that no earlier run has used."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a derived lookup table and read it back.

    That cuts the lineage on storage that outlives executors, and gives the
    planner the table's real size: Spark broadcasts it below the session's
    broadcast limit and sort-merges it beyond. Shuffle files of the write go when
    it ends, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_SETTING, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            if f"/{spark.sparkContext.applicationId}/" not in folder:
                raise ValueError(f"not a settled table: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
