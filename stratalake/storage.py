"""Tables written for a while in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows, of triples or the like, that a task should sort or hash at most.
TASK_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a session in one process gets a temporary folder of its own; any other raises, since executors
    would write to folders that nobody else sees.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="stratalake-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, name: str, compression: str | None = None, task_rows: int | None = None) -> DataFrame:
    """df written as Parquet in the shared folder and read back: cuts the lineage and survives lost executors.

    With `task_rows` no file has more rows, and each is read by a task of its own. Without, a task reads as many bytes as the session
    says, which for rows that compress well, such as triples, are some twenty million rows.
    """
    spark, path = df.sparkSession, new_dir(df.sparkSession, name)
    df.write.options(**{"maxRecordsPerFile": task_rows} if task_rows else {}).parquet(path, compression=compression)
    return (file_by_file(spark) if task_rows else spark).read.schema(df.schema).parquet(path)


def file_by_file(spark: SparkSession) -> SparkSession:
    """A session with the same settings, except that the files it reads are not packed together into tasks."""
    other = spark.newSession()
    other.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    for k, v in spark.conf.getAll.items():
        if other.conf.isModifiable(k):
            other.conf.set(k, v)
    other.conf.set("spark.sql.files.openCostInBytes", other._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return other


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of new_dir() that nothing will read again."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
