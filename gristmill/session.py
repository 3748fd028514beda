"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the engine's defaults; keyword settings win over them."""
    builder = SparkSession.builder.master(master).appName("gristmill")
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "12g"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it is unset, a temporary folder if all runs on this machine, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that every executor reaches")
    if not hasattr(spark.sparkContext, "_gristmill_folder"):
        spark.sparkContext._gristmill_folder = tempfile.mkdtemp(prefix="gristmill-")
    return spark.sparkContext._gristmill_folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back from there.

    A lost executor costs nothing: the files outlive it. Columnar files are smaller than a checkpoint's rows, and later
    reads take only the columns they need. The session's tables are removed when the driver ends, or by ``remove_tables``.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/gristmill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    if not _registered:
        _registered.append(atexit.register(_remove_written))
    return spark.read.schema(df.schema).parquet(path)


_written: list[str] = []
_registered: list = []


def remove_tables(spark: SparkSession) -> None:
    """Remove the tables written so far: for a long session, once what reads them is done."""
    while _written:
        where = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _remove_written() -> None:
    spark = SparkSession.getActiveSession()
    left = list(_written)
    try:
        remove_tables(spark)
    except Exception:  # the JVM may be gone already
        for path in left:
            shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
