"""Scans and sinks: parquet tables, delimited text, nested JSON lines, overlays and the delivery tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Control characters that no spreadsheet accepts (fixed values).
ILLEGAL_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether any file matches ``path`` on whichever file system it names."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(system.globStatus(where))


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str = ";") -> DataFrame:
    """Delimited text with a header, every column a string; a missing path is an empty relation.

    Columns absent from the file come back NULL, columns not asked for are dropped. A byte-order mark before the
    first header is removed.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("\ufeff") for c in raw.columns])
    return raw.select(*[F.col(f"`{c}`") if c in raw.columns else F.lit(None).cast("string").alias(c) for c in columns])


def read_json_units(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Nested JSON lines (plain or gzip) under a declared schema; malformed lines become rows of NULL."""
    return spark.read.schema(schema).json(path)


def overlay(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of frames where, for one key, the row of the last frame that has it wins."""
    union = None
    for priority, frame in enumerate(frames):
        frame = frame.withColumn("_priority", F.lit(priority))
        union = frame if union is None else union.unionByName(frame, allowMissingColumns=True)
    last = Window.partitionBy(*keys).orderBy(F.col("_priority").desc())
    return union.withColumn("_rank", F.row_number().over(last)).filter("_rank = 1").drop("_rank", "_priority")


def printable(value: Column) -> Column:
    """Text without the control characters that spreadsheets refuse."""
    return F.regexp_replace(value, ILLEGAL_CONTROL, "")


def write_delimited(df: DataFrame, path: str, sep: str = ";", partition_by: tuple[str, ...] = ()) -> None:
    """Delimited text, minimal quoting, one folder per partition value where asked."""
    clean = df.select(*[printable(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])
    writer = clean.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"')
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_delivery_tree(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Parquet tree where only the partitions present in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def newest_status(df: DataFrame, key: str, modified: str) -> DataFrame:
    """One row per key: that of the file modified last."""
    newest = Window.partitionBy(key).orderBy(F.col(modified).desc_nulls_last(), F.to_json(F.struct("*")))
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
