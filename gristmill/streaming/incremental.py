"""Incremental ingest: files that arrive are read once, de-duplicated and upserted batch by batch.

An addition of this engine: what the sources do with a file of finished keys is a checkpoint here, and each micro-batch
is folded into a snapshot that never overwrites a value. The snapshot lies in buckets by a hash of the key; a batch
writes only the buckets it touches, under its own number, and the newest finished number of a bucket counts.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gristmill.operators.lifecycle import upsert_keep
from gristmill.operators.relational import first_per_group
from gristmill.sources.tables import path_exists

BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _names(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers behind ``prefix`` in the names of a folder's entries."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(where):
        return []
    names = [s.getPath().getName() for s in system.listStatus(where)]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).isdigit())


def newest(spark: SparkSession, snapshot: str, before: int | None = None) -> dict[int, int]:
    """Newest finished batch of each bucket, of those numbered below ``before``: at most as many entries as buckets."""
    found: dict[int, int] = {}
    for batch in _names(spark, snapshot, "batch="):
        if (before is None or batch < before) and path_exists(spark, f"{snapshot}/batch={batch}/_SUCCESS"):
            found |= {b: batch for b in _names(spark, f"{snapshot}/batch={batch}", f"{BUCKET}=")}
    return found


def _read(spark: SparkSession, snapshot: str, versions: dict[int, int]) -> DataFrame:
    return spark.read.parquet(*[f"{snapshot}/batch={v}/{BUCKET}={b}" for b, v in sorted(versions.items())])


def fold_batch(batch: DataFrame, number: int, snapshot: str, key: str, order: str, buckets: int = 64) -> None:
    """Merge one micro-batch into the snapshot: first row of each key, holes filled, nothing overwritten.

    A batch that is run again after a failure reads what stood before it and writes the same again. Buckets' versions
    that two newer batches have replaced are removed.
    """
    spark = batch.sparkSession
    fresh = first_per_group(batch.filter(F.col(key).isNotNull()), [key], [batch[order]])
    touched = [r[0] for r in fresh.select(_bucket(key, buckets)).distinct().collect()]  # at most ``buckets``
    if not touched:
        return
    versions = {b: v for b, v in newest(spark, snapshot, number).items() if b in touched}
    merged = upsert_keep(_read(spark, snapshot, versions), fresh, key) if versions else fresh
    merged.withColumn(BUCKET, _bucket(key, buckets)).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{snapshot}/batch={number}")
    _vacuum(spark, snapshot, number)


def _vacuum(spark: SparkSession, snapshot: str, number: int) -> None:
    current, before = newest(spark, snapshot), newest(spark, snapshot, number)
    for batch in _names(spark, snapshot, "batch="):
        if batch not in current.values() and batch not in before.values():
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{snapshot}/batch={batch}")
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def snapshot_of(spark: SparkSession, snapshot: str) -> DataFrame:
    """The snapshot as the newest finished batches left it."""
    return _read(spark, snapshot, newest(spark, snapshot))


def ingest(spark: SparkSession, source: str, schema: T.StructType, snapshot: str, checkpoint: str, key: str, order: str, buckets: int = 64) -> StreamingQuery:
    """Read every parquet file that hasn't been read yet, fold it in, and stop."""
    arriving = spark.readStream.schema(schema).parquet(source)
    writer = arriving.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    fold = partial(fold_batch, snapshot=snapshot, key=key, order=order, buckets=buckets)
    return writer.foreachBatch(lambda batch, number: fold(batch, number)).start()
