"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch: texts run to hundreds of kilobytes, so batches stay small.
ARROW_ROWS, ARROW_BYTES = 256, 8 << 20
#: Bytes of a file of an intermediate table, and the least worth a task of its own.
FILE_BYTES, TASK_BYTES = 64 << 20, 1 << 20
#: The most that is broadcast, and the most that a partition of a hash join may build on.
BROADCAST_BYTES, HASH_BYTES = 16 << 20, 64 << 20
#: A table of at most so many bytes for each core may be dealt anew to all of them.
SPREAD_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df, whose rows meet costly work in any order: a small table in fewer files than there are cores is dealt to all of
    them. Large ones are in many splits and stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > cores * SPREAD_BYTES:
        return df
    return df.repartition(cores) if 0 < len(df.inputFiles()) < cores else df


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where all of them are this one process (tests) may a temporary one
    stand in for it: on a cluster each machine would write to a folder of its own, and rows would be lost."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="mqstream-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/mqstream-{spark.sparkContext.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark's file systems keep it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application's operators, once their results have been read or written."""
    remove(spark, scratch(spark))


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` wrote as they are, once all that is made of them has been written too. What is ``kept`` may be
    computed again, so what it is made of stays."""
    for df in tables:
        for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            remove(df.sparkSession, path)


def saved(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors. ``by`` is a column with
    few values whose rows are read apart."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/{label}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """A table that several steps read: computed once and held on the executors' disks. What is lost with an executor is
    computed again."""
    return df.persist(StorageLevel.DISK_ONLY)


def files_for(held: DataFrame) -> int:
    """How many files a table that is persisted and counted is worth, by its bytes: enough for all cores while each has
    something to do, and none larger than FILE_BYTES."""
    size = int(held.select("*")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // FILE_BYTES), min(held.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def settled(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """``saved`` in files whose number follows from the table's bytes, not from the tasks that made it: the tables here are
    narrow, and many small files cost more than the step itself."""
    held = kept(df)
    held.count()
    out = saved(held.coalesce(files_for(held)), label, by)
    held.unpersist()
    return out


def small(df: DataFrame, row_bytes: Column | int = 16) -> DataFrame:
    """df, marked for a join with large rows. It is measured: broadcast if within BROADCAST_BYTES; beyond that the side a
    shuffled hash join builds on, so that the large rows are never sorted, as long as a partition's share can be held in
    memory; and beyond that a plain join, which spills. ``row_bytes`` is what a row takes."""
    size = df.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return F.broadcast(df)
    return df.hint("shuffle_hash") if size <= HASH_BYTES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def batch_of(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """Texts as UTF-8, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names like these that none of the taken ones equals, whatever its case."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out
