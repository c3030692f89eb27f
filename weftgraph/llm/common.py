"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SET = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone (extra columns go), a null text read as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the cluster's shared checkpoint folder.

    Without one a temporary folder takes its place where driver and executors are one
    process; on a cluster that would be another folder on every machine, so it is an error.
    """
    base = spark.conf.get(_SET, None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{_SET} is not set: operators need a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="weft-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set(_SET, base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/weft-{uuid.uuid4().hex}"


def stored(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(nullable(df.schema)).parquet(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves 2 modulo 4; a null id is held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))


_kept: dict = {}


def kept(key: tuple, make: Callable):
    """What a Python worker keeps from task to task (an encoder with its known words): one thing, until another operator's task comes."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def give_back() -> None:
    """Freed memory of this Python worker goes back to the system, where the C library can do that; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 20, rows: int = 2048, keeps: bool = False) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that no slice holds much more than ``limit`` bytes of ``column`` or ``rows`` rows; a longer value stands alone.

    keeps: the task uses what its worker keeps (``kept``); other tasks drop it.
    """
    if not keeps:
        _kept.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        at, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit or i - at == rows:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += int(n)
        yield batch.slice(at)
        del batch
    give_back()


def arrow_batch(columns: dict, schema: T.StructType | pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
