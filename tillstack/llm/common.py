"""Helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows of one Arrow batch.  Long texts bound the batch's bytes together with
#: ``spark.sql.execution.arrow.maxBytesPerBatch`` where Spark has it.
ARROW_ROWS = 256
_made: list[tuple[object, object]] = []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Where the session has none (local tests) a folder is made and registered
    with the context; a session with several machines must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = held.get() if held.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _drop_made() -> None:
    while _made:
        fs, path = _made.pop()
        try:
            fs.delete(path, True)
        except Exception:  # the JVM may be gone already: the folder is scratch
            return


atexit.register(_drop_made)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and survives lost executors.  The files go when the
    driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _made.append((jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath))
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, by: str) -> DataFrame:
    """``stored``, with the rows in buckets of the column ``by``: what groups or joins them
    by it needs no shuffle of them.  Only tables have buckets: the name of this external
    one goes once its files are known."""
    spark, name = df.sparkSession, f"llm_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(tasks(spark), by).saveAsTable(name)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _made.append((jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath))
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return held


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of whole texts holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def give_back() -> None:
    """Return freed memory of a Python worker to the machine: workers live on after their
    task, and what one keeps counts beside the next task's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """Tells rows with one id and other texts apart when results are joined back."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def word_chunks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text in lists of bounded length.

    ``bytes.split`` parts at exactly these six characters.
    """
    if len(data) <= size:
        yield data.split()
        return
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[at:end].split()
        at = end


def batch(columns: Iterable, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def byte_values(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8 (null: empty), one at a time."""
    for v in column.cast(pa.large_binary()):
        yield v.as_py() or b""


def laid_out(data: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """A text's words joined by one space, and where each starts and ends; no list of all words is kept."""
    parts, sizes = [], []
    for words in word_chunks(data):
        if words:
            parts.append(b" ".join(words))
            sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
    size = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    ends = np.cumsum(size + 1) - 1 if len(size) else size
    return b" ".join(parts), ends - size, ends
