"""Places that driver and executors share, and blocks of documents written there."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scribemill.llm._arrays import sliced, texts, tidy

BLOCK_BYTES = 6 << 20
#: of Arrow data between Spark and a Python worker
BATCH_BYTES = 16 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir. Where that is unset, a session on one machine, as in tests, gets a folder
    there; on a cluster, whose executors would not see it, this is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: the innermost open block of each thread
_open: contextvars.ContextVar[temporary_tables | None] = contextvars.ContextVar("open", default=None)
#: what a session's queries have left in the shared folder
_left: dict[str, set[str]] = {}


def delete(spark: SparkSession, paths) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def clean_up(spark: SparkSession) -> None:
    """Delete the tables and shards that queries of this application left in the shared folder. Results that read them
    can no longer be computed: for the end of a session, or when its results have been written."""
    delete(spark, _left.pop(spark.sparkContext.applicationId, ()))


def left_behind(spark: SparkSession, path: str) -> str:
    """The path, noted for `clean_up`."""
    _left.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


class temporary_tables:
    """Tables that `written` makes inside the block, in the same thread, are deleted at its end, but for those to keep.

    Only for blocks that leave nothing behind that reads the others: what is kept has been written itself.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def __enter__(self):
        self.token = _open.set(self)
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        self.paths = {path: df for path, df in self.paths.items() if df is not table}
        return table

    def __exit__(self, *_):
        _open.reset(self.token)
        delete(self.spark, self.paths)
        _left.get(self.spark.sparkContext.applicationId, set()).difference_update(self.paths)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int = BATCH_BYTES):
    """Within the block, jobs send rows to Python workers and back in batches of so many bytes, or one row."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The same rows from a table in the shared folder, which outlives any executor; cuts the lineage."""
    path = left_behind(df.sparkSession, shared_dir(df.sparkSession, name))
    with small_batches(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    if block := _open.get():
        block.paths[path] = table
    return table


BLOCKS = "block long, ids array<bigint>, ends binary, data binary"


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = BLOCK_BYTES) -> DataFrame:
    """Rows of consecutive documents, about `size` bytes of UTF-8 each; a longer text is a block by itself.

    `ends` holds the little-endian int64 end of every text in `data`; a null text is empty. The block numbers are
    fixed once the result is written.
    """

    def pack(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        ids, ends, parts, held = [], [], [], 0

        def row():
            nonlocal number, ids, ends, parts, held
            out = pa.record_batch([pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(ends, "<i8").tobytes()], pa.binary()), pa.array([b"".join(parts)], pa.binary())], names=["block", "ids", "ends", "data"])
            number, ids, ends, parts, held = number + 1, [], [], [], 0
            return out

        for batch in batches:
            data, offsets = texts(batch.column(1))
            own = batch.column(0).to_pylist()
            for i, j in sliced(offsets, size):
                if held and held + offsets[j] - offsets[i] > size:
                    yield row()
                ids += own[i:j]
                ends += (offsets[i + 1 : j + 1] - offsets[i] + held).tolist()
                parts.append(data[offsets[i] : offsets[j]].tobytes())
                held += int(offsets[j] - offsets[i])
        if ids:
            yield row()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(pack), BLOCKS)


def block_texts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a block's texts."""
    return np.frombuffer(row["data"], np.uint8), np.concatenate([[0], np.frombuffer(row["ends"], "<i8")]).astype(np.int64)


def rows_of(batch: pa.RecordBatch):
    """The rows of a batch as dictionaries, one at a time: blocks are large."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]
