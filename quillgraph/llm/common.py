"""Shared plumbing: shared scratch tables, Arrow batch maps, word rules."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillgraph.session import shipped

#: Rows and bytes handed to a Python worker at once; texts are long, so the default row count is too many.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20
_local_dir: list[str] = []
_kept: dict[object, object] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where none is named, a temporary one, on a single machine alone; a cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_dir:
            _local_dir.append(tempfile.mkdtemp(prefix="quillgraph-"))
            atexit.register(shutil.rmtree, _local_dir[0], True)
        root = f"file://{_local_dir[0]}"
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{scratch_root(spark)}/quillgraph/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a shared table and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def batched(spark: SparkSession) -> None:
    """Send the package to the workers, and keep Arrow batches small, so that a worker's memory stays bounded."""
    shipped(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def kept(key: object, make: Callable[[], object]):
    """What ``make`` gives, kept in this worker between tasks; a worker keeps one such object at a time."""
    if key not in _kept:
        let_go()
        _kept[key] = make()
    return _kept[key]


def let_go() -> None:
    """Give back the memory of what this worker keeps: it turns to an operator that keeps nothing."""
    if _kept:
        _kept.clear()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str, keeps: bool = False) -> DataFrame:
    """``mapInArrow`` with a per-task setup: ``make()`` runs on the executor and returns the batch function.

    ``keeps``: it takes an object from ``kept``.
    """
    batched(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            let_go()
        one = make()
        for batch in batches:
            if batch.num_rows and (out := one(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and the other columns under names that no operator uses."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_carried{i}") for i, c in enumerate(others)])


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``carried(docs)`` with the columns of ``docs`` again."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return rows.select(*[c if c in ("doc_id", "text") else F.col(f"_carried{others.index(c)}").alias(c) for c in docs.columns])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and ``text`` of the documents table; other columns are not read."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Shuffle partitions so that each holds about ``per_part`` rows, and no fewer than the session's."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))
