"""Helpers shared by the training-data operators: tables, shared scratch space and files."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space bytes; bytes.split() without arguments cuts at exactly these.
ASCII_SPACE = " \t\n\r\x0b\x0c"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where that is unset (local mode only)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="taskloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new, not yet existing folder in the shared space."""
    return f"{shared_root(spark)}/taskloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet and read it again: cuts lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Have the driver's JVM collect its garbage: only then Spark deletes the shuffle files of steps that are done."""
    gc.collect()
    spark._jvm.System.gc()


def _filesystem(uri: str):
    """(pyarrow filesystem or None for the local one, path)."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return None, parts.path
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


@contextmanager
def writing(uri: str):
    """A binary file that appears under its name only when complete, so a repeated task leaves one whole file."""
    remote, path = _filesystem(uri)
    part = f"{path}.{uuid.uuid4().hex}.part"
    if remote is None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        try:
            with open(part, "wb") as out:
                yield out
            os.replace(part, path)
        finally:
            if os.path.exists(part):
                os.remove(part)
    else:
        remote.create_dir(os.path.dirname(path), recursive=True)
        with remote.open_output_stream(part) as out:
            yield out
        remote.move(part, path)


@contextmanager
def reading(uri: str):
    """The file as a seekable binary stream."""
    remote, path = _filesystem(uri)
    with open(path, "rb") if remote is None else remote.open_input_file(path) as stream:
        yield stream


def batches(rows, limit: int, weight):
    """Lists of rows whose weights add up to about limit."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += weight(row)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held


def slices(batch, limit: int, column: str = "text"):
    """Slices of an Arrow batch with about `limit` bytes of text each (more where one text has more)."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False) + 64
    part = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges[:-1], edges[1:]):
        yield batch.slice(low, high - low)


def positional(df):
    """df with its columns named _col0, _col1, ... so that no name clashes with those of an operator; undo by toDF."""
    return df.toDF(*(f"_col{k}" for k in range(len(df.columns))))


def identified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with columns renamed by position and _row, a long that no two rows share and that ascends with doc_id.

    _row is doc_id where that is unique and never null. Else the rows are numbered in the order of doc_id, null first,
    and written, so that a repeated task finds the same numbers.
    """
    key = F.col(f"_col{docs.columns.index('doc_id')}").cast("long")
    rows = positional(docs)
    total, different = rows.agg(F.count("*"), F.count_distinct(key)).first()
    if total == different:
        return rows.withColumn("_row", key)
    return materialize(rows.orderBy(key.asc_nulls_first()).withColumn("_row", F.monotonically_increasing_id()), scratch(spark, "numbered"))
