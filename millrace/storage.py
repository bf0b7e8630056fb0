"""Tables that a job writes on its way, in the folder that all executors share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset and the master
    is local, as in tests. A cluster's executors could not see such a folder: an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of its own: lineage is cut, and what isn't deterministic is fixed."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch on its way to Python, unless the session has a value of its own.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose texts go to Python by a few MB a batch where the session leaves Spark's 64 MB: neither side of the pipe
    holds many long texts."""
    conf = df.sparkSession.conf
    if conf.get(BATCH) in ("67108864b", "64MB"):
        conf.set(BATCH, str(BATCH_BYTES))
    return df


def shares(weights: list[int], most: int) -> Iterator[slice]:
    """Slices of rows of ``most`` weight together, or of one row that has more: what a worker makes objects for at once."""
    start = held = 0
    for i, weight in enumerate(weights):
        if i > start and held + weight > most:
            yield slice(start, i)
            start, held = i, 0
        held += weight
    if weights:
        yield slice(start, len(weights))


def sliced(batches: Iterator, weigh: Callable, most: int) -> Iterator:
    """Batches (series, or tuples of them) in slices of ``most`` weight, by ``weigh`` of a row's values. Freed memory goes back to the
    system behind each batch, as workers wait for their next one beside others that work."""
    for batch in batches:
        columns = batch if isinstance(batch, tuple) else (batch,)
        for own in shares([weigh(*row) for row in zip(*columns, strict=True)], most):
            parts = tuple(x.iloc[own] for x in columns)
            yield parts if isinstance(batch, tuple) else parts[0]
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
