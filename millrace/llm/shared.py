"""Tables and archives that a job writes on its way, in the folder all executors share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch on its way to Python, unless the session has a value of its own.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset and the
    master is local, as in tests. A cluster's executors could not see such a folder: an error."""
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


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage is cut, and a lost
    executor costs no recomputation of what stands before. The table stays, as a result reads it."""
    return _written(df, label)[0]


class Tables:
    """Written tables of one job. ``drop`` removes one that nothing reads any more; what is left
    goes when the ``with`` block ends without an error."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[tuple[DataFrame, str]] = []

    def __call__(self, df: DataFrame, label: str) -> DataFrame:
        table, path = _written(df, label)
        self.paths.append((table, path))
        return table

    def drop(self, table: DataFrame) -> None:
        for found in [x for x in self.paths if x[0] is table]:
            self.paths.remove(found)
            remove(self.spark, found[1])

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, kind, *_) -> None:
        for _, path in self.paths if kind is None else ():
            remove(self.spark, path)
        self.paths = []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder in whatever store it is."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def mapped(rows: DataFrame, run, schema) -> DataFrame:
    """``rows.mapInArrow(run, schema)`` with batches of a few MB, where the session leaves Spark's
    64 MB: long texts come by a few, so that neither side of the pipe holds many of them."""
    conf = rows.sparkSession.conf
    if conf.get(BATCH) in ("67108864b", "64MB"):
        conf.set(BATCH, str(BATCH_BYTES))

    def trimmed(batches):
        yield from run(batches)
        release()

    return rows.mapInArrow(trimmed, schema)


def release() -> None:
    """Give freed memory back to the system, as workers wait for their next task beside others that work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` over as many tasks as the session runs at once, if they come in fewer, as those of one small file
    do; larger tables stay where they are."""
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= wanted else rows.repartition(wanted)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text):
    """128-bit digest of a text as hex; null counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def row_of(docs: DataFrame, *without: str):
    """All columns of ``docs`` but some as one struct, so that names of its columns can't clash with
    ours; ``select("row.*")`` gives them back. Columns named as results are replaced by these."""
    low = {x.lower() for x in without}
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in low]).alias("row")


def kept_row(docs: DataFrame, *without: str):
    """As row_of, for rows that are written or go through Python: never a struct without fields."""
    low = {x.lower() for x in without}
    return row_of(docs, *without) if any(c.lower() not in low for c in docs.columns) else F.struct(F.lit(0).alias("none")).alias("row")
