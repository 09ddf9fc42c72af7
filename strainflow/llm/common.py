"""What the operators of this subpackage share: the shared work folder, written
tables that cut lineage, and sizes of partitions."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session setting under which shuffle files go as soon as the write that needed them ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """The tables and folders that one owner has written, such as a stage of a pipeline."""

    def __init__(self):
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> None:
        """Deletes them. For owners whose results, if they read them, are written."""
        while self.paths:
            delete(spark, self.paths.pop())


_owner: contextvars.ContextVar[Scratch | None] = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch() -> Iterator[Scratch]:
    """What is written within belongs to the Scratch that this gives; without one it stays."""
    own = Scratch()
    token = _owner.set(own)
    try:
        yield own
    finally:
        _owner.reset(token)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session
    that names none (tests, bench) gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strainflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A fresh path in the shared folder, of the current owner unless it is to be kept."""
    path = f"{shared_dir(spark)}/strainflow/{label}-{uuid.uuid4().hex[:12]}"
    if not keep and (own := _owner.get()):
        own.paths.append(path)
    return path


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, label: str) -> str:
    """A new_path() that exists, so that it can be read even if no task writes there."""
    found = new_path(spark, label)
    path = spark._jvm.org.apache.hadoop.fs.Path(found)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return found


def materialize(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends here, so a
    lost executor costs a reread, and the write's shuffle files go at once."""
    spark = df.sparkSession
    path = new_path(spark, label, keep)
    return written(df, path)


def written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_CLEAN, "false")
    with contextlib.suppress(Exception):  # older 4.x has no such setting
        spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        with contextlib.suppress(Exception):
            spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches between the JVM and Python hold no more than about this many bytes, for
    the rest of the session: by rows alone, a batch of long texts would take all memory."""
    with contextlib.suppress(Exception):  # older 4.x has no such setting
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_plans(spark: SparkSession) -> None:
    """Texts of plans are cut for the rest of the session. Spark keeps those of past queries in the
    driver, and a plan with a large literal would take tens of MB there, several times a query."""
    spark.conf.set("spark.sql.maxPlanStringLength", "100000")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def total_bytes(df: DataFrame, column: Column) -> int:
    return df.select(F.sum(F.octet_length(column).cast("bigint"))).first()[0] or 0


def parts_for(size: int, each: int, least: int = 12) -> int:
    """How many partitions of about `each` bytes or rows hold `size`."""
    return max(least, -(-size // each))
