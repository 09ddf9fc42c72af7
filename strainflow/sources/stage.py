"""Tables written once in the folder that driver and executors share, for plans that read a result
several times or need its rows to stay where they are."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strainflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows of a partition that dealt() makes.
ROWS = 400_000


def partitions(spark: SparkSession, rows: int) -> int:
    """As many as hold ROWS rows or fewer each, and as the session's at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS))


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by its keys, for an aggregate with nearly as many groups as rows: in partitions of ROWS rows or
    fewer, as many as the session's at least, so that a task's table doesn't grow with the input. rows:
    about how many df has."""
    return df.repartition(partitions(df.sparkSession, rows), *keys)


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark takes df for small enough to be sent whole to each task of a join."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit


#: Bytes of a generated method that HotSpot compiles at most; larger ones are interpreted for good.
COMPILED = 8000


@contextlib.contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Plans of many columns run in methods that the JVM compiles: what would be one larger method is
    run an operator at a time. The session's own limit is back afterwards."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), COMPILED)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet and read back: it is computed once, and a lost executor costs a reread.
    The files go when the driver ends."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stages/{label}-{uuid.uuid4().hex[:12]}"
    with compiled(spark):
        df.write.parquet(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(folder)
