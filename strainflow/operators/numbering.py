"""Row numbers over a natural order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.sources.stage import staged

#: monotonically_increasing_id() has the number in the partition in its low bits.
_BITS = 33


def numbered(df: DataFrame, order: list[str | Column], out: str = "row_number", ranges: int | None = None) -> DataFrame:
    """df with `out`, its rows' numbers from 1 in the order. The order should tell rows apart: which of
    two rows that are equal in it comes first is open.

    Rows are dealt into sorted ranges and written with their range and their place in it; the sizes
    of the ranges, one number each, give how many rows come before a range. A hot value of the first
    columns is split by the later ones. ranges: the session's number of shuffle partitions unless given."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    kept = staged(place, "numbered")
    part = F.shiftright("_place", _BITS).cast("int")
    sizes = {r["part"]: r["n"] for r in kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for k in range(max(sizes, default=-1) + 1):
        before.append(total)
        total += sizes.get(k, 0)
    offset = F.get(F.array(*[F.lit(x).cast("bigint") for x in before]), part) if before else F.lit(0).cast("bigint")
    return kept.withColumn(out, offset + F.col("_place").bitwiseAND((1 << _BITS) - 1) + 1).drop("_place")


def handoff_order(df: DataFrame, document: list[str], origin: str, rank: str, source: str, out: str = "handoff_row_order", expanded: str = "expanded") -> DataFrame:
    """Rows in the order in which the last value of a cell wins: by document keys, species and
    antibiotic (all of `document`), results that a class was expanded to before explicit ones, then
    by the laboratory's own rank and the row's place in its source; nulls last."""
    order = [F.col(c).asc_nulls_last() for c in document]
    first = F.when(F.col(origin) == expanded, 0).otherwise(1)
    return numbered(df, [*order, first, F.col(rank).asc_nulls_last(), F.col(source).asc_nulls_last()], out)
