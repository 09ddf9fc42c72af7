"""Sharding: best-fit-decreasing packing of indivisible groups into shards.

Groups of equal texts never part. Their sizes are counted by size in Spark; the counts, not the
groups, are packed: groups of one size, largest size first, fill the bin with the tightest room
that holds them, found in a balanced tree of remaining room, until it holds no more of that
size, then the next tightest. So a run of equal groups costs as many steps as it touches bins,
and what is packed is one row for each distinct size. Distinct sizes s1 < s2 < ... sum to no more
than the total, so there are at most sqrt(2 * total bytes) of them.

Each group then finds its bin by its rank among the groups of its size. Ranks and slots are
counted in two levels (rows of a bucket, then offsets of buckets), so no size and no shard is
ordered by one task, and copies of one text meet their group in a join that Spark splits.

Defined cases: a null text has size 8 and belongs to the group of null texts, which is apart from
that of empty texts; null and repeated doc_ids are ordinary rows; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strainflow.llm.common import materialize, parts_for, table

#: What a row takes besides its text.
ROW_BYTES = 8
#: Rows of a bucket that one task numbers.
BUCKET_ROWS = 20_000


class RoomTree:
    """Bins by remaining room, in a treap: priorities come from the bin's number, so depth is
    logarithmic as expected and every run gives the same tree. Each room holds a bin."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _priority(bin_: int) -> int:
        x = (bin_ + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        return x ^ x >> 27

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return (node[0], node[1], node[2], low), high
        low, high = self._split(node[2], key)
        return low, (node[0], node[1], high, node[3])

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            return (a[0], a[1], a[2], self._join(a[3], b))
        return (b[0], b[1], self._join(a, b[2]), b[3])

    def add(self, room: int, bin_: int) -> None:
        low, high = self._split(self.root, (room, bin_))
        self.root = self._join(self._join(low, ((room, bin_), self._priority(bin_), None, None)), high)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least room that still holds size."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            return None
        path = high
        while path[2] is not None:
            path = path[2]
        room, bin_ = path[0]
        _, rest = self._split(high, (room, bin_ + 1))
        self.root = self._join(low, rest)
        return room, bin_


@dataclass
class Packing:
    """Runs of equal groups: groups number first..last-1 of a size go to a bin."""

    size: list[int]
    first: list[int]
    last: list[int]
    bin: list[int]
    bins: int


def best_fit_decreasing(sizes: np.ndarray, counts: np.ndarray, capacity: int, bins: int | None = None) -> Packing | None:
    """Packs counts[i] groups of sizes[i]; None if `bins` don't suffice. A group above the
    capacity has a bin of its own."""
    tree, used, out = RoomTree(), 0, Packing([], [], [], [], 0)
    for i in np.argsort(sizes)[::-1].tolist():
        size, count, done = int(sizes[i]), int(counts[i]), 0
        while done < count:
            found = tree.take_tightest(size)
            if found is None:
                if bins is not None and used == bins:
                    return None
                found = (max(capacity, size), used)
                used += 1
            room, bin_ = found
            n = min(count - done, room // size)
            tree.add(room - n * size, bin_)
            out.size.append(size), out.first.append(done), out.last.append(done + n), out.bin.append(bin_)
            done += n
    out.bins = used
    return out


def pack_evenly(sizes: np.ndarray, counts: np.ndarray, bins: int) -> Packing:
    """The packing of least capacity (to 1 in 2**12 of a shard) that takes `bins` at most. Groups
    larger than an even share have a shard of their own; the others share the rest."""
    order = np.argsort(sizes)[::-1]
    sizes, counts = sizes[order].astype(object), counts[order].astype(object).copy()
    alone, left, total = Packing([], [], [], [], 0), bins, sum(int(s) * int(c) for s, c in zip(sizes, counts, strict=True))
    for i in range(len(sizes)):
        taken = 0
        while counts[i] and left > 1 and int(sizes[i]) * left > total:
            alone.size.append(int(sizes[i])), alone.first.append(taken), alone.last.append(taken + 1), alone.bin.append(alone.bins)
            taken, counts[i], left, total, alone.bins = taken + 1, counts[i] - 1, left - 1, total - int(sizes[i]), alone.bins + 1
        if not taken or counts[i]:
            break
    offset = dict(zip(alone.size, alone.last, strict=True))
    low = max(-(-total // left), max((int(s) for s, c in zip(sizes, counts, strict=True) if c), default=1), 1)
    s, c = np.array([int(x) for x, n in zip(sizes, counts, strict=True) if n], np.int64), np.array([int(n) for n in counts if n], np.int64)
    step, best, capacity = max(1, low >> 12), None, low
    while (best := best_fit_decreasing(s, c, capacity, left)) is None:
        capacity += step
        step *= 2
    fail, step = capacity - step // 2, max(1, low >> 12)
    while capacity - fail > step:
        middle = (capacity + fail) // 2
        if (tried := best_fit_decreasing(s, c, middle, left)) is None:
            fail = middle
        else:
            best, capacity = tried, middle
    shift = [offset.get(x, 0) for x in best.size]
    return Packing(
        alone.size + best.size,
        alone.first + [f + d for f, d in zip(best.first, shift, strict=True)],
        alone.last + [f + d for f, d in zip(best.last, shift, strict=True)],
        alone.bin + [b + alone.bins for b in best.bin],
        bins,
    )


def numbered(df: DataFrame, group: list[str], order: list[str], rows: int, name: str) -> DataFrame:
    """df with `name`: each row's number from 0 within `group`. Rows of a group are dealt to
    buckets by a hash of `order`, numbered there, and shifted by the buckets before."""
    buckets = parts_for(rows, BUCKET_ROWS, 1)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(*group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*group, "_bucket").orderBy(*order)
    rank = dealt.withColumn("_rank", F.row_number().over(within) - 1)
    return rank.join(starts, [*group, "_bucket"]).withColumn(name, F.col("_start") + F.col("_rank")).drop("_bucket", "_rank", "_start")


def shard_documents(docs: DataFrame, shards: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size, text_crc32, shard, slot): every row in one of `shards`, their bytes nearly
    equal, equal texts together. slot counts a shard's rows from 0."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("digest"),
        ),
        "shard-rows",
    )
    n = rows.count()
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_size"))
    groups = materialize(groups, "shard-groups")
    counted = groups.groupBy("group_size").agg(F.count("*").alias("n")).toPandas()
    packing = pack_evenly(counted["group_size"].to_numpy(np.int64), counted["n"].to_numpy(np.int64), shards)
    runs = spark.createDataFrame(list(zip(packing.size, packing.first, packing.last, packing.bin, strict=True)), "group_size bigint, first bigint, last bigint, shard int")
    ranked = numbered(groups, ["group_size"], ["digest"], n, "rank")
    placed = ranked.join(runs, "group_size").filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))).select("digest", "shard")
    sharded = materialize(rows.join(placed, "digest").select("id", "size", "crc", "digest", "shard"), "shard-placed")
    out = numbered(sharded, ["shard"], ["id", "digest"], -(-n // max(1, shards)), "slot")
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", F.col("slot").cast("bigint").alias("slot"))


def op2_best_fit_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes; equal texts share a shard."""
    out = shard_documents(table(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
