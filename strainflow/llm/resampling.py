"""Importance resampling towards a target distribution, on hashed n-grams whose CRCs are composed.

A feature is a run of words joined by single spaces; its bucket is the CRC-32 of those bytes. Each
word's CRC is computed once. The CRC of a run comes from those of its words: appending n bytes
multiplies a CRC by a 32 x 32 matrix over GF(2), the n-th power of the matrix of one zero byte, so
crc(a + b) = shift(crc(a), len(b)) ^ crc(b). Powers of two of that matrix are made once, as four
tables of 256 words each, and applied to all runs of a batch by the bits of their lengths. No run is
ever put together as a string.

Documents are scanned twice. The first scan counts buckets, in one array for each task, summed by Spark;
what reaches the driver is a count for each bucket, of which there are `buckets`. The second scan adds
up the gains of each document's features. Ranks come from the sorted ranges of the scored rows, whose
sizes give the number before each range; no row is ranked in a single task.

Defined cases: words are runs of a-z, 0-9 and non-ASCII characters after A-Z is lowered. Null and
empty texts have no features and weight 0. The noise of a row without doc_id is that of the empty
string, and such rows come last among equal scores. Repeated rows are drawn as rows of their own. An
empty target gives gains by the smoothing alone. Other columns are ignored. An empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainflow.llm.common import materialize, parts_for, table
from strainflow.llm.words import ALNUM, Words, chunks, words

BUCKETS, PERCENT, LEAST_WORDS, SEED = 10_000, 10, 20, 2024
#: The reversed polynomial of CRC-32; a fixed value.
POLYNOMIAL = 0xEDB88320
#: Bytes of a word that are folded for all words at once; zlib takes the rest of longer ones.
STEPS = 32
#: Rows in a range that is sorted and numbered at once.
RANGE_ROWS = 500_000


@cache
def _bytes_table() -> np.ndarray:
    """What a byte adds to a CRC, for each of its 256 values."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, crc >> 1 ^ np.uint32(POLYNOMIAL), crc >> 1).astype(np.uint32)
    return crc


def _times(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """A matrix, as four tables by the byte of the vector, times each CRC."""
    return tables[0][crc & 255] ^ tables[1][crc >> 8 & 255] ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


@cache
def _shift(power: int) -> np.ndarray:
    """The matrix that appends 2**power zero bytes."""
    bits = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32)[:, None])
    if power:
        half = _shift(power - 1)
        return _times(half, _times(half, bits))
    return _bytes_table()[bits & 255] ^ bits >> 8


def combine(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs of a + b, of the CRCs of a and b and the length of b."""
    out = first.copy()
    for power in range(int(length.max(initial=0)).bit_length()):
        some = np.flatnonzero(length >> power & 1)
        out[some] = _times(_shift(power), out[some])
    return out ^ second


def word_crcs(w: Words) -> np.ndarray:
    """The CRC-32 of each word."""
    length, step = w.stop - w.start, _bytes_table()
    crc = np.full(len(length), 0xFFFFFFFF, np.uint32)
    rest = np.arange(len(length))
    for k in range(STEPS):
        rest = rest[length[rest] > k]
        if not len(rest):
            break
        now = crc[rest]
        crc[rest] = step[(now ^ w.data[w.start[rest] + k]) & 255] ^ now >> 8
    crc ^= np.uint32(0xFFFFFFFF)
    for k in rest[length[rest] > STEPS].tolist():
        crc[k] = zlib.crc32(w.data[w.start[k] + STEPS : w.stop[k]], int(crc[k]))
    return crc


def run_crcs(w: Words, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, first word, CRC) of all runs of 1 to `longest` words that lie within a row."""
    crc, length = word_crcs(w), w.stop - w.start
    ends = np.repeat(w.first[1:], np.diff(w.first))
    yield 1, np.arange(len(crc)), crc
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    spaced = combine(space, crc, length) if longest > 1 else crc
    at, run = np.arange(len(crc)), crc
    for size in range(2, longest + 1):
        inside = at + size <= ends[at]
        at, run = at[inside], run[inside]
        last = at + size - 1
        run = combine(run, spaced[last], length[last] + 1)
        yield size, at, run


def _count(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in chunks(batches, 2000):
            for _, _, crc in run_crcs(words(batch.column(0), ALNUM), longest):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, *, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    counted = texts.select(F.col(text_col).cast("string")).mapInArrow(_count(longest, buckets), "bucket int, n bigint")
    got = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's ratio of smoothed shares."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(id_: object, seed: int) -> int:
    """floor(1000 times) a Gumbel variate that the id decides."""
    h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(gains: np.ndarray, longest: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2000):
            w = words(batch.column(1), ALNUM)
            features, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for _, at, crc in run_crcs(w, longest):
                before = np.searchsorted(at, w.first)
                total = np.concatenate([np.zeros(1, np.int64), np.cumsum(gains[crc % np.uint32(len(gains))])])
                features += np.diff(before)
                weight += np.diff(total[before])
            drawn = np.array([noise(x, seed) for x in batch.column(0).to_pylist()], np.int64)
            yield pa.record_batch([batch.column(0), *(pa.array(x.astype(np.int64)) for x in (np.diff(w.first), features, weight, weight + drawn))], ["id", "n_words", "n_features", "weight", "score"])

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.record_batch([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(before, before + n))], [*batch.schema.names, "part", "at"])
        before += n


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(id_col, n_features, weight, score, rank) of each row of docs; rank is null for rows that
    aren't drawn. `longest`: words of the longest features."""
    options = {"text_col": text_col, "longest": longest, "buckets": buckets}
    gains = bucket_gains(bucket_counts(docs, **options), bucket_counts(target, **options))
    id_type = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(_score(gains, longest, seed), f"id {id_type}, n_words bigint, n_features bigint, weight bigint, score bigint")
    # numbered, so that rows which are equal otherwise don't all fall in one range
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rank = lambda x: x.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
    few, enough = scored.filter(F.col("n_words") < least_words), scored.filter(F.col("n_words") >= least_words)
    n = enough.count()
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("_row")]
    ranges = enough.repartitionByRange(parts_for(n, RANGE_ROWS), *order).sortWithinPartitions(*order)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in enough.schema)
    ranges = materialize(ranges.mapInArrow(_numbered, f"{fields}, part int, at bigint"), "ranked")
    # a row for each range
    sizes = sorted((r["part"], r["n"]) for r in ranges.groupBy("part").agg(F.count("*").alias("n")).collect())
    starts, before = [], 0
    for part, size in sizes:
        starts.append((part, before))
        before += size
    offsets = docs.sparkSession.createDataFrame(starts, "part int, before bigint")
    place = F.col("before") + F.col("at") + 1
    drawn = ranges.join(F.broadcast(offsets), "part").withColumn("rank", F.when(place <= n * percent // 100, place))
    return rank(drawn).unionByName(rank(few.withColumn("rank", F.lit(None).cast("bigint"))))


def op12_crc_resampling(spark, sf_dir: str) -> DataFrame:
    """All documents, drawn towards the benchmark's words."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP12_SQL = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
dw as (select r, unnest(w) as word from d),
bw as (select unnest({_WORDS}) as word from benchmark),
tab as (select list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, {POLYNOMIAL}) else c >> 1 end)) as tab),
v as (select word, list_transform(range(1, strlen(word) + 1), lambda i: ('0x' || substr(hex(encode(word)), 2 * i - 1, 2))::bigint) as bytes from (select word from dw union select word from bw)),
h as (select word, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % {BUCKETS} as bucket from v, tab),
s as (select bucket, count(*) as s from dw join h using (word) group by bucket),
t as (select bucket, count(*) as t from bw join h using (word) group by bucket),
g as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from dw) + {BUCKETS})::double / ((s + 1)::double * ((select count(*) from bw) + {BUCKETS})::double)))::bigint as gain from s left join t using (bucket)),
p as (select r, sum(gain) as weight from dw join h using (word) join g using (bucket) group by r),
x as (select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight, ('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h from d left join p using (r)),
y as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from x),
z as (select *, row_number() over (partition by n_features >= {LEAST_WORDS} order by score desc, doc_id nulls last) as k, (select count(*) from y where n_features >= {LEAST_WORDS}) as n from y)
select doc_id, n_features, weight, score, case when n_features >= {LEAST_WORDS} and k <= n * {PERCENT} // 100 then k end as rank from z
"""
