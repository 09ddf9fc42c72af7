"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of WINDOW words (an item of fewer words is one window). A window's
elements are its word shingles, ordered by rarity over all documents. A document that contains a
window contains all its shingles, so the necessary prefix is one shingle, the rarest. Documents'
shingles meet that index by a join; the shingle's offset gives the window's position, which must
fit in the document (positional and length bounds), and the words are then compared exactly.

Documents are scanned twice: for the counts of the benchmark's shingles, and for the index's
shingles with the words around them. A bitmap of fixed size drops other shingles at the scan. The
index is broadcast while its checked size is small; else the join shuffles. Texts never travel.

Defined cases: words are runs of a-z, 0-9 and non-ASCII characters after A-Z is lowered. Null and
empty texts have no words and are clean; an item without words has no window; an item_id may be
null (it is then left out of the list of items, but its words count as hit). Repeated rows and
equal doc_ids are judged row by row, since results hang on the text alone. Other columns are
ignored by match() and passed through by clean().
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainflow.llm.common import materialize, table
from strainflow.llm.words import ALNUM, chunks, words

WINDOW = 10
SHINGLE = 5
#: Bits of the bitmap that drops shingles at the scan.
BITS = 1 << 22
#: An index of more windows isn't broadcast.
BROADCAST_WINDOWS = 200_000
#: More texts with a hit aren't broadcast; each has up to some kB of items.
BROADCAST_TEXTS = 50_000


def _windows(window: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = words(batch.column(1), ALNUM)
            out = [[], [], [], []]
            for row in range(batch.num_rows):
                a, b = int(w.first[row]), int(w.first[row + 1])
                size = min(window, b - a)
                width = min(shingle, size)
                for at in range(a, b - size + 1) if size else ():
                    out[0].append(batch.column(0)[row].as_py())
                    out[1].append(" ".join(bytes(w.data[s:e]).decode() for s, e in zip(w.start[at : at + size], w.stop[at : at + size], strict=True)))
                    out[2].append(size)
                    part = w.hash[at : at + size]
                    keep, w.hash = w.hash, part
                    out[3].append(w.shingles(width).astype(np.int64).tolist())
                    w.hash = keep
            yield pa.record_batch([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.list_(pa.int64()))], ["item", "window", "size", "shingles"])

    return run


def _bitmap(tokens: DataFrame, column: str) -> np.ndarray:
    """Which remainders of a token modulo BITS occur: at most BITS rows, whatever the benchmark."""
    got = tokens.select(F.pmod(F.col(column), F.lit(BITS)).cast("int").alias("at")).distinct().toPandas()["at"]
    bits = np.zeros(BITS, bool)
    bits[got.to_numpy(np.int64)] = True
    return np.packbits(bits)


def _hits(w, widths: list[int], packed: np.ndarray):
    """Positions and tokens of the shingles whose bit is set and that lie within a row."""
    bits = np.unpackbits(packed)
    ends = np.repeat(w.first[1:], np.diff(w.first))
    for width in widths:
        token = w.shingles(width)
        at = np.flatnonzero(bits[(token & np.uint64(BITS - 1)).astype(np.int64)])
        at = at[at + width <= ends[at]]
        yield at, token[at].astype(np.int64)


def _counts(widths: list[int], packed: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2000):
            w = words(batch.column(0), ALNUM)
            tokens = np.concatenate([np.zeros(0, np.int64), *(t for _, t in _hits(w, widths, packed))])
            token, n = np.unique(tokens, return_counts=True)
            yield pa.record_batch([pa.array(token), pa.array(n.astype(np.int64))], ["token", "n"])

    return run


def _candidates(widths: list[int], packed: np.ndarray, reach: int, window: int, schema: pa.Schema):
    """For each row its digest, number of words, and candidates: a shingle of the index, its
    position, and the words that a window around it may take."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 2000):
            w = words(batch.column(1), ALNUM)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for at, token in _hits(w, widths, packed):
                row = np.searchsorted(w.first, at, side="right") - 1
                begin = np.maximum(w.first[row], at - reach)
                end = np.minimum(w.first[row + 1], at + window)
                for r, p, t, b, e in zip(row.tolist(), at.tolist(), token.tolist(), begin.tolist(), end.tolist(), strict=True):
                    text = " ".join([bytes(w.data[s:z]).decode() for s, z in zip(w.start[b:e].tolist(), w.stop[b:e].tolist(), strict=True)])
                    first = int(w.first[r])
                    found[r].append({"token": t, "at": p - first, "begin": b - first, "near": text})
            texts = batch.column(1)
            key = [hashlib.sha256(texts[i].as_buffer()).digest()[:16] if texts[i].is_valid else b"" for i in range(len(texts))]
            yield pa.record_batch([batch.column(0), pa.array(key, pa.binary()), pa.array(np.diff(w.first).astype(np.int64)), pa.array(found, schema.field("found").type)], schema=schema)

    return run


_FOUND = T.ArrayType(T.StructType([T.StructField("token", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("begin", T.IntegerType()), T.StructField("near", T.StringType())]))


def _matches(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(id, key, n_words) of each row of docs, and (key, items, n_hit) of each text with a hit."""
    from pyspark.sql.pandas.types import to_arrow_schema

    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    found = materialize(found.mapInArrow(_windows(window, shingle), "item string, window string, size int, shingles array<bigint>").distinct(), "windows")
    tokens = found.select(F.explode("shingles").alias("token")).distinct()
    widths = sorted({min(shingle, r[0]) for r in found.select("size").distinct().collect()})

    scanned = text.select("text").mapInArrow(_counts(widths, _bitmap(tokens, "token")), "token bigint, n bigint")
    often = materialize(scanned.groupBy("token").agg(F.sum("n").alias("n")).join(tokens, "token", "left_semi"), "shingle-counts")
    each = found.select("item", "window", "size", F.posexplode("shingles").alias("offset", "token")).join(often, "token", "left")
    rarest = each.groupBy("item", "window", "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("least"))
    # a window of which a shingle never occurs can't be in any document
    index = materialize(rarest.filter("least.n > 0").select("item", "window", "size", "least.token", "least.offset"), "window-index")

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("key", T.BinaryType()), T.StructField("n_words", T.LongType()), T.StructField("found", _FOUND)])
    arrow = to_arrow_schema(schema)
    rows = materialize(text.mapInArrow(_candidates(widths, _bitmap(index, "token"), window - 1, window, arrow), schema), "candidates")
    side = F.broadcast(index) if index.count() <= BROADCAST_WINDOWS else index
    near = rows.filter(F.size("found") > 0).select("key", "n_words", F.explode("found").alias("f")).select("key", "n_words", "f.*")
    begin = F.col("at") - F.col("offset")
    there = near.join(side, "token").filter((begin >= 0) & (begin + F.col("size") <= F.col("n_words")))
    same = there.filter(F.array_join(F.slice(F.split("near", " "), begin - F.col("begin") + 1, F.col("size")), " ") == F.col("window"))
    hit = same.groupBy("key").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.collect_set(F.struct(begin.alias("a"), (begin + F.col("size") - 1).alias("b"))).alias("spans"),
    )
    hit = hit.select("key", "items", F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["a"], s["b"]))))).cast("bigint").alias("n_hit"))
    # written, so that a text with many copies meets one row, broadcast or in a join that Spark splits
    hit = materialize(hit, "hit-texts")
    return rows.select("id", "key", "n_words"), F.broadcast(hit) if hit.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS else hit


def match(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(id_col, n_words, n_hit, items array<string>): a row for each row of docs."""
    id_col = options.get("id_col", "doc_id")
    rows, hit = _matches(docs, items, **options)
    out = rows.join(hit, "key", "left")
    return out.select(F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs that contain no window of an item, by their own texts, whatever their ids."""
    text = F.col(options.get("text_col", "text")).cast("string")
    hit = _matches(docs, items, **options)[1].select(F.col("key").alias("_hit"))
    # the key that _candidates gives a text
    return docs.join(hit, F.substring(F.unhex(F.sha2(text, 256)), 1, 16) == F.col("_hit"), "left_anti")


def op4_benchmark_windows(spark, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    found = match(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


_SQL_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP4_SQL = f"""
with items as (select item_id::varchar as item, {_SQL_WORDS} as w from benchmark),
windows as (
  select distinct item, len(w)::bigint as n, array_to_string(w, ' ') as key from items where len(w) between 1 and {WINDOW - 1}
  union select distinct item, {WINDOW}::bigint, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')
  from (select item, w, unnest(range(1, len(w) - {WINDOW - 2})) as i from items where len(w) >= {WINDOW})),
docs as (select doc_id, row_number() over () as r, {_SQL_WORDS} as w from documents),
spots as (
  select r, s.n, i, array_to_string(list_slice(w, i, i + s.n - 1), ' ') as key
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, (select distinct n from windows) where len(w) >= n) s),
hits as (select a.r, a.i, a.n, x.item from spots a join windows x on a.key = x.key and a.n = x.n),
covered as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as l from (select distinct r, item from hits where item is not null) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(l, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join covered using (r) left join named using (r)
"""
