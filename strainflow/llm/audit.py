"""Filter interaction audit: what each of five filters removes, at each place of each of the 120
orders in which they can run.

A document's failures are a mask of five bits. A table of 32 masks by 120 orders, made once, says at
which step an order first meets a failure. A task looks its documents' masks up there and counts
removals by part, order and step with np.bincount, once over all documents, once over those of good
quality and once over toxic ones. These partial arrays have a fixed length for each part and are
summed by Spark; redundant and unique failures and the Shapley sums follow from the sums alone.

The masks are made by column expressions, beside a digest of the text and without the text itself,
and are written once. A text's repeats are found by the least doc_id of each digest; digests of a single
document leave before the join back.

Defined cases: a null text is empty, a null part the empty string. A row without doc_id, and rows
that share the least doc_id of their text, repeat nothing. Of several labels of one doc_id any says
good or toxic; rows without a label, or with a null one, are neither. Other columns are ignored. An
empty table gives an empty one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.llm.common import materialize, table, text_or_empty

LETTERS = "ABCDE"
STEPS = len(LETTERS)
ORDERS = ["".join(x) for x in itertools.permutations(LETTERS)]
#: For each order, the filter of each step.
FILTER = np.array([[LETTERS.index(x) for x in order] for order in ORDERS])
#: For each mask of failures and each order, the first step that fails; STEPS if none does.
FIRST = np.array([[next((k for k, f in enumerate(order) if mask >> f & 1), STEPS) for order in FILTER] for mask in range(1 << STEPS)])
_CELLS = len(ORDERS) * STEPS
#: A part's sums: removals of all, good and toxic documents by order and step, then documents by mask.
LENGTH = 3 * _CELLS + (1 << STEPS)
#: A task that holds the sums of more parts hands them on.
PARTS_HELD = 1000
#: More repeated texts aren't broadcast.
BROADCAST_TEXTS = 200_000

MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SYMBOLS = 50, 65, 5, "[#$%&*|]"


def failures(text: Column) -> Column:
    """The bits of the filters A to D, which look at one text alone."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct, chars = F.size(words), F.size(F.array_distinct(words)), F.char_length(text)
    upper = chars - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    failed = [n < MIN_WORDS, 100 * distinct < MIN_DISTINCT * n, 100 * upper.cast("bigint") > MAX_UPPER * chars, text.rlike(SYMBOLS)]
    return sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(failed[1:], 1)), F.when(failed[0], 1).otherwise(0))


def marked(docs: DataFrame, labels: DataFrame, *, part: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, good, toxic) of each row of docs."""
    text = text_or_empty(text_col)
    own = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(id_col).alias("id"),
        failures(text).alias("mask"),
        F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest"),
    )
    own = materialize(own, "audit-masks")
    several = own.filter("id is not null").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    several = materialize(several.select(F.col("digest").alias("_digest"), "first"), "audit-repeats")
    few = several.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS
    seen = own.join(F.broadcast(several) if few else several, F.col("digest") == F.col("_digest"), "left")
    repeats = F.when(F.col("id") > F.col("first"), 1 << LETTERS.index("E")).otherwise(0)
    seen = seen.select("part", "id", (F.col("mask") + repeats).alias("mask"))
    known = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
    known = known.agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    # rows without id have no label, and would all meet in one task
    named = seen.filter("id is not null").join(known, F.col("id") == F.col("_id"), "left")
    named = named.select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return named.unionByName(seen.filter("id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic")))


def _sums(mask: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    """Removals by part, order and step."""
    place = np.arange(len(ORDERS)) * (STEPS + 1)
    cell = code[:, None] * (len(ORDERS) * (STEPS + 1)) + place + FIRST[mask]
    counts = np.bincount(cell.ravel(), minlength=n * len(ORDERS) * (STEPS + 1))
    return counts.reshape(n, len(ORDERS), STEPS + 1)[:, :, :STEPS].reshape(n, _CELLS)


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.list_(pa.int64()))], ["part", "sums"])

    for whole in batches:
        for k in range(0, whole.num_rows, 4096):
            batch = whole.slice(k, 4096)
            parts = batch.column(0).dictionary_encode()
            names, code = parts.dictionary.to_pylist(), parts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            mask, good, toxic = (batch.column(j).to_numpy(zero_copy_only=False) for j in (1, 2, 3))
            n = len(names)
            by_label = [_sums(mask[some], code[some], n) for some in (slice(None), good == 1, toxic == 1)]
            masks = np.bincount(code << STEPS | mask, minlength=n << STEPS).reshape(n, 1 << STEPS)
            for name, sums in zip(names, np.hstack([*by_label, masks]), strict=True):
                held[name] = held[name] + sums if name in held else sums
            if len(held) > PARTS_HELD:
                yield out()
                held.clear()
    if held:
        yield out()


_SCHEMA = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mask = np.arange(1 << STEPS)
    order = np.repeat(ORDERS, STEPS)
    step = np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))
    for batch in batches:
        for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums = np.zeros(LENGTH, np.int64)
            for x in cells:
                sums[x["cell"]] = x["n"]
            removed, good, toxic = sums[: 3 * _CELLS].reshape(3, len(ORDERS), STEPS)
            masks = sums[3 * _CELLS :]
            fails = np.array([masks[mask >> f & 1 == 1].sum() for f in range(STEPS)])
            alone = masks[1 << np.arange(STEPS)]
            shapley = np.bincount(FILTER.ravel(), weights=removed.ravel(), minlength=STEPS).astype(np.int64)
            columns = [masks.sum() - removed.cumsum(axis=1), removed, fails[FILTER] - removed, alone[FILTER], good, toxic, shapley[FILTER]]
            arrays = [pa.array([part] * _CELLS, pa.string()), pa.array(order.tolist()), pa.array(step), *(pa.array(x.ravel()) for x in columns)]
            yield pa.record_batch(arrays, [x.split()[0] for x in _SCHEMA.split(", ")])


def audit(docs: DataFrame, labels: DataFrame, *, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each part, order of the filters and step: documents kept after the step, removed by
    it, failing it but removed before, failing nothing else, removed good and toxic ones, and the
    filter's removals over all orders."""
    rows = marked(docs, labels, part=part, id_col=id_col, text_col=text_col)
    partial = rows.mapInArrow(_partial, "part string, sums array<bigint>")
    cells = partial.select("part", F.posexplode("sums").alias("cell", "n")).filter("n > 0").groupBy("part", "cell").agg(F.sum("n").alias("n"))
    # LENGTH cells of a part at most
    return cells.groupBy("part").agg(F.collect_list(F.struct("cell", "n")).alias("cells")).mapInArrow(_report, _SCHEMA)


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    """The five filters over all documents, by source."""
    return audit(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), table(spark, sf_dir, "labels"))


OP13_SQL = rf"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
w as (select *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from d),
m as (select w.doc_id, part, (len(words) < {MIN_WORDS})::int as a, (100 * len(list_distinct(words)) < {MIN_DISTINCT} * len(words))::int as b,
        (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MAX_UPPER} * length(t))::int as c,
        regexp_matches(t, '{SYMBOLS}')::int as d, coalesce(doc_id > min(doc_id) over (partition by t), false)::int as e from w),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
x as (select part, [a, b, c, d, e] as fails, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, count(*) as n
      from m left join l using (doc_id) group by all),
f as (select unnest(range(5))::int as f),
o as (select row_number() over () as o, [p.f, q.f, r.f, s.f, t.f] as ord from f p, f q, f r, f s, f t where len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
g as (select ord, x.*, coalesce(nullif(list_position(list_transform(ord, lambda k: fails[k + 1]), 1), 0), 6) as hit from o, x),
s as (select ord, part, k, ord[k] as f,
        sum(n) filter (hit > k) as kept, sum(n) filter (hit = k) as removed, sum(n) filter (hit < k and fails[ord[k] + 1] = 1) as redundant,
        sum(n) filter (fails[ord[k] + 1] = 1 and list_sum(fails) = 1) as alone, sum(n * good) filter (hit = k) as good_lost, sum(n * toxic) filter (hit = k) as toxic_lost
      from g, (select unnest(range(1, 6))::int as k) group by ord, part, k)
select part, array_to_string(list_transform(ord, lambda y: 'ABCDE'[y + 1]), '') as filter_order, k as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
       coalesce(redundant, 0)::bigint as redundant, coalesce(alone, 0)::bigint as unique_fails, coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
       coalesce(sum(removed) over (partition by part, f), 0)::bigint as shapley
from s
"""
