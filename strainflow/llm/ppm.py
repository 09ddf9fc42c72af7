"""Scoring by prediction by partial matching over bytes, with a model learned from the whole corpus.

A document is the byte string of its words, each followed by a space, and one end sign. A byte is
predicted from the `order` bytes before it. Contexts form a trie, read from the nearest byte on: a
node has the symbols that followed it and their counts. The deepest contexts count occurrences; a
shorter one counts in how many of the contexts that lengthen it by a byte a symbol was seen, as a coder
does that only updates what it used. A symbol unknown to a node costs an escape (method D:
half a count for each different symbol of the node, taken from its own), and the next shorter context predicts it with all symbols
of the longer one excluded; below the empty context, signs that were never seen are equally likely.

What a byte costs hangs on it and its context alone, so the trie is evaluated once for each distinct
run of order + 1 bytes of the corpus, seen in training or not. Runs travel as numbers of at most 64
bits, with counts added up in tasks first. The trie is dealt by the two nearest bytes of a context,
so a group holds whole subtrees and at most 256 ** order rows; the nodes above, at most 65,536
symbols, are known to all tasks.

Documents are then read again. Runs and words with at least a share 1 / `heavy` of all occurrences, of
which there can be no more than `heavy`, are looked up in a table that each task has; what is rarer, so
never hot, meets the written costs and counts in a join, as (row, run, times), and is summed by row.
So the model may grow with the corpus without limit.

The base score is that of a smoothed unigram model of the same words.

Defined cases: words are what white space parts, after A-Z is lowered. Null and empty texts have the end
sign as their only token. A row without doc_id is learned from and not held out. Repeated rows are
learned from and scored each. Without any training row all signs are equally likely, and no token
is known. Words are told apart by 64-bit hashes (two of a billion words fall together with odds of
1 to 37). Other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strainflow.llm.common import materialize, table
from strainflow.llm.words import NOT_SPACE, Words, chunks, words

ORDER = 5
#: Runs, and words, that a task looks up without a join, at most.
HEAVY = 1 << 22
#: Distinct keys that a counting task holds before it hands their counts on.
HELD = 2_000_000
SPACE, END = 0x20, 0x0A
#: Bytes that words can have, the space and the end sign.
SIGNS = int(NOT_SPACE.sum()) + 2
ALPHA = 0.1
_RUN, _WORD = 0, 1
_LOW = np.uint64(0xFF)


def _mask(order: int) -> np.uint64:
    """The bits of a run's last order + 1 bytes."""
    return np.uint64((1 << 8 * (order + 1)) - 1)


def runs(w: Words, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each sign's run, its context before it and itself last, and the rows + 1 places of each row's
    signs. Before a row's first sign there are end signs."""
    length = w.stop - w.start
    n_words = np.diff(w.first)
    row = np.repeat(np.arange(len(n_words)), n_words)
    before = np.concatenate([[0], np.cumsum(length + 1)])
    # a row takes `order` places, then its words' signs, then its end
    at = before[:-1] + row * (order + 1) + order
    out = np.full(before[-1] + len(n_words) * (order + 1), END, np.uint8)
    inside = np.concatenate([[0], np.cumsum(length)])
    each = np.arange(inside[-1])
    out[each + np.repeat(at - inside[:-1], length)] = w.data[each + np.repeat(w.start - inside[:-1], length)]
    out[at + length] = SPACE
    rows = np.concatenate([[0], np.cumsum(before[w.first[1:]] - before[w.first[:-1]] + 1)])
    key = np.zeros(len(out) - order if len(out) else 0, np.uint64)
    for k in range(order + 1):
        key = key << np.uint64(8) | out[k : k + len(key)].astype(np.uint64)
    real = np.ones(len(key), bool)
    for k in range(order):
        # the last places before a row's signs, but for the first row's, end no run of any row
        real[(rows[1:-1] + np.arange(1, len(rows) - 1) * order - order + k)] = False
    return key[real], rows


class Tally:
    """Counts by key, held as sorted arrays."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = self.merged = 0

    def add(self, keys: np.ndarray, once: int = 1) -> None:
        key, n = np.unique(keys, return_counts=True)
        self.parts.append((key, n * once))
        self.size += len(key)
        if self.size > 2 * self.merged + 500_000:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([np.zeros(0, np.uint64), *(p[0] for p in self.parts)])
        n = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in self.parts)])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
        self.parts = [(keys[first], np.add.reduceat(n, first) if len(first) else n)]
        self.size = self.merged = len(first)
        return self.parts[0]


def _count(order: int):
    def out(kind: int, tally: Tally) -> Iterator[pa.RecordBatch]:
        keys, n = tally.merge()
        for k in range(0, len(keys), 100_000):
            some = keys[k : k + 100_000]
            yield pa.record_batch([pa.array(np.full(len(some), kind, np.int8)), pa.array(some.view(np.int64)), pa.array(n[k : k + 100_000])], ["kind", "key", "n"])
        tally.__init__()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {_RUN: Tally(), _WORD: Tally()}
        for batch in chunks(batches, 2000):
            w = words(batch.column(1), NOT_SPACE)
            trains = batch.column(0).to_numpy(zero_copy_only=False)
            key, rows = runs(w, order)
            of = np.repeat(trains, np.diff(rows))
            held[_RUN].add(key[of])
            held[_RUN].add(key[~of], 0)
            held[_WORD].add(w.hash[np.repeat(trains, np.diff(w.first))])
            for kind, tally in held.items():
                if tally.size > HELD and len(tally.merge()[0]) > HELD:
                    yield from out(kind, tally)
        for kind, tally in held.items():
            yield from out(kind, tally)

    return run


class Level:
    """The nodes of one depth: their symbols as sorted runs with counts."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        self.keys, self.n = keys, n
        context = keys >> np.uint64(8)
        self.first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), context[1:] != context[:-1]]))
        self.nodes = context[self.first]
        self.symbols = np.diff(np.concatenate([self.first, [len(keys)]]))
        self.total = self.sums(n)
        #: What a node's symbols have in the node of its next shorter context.
        self.below = np.zeros(len(self.nodes), np.int64)

    def sums(self, n: np.ndarray) -> np.ndarray:
        return np.add.reduceat(n, self.first) if len(self.first) else np.zeros(0, np.int64)

    def shorter(self, order: int) -> Level:
        """The nodes of one byte less, which count in how many of these a symbol was seen."""
        return Level(*np.unique(self.keys & _mask(order - 1), return_counts=True))

    def over(self, less: Level, order: int) -> None:
        self.below = self.sums(less.n[np.searchsorted(less.keys, self.keys & _mask(order - 1))])


def _find(sorted_: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted in a sorted array, and whether they are there."""
    at = np.searchsorted(sorted_, wanted)
    return at, at < len(sorted_) if not len(sorted_) else sorted_[np.minimum(at, len(sorted_) - 1)] == wanted


def costs(keys: np.ndarray, levels: list[Level]) -> np.ndarray:
    """log10 of the probability of each run's last byte after the others; levels by their order."""
    out = np.zeros(len(keys))
    open_, gone, gone_n = np.arange(len(keys)), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    for order in range(len(levels) - 1, -1, -1):
        level, key = levels[order], keys[open_] & _mask(order)
        node, known = _find(level.nodes, key >> np.uint64(8))
        at, there = _find(level.keys, key)
        node = np.where(known, node, 0)
        if len(level.nodes):
            total, symbols = level.total[node] - gone_n, level.symbols[node] - gone
            share = np.where(there, level.n[np.where(there, at, 0)] - 0.5, 0.5 * symbols)
            some = known & (there | (symbols > 0))  # else all that the node has is excluded
            out[open_[some]] += np.log10(share[some] / total[some])
            gone, gone_n = np.where(known, level.symbols[node], 0), np.where(known, level.below[node], 0)
        open_, gone, gone_n = open_[~there], gone[~there], gone_n[~there]
    out[open_] -= np.log10(SIGNS - gone)
    return out


def _evaluate(order: int, low: list[Level]):
    """The costs of the runs whose contexts end in the same two bytes."""

    def run(group: pa.Table) -> pa.Table:
        keys, n = group.column("key").to_numpy().view(np.uint64), group.column("n").to_numpy()
        sort = np.argsort(keys)
        keys, n = keys[sort], n[sort]
        levels = [Level(keys[n > 0], n[n > 0])]
        for k in range(order, 2, -1):
            levels.insert(0, levels[0].shorter(k))
        levels = low + levels
        for k in range(2, order + 1):
            levels[k].over(levels[k - 1], k)
        return pa.table({"key": keys.view(np.int64), "n": n, "cost": costs(keys, levels)})

    return run


def _low(seen: DataFrame) -> list[Level]:
    """The levels of no and of one byte of context, from the distinct runs of two: at most 65,536 rows."""
    pairs = seen.select(F.col("key").bitwiseAND(0xFFFFFF).alias("key")).distinct().groupBy(F.col("key").bitwiseAND(0xFFFF).alias("key")).agg(F.count("*").alias("n"))
    got = pairs.orderBy("key").toPandas()
    one = Level(got["key"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64))
    none = one.shorter(1)
    one.over(none, 1)
    return [none, one]


class Table:
    """Values by 64-bit key, found for whole arrays at once: open addressing at half full or less."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 1)
        self.keys, self.place = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        self.values = values
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.place[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.place[at], self.keys[at] = left[won], keys[left[won]]
            rest = np.ones(len(left), bool)
            rest[won] = False
            left, slot = left[rest], slot[rest] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, whether known); 0 where not."""
        slot = self._slot(keys)
        place = self.place[slot]
        unsure = np.flatnonzero((place >= 0) & (self.keys[slot] != keys))
        while len(unsure):
            slot[unsure] = slot[unsure] + 1 & (1 << self.bits) - 1
            place[unsure] = self.place[slot[unsure]]
            unsure = unsure[(place[unsure] >= 0) & (self.keys[slot[unsure]] != keys[unsure])]
        known = place >= 0
        return np.where(known, self.values[np.where(known, place, 0)], 0) if len(self.values) else np.zeros(len(keys)), known


def _lists(rows: np.ndarray, keys: np.ndarray, n_rows: int) -> list[pa.Array]:
    """For each row its distinct keys and how often it has each."""
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])]))
    n = np.diff(np.concatenate([first, [len(keys)]]))
    offsets = pa.array(np.searchsorted(rows[first], np.arange(n_rows + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(keys[first].view(np.int64))), pa.ListArray.from_arrays(offsets, pa.array(n.astype(np.int32)))]


_ROWS = "id {}, trains boolean, n_tokens bigint, n_known bigint, base double, score double, runs array<bigint>, run_n array<int>, words array<bigint>, word_n array<int>"


def _score(order: int, run_costs: tuple, word_counts: tuple, smooth: Callable[[np.ndarray], np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run, by_word = Table(*run_costs), Table(*word_counts)
        for batch in chunks(batches, 1000):
            n = batch.num_rows
            w = words(batch.column(2), NOT_SPACE)
            key, rows = runs(w, order)
            row = np.repeat(np.arange(n), np.diff(rows))
            cost, known = by_run.get(key)
            of = np.repeat(np.arange(n), np.diff(w.first))
            count, often = by_word.get(w.hash)
            base = np.bincount(of[often], smooth(count[often]), n)
            lists = _lists(row[~known], key[~known], n) + _lists(of[~often], w.hash[~often], n)
            numbers = (np.diff(w.first) + 1, np.bincount(of[often], minlength=n), base, np.bincount(row, cost, n))
            arrays = [batch.column(0), batch.column(1), *(pa.array(x.astype(kind)) for x, kind in zip(numbers, (np.int64, np.int64, float, float), strict=True)), *lists]
            yield pa.record_batch(arrays, [x.split()[0] for x in _ROWS.split(", ")])

    return run


def _heavy(counted: DataFrame, total: int, heavy: int, value: str) -> tuple[tuple[np.ndarray, np.ndarray], Column]:
    """Keys and values of those with a share of 1 / heavy of all, at most `heavy`, and what tells them."""
    often = F.col("n") * F.lit(heavy) >= F.lit(max(total, 1))
    got = counted.filter(often).select("key", F.col(value).cast("double").alias("value")).toPandas()
    return (got["key"].to_numpy(np.int64).view(np.uint64), got["value"].to_numpy(float)), often


def ppm_scores(docs: DataFrame, held_out: Column, *, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, heavy: int = HEAVY) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of each row of docs, the
    scores as log10 of the text's probability. Rows that aren't held out train. order: 2 to 7."""
    if not 2 <= order <= 7:
        raise ValueError("order must be 2 to 7")
    text = docs.select(F.col(id_col).alias("id"), (~F.coalesce(held_out, F.lit(False))).alias("trains"), F.col(text_col).cast("string").alias("text"))
    counted = text.select("trains", "text").mapInArrow(_count(order), "kind byte, key bigint, n bigint")
    counted = materialize(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "ppm-counts")
    run_counts, word_counts = (counted.filter(F.col("kind") == k).select("key", "n") for k in (_RUN, _WORD))
    sums = {r["kind"]: r for r in counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()}
    # every training row has one end sign
    ends = text.filter("trains").count()
    n_words, distinct = (sums[_WORD]["n"], sums[_WORD]["distinct"]) if _WORD in sums else (0, 0)
    tokens, vocabulary = n_words + ends, distinct + (ends > 0)
    whole = tokens + ALPHA * (vocabulary + 1)
    smooth = lambda n: np.log10((n + ALPHA) / whole)

    low = _low(run_counts.filter("n > 0"))
    nearest = F.shiftrightunsigned("key", 8).bitwiseAND(0xFFFF)
    priced = materialize(run_counts.groupBy(nearest.alias("near")).applyInArrow(_evaluate(order, low), "key bigint, n bigint, cost double"), "ppm-costs")
    heavy_runs, often_run = _heavy(priced, sums[_RUN]["n"] if _RUN in sums else 0, heavy, "cost")
    heavy_words, often_word = _heavy(word_counts, n_words, heavy, "n")

    scan = _score(order, heavy_runs, heavy_words, smooth)
    rows = text.mapInArrow(scan, _ROWS.format(docs.schema[id_col].dataType.simpleString()))
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "ppm-rows")
    each = lambda keys, n: rows.filter(F.size(keys) > 0).select("_row", F.explode(F.arrays_zip(F.col(keys).alias("key"), F.col(n).alias("times"))).alias("x")).select("_row", "x.key", "x.times")
    none = F.lit(0.0)
    of_runs = each("runs", "run_n").join(priced.filter(~often_run).select("key", "cost"), "key").select("_row", (F.col("cost") * F.col("times")).alias("score"), none.alias("base"), F.lit(0).cast("bigint").alias("known"))
    count = F.coalesce("n", F.lit(0))
    of_words = each("words", "word_n").join(word_counts.filter(~often_word), "key", "left")
    of_words = of_words.select("_row", none.alias("score"), (F.log10((count + ALPHA) / F.lit(whole)) * F.col("times")).alias("base"), F.when(count > 0, F.col("times")).otherwise(0).cast("bigint").alias("known"))
    rare = of_runs.unionByName(of_words).groupBy("_row").agg(F.sum("score").alias("_score"), F.sum("base").alias("_base"), F.sum("known").alias("_known"))
    own = rows.select("_row", "id", "trains", "n_tokens", "n_known", "base", "score").join(rare, "_row", "left")
    return own.select(
        F.col("id").alias(id_col),
        (~F.col("trains")).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", none) + float(np.log10((ends + ALPHA) / whole))).alias("base_score"),
        (F.col("score") + F.coalesce("_score", none)).alias("score"),
    )


def op11_ppm_score(spark, sf_dir: str) -> DataFrame:
    """All documents, by a model of those whose id's CRC isn't divisible by ten."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ppm_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
