"""Byte-level BPE: encoding and decoding with the ranks of a public vocabulary file.

encode() splits every text with the vocabulary's pattern (JVM), gathers the distinct words
of a block of documents, folds the ranked merges over each distinct word's byte array with
Spark's higher-order functions against a literal map from pairs of ids to the merged id, and
puts the ids back in the documents' order. All of it is narrow: no row is shuffled, a block
holds a bounded number of bytes, and nothing grows with the corpus. Words that a bounded sample
of the texts has often are folded first, once, and broadcast. decode() concatenates the
ids' byte pieces.

Defined cases: a null text is the empty text and has no ids; a null or repeated doc_id is
passed through, a row for each row; other columns are ignored; an empty table gives an empty
table. A single word of more than `max_fold_bytes` bytes (the fold copies its arrays at each
merge) is merged with a heap instead, by the same ranks and the same order of merges.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainflow.llm.common import bounded_batches, materialize, short_plans, table, text_or_empty, total_bytes

#: Bytes of words that a block of documents gathers before its distinct words are folded.
BLOCK_BYTES = 24 << 20
#: Frequent words, gathered from about SAMPLE_BYTES of text, that are folded once instead of once
#: a block. A cache: which words it holds changes no result.
HEAD_WORDS, SAMPLE_BYTES = 300_000, 48 << 20
#: Words to a row while they are folded.
WORDS_PER_ROW = 2000
MAX_FOLD_BYTES = 256
#: Rank of a pair that never merges.
NEVER = 1 << 18
_SHIFT = 17
#: White space as Unicode defines it; Java's \s is ASCII only.
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


#: The usual pattern of these vocabularies, and the same matches with the common cases first,
#: nothing to backtrack, and the contractions behind one quote.
_USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SAME = r" ?[a-zA-Z\p{L}]++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"


def java_pattern(pattern: str) -> str:
    """The vocabulary's pattern in Java's syntax, with white space spelt out."""
    pattern = _SAME if pattern == _USUAL else pattern
    return pattern.replace(r"[^\s", "[^" + _SPACE).replace(r"\S", f"[^{_SPACE}]").replace(r"\s", f"[{_SPACE}]")


@functools.lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pair_ids(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of ids whose pieces join to a piece, as first << 17 | second -> joined id.
    Ranks are the ids, so the least joined id is the next merge."""
    return {
        ranks[piece[:i]] << _SHIFT | ranks[piece[i:]]: rank
        for piece, rank in ranks.items()
        for i in range(1, len(piece))
        if piece[:i] in ranks and piece[i:] in ranks
    }


def two_choice_table(pairs: dict[int, int]) -> tuple[list[int], int, int]:
    """The pairs in one array that needs two looks: a pair is at pair % p or at p + pair % q.
    An entry is pair << 17 | joined id; -1 is empty."""

    def prime(n: int) -> int:
        return next(x for x in range(n | 1, 2 * n + 9, 2) if all(x % d for d in range(3, int(x**0.5) + 1, 2)))

    size = max(16, int(0.8 * len(pairs)))
    while True:
        p = prime(size)
        q = prime(p + 2)
        slots = [-1] * (p + q)
        for pair, joined in pairs.items():
            entry, at = pair << _SHIFT | joined, pair % p
            for _ in range(500):
                entry, slots[at] = slots[at], entry
                if entry < 0:
                    break
                other = entry >> _SHIFT
                at = p + other % q if at == other % p else other % p
            else:
                break
        else:
            return slots, p, q
        size = size * 5 // 4


class Vocabulary:
    """Ranks from a file in tiktoken's format; the path is the parameter."""

    def __init__(self, path: str):
        self.path = path
        ranks = load_ranks(path)
        self.byte_ids = bytes(ranks[bytes([i])] for i in range(256))
        slots, self.p, self.q = two_choice_table(pair_ids(ranks))
        self._slots = ",".join(map(str, slots))

    def _joined(self, slots: Column, pair: Column) -> Column:
        """The id that a pair of ids joins to, NEVER if none."""
        looks = F.array(F.get(slots, (pair % self.p).cast("int")), F.get(slots, (self.p + pair % self.q).cast("int")))
        hit = F.get(F.filter(looks, lambda x: F.shiftright(x, _SHIFT) == pair), F.lit(0))
        return F.coalesce(hit.bitwiseAND(F.lit((1 << _SHIFT) - 1).cast("bigint")), F.lit(NEVER).cast("bigint")).cast("int")

    def fold(self, words: Column) -> Column:
        """The ids of each word of an array; the literal table is bound once for all of them."""
        # a literal once constants are folded
        slots = F.split(F.lit(self._slots), ",").cast("array<bigint>")
        return F.get(F.transform(F.array(slots), lambda table: F.transform(words, lambda word: self._fold(table, word))), F.lit(0))

    def _fold(self, slots: Column, word: Column) -> Column:
        """The ids of a word, given as the ids of its bytes: a fold over as many steps as
        merges are possible. The state holds the parts and the ranks of neighbouring parts."""

        def pair(a: Column, b: Column) -> Column:
            return F.shiftleft(a.cast("bigint"), _SHIFT).bitwiseOR(b.cast("bigint"))

        def merge(state: Column, at: Column) -> Column:
            parts, ranks = state["parts"], state["ranks"]
            joined = F.get(ranks, at - 1)
            near = F.filter(
                F.array(
                    F.when(at > 1, pair(F.get(parts, at - 2), joined)),
                    F.when(at < F.size(ranks), pair(joined, F.get(parts, at + 1))),
                ),
                lambda x: x.isNotNull(),
            )
            return F.struct(
                F.flatten(F.array(F.slice(parts, F.lit(1), at - 1), F.array(joined), F.slice(parts, at + 2, F.size(parts)))).alias("parts"),
                F.flatten(
                    F.array(
                        F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))),
                        F.transform(near, lambda x: self._joined(slots, x)),
                        F.slice(ranks, at + 2, F.size(ranks)),
                    )
                ).alias("ranks"),
            )

        def step(state: Column, _: Column) -> Column:
            least = F.array_min(state["ranks"])
            at = F.array_position(state["ranks"], least).cast("int")
            return F.when(least < NEVER, F.get(F.transform(F.array(at), lambda at: merge(state, at)), F.lit(0))).otherwise(state)

        rest = F.slice(word, F.lit(2), F.size(word))
        ranks = F.transform(rest, lambda b, i: self._joined(slots, pair(F.get(word, i), b)))
        return F.aggregate(rest, F.struct(word.alias("parts"), ranks.alias("ranks")), step, lambda state: state["parts"])


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a very long word: least rank first, then leftmost."""
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop or ranks.get(word[i:stop]) != rank:
            continue
        alive[end[i]] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _blocks(byte_ids: bytes, max_fold: int, block_bytes: int, head=None):
    """Rows of a partition: for each block its distinct words as arrays of byte ids, in rows of
    WORDS_PER_ROW, then its documents as positions in that list (an Arrow stream). Words of the
    head (a broadcast of Arrow arrays: words and ids) come before the block's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            ids = pa.chunked_array([b.column(0) for b in held]).combine_chunks()
            lists = pa.chunked_array([b.column(1) for b in held]).combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                ids, lists = pa.concat_arrays(ids.chunks), pa.concat_arrays(lists.chunks)
            coded = lists.flatten().dictionary_encode()
            known = head.value[0] if head else pa.array([], pa.string())
            place = pc.index_in(coded.dictionary, value_set=known).fill_null(-1).to_numpy().astype(np.int32)
            own = np.flatnonzero(place < 0)
            long = pc.greater(pc.binary_length(coded.dictionary), max_fold).to_numpy(zero_copy_only=False)[own]
            own = np.concatenate([own[~long], own[long]])
            place[own] = len(known) + np.arange(len(own), dtype=np.int32)
            words = [w.encode() for w in coded.dictionary.take(pa.array(own)).to_pylist()]
            short, index = len(words) - int(long.sum()), pa.array(place[coded.indices.to_numpy(zero_copy_only=False)])
            del coded
            for part, fold in ((words[:short], True), (words[short:], False)):
                step = WORDS_PER_ROW if fold else 1
                for k in range(0, len(part), step):
                    some = part[k : k + step]
                    values = np.frombuffer(b"".join(some).translate(byte_ids), np.uint8).astype(np.int32)
                    ends = np.cumsum([0, *map(len, some)], dtype=np.int32)
                    inner = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                    yield pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner), pa.array([None], pa.binary()), pa.array([fold])], ["words", "docs", "fold"])
            counts = np.diff(lists.offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            for k in range(0, len(ids), 1000):
                stop = min(len(ids), k + 1000)
                docs = pa.record_batch([ids.slice(k, stop - k), pa.LargeListArray.from_arrays(pa.array(ends[k : stop + 1] - ends[k]), index.slice(ends[k], ends[stop] - ends[k]))], ["id", "at"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, docs.schema) as writer:
                    writer.write_batch(docs)
                yield pa.record_batch([pa.array([None], pa.list_(pa.list_(pa.int32()))), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([None], pa.bool_())], ["words", "docs", "fold"])

        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                held.append(some)
                size += some.nbytes
                if size >= block_bytes:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _assemble(path: str, byte_ids: bytes, head=None):
    """Puts the folded words' ids back in the order of each document's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        back = bytes(byte_ids.index(i) for i in range(256))
        words: list[pa.Array] = []
        values = starts = lengths = None
        for batch in batches:
            for row in range(batch.num_rows):
                if not batch.column(0)[row].is_valid:
                    if values is None:
                        whole = pa.concat_arrays(([head.value[1]] if head else []) + words) if words or head else pa.array([], pa.list_(pa.int32()))
                        values, ends = whole.flatten().to_numpy(), whole.offsets.to_numpy()
                        starts, lengths = (ends[:-1] - ends[0]).astype(np.int64), np.diff(ends).astype(np.int64)
                        words = []
                    with pa.ipc.open_stream(batch.column(1)[row].as_buffer()) as reader:
                        docs = reader.read_next_batch()
                    at = docs.column(1).flatten().to_numpy()
                    n = lengths[at]
                    ends = np.concatenate([[0], np.cumsum(n)])
                    take = np.arange(ends[-1]) + np.repeat(starts[at] - ends[:-1], n)
                    offsets = ends[docs.column(1).offsets.to_numpy()].astype(np.int32)
                    yield pa.record_batch([docs.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[take].astype(np.int32)))], ["id", "ids"])
                    continue
                if values is not None:
                    values = None
                got = batch.column(0).slice(row, 1).flatten()
                if not batch.column(2)[row].as_py():
                    long = bytes(got.flatten().to_numpy().astype(np.uint8)).translate(back)
                    got = pa.array([heap_merge(long, load_ranks(path))], pa.list_(pa.int32()))
                words.append(got)

    return run


def _head(split: DataFrame, vocabulary: Vocabulary, max_fold: int, most: int):
    """Frequent words and their ids, folded once: a broadcast of at most `most` short words."""
    if not most:
        return None
    spark = split.sparkSession
    share = max(1, total_bytes(split, F.col("text")) // SAMPLE_BYTES)
    words = split.filter(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).select(F.explode("found").alias("word")).filter(F.octet_length("word") <= max_fold)
    often = words.groupBy("word").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "word").limit(most).select("word")
    byte_ids = vocabulary.byte_ids

    def as_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = [w.encode() for w in batch.column(0).to_pylist()]
            ends = np.cumsum([0, *map(len, some)], dtype=np.int32)
            inner = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(some).translate(byte_ids), np.uint8).astype(np.int32)))
            yield pa.record_batch([batch.column(0), inner], ["word", "bytes"])

    dealt = often.repartition(spark.sparkContext.defaultParallelism, "word").mapInArrow(as_ids, "word string, bytes array<int>")
    got = materialize(dealt.select("word", F.get(vocabulary.fold(F.array("bytes")), F.lit(0)).alias("ids")), "head").toArrow().combine_chunks()
    if not got.num_rows:
        return None
    word, ids = got.column("word").combine_chunks(), got.column("ids").combine_chunks()
    if isinstance(word, pa.ChunkedArray):
        word, ids = pa.concat_arrays(word.chunks), pa.concat_arrays(ids.chunks)
    return spark.sparkContext.broadcast((word, ids.cast(pa.list_(pa.int32()))))


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", max_fold_bytes: int = MAX_FOLD_BYTES, block_bytes: int = BLOCK_BYTES, head_words: int = HEAD_WORDS, after=None) -> DataFrame:
    """(id_col, ids array<int>): a row for each row of docs, ids as the tiktoken library gives
    them for the pattern and ranks, without special tokens.

    `after` is a function over Arrow batches (id, ids) and the columns that it makes of ids; it
    runs in the worker that puts the ids together, so that they need not pass another one."""
    bounded_batches(docs.sparkSession)
    short_plans(docs.sparkSession)
    text = text_or_empty(text_col)
    split = docs.select(F.col(id_col).alias("id"), F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0)).alias("found"), text.alias("text"))
    head = _head(split, vocabulary, max_fold_bytes, head_words)
    blocks = split.select("id", "found").mapInArrow(_blocks(vocabulary.byte_ids, max_fold_bytes, block_bytes, head), "words array<array<int>>, docs binary, fold boolean")
    folded = blocks.select(F.when(F.col("fold"), vocabulary.fold(F.col("words"))).otherwise(F.col("words")).alias("words"), "docs", "fold")
    kind = docs.schema[id_col].dataType
    finish, columns = after or (lambda batches: batches, "ids array<int>")
    assemble = _assemble(vocabulary.path, vocabulary.byte_ids, head)
    out = T.StructType([T.StructField("id", kind), *T._parse_datatype_string(columns).fields])
    return folded.mapInArrow(lambda batches: finish(assemble(batches)), out).withColumnRenamed("id", id_col)


def _pieces(path: str) -> pa.Array:
    ranks = load_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pa.array(pieces, pa.large_binary())


def _joined(ids: pa.ListArray, pieces: pa.Array) -> Iterator[bytes]:
    """The pieces of each row's ids, concatenated."""
    joined = pieces.take(ids.flatten())
    ends, data = np.frombuffer(joined.buffers()[1], np.int64)[: len(joined) + 1], joined.buffers()[2]
    cut = ends[ids.offsets.to_numpy() - ids.offsets[0].as_py()].tolist()
    data = memoryview(data) if data else memoryview(b"")
    return (data[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True))


def decode(tokens: DataFrame, vocabulary: Vocabulary, *, ids_col: str = "ids") -> DataFrame:
    """tokens with a column `decoded` (binary): each row's pieces, concatenated."""
    path, at = vocabulary.path, tokens.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                yield pa.record_batch([*some.columns, pa.array(_joined(some.column(at), pieces), pa.binary())], [*some.schema.names, "decoded"])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digests(path: str):
    """For encode()'s `after`: the number of ids, and digests of the ids as little-endian unsigned
    32-bit integers and of what they decode to, so that neither travels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            ids = batch.column(1)
            raw = memoryview(ids.flatten().to_numpy().astype("<u4")).cast("B")
            cut = (4 * (ids.offsets.to_numpy() - ids.offsets[0].as_py())).tolist()
            sums = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]
            texts = [hashlib.sha256(x).hexdigest() for x in _joined(ids, pieces)]
            yield pa.record_batch([batch.column(0), ids.value_lengths().cast(pa.int64()), pa.array(sums, pa.string()), pa.array(texts, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def ids_and_digest(path: str):
    """For encode()'s `after`: the number of ids, the ids, and a digest of what they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                ids = some.column(1)
                texts = [hashlib.sha256(x).hexdigest() for x in _joined(ids, pieces)]
                yield pa.record_batch([some.column(0), ids.value_lengths().cast(pa.int64()), ids, pa.array(texts, pa.string())], ["id", "n_tokens", "ids", "decoded_sha256"])

    return run


IDS_AND_DIGEST = "n_tokens bigint, ids array<int>, decoded_sha256 string"
DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded; a row for each."""
    import public_tokenizers

    vocabulary = Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN, after=(digests(vocabulary.path), DIGESTS))
