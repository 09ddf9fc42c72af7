"""Token ids in seekable binary files: independent zstandard frames, a trailing seek table, and a
checksum for each frame, so readers decompress only the frames of the documents they want.

A file holds the ids of documents in ascending order as little-endian unsigned 32-bit integers.
Frames hold whole documents, about FRAME_BYTES each. The frame after them is the index (a row of
doc_id, number of ids, frame, offset in the frame, all signed 64-bit; first the number of ids
before the file). Last comes the seek table of the Zstandard Seekable Format, a skippable frame:
compressed size, size and checksum (low 32 bits of xxHash64 of the contents) of each frame.

Rows are dealt to tasks by ranges of doc_id, and a task begins another file after FILE_BYTES, so
one file's documents precede the next one's; the ids before a file come from the files' totals,
summed in two levels. Readers take the files that the write names, so that what a lost or repeated
attempt left behind isn't read. A reader of all documents gets a file as one row, so an executor
must hold a few times FILE_BYTES.

Defined cases: a null text is empty and has only the end id; null doc_ids come first, as the
order of Spark has them; equal doc_ids keep an order by a hash of
their text, by which they may lie in several files. An empty table gives no rows.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import itertools
import json
import os
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strainflow.llm.common import materialize, new_folder, parts_for, table, text_or_empty, total_bytes
from strainflow.llm.files import check_folder, only, whole_file
from strainflow.llm.words import chunks

END_ID = 1
FRAME_BYTES = 256 << 10
#: Text that a task encodes, and compressed bytes after which it begins another file.
TASK_TEXT_BYTES, FILE_BYTES = 24 << 20, 128 << 20
#: Distinct chunks, and pieces of them, whose ids a worker process remembers.
CACHE = 150_000
#: Files whose totals are summed by one task of the second level.
FILES_PER_GROUP = 1000
#: More files than this aren't broadcast.
BROADCAST_FILES = 100_000
#: Fixed by the Zstandard Seekable Format.
SKIPPABLE, SEEKABLE, HAS_CHECKSUM = 0x184D2A5E, 0x8F92EAB1, 1 << 7
_NULL = -(1 << 63)


#: Printable ASCII and the letters of Latin-1: NFC leaves them, and their classes are known.
_LATIN = "[!-~À-ÖØ-öø-ÿ]+"
_LETTERS = "a-zß-öø-ÿ"


class Encoder:
    """Texts to ids with the tokenizers library. The vocabulary drops white space and never looks
    across it, so a text is the sum of its chunks between white space, and a chunk of ASCII and Latin-1
    letters the sum of the matches of the vocabulary's own pattern, which the library's model takes as
    they are. Each distinct one is encoded once while it is in a cache, on which no result depends.
    Texts with an added token's characters are encoded whole."""

    def __init__(self, path: str, cache: int = CACHE):
        # tasks are the parallelism; the library's threads would only wait for each other
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.most = cache
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.pattern = piece_pattern(self.tokenizer)
        self.symbols = latin_symbols() if self.pattern else {}
        added = (x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.odd = "|".join(map(re.escape, added)) or "$^"

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_chunks(self, new: list[str]) -> None:
        for k in range(0, len(new), 10_000):
            some = new[k : k + 10_000]
            self.chunks.update(zip(some, self.whole(some), strict=True))

    def _learn_pieces(self, new: list[str]) -> None:
        tokens, symbols = self.model.tokenize, self.symbols
        for piece in new:
            self.pieces[piece] = b"" if piece == "\n" else array("I", [t.id for t in tokens(piece if piece.isascii() else piece.translate(symbols))]).tobytes()

    def _trim(self, cache: dict[str, bytes]) -> None:
        """Forgets the older half of a full cache."""
        if len(cache) > self.most:
            for key in list(itertools.islice(cache, len(cache) - self.most // 2)):
                del cache[key]

    def _recall(self, cache: dict[str, bytes], names: list[str], learn) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all names in one array, and how many each has."""
        self._trim(cache)
        learn([x for x in names if x not in cache])
        known = list(map(cache.__getitem__, names))
        return np.frombuffer(b"".join(known), "<u4"), np.fromiter(map(len, known), np.int64, len(known)) // 4

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of distinct chunks in some order, and the place of each one's first and its number."""
        latin = pc.match_substring_regex(words, f"^{_LATIN}$").to_numpy(zero_copy_only=False) if self.pattern else np.zeros(len(words), bool)
        starts, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        others, plain = np.flatnonzero(~latin), np.flatnonzero(latin)
        ids, n = self._recall(self.chunks, words.take(pa.array(others)).to_pylist(), self._learn_chunks)
        starts[others], sizes[others] = np.cumsum(n) - n, n
        if not len(plain):
            return ids, starts, sizes
        # one list of pieces for all chunks, with a line end after each
        flat = self.pattern.findall("\n".join([*words.take(pa.array(plain)).to_pylist(), ""]).lower())
        coded = pa.array(flat, pa.string()).dictionary_encode()
        names, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        values, n = self._recall(self.pieces, names, self._learn_pieces)
        values, ends = gathered(values, n, at)
        stops = ends[at == names.index("\n")]
        starts[plain], sizes[plain] = len(ids) + np.concatenate([[0], stops[:-1]]), np.diff(stops, prepend=0)
        return np.concatenate([ids, values]), starts, sizes

    def __call__(self, texts: pa.Array, end: int | None = None) -> pa.Array:
        """Binary ids of each text, and the end id."""
        odd = np.flatnonzero(pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False))
        whole = dict(zip(odd.tolist(), self.whole(texts.take(pa.array(odd)).to_pylist()) if len(odd) else [], strict=True))
        parted = pc.ascii_split_whitespace(pc.if_else(pc.match_substring_regex(texts, self.odd), "", texts) if len(odd) else texts)
        coded = parted.flatten().dictionary_encode()
        values, starts, sizes = self._ids(coded.dictionary)
        ids, ends = gathered(values, sizes, coded.indices.to_numpy(zero_copy_only=False), starts)
        stops = np.concatenate([[0], ends])[parted.offsets.to_numpy()[1:] - parted.offsets[0].as_py()].astype(np.int64)
        if end is not None:
            stops = stops + np.arange(1, len(stops) + 1)
            room = np.full(len(ids) + len(stops), end, "<u4")
            own = np.ones(len(room), bool)
            own[stops - 1] = False
            room[own] = ids
            ids = room
        out = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((4 * np.concatenate([[0], stops])).astype(np.int32)), pa.py_buffer(ids.astype("<u4", copy=False))])
        if not whole:
            return out
        tail = b"" if end is None else struct.pack("<I", end)
        return pa.array([whole[k] + tail if k in whole else x for k, x in enumerate(out.to_pylist())], pa.binary())


def gathered(values: np.ndarray, sizes: np.ndarray, at: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """values' pieces of these sizes in the order of `at`, and where each ends."""
    starts, n = np.cumsum(sizes) - sizes if starts is None else starts, sizes[at]
    ends = np.cumsum(n)
    # half the memory of 64-bit places: a batch has no 2 ** 31 ids
    places = np.repeat((starts[at] - (ends - n)).astype(np.int32), n)
    places += np.arange(len(places), dtype=np.int32)
    return values[places], ends


def piece_pattern(tokenizer) -> re.Pattern | None:
    """What parts a lower-cased chunk of ASCII and Latin-1 letters as the vocabulary does: its own
    pattern with these classes, if its steps are those that this knows."""
    from tokenizers.models import BPE

    steps, parts = (x and json.loads(x.__getstate__()) for x in (tokenizer.normalizer, tokenizer.pre_tokenizer))
    steps, parts = (x and (x.get("normalizers") or x.get("pretokenizers") or [x]) for x in (steps, parts))
    known = [x["type"] for x in steps or []] == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in parts or []] == ["Split", "ByteLevel"]
    if not known or not isinstance(tokenizer.model, BPE) or steps[1]["pattern"] != {"Regex": "\\s+"}:
        return None
    if parts[0]["behavior"] != "Removed" or not parts[0]["invert"] or parts[1]["use_regex"] or parts[1]["add_prefix_space"]:
        return None
    classes = parts[0]["pattern"]["Regex"].replace("\\p{L}", _LETTERS).replace("\\p{N}", "0-9")
    return None if "\\p" in classes else re.compile(classes + "|\n")


def latin_symbols() -> dict[int, str]:
    """The letters of Latin-1 as the library's byte level writes their bytes."""
    from tokenizers.pre_tokenizers import ByteLevel

    level = ByteLevel(add_prefix_space=False, use_regex=False)
    return {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100)}


def give_back() -> None:
    """Free memory that Arrow and the C library keep goes back to the system, where it can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for a worker process, whose tasks share its cache."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """(id_col, ids binary): little-endian ids of each text, and the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(path)
        for batch in chunks(batches, 4000, 4 << 20):
            yield pa.record_batch([batch.column(0), to_ids(batch.column(1), end_id)], [id_col, "ids"])
            give_back()

    kind = docs.select(id_col).dtypes[0][1]
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


class Writer:
    """One file of (doc_id, ids), written to a stream."""

    def __init__(self, stream):
        self.stream, self.packer = stream, zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.seek, self.index, self.held = [], [], []
        self.size = self.ids = self.written = 0

    def _frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.stream.write(packed)
        self.written += len(packed)
        self.seek.append(struct.pack("<III", len(packed), len(data), xxhash.xxh64(data).intdigest() & 0xFFFFFFFF))

    def add(self, id_: int | None, ids: bytes) -> None:
        self.index.append((_NULL if id_ is None else id_, len(ids) // 4, len(self.seek), self.size))
        self.held.append(ids)
        self.size += len(ids)
        self.ids += len(ids) // 4
        if self.size >= FRAME_BYTES:
            self._frame(b"".join(self.held))
            self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._frame(b"".join(self.held))
        self._frame(np.array(self.index, "<i8").reshape(-1, 4).tobytes())
        seek = b"".join(self.seek) + struct.pack("<IBI", len(self.seek), HAS_CHECKSUM, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(seek)) + seek)


def write_file(stream, rows: Iterator[tuple[int | None, bytes]]) -> int:
    """Writes one file of (doc_id, ids) and returns its number of ids."""
    writer = Writer(stream)
    for id_, ids in rows:
        writer.add(id_, ids)
    writer.close()
    return writer.ids


class Reader:
    """Random access to one file's bytes; read_at(offset, size) gives a range of them."""

    def __init__(self, read_at, size: int):
        self._read = read_at
        n, flags, magic = struct.unpack("<IBI", read_at(size - 9, 9))
        if magic != SEEKABLE or flags != HAS_CHECKSUM:
            raise ValueError("no seek table")
        entries = np.frombuffer(read_at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        if struct.unpack("<II", read_at(size - 17 - 12 * n, 8)) != (SKIPPABLE, 12 * n + 9):
            raise ValueError("a seek table that isn't a skippable frame")
        self.sizes, self.checks = entries[:, 0], entries[:, 2]
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.lengths = entries[:, 1]
        self.index = np.frombuffer(self.frame(n - 1), "<i8").reshape(-1, 4)

    def frame(self, k: int) -> bytes:
        data = zstandard.ZstdDecompressor().decompress(self._read(int(self.starts[k]), int(self.sizes[k])), max_output_size=max(1, int(self.lengths[k])))
        if xxhash.xxh64(data).intdigest() & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"frame {k} is damaged")
        return data

    def documents(self, wanted: set[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
        """(doc_id, ids) of the wanted documents, or all; other frames are not read."""
        at, data = -1, b""
        for id_, n, k, offset in self.index.tolist():
            if wanted is None or id_ in wanted:
                if k != at:
                    at, data = k, self.frame(k)
                yield (None if id_ == _NULL else id_), data[offset : offset + 4 * n]


def write(tokens: DataFrame, folder: str, id_col: str = "doc_id", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes tokens, whose partitions are ranges of id_col, as files of about file_bytes at most;
    (file, part, number, ids) of each, once its task has ended."""
    check_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        rows = (row for batch in batches for some in chunks([batch], 1000) for row in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True))
        row, number = next(rows, None), 0
        while row is not None:
            name = f"part-{part:06d}-{number:06d}-{attempt}.tokens.zst"
            with whole_file(folder, name) as stream:
                writer = Writer(stream)
                while row is not None and writer.written < file_bytes:
                    writer.add(*row)
                    row = next(rows, None)
                writer.close()
            yield pa.record_batch([pa.array([name]), pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([writer.ids], pa.int64())], ["file", "part", "number", "ids"])
            number += 1

    return tokens.select(F.col(id_col).cast("bigint"), "ids").mapInArrow(run, "file string, part int, number int, ids bigint")


def read(spark, folder: str, files: DataFrame | None = None) -> DataFrame:
    """(file, number, doc_id, ids binary): all documents of all files, or of those that `files`
    (of write()) names; number counts in a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                view = memoryview(data.as_buffer())
                reader, name = Reader(lambda a, n, view=view: bytes(view[a : a + n]), len(view)), path.rsplit("/", 1)[-1]
                held, number = [], 0
                for row in reader.documents():
                    held.append(row)
                    if len(held) == 500:
                        yield out(name, number, held)
                        number, held = number + len(held), []
                if held:
                    yield out(name, number, held)

    def out(name: str, number: int, rows: list) -> pa.RecordBatch:
        n = len(rows)
        return pa.record_batch([pa.array([name] * n), pa.array(range(number, number + n), pa.int64()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["file", "number", "doc_id", "ids"])

    found = only(spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens.zst").load(folder), files, BROADCAST_FILES)
    return found.select("path", "content").mapInArrow(run, "file string, number bigint, doc_id bigint, ids binary")


def starts(docs: DataFrame, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of read()'s rows; files are those of write()."""
    rows = docs.select("file", "number", "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    rows = materialize(rows, "token-rows")
    before = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    grouped = files.withColumn("group", F.floor(F.col("part") / FILES_PER_GROUP))
    # a row for each thousand parts
    groups = grouped.groupBy("group").agg(F.sum("ids").alias("ids")).select("group", before(Window.orderBy("group")).alias("_group"))
    offsets = grouped.withColumn("_file", before(Window.partitionBy("group").orderBy("part", "number"))).join(groups, "group")
    offsets = materialize(offsets.select("file", (F.col("_file") + F.col("_group")).alias("before")), "file-offsets")
    running = Window.partitionBy("file").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("_in", F.coalesce(F.sum("n_tokens").over(running), F.lit(0)))
    few = offsets.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES
    return within.join(F.broadcast(offsets) if few else offsets, "file").select("doc_id", (F.col("before") + F.col("_in")).alias("start"), "n_tokens", "ids_crc32")


def op10_token_frames(spark, sf_dir: str) -> DataFrame:
    """All documents encoded, written in ascending order, and read back."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    parts = parts_for(total_bytes(docs, F.col("text")), TASK_TEXT_BYTES)
    # the hash parts rows of one doc_id, or of none
    ordered = docs.repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    folder = new_folder(spark, "tokens")
    files = materialize(write(encode(ordered, public_tokenizers.path("word_bpe_49k.json")), folder), "token-files")
    return starts(read(spark, folder, files), files)
