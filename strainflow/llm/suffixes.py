"""Suffix-array dedup: removes every byte covered by a 50-byte string that also starts in a
document of smaller doc_id.

Candidates. In each window of 50 bytes one of its 16-byte grams has the least hash: its anchor.
Equal windows have the same anchor at the same place, so only runs of windows around equal anchors
can be equal. A scan packs for each run the anchor's hash, a hash of the run's bytes and its place
(about one run for 18 bytes), and deals them by anchor. Equal runs are reduced to the one of least
doc_id there, which covers the others whole: groups of copies end here. Of anchors with several
different runs of different doc_ids, the bytes are fetched and dealt by the anchor and the bytes on one side of it, left
for windows that reach far left and right for the others, so no anchor is a single group. Parts
of runs of which all but a few bytes of a window are another doc_id's run's too go on, but for those that
equal a part of smaller doc_id, which covers them whole.

Suffix arrays. These parts are concatenated in blocks, the anchor with the bytes on its side, which all
windows dealt by them hold, being one symbol for all parts that have these bytes, and sorted by linear
grouping construction (Baier 2016): suffixes are grouped by their Lyndon prefixes, groups in
descending order split the groups of their previous-smaller suffixes, and then each group's order is
emitted from the next smaller suffix, without recursive renaming. Suffixes that agree on a window's
symbols are neighbours, and the least doc_id among them decides.

All shuffles carry packed arrays by bucket: texts by a hash of doc_id, runs by a hash of the anchor.
Tasks take bucket after bucket from sorted partitions. A bucket holds a bounded number of bytes or
runs, but for the copies of one run (15 bytes each, of which a scan's bucket has one for a
document), and for different runs that share an anchor and the bytes on a side of it.

Defined cases: matches are between rows of different doc_id, so equal doc_ids (repeated rows) never
remove from each other; a null doc_id counts as greater than all; null and empty texts, and texts
below 50 bytes, are kept whole. Runs are compared by 40 bits of the anchor's and 40 bits of the
run's hash within a bucket. Other columns are ignored. An empty table gives none.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainflow.llm.common import bounded_batches, materialize, parts_for, table, text_or_empty, total_bytes
from strainflow.llm.words import _BYTE, _INVERSE, BASE, mix, span_hashes

WINDOW, GRAM = 50, 16
_RUN = WINDOW - GRAM + 1  # grams in a window, windows around a gram
_AROUND = WINDOW - GRAM  # bytes of a window besides its gram
#: Windows by how many bytes they reach left of the anchor, this many lengths to a class; classes
#: below _RIGHT are dealt by what is right of the anchor, the others by what is left of it.
_CLASS, _RIGHT = 2, 8
#: Bytes of a bucket of texts; runs of a bucket when equal ones are reduced, and when bytes are compared.
TEXT_BUCKET, RUN_BUCKET, PART_BUCKET = 8 << 20, 600_000, 300_000
#: Bytes of runs that are fetched at once; their hashes take 32 times as much.
SLICE = 4 << 20
#: Symbols of one suffix array.
BLOCK_SYMBOLS = 150_000
_LAST = (1 << 63) - 1
#: Low bits of a gram's hash that give way to its place.
_PLACE = np.uint64((1 << 31) - 1)


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes of text in order, by linear grouping construction; symbols are not negative."""
    text = [*text, -1]
    n = len(text)
    symbols = {c: k for k, c in enumerate(sorted(set(text)))}
    group = [symbols[c] for c in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [len(m) for m in members]
    below, above = [k - 1 for k in range(len(size))], [*range(1, len(size)), -1]
    smaller, done = [-1] * n, bytearray(n)
    now = len(size) - 1
    while now >= 0:
        counts: dict[int, int] = {}
        # members ascend: previous smaller suffixes of a group's members ascend as these do
        for i in members[now]:
            if group[i] != now:
                continue
            j = i - 1
            while j >= 0 and done[j]:
                j = smaller[j]
            smaller[i] = j
            done[i] = 1
            if j >= 0:
                counts[j] = counts.get(j, 0) + 1
        members[now] = []
        if counts:
            # by how often, in lists that the counts bound, so that nothing is sorted
            split: list[dict[int, list[int]]] = [{} for _ in range(max(counts.values()) + 1)]
            for j, c in counts.items():
                split[c].setdefault(group[j], []).append(j)
            for layer in reversed(split):
                for g, part in layer.items():
                    if len(part) == size[g]:
                        continue
                    new = len(size)
                    for j in part:
                        group[j] = new
                    members.append(part)
                    size.append(len(part))
                    size[g] -= len(part)
                    below.append(g)
                    above.append(above[g])
                    if above[g] >= 0:
                        below[above[g]] = new
                    above[g] = new
        now = below[now]
    start, at, g = [0] * len(size), 0, group[n - 1]
    while g >= 0:
        start[g] = at
        at += size[g]
        g = above[g]
    out, placed = [0] * n, bytearray(n)
    out[0], placed[n - 1] = n - 1, 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            placed[j] = 1
            g = group[j]
            out[start[g]] = j
            start[g] += 1
            j = smaller[j]
    return out[1:]


def _powers(values: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of `width` values, by doubling."""
    out, have, now, size = None, 0, values, 1
    while True:
        if width & size:
            if out is None:
                out, have = now, size
            else:
                n = max(0, min(len(out), len(now) - have))
                out = out[:n] * np.uint64(pow(BASE, size, 2**64)) + now[have : have + n]
                have += size
        if 2 * size > width:
            return out
        n = max(0, len(now) - size)
        now = now[:n] * np.uint64(pow(BASE, size, 2**64)) + now[size : size + n]
        size *= 2


def _least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[: len(values) - size], values[size:])
        size *= 2
    more = width - size
    return np.minimum(values[: len(values) - more], values[more:]) if more else values


def runs(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of one text: anchor hash, hash of the run's bytes, first window, bytes, anchor's place in
    the run; for each run of windows with the same anchor."""
    grams = mix(_powers(_BYTE[data], GRAM))
    # the leftmost place breaks ties of equal grams
    place = np.arange(len(grams), dtype=np.uint64)
    where = (_least((grams & ~_PLACE) | place, _RUN) & _PLACE).astype(np.int64)
    cut = np.flatnonzero(where[1:] != where[:-1]) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(where)]]) - 1
    at = where[first]
    return grams[at], span_hashes(data, first, last + WINDOW), first, last - first + WINDOW, at - first


def _bytes5(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])


def _from5(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(x, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


_PACKED = "bucket int, ids binary, ends binary, data binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each bucket of texts: ids, ends, and the compressed bytes."""
    held: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for bucket, id_, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            held.setdefault(bucket, []).append((id_, text.encode()))
    packer = zstandard.ZstdCompressor(level=3)
    for bucket in sorted(held):
        rows = sorted(held.pop(bucket))
        ids, ends = np.array([r[0] for r in rows], np.int64), np.cumsum([len(r[1]) for r in rows], dtype=np.int64)
        yield pa.record_batch([pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), ends.tobytes(), packer.compress(b"".join(r[1] for r in rows))))], ["bucket", "ids", "ends", "data"])


def _unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, ends = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["ends"], np.int64)
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, int(ends[-1])))
    return ids, np.concatenate([[0], ends]), np.frombuffer(data, np.uint8)


def _grouped(rows: Iterator[dict], name: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that follow each other and agree on a column."""
    for key, some in itertools.groupby(rows, key=operator.itemgetter(name)):
        yield key, list(some)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}


def _deal(buckets: int):
    """Packed texts to packed runs by bucket of the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for row in _rows(batches):
            ids, ends, data = _unpack(row)
            parts = []
            for d in range(len(ids)):
                if ends[d + 1] - ends[d] >= WINDOW:
                    anchor, content, first, size, at = runs(data[ends[d] : ends[d + 1]])
                    parts.append((anchor, content, (first + ends[d]).astype(np.uint32), size.astype(np.uint8), at.astype(np.uint8), np.full(len(first), d, np.int32)))
            if not parts:
                continue
            anchor, content, first, size, at, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
            anchor = mix(anchor)  # the least of many hashes is small
            bucket = ((anchor >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            anchor, content, first, size, at, doc, bucket = (x[order] for x in (anchor, content, first, size, at, doc, bucket))
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cut)):
                s = slice(cut[b], cut[b + 1])
                known, which = np.unique(doc[s], return_inverse=True)
                packed = [_bytes5(anchor[s]).tobytes(), _bytes5(content[s]).tobytes(), first[s].tobytes(), size[s].tobytes(), at[s].tobytes(), packer.compress(which.astype(np.int32).tobytes()), ids[known].tobytes()]
                yield pa.record_batch([pa.array([int(b)], pa.int32()), pa.array([row["bucket"]], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], ["anchors", "bucket", "anchor", "content", "first", "size", "at", "doc", "ids"])

    return run


_DEALT = "anchors int, bucket int, anchor binary, content binary, first binary, size binary, at binary, doc binary, ids binary"
_FOUND = "bucket int, kind int, anchors int, first binary, size binary, at binary, anchor binary, id binary"


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs covered whole (kind 0), and runs whose bytes must be compared (kind 1), by the
    bucket of their text."""
    for anchors, rows in _grouped(_rows(batches), "anchors"):
        anchor, content = (np.concatenate([_from5(r[x]) for r in rows]) for x in ("anchor", "content"))
        first = np.concatenate([np.frombuffer(r["first"], np.uint32) for r in rows])
        size, at = (np.concatenate([np.frombuffer(r[x], np.uint8) for r in rows]) for x in ("size", "at"))
        id_ = np.concatenate([np.frombuffer(r["ids"], np.int64)[np.frombuffer(zstandard.ZstdDecompressor().decompress(r["doc"]), np.int32)] for r in rows])
        bucket = np.repeat([r["bucket"] for r in rows], [len(r["first"]) // 4 for r in rows])
        order = np.lexsort((id_, content, anchor))
        anchor, content, first, size, at, id_, bucket = (x[order] for x in (anchor, content, first, size, at, id_, bucket))
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        other = new.copy()
        other[1:] |= content[1:] != content[:-1]
        least = id_[np.flatnonzero(other)][np.cumsum(other) - 1]
        group = np.cumsum(new) - 1
        # where all different runs are first in one row, nothing is left to remove
        heads = np.flatnonzero(new)
        several = (np.minimum.reduceat(least, heads) < np.maximum.reduceat(least, heads))[group]
        for kind, mark in ((0, id_ > least), (1, several & (id_ == least))):
            mine = np.flatnonzero(mark)
            mine = mine[np.argsort(bucket[mine], kind="stable")]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket[mine])) + 1, [len(mine)]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if a < b:
                    m = mine[a:b]
                    packed = [first[m].tobytes(), size[m].astype(np.uint32).tobytes()] + ([at[m].tobytes(), _bytes5(anchor[m]).tobytes(), id_[m].tobytes()] if kind else [None] * 3)
                    yield pa.record_batch([pa.array([int(bucket[m[0]])], pa.int32()), pa.array([kind], pa.int32()), pa.array([anchors], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)], ["bucket", "kind", "anchors", "first", "size", "at", "anchor", "id"])


_ASKED = "anchors int, bucket int, first binary, size binary, at binary, side binary, code binary, id binary, bytes binary"


class Spans:
    """Hashes of spans of some bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        power, back = np.full(n, BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        power[0] = back[0] = 1
        np.cumprod(power, out=power)
        np.cumprod(back, out=back)
        self.total, self.back = np.zeros(n, np.uint64), back
        np.cumsum(_BYTE[data] * power[:-1], out=self.total[1:])

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.back[start])


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]


def _asks(asked: list[dict]) -> Iterator[tuple[np.ndarray, ...]]:
    """first, size, at, id and anchor of what is asked of a text bucket, in slices of about SLICE bytes
    of runs: however many buckets of anchors there are, no slice is made of a few runs."""
    kinds = (("first", np.uint32), ("size", np.uint32), ("at", np.uint8), ("id", np.int64))
    first, size, at, id_ = (np.frombuffer(b"".join([ask[x] for ask in asked]), kind).astype(np.int64) for x, kind in kinds)
    anchor = _from5(b"".join([ask["anchor"] for ask in asked]))
    total = np.cumsum(size)
    cuts = np.searchsorted(total, np.arange(SLICE, total[-1], SLICE)) if len(total) else []
    edges = np.unique(np.concatenate([[0], cuts, [len(total)]]).astype(np.int64))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield first[a:b], size[a:b], at[a:b], id_[a:b], anchor[a:b]


def _fetch(buckets: int):
    """Packed texts with what is asked of them, to the asked runs' bytes: those of windows that
    reach far left of the anchor, dealt by the bytes left of it, and those of the others. A text
    bucket's slice sends a row to a bucket, whichever buckets of anchors asked."""
    left, right = _CLASS * _RIGHT, _AROUND - _CLASS * _RIGHT + 1  # bytes that all windows of a side reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            _, _, data = _unpack(row)
            for first, size, at, id_, anchor in _asks(row["asked"]):
                own = _gather(data, first, size)
                start, hashes = np.cumsum(size) - size, Spans(own)
                out = []
                for side, fits, lo, hi, a, b in (
                    (0, at + GRAM + right <= size, np.maximum(0, at - left + 1), size, at + GRAM, at + GRAM + right),
                    (1, at >= left, np.zeros_like(at), np.minimum(size, at + GRAM + _AROUND - left), at - left, at),
                ):
                    k = np.flatnonzero(fits & (hi - lo >= WINDOW))
                    code = mix(anchor[k] * np.uint64(BASE) + hashes((start + a)[k], (start + b)[k]) + np.uint64(side))
                    out.append((code, (first + lo)[k], (hi - lo)[k], (at - lo)[k], np.full(len(k), side), id_[k], (start + lo)[k]))
                code, where, n, at, side, id_, begin = (np.concatenate(x) for x in zip(*out, strict=True))
                bucket = ((code >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for c in np.flatnonzero(np.diff(edges)):
                    m = order[edges[c] : edges[c + 1]]
                    packed = [where[m].astype(np.uint32), n[m].astype(np.uint8), at[m].astype(np.uint8), side[m].astype(np.uint8), code[m], id_[m], _gather(own, begin[m], n[m])]
                    yield pa.record_batch([pa.array([int(c)], pa.int32()), pa.array([row["bucket"]], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], ["anchors", "bucket", "first", "size", "at", "side", "code", "id", "bytes"])

    return run


def shared_windows(symbols: list[int], starts: np.ndarray, stops: np.ndarray, ids: np.ndarray, width: int = _RUN) -> tuple[np.ndarray, np.ndarray]:
    """Positions of windows of width symbols that a piece of smaller id has too. Pieces are
    symbols[start:stop]."""
    text = np.array(symbols, np.int64)
    order = np.array(suffix_array(symbols), np.int64)
    piece = np.searchsorted(starts, order, side="right") - 1
    good = order + width <= stops[piece]
    order, piece = order[good], piece[good]
    if not len(order):
        return order, piece
    same = np.arange(len(order) - 1)
    for k in range(width):
        same = same[text[order[same] + k] == text[order[same + 1] + k]]
    new = np.ones(len(order), bool)
    new[same + 1] = False
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[piece], heads)[np.cumsum(new) - 1]
    hit = least < ids[piece]
    return order[hit], piece[hit]


def _several(code: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which codes occur with more than one id."""
    order = np.lexsort((ids, code))
    code, ids = code[order], ids[order]
    heads = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])[: len(code)])
    size = np.diff(np.concatenate([heads, [len(code)]]))
    out = np.zeros(len(code), bool)
    out[order] = np.repeat(ids[heads] != ids[heads + size - 1], size)
    return out


def _parts(code, size, at, side, start, ids, hashes: Spans) -> list[np.ndarray]:
    """Of runs dealt by their code: parts (run, begin, end in it) with windows of which all but
    _CLASS - 1 bytes at the ends are a run's of another doc_id too."""
    count = -(-(_AROUND + 1) // _CLASS)
    kept = np.zeros((count + 1, len(code)), bool)
    for j in range(count):
        l, r = j * _CLASS, max(0, _AROUND - j * _CLASS - _CLASS + 1)
        fits = np.flatnonzero((side == (j >= _RIGHT)) & (at >= l) & (size - at - GRAM >= r))
        p = (start + at)[fits]
        kept[j, fits] = _several(mix(code[fits] * np.uint64(BASE) + hashes(p - l, p)) * np.uint64(BASE) + hashes(p + GRAM, p + GRAM + r), ids[fits])
    out = []
    for a in range(count):
        begins = kept[a] & ~kept[a - 1]  # kept[-1] is all False
        for b in range(a, count):
            run = np.flatnonzero(begins & kept[a : b + 1].all(axis=0) & ~kept[b + 1])
            lo, hi = np.maximum(0, at[run] - b * _CLASS - _CLASS + 1), np.minimum(size[run], at[run] + GRAM + _AROUND - a * _CLASS)
            out.append(np.stack([run, lo, hi]))
    found = np.concatenate(out, axis=1)
    return list(found[:, found[2] - found[1] >= WINDOW])


def _repeated(keys: list[np.ndarray], ids: np.ndarray, begin: np.ndarray, size: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Which parts data[begin:begin + size] are, byte by byte, one of smaller id with the same keys."""
    order = np.lexsort((ids, *keys))
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = ids[order] > ids[first]
    order, first = order[later], first[later]
    n = size[order]
    other = _gather(data, begin[order], n) != _gather(data, begin[first], n)
    out = np.zeros(len(ids), bool)
    out[order[np.add.reduceat(other, np.cumsum(n) - n, dtype=np.int64) == 0] if len(order) else order] = True
    return out


def _core(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far left of the anchor what all windows of a side hold begins, and its bytes."""
    left, right = _CLASS * _RIGHT, _AROUND - _CLASS * _RIGHT + 1
    return np.where(side == 1, left, 0), GRAM + np.where(side == 1, left, right)


def _marked(code: np.ndarray, side: np.ndarray, which: np.ndarray, anchor: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """which in the order of side, code and the bytes that all windows hold, byte by byte, and where
    these differ from those before. anchor: where it is in data."""
    before, core = _core(side)
    words = np.zeros((len(which), -(-WINDOW // 8) * 8), np.uint8)
    place = np.arange(words.shape[1])
    held = place < core[:, None]
    words[held] = data[((anchor - before)[:, None] + place)[held]]
    keys = [*words.view(np.uint64).T, code, side]
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    return which[order], new


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that share an anchor and the bytes on a side of it: what is covered in each (kind 0)."""
    for _, rows in _grouped(_rows(batches), "anchors"):
        code, id_ = (np.concatenate([np.frombuffer(r[x], kind) for r in rows]) for x, kind in (("code", np.uint64), ("id", np.int64)))
        first, size, at, side = (np.concatenate([np.frombuffer(r[x], kind) for r in rows]).astype(np.int64) for x, kind in (("first", np.uint32), ("size", np.uint8), ("at", np.uint8), ("side", np.uint8)))
        bucket = np.repeat([r["bucket"] for r in rows], [len(r["first"]) // 4 for r in rows])
        data = np.concatenate([np.frombuffer(r["bytes"], np.uint8) for r in rows])
        start = np.cumsum(size) - size
        some = np.flatnonzero(_several(code, id_))
        hashes = Spans(data)
        run, lo, hi = _parts(*(x[some] for x in (code, size, at, side, start, id_)), hashes)
        if not len(run):
            continue
        run = some[run]
        begin = start[run] + lo
        whole = _repeated([code[run], at[run] - lo, hi - lo, hashes(begin, begin + hi - lo)], id_[run], begin, hi - lo, data)
        # all windows of a part that is one of smaller doc_id are covered
        n = (hi - lo)[whole] - WINDOW + 1
        windows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found: list[list[np.ndarray]] = [[np.repeat(bucket[run[whole]], n)], [np.repeat((first[run] + lo)[whole], n) + windows]]
        order = np.flatnonzero(~whole)
        order, new = _marked(code[run[order]], side[run[order]], order, (start + at)[run[order]], data)
        run, lo, hi = run[order], lo[order], hi[order]
        mark = 257 + np.cumsum(new)
        # a part is its bytes with what all its windows hold as one symbol, and an end
        before, core = _core(side[run])
        left, length = at[run] - before - lo, hi - lo - core + 2
        total = np.cumsum(length)
        heads = np.flatnonzero(new)
        cuts = [0]
        for h in [*heads[1:].tolist(), len(run)]:
            if h == len(run) or side[run[h]] != side[run[h - 1]] or total[h - 1] - (total[cuts[-1] - 1] if cuts[-1] else 0) >= BLOCK_SYMBOLS:
                cuts.append(h)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            n = length[a:b]
            starts = np.cumsum(n) - n
            pos, l, e = (np.arange(n.sum()) - np.repeat(starts, n)), np.repeat(left[a:b], n), np.repeat(n, n)
            take = np.repeat((start[run] + lo)[a:b], n) + pos + np.where(pos > l, core[a] - 1, 0)
            take[pos == e - 1] = 0
            symbols = np.where(pos == e - 1, 0, np.where(pos == l, np.repeat(mark[a:b], n), data[take].astype(np.int64) + 1))
            where, piece = shared_windows(symbols.tolist(), starts, starts + n - 1, id_[run[a:b]], WINDOW - int(core[a]) + 1)
            piece += a
            found[0].append(bucket[run[piece]])
            found[1].append((first[run] + lo)[piece] + where - (starts[piece - a]))
        text, place = (np.concatenate(x) for x in found)
        order = np.lexsort((place, text))
        text, place = text[order], place[order]
        # windows that begin one after the other are one span
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (place[1:] - place[:-1] > 1)
        begin = np.flatnonzero(new)
        stop = np.concatenate([begin[1:], [len(text)]]) - 1 if len(text) else begin
        text, begin, size = text[begin], place[begin], place[stop] - place[begin] + WINDOW
        edges = np.concatenate([[0], np.flatnonzero(np.diff(text)) + 1, [len(text)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if a < b:
                yield pa.record_batch([pa.array([int(text[a])], pa.int32()), pa.array([begin[a:b].astype(np.uint32).tobytes()], pa.binary()), pa.array([size[a:b].astype(np.uint32).tobytes()], pa.binary())], ["bucket", "first", "size"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed texts with their covered spans, to a row for each document."""
    for row in _rows(batches):
        ids, ends, data = _unpack(row)
        edge = np.zeros(len(data) + 1, np.int32)
        for spans in row["covered"] or ():
            first, size = np.frombuffer(spans["first"], np.uint32).astype(np.int64), np.frombuffer(spans["size"], np.uint32).astype(np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, first + size, -1)
        gone = np.cumsum(edge[:-1]) > 0
        for k in range(0, len(ids), 500):
            out = [[], [], [], []]
            for d in range(k, min(len(ids), k + 500)):
                a, b = int(ends[d]), int(ends[d + 1])
                mine = gone[a:b]
                bounds = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                out[0].append(None if ids[d] == _LAST else int(ids[d]))
                out[1].append(b - a)
                out[2].append([{"start": s, "stop": e} for s, e in bounds.reshape(-1, 2).tolist()])
                out[3].append(data[a:b][~mine].tobytes())
            yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(out[3], pa.binary())], ["id", "n_bytes", "spans", "kept"])


def dedupe(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, spans array<(start, stop)>, kept binary): a row for each row of docs."""
    bounded_batches(docs.sparkSession, "16m")
    text = text_or_empty(text_col)
    size = total_bytes(docs, text)
    texts, anchors, parts = parts_for(size, TEXT_BUCKET), *(parts_for(size // (_RUN // 2), n) for n in (RUN_BUCKET, PART_BUCKET))
    id_ = F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST))
    rows = docs.select(F.pmod(F.xxhash64(id_), F.lit(texts)).cast("int").alias("bucket"), id_.alias("id"), text.alias("text"))
    packed = materialize(rows.repartition(texts, "bucket").mapInArrow(_pack, _PACKED), "texts")
    found = materialize(packed.mapInArrow(_deal(anchors), _DEALT).repartition(anchors, "anchors").sortWithinPartitions("anchors").mapInArrow(_resolve, _FOUND), "runs")
    asked = found.filter("kind = 1").groupBy("bucket").agg(F.collect_list(F.struct("anchors", "first", "size", "at", "anchor", "id")).alias("asked"))
    fetched = packed.join(asked, "bucket").select("bucket", "ids", "ends", "data", "asked").mapInArrow(_fetch(parts), _ASKED)
    compared = materialize(fetched.repartition(parts, "anchors").sortWithinPartitions("anchors").mapInArrow(_compare, "bucket int, first binary, size binary"), "compared")
    covered = found.filter("kind = 0").select("bucket", "first", "size").union(compared).groupBy("bucket").agg(F.collect_list(F.struct("first", "size")).alias("covered"))
    out = packed.join(covered, "bucket", "left").select("ids", "ends", "data", "covered")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))), T.StructField("kept", T.BinaryType())])
    return out.mapInArrow(_cut, schema).withColumnRenamed("id", id_col)


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the 50-byte strings of documents of smaller doc_id."""
    out = dedupe(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
