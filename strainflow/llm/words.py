"""Words and shingles of an Arrow batch, as numpy arrays over the batch's bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_A = np.arange(256, dtype=np.uint8)
#: A-Z in lower case.
LOWER = np.where((_A >= 65) & (_A <= 90), _A + 32, _A).astype(np.uint8)
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F], on lower case.
ALNUM = ((_A >= 48) & (_A <= 57)) | ((_A >= 97) & (_A <= 122)) | (_A >= 128)
#: [^\x20\x09-\x0D]
NOT_SPACE = (_A != 32) & ~((_A >= 9) & (_A <= 13))

_BYTE = np.random.default_rng(20).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x5851F42D4C957F2D
_INVERSE = pow(BASE, -1, 2**64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the len+1 offsets of each; a null is empty."""
    texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    data: np.ndarray  # bytes, lower case
    start: np.ndarray  # of each word in data
    stop: np.ndarray
    first: np.ndarray  # rows + 1: the number of each row's first word
    hash: np.ndarray

    def shingles(self, width: int) -> np.ndarray:
        """A hash for each run of `width` words, by its first word; runs may cross rows."""
        n = max(0, len(self.hash) - width + 1)
        out = np.full(n, width, np.uint64)
        for k in range(width):
            out = mix(out * np.uint64(BASE) + self.hash[k : k + n])
        return out


def words(texts: pa.Array, kind: np.ndarray) -> Words:
    """Runs of bytes of a kind, in texts whose A-Z are lowered first."""
    data, offsets = raw(texts)
    data = LOWER[data]
    inside = kind[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[:-1][np.diff(offsets) > 0]
    begins[cut] = inside[cut]
    start = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = cut[1:] - 1
    ends[last] = inside[last]
    stop = np.flatnonzero(ends) + 1
    return Words(data, start, stop, np.searchsorted(start, offsets), span_hashes(data, start, stop))


def span_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, from one running sum: byte values times powers of an
    odd base, brought back to the span's start by the inverse power."""
    if not len(data):
        return np.zeros(len(start), np.uint64)
    power = np.full(len(data) + 1, BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:-1], out=total[1:])
    back = np.full(len(data) + 1, _INVERSE, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return mix((total[stop] - total[start]) * back[start] + (stop - start).astype(np.uint64))


def chunks(batches, rows: int = 400, most: int = 2 << 20):
    """Slices of Arrow batches of bounded bytes (a single longer row is a slice of its own)."""
    for batch in batches:
        k = 0
        while k < batch.num_rows:
            n = min(rows, batch.num_rows - k)
            while n > 1 and batch.slice(k, n).get_total_buffer_size() > 0 and batch.slice(k, n).nbytes > most:
                n //= 2
            yield batch.slice(k, n)
            k += n
