"""Media columns: documents as ordered sequences of text and media references.

interleave() parses HTML into an array of structs, in document order: text runs, and references
with the digest that the src names and the caption (figcaption, else alt). resolve() joins the
references to a media table by digest, keeping positions and captions aligned; the media table's
own columns may be payloads or what was computed from them, so callers that need only features
never shuffle a payload.

Payloads are stored as 8-bit grey PGM images, 64 samples wide, losslessly.

Defined cases: null and empty HTML give an empty sequence; a reference whose digest no media row
has stays, with null media columns; equal digests in the media table count once; captions may be
null. Text in script and style is left out. Repeated rows stay rows of their own. A caption is that of
the innermost open figure, for its references that have none of their own figure; one that is left open
ends with the figure or where another block begins; one outside of figures is text.
"""

from __future__ import annotations

import hashlib
import html
import re
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainflow.llm.common import materialize, table, text_or_empty
from strainflow.llm.words import chunks

WIDTH = 64
SCHEME = "sha256:"
PART = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("caption", T.StringType()), T.StructField("url", T.StringType())])


class _Sequence(HTMLParser):
    BREAKS = frozenset("p div li h1 h2 h3 h4 h5 h6 br figure table tr section article figcaption".split())
    MEDIA = frozenset("img video audio source".split())

    def __init__(self, every: bool):
        super().__init__(convert_charrefs=True)
        self.parts: list[dict] = []
        self._every = every
        self._text: list[str] = []
        self._caption: list[str] | None = None  # of the innermost open figure
        self._figures: list[int] = []  # where the open figures begin
        self._named: set[int] = set()  # parts whose caption a figure has given
        self._skip = 0

    def _flush(self) -> None:
        text = " ".join("".join(self._text).split())
        self._text = []
        if text:
            self.parts.append({"kind": "text", "text": text, "digest": None, "caption": None, "url": None})

    def _end_caption(self) -> None:
        if self._caption is None:
            return
        caption, self._caption = " ".join("".join(self._caption).split()), None
        for k in range(self._figures[-1], len(self.parts)):
            if self.parts[k]["kind"] == "media" and k not in self._named:
                self.parts[k]["caption"] = caption
                self._named.add(k)

    def handle_starttag(self, tag, attrs):
        if tag in self.BREAKS and "".join(self._caption or ()).strip():
            self._end_caption()  # it was left open
        if tag in self.BREAKS or tag in self.MEDIA:
            self._flush()
        if tag in ("script", "style"):
            self._skip += 1
        elif tag == "figure":
            self._end_caption()
            self._figures.append(len(self.parts))
        elif tag == "figcaption" and self._figures:
            self._caption = []
        elif tag in self.MEDIA:
            found = dict(attrs)
            url = found.get("src") or ""
            digest = url[len(SCHEME) :] if url.startswith(SCHEME) else None
            if digest is not None or (self._every and url):
                self.parts.append({"kind": "media", "text": None, "digest": digest, "caption": found.get("alt"), "url": url})

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self._skip = max(0, self._skip - 1)
        elif tag == "figcaption":
            self._flush()
            self._end_caption()
        elif tag == "figure":
            self._flush()
            self._end_caption()
            del self._figures[-1:]
        elif tag in self.BREAKS:
            self._flush()

    def handle_data(self, data):
        if not self._skip:
            (self._text if self._caption is None else self._caption).append(data)

    def close(self):
        super().close()
        self._flush()
        self._end_caption()
        return [p | {"position": i} for i, p in enumerate(self.parts)]


def sequence_of(page: str | None, every: bool = False) -> list[dict]:
    parser = _Sequence(every)
    parser.feed(page or "")
    return parser.close()


def interleave(docs: DataFrame, *, html_col: str = "html", every: bool = False) -> DataFrame:
    """docs with a column `sequence`: array of (position, kind, text, digest, caption, url). With `every`,
    references that name no digest are kept too, by their url and a null digest."""
    from pyspark.sql.pandas.types import to_arrow_type

    at, kind = docs.columns.index(html_col), to_arrow_type(T.ArrayType(PART))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = [sequence_of(x, every) for x in batch.column(at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(found, kind)], [*batch.schema.names, "sequence"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("sequence", T.ArrayType(PART))]))


def resolve(docs: DataFrame, media: DataFrame, *, id_col: str = "doc_id", digest_col: str = "digest") -> DataFrame:
    """A row for each part of each sequence, with the media table's columns beside references."""
    parts = docs.select(F.col(id_col), F.explode("sequence").alias("part")).select(id_col, "part.*")
    # written, so that a digest with many references meets one row in a join that Spark splits
    known = materialize(media.dropDuplicates([digest_col]).withColumnRenamed(digest_col, "_digest"), "media-rows")
    return parts.join(known, parts["digest"] == known["_digest"], "left").drop("_digest")


def to_pgm(data: bytes) -> bytes:
    """A stored form of a text's bytes: zeros up to a positive multiple of 64, as grey samples."""
    height = max(1, -(-len(data) // WIDTH))
    return f"P5\n# bytes {len(data)}\n{WIDTH} {height}\n255\n".encode() + data.ljust(height * WIDTH, b"\0")


def from_pgm(stored: bytes) -> tuple[int, bytes]:
    """The number of bytes before padding, and the samples."""
    head = re.match(rb"P5\n# bytes (\d+)\n(\d+) (\d+)\n255\n", stored)
    samples = stored[head.end() :]
    if len(samples) != int(head[2]) * int(head[3]):
        raise ValueError("a PGM image with too few or too many samples")
    return int(head[1]), samples


def feature(samples: bytes) -> str:
    """Mean, spread and coarse histogram of the samples, as whole numbers."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64)
    n, total, square = len(x), int(x.sum()), int((x * x).sum())
    bins = np.bincount(x >> 5, minlength=8).tolist()
    return f"{WIDTH}x{n // WIDTH};mean={total * 1000 // n};var={(n * square - total * total) * 1000 // (n * n)};hist={','.join(map(str, bins))}"


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, html, digest, media): each text as an image, and a page that refers to it."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            media = [to_pgm(x.encode()) for x in batch.column(1).to_pylist()]
            digest = [hashlib.sha256(x).hexdigest() for x in media]
            pages = [f'<article><p>Document {html.escape(str(i))}</p><figure><img src="{SCHEME}{d}"><figcaption>{len(m)} bytes</figcaption></figure></article>' for i, d, m in zip(batch.column(0).to_pylist(), digest, media, strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(pages, pa.string()), pa.array(digest, pa.string()), pa.array(media, pa.binary())], [id_col, "html", "digest", "media"])

    schema = T.StructType([T.StructField(id_col, kind), T.StructField("html", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("media", T.BinaryType())])
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def features(media: DataFrame) -> DataFrame:
    """What the stored bytes give: columns for op8, by digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for stored in batch.column(1).to_pylist():
                n, samples = from_pgm(stored)
                rows.append((n, len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(samples)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = ["digest", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            yield pa.record_batch([batch.column(0), *(pa.array([r[i] for r in rows], kinds[i]) for i in range(7))], names)

    return media.select("digest", "media").mapInArrow(run, "digest string, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")


def op8_media_sequences(spark, sf_dir: str) -> DataFrame:
    """Every document as an interleaved page whose one image holds its text."""
    stored = materialize(store(table(spark, sf_dir, "documents")), "media")
    pages = interleave(stored.select("doc_id", "html")).drop("html")
    parts = resolve(pages, features(stored)).filter("kind = 'media'")
    return parts.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "position", "caption")
