"""Legacy archives and pages as they are found: bare line feeds, gzip, blanks, damage; figures left open."""

from __future__ import annotations

import gzip

import pytest

from strainflow.llm import media, warc


def _arc(*blocks):
    return warc.arc_file("x.arc", 1, [(u, "1.2.3.4", "20010203040506", "text/html", b) for u, b in blocks])


def _records(spark, data, **options):
    return warc.convert(spark.createDataFrame([(bytearray(data),)], "arc binary"), **options).collect()


@pytest.mark.parametrize("packed", [False, True])
def test_heads_of_bare_line_feeds(spark, packed):
    blocks = [("http://a", b"HTTP/1.0 200 OK\nX: y\n\none\r\n\r\n"), ("http://b", b"HTTP/1.0 200 OK\nX: y\n\ntwo"), ("http://c", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n\n\nthree"), ("http://d", b"HTTP/1.0 200 OK and no blank line")]
    data = _arc(*blocks)
    if packed:  # a member for each record, as archives have them
        cut = data.index(b"http://b")
        data = gzip.compress(data[:cut]) + gzip.compress(data[cut:])
    got = {r["url"]: (r["type"], bytes(r["payload"]), bytes(r["http"]) + bytes(r["payload"])) for r in _records(spark, data)}
    assert {k: v[:2] for k, v in got.items()} == {"http://a": ("response", b"one\r\n\r\n"), "http://b": ("response", b"two"), "http://c": ("response", b"\n\nthree"), "http://d": ("resource", blocks[3][1])}
    assert [got[u][2] for u, _ in blocks] == [b for _, b in blocks]


def test_bare_line_feeds_are_read_back(spark, tmp_path):
    data = _arc(("http://a", b"HTTP/1.0 200 OK\nX: y\n\none"), ("http://b", b"HTTP/1.0 200 OK\nX: y\n\ntwo"))
    records = warc.convert(spark.createDataFrame([(bytearray(data),)], "arc binary")).selectExpr("*", "url as key", "cast(octet_length(payload) as bigint) as payload_bytes")
    files = warc.write_warc(warc.mark_revisits(records, "key"), str(tmp_path), "key").cache()
    assert files.count() == 1
    got = {r["key"]: (r["record_type"], r["payload_bytes"], r["payload_digest"]) for r in warc.read_warc(spark, str(tmp_path), files).collect()}
    assert got == {"http://a": ("response", 3, warc.digest(b"one")), "http://b": ("response", 3, warc.digest(b"two"))}


def test_blanks_in_urls(spark):
    data = _arc(("http://a/b c d", b"x"))
    assert [(r["url"], r["ip"]) for r in _records(spark, data)] == [("http://a/b%20c%20d", "1.2.3.4")]


@pytest.mark.parametrize("damage", ["short", "length", "header", "gzip", "first"])
def test_damaged_records(spark, damage):
    data = _arc(("http://a", b"good"), ("http://b", b"longer block"))
    data = {"short": data[:-6], "length": data.replace(b"text/html 12", b"text/html xx"), "header": data[:-1] + b"\nodd line\n", "gzip": gzip.compress(data)[:-9], "first": b"no archive\n"}[damage]
    with pytest.raises(Exception, match="ARC|gzip|filedesc"):
        _records(spark, data)
    got = _records(spark, data, rejects=True)
    assert [r["type"] for r in got].count("reject") == 1 and all(bytes(r["payload"]) in (b"good", b"longer block") for r in got if r["type"] != "reject")
    if damage in ("short", "length"):
        assert len(got) == 2 and bytes(got[1]["payload"]).startswith(b"http://b") and "at byte" in got[1]["about"]


def _parts(page, every=False):
    return [(p["text"], p["digest"], p["caption"]) for p in media.sequence_of(page, every)]


def test_open_captions_end():
    assert _parts('<figure><img src="sha256:a"><figcaption>cap<p>rest</p></figure><p>more</p>') == [(None, "a", "cap"), ("rest", None, None), ("more", None, None)]
    assert _parts('<figure><img src="sha256:a"><figcaption>cap</figure>after') == [(None, "a", "cap"), ("after", None, None)]
    assert _parts('<figure><img src="sha256:a"><figcaption>cap') == [(None, "a", "cap")]
    assert _parts('<figure><img src="sha256:a"><figcaption><p>cap</p></figcaption></figure>') == [(None, "a", "cap")]


def test_captions_belong_to_their_figures():
    assert _parts('<img src="sha256:a" alt="own"><figcaption>text</figcaption>') == [(None, "a", "own"), ("text", None, None)]
    nested = '<figure><img src="sha256:a"><figure><img src="sha256:b"><figcaption>inner</figcaption></figure><figcaption>outer</figcaption></figure>'
    assert _parts(nested) == [(None, "a", "outer"), (None, "b", "inner")]
    two = '<figure><img src="sha256:a"></figure><figure><img src="sha256:b"><figcaption>b</figcaption></figure>'
    assert _parts(two) == [(None, "a", None), (None, "b", "b")]
    assert _parts("</figure></figcaption>x") == [("x", None, None)]


def test_every_reference_is_kept(spark):
    page = '<p>a</p><img src="http://z/1" alt="z"><img src="sha256:q"><img>'
    assert len(media.sequence_of(page)) == 2
    frame = spark.createDataFrame([(1, page)], "doc_id int, html string")
    parts = media.resolve(media.interleave(frame, every=True), spark.createDataFrame([("q", 5)], "digest string, n int")).orderBy("position").collect()
    assert [(r["kind"], r["url"], r["digest"], r["caption"], r["n"]) for r in parts] == [("text", None, None, None, None), ("media", "http://z/1", None, "z", None), ("media", "sha256:q", "q", None, 5)]


def test_op10_rows_without_ids_lie_in_several_ranges(spark, tmp_path):
    """Rows without doc_id, or of one doc_id, keep one order and are dealt by their texts."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from strainflow.llm import registry, tokenfile

    texts = [f"text number {k} " * 40 for k in range(300)]
    pq.write_table(pa.table({"doc_id": pa.array([None] * 150 + [7] * 150, pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    got = registry.QUERIES["op10_token_frames"](spark, str(tmp_path)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None] * 150 + [7] * 150
    before = 0
    for r in got:
        assert r["start"] == before
        before += r["n_tokens"]
    docs = spark.createDataFrame([(7, t) for t in texts], "doc_id bigint, text string")
    from pyspark.sql import functions as F

    parts = docs.repartitionByRange(6, "doc_id", F.xxhash64("text")).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(parts) > 3 and tokenfile.END_ID == 1
