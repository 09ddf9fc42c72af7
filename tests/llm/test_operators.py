"""The ten operators and the pipeline against plain Python on small tables, with edge cases."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import shutil
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from conftest import DATA, same  # noqa: E402

P = pytest.importorskip("public_tokenizers")

#: Columns that documents may have besides their own.
CLASHING = ["id", "key", "bucket", "score", "predicted", "digest", "size", "n", "token", "_kept", "ids", "item", "shard", "url"]


def _write(folder: Path, docs: pa.Table, pages: pa.Table) -> Path:
    for name in ("benchmark", "labels"):
        shutil.copy(DATA / f"{name}.parquet", folder)
    pq.write_table(docs, folder / "documents.parquet")
    pq.write_table(pages, folder / "pages.parquet")
    return folder


@pytest.fixture(scope="session")
def edge(tmp_path_factory) -> Path:
    """The smallest documents and pages with nulls, empty, very long and repeated rows."""
    folder = tmp_path_factory.mktemp("edge")
    docs = pq.read_table(DATA / "documents.parquet", columns=["doc_id", "text", "lang", "source"]).to_pylist()
    item = next(x for x in pq.read_table(DATA / "benchmark.parquet").to_pylist() if len((x["text"] or "").split()) > 12)["text"]
    rng = random.Random(3)
    words = [f"w{k}" for k in range(5000)]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    odd = "x" * 3000 + "\x1c été ​İ ﬁ 12345678 don't 'll  \r\n\t" + "\U0001f600" * 40
    more = [(9001, None), (9002, ""), (9003, " \n\t "), (9004, long), (9005, long[:200_000] + " tail"), (9006, docs[0]["text"]), (9006, docs[0]["text"]), (9007, odd), (9008, "ab" * 400), (9009, "b" + "ab" * 400), (9010, f"before {item} after"), (9011, item.upper()), (9012, "one"), (9013, "one two"), (9014, "one two"), (None, docs[1]["text"])]
    rows = docs + [{"doc_id": i, "text": t, "lang": None, "source": None} for i, t in more]
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("n_chars", pa.int64()), *((c, pa.string()) for c in CLASHING)])
    table = pa.Table.from_pylist([r | {"n_chars": len(r["text"] or ""), **dict.fromkeys(CLASHING, "?")} for r in rows], schema)
    pages = pq.read_table(DATA / "pages.parquet").to_pylist()
    pages += [{"page_id": 9001, "url": None, "html": None}, {"page_id": 9002, "url": "http://a b/é", "html": ""}, {"page_id": 9003, "url": "http://c", "html": pages[0]["html"]}, {"page_id": 9003, "url": "http://c", "html": pages[0]["html"]}, {"page_id": 9004, "url": "http://d", "html": "HTTP/1.1 x\r\n\r\nWARC/1.0\r\n\n\n"}]
    return _write(folder, table, pa.Table.from_pylist([r | {"key": "?", "payload": "?"} for r in pages], pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("html", pa.string()), ("key", pa.string()), ("payload", pa.string())])))


@pytest.fixture(scope="session")
def empty(tmp_path_factory, edge) -> Path:
    return _write(tmp_path_factory.mktemp("empty"), pq.read_table(edge / "documents.parquet").slice(0, 0), pq.read_table(edge / "pages.parquet").slice(0, 0))


@pytest.fixture(scope="session")
def docs(edge) -> list[tuple[int | None, str | None]]:
    return [(r["doc_id"], r["text"]) for r in pq.read_table(edge / "documents.parquet", columns=["doc_id", "text"]).to_pylist()]


@pytest.fixture(scope="session")
def queries():
    import corpus_pipeline
    from strainflow.llm import registry

    return registry.QUERIES | {"pipeline": corpus_pipeline.run}


def _rows(frame, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def _sorted(rows) -> list[tuple]:
    return sorted(rows, key=repr)


def _raw(text: str | None) -> bytes:
    return (text or "").encode()


def _tiktoken():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("n", range(11))
def test_empty(spark, empty, queries, n):
    name = next((x for x in queries if x.startswith(f"op{n}_")), "pipeline")
    assert queries[name](spark, str(empty)).count() == 0


@pytest.mark.parametrize("name", ["op3_site_lines", "op4_benchmark_windows"])
def test_sql(spark, queries, name):
    from strainflow.llm import registry

    same(queries[name](spark, str(DATA)), registry.ORACLE_SQL[name], DATA)


def test_op3_edge(spark, edge, queries):
    from strainflow.llm import lines

    rows = pq.read_table(edge / "documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()
    wanted = [(r["doc_id"], hashlib.sha256(_raw(r["text"])).hexdigest()) for r in _without_boilerplate(rows, lines)]
    assert _rows(queries["op3_site_lines"](spark, str(edge)), "doc_id", "kept_sha256") == _sorted(wanted)


def test_op4_edge(spark, edge, docs, queries):
    windows = defaultdict(set)
    for r in pq.read_table(edge / "benchmark.parquet").to_pylist():
        w = _alnum(r["text"])
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[n, tuple(w[k : k + n])].add(str(r["item_id"]))
    wanted = []
    for i, t in docs:
        w, hit, items = _alnum(t), set(), set()
        for n in {n for n, _ in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get((n, tuple(w[k : k + n]))):
                    hit |= set(range(k, k + n))
                    items |= found
        wanted.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    assert _rows(queries["op4_benchmark_windows"](spark, str(edge)), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == _sorted(wanted)


def test_op1(spark, edge, docs, queries):
    tok = _tiktoken()
    wanted = []
    for i, text in docs:
        ids = tok.encode_ordinary(text or "")
        wanted.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(_raw(text)).hexdigest()))
    assert _rows(queries["op1_byte_bpe"](spark, str(edge)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == _sorted(wanted)


def test_op1_long_words_and_small_blocks(spark):
    from strainflow.llm import bpe

    tok, v = _tiktoken(), bpe.Vocabulary(P.path("byte_bpe_50k.tiktoken"))
    texts = ["the " * 50, "q" * 700, "abcdefghij" * 60, "", "naïve  coöperation\n\n\n end"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for options in ({"max_fold_bytes": 20, "head_words": 0}, {"block_bytes": 100}):
        got = dict(map(tuple, bpe.encode(frame, v, P.PATTERN, **options).collect()))
        assert got == {i: tok.encode_ordinary(t) for i, t in enumerate(texts)}


def test_op2(spark, edge, docs, queries):
    got = queries["op2_best_fit_shards"](spark, str(edge)).collect()
    wanted = [(i, len(_raw(t)) + 8, zlib.crc32(_raw(t))) for i, t in docs]
    assert _sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == _sorted(wanted)
    by, sizes, shards = defaultdict(list), defaultdict(int), defaultdict(set)
    text = {i: t for i, t in docs}
    for r in got:
        by[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        shards[text[r["doc_id"]]].add(r["shard"])
    assert set(by) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(len(s) == 1 for s in shards.values())
    assert {r["law"] for r in got} == {"bytes"} and all(r["grown_shard"] is None for r in got)
    group = defaultdict(int)
    for i, t in docs:
        group[t] += len(_raw(t)) + 8
    # large groups have shards of their own; the others are even
    alone = [x for x in group.values() if x * 24 > sum(group.values())]
    even = [s for s in sizes.values() if s not in alone]
    assert max(even) - min(even) <= max(64, sum(even) // len(even) // 20)


def test_best_fit_decreasing_is_what_it_says():
    from strainflow.llm.sharding import best_fit_decreasing

    rng = random.Random(5)
    for _ in range(60):
        sizes = sorted({rng.randint(1, 40) for _ in range(rng.randint(1, 12))})
        counts, capacity = [rng.randint(1, 6) for _ in sizes], rng.randint(20, 60)
        rooms: list[int] = []
        for s, c in sorted(zip(sizes, counts, strict=True), reverse=True):
            for _ in range(c):
                fit = [k for k, room in enumerate(rooms) if room >= s]
                if not fit:
                    rooms.append(max(s, capacity) - s)
                else:
                    rooms[min(fit, key=lambda k: (rooms[k], k))] -= s
        got = best_fit_decreasing(np.array(sizes), np.array(counts), capacity)
        assert got.bins == len(rooms)
        assert sum(b - a for a, b in zip(got.first, got.last, strict=True)) == sum(counts)


def test_op5(spark, edge, docs, queries):
    big = 1 << 62
    least: dict[bytes, int] = {}
    for i, t in docs:
        data = _raw(t)
        for k in range(len(data) - 49):
            w = data[k : k + 50]
            least[w] = min(least.get(w, big), big if i is None else i)
    wanted = []
    for i, t in docs:
        data = _raw(t)
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 49):
            if least[data[k : k + 50]] < (big if i is None else i):
                gone[k : k + 50] = True
        kept = bytes(b for b, g in zip(data, gone[:-1], strict=True) if not g)
        wanted.append((i, len(data), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert _rows(queries["op5_suffix_dedup"](spark, str(edge)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _sorted(wanted)


def test_suffix_array():
    from strainflow.llm.suffixes import suffix_array

    rng = random.Random(1)
    for size in [0, 1, 2, 5, 30, 200]:
        for letters in (1, 2, 5):
            x = [rng.randrange(letters) for _ in range(size)]
            assert suffix_array(x) == sorted(range(size), key=lambda i, x=x: x[i:])


def _area(scores, labels) -> float:
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    for s in np.unique(scores):
        rank[scores == s] = rank[scores == s].mean()
    n1 = labels.sum()
    return (rank[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


@pytest.mark.parametrize(("scale", "least"), [("sf0.01", 0.9), ("sf0.1", 0.95)])
def test_op6_held_out(spark, queries, scale, least):
    folder = DATA.parent / scale  # at sf0.01 only six held-out documents are toxic
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(folder / "labels.parquet").to_pylist() if r["toxic"] is not None}
    got = [r for r in queries["op6_toxic_lexicon"](spark, str(folder)).collect()]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    some = [r for r in got if r["held_out"] and r["doc_id"] in labels]
    score, label = np.array([r["score"] for r in some]), np.array([labels[r["doc_id"]] for r in some])
    assert label.sum() > 5 and _area(score, label) >= least


def test_op6_edge(spark, edge, docs, queries):
    got = queries["op6_toxic_lexicon"](spark, str(edge)).collect()
    assert _sorted((r["doc_id"],) for r in got) == _sorted((i,) for i, _ in docs)
    assert all(r["score"] is not None for r in got)


def test_op6_folding_and_exceptions():
    from strainflow.llm.toxicity import Lexicon, fold

    assert fold("Y0u ѕtup1d  fооl!") == " you stupid fool "
    lexicon = Lexicon({" stup": 3.0}, frozenset({" not stupid "}), (-4.0, 1.0, 1.0))
    assert lexicon.matches(fold("so stupid")) and not lexicon.matches(fold("not stupid"))
    assert lexicon.score("stup1d") > lexicon.score("") >= 0


def test_op6_scores_by_naive_search(spark, edge, docs):
    """score() against a search for each pattern at each place."""
    import math

    from strainflow.llm.common import table
    from strainflow.llm.toxicity import fold, learn, score

    lexicon = learn(table(spark, str(DATA.parent / "sf0.01"), "documents"), table(spark, str(DATA.parent / "sf0.01"), "labels"))
    assert lexicon.weights
    some = dict(list(lexicon.weights.items())[:40])
    lexicon.weights, lexicon.exceptions = some, lexicon.exceptions | {f" so{p.rstrip()} " for p in list(some)[:3]}

    def places(pattern, text):
        return [k for k in range(len(text) - len(pattern) + 1) if text.startswith(pattern, k)]

    texts = [t for _, t in docs if len(t or "") < 20_000] + [f"so{p} x{p}{p} end" for p in some]
    wanted = []
    for t in texts:
        folded = fold(t or "")
        at = {}
        for p, w in some.items():
            for k in places(p, folded):
                at[k] = max(w, at.get(k, 0))
        excused = [(k, k + len(x) - 1) for x in lexicon.exceptions if x not in some for k in places(x, folded)]
        total = sum(w for k, w in at.items() if not any(a <= k < b for a, b in excused))
        z = lexicon.curve[0] + lexicon.curve[1] * math.log1p(total) + lexicon.curve[2] * math.log1p(1000 * total / (len(folded) + 200))
        wanted.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r["score"] for r in score(frame, lexicon).orderBy("doc_id").collect()]
    assert len(got) == len(wanted) and all(abs(a - b) < 1e-9 for a, b in zip(got, wanted, strict=True))


def test_op6_labels(spark):
    """Null, repeated, unknown and absent labels, and clashing columns."""
    from strainflow.llm.toxicity import learn, score

    texts = [(k, f"w{k} zorkish v{k} here", "?") for k in range(60)] + [(k, f"nice plain words {k}", "?") for k in range(60, 400)] + [(None, None, "?")]
    docs = spark.createDataFrame(texts, "doc_id int, text string, score string")
    labels = [(k, 1 if k < 60 else 0, "?") for k in range(400)]
    schema = "doc_id int, toxic int, text string"
    plain = learn(docs, spark.createDataFrame(labels, schema))
    odd = learn(docs, spark.createDataFrame(labels + [(k, 0, "?") for k in range(60)] + [(None, 1, "?"), (3, None, "?"), (99_999, 1, "?")], schema))
    assert plain == odd and plain.weights
    got = {r["doc_id"]: r["predicted"] for r in score(docs, plain).collect()}
    assert all(got[k] == int(k < 60) for k in range(400)) and got[None] == 0
    none = learn(docs, spark.createDataFrame([], schema))
    assert not none.weights and {r["predicted"] for r in score(docs, none).collect()} == {0}


def test_op4_benchmark_edges(spark):
    """An empty benchmark; null items and texts, repeats and clashing columns."""
    from strainflow.llm.decontaminate import match

    docs = spark.createDataFrame([(1, "a b c"), (None, None), (2, "x")], "doc_id int, text string")
    schema = "item_id int, text string, key string, n string"
    assert {(r["doc_id"], r["n_hit"], len(r["items"])) for r in match(docs, spark.createDataFrame([], schema)).collect()} == {(1, 0, 0), (None, 0, 0), (2, 0, 0)}
    items = spark.createDataFrame([(7, "B c", "?", "?"), (7, "B c", "?", "?"), (None, "a", "?", "?"), (8, None, "?", "?"), (9, "", "?", "?")], schema)
    assert {(r["doc_id"], r["n_hit"], tuple(r["items"])) for r in match(docs, items).collect()} == {(1, 3, ("7",)), (None, 0, ()), (2, 0, ())}


def test_op7_other_records(spark, tmp_path):
    """Blocks that aren't HTTP answers keep all their bytes; the filedesc becomes warcinfo; files that no task named aren't read."""
    from strainflow.llm import warc

    blocks = [("dns:a", "text/dns", b"20010101\r\n\r\nrest of it\r\n\r\n"), ("http://b", "text/html", b"HTTP/1.0 200 OK\r\nX: y\r\n\r\nbody"), ("ftp://c", "text/plain", b"")]
    arc = warc.arc_file("x.arc", 1, [(u, "1.2.3.4", "20010203040506", k, b) for u, k, b in blocks])
    frame = spark.createDataFrame([(bytearray(arc),)], "arc binary")
    records = warc.convert(frame).selectExpr("*", "url as key", "cast(octet_length(payload) as bigint) as payload_bytes")
    files = warc.write_warc(warc.mark_revisits(records, "key"), str(tmp_path), "key").cache()
    name = files.first()["file"]
    (tmp_path / "stale.warc.gz").write_bytes((tmp_path / name).read_bytes())
    got = {r["key"]: (r["record_type"], r["payload_bytes"], r["payload_digest"]) for r in warc.read_warc(spark, str(tmp_path), files).collect()}
    assert got == {u: ("response" if b.startswith(b"HTTP") else "resource", len(p), warc.digest(p)) for u, k, b in blocks for p in [b.partition(b"\r\n\r\n")[2] if b.startswith(b"HTTP") else b]}
    kinds = {f.get("WARC-Target-URI"): (f["WARC-Type"], f["Content-Type"], b) for f, b in warc.warc_records((tmp_path / name).read_bytes())}
    assert kinds["dns:a"] == ("resource", "text/dns", blocks[0][2]) and kinds[None][0] == "warcinfo" and b"Archive-length" in kinds[None][2]


def test_op7(spark, edge, queries):
    pages = [(r["page_id"], _raw(r["html"])) for r in pq.read_table(edge / "pages.parquet").to_pylist()]
    first: dict[bytes, int] = {}
    for i, data in pages:
        first[data] = min(i, first.get(data, i))
    wanted = [(i, len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), "revisit" if i > first[d] else "response", first[d] if i > first[d] else None) for i, d in pages]
    assert _rows(queries["op7_arc_to_warc"](spark, str(edge)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == _sorted(wanted)


@pytest.mark.parametrize("version", [1, 2])
def test_op7_arc_versions(version):
    from strainflow.llm.warc import arc_file, arc_records

    blocks = [b"", b"a\n\nb", b"HTTP/1.1 200 OK\r\n\r\n\n"]
    data = arc_file("x.arc", version, [(f"http://{k}", "1.2.3.4", "20010203040506", "text/html", b) for k, b in enumerate(blocks)])
    got = list(arc_records(data))
    assert [b for _, b in got] == blocks and [f["URL"] for f, _ in got] == ["http://0", "http://1", "http://2"]
    with pytest.raises(ValueError):
        list(arc_records(data[:-8]))


def test_op8(spark, edge, docs, queries):
    wanted = []
    for i, t in docs:
        data = _raw(t)
        padded = data.ljust(max(1, -(-len(data) // 64)) * 64, b"\0")
        wanted.append((i, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:])))
    got = queries["op8_media_sequences"](spark, str(edge))
    assert _rows(got, "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == _sorted(wanted)
    by = defaultdict(set)
    for r in got.collect():
        by[r["payload_sha256"], r["n_bytes"]].add((r["media_bytes"], r["media_sha256"], r["feature"]))
    assert all(len(x) == 1 for x in by.values())


def test_op8_features(spark, edge, docs, queries):
    """The stored form and the feature, from their definitions."""
    wanted = []
    for i, t in docs:
        data = _raw(t).ljust(max(1, -(-len(_raw(t)) // 64)) * 64, b"\0")
        stored = b"P5\n# bytes %d\n64 %d\n255\n" % (len(_raw(t)), len(data) // 64) + data
        n, total, square, bins = len(data), sum(data), sum(b * b for b in data), [0] * 8
        for b in data:
            bins[b // 32] += 1
        feature = f"64x{n // 64};mean={total * 1000 // n};var={(n * square - total * total) * 1000 // (n * n)};hist={','.join(map(str, bins))}"
        wanted.append((i, len(stored), hashlib.sha256(stored).hexdigest(), feature))
    assert _rows(queries["op8_media_sequences"](spark, str(edge)), "doc_id", "media_bytes", "media_sha256", "feature") == _sorted(wanted)


def test_op8_sequences(spark):
    from strainflow.llm import media

    page = '<p>one</p><figure><img src="sha256:aa" alt="x"><figcaption>cap &amp; tion</figcaption></figure><script>no</script>two<img src="sha256:bb" alt="alt"><img src="http://z">'
    frame = spark.createDataFrame([(1, page), (2, None), (3, "")], "doc_id int, html string")
    known = spark.createDataFrame([("aa", 5), ("aa", 5)], "digest string, n int")
    got = media.resolve(media.interleave(frame), known).orderBy("doc_id", "position").collect()
    assert [(r["position"], r["kind"], r["text"], r["digest"], r["caption"], r["n"]) for r in got] == [(0, "text", "one", None, None, None), (1, "media", None, "aa", "cap & tion", 5), (2, "text", "two", None, None, None), (3, "media", None, "bb", "alt", None)]


def _lower(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def _shingles(text: str | None, width: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)] if words else [])


def _components(docs, width, percent) -> list[tuple]:
    sets = [_shingles(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * min(len(sets[a]), len(sets[b])) >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(docs)]


def test_op9(spark, edge, docs, queries):
    assert _rows(queries["op9_ngram_tree_join"](spark, str(edge)), "doc_id", "n_shingles", "component_id") == _sorted(_components(docs, 4, 85))


@pytest.mark.parametrize("block_sets", [2, 7, 500])
def test_op9_small_blocks(spark, block_sets):
    """Chains of near copies whose clusters take several blocks."""
    from strainflow.llm import ngram_join

    rng = random.Random(9)
    rows, base = [], [f"w{k}" for k in range(60)]
    for i in range(60):
        if i % 20 == 0:
            base = base[:30] + [f"v{i}.{k}" for k in range(30)]
        text = list(base)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(text)))
    got = ngram_join.link(spark.createDataFrame(rows, "doc_id long, text string"), width=3, percent=60, block_sets=block_sets)
    assert _rows(got, "doc_id", "n_shingles", "component_id") == _sorted(_components(rows, 3, 60))


def _alike_sets(rng, n: int, rank) -> list[np.ndarray]:
    from strainflow.llm import ngram_join

    bases = [np.unique(rng.integers(0, 2**63, 300).astype(np.uint64)) for _ in range(3)]
    out = []
    for i in range(n):
        kept = bases[i % 3][rng.random(300) > rng.choice([0, 0.02, 0.1, 0.3])]
        out.append(ngram_join._ordered(np.unique(np.append(kept, rng.integers(0, 2**63, rng.integers(0, 8)).astype(np.uint64))), rank))
    return out


@pytest.mark.parametrize("percent", [60, 80, 100])
def test_op9_walk(percent):
    """A walk finds what every pair compared finds; a labelled one leaves out its own label only."""
    from strainflow.llm import ngram_join

    rng = np.random.default_rng(4)
    rank = rng.integers(0, 9, 1 << ngram_join.SKETCH_BITS)
    sets = _alike_sets(rng, 90, rank)
    tree = ngram_join.Tree()
    for i, tokens in enumerate(sets):
        tree.add(tokens[::-1], i)
    flat = ngram_join.FlatTree(tree, rank)
    wanted = [[j for j, y in enumerate(sets) if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))] for x in sets]
    assert [sorted(flat.links(x, percent)) for x in sets] == wanted
    flat.label([i % 3 for i in flat.all_names])
    for i, x in enumerate(sets):
        assert {j for j in wanted[i] if j % 3 != i % 3} <= set(flat.links(x, percent, i % 3)) <= set(wanted[i])


def test_op9_forest():
    """Links of a block connect what all links connect, however often the tree is labelled."""
    from strainflow.llm import ngram_join

    rng = np.random.default_rng(6)
    rank = rng.integers(0, 9, 1 << ngram_join.SKETCH_BITS)
    sets = _alike_sets(rng, 200, rank)
    block = ngram_join.Block(85, rank)
    for i, tokens in enumerate(sets):
        block.add(i, i, tokens)
    for i, tokens in enumerate(sets):
        block.walk(i, i, tokens)

    def roots(pairs):
        root = list(range(len(sets)))
        for _ in sets:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        return root

    every = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))]
    assert roots(block.found) == roots(every)
    assert len(block.found) == len(sets) - len(set(roots(every)))


def test_op10(spark, edge, docs, queries):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    wanted, start = [], 0
    for i, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        wanted.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert _rows(queries["op10_token_frames"](spark, str(edge)), "doc_id", "start", "n_tokens", "ids_crc32") == _sorted(wanted)


def test_op10_reader_takes_only_what_it_needs():
    import io

    from strainflow.llm import tokenfile

    stream = io.BytesIO()
    rows = [(k, np.full(40_000, k, "<u4").tobytes()) for k in range(20)]
    tokenfile.write_file(stream, iter(rows))
    data, read = stream.getvalue(), []

    def at(offset, size):
        read.append(size)
        return data[offset : offset + size]

    reader = tokenfile.Reader(at, len(data))
    before = sum(read)
    assert list(reader.documents({7})) == [rows[7]] and sum(read) - before == reader.sizes[reader.index[7, 2]]
    spoilt = bytearray(data)
    spoilt[int(reader.starts[0]) + 20] ^= 1
    with pytest.raises(Exception):  # noqa: B017  zstandard's own error, or the checksum's
        list(tokenfile.Reader(lambda o, n: bytes(spoilt[o : o + n]), len(spoilt)).documents({0}))


def _without_boilerplate(rows: list[dict], lines) -> list[dict]:
    pages, often = defaultdict(int), defaultdict(int)
    for r in rows:
        pages[r["source"]] += 1
        for x in set(r["text"].split("\n") if r["text"] is not None else []):
            often[r["source"], x] += 1
    bad = {k for k, n in often.items() if k[1].strip(" ") and n >= lines.LEAST and 2 ** (n - 1) >= pages[k[0]] and n > pages[k[0]] * lines.SHARE}
    return [r | {"text": None if r["text"] is None else "\n".join(x for x in r["text"].split("\n") if (r["source"], x) not in bad)} for r in rows]


def _alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text))


def test_pipeline(spark, edge):
    """Each stage on what its predecessor kept, against plain Python."""
    import corpus_pipeline
    from strainflow.llm import lines, registry

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontamination", "byte_bpe"]
    from strainflow.llm.common import materialize, table

    frames = [table(spark, str(edge), "documents")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], str(edge)), f"test-{name}", keep=True))
    start, clean, cut, single, kept, ids = ([r.asDict() for r in f.collect()] for f in frames)
    key = lambda rows: _sorted((r["doc_id"], r["text"], r["source"]) for r in rows)

    toxic = {(r["doc_id"]): r["predicted"] for r in registry.QUERIES["op6_toxic_lexicon"](spark, str(edge)).collect()}
    assert key(clean) == key(r for r in start if not toxic[r["doc_id"]])

    wanted = _without_boilerplate(clean, lines)
    assert key(cut) == key(wanted)

    roots = _components([(r["doc_id"], r["text"]) for r in cut], 5, 80)
    alone = [r for r, (i, _, c) in zip(cut, roots, strict=True) if i is None or i == c]
    once = list({(r["doc_id"], r["text"]): r for r in alone if r["doc_id"] is not None}.values()) + [r for r in alone if r["doc_id"] is None]
    assert key(single) == key(once)

    windows = defaultdict(set)
    for x in pq.read_table(edge / "benchmark.parquet").to_pylist():
        w = _alnum(x["text"])
        n = min(10, len(w))
        if n:
            windows[n] |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
    hit = lambda t: any(tuple(w[k : k + n]) in some for w in [_alnum(t)] for n, some in windows.items() for k in range(len(w) - n + 1))
    assert key(kept) == key(r for r in single if not hit(r["text"]))

    tok = _tiktoken()
    assert _sorted((r["doc_id"], r["ids"], r["n_tokens"]) for r in ids) == _sorted((r["doc_id"], x, len(x)) for r in kept for x in [tok.encode_ordinary(r["text"] or "")])


def test_nothing_else_imports_this_package():
    root = Path(__file__).resolve().parents[2]
    for path in (root / "strainflow").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()


def test_components_of_a_long_chain(spark):
    from strainflow.llm.components import components

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (100, 100), (None, 3)], "a long, b long")
    got = dict(map(tuple, components(edges).select("node", F.col("root")).collect()))
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
