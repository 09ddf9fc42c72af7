"""What the review of the first round found missing in the training-data operators."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from conftest import DATA, same  # noqa: E402


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_op3_hosts_sql(spark, scale):
    from strainflow.llm import registry

    folder = DATA.parent / scale
    same(registry.QUERIES["op3_host_lines"](spark, str(folder)), registry.ORACLE_SQL["op3_host_lines"], folder)


def test_op3_one_rate_goes_everywhere(spark):
    """A line on 4 % of each source's documents goes from all; lines of clean documents, and of one with five copies, stay."""
    from strainflow.llm import lines

    rows = [(s, k, f"own {s} {k}" + ("\nplanted" if k % 25 == 0 else "") + ("\ncopied" if k % 100 == 1 else "")) for s in range(4) for k in range(500 + s * 50)]
    out = lines.drop_boilerplate(spark.createDataFrame(rows, "source int, k int, text string"), rule=lines.usual)
    got = {(r["source"], r["k"]): r["_kept"] for r in out.collect()}
    assert got == {(s, k): [x for x in t.split("\n") if x != "planted"] for s, k, t in rows}


def test_op3_small_hosts(spark):
    """Many small hosts, of which each has a line on all its pages: it goes from those of three pages or more."""
    from strainflow.llm import lines

    rows = [(f"HTTP://u@Host{h}.example:80/p?{k}", f"menu {h}\nown {h} {k}") for h in range(60) for k in range(1 + h % 9)] + [(None, "menu 8\nx"), ("no url", "menu 8\ny")]
    frame = spark.createDataFrame(rows, "url string, text string")
    got = {r["url"]: r["_kept"] for r in lines.drop_boilerplate(frame, site=lines.host(F.col("url")), rule=lines.usual).collect()}
    sizes = {h: 1 + h % 9 for h in range(60)}
    for url, text in rows:
        menu, own = text.split("\n")
        large = menu.startswith("menu") and url and url.startswith("HTTP") and sizes[int(menu[5:])] >= 3
        assert got[url] == ([own] if large else [menu, own])


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def _pairs(frame):
    return sorted(((r["doc_id"], r["text"]) for r in frame.collect()), key=repr)


def test_clean_judges_row_by_row(spark):
    from strainflow.llm import decontaminate

    item = "one two three four five six seven eight nine ten eleven é"
    clean = [(None, "clean text"), (None, None), (7, "other clean text"), (8, "")]
    bad = [(None, f"before {item}"), (7, f"{item.upper().replace('É', 'é')} after"), (7, item)]
    got = decontaminate.clean(_frame(spark, clean + bad), spark.createDataFrame([(1, item)], "item_id int, text string"))
    assert _pairs(got) == sorted(clean, key=repr)


def test_near_copies_judges_row_by_row(spark, tmp_path):
    import corpus_pipeline

    def text(seed, last=""):
        return " ".join(f"{seed}{k}" for k in range(60)) + last

    rows = [
        (None, text("a")), (None, text("a", " x")), (None, text("a", " y")),  # of these any one stays
        (5, text("b")), (5, text("b", " x")),  # one of two with an id
        (3, text("c")), (9, text("c", " x")), (9, text("d")),  # 9 goes as a copy of 3, not as d
        (4, text("e")), (4, text("e")), (6, ""), (6, ""), (None, ""), (None, None), (6, "one"),
    ]
    got = _pairs(corpus_pipeline.near_copies(spark, _frame(spark, rows), str(tmp_path)))
    short = [(i, (t or "")[:2] if t else t) for i, t in got]
    assert sorted(short, key=repr) == sorted([(None, "a0"), (5, "b0"), (3, "c0"), (9, "d0"), (4, "e0"), (6, ""), (None, ""), (None, None), (6, "on")], key=repr)


def test_op10_added_tokens_as_the_library_does(spark):
    import numpy as np
    import public_tokenizers
    from strainflow.llm import tokenfile
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = ["end <|endoftext|> x", "a<|endoftext|>b <|startoftext|>", "<|endoftext|><|endoftext|>", "<|endof text|>", "\x1c <|endoftext|>\t.", "plain"]
    got = dict(map(tuple, tokenfile.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), path, end_id=None).collect()))
    assert {k: np.frombuffer(v, "<u4").tolist() for k, v in got.items()} == {k: tok.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts)}


def test_token_ids_of_any_characters():
    """Pieces by the library's model, in a small cache, are what the library makes of whole texts."""
    import random
    from array import array

    import public_tokenizers
    import pyarrow as pa

    from strainflow.llm.tokenfile import Encoder

    coder = Encoder(public_tokenizers.path("word_bpe_49k.json"), cache=50)
    rnd = random.Random(3)
    wide = [chr(c) for c in range(0x300)] + list("́İ中٣ⅷ가\U0001f600 \t\n's't'll") * 3
    latin = [chr(c) for c in range(0x21, 0x100)]
    texts = ["".join(rnd.choices(some, k=rnd.randint(0, 25))) for some in (wide, latin) for _ in range(2000)]
    texts += ["", " \n", "a <|endoftext|> b", "\x00\x1c\x7f", "ÉCHEA×ß,"]
    for k in range(0, len(texts), 700):
        some = texts[k : k + 700]
        want = [array("I", e.ids + [1]).tobytes() for e in coder.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        assert coder(pa.array(some), 1).to_pylist() == want


def test_op5_compares_no_runs_of_one_document_alone():
    """Different runs around passages that one document repeats are not fetched; those of two documents are."""
    import pyarrow as pa

    from strainflow.llm import suffixes as S

    passage = "".join(chr(97 + k * k % 23) for k in range(70))
    own = " ".join(f"{k * 7919 % 1000:04d}{passage}{k * 104729 % 1000:04d}" for k in range(30))

    def asked(texts):
        batch = pa.record_batch([pa.array([0] * len(texts), pa.int32()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["bucket", "id", "text"])
        return [r for b in S._resolve(S._deal(1)(S._pack(iter([batch])))) for r in b.to_pylist() if r["kind"] == 1]

    assert not asked([own, "another text without anything that the first one has, " * 3])
    assert asked([own, "before it " + passage + " after it"])
    # one code of one document, one of two
    assert S._several(S.np.array([1, 2, 1, 2]), S.np.array([5, 5, 5, 6])).tolist() == [False, True, False, True]


def test_op5_parts_of_a_smaller_document_need_no_suffix_array():
    import numpy as np

    from strainflow.llm import suffixes as S

    data = np.frombuffer(b"abcdefghijabcdefghijabcdefghiX", np.uint8)
    begin, size = np.array([0, 10, 20]), np.array([10, 10, 10])
    key = [np.array([1, 1, 1])]
    assert S._repeated(key, np.array([1, 2, 3]), begin, size, data).tolist() == [False, True, False]
    assert S._repeated(key, np.array([2, 2, 2]), begin, size, data).tolist() == [False, False, False]


@pytest.mark.parametrize(("piece", "block"), [(4 << 20, 150_000), (300, 50)])
def test_op5_a_bucket_of_texts_sends_a_row_to_a_bucket(monkeypatch, piece, block):
    """However many buckets of anchors ask, runs are fetched by slices of bytes; what is compared of them is a
    symbol for all that their windows hold, and what is removed is what a search of all windows removes."""
    import random

    import pyarrow as pa

    from strainflow.llm import suffixes as S

    monkeypatch.setattr(S, "SLICE", piece, raising=False)
    monkeypatch.setattr(S, "BLOCK_SYMBOLS", block)
    rng = random.Random(11)
    passages = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(40, 200))) for _ in range(12)]
    texts = []
    for _ in range(60):
        cut = [p[rng.randrange(20) : len(p) - rng.randrange(20)] for p in rng.choices(passages, k=4)]
        texts.append("".join(c if rng.random() < 0.97 else "X" for c in "".join(x + rng.choice("efgh") * rng.randrange(3) for x in cut)))
    batch = pa.record_batch([pa.array([0] * len(texts), pa.int32()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["bucket", "id", "text"])
    packed = list(S._pack(iter([batch])))
    ordered = lambda batches: iter([pa.Table.from_batches(batches).sort_by("anchors").combine_chunks().to_batches()[0]])
    found = [r for b in S._resolve(ordered(list(S._deal(40)(iter(packed))))) for r in b.to_pylist()]
    asked = [r for r in found if r["kind"] == 1]
    rows = packed[0].append_column("asked", pa.array([asked]))
    sent = list(S._fetch(40)(iter([rows])))
    assert len(asked) > 20 and (piece < 1000 or len(sent) <= 40)
    sizes, real = [], S.shared_windows
    monkeypatch.setattr(S, "shared_windows", lambda symbols, *more: (sizes.append(len(symbols)), real(symbols, *more))[1])
    covered = [(r["first"], r["size"]) for b in S._compare(ordered(sent)) for r in b.to_pylist()] + [(r["first"], r["size"]) for r in found if r["kind"] == 0]
    assert 0 < sum(sizes) < sum(len(r["bytes"]) for b in sent for r in b.to_pylist()) / 2
    out = [r for b in S._cut(iter([packed[0].append_column("covered", pa.array([[{"first": f, "size": n} for f, n in covered]]))])) for r in b.to_pylist()]
    first = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - S.WINDOW + 1):
            first.setdefault(t[i : i + S.WINDOW], k)
    for k, t in enumerate(texts):
        gone = {j for i in range(len(t) - S.WINDOW + 1) if first[t[i : i + S.WINDOW]] < k for j in range(i, i + S.WINDOW)}
        assert out[k]["kept"].decode() == "".join(c for j, c in enumerate(t) if j not in gone)


@pytest.mark.parametrize("signed_sets", [2000, 7])
def test_op9_only_what_signatures_allow_goes_on(spark, monkeypatch, signed_sets):
    """Sets that merely share a rare passage are in one cluster, and none of their shingles travels."""
    import random

    from strainflow.llm import ngram_join

    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = ["a rare passage of six words " + " ".join(word() for _ in range(rng.randrange(60, 120))) for _ in range(60)]
    texts += [texts[3] + " one more", texts[3] + " two", texts[20].replace(" of six ", " of "), "a rare passage"]
    went, inner = [], ngram_join._links_of

    def links_of(sets, *more):
        went.append(sets.count())
        return inner(sets, *more)

    monkeypatch.setattr(ngram_join, "_links_of", links_of)
    found = ngram_join.link(_frame(spark, list(enumerate(texts))), width=4, percent=85, signed_sets=signed_sets)
    component = {r["doc_id"]: r["component_id"] for r in found.collect()}
    assert component == {k: {60: 3, 61: 3, 62: 20}.get(k, k) for k in range(len(texts))}
    assert went == [5]


@pytest.mark.parametrize("percent", [30, 60, 85])
def test_op9_signatures_lose_no_link(percent):
    """Sets that link are connected by the pairs that signatures allow, in one group and in groups of two sides."""
    import numpy as np

    from strainflow.llm import ngram_join

    rng = np.random.default_rng(9)
    stock = rng.integers(0, 2**63, 700).astype(np.uint64)
    sets = [np.unique(rng.choice(stock[: rng.integers(1, 4) ** 2 * 70 + 30], rng.integers(1, 600))) for _ in range(150)]
    sets += [np.unique(np.append(rng.permutation(sets[k])[: -1 - k % 9], stock[:1])) for k in range(100)]
    n, signs = np.array(list(map(len, sets))), list(map(ngram_join._signature, sets))
    links = {(a, b) for a in range(len(sets)) for b in range(a) if 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= percent * (n[a] + n[b] - both)}
    assert links

    def connected(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return label

    key = np.arange(len(sets))
    label = connected(ngram_join._allowed(percent, key, n, np.full(len(sets), ngram_join.BOTH), signs))
    assert all(label[a] == label[b] for a, b in links)
    role = np.where(key % 2, ngram_join.STAYS, ngram_join.WALKS)
    label = connected(ngram_join._allowed(percent, key, n, role, signs))
    assert all(label[a] == label[b] for a, b in links if role[a] != role[b])


def test_pipeline_tokens_take_two_workers_a_task(spark, tmp_path):
    """Ids are decoded in the worker that puts them together."""
    import hashlib

    import corpus_pipeline
    import public_tokenizers
    from strainflow.llm import bpe

    rows = [(0, "It's a test, isn't it?"), (1, ""), (2, None), (3, "f\u00fcr 100 \U0001f600 " * 9), (None, "x" * 700), (3, "again")]
    frame = _frame(spark, rows)
    found = corpus_pipeline.tokens(spark, frame, str(tmp_path))
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    node, names = found._jdf.queryExecution().optimizedPlan(), []
    while node.children().size():
        names.append(node.nodeName())
        node = node.children().apply(0)
    assert names.count("MapInArrow") == 2
    ids = bpe.encode(frame, bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    wanted = sorted((str(r["doc_id"]), r["ids"]) for r in ids.collect())
    got = found.collect()
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == wanted
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert sorted(r["decoded_sha256"] for r in got) == sorted(hashlib.sha256((x or "").encode()).hexdigest() for _, x in rows)
