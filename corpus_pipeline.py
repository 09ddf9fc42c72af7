"""A corpus pipeline: documents without toxic ones, without their sites' boilerplate lines,
without near copies, without benchmark passages, as token ids.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that run() writes as Parquet and
rereads as the next stage's docs, so a lost executor costs a reread. A stage's result must be
written before the next stage begins: the tables that it reads are then deleted.
"""

from __future__ import annotations

import functools
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strainflow.llm import bpe, decontaminate, lines, ngram_join, toxicity
from strainflow.llm.common import bounded_batches, delete, materialize, new_path, scratch, table, written

#: Smaller blocks than op1's cost some CPU time and save Python workers' memory: the stages before have
#: grown the executors' heaps to their limit.
BLOCK_BYTES = 6 << 20
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_last = threading.local()


def _stage(stage: Callable) -> Callable:
    """The stage, which first deletes what the stage before it in this thread wrote for itself."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if getattr(_last, "scratch", None):
            _last.scratch.release(spark)
        bounded_batches(spark)
        with scratch() as _last.scratch:
            return stage(spark, docs, sf_dir)

    return run


@_stage
def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from labels outside the held-out fold, calls toxic go."""
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(~toxicity.held_out()))
    return toxicity.score(docs.select(*COLUMNS), lexicon).filter("predicted = 0").select(*COLUMNS)


@_stage
def site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source's documents go, by the one ratio of lines.usual; every document stays."""
    out = lines.drop_boilerplate(docs.select(*COLUMNS))
    text = F.array_join("_kept", "\n")
    return out.select("doc_id", text.alias("text"), "lang", "source", F.char_length(text).cast("bigint").alias("n_chars"))


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows connected by a similarity of 0.8 on five-word shingles, the one of least doc_id
    stays (of several with that doc_id, one), and so does one of those without doc_id. Of rows
    without words, repeated ones with a doc_id stay once."""
    # doc_ids may be null or repeat: rows are told apart by a number that is written with them
    keyed = materialize(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "keyed")
    found = ngram_join.link(keyed, id_col="_row", width=5, percent=80).withColumnRenamed("_row", "_id")
    digest = F.xxhash64("text", "lang", "source")
    rows = keyed.select("_row", "doc_id", digest.alias("digest"), F.sha2("text", 256).alias("sha")).join(found, F.col("_row") == F.col("_id"))
    wordless, nameless = F.col("n_shingles") == 0, F.col("doc_id").isNull()
    group = F.when(~wordless, F.col("component_id")).when(nameless, F.col("_row"))
    same = F.when(wordless & ~nameless, F.struct("doc_id", "sha"))
    first = F.min(F.struct("doc_id", "digest", "_row"))
    kept = rows.groupBy(wordless.alias("w"), nameless.alias("n"), group.alias("g"), same.alias("s")).agg(first.alias("first"))
    kept = materialize(kept.select(F.col("first._row").alias("_row")), "kept")
    return keyed.join(kept, "_row", "left_semi").select(*COLUMNS)


@_stage
def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a window of a benchmark item go."""
    return decontaminate.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of each document."""
    import public_tokenizers

    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    after = (bpe.ids_and_digest(vocabulary.path), bpe.IDS_AND_DIGEST)
    return bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, block_bytes=BLOCK_BYTES, after=after)


STAGES = [("toxicity", toxic), ("line_dedup", site_lines), ("ngram_join", near_copies), ("decontamination", benchmarks), ("byte_bpe", tokens)]

#: The lexicon is a fitted model and the components are iterative, so SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}", keep=True)
        docs = written(stage(spark, docs, sf_dir), path)
        if before:
            delete(spark, before)
        before = path
    return docs
