"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding: compatibility decomposition without marks, lower case, homoglyphs of other scripts, and
digits or signs that stand beside letters read as letters (w0rthle$$). Words are then parted by
one space, so that a pattern " stem" matches words that begin with it and " word " whole words.

The lexicon is learned from labelled rows: words and their beginnings whose share of toxic
documents is significantly high (likelihood ratio), weighted by log odds. Exception phrases are
pairs of words around a match that clean documents have and toxic ones don't; a match inside one
doesn't count. A document's weights are summed and normalised by its length, and a logistic curve
fitted to the same rows makes that a score from 0 to 1.

Learning reads at most `max_rows` labelled rows, those whose hashed ids come first (a documented
bound); scoring reads every whole text and shuffles nothing.

Defined cases: null and empty texts have no match and get the score of a clean text; labels of
rows that aren't in docs, null labels and repeated labels of one doc_id (the greater counts) are
handled; without toxic labels the lexicon is empty and every score is low. Other columns are
passed through by score() and ignored in learning; `score` and `predicted` replace columns of
these names.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strainflow.llm.common import materialize, table, text_or_empty
from strainflow.llm.words import chunks

MAX_ROWS = 20_000
#: Beginnings of words that are candidates.
STEMS = range(4, 9)
#: Least likelihood ratio (G squared) of a pattern, and least log odds.
EVIDENCE, ODDS = 18.0, 2.5
#: Letters of other scripts by the Latin letter that they look like.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ӏ": "l", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n", "ь": "b",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "υ": "u", "ι": "i", "κ": "k", "τ": "t", "ε": "e", "χ": "x", "γ": "y", "η": "n", "ω": "w", "β": "b",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "l", "ø": "o", "đ": "d",
}
#: Digits and signs by the letter that they stand for.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}

_MARKS = re.compile("[̀-ͯ]+")
_GLYPHS = str.maketrans(HOMOGLYPHS)
_SIGNS = str.maketrans(DIGITS)
_BESIDE = re.compile(r"(?<=[^\W\d_])[0-9@$!|]+(?=[^\W\d_])|(?<=[^\W\d_])[0-9@$]+|(?<![^\s(\"'])[0-9@$]+(?=[^\W\d_])")
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Folded words with a space before and after each."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
        if not text.isascii():
            text = text.translate(_GLYPHS)
    text = _BESIDE.sub(lambda m: m[0].translate(_SIGNS), text)
    return f" {' '.join(_WORD.findall(text))} "


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: frozenset[str] = frozenset()
    #: Of the logistic curve: constant, and factors of the summed weights and of those a length.
    curve: tuple[float, float, float] = (-4.0, 0.0, 0.0)

    @functools.cached_property
    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            found.add_word(pattern, (pattern, weight))
        for phrase in self.exceptions:
            if phrase not in self.weights:
                found.add_word(phrase, (phrase, None))
        if len(found):
            found.make_automaton()
        return found

    def __getstate__(self):
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve}

    def matches(self, folded: str) -> list[tuple[int, int, float]]:
        """Word begun at, end and weight of the heaviest pattern of each matched word, outside
        exception phrases."""
        if not self.weights:
            return []
        best: dict[int, tuple[int, float]] = {}
        excused: list[tuple[int, int]] = []
        for end, (pattern, weight) in self.automaton.iter(folded):
            begin = end - len(pattern) + 1
            if weight is None:
                excused.append((begin, end))
            elif begin not in best or weight > best[begin][1]:
                best[begin] = (end, weight)
        # both by place: a match is excused if a phrase that begins before it or with it ends behind its begin
        excused.sort()
        out, at, reach = [], 0, -1
        for a in sorted(best):
            while at < len(excused) and excused[at][0] <= a:
                reach, at = max(reach, excused[at][1]), at + 1
            if a >= reach:
                out.append((a, *best[a]))
        return out

    def features(self, folded: str) -> tuple[float, float]:
        """Summed weights, and the same for a thousand characters, both as logarithms."""
        total = sum(w for _, _, w in self.matches(folded))
        return math.log1p(total), math.log1p(1000 * total / (len(folded) + 200))

    def score(self, text: str) -> float:
        a, b = self.features(fold(text))
        z = self.curve[0] + self.curve[1] * a + self.curve[2] * b
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        yield pa.record_batch([pa.array(list(map(fold, batch.column(0).to_pylist())), pa.string()), batch.column(1)], ["text", "label"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents of the partition each pattern is."""
    toxic, clean = Counter(), Counter()

    def out():
        names = list(toxic.keys() | clean.keys())
        return pa.record_batch([pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([clean[x] for x in names], pa.int64())], ["pattern", "toxic", "clean"])

    for batch in chunks(batches):
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = set(text.split())
            found = {f" {w[:n]}" for w in words for n in STEMS if len(w) > n} | {f" {w} " for w in words}
            (toxic if label else clean).update(found)
        if len(toxic) + len(clean) > 1_000_000:
            yield out()
            toxic.clear(), clean.clear()
    if toxic or clean:
        yield out()


def _contexts(patterns: frozenset[str]):
    """The patterns' occurrences by a hash of the words before and after: copies and near copies
    of a document repeat contexts, so distinct contexts count what they would inflate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = set()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = text.split()
                for i, w in enumerate(words):
                    hit = [p for p in (f" {w[:n]}" for n in STEMS if len(w) > n) if p in patterns] + ([f" {w} "] if f" {w} " in patterns else [])
                    if hit:
                        near = zlib.crc32(f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}".encode())
                        found |= {(p, near, label) for p in hit}
            rows = list(found)
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())], ["pattern", "near", "label"])

    return run


def _select(counts, toxic_rows: int, clean_rows: int) -> dict[str, float]:
    """Significant patterns, shortest first; a longer one stays only if it says more."""
    t, c = counts["toxic"].to_numpy(float), counts["clean"].to_numpy(float)
    share = toxic_rows / max(1, toxic_rows + clean_rows)
    n = t + c
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(t > 0, t * np.log(t / (n * share)), 0) + np.where(c > 0, c * np.log(c / (n * (1 - share))), 0))
    odds = np.log((t + 0.5) / (toxic_rows + 1)) - np.log((c + 0.5) / (clean_rows + 1))
    good = (g >= EVIDENCE) & (odds >= ODDS)
    rows = list(zip(counts["pattern"].to_numpy()[good], odds[good], strict=True))
    weights: dict[str, float] = {}
    for pattern, weight in sorted(rows, key=lambda r: (len(r[0].rstrip()), r[0])):
        shorter = [weights[pattern[:k]] for k in range(2, len(pattern)) if pattern[:k] in weights]
        if not shorter or weight > max(shorter) + 1.0:
            weights[str(pattern)] = float(weight)
    return weights


def _phrases(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded, found = text, set()
                for a, _, _ in lexicon.matches(folded):
                    stop = folded.index(" ", a + 1)
                    after = folded.find(" ", stop + 1)
                    before = folded.rfind(" ", 0, a) if a else -1
                    found |= ({folded[before : stop + 1]} if before >= 0 else set()) | ({folded[a : after + 1]} if after >= 0 else set())
                rows += [(x, int(bool(label)), int(not label)) for x in found]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())], ["pattern", "toxic", "clean"])

    return run


def _features(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            rows = [lexicon.features(t) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()), batch.column(1)], ["a", "b", "label"])

    return run


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    """Newton's method with a small ridge."""
    x = np.column_stack([np.ones(len(x)), x])
    weight = np.ones(len(y))
    beta = np.zeros(x.shape[1])
    ridge = penalty * len(y) * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS, exceptions: frozenset[str] = frozenset()) -> Lexicon:
    """The lexicon of labelled rows; `exceptions` are phrases to excuse besides learned ones."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    # bounded by max_rows, so small enough to broadcast
    some = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    text = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    # folded once; what is counted below comes from these rows only, so max_rows bounds it
    rows = materialize(text.join(F.broadcast(some), "_id").select("text", "label").mapInArrow(_folded, "text string, label int"), "labelled")
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not size.get(1) or not size.get(0):
        return Lexicon()
    counts = rows.mapInArrow(_candidates, "pattern string, toxic bigint, clean bigint").groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # what few toxic documents have can't be significant
    strong = counts.filter((F.col("toxic") >= 3) & (F.col("toxic") * size[0] > F.col("clean") * size[1] * 8))
    patterns = frozenset(r["pattern"] for r in strong.select("pattern").collect())
    near = rows.mapInArrow(_contexts(patterns), "pattern string, near bigint, label int").distinct()
    apart = near.groupBy("pattern").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    lexicon = Lexicon(_select(apart.toPandas(), size[1], size[0]))
    around = rows.mapInArrow(_phrases(lexicon), "pattern string, toxic bigint, clean bigint").groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    excused = around.filter("clean >= 3 and toxic = 0").collect()
    lexicon = Lexicon(lexicon.weights, frozenset(r["pattern"] for r in excused) | frozenset(fold(x) for x in exceptions))
    got = rows.mapInArrow(_features(lexicon), "a double, b double, label int").toPandas()
    beta = _logistic(got[["a", "b"]].to_numpy(float), got["label"].to_numpy(float))
    lexicon.curve = tuple(float(x) for x in beta)
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, *, text_col: str = "text") -> DataFrame:
    """docs with `score` and `predicted`."""
    kept = docs.drop("score", "predicted")
    at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = [lexicon.score(str(t) if t is not None else "") for t in batch.column(at).to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"])

    out = kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())]))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def op6_toxic_lexicon(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the rows that aren't held out."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    lexicon = learn(docs, labels.filter(~held_out()))
    return score(docs, lexicon).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
