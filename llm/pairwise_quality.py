"""Operator 3, quality classifier: Bradley-Terry ranking from preference pairs.

1. *Features.* Each whole text becomes a short vector of shape statistics (word counts, symbols,
   capitals, repetition, line and punctuation shares); labels, language, source and id take no part.
2. *Pairs.* From at most ``MAX_LABELLED`` labelled documents (those with the smallest hash of their id;
   the bound is a parameter), every document of the rarer label is preferred to, or by, ``PAIRS`` others.
   The chance that ``a`` is preferred to ``b`` is the logistic function of ``w . (a - b)``; ``w`` minimises
   the logistic loss over the pairs with a ridge term, by Newton steps.
3. *Threshold.* The scores of the labelled documents are cut at the quantile that leaves the share of
   label 1 above. Scores are shifted and squashed so that this cut is ``THRESHOLD``.

Only the bounded sample reaches the driver, as vectors. Scoring is local to each document, without a
shuffle; the whole model is a few numbers.

Defined cases: null and empty texts have a vector of zeros and a score like any other; rows without an
id are scored and never held out; several labels of one id count as their minimum; without labels of
both kinds every score is ``THRESHOLD``; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import textcore as tc

MAX_LABELLED = 20_000
PAIRS = 8
RIDGE = 1e-3
THRESHOLD = 0.7
HELD_OUT, FOLDS = 2, 4
SLICE_BYTES = 1 << 20
FEATURES = 16


def _class(members: str | bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members if isinstance(members, bytes) else members.encode())] = True
    return out


_SYMBOL, _BANG, _DIGIT, _STOP = _class("#*$%&|<>~^_=+{}[]\\"), _class("!"), _class("0123456789"), _class(".,;:?")
_UPPER, _LOWER = _class(bytes(range(65, 91))), _class(bytes(range(97, 123)))


def _sum(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[off[1:]] - total[off[:-1]]).astype(float)


def _repeats(key: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: entries, and entries that also stand elsewhere in it (all but one of each)."""
    own = np.bincount(doc, minlength=docs).astype(float)
    by = np.lexsort((key, doc))
    same = (key[by][1:] == key[by][:-1]) & (doc[by][1:] == doc[by][:-1])
    return own, np.bincount(doc[by][1:][same], minlength=docs).astype(float)


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` numbers per document."""
    docs = len(off) - 1
    words = tc.Words(buf, off)
    n = words.count().astype(float)
    doc = words.doc()
    at_least_one = np.maximum(n, 1)
    _, again = _repeats(words.hash, doc, docs)
    gram = tc.shingles(words.hash, 3)
    inside = np.flatnonzero(doc[: len(gram)] == doc[2 : 2 + len(gram)]) if len(gram) else np.zeros(0, np.int64)
    grams, grams_again = _repeats(gram[inside], doc[inside], docs)
    line_doc, line = words.lines()
    lines, lines_again = _repeats(line, line_doc, docs)
    run = np.zeros(len(doc), bool)
    run[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    last = buf[words.end - 1] if len(doc) else np.zeros(0, np.uint8)
    ends_odd = _sum(_SYMBOL[last] | _BANG[last], words.first)
    bare = _sum((words.end - words.start == 1) & _SYMBOL[last], words.first)
    length = _sum((words.end - words.start).astype(np.int64), words.first) / at_least_one
    upper, lower = _sum(_UPPER[buf], off), _sum(_LOWER[buf], off)
    columns = [
        np.log1p(n), np.minimum(n, 50) / 50, np.minimum(_sum(_SYMBOL[buf], off) / at_least_one, 1), upper / np.maximum(upper + lower, 1),
        np.minimum(upper / np.maximum(upper + lower, 1) * 3, 1), again / at_least_one, grams_again / np.maximum(grams, 1), np.minimum(grams_again / np.maximum(grams, 1) * 5, 1),
        lines_again / np.maximum(lines, 1), np.minimum(_sum(_BANG[buf], off) / at_least_one, 1), np.minimum(length, 20) / 20, np.minimum(_sum(_STOP[buf], off) / at_least_one, 1),
        np.minimum(_sum(_DIGIT[buf], off) / at_least_one, 1), _sum(run, words.first) / at_least_one, ends_odd / at_least_one, bare / at_least_one,
    ]
    return np.where((n > 0)[:, None], np.stack(columns, axis=1), 0.0)


def vectors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, x): the feature vector of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = tc.flat(batch.column(1))
            for lo, hi in tc.slices(off, SLICE_BYTES):
                x = features(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * FEATURES, pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), flat], names=["doc_id", "x"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, x array<double>")


class Ranker:
    """Weights of the pairwise logistic loss, and the shift that puts the score quantile at the threshold."""

    def __init__(self, x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, threshold: float = THRESHOLD):
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.weight, self.cut, self.threshold = np.zeros(FEATURES), 0.0, threshold
        good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        if not len(good) or not len(bad):
            return
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = (x - self.mean) / self.scale
        few, many = (bad, good) if len(bad) <= len(good) else (good, bad)
        take = np.random.default_rng(7).integers(0, len(many), (len(few), pairs))
        difference = z[many[take]] - z[few][:, None, :]
        d = (difference if few is bad else -difference).reshape(-1, FEATURES)
        for _ in range(50):
            chance = 1 / (1 + np.exp(np.clip(d @ self.weight, -30, 30)))
            slope = -(d.T @ chance) / len(d) + ridge * self.weight
            bend = (d * (chance * (1 - chance))[:, None]).T @ d / len(d) + ridge * np.eye(FEATURES)
            step = np.linalg.solve(bend, slope)
            self.weight -= step
            if np.abs(step).max() < 1e-8:
                break
        # the lowest scores, as many as have label 0, go below the threshold
        order = np.sort(z @ self.weight)
        self.cut = float((order[len(bad) - 1] + order[min(len(bad), len(order) - 1)]) / 2)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.cut + shift, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> Ranker:
    """Learn from at most ``max_labelled`` labelled rows of ``docs``."""
    known = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label")).where("_id is not null and _label in (0, 1)").groupBy("_id").agg(F.min("_label").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    some = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(sample), "_id", "left_semi")
    rows = vectors(some, "_id", "_text").withColumnRenamed("doc_id", "_id").dropDuplicates(["_id"]).join(sample, "_id").orderBy("_id").select("_label", "x").toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(-1, FEATURES) if rows.num_rows else np.zeros((0, FEATURES))
    return Ranker(x, rows.column("_label").to_numpy())


def score(spark: SparkSession, docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shipped = spark.sparkContext.broadcast(ranker)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shipped.value.score(x))], names=["doc_id", "score"])

    return vectors(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double")


def op3_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table; labels of held-out ids are not read for learning."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))
    ranker = fit(docs, labels.where(~held_out))
    out = score(spark, docs, ranker)
    return out.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
