"""Operator 6, quality rules: n-gram perplexity bands per language.

1. *Base rules* of each text: too few words, or too many words in repeated 3-word windows.
2. *Counting.* Spark counts the byte n-grams of every document that reads as prose (base rules, few
   symbols, not mostly capitals), per language. A task sends each distinct n-gram once, with its count.
3. *Model.* Interpolated modified Kneser-Ney (three discounts per order from the counts of counts,
   continuation counts below the highest order), as Spark aggregates and joins over all counted n-grams. It is
   written in key order, a folder per language: packed n-grams with log probabilities, and contexts with log backoff weights.
4. *Bands.* Every document, whether counted or not, gets the perplexity per byte of its whole text
   under its language's model. A document is kept if it lies between ``lower`` and ``upper`` times
   the median perplexity of its language's counted documents.

The counts are sums with map-side combination, so that a hot source or language is no hot task; a
context has at most 256 successors, so that no join has a hot key. Nothing of the model passes through the
driver, and no n-gram is left out. A scoring task reads the sorted arrays of the languages that
it meets from the shared folder (16 bytes per n-gram, at most ``HELD`` languages at a time). Scores
are written to the shared folder once; the medians are read from there.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``; null or empty text has no words and fails the base
rules; a null ``lang`` is a language of its own, and a language without counted documents rejects
nothing by perplexity; repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import textcore as tc
from llm.shared import shared_path

ORDER = 4
HELD = 8
SLICE_BYTES = 1 << 20
#: A document is counted if it has at most this many symbols and capital letters per hundred.
MAX_SYMBOLS_PER_100_WORDS = 5
MAX_CAPITALS_PER_100_LETTERS = 30
LOWER, UPPER = 0.5, 2.0
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[list(range(65, 91))] = True
_LOWER = np.zeros(256, bool)
_LOWER[list(range(97, 123))] = True
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, prose boolean"


def _per_doc(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]


def base_rules(buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The columns of ``BASE`` for a run of documents."""
    docs = len(off) - 1
    words = tc.Words(buf, off)
    n_words = words.count()
    head = (buf & 0xC0) != 0x80  # the first byte of a code point; delimiters are single bytes
    points = np.append(0, np.cumsum(head, dtype=np.int64))
    chars = np.append(0, np.cumsum(points[words.end] - points[words.start]))
    word_chars = chars[words.first[1:]] - chars[words.first[:-1]]
    line_doc, line = words.lines()
    order = np.lexsort((line, line_doc))
    same = (line[order][1:] == line[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
    n_dup_lines = np.bincount(line_doc[order][1:][same], minlength=docs)
    repeat = np.zeros(len(words.start), bool)
    gram = tc.shingles(words.hash, 3)
    if len(gram):
        doc = words.doc()
        inside = np.flatnonzero(doc[: len(gram)] == doc[2 : 2 + len(gram)])
        key = gram[inside] ^ tc.mix(doc[inside].astype(tc.U64) + tc.U64(1))
        order = np.argsort(key, kind="stable")
        eq = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][eq]] = True
        twice[order[:-1][eq]] = True
        at = inside[twice]
        for k in range(3):
            repeat[at + k] = True
    n_repeat = _per_doc(repeat, words.first)
    n_symbols = _per_doc(_SYMBOLS[buf], off)
    capitals, small = _per_doc(_UPPER[buf], off), _per_doc(_LOWER[buf], off)
    failed = (n_words < 50) | (100 * n_repeat > 50 * n_words)
    prose = ~failed & (100 * n_symbols <= MAX_SYMBOLS_PER_100_WORDS * n_words) & (100 * capitals <= MAX_CAPITALS_PER_100_LETTERS * (capitals + small))
    return [n_words, word_chars, n_symbols, n_dup_lines, n_repeat, failed, prose]


def grams(buf: np.ndarray, off: np.ndarray, order: int) -> np.ndarray:
    """Each byte packed with the ``order - 1`` before it (zeros before the text), the newest lowest."""
    size = np.diff(off)
    place = np.arange(len(buf)) + np.repeat((np.arange(len(size)) + 1) * (order - 1), size)
    padded = np.zeros(len(buf) + len(size) * (order - 1), np.uint8)
    padded[place] = buf
    out = np.zeros(len(buf), tc.U64)
    for k in range(order - 1, -1, -1):
        out = (out << tc.U64(8)) | padded[place - k]
    return out


def _distinct(keys: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weight is None:
        keys = np.sort(keys)
        head = np.flatnonzero(tc.heads(keys))
        return keys[head], np.diff(np.append(head, len(keys)))
    order = np.argsort(keys, kind="stable")
    head = np.flatnonzero(tc.heads(keys[order]))
    return keys[order][head], np.add.reduceat(weight[order], head) if len(head) else weight[:0]


def _languages(column: pa.Array) -> tuple[list, np.ndarray]:
    coded = column.dictionary_encode(null_encoding="encode")
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)


def count_grams(docs: DataFrame, text_col: str, lang_col: str, order: int) -> DataFrame:
    """(lang, gram, n) over the prose documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def add(lang, keys: np.ndarray, n: np.ndarray) -> None:
            old = held.get(lang)
            if old is not None:
                keys, n = _distinct(np.concatenate([old[0], keys]), np.concatenate([old[1], n]))
            held[lang] = (keys, n)

        for batch in batches:
            names, index = _languages(batch.column(0))
            buf, off = tc.flat(batch.column(1))
            for lo, hi in tc.slices(off, SLICE_BYTES):
                part, rel = buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                prose = base_rules(part, rel)[-1]
                every, own = grams(part, rel, order), np.repeat(np.where(prose, index[lo:hi], -1), np.diff(rel))
                for k, name in enumerate(names):
                    mine = every[own == k]
                    if len(mine):
                        add(name, *_distinct(mine))
        for lang, (keys, n) in held.items():
            for lo in range(0, len(keys), 100_000):
                k = keys[lo : lo + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k.astype(np.int64)), pa.array(n[lo : lo + 100_000].astype(np.int64))], names=["lang", "gram", "n"])

    plain = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _clipped(value: Column, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(0.05)), F.lit(high))


def write_model(spark: SparkSession, counts: DataFrame, order: int, base: str) -> str:
    """Smooth ``counts (lang, gram, n)`` into sorted ``kind, k, key, value`` rows, a folder per language; their folder.

    Kind 0 holds the log probability of every packed ``k``-gram, kind 1 the log backoff weight of every
    context of ``k - 1`` bytes.
    """

    def stored(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    levels = [counts.select(model_name(F.col("lang")).alias("model"), F.lit(order).alias("k"), "gram", "n")]
    for k in range(order - 1, 0, -1):  # continuation counts: the distinct longer n-grams that end so
        low = F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1))
        levels.append(stored(levels[-1].groupBy("model", F.lit(k).alias("k"), low.alias("gram")).agg(F.count("*").alias("n")), f"level{k}"))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    n1, n2, n3, n4 = (F.greatest(F.count_if(F.col("n") == c), F.lit(1)) for c in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    discounts = every.groupBy("model", "k").agg(_clipped(1 - 2 * y * n2 / n1, 0.95).alias("d1"), _clipped(2 - 3 * y * n3 / n2, 1.9).alias("d2"), _clipped(3 - 4 * y * n4 / n3, 2.9).alias("d3"))
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    # one row per language and order: no exchange of the n-grams by so few keys
    less = every.join(F.broadcast(discounts), ["model", "k"]).select("model", "k", "gram", F.shiftright("gram", 8).alias("context"), "n", discount.alias("discount"))
    context = stored(less.groupBy("model", "k", "context").agg(F.sum("n").alias("total"), (F.sum("discount") / F.sum("n")).alias("weight")), "contexts")
    terms = less.join(context, ["model", "k", "context"])
    terms = stored(terms.select("model", "k", "gram", ((F.col("n") - F.col("discount")) / F.col("total")).alias("own"), "weight"), "terms")
    lower, rows = None, context.select("model", F.lit(1).alias("kind"), "k", F.col("context").alias("key"), F.log(F.greatest("weight", F.lit(1e-12))).alias("value"))
    for k in range(1, order + 1):
        term = terms.where(F.col("k") == k)
        if lower is None:
            own = term.select("model", "gram", (F.col("own") + F.col("weight") / 256).alias("p"))
        else:  # the shorter n-gram of a counted one is counted
            suffix = term.withColumn("suffix", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)))
            own = suffix.join(lower.select("model", F.col("gram").alias("suffix"), "p"), ["model", "suffix"]).select("model", "gram", (F.col("own") + F.col("weight") * F.col("p")).alias("p"))
        lower = stored(own, f"p{k}")
        rows = rows.unionByName(lower.select("model", F.lit(0).alias("kind"), F.lit(k).alias("k"), F.col("gram").alias("key"), F.log("p").alias("value")))
    keys = ["model", "kind", "k", "key"]
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("model").parquet(f"{base}/model")
    return f"{base}/model"


def model_name(lang: Column) -> Column:
    """The folder of a language's model (null is one as well)."""
    return F.lower(F.hex(F.xxhash64(F.coalesce(F.concat(F.lit("="), lang), F.lit("")))))


class KneserNey:
    """One language's model: per order the sorted grams with log probabilities, and contexts with backoffs."""

    def __init__(self, table: pa.Table, order: int):
        self.order = order
        kind, k, key, value = (table.column(c).to_numpy() for c in ("kind", "k", "key", "value"))
        by = np.lexsort((key, k, kind)) if len(key) and (np.diff(key) < 0).sum() > 2 * order else slice(None)
        kind, k, key, value = kind[by], k[by], key[by].astype(tc.U64), value[by]
        part = lambda a, b: slice(*np.searchsorted(kind * (order + 1) + k, [a * (order + 1) + b, a * (order + 1) + b + 1]))
        self.grams = [np.zeros(1, tc.U64), *(key[part(0, n)] for n in range(1, order + 1))]
        self.logp = [np.full(1, -math.log(256)), *(value[part(0, n)] for n in range(1, order + 1))]
        self.contexts = [key[part(1, n)] for n in range(1, order + 1)]
        self.backoff = [value[part(1, n)] for n in range(1, order + 1)]

    def _log(self, k: int, gram: np.ndarray) -> np.ndarray:
        """Log probability of the last byte of packed ``k``-grams, backing off where one is unknown."""
        if k == 0:
            return np.full(len(gram), self.logp[0][0])
        at = np.minimum(np.searchsorted(self.grams[k], gram), len(self.grams[k]) - 1)
        out = self.logp[k][at]
        miss = np.flatnonzero(self.grams[k][at] != gram)
        if len(miss):
            lost = gram[miss]
            context, own = self.contexts[k - 1], lost >> tc.U64(8)
            at = np.minimum(np.searchsorted(context, own), len(context) - 1)
            weight = np.where(context[at] == own, self.backoff[k - 1][at], 0.0)
            out[miss] = weight + self._log(k - 1, lost & tc.U64((1 << 8 * (k - 1)) - 1))
        return out

    def mean_loss(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean negative log probability per byte of each text (0 for an empty one)."""
        loss = -self._log(self.order, grams(buf, off, self.order))
        total = np.append(0.0, np.cumsum(loss))
        return (total[off[1:]] - total[off[:-1]]) / np.maximum(np.diff(off), 1)


@lru_cache(HELD)
def load_model(folder: str, name: str, order: int) -> KneserNey | None:
    """A language's model from its files, in the order of their names; None if it has none."""
    system, root = fs.FileSystem.from_uri(folder)
    files = system.get_file_info(fs.FileSelector(f"{root}/model={name}", allow_not_found=True))
    paths = sorted(f.path for f in files if f.base_name.startswith("part-"))
    tables = [pq.ParquetFile(system.open_input_file(p)).read(["kind", "k", "key", "value"]) for p in paths]
    return KneserNey(pa.concat_tables(tables), order) if tables else None


def score(docs: DataFrame, folder: str, order: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Per row: ``doc_id, lang``, the columns of ``BASE`` and ``loss`` (null without a model)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, index = _languages(batch.column(3))
            buf, off = tc.flat(batch.column(2))
            for lo, hi in tc.slices(off, SLICE_BYTES):
                part, rel = buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                loss = np.full(hi - lo, np.nan)
                for k, name in enumerate(names):
                    rows = np.flatnonzero(index[lo:hi] == k)
                    model = load_model(folder, name, order) if len(rows) else None
                    if model is not None:
                        size = np.diff(rel)[rows]
                        own = part[tc.expand(rel[rows], rel[rows] + size)]
                        loss[rows] = model.mean_loss(own, np.append(0, np.cumsum(size)))
                columns = [pa.array(c) for c in base_rules(part, rel)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *columns, pa.array(loss, mask=np.isnan(loss))], schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("prose", pa.bool_()), ("loss", pa.float64())])
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), model_name(F.col(lang_col).cast("string")).alias("model"))
    return plain.mapInArrow(run, f"doc_id bigint, lang string, {BASE}, loss double")


def quality_rules(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """Per row: ``doc_id, lang``, base measures, ``perplexity, low, high, kept``."""
    base = shared_path(spark, f"perplexity/{uuid.uuid4().hex}")
    counts_path, scores_path = f"{base}/counts", f"{base}/scores"
    count_grams(docs, text_col, lang_col, order).write.parquet(counts_path)
    folder = write_model(spark, spark.read.parquet(counts_path), order, base)
    score(docs, folder, order, id_col, text_col, lang_col).write.parquet(scores_path)
    scores = spark.read.parquet(scores_path)
    middle = scores.where("prose").groupBy(F.col("lang").alias("_lang")).agg(F.percentile_approx("loss", 0.5, 10_000).alias("_middle"))
    # one row per language that has a model
    joined = scores.join(F.broadcast(middle), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    perplexity = F.exp("loss")
    low, high = F.exp("_middle") * lower, F.exp("_middle") * upper
    inside = F.coalesce((perplexity >= low) & (perplexity <= high), F.lit(True))
    return joined.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"), perplexity.alias("perplexity"), low.alias("low"), high.alias("high"))


def op6_perplexity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    out = quality_rules(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "perplexity")
