"""Operator 12, filter interaction audit: truth-table survival words and carry-save positional popcounts.

1. *Marks.* One pass over the texts gives each row the filters that it fails by itself (A to D) and a
   128-bit digest of its text. No text is shuffled.
2. *Copies (E).* Rows are counted per (text, part, labels, id) and then per (text, part, labels), each time combined before the
   shuffle, so that a text that a third of all rows share is a few rows per task. A row fails E if its
   text also has a smaller id anywhere in the table.
3. *Words.* The filters that a row fails become a 32-bit truth table: bit ``S`` is set if the row survives
   every filter of the subset ``S``. A word that stands for ``n`` rows enters the planes of n's binary digits.
4. *Popcounts.* Each plane is reduced three words at a time by carry-save adders (sum word, carry word of the
   next plane) until two are left; the planes' bits are the survivors of all 32 subsets, per part and
   label. Tasks give 32 numbers per part and label, which Spark adds.
5. *Orders.* Every column of the 600 rows of a part is a difference of subset survivors.

Defined cases: null text counts as empty, null ``lang`` as part ``''``; a row without an id never fails
E, makes no other row fail it and has no labels; rows that share an id are counted one by one, and none makes the other
fail E; several labels of one id count as their maximum; an empty table has no parts and no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.shared import shared_path

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITALS_PERCENT = 3
MARKS = b"#$%&*|"
_CAPITALS = bytes(range(65, 91))
_COPY = 1 << FILTERS.index("E")

#: The survival word of every set of failed filters.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)


def failed(text: bytes, chars: int) -> int:
    """The filters A to D that a text fails, as a bit set; ``bytes.split`` splits at the six ASCII blanks."""
    words = text.split()
    n = len(words)
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    marks = len(text) != len(text.translate(None, MARKS))
    return (n < MIN_WORDS) | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1 | (100 * capitals > CAPITALS_PERCENT * chars) << 2 | marks << 3


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
        chars = pc.utf8_length(text).to_pylist()
        bits, keys = [], []
        for value, n in zip(text.cast(pa.large_binary()), chars, strict=True):
            raw = value.as_py()
            bits.append(failed(raw, n))
            keys.append(hashlib.blake2b(raw, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), pa.array(keys, pa.binary()), pa.array(bits, pa.int32())], ["id", "part", "text_key", "bits"])


def marked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``id, part, text_key, bits`` of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_marked, "id long, part string, text_key binary, bits int")


def with_copies(rows: DataFrame) -> DataFrame:
    """``part, good, toxic, failed, n``: rows of ``marked`` (with labels) by failed filters, copies included."""
    kind = ["text_key", "bits", "part", "good", "toxic"]
    by_id = rows.groupBy(*kind, "id").agg(F.count("*").alias("n"))
    total = by_id.groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min("id").alias("first"),
        F.min_by("n", "id").alias("at_first"),
    )
    least = F.min("first").over(Window.partitionBy("text_key"))
    stay = total.withColumn("stay", F.col("no_id") + F.when(F.col("first") == least, F.col("at_first")).otherwise(0))
    both = F.array(F.struct(F.col("bits").alias("failed"), F.col("stay").alias("n")), F.struct(F.col("bits").bitwiseOR(F.lit(_COPY)).alias("failed"), (F.col("n") - F.col("stay")).alias("n")))
    return stay.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "good", "toxic", "x.failed", "x.n").where("n > 0")


def positional(words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per bit position the summed weights of the words that have it, by carry-save addition."""
    out, planes = np.zeros(32, np.int64), []
    for b in range(int(weights.max(initial=0)).bit_length()):
        planes.append([words[(weights >> b) & 1 == 1]])
    b = 0
    while b < len(planes):
        plane = np.concatenate(planes[b])
        carries = []
        while len(plane) > 2:
            k = len(plane) // 3
            x, y, z = plane[:k], plane[k : 2 * k], plane[2 * k : 3 * k]
            half = x ^ y
            carries.append((x & y) | (half & z))
            plane = np.concatenate([half ^ z, plane[3 * k :]])
        if carries:
            if b + 1 == len(planes):
                planes.append([])
            planes[b + 1] += carries
        out += ((plane[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)).sum(axis=0, dtype=np.int64) << b
        b += 1
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pc.dictionary_encode(batch.column("part"))
        code = part.indices.to_numpy(zero_copy_only=False) * 4 + batch.column("good").to_numpy(zero_copy_only=False) * 2 + batch.column("toxic").to_numpy(zero_copy_only=False)
        words = WORDS[batch.column("failed").to_numpy()]
        weights = batch.column("n").to_numpy()
        by = np.argsort(code, kind="stable")
        edges = np.flatnonzero(np.diff(code[by], prepend=-1, append=-1))
        kinds = [int(code[by[lo]]) for lo in edges[:-1]]
        counts = [positional(words[by[lo:hi]], weights[by[lo:hi]]) for lo, hi in zip(edges[:-1], edges[1:], strict=True)]
        names = [part.dictionary[k // 4].as_py() for k in kinds]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x for x in names for _ in range(SUBSETS)], pa.string()),
                pa.array(np.repeat([k & 2 > 0 for k in kinds], SUBSETS)),
                pa.array(np.repeat([k & 1 > 0 for k in kinds], SUBSETS)),
                pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(kinds))),
                pa.array(np.concatenate(counts)),
            ],
            ["part", "good", "toxic", "subset", "n"],
        )


def survivors(rows: DataFrame) -> DataFrame:
    """``part, subset, n, good, toxic``: rows that survive each of the 32 subsets, and of those the labelled ones."""
    counted = rows.mapInArrow(_counted, "part string, good boolean, toxic boolean, subset int, n long")
    of = lambda label: F.sum(F.when(F.col(label), F.col("n")).otherwise(0))
    return counted.groupBy("part", "subset").agg(F.sum("n").alias("n"), of("good").alias("good_n"), of("toxic").alias("toxic_n"))


def _steps() -> list[dict]:
    out = []
    for order in permutations(FILTERS):
        before = 0
        for k, name in enumerate(order):
            own = 1 << FILTERS.index(name)
            out.append({"filter_order": "".join(order), "step": k + 1, "before": before, "own": own})
            before |= own
    return out


def orders(counts: DataFrame) -> DataFrame:
    """The 600 rows of every part, from its ``survivors``."""
    table = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", F.struct("n", "good_n", "toxic_n")))).alias("left"))
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order:string,step:int,before:int,own:int>>")
    rows = table.select("part", "left", F.explode(steps).alias("s")).select("part", "left", "s.*")
    left = lambda subset, what="n": F.element_at("left", subset)[what]
    after: Column = F.col("before").bitwiseOR(F.col("own"))
    others: Column = F.lit(SUBSETS - 1) - F.col("own")
    lost = lambda what: left(F.col("before"), what) - left(after, what)
    rows = rows.withColumn("removed", lost("n"))
    return rows.select(
        "part",
        "filter_order",
        "step",
        left(after).alias("kept"),
        "removed",
        (left(F.lit(0)) - left(F.col("own")) - F.col("removed")).alias("redundant"),
        (left(others) - left(F.lit(SUBSETS - 1))).alias("unique_fails"),
        lost("good_n").alias("good_lost"),
        lost("toxic_n").alias("toxic_lost"),
        F.sum("removed").over(Window.partitionBy("part", "own")).alias("shapley"),
    )


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of ``docs`` with ``labels (doc_id, quality, toxic)``."""
    path = shared_path(spark, f"filter_audit/{uuid.uuid4().hex}")
    marked(docs).write.parquet(path)
    rows = spark.read.parquet(path)
    known = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")).where("id is not null")
    known = known.groupBy("id").agg(*[F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("good", "toxic")])
    no = F.lit(False)
    named = rows.where("id is not null").join(known, "id", "left").withColumns({c: F.coalesce(F.col(c), no) for c in ("good", "toxic")})
    nameless = rows.where("id is null").withColumns({"good": no, "toxic": no})
    return orders(survivors(with_copies(named.unionByName(nameless))))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table with its ``labels``."""
    return audit(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _oracle() -> str:
    steps = ", ".join(f"('{s['filter_order']}', {s['step']}, {s['before']}, {s['own']})" for s in _steps())
    return f"""
WITH known AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
texts AS (
  SELECT d.doc_id, coalesce(d.lang, '') AS part, coalesce(d.text, '') AS t, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
         regexp_extract_all(coalesce(d.text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents d LEFT JOIN known k USING (doc_id)),
marks AS (
  SELECT part, good, toxic,
         CASE WHEN len(words) < {MIN_WORDS} THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITALS_PERCENT} * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS f
  FROM texts),
tally AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marks GROUP BY part, f),
steps(filter_order, step, before, own) AS (VALUES {steps}),
cells AS (
  SELECT part, filter_order, step, own,
    CAST(sum(CASE WHEN f & (before | own) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN f & before = 0 AND f & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN f & before <> 0 AND f & own <> 0 THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN f = own THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN f & before = 0 AND f & own <> 0 THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN f & before = 0 AND f & own <> 0 THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM tally, steps GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM cells
"""


OP12_SQL = _oracle()
