"""Operator 13, hard-negative mining by threshold joins of quantised vectors, in the manner of L2AP.

A *window* asks for the ``k`` best rows of the anchor's label (or of any other) whose score lies between
``low`` and ``high``; scores are integer inner products. Positives are one window per anchor, without an
upper end; negatives are one window per positive.

1. *Blocks.* Rows and anchors are dealt into blocks of bounded size; every block of rows meets every block of
   anchors in a task of its own. Only rows that divide ``ANCHOR_EVERY`` are anchors (the stated query set).
2. *Join.* Dimensions are taken in the order of their second moment. A row's index entries begin where
   its prefix norm times the anchors' can reach the least threshold of the task; what lies before is
   covered by that bound and left out. Partial scores are added from the last chunk of
   dimensions on, and a pair goes as soon as its score so far plus the product of both remaining norms stays
   under the anchor's threshold. What is left is scored exactly, omitted dimensions included.
3. *Thresholds.* A window's threshold begins where about ``AIM`` times ``k`` rows are expected above it (from the
   mean and deviation of the anchor's scores against a sample of ``SAMPLE_ROWS`` rows). Windows that do not
   fill come again with a threshold that ``WIDEN`` times as many rows should pass, and at last with the window's own low end.
   A filled window is exact at any threshold: every row above it was met. The sample changes the work only.
   Tasks return ``k`` rows a window, which Spark ranks.

Defined cases: rows without an id, label or vector, or with a component that is null, NaN or infinite, take
no part; "other rows" are those with another id; equal rows count once as anchors and each for itself as
candidates; ties go to the smaller id; a missing component of a shorter vector counts as zero; an empty
vector scores 0; scores are exact up to 2**53; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.shared import shared_path

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
SCALE = 256
LOW_PERCENT, HIGH_PERCENT = 50, 95
SAMPLE_ROWS, SAMPLE_BYTES = 2048, 8 << 20
AIM, WIDEN, ROUNDS = 4, 16, 4
ROW_BLOCK, ANCHOR_BLOCK = 32_768, 8_192
TILE_ROWS, TILE_ANCHORS = 4_096, 256
CHUNKS = 8
SPARSE = 0.1


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Lists of numbers as rows of a matrix, short ones filled with zeros."""
    column = pa.chunked_array([column]) if isinstance(column, pa.Array) else column
    lists = [x for x in column.chunks if len(x)]
    size = np.concatenate([np.diff(x.offsets.to_numpy()) for x in lists] or [np.zeros(0, int)])
    flat = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in lists] or [np.zeros(0)])
    out = np.zeros((len(size), max(width, int(size.max(initial=0)))))
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def ordered(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Columns by ``order``; those that it does not name come first."""
    named = order[order < values.shape[1]]
    rest = np.setdiff1d(np.arange(values.shape[1]), named)
    return np.ascontiguousarray(values[:, np.concatenate([rest, named])])


class Index:
    """Rows of a tile with their prefix norms at the chunk borders."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.edge = np.linspace(0, values.shape[1], CHUNKS + 1).astype(int)
        square = np.concatenate([np.zeros((len(values), 1)), np.cumsum(values * values, axis=1)], axis=1)
        # rounded up, so that a bound is never too small
        self.norm = np.sqrt(square[:, self.edge]) * (1 + 1e-9)

    def split(self, most: np.ndarray, least: float) -> np.ndarray:
        """Per row the first chunk that is indexed: its prefix norms before cannot reach ``least``."""
        return CHUNKS - (self.norm[:, 1:] * most[1:] >= least).sum(axis=1)


def threshold_join(rows: Index, anchors: Index, theta: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the wanted pairs that score at least the anchor's ``theta``."""
    split = rows.split(anchors.norm.max(axis=0, initial=0), float(theta.min(initial=np.inf)))
    alive = wanted & (split < CHUNKS)
    score = np.zeros(alive.shape)
    need = theta[:, None] - 1e-6
    for c in range(CHUNKS - 1, -1, -1):
        if alive.sum() < SPARSE * alive.size:
            break
        lo, hi = rows.edge[c], rows.edge[c + 1]
        listed = np.flatnonzero(split <= c)
        score[:, listed] += anchors.values[:, lo:hi] @ rows.values[listed, lo:hi].T
        at = np.maximum(split, c)
        at[at == CHUNKS] = 0
        alive &= score + anchors.norm[:, at] * rows.norm[np.arange(len(at)), at] >= need
    else:
        c = -1
    i, j = np.nonzero(alive)
    s = score[i, j]
    done = np.maximum(c + 1, split[j])  # chunks from here on are in the score
    for k in range(CHUNKS - 1, -1, -1):
        todo = np.flatnonzero(done > k)
        if not len(todo):
            continue
        lo, hi = rows.edge[k], rows.edge[k + 1]
        s[todo] += np.einsum("pd,pd->p", anchors.values[i[todo], lo:hi], rows.values[j[todo], lo:hi])
        bound = anchors.norm[i, np.minimum(done, k)] * rows.norm[j, np.minimum(done, k)]
        stay = s + bound >= need[i, 0]
        i, j, s, done = i[stay], j[stay], s[stay], done[stay]
    stay = s >= theta[i]
    return i[stay], j[stay], s[stay]


def best(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first ``k`` of each group: higher scores first, then smaller ids."""
    by = np.lexsort((ids, -score, group))
    sorted_group = group[by]
    rank = np.arange(len(by)) - np.searchsorted(sorted_group, sorted_group)
    return by[rank < k]


def block_search(rows: pa.Table, asked: pa.Table, order: np.ndarray, same: bool, k: int) -> pa.Table:
    """The best ``k`` rows of each window of one block of anchors within one block of rows."""
    names = ["anchor", "w", "found_id", "score"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    if not rows.num_rows or not asked.num_rows:
        return pa.table([pa.array([], t) for t in kinds], names=names)
    x, a = matrix(rows["vec"]), matrix(asked["vec"])
    width = max(x.shape[1], a.shape[1])
    x, a = (ordered(np.pad(m, ((0, 0), (0, width - m.shape[1]))), order) for m in (x, a))
    ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
    key, own, own_label = asked["anchor"].to_numpy(), asked["vec_id"].to_numpy(), asked["label"].to_numpy()
    windows = asked["windows"].to_pylist()
    slots = max(len(w) for w in windows)
    low, high, name = (np.full((len(windows), slots), v) for v in (np.inf, -np.inf, -1))
    for n, ws in enumerate(windows):
        for m, w in enumerate(ws):
            low[n, m], high[n, m], name[n, m] = w["low"], w["high"], w["w"]
    theta = low.min(axis=1)
    found: list[list[np.ndarray]] = []
    for r in range(0, len(x), TILE_ROWS):
        tile = Index(x[r : r + TILE_ROWS])
        tile_ids, tile_labels = ids[r : r + TILE_ROWS], labels[r : r + TILE_ROWS]
        for q in range(0, len(a), TILE_ANCHORS):
            part = slice(q, q + TILE_ANCHORS)
            wanted = ((tile_labels == own_label[part, None]) == same) & (tile_ids != own[part, None])
            i, j, s = threshold_join(tile, Index(a[part]), theta[part], wanted)
            for m in range(slots):
                inside = np.flatnonzero((s >= low[i + q, m]) & (s <= high[i + q, m]))
                at = inside[best(i[inside], s[inside], tile_ids[j[inside]], k)]
                found.append([(i[at] + q) * slots + m, s[at], tile_ids[j[at]]])
    group, score, got = (np.concatenate(c) for c in zip(*found, strict=True))
    at = best(group, score, got, k)
    group = group[at]
    cols = [key[group // slots], name.ravel()[group].astype(np.int32), got[at], np.clip(score[at], -(2.0**63), 2.0**63 - 1024).astype(np.int64)]
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)


class Sample:
    """Bounded sample of the rows: the order of the dimensions, and where an anchor's thresholds begin."""

    def __init__(self, table: pa.Table, total: int):
        self.values, self.labels, self.total = matrix(table["vec"]), table["label"].to_numpy(), total
        self.order = np.argsort((self.values * self.values).sum(axis=0), kind="stable")

    def lows(self, vec: np.ndarray, label: int, same: bool, k: int, floor: float, high: float) -> list[float]:
        """Falling thresholds that end with the window's own low end."""
        width = min(len(vec), self.values.shape[1])
        score = (self.values[:, :width] @ vec[:width])[(self.labels == label) == same]
        out = []
        if len(score) > 1 and score.std() > 0:
            rows = self.total * len(score) / len(self.labels)
            normal = NormalDist(float(score.mean()), float(score.std()))
            above = 1 - normal.cdf(high) if np.isfinite(high) else 0.0
            for r in range(ROUNDS - 1):
                rest = above + AIM * k * WIDEN**r / rows
                if rest < 1 and (theta := float(np.ceil(normal.inv_cdf(1 - rest)))) > floor:
                    out.append(theta)
        return [*out, floor]


def _windows(sample: Sample, same: bool, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = matrix(batch.column("vec"))
            floor, high = batch.column("floor").to_numpy(), batch.column("high").to_numpy()
            lows = [sample.lows(vec[n], label, same, k, floor[n], high[n]) for n, label in enumerate(batch.column("label").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("anchor"), batch.column("w"), batch.column("high"), pa.array(lows, pa.list_(pa.float64()))], ["anchor", "w", "high", "lows"])

    return run


class Miner:
    """Searches windows over ``rows (vec_id, label, vec, deal)``; every round is a written table."""

    def __init__(self, spark: SparkSession, rows: DataFrame):
        self.spark = spark
        self.base = shared_path(spark, f"hard_negatives/{uuid.uuid4().hex}")
        self.rows = self.written(rows, "rows")
        self.count, width = self.rows.agg(F.count("*"), F.max(F.size("vec"))).first()
        size = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, width or 1))))
        self.sample = Sample(self.rows.select("vec", "label", F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(size).toArrow(), self.count)

    def written(self, table: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        schema = table.schema
        table.write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def search(self, anchors: DataFrame, windows: DataFrame, name: str, same: bool, k: int) -> DataFrame:
        """``anchor, w, found_id, score, rank`` for ``windows (anchor, w, floor, high)`` of ``anchors (anchor, vec_id, label, vec)``."""
        asked = windows.join(anchors.select("anchor", "label", "vec"), "anchor")
        pending = self.written(asked.mapInArrow(_windows(self.sample, same, k), "anchor long, w int, high double, lows array<double>"), f"{name}/windows")
        found = []
        for r in range(ROUNDS):
            left = pending.count()
            if not left:
                break
            low = F.element_at("lows", F.least(F.lit(r + 1), F.size("lows")))
            now = pending.groupBy("anchor").agg(F.collect_list(F.struct("w", low.alias("low"), "high")).alias("windows"))
            met = self.join(now.join(anchors, "anchor"), same, k)
            first = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "found_id")
            ranked = met.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            full = (F.max("rank").over(Window.partitionBy("anchor", "w")) == k) | (F.size("lows") <= r + 1)
            got = ranked.join(pending.select("anchor", "w", "lows"), ["anchor", "w"]).where("true").withColumn("full", full).where("full")
            found.append(self.written(got.select("anchor", "w", "found_id", "score", "rank"), f"{name}/found{r}"))
            rest = pending.where(F.size("lows") > r + 1).join(found[-1].select("anchor", "w").distinct(), ["anchor", "w"], "left_anti")
            pending = self.written(rest, f"{name}/pending{r}")
        empty = self.spark.createDataFrame([], "anchor long, w int, found_id long, score long, rank int")
        for table in found:
            empty = empty.unionByName(table)
        return empty

    def join(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        """Every block of rows with every block of anchors, each pair of blocks in one task."""
        most = self.spark.sparkContext.defaultParallelism
        row_blocks = max(-(-self.count // ROW_BLOCK), min(2 * most, -(-self.count // 2048)), 1)
        asked = self.written(asked, f"asked{uuid.uuid4().hex}")
        anchor_blocks = max(1, -(-asked.count() // ANCHOR_BLOCK))
        order = self.sample.order
        left = self.rows.select("vec_id", "label", "vec", F.pmod("deal", F.lit(row_blocks)).alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("ab"))
        right = asked.select("anchor", "vec_id", "label", "vec", "windows", F.pmod("anchor", F.lit(anchor_blocks)).cast("int").alias("ab"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("rb"))

        def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
            return block_search(rows, anchors, order, same, k)

        return left.groupBy("rb", "ab").cogroup(right.groupBy("rb", "ab")).applyInArrow(run, "anchor long, w int, found_id long, score long")


def quantised(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, vec, deal``: the rows that take part, relabelled, each component floored to 1/256."""
    vec = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), vec.alias("raw"))
    # NaN counts as larger than any number
    whole = F.forall("raw", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & whole)
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    # dealt once and written, so that rows of one id spread as well
    deal = F.xxhash64(F.monotonically_increasing_id())
    return rows.select("vec_id", moved.alias("label"), F.transform("raw", lambda x: F.floor(x * SCALE).cast("double")).alias("vec"), deal.alias("deal"))


def mine(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    miner = Miner(spark, quantised(embeddings))
    key = F.xxhash64("vec_id", "label", "vec").alias("anchor")
    anchors = miner.written(miner.rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).select(key, "vec_id", "label", "vec").dropDuplicates(["anchor", "vec_id"]), "anchors")
    infinite = F.lit(float("inf"))
    every = anchors.select("anchor", F.lit(0).alias("w"), (-infinite).alias("floor"), infinite.alias("high"))
    positives = miner.search(anchors, every, "positives", True, POSITIVES).select("anchor", F.col("rank").alias("w"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    positives = miner.written(positives, "positive_rows")
    p = F.col("positive_score")
    low = (F.floor(p / 2) + F.pmod(p, F.lit(2))).cast("double")  # the next integer from p / 2 on, for p >= 0
    high = ((p - F.pmod(p, F.lit(100))) / 100 * HIGH_PERCENT + F.floor(F.pmod(p, F.lit(100)) * HIGH_PERCENT / 100)).cast("double")
    asked = positives.where("positive_score >= 0").select("anchor", "w", low.alias("floor"), high.alias("high")).where("floor <= high")
    negatives = miner.search(anchors, asked, "negatives", False, NEGATIVES)
    named = positives.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return named.join(negatives, ["anchor", "w"]).select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``embeddings`` table."""
    return mine(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP13_SQL = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, r.label = a.label AS same,
         CAST(list_dot_product(a.vec, r.vec) AS BIGINT) AS score
  FROM rows a JOIN rows r ON r.vec_id <> a.vec_id WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
 AND {LOW_PERCENT} * p.positive_score <= 100 * n.score AND 100 * n.score <= {HIGH_PERCENT} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
