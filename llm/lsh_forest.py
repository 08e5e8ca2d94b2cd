"""Operator 10, MinHash near-dedup with an LSH forest.

1. *Signatures.* Each text's set of word shingles gives ``TREES * DEPTH`` MinHash values, ``DEPTH``
   per tree, and one 64-bit name of the whole set. Texts with equal sets form a class.
2. *Forest.* A tree orders all classes by its ``DEPTH`` values. A region is a run of classes with a
   common prefix of ``START`` values. In a region all pairs are estimated; its candidates span the components
   of the pairs whose estimate could reach the threshold. Counts per prefix decide before any region is
   gathered: where more than ``REGION`` classes share a prefix, they are cut by size and hash into blocks of
   half a region, and every two blocks whose sizes allow a link meet, so that no pair of a region is left out.
3. *Families.* Candidates are not links: their connected components only say which full sets must meet.
   Every class of a family is sent once, as text. A family of more than ``FAMILY`` classes is split into parts;
   each part also gets the family's hubs (classes with the most candidates).
4. *Links.* In a family (part) every pair whose estimate could reach the threshold is confirmed on the
   full sets, the likeliest first, until its classes are already connected. Then every two parts of a split
   family meet: first the signatures of its classes, which name those with an estimate that could reach the
   threshold and no connection yet, then the texts of these. Components of all confirmed links are the groups.

At similarity 0.85 a pair misses all of 16 trees at depth 4 with a probability of 1e-5. No pairs of copies
are emitted: a class counts once, and a region emits fewer candidates than it has classes. Regions and
families of n classes above their limits cost n * n estimates, in groups of bounded size.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; texts with fewer words than a
shingle have one shingle, the whole sequence; null, empty and blank texts have an empty set and stay
alone; a null ``doc_id`` is never a group's id unless all are null; rows with equal ``doc_id`` count as
separate texts with the same id; other columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import textcore as tc
from llm.components import connected
from llm.shared import shared_path

TREES, DEPTH, START = 16, 8, 4
REGION = 2000
FAMILY = 1500
HUBS = 8
#: Standard errors of the estimate below the threshold that a pair may have and still be confirmed.
MARGIN = 4.0
SLICE_BYTES = 1 << 19
_SEED = np.random.default_rng(20240131)
_XOR = _SEED.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)
_MUL = _SEED.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32) | np.uint32(1)


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 48-bit shingles of each document in turn, their bounds)."""
    words = tc.Words(buf, off, lower=True)
    count = words.count()
    hashes = tc.Hashes(words.hash)
    full = np.maximum(count - width + 1, 0)
    start = tc.expand(words.first[:-1], words.first[:-1] + full)
    short = np.flatnonzero((count > 0) & (count < width))
    doc = np.concatenate([np.repeat(np.arange(len(count)), full), short])
    name = np.concatenate([hashes.windows(start, width), hashes.of(words.first[short], words.first[short + 1])])
    if len(count) >= 1 << 16:
        raise ValueError("too many documents in one slice")
    both = np.sort((doc.astype(tc.U64) << tc.U64(48)) | (name >> tc.U64(16)))
    both = both[tc.heads(both)]
    bounds = np.searchsorted(both, np.arange(len(count) + 1, dtype=tc.U64) << tc.U64(48)) if len(count) < 1 << 16 else None
    return both & tc.U64((1 << 48) - 1), bounds


def signatures(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(MinHash values as rows of uint32, set names); documents with an empty set have zeros."""
    size = np.diff(bounds)
    some = np.flatnonzero(size)
    value = np.zeros((len(size), TREES * DEPTH), np.uint32)
    name = np.zeros(len(size), np.int64)
    if len(some):
        at = bounds[:-1][some]
        x = (tc.mix(sets) >> tc.U64(32)).astype(np.uint32)
        for k in range(TREES * DEPTH):
            value[some, k] = np.minimum.reduceat((x ^ _XOR[k]) * _MUL[k], at)
        total = np.add.reduceat(tc.mix(sets + tc.U64(0x5851F42D)), at)
        name[some] = tc.mix(total + size[some].astype(tc.U64)).astype(np.int64)
    return value, name


def _slices(off: np.ndarray) -> Iterator[tuple[int, int]]:
    for lo, hi in tc.slices(off, SLICE_BYTES):
        for a in range(lo, hi, 60_000):
            yield a, min(hi, a + 60_000)


def row_key(id: Column, text: Column) -> Column:
    """Names a row by its id and its text, so that rows without an id, or with one id, are told apart."""
    return F.xxhash64(id, text)


def sign(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Per row: ``doc_id, row_key, n_shingles, set_id`` (0: empty), ``sig`` (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = tc.flat(batch.column(2))
            for lo, hi in _slices(off):
                sets, bounds = shingle_sets(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], width)
                value, name = signatures(sets, bounds)
                sig = pa.array([v.tobytes() for v in value], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(np.diff(bounds), pa.int64()), pa.array(name), sig], names=["doc_id", "row_key", "n_shingles", "set_id", "sig"])

    plain = docs.select(F.col(id_col).cast("long").alias("id"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "doc_id bigint, row_key bigint, n_shingles bigint, set_id bigint, sig binary")


def prefix_keys(classes: DataFrame, depth: int) -> DataFrame:
    """(set_id, tree, key): a class's prefix of ``depth`` values in each tree."""
    prefix = F.expr(f"transform(sequence(0, {TREES - 1}), t -> struct(t as tree, xxhash64(t, substring(sig, t * {4 * DEPTH} + 1, {4 * depth})) as key))")
    return classes.select("set_id", F.inline(prefix))


def regions(classes: DataFrame, region: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """((set_id, key) of regions of 2 to ``region`` classes, (set_id, key) of every two blocks of the larger ones).

    ``classes (set_id, sig, n_shingles)``. Linked sets differ by less than one step of ``size``, so that they lie
    in one block or in blocks of the same or the next size.
    """
    rows = prefix_keys(classes, START).select("set_id", "key")
    sized = rows.join(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key")
    step = 1.001 * math.log(max(100 / percent, 1.000001))
    size = F.floor(F.log("n_shingles") / F.lit(step)).cast("int").alias("size")
    large = sized.where(F.col("n") > region).select("set_id", "key").join(classes.select("set_id", size), "set_id")
    counted = large.groupBy("key", "size").agg(F.ceil(F.count("*") / F.lit(max(region // 2, 1))).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("set_id", F.lit("block")), F.col("blocks")).cast("int").alias("block")
    placed = large.join(counted, ["key", "size"]).select("key", "size", block, "set_id")
    each = counted.select("key", "size", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    other = each.select("key", F.col("size").alias("size2"), F.col("block").alias("block2"))
    meet = each.join(other, "key").where("(size2 = size and block2 >= block) or size2 = size + 1")
    name = F.xxhash64("key", "size", "block", "size2", "block2").alias("group")
    ends = F.array(F.struct("size", "block"), F.struct(F.col("size2").alias("size"), F.col("block2").alias("block")))
    groups = meet.select("key", name, F.explode(F.array_distinct(ends)).alias("end")).select("key", "end.size", "end.block", "group")
    return sized.where(F.col("n") <= region).select("set_id", "key"), placed.join(groups, ["key", "size", "block"]).select("set_id", F.col("group").alias("key"))


def estimate_floor(threshold: float) -> float:
    return threshold - MARGIN * (threshold * (1 - threshold) / (TREES * DEPTH)) ** 0.5


def _matches(sig: np.ndarray, rows: slice) -> np.ndarray:
    """Share of equal one-byte MinHash values, of some rows with all."""
    out = np.zeros((len(sig[rows]), len(sig)), np.uint8)
    for k in range(sig.shape[1]):
        column = np.ascontiguousarray(sig[:, k])
        out += column[rows, None] == column[None, :]
    return out


def _unite(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, after the edges (i, j) are added."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return root
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]


def candidates(rows: DataFrame, floor: float) -> DataFrame:
    """(a, b): pairs that span the components of all pairs of ``floor`` inside each region of ``rows (set_id, key, sig)``.

    A component's pairs are those of its medoid, the class that is most similar to all of the region."""
    need = int(np.ceil(floor * TREES * DEPTH))

    def run(table: pa.Table) -> pa.Table:
        name = table.column("set_id").to_numpy()
        short = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(len(name), -1).astype(np.uint8)
        order = np.argsort(name)
        name, short = name[order], short[order]
        root, total = np.arange(len(name)), np.zeros(len(name), np.int64)
        for lo in range(0, len(name), 256):
            equal = _matches(short, slice(lo, lo + 256))
            total[lo : lo + 256] = equal.sum(axis=1, dtype=np.int64)
            i, j = np.nonzero(equal >= need)
            root = _unite(root, i + lo, j)
        best = np.lexsort((-total, root))
        middle = best[np.searchsorted(root[best], root)]
        left, right = name, name[middle]
        keep = left != right
        return pa.table({"a": np.minimum(left, right)[keep], "b": np.maximum(left, right)[keep]})

    return rows.groupBy("key").applyInArrow(run, "a bigint, b bigint").distinct()


def _full_sets(table: pa.Table, width: int) -> dict[int, np.ndarray]:
    """The full sets of the rows of ``table (set_id, text)``, by name."""
    names = table.column("set_id").to_numpy()
    sets: dict[int, np.ndarray] = {}
    buf, off = tc.flat(table.column("text"))
    for lo, hi in _slices(off):
        every, bounds = shingle_sets(buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], width)
        _, found = _names(every, bounds)
        for i in range(hi - lo):
            if found[i] == names[lo + i]:  # rows of the same key with another text drop out here
                sets[int(found[i])] = every[bounds[i] : bounds[i + 1]]
    return sets


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _open_pairs(short: np.ndarray, size: np.ndarray, lo: int, need: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, i, j), i < j: pairs of the rows from ``lo`` on whose estimate and sizes allow a link."""
    equal = _matches(short, slice(lo, lo + 256))
    i, j = np.nonzero(equal >= need)
    score = equal[i, j].astype(np.int64)
    i = i + lo
    fits = (i < j) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
    return score[fits], i[fits], j[fits]


def confirm(members: DataFrame, width: int, percent: int, floor: float) -> DataFrame:
    """(a, b): spanning links of each part of ``members (family, part, set_id, sig, root, text)``, on full sets;
    classes of one ``root`` are connected already."""
    need = int(np.ceil(floor * TREES * DEPTH))

    def run(table: pa.Table) -> pa.Table:
        sets = _full_sets(table, width)
        of_class = {k: (sig, root) for k, sig, root in zip(*(table.column(c).to_pylist() for c in ("set_id", "sig", "root")), strict=True)}
        node = sorted(sets)
        short = np.frombuffer(b"".join(of_class[k][0] for k in node), "<u4").reshape(len(node), -1).astype(np.uint8) if node else np.zeros((0, 1), np.uint8)
        size = np.array([len(sets[k]) for k in node], np.int64)
        first: dict[int, int] = {}
        root = [first.setdefault(of_class[k][1], i) for i, k in enumerate(node)]

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        pairs = [np.stack(_open_pairs(short, size, lo, need, percent)) for lo in range(0, len(node), 256)]
        every = np.concatenate(pairs, axis=1) if pairs else np.zeros((3, 0), np.int64)
        links = []
        for k in np.argsort(-every[0], kind="stable"):
            i, j = int(every[1, k]), int(every[2, k])
            a, b = find(i), find(j)
            if a == b:
                continue
            if _similar(sets[node[i]], sets[node[j]], percent):
                root[max(a, b)] = min(a, b)
                links.append((node[i], node[j]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return members.groupBy("family", "part").applyInArrow(run, "a bigint, b bigint")


def meetings(split: DataFrame) -> DataFrame:
    """The rows of ``split (family, parts, part, ...)`` once for every other part of the family that they meet, as ``part`` (part * parts + other)."""
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: o != F.col("part"))).alias("other")
    both = split.select("*", other)
    return both.withColumn("part", F.least("part", "other").cast("long") * F.col("parts") + F.greatest("part", "other")).drop("other", "parts")


def unconnected(rows: DataFrame, percent: int, floor: float) -> DataFrame:
    """(family, part, set_id): the classes of ``rows (family, part, set_id, n_shingles, sig, root)`` with a pair in
    their part whose estimate and sizes allow a link and whose roots differ."""
    need = int(np.ceil(floor * TREES * DEPTH))

    def run(table: pa.Table) -> pa.Table:
        root, size = table.column("root").to_numpy(), table.column("n_shingles").to_numpy()
        wanted = np.zeros(len(root), bool)
        if (root != root[0]).any():
            short = np.frombuffer(b"".join(table.column("sig").to_pylist()), "<u4").reshape(len(root), -1).astype(np.uint8)
            for lo in range(0, len(root), 256):
                _, i, j = _open_pairs(short, size, lo, need, percent)
                apart = root[i] != root[j]
                wanted[i[apart]] = wanted[j[apart]] = True
        return table.select(["family", "part", "set_id"]).filter(pa.array(wanted))

    return rows.groupBy("family", "part").applyInArrow(run, "family bigint, part bigint, set_id bigint")


def _names(sets: np.ndarray, bounds: np.ndarray) -> tuple[None, np.ndarray]:
    size = np.diff(bounds)
    some = np.flatnonzero(size)
    name = np.zeros(len(size), np.int64)
    if len(some):
        total = np.add.reduceat(tc.mix(sets + tc.U64(0x5851F42D)), bounds[:-1][some])
        name[some] = tc.mix(total + size[some].astype(tc.U64)).astype(np.int64)
    return None, name


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 85, region: int = REGION, family: int = FAMILY) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``; links at ``percent`` per hundred of the union."""
    return near_groups(spark, docs, id_col, text_col, width, percent, region, family).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 85, region: int = REGION, family: int = FAMILY) -> DataFrame:
    """Per row: ``doc_id, row_key, n_shingles, set_id``, its ``group`` (the row's key if the set is empty) and the group's smallest id as ``component_id``."""
    base = shared_path(spark, f"lsh_forest/{uuid.uuid4().hex}")
    floor = estimate_floor(percent / 100)
    sign(docs, id_col, text_col, width).write.parquet(f"{base}/signed")
    signed = spark.read.parquet(f"{base}/signed")
    signed.where("set_id <> 0").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min("row_key").alias("text_key"), F.min("n_shingles").alias("n_shingles"), F.min("sig").alias("sig")).write.parquet(f"{base}/classes")
    classes = spark.read.parquet(f"{base}/classes")
    fits, blocks = regions(classes.select("set_id", "sig", "n_shingles"), region, percent)
    rows = fits.unionByName(blocks).join(classes.select("set_id", "sig"), "set_id")
    candidates(rows, floor).write.parquet(f"{base}/candidates")
    pairs = spark.read.parquet(f"{base}/candidates")
    found = connected(spark, pairs)
    degree = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
    sized = found.groupBy("root").agg(F.count("*").alias("n"))
    # two parts of a split family meet in one group
    parts = F.when(F.col("n") > family, F.ceil(2 * F.col("n") / family)).otherwise(1).cast("int")
    node = found.join(degree, "node").join(sized, "root").withColumn("parts", parts)
    placed = node.select(F.col("root").alias("family"), "parts", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), F.col("node").alias("set_id"))
    inside = placed.drop("parts")
    hub = node.where("parts > 1").groupBy("root", "parts", F.pmod(F.hash("node"), F.lit(HUBS)).alias("slot")).agg(F.max(F.struct("degree", "node")).alias("top"))
    hubs = hub.select(F.col("root").alias("family"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("top.node").alias("set_id"))
    wanted = inside.unionByName(hubs).distinct().join(classes, "set_id")
    texts = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))
    members = wanted.join(texts, "text_key").select("family", "part", "set_id", "sig", F.col("set_id").alias("root"), "text")
    confirm(members, width, percent, floor).write.parquet(f"{base}/links")
    links = spark.read.parquet(f"{base}/links")
    groups = connected(spark, links)
    split = placed.where("parts > 1")
    if not split.isEmpty():
        rooted = classes.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
        unconnected(meetings(split).join(rooted, "set_id"), percent, floor).write.parquet(f"{base}/unconnected")
        apart = spark.read.parquet(f"{base}/unconnected").join(rooted, "set_id").join(texts, "text_key").select("family", "part", "set_id", "sig", "root", "text")
        confirm(apart, width, percent, floor).write.parquet(f"{base}/more_links")
        groups = connected(spark, links.unionByName(spark.read.parquet(f"{base}/more_links")))
    of_class = classes.select("set_id", "rep").join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    smallest = of_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    component = of_class.join(smallest, "root").select("set_id", F.col("root").alias("group"), "component_id")
    joined = signed.select("doc_id", "row_key", "n_shingles", "set_id").join(component, "set_id", "left")
    alone = F.col("set_id") == 0
    return joined.select("doc_id", "row_key", "n_shingles", "set_id", F.when(alone, F.col("row_key")).otherwise(F.col("group")).alias("group"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op10_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table: 3-word shingles, similarity of 85 per hundred."""
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
