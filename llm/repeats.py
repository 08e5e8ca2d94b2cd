"""Finding equal windows across documents with little data moved.

Documents are packed into *groups*: consecutive ranges of ``doc_id``, each a few megabytes, sent to
their task once as compressed Arrow blocks. A group sends the sorted distinct fingerprints of its
windows, cut into key ranges (*buckets*) and delta-compressed; a bucket's task sorts one key range
at a time and answers each sender with one bit per fingerprint. A hot fingerprint is therefore at
most one entry per group, whatever its number of copies, and no pair of copies is ever emitted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import textcore as tc

GROUP_BYTES = 4 << 20
#: Text whose windows one bucket sorts at a time, on average.
BUCKET_BYTES = 16 << 20
PACK_BYTES = 4 << 20
SLICE_BYTES = 1 << 19
NULL_ID = np.iinfo(np.int64).min
_DOCS = pa.schema([("id", pa.int64()), ("text", pa.large_binary())])


def sizes(spark: SparkSession, docs: DataFrame, text_col: str, group_bytes: int) -> tuple[int, int]:
    """(groups, buckets) for the bytes of all texts; at least one of each per shuffle partition."""
    total = docs.select(F.sum(F.octet_length(F.col(text_col)).cast("long")).alias("n")).first()["n"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, math.ceil(total / group_bytes)), max(least, math.ceil(total / BUCKET_BYTES))


def boundaries(docs: DataFrame, id_col: str, groups: int) -> np.ndarray:
    """Ids that split the documents into ``groups`` ranges of about equal counts (ids only are read)."""
    ids = docs.select(F.col(id_col).cast("long").alias("i")).where("i is not null")
    probs = [k / groups for k in range(1, groups)]
    cut = ids.approxQuantile("i", probs, 0.2 / groups) if probs else []
    return np.unique(np.array(cut, dtype=np.float64)).astype(np.int64)


def pack(docs: DataFrame, id_col: str, text_col: str, cuts: np.ndarray) -> DataFrame:
    """(grp, pack): the documents of each id range, as compressed Arrow blocks."""

    def block(table: pa.Table) -> bytes:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.Table]] = {}
        size: dict[int, int] = {}

        def flush(g: int) -> pa.RecordBatch:
            table = pa.concat_tables(held.pop(g)).combine_chunks()
            size.pop(g)
            return pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([block(table)], pa.binary())], ["grp", "pack"])

        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            grp = np.searchsorted(cuts, ids, side="right")
            table = pa.Table.from_arrays([batch.column(0), batch.column(1).cast(pa.large_binary())], schema=_DOCS)
            order = np.argsort(grp, kind="stable")
            edge = np.flatnonzero(np.diff(grp[order])) + 1
            for rows in np.split(order, edge):
                if len(rows):
                    g, part = int(grp[rows[0]]), table.take(pa.array(rows))
                    held.setdefault(g, []).append(part)
                    size[g] = size.get(g, 0) + part.nbytes
                    if size[g] >= PACK_BYTES:
                        yield flush(g)
            while sum(size.values()) > 8 * PACK_BYTES:
                yield flush(max(size, key=size.get))
        for g in list(held):
            yield flush(g)

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "grp int, pack binary")


class Group:
    """The documents of one group, by id: ``ids`` (null as NULL_ID), ``valid``, ``buf``, ``off``."""

    def __init__(self, packs: pa.ChunkedArray):
        tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in packs]
        table = pa.concat_tables(tables) if tables else _DOCS.empty_table()
        raw = table.column(0).combine_chunks() if table.num_rows else pa.array([], pa.int64())
        if isinstance(raw, pa.ChunkedArray):
            raw = pa.concat_arrays(raw.chunks)
        ids = raw.fill_null(NULL_ID).to_numpy(zero_copy_only=False)
        # order: id, then a total order of the content, so that the result never depends on arrival
        order = np.argsort(ids, kind="stable")
        if not tc.heads(ids[order]).all():
            text = table.column(1).to_pylist()
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], text[i] or b"")), dtype=np.int64)
        self.ids = ids[order]
        self.valid = self.ids != NULL_ID
        self.buf, self.off = tc.flat(table.column(1).take(pa.array(order)))

    def slices(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, last row + 1, bytes, offsets) of cache-sized runs of whole documents."""
        for lo, hi in tc.slices(self.off, SLICE_BYTES):
            off = self.off[lo : hi + 1]
            yield lo, hi, self.buf[off[0] : off[-1]], off - off[0]

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=~self.valid)


def encode_sorted(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as compressed byte planes of their gaps."""
    gaps = np.diff(keys, prepend=np.zeros(1, tc.U64)).astype("<u8")
    return pa.compress(np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True) if len(keys) else b""


def decode_sorted(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, tc.U64)
    planes = np.frombuffer(pa.decompress(blob, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel(), dtype=tc.U64)


def bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def unbits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)


def bucket_edges(keys: np.ndarray, key_bits: int, buckets: int) -> np.ndarray:
    """Where each of the equal key ranges begins in the sorted ``keys``."""
    cut = [min((k << key_bits) // buckets, (1 << 64) - 1) for k in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(cut, dtype=tc.U64)), [len(keys)]])


_SENT = "kind int, bucket int, grp int, n int, keys binary, multi binary, mark binary"
_ANSWER = "kind int, grp int, bucket int, n int, flag binary"


def sent(kind: int, grp: int, keys: np.ndarray, key_bits: int, buckets: int, multi: np.ndarray | None = None, mark: np.ndarray | None = None) -> pa.Table:
    """A group's sorted distinct keys; ``multi``: in two or more of its documents, ``mark``: see ``answer``."""
    edge = bucket_edges(keys, key_bits, buckets)
    rows = [
        (kind, b, grp, int(hi - lo), encode_sorted(keys[lo:hi]), None if multi is None else bits(multi[lo:hi]), None if mark is None else bits(mark[lo:hi]))
        for b, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if hi > lo
    ]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
    kinds = [pa.int32()] * 4 + [pa.binary()] * 3
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["kind", "bucket", "grp", "n", "keys", "multi", "mark"])


class Bucket:
    """All entries of one key range: one sorted array of distinct keys per sending group, in group order."""

    def __init__(self, table: pa.Table):
        self.rows = sorted(table.to_pylist(), key=lambda r: r["grp"])
        self.keys = [decode_sorted(r["keys"], r["n"]) for r in self.rows]

    def flagged(self, name: str) -> np.ndarray:
        """The keys that a sender flagged, sorted and distinct."""
        parts = [k[unbits(r[name], r["n"])] for r, k in zip(self.rows, self.keys, strict=True) if r[name] is not None]
        return tc.sorted_distinct(np.concatenate([*parts, np.zeros(0, tc.U64)]))

    def shared(self) -> np.ndarray:
        """Keys of two groups, or of two documents of one group."""
        every = np.sort(np.concatenate(self.keys))
        twice = every[1:][every[1:] == every[:-1]]
        return tc.sorted_distinct(np.concatenate([twice, self.flagged("multi")]))


def shared(bucket: Bucket) -> list[np.ndarray]:
    """True for keys found in two documents."""
    known = tc.Members(bucket.shared())
    return [known.test(k) for k in bucket.keys]


def shared_and_marked(bucket: Bucket) -> list[np.ndarray]:
    """True for keys found in two places, at least one of them marked."""
    both = bucket.shared()
    known = tc.Members(both[tc.Members(bucket.flagged("mark")).test(both)])
    return [known.test(k) for k in bucket.keys]


def not_first(bucket: Bucket) -> list[np.ndarray]:
    """True for keys that an earlier group also sent."""
    known = tc.Members(bucket.shared())
    rest = [np.flatnonzero(known.test(k)) for k in bucket.keys]
    keys = np.concatenate([k[i] for k, i in zip(bucket.keys, rest, strict=True)])
    order = np.argsort(keys, kind="stable")  # the groups are in order
    late = np.empty(len(keys), bool)
    late[order] = ~tc.heads(keys[order])
    out = [np.zeros(len(k), bool) for k in bucket.keys]
    for mask, at, flag in zip(out, rest, np.split(late, np.cumsum([len(i) for i in rest])[:-1]), strict=True):
        mask[at] = flag
    return out


def answer(entries: DataFrame, decide: dict[int, Callable[[Bucket], list[np.ndarray]]]) -> DataFrame:
    """One bit per sent key, decided by the entry's kind; a task sorts one key range."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind, bucket = key[0].as_py(), Bucket(table)
        flags = decide[kind](bucket)
        cols = [[kind] * len(flags), [r["grp"] for r in bucket.rows], [r["bucket"] for r in bucket.rows], [r["n"] for r in bucket.rows]]
        return pa.Table.from_arrays([*(pa.array(c, pa.int32()) for c in cols), pa.array([bits(f) for f in flags], pa.binary())], names=["kind", "grp", "bucket", "n", "flag"])

    return entries.groupBy("kind", "bucket").applyInArrow(run, _ANSWER)


def flags_of(table: pa.Table, kind: int) -> np.ndarray:
    """The bits that answer a group's sorted distinct keys, in key order."""
    rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
    return np.concatenate([unbits(r["flag"], r["n"]) for r in rows]) if rows else np.zeros(0, bool)
