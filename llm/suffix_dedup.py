"""Operator 5, suffix-array dedup: repeated byte strings, by difference-cover blockwise sorting.

A byte is removed if a string of ``min_length`` bytes that covers it also starts in a document with
a smaller ``doc_id``. Only the order of suffixes to that depth matters, so a suffix array over the
first ``min_length`` bytes is built one key range (bucket) of suffixes at a time:

1. *Cover sample.* Offsets ``p`` with ``p mod v`` in a perfect difference set ``D`` are sampled.
   Any two suffixes have one common shift ``d < v`` at which both are sampled, so strings of
   ``min_length`` bytes are equal only if the names of a common sample of ``min_length - v + 1`` bytes
   are. The names that occur in one document only are found by a distributed sort of the sample.
2. *Suffix buckets.* A suffix none of whose samples in reach has a repeated name has no partner.
   The others are cut into key ranges; each task sorts one range at a time and tells each sender
   which of its suffixes also starts in an earlier group. Ties (equal strings) need no long
   comparison: names settle them.

Whole copies of a text with a smaller id go at once; their suffixes are not sorted again. Memory per task is one group of documents, or one
bucket; both are bounded by parameters, not by the corpus or by a hot string: a string that a third
of all documents hold is one entry per group.

Defined cases: null text is empty; strings never cross documents; texts under ``min_length`` bytes
keep all; rows with equal ``doc_id`` never remove each other's strings; a null ``doc_id`` counts as
smaller than any; other columns are ignored; an empty table gives an empty result.

Keys are 64-bit hashes of the strings (the names of the sample: 36 bits, which only adds candidates).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import repeats as rp
from llm import textcore as tc

MIN_LENGTH = 50
PERIOD = 21
NAME_BITS = 36
SPANS = "array<struct<start:bigint,end:bigint>>"
SCHEMA = f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans {SPANS}, kept binary"


def difference_cover(period: int) -> np.ndarray:
    """The smallest set with every residue of ``period`` as a difference of two members."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return np.array(cover)
    raise ValueError(period)


class _Sampler:
    """The cover sample of one slice of documents at a time."""

    def __init__(self, min_length: int, period: int):
        self.length, self.period = min_length, period
        self.name_length = min_length - period + 1
        self.cover = difference_cover(period)

    def positions(self, off: np.ndarray) -> np.ndarray:
        """Sampled offsets in the slice whose name fits into the document."""
        room = np.maximum(np.diff(off) - self.name_length + 1, 0)
        turns = np.arange(int(room.max(initial=0)) // self.period + 1) * self.period
        base = (turns[:, None] + self.cover[None, :]).ravel()
        size = np.searchsorted(base, room)
        return base[tc.expand(np.zeros(len(size), np.int64), size)] + np.repeat(off[:-1], size)

    def candidates(self, off: np.ndarray, hit: np.ndarray) -> np.ndarray:
        """Suffixes of full length with a repeated sample (at the sorted offsets ``hit``) in reach."""
        start, end = tc.merged(hit - self.period + 1, hit + 1)
        at = tc.expand(np.maximum(start, 0), end)
        row = np.searchsorted(off, at, side="right") - 1
        return at[at + self.length <= off[row + 1]]


def _packed(names: np.ndarray, row: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct names, found in documents of two ids); name and row share one sortable integer."""
    both = np.sort((names << tc.U64(64 - NAME_BITS)) | row.astype(tc.U64))
    keys = both >> tc.U64(64 - NAME_BITS)
    head = np.flatnonzero(tc.heads(keys))
    if not len(head):
        return keys, np.zeros(0, bool)
    last = np.append(head[1:], len(keys)) - 1
    low = tc.U64((1 << (64 - NAME_BITS)) - 1)
    return keys[head], ids[(both[head] & low).astype(np.int64)] != ids[(both[last] & low).astype(np.int64)]


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, period: int = PERIOD, group_bytes: int = rp.GROUP_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, spans, kept`` (remaining bytes)."""
    if not 1 <= period < min_length:
        raise ValueError("period must be below min_length")
    groups, buckets = rp.sizes(spark, docs, text_col, group_bytes)
    packed = rp.pack(docs, id_col, text_col, rp.boundaries(docs, id_col, groups))
    sampler = _Sampler(min_length, period)

    def sample(group: rp.Group):
        """Per slice: (first row, offsets, hashes, sampled positions, names)."""
        for lo, _, buf, off in group.slices():
            hashes, at = tc.Hashes(buf), sampler.positions(off)
            yield lo, off, hashes, at, hashes.windows(at, sampler.name_length) >> tc.U64(64 - NAME_BITS)

    def distinct_names(group: rp.Group, kept: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        names, rows = [], []
        for part in sample(group):
            lo, off, _, at, name = part
            names.append(name)
            rows.append(np.searchsorted(off, at, side="right") - 1 + lo)
            if kept is not None:
                kept.append(part)
        return _packed(np.concatenate([*names, np.zeros(0, tc.U64)]), np.concatenate([*rows, np.zeros(0, np.int64)]), group.ids)

    def texts(group: rp.Group) -> np.ndarray:
        """A hash of each whole text."""
        parts = [tc.Hashes(buf).of(off[:-1], off[1:]) for _, _, buf, off in group.slices()]
        return np.concatenate([*parts, np.zeros(0, tc.U64)])

    def copies(group: rp.Group, flags: np.ndarray) -> np.ndarray:
        """Rows whose whole text also stands in a document with a smaller id."""
        whole = texts(group)
        names = tc.sorted_distinct(whole)
        order = np.argsort(whole, kind="stable")
        head = tc.heads(whole[order])
        run = np.cumsum(head) - 1
        late = np.empty(len(whole), bool)
        late[order] = group.ids[order] > group.ids[order[head]][run]
        return late | tc.Members(names[flags]).test(whole)

    def send_names(key: tuple, table: pa.Table) -> pa.Table:
        group, grp = rp.Group(table.column("pack")), key[0].as_py()
        keys, multi = distinct_names(group)
        whole = rp.sent(0, grp, tc.sorted_distinct(texts(group)), 64, buckets)
        return pa.concat_tables([rp.sent(1, grp, keys, NAME_BITS, buckets, multi=multi), whole])

    def suffixes(group: rp.Group, flags: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, offsets in the group) of the candidate suffixes of all texts but copies."""
        parts: list = []
        names, _ = distinct_names(group, parts)
        known = tc.Members(names[flags])
        keys, offs = [np.zeros(0, tc.U64)], [np.zeros(0, np.int64)]
        for lo, off, hashes, at, name in parts:
            pos = sampler.candidates(off, at[known.test(name)])
            pos = pos[~copy[np.searchsorted(off, pos, side="right") - 1 + lo]]
            keys.append(hashes.windows(pos, min_length))
            offs.append(pos + group.off[lo])
        return np.concatenate(keys), np.concatenate(offs)

    def send_suffixes(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        group = rp.Group(left.column("pack"))
        found, _ = suffixes(group, rp.flags_of(right, 1), copies(group, rp.flags_of(right, 0)))
        return rp.sent(2, key[0].as_py(), tc.sorted_distinct(found), 64, buckets)

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        group = rp.Group(left.column("pack"))
        copy = copies(group, rp.flags_of(right, 0))
        found, at = suffixes(group, rp.flags_of(right, 1), copy)
        order = np.argsort(found, kind="stable")  # offsets, hence ids, ascend within a key
        head = tc.heads(found[order])
        run = np.cumsum(head) - 1
        ids = group.ids[np.searchsorted(group.off, at[order], side="right") - 1]
        # an earlier group has the string, or a document of this group with a smaller id
        gone = rp.flags_of(right, 2)[run] | (ids > ids[np.flatnonzero(head)][run])
        return _result(group, np.sort(at[order[gone]]), min_length, copy)

    once = packed.groupBy("grp")
    names = rp.answer(once.applyInArrow(send_names, rp._SENT), {0: rp.not_first, 1: rp.shared})
    again = once.cogroup(names.groupBy("grp")).applyInArrow(send_suffixes, rp._SENT)
    earlier = rp.answer(again, {2: rp.not_first})
    return once.cogroup(names.unionByName(earlier).groupBy("grp")).applyInArrow(cut, SCHEMA)


def _result(group: rp.Group, start: np.ndarray, length: int, copy: np.ndarray) -> pa.Table:
    """The rows of a group whose strings at the sorted offsets ``start`` go, and whole copies."""
    row = np.searchsorted(group.off, start, side="right") - 1
    begin, end = tc.merged(start, start + length, row)
    whole = np.flatnonzero(copy & (np.diff(group.off) >= length))
    begin, end = np.append(begin, group.off[whole]), np.append(end, group.off[whole + 1])
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], end[order]
    row = np.searchsorted(group.off, begin, side="right") - 1
    rows = len(group.ids)
    removed = np.bincount(row, weights=end - begin, minlength=rows).astype(np.int64)
    first = np.searchsorted(row, np.arange(rows + 1))
    base = group.off[row]
    spans = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays([pa.array(begin - base, pa.int64()), pa.array(end - base, pa.int64())], ["start", "end"]))
    stay = zip(np.append(0, end), np.append(begin, len(group.buf)), strict=True)
    kept = b"".join(group.buf[a:b].tobytes() for a, b in stay)
    size = np.diff(group.off)
    off = np.append(0, np.cumsum(size - removed)).astype(np.int32)
    kept_column = pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(kept)])
    columns = [group.id_column(), *(pa.array(c, pa.int64()) for c in (size, removed, np.diff(first))), spans, kept_column]
    return pa.Table.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table, strings of 50 bytes."""
    out = remove_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
