"""Operator 9, substring dedup: repeated word strings, by fixed-block anchors.

A word is removed if a window of ``window`` words that covers it also starts earlier: in a document
with a smaller ``doc_id``, or earlier in the same document.

1. *Index.* Every document is cut into non-overlapping blocks of ``block`` words, with
   ``2 * block <= window``: any window then holds a whole block of its own document.
2. *Probe.* Every rolling run of ``block`` words of every document is looked up among the blocks.
   A block that no other place holds is a miss.
3. *Extend.* A window can only repeat if all whole blocks inside it are hits. The windows around hits
   are compared exactly; the union of the repeated ones are the maximal exact repeats.

Steps 2 and 3 are distributed sorts of fingerprints in key ranges (``repeats``): one entry per group
of documents and fingerprint, one bit back. No pair of places is ever emitted.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+``, unchanged; null text has none; texts shorter than a
window keep all; rows with equal ``doc_id`` are different documents, neither of them earlier; a null
``doc_id`` counts as smaller than any; other columns are ignored; an empty table gives an empty result.
Window keys are 64-bit hashes; block names have 40 bits, which only adds windows to compare.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import repeats as rp
from llm import textcore as tc

WINDOW = 20
BLOCK = 10
NAME_BITS = 40
SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_text string"


def _positions(count: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Starts of the runs of ``width`` words that stay in their document."""
    return tc.expand(first[:-1], first[:-1] + np.maximum(count - width + 1, 0))


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, block: int = BLOCK, group_bytes: int = rp.GROUP_BYTES) -> DataFrame:
    """Per document: ``doc_id, n_words, n_removed, spans`` (of removed words), ``kept_text``."""
    if not 1 <= 2 * block <= window:
        raise ValueError("a window must hold two blocks")
    groups, buckets = rp.sizes(spark, docs, text_col, group_bytes)
    packed = rp.pack(docs, id_col, text_col, rp.boundaries(docs, id_col, groups))

    def slices(group: rp.Group):
        """Per slice: (first row, words, hashes of word runs)."""
        for lo, _, buf, off in group.slices():
            words = tc.Words(buf, off)
            yield lo, words, tc.Hashes(words.hash)

    def names(words: tc.Words, hashes: tc.Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, names, is a block) of the rolling runs."""
        at = _positions(words.count(), words.first, block)
        row = np.searchsorted(words.first, at, side="right") - 1
        return at, hashes.windows(at, block) >> tc.U64(64 - NAME_BITS), (at - words.first[row]) % block == 0

    def distinct(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sorted distinct names, found twice, is a block somewhere); the flag is the lowest bit."""
        both = np.sort(np.concatenate([*found, np.zeros(0, tc.U64)]))
        keys = both >> tc.U64(1)
        head = np.flatnonzero(tc.heads(keys))
        last = np.append(head[1:], len(keys))[: len(head)] - 1
        return keys[head], last > head, (both[last] & tc.U64(1)).astype(bool)

    def send_names(key: tuple, table: pa.Table) -> pa.Table:
        found = []
        for _, words, hashes in slices(rp.Group(table.column("pack"))):
            _, name, anchor = names(words, hashes)
            found.append((name << tc.U64(1)) | anchor)
        keys, multi, mark = distinct(found)
        return rp.sent(1, key[0].as_py(), keys, NAME_BITS, buckets, multi=multi, mark=mark)

    def candidates(group: rp.Group, flags: np.ndarray):
        """(window keys, rows, starts in words of the row) where all whole blocks are hits."""
        parts, found = [], []
        for lo, words, hashes in slices(group):
            at, name, anchor = names(words, hashes)
            found.append((name << tc.U64(1)) | anchor)
            parts.append((lo, words, hashes, at[anchor], name[anchor]))
        known = tc.Members(distinct(found)[0][flags])
        keys, rows, starts = [np.zeros(0, tc.U64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lo, words, hashes, at, name in parts:
            hit = np.zeros(len(words.start) + 1, bool)
            hit[at] = known.test(name)
            pos = _positions(words.count(), words.first, window)
            row = np.searchsorted(words.first, pos, side="right") - 1
            rel = pos - words.first[row]
            base = words.first[row]
            some = hit[base + -(-rel // block) * block] & hit[base + (rel + window - block) // block * block]
            pos, row = pos[some], row[some]
            keys.append(hashes.windows(pos, window))
            rows.append(row + lo)
            starts.append(rel[some])
        return np.concatenate(keys), np.concatenate(rows), np.concatenate(starts)

    def send_windows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        keys, _, _ = candidates(rp.Group(left.column("pack")), rp.flags_of(right, 1))
        return rp.sent(2, key[0].as_py(), tc.sorted_distinct(keys), 64, buckets)

    def cut(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        group = rp.Group(left.column("pack"))
        keys, row, start = candidates(group, rp.flags_of(right, 1))
        order = np.argsort(keys, kind="stable")  # rows and starts ascend within a key
        head = tc.heads(keys[order])
        run = np.cumsum(head) - 1
        by = row[order]
        same_row = np.zeros(len(by), bool)
        same_row[1:] = (by[1:] == by[:-1]) & ~head[1:]
        ids = group.ids[by]
        gone = rp.flags_of(right, 2)[run] | (ids > ids[np.flatnonzero(head)][run]) | same_row
        pick = np.sort(order[gone])
        return _result(group, row[pick], start[pick], window)

    once = packed.groupBy("grp")
    hits = rp.answer(once.applyInArrow(send_names, rp._SENT), {1: rp.shared_and_marked})
    again = once.cogroup(hits.groupBy("grp")).applyInArrow(send_windows, rp._SENT)
    earlier = rp.answer(again, {2: rp.not_first})
    return once.cogroup(hits.unionByName(earlier).groupBy("grp")).applyInArrow(cut, SCHEMA)


def _result(group: rp.Group, row: np.ndarray, start: np.ndarray, window: int) -> pa.Table:
    begin, end, piece = [], [], []
    if len(row):
        # one axis for all rows: each row's words are shifted past the row before
        shift = np.concatenate([[0], np.cumsum(np.diff(group.off) + 1)])
        begin, end = tc.merged(start + shift[row], start + shift[row] + window, row)
        piece = np.searchsorted(shift, begin, side="right") - 1
        begin, end = begin - shift[piece], end - shift[piece]
    rows = len(group.ids)
    first = np.searchsorted(piece, np.arange(rows + 1))
    data = group.buf.tobytes()
    kept, total, removed = [], np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i in range(rows):
        words = data[group.off[i] : group.off[i + 1]].split()
        total[i] = len(words)
        for k in range(first[i + 1] - 1, first[i] - 1, -1):
            removed[i] += end[k] - begin[k]
            del words[begin[k] : end[k]]
        kept.append(b" ".join(words))
    spans = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.StructArray.from_arrays([pa.array(begin, pa.int64()), pa.array(end, pa.int64())], ["start", "end"]))
    return pa.Table.from_arrays([group.id_column(), pa.array(total), pa.array(removed), spans, pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table, windows of 20 words."""
    out = remove_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
