"""Operators 5 and 9 against brute force."""

from __future__ import annotations

import pytest

from llm import substring_dedup, suffix_dedup

from llm_cases import docs, docs_rows, no_docs, words  # noqa: F401

LOW = -(1 << 63)


def expected_bytes(rows, length):
    out = []
    keyed = [(LOW if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    first: dict[bytes, int] = {}
    for key, data in keyed:
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            first[s] = min(first.get(s, key), key)
    for (key, data), r in zip(keyed, rows, strict=True):
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < key:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((r[0], len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("length,period", [(50, 21), (20, 7)])
def test_suffix_dedup(spark, docs, docs_rows, length, period):
    got = suffix_dedup.remove_repeats(spark, docs, min_length=length, period=period, group_bytes=4000).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == expected_bytes(docs_rows, length)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans for r in got)


def expected_words(rows, window):
    keyed = [(LOW if r[0] is None else r[0], words(r[1])) for r in rows]
    first: dict[tuple, int] = {}
    for key, w in keyed:
        for p in range(len(w) - window + 1):
            s = tuple(w[p : p + window])
            first[s] = min(first.get(s, key), key)
    out = []
    for (key, w), r in zip(keyed, rows, strict=True):
        gone, seen = [False] * len(w), set()
        for p in range(len(w) - window + 1):
            s = tuple(w[p : p + window])
            if first[s] < key or s in seen:
                gone[p : p + window] = [True] * window
            seen.add(s)
        out.append((r[0], len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,block", [(20, 10), (7, 3)])
def test_substring_dedup(spark, docs, docs_rows, window, block):
    got = substring_dedup.remove_repeats(spark, docs, window=window, block=block, group_bytes=4000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == expected_words(docs_rows, window)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in got)


def test_empty_tables(spark, no_docs):
    assert suffix_dedup.remove_repeats(spark, no_docs).count() == 0
    assert substring_dedup.remove_repeats(spark, no_docs).count() == 0


def test_difference_cover():
    for v in (1, 2, 7, 13, 21):
        cover = suffix_dedup.difference_cover(v)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert len(suffix_dedup.difference_cover(21)) == 5


def test_parameters(spark, docs):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(spark, docs, min_length=5, period=5)
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(spark, docs, window=5, block=3)
