"""Operator 7: round trips."""

from __future__ import annotations

import hashlib
from base64 import b32encode

import pytest

from llm import warc
from llm.shared import ship

PAGES = "page_id bigint, url string, html string, digest string, first bigint"


@pytest.fixture(scope="module")
def rows():
    body = ["<p>one</p>", "<p>twö</p>\r\n\r\nmore", "", None, "<p>one</p>", "x" * 200_000]
    out = [(i, f"http://h.example/{i}?a b=ü" if i % 3 else None, body[i % 6], "d", 1) for i in range(40)]
    return [*out, out[4], (None, "u", "<p>one</p>", "d", 2), (None, None, "alone", "d", 2)]


def test_round_trip(spark, rows, tmp_path):
    ship(spark)
    folder = f"file://{tmp_path}/warc"
    index = warc.write_archives(spark, spark.createDataFrame(rows, PAGES).repartition(3), folder, archive_bytes=50_000)
    got = warc.read_records(index, folder).collect()
    first: dict[str, list] = {}
    for i, _, html, _, _ in rows:
        first.setdefault(html or "", []).append(i)
    smallest = {h: min((i for i in ids if i is not None), default=None) for h, ids in first.items()}
    want = []
    for i, _, html, _, _ in rows:
        data = (html or "").encode()
        revisit = i != smallest[html or ""]
        want.append((i, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", smallest[html or ""] if revisit else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert all(bytes(r.payload) in [(h or "").encode() for *_, h, _, _ in rows] for r in got if r.record_type == "response")


def test_selected_records(spark, rows, tmp_path):
    ship(spark)
    folder = f"file://{tmp_path}/warc"
    index = warc.write_archives(spark, spark.createDataFrame(rows, PAGES), folder)
    got = warc.read_records(index.where("page_id in (3, 17, 30)"), folder).collect()
    assert sorted(r.page_id for r in got) == [3, 17, 30]


def test_empty(spark, tmp_path):
    ship(spark)
    folder = f"file://{tmp_path}/warc"
    index = warc.write_archives(spark, spark.createDataFrame([], PAGES), folder)
    assert index.count() == 0 and warc.read_records(index, folder).count() == 0


def test_coalesce():
    assert warc.coalesce([(0, 10), (10, 5), (100, 5), (500, 1)], gap=90, most=120) == [(0, 105, [0, 1, 2]), (500, 501, [3])]
    assert warc.coalesce([]) == []


def test_damage_is_found():
    good = warc.record(1, "u", b"abc", b32encode(hashlib.sha1(b"abc").digest()).decode(), None, False)
    assert warc.parse(good)["payload"] == b"abc"
    for bad in (good.replace(b"abc", b"abd"), good[:-3], good.replace(b"WARC/1.1", b"JUNK/1.1")):
        with pytest.raises(ValueError):
            warc.parse(bad)
