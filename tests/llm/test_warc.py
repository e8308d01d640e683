import base64
import hashlib

import pytest

from moorline.llm import warc as W
from moorline.llm.common import work_uri

from . import helpers as H


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "page_id bigint, url string, html string, row string, digest string")


ROWS = [(1, "http://a/1", "<p>a</p>"), (2, "http://a/2", "<p>a</p>"), (3, None, None), (4, "http://a b/\r\nX: y", ""),
        (5, "http://a/5", "é\r\n\r\nWARC/1.1 " * 50000), (6, "u", "b"), (6, "u", "b"), (None, "v", "b"), (None, "w", "c"), (None, "w", "c")]


def test_round_trip(spark):
    got = {}
    for r in W.round_trip(_pages(spark, ROWS)).collect():
        got.setdefault(r.page_id, []).append((r.record_type, r.refers_to, r.payload_bytes, r.payload_digest))
    for page_id, _, html in ROWS:
        raw = (html or "").encode()
        for g in got[page_id]:
            if page_id is not None:
                assert g[2:] == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
    assert got[1][0][:2] == ("revisit", 2) and got[2][0][:2] == ("response", None)
    assert got[3][0][:2] == ("revisit", 4) and got[4][0][:2] == ("response", None)
    assert [g[0] for g in got[6]] == ["response"] * 2
    assert sorted(str(g[:2]) for g in got[None]) == sorted(["('revisit', 6)", "('response', None)", "('response', None)"])
    assert W.round_trip(_pages(spark, [])).count() == 0


def test_index_selects_and_archives_are_split(spark):
    folder = work_uri(spark, "test-warc")
    pages = [(i, f"http://h/{i}", f"page {i} " * 200) for i in range(200)]
    index = W.write_archives(_pages(spark, pages).coalesce(2), folder, archive_bytes=4000)
    assert index.select("archive").distinct().count() > 4
    got = {r.page_id: r for r in W.read_records(index.where("page_id % 7 = 0"), folder).collect()}
    assert set(got) == set(range(0, 200, 7))
    assert all(bytes(got[i].payload).decode() == f"page {i} " * 200 and got[i].url == f"http://h/{i}" for i in got)


def test_ranges_join_near_records_only():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 100, 10), ("a", 110, 50), ("b", 160, 5)]
    assert [len(g) for g in W.ranges(rows, gap=5, most=40)] == [2, 1, 1, 1]


def test_damage_is_noticed():
    raw = W.record(1, "u", b"abc", None)
    assert W.parse(raw)["payload"] == b"abc"
    with pytest.raises(ValueError):
        W.parse(raw.replace(b"\r\nabc", b"\r\nabd"))
    with pytest.raises(ValueError):
        W.parse(raw[:-2])


def test_input_split_anew_between_jobs(spark, monkeypatch):
    rows = [(i, f"http://h/{i}", f"page {i}" if i % 3 else "page") for i in range(100)]
    folder = work_uri(spark, "test-warc")
    with H.moving(spark, monkeypatch, W, rows, "page_id bigint, url string, html string") as df:
        got = W.read_records(W.write_archives(df, folder), folder).collect()
    assert {(r.page_id, r.refers_to, r.payload and r.payload.decode()) for r in got} == {
        (i, None if i % 3 or i == 99 else 99, t if i % 3 or i == 99 else None) for i, _, t in rows}
