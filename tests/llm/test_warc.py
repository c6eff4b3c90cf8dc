import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import shared, warc

SCHEMA = "page_id long, url string, html string"


def expected(pages):
    groups = {}
    for page, _, html in pages:
        body = (html or "").encode()
        if len(body) >= warc.LEAST_BYTES:
            groups.setdefault(body, []).append(page)
    out = []
    for page, url, html in pages:
        body = (html or "").encode()
        ids = [i for i in groups.get(body, []) if i is not None]
        target = max(ids) if ids and max(ids) != page else None
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "response" if target is None else "revisit", target, warc.url_key(warc.address(url or ""))))
    return sorted(out, key=str)


def columns(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key").collect()), key=str)


def plain(rows):
    rows = sorted(rows, key=warc._key)
    seen, out = {}, []
    for place, x in enumerate(rows):
        seen[x["url_key"]] = seen.get(x["url_key"], 0) + 1
        out.append((x["url_key"], x["captured"], x["page_id"], x["archive"], x["offset"], place, seen[x["url_key"]]))
    return out


PAGES = [
    (1, "http://www.a.org/x?b=2&a=1#f", "x" * 1000),
    (2, "https://A.org/x?a=1&b=2", "x" * 1000),
    (3, "https://a.org/x?a=1&b=2", "x" * 999),
    (4, "https://a.org/x?a=1&b=2", "x" * 999),
    (5, None, None),
    (None, "http://b.org:80", "x" * 1000),
    (None, "http://b.org", "y" * 2000),
    (None, "http://c.org", "y" * 2000),
    (9, "http://d.org/\r\nInjected: yes", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (9, "http://e.org/", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (8, "http://e.org/", "\r\n\r\nWARC/1.1\r\n\r\n" * 100),
    (10, "http://é.org/é", "é" * 700),
    (11, "", "😀\n" * 250_000),
]


def test_records_come_back(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumn("payload", F.lit("clash")).withColumn("place", F.lit(1))
    path = f"file://{tmp_path}/archives"
    warc.write_archives(pages, path)
    assert columns(warc.local_runs(spark, path)) == expected(PAGES)
    bodies = {(r.page_id, r.url): r.payload for r in warc.read_records(spark, path).collect()}
    assert bodies[11, ""].decode() == "😀\n" * 250_000 and bodies[1, PAGES[0][1]] is None
    text = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "archives").glob("part-*"))
    assert text.count(b"\r\n\r\nWARC/1.1\r\nWARC-Type: ") + 1 >= len(PAGES) and text.endswith(b"\r\n\r\n")


def test_offsets_lead_to_records(spark, tmp_path):
    warc.write_archives(spark.createDataFrame(PAGES, SCHEMA), f"file://{tmp_path}/archives")
    for r in warc.local_runs(spark, f"file://{tmp_path}/archives").collect():
        data = (tmp_path / "archives" / r.archive).read_bytes()[r.offset : r.offset + r.length]
        assert data.endswith(warc.END)
        fields, _ = warc.parsed(data[: -len(warc.END)])
        assert warc._page(fields["warc-record-id"]) == r.page_id


@pytest.mark.parametrize("rows", [0, 1, 400])
def test_histories_in_one_order(spark, tmp_path, rows):
    """Ranges and runs of a few rows; one URL holds a third of all captures."""
    rng = random.Random(rows)
    pages = [(i, "http://hot.org/" if i % 3 == 0 else f"http://h{rng.randrange(30)}.org/", "p" * rng.choice([5, 1200, 1300])) for i in range(rows)]
    frame = spark.createDataFrame(pages, SCHEMA).repartition(7)
    warc.write_archives(frame, f"file://{tmp_path}/a", captured=F.col("page_id") % 50)
    runs = warc.local_runs(spark, f"file://{tmp_path}/a", run_rows=9)
    index = warc.merged_index(runs, range_rows=20)
    got = [(r.url_key, r.captured, r.page_id, r.archive, r.offset, r.place, r.capture) for r in index.orderBy("place").collect()]
    assert got == plain([r.asDict() for r in runs.collect()])
    assert columns(index) == expected(pages)


def test_large_groups_are_joined_apart(spark, monkeypatch):
    monkeypatch.setattr(warc, "LARGE_ROWS", 5)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", 0)
    pages = [(i, "u", "z" * (1000 if i < 40 else 1001 + i // 3)) for i in range(60)]
    found = warc.with_targets(spark.createDataFrame(pages, SCHEMA))
    assert sorted((r.page_id, r.refers_to) for r in found.collect()) == sorted((p, t) for p, _, _, _, t, _ in expected(pages))


def test_damage_is_found(spark):
    good = warc._record("response", [("WARC-Record-ID", "<urn:page:1>")], b"abc")
    with pytest.raises(ValueError):
        warc.parsed(gzip.compress(good + b"d"))
    with pytest.raises(ValueError):
        warc.parsed(gzip.compress(b"HTTP" + good))


def test_merge_order_is_a_stable_sort():
    rng = random.Random(5)
    for k in (1, 2, 3, 7, 16):
        pieces = [sorted(rng.randrange(20) for _ in range(rng.randrange(1, 9))) for _ in range(k)]
        keys, starts = [], []
        for p in pieces:
            starts.append(len(keys))
            keys += p
        assert warc.merge_order(keys, starts) == sorted(range(len(keys)), key=lambda i: keys[i])
    assert warc.merge_order([], []) == []


def test_url_keys():
    assert warc.url_key("HTTPS://WWW2.Blog.Example.com:443/A/b?z=1&a=2#top") == "com,example,blog)/A/b?a=2&z=1"
    assert warc.url_key("") == ")/" and warc.url_key("http://x.org?") == "org,x)/"
