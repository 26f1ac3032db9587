"""WARC bundles: exact round trips, and what an index finds."""

import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from podium.llm.queries import SQL
from podium.llm.warc import BundleReader, BundleWriter, archived, fetch, parse, read_archive, record, write_archive

PAGES = "page_id long, url string, html string, digest string, first int, payload string"
LONG = "<p>" + "à long page " * 40_000


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 7, "y") for i, u, h in rows], PAGES)


ROWS = [
    (1, "http://a/1", "x" * 99), (2, "http://a/2", "x" * 99), (3, "http://a/3", "y" * 100), (9, None, "y" * 100),
    (5, "http://a/5 b\nc", "y" * 100), (6, "u", None), (7, "u", ""), (8, "u", LONG), (4, "u", LONG),
    (None, "n", LONG), (None, "n", "z" * 200), (None, "m", "z" * 200), (11, "r", "r" * 150), (11, "r", "r" * 150),
    (12, "r", "r" * 150), (13, "\r\n\r\nWARC/1.1", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9), (14, "é", "é" * 50),
]


def expected(rows):
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        ids = [j for j, _, other in rows if (other or "").encode() == payload and j is not None]
        first = min(ids, default=None) if len(payload) >= 100 else None
        revisit = first is not None and i != first
        kind = "revisit" if revisit else "response"
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), kind, first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [0, 1000])
@pytest.mark.parametrize("frame_bytes, bundle_bytes", [(1, 1), (1 << 20, 64 << 20)])
def test_round_trip(spark, most, frame_bytes, bundle_bytes):
    frame = pages(spark, ROWS).repartition(3)
    got = archived(frame, most_broadcast=most, frame_bytes=frame_bytes, bundle_bytes=bundle_bytes)
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == expected(ROWS)


def test_texts_come_back(spark, tmp_path):
    index = write_archive(pages(spark, ROWS).repartition(2), str(tmp_path / "a"), frame_bytes=2000)
    back = read_archive(spark, str(tmp_path / "a"))
    texts = {(r.page_id, bytes(r.payload).decode()) for r in back.where("record_type = 'response'").collect()}
    whole = {r.page_id for r in index.where("record_type = 'response'").collect()}
    assert texts == {(i, h or "") for i, _, h in ROWS if i in whole and not (i is None and h == LONG)}
    assert back.where("record_type = 'revisit' and payload is not null").count() == 0
    assert {r.url for r in back.where("page_id in (5, 9, 13, 14)").collect()} == {
        "http://a/5%20b%0Ac", None, "%0D%0A%0D%0AWARC/1.1", "é"
    }


def test_the_index_leads_to_single_records(spark, tmp_path):
    rows = [(i, f"u{i}", f"<p>{i}" + "text " * (i % 50)) for i in range(400)]
    index = write_archive(pages(spark, rows).repartition(3), str(tmp_path / "a"), frame_bytes=3000, bundle_bytes=4000)
    assert index.count() == 400 and index.select("bundle").distinct().count() > 3
    assert index.agg(F.max("frame")).first()[0] > 0 and index.agg(F.max("offset")).first()[0] > 0
    got = fetch(spark, str(tmp_path / "a"), index.where("page_id % 7 = 3"))
    assert {r.page_id: bytes(r.payload).decode() for r in got.collect()} == {i: h for i, _, h in rows if i % 7 == 3}


def test_bundles_are_plain_zstandard_with_a_seek_table(tmp_path):
    bundle = BundleWriter(str(tmp_path), frame_bytes=500)
    data = [record(i, "u", b"p" * 100 * i, hashlib.sha256(b"p" * 100 * i).hexdigest(), None)[1] for i in range(9)]
    places = [bundle.add(x) for x in data]
    bundle.close()
    path = tmp_path / bundle.name
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True).read()
    assert whole == b"".join(data)
    reader = BundleReader(str(tmp_path), bundle.name)
    assert sum(plain for _, plain in reader.sizes) == len(whole) and len(reader.sizes) > 2
    for (frame, offset), one in zip(places, data):
        assert reader.frame(frame)[offset : offset + len(one)] == one


def test_damage_is_noticed():
    data = record(1, "u", b"good", hashlib.sha256(b"good").hexdigest(), None)[1]
    with pytest.raises(ValueError, match="damaged"):
        parse(data.replace(b"good", b"evil"))
    with pytest.raises(ValueError, match="no WARC record"):
        parse(b"x" + data)


def test_empty_table(spark, tmp_path):
    assert archived(pages(spark, [])).count() == 0
    assert write_archive(pages(spark, []), str(tmp_path / "a")).count() == 0


def test_sql_of_awkward_rows(spark):
    import duckdb

    frame = pages(spark, ROWS).select("page_id", "url", "html").toPandas().astype({"page_id": "Int64"})
    connection = duckdb.connect()
    connection.register("pages", frame)
    found = connection.sql(SQL["op13_warc"])
    names = found.columns
    rows = [dict(zip(names, row)) for row in found.fetchall()]
    keys = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[k] for k in keys) for r in rows), key=str) == expected(ROWS)
