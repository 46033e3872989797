from __future__ import annotations

import base64
import hashlib

import pytest

from tickgate.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"
LONG = "<p>é🙂</p>" * 40_000
ROWS = [(5, "http://a/x", "one", "c"), (2, "http://a/y\r\nX-Bad: 1", "one", "c"), (9, None, "one", "c"),
        (1, "http://b", None, "c"), (3, "http://b", "", "c"), (4, "http://c", LONG, "c"), (8, "http://c", LONG, "c"),
        (7, "http://d", "\r\n\r\nWARC/1.1\r\n", "c"), (6, "http://e", "only", "c"), (6, "http://e", "only", "c"),
        (None, "http://f", "nobody", "c"), (None, "http://g", "one", "c")]


def brute(rows, min_bytes=0):
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h, _ in rows:
        p = (h or "").encode()
        f = first.get(h or "") if len(p) >= min_bytes else None
        again = f is not None and i != f
        out.append((str(i) if i is not None else "null", "revisit" if again else "response", str(f) if again else None,
                    len(p), base64.b32encode(hashlib.sha1(p).digest()).decode()))
    return sorted(out, key=repr)


COLS = ("record_id", "record_type", "refers_to", "payload_bytes", "payload_digest")


@pytest.mark.parametrize("min_bytes, frame, bundle", [(0, 1 << 20, 1 << 28), (4, 200, 1), (0, 1, 1 << 28)])
def test_round_trip(spark, tmp_path, min_bytes, frame, bundle):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    m = warc.write(pages, f"file://{tmp_path}/w", min_bytes=min_bytes, frame_bytes=frame, bundle_bytes=bundle)
    assert m.count() == len(ROWS)
    got = warc.read_all(m).collect()
    assert sorted((tuple(r[c] for c in COLS) for r in got), key=repr) == brute(ROWS, min_bytes)
    by_id = {r.record_id: r for r in got}
    assert bytes(by_id["4"].payload).decode() == LONG and by_id["8"].payload is None
    assert by_id["2"].url == "http://a/y%0D%0AX-Bad: 1" and by_id["9"].url is None
    assert bytes(by_id["7"].payload) == b"\r\n\r\nWARC/1.1\r\n"


def test_records_by_id_and_damage(spark, tmp_path):
    m = warc.write(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), f"file://{tmp_path}/w", frame_bytes=64)
    ids = spark.createDataFrame([("4",), ("3",), ("none",), ("4",)], "record_id string")
    got = {r.record_id: r for r in warc.fetch(m, ids).collect()}
    assert set(got) == {"3", "4"} and got["3"].refers_to == "1" and bytes(got["4"].payload).decode() == LONG
    place = m.where("record_id = '7'").first()
    path = place.bundle.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[place.frame_at + place.frame_size - 3] ^= 255
    open(path, "wb").write(bytes(data))
    with pytest.raises(Exception):
        warc.read_all(m).collect()


def test_bundles_are_plain_zstandard(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    m = warc.write(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), f"file://{tmp_path}/w", frame_bytes=100)
    path = m.first().bundle.removeprefix("file://")
    with open(path, "rb") as f:
        data = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert sum(1 for _ in warc.parse_records(data)) == len(ROWS)


def test_empty_table(spark, tmp_path):
    m = warc.write(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/w")
    assert m.count() == 0 and warc.read_all(m).count() == 0
