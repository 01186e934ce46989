import hashlib
from collections import Counter

from kestrel.llm import warc
from kestrel.storage import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, uid long, rid string, payload string"
BIG, OTHER = "x" * 1200 + "\r\n\r\nWARC/1.1\r\n é", "y" * 1000


def rows():
    r = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (4, "http://b/\r\nX: y", "small"), (5, "u", "small"), (6, "u", None),
         (7, "u", ""), (8, "u", OTHER), (9, "u", "z" * 999), (10, "u", "z" * 999), (11, "u", OTHER), (11, "u", OTHER), (12, "u", "q" * 300_000),
         (None, "u", BIG), (None, "n", "n" * 2000), (None, "n", "n" * 2000), (13, "w", "one\r\n\r\n")]
    return [(*x, "d", 1, "r", "p") for x in r]


def want(data):
    stored = {}
    for p, _, h, *_ in data:
        if p is not None and len((h or "").encode()) >= 1000:
            stored[h] = max(stored.get(h, p), p)
    n = Counter(h for _, _, h, *_ in data)
    out = []
    for p, _, h, *_ in data:
        b = (h or "").encode()
        to = stored.get(h) if n[h] > 1 else None
        revisit = to is not None and to != p
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return out


def _sorted(x):
    return sorted(x, key=str)


def test_round_trip_on_edge_cases(spark):
    got = [tuple(r) for r in warc.round_trip(spark.createDataFrame(rows(), SCHEMA)).collect()]
    assert _sorted(got) == _sorted(want(rows()))


def test_assembled_captures_hold_request_response_and_metadata(spark):
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(rows(), SCHEMA), path)
    got = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(got) == len(rows())
    for r in got:
        assert (r.request.warc_type, r.metadata.warc_type) == ("request", "metadata")
        assert r.request.concurrent_to == r.metadata.concurrent_to == r.capture_id == r.response.record_id
        assert r.request.target_uri == r.response.target_uri
    texts = {r.page_id: r.response.payload for r in got if r.response.warc_type == "response" and r.page_id is not None}
    assert texts[12] == "q" * 300_000 and texts[6] == "" and texts[3] == BIG and texts[13] == "one\r\n\r\n"


def test_empty_table(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
