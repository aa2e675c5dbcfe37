import base64
import hashlib

import zstandard

from chronopanel.llm import warc as W
from chronopanel.llm.store import filesystem, shared_folder

PAGES = [(0, "http://a/x", "<p>one</p>"), (1, "http://a/y", "<p>one</p>"), (2, None, None), (3, "http://b", ""), (4, "u\r\nInjected: 1", "é" * 50_000),
         (5, "http://c", "\r\n\r\nbody\r\n\r\n"), (6, "http://c", "<p>one</p>"), (7, "http://d", "WARC/1.1\r\n"), (7, "http://d", "twice"), (7, "http://d", "twice"),
         (None, "http://e", "<p>one</p>"), (None, "http://f", "lonely")]


def pages(spark):
    return spark.createDataFrame([(*r, "p", 1, "s") for r in PAGES], "page_id long, url string, html string, part string, id int, hex string")


def expected(min_bytes=0):
    low = {}
    for i, _, h in PAGES:
        if i is not None:
            low[h or ""] = min(i, low.get(h or "", i))
    out = []
    for i, _, h in PAGES:
        raw, first = (h or "").encode(), low.get(h or "")
        copies = sum((x or "") == (h or "") for *_, x in PAGES) > 1
        revisit = first is not None and i != first and copies and len(raw) >= min_bytes
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_query(spark):
    assert sorted((tuple(r) for r in W.warc_bundles(spark, pages(spark)).collect()), key=str) == expected()


def test_payloads_and_single_records(spark):
    manifest = W.write_warc(pages(spark).repartition(2), shared_folder(spark, "warc"), frame_bytes=200, min_bytes=1)
    rows = W.read_warc(manifest).collect()
    assert sorted(((r["id"], r["length"], r["digest"], r["type"], r["refers_to"]) for r in rows), key=str) == expected(1)
    kept = {(r["id"], bytes(r["payload"]).decode()) for r in rows if r["type"] == "response"}
    assert kept <= {(i, h or "") for i, _, h in PAGES}
    found = [x for m in manifest.collect() if (x := W.read_record(m["path"], 5))]
    assert len(found) == 1 and found[0]["payload"] == b"\r\n\r\nbody\r\n\r\n"
    assert all(W.read_record(m["path"], 999) is None for m in manifest.collect())


def test_bundles_are_plain_warc_streams(spark):
    manifest = W.write_warc(pages(spark), shared_folder(spark, "warc"))
    n = 0
    for m in manifest.collect():
        fs, inner = filesystem(m["path"])
        data = fs.open_input_file(inner).read()
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        while plain:
            head, _, rest = plain.partition(b"\r\n\r\n")
            size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b":")[1])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size: size + 4] == b"\r\n\r\n"
            plain, n = rest[size + 4:], n + 1
    assert n == len(PAGES)


def test_empty_table(spark):
    assert W.warc_bundles(spark, pages(spark).limit(0)).collect() == []
