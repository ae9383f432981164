import base64
import gzip
import hashlib
import time

import oracle
import pytest

from faultloom.llm import warc
from faultloom.llm.queries import QUERIES
from faultloom.session import scratch_path


def test_query_equals_sql(spark, sf_dir):
    q = QUERIES["op3_warc"]
    assert oracle.compare(spark, "op3_warc", q.run, q.oracle, sf_dir) is None


def made(n, size=700):
    pages = []
    for i in range(n):
        body = (f"page {i} " * size)[:size].encode()
        pages.append((i, f"http://x/{i}", hashlib.sha256(body).hexdigest(), None, body))
    return pages


def whole(data, found):
    at = 0
    for f in found:
        assert f["offset"] == at
        at += f["length"]
    assert at == len(data)


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage_goes_on_behind_damage(zipped):
    pages = made(6)
    parts = [gzip.compress(warc.record(*p)) if zipped else warc.record(*p) for p in pages]
    data = bytearray(b"".join(parts))
    assert [f["page_id"] for f in warc.salvage(bytes(data))] == [0, 1, 2, 3, 4, 5]
    data[len(parts[0]) + len(parts[1]) // 2] ^= 255
    found = list(warc.salvage(bytes(data)))
    assert [f.get("page_id") for f in found] == [0, None, 2, 3, 4, 5]
    assert (found[1]["offset"], found[1]["length"]) == (len(parts[0]), len(parts[1]))
    whole(data, found)
    # Junk before, a member cut short behind, and bytes that look like a member.
    data = b"junk" + parts[0] + warc.MAGIC + b"xx" + warc.VERSION + parts[2] + parts[3][:-9]
    found = list(warc.salvage(data))
    assert [f.get("page_id") for f in found] == [None, 0, None, 2, None]
    assert all(f["gap_reason"] for f in found if "gap_reason" in f)
    whole(data, found)
    assert list(warc.salvage(b"")) == []


SCHEMA = "page_id long, url string, html string, digest string, first int"


def test_edges(spark):
    same, short = "é" * 60, "short"
    pages = [(5, "u\r\nX: y", same), (3, None, same), (9, "%0A", same), (1, "u", short), (2, "u", short),
             (4, "u", None), (6, "u", ""), (None, "u", same), (3, "u", same)]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], SCHEMA)
    path = scratch_path(spark, "warc-test")
    warc.write(df, path)
    found = warc.read(spark, path)
    assert warc.gaps(found).count() == 0
    urls = {r.page_id: r.url for r in found.collect()}
    assert urls[5] == "u\r\nX: y" and urls[9] == "%0A"
    got = sorted((r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes) for r in warc.roundtrip(df).collect())
    assert got == [
        (0, "revisit", 3, 120), (1, "response", None, 5), (2, "response", None, 5), (3, "response", None, 120),
        (3, "response", None, 120), (4, "response", None, 0), (5, "revisit", 3, 120), (6, "response", None, 0),
        (9, "revisit", 3, 120),
    ]
    assert warc.roundtrip(df.limit(0)).count() == 0


def test_large_payload_and_damaged_archive(spark, tmp_path):
    big = "x" * (17 << 20)
    df = spark.createDataFrame([(i, "u", big if i == 2 else f"page {i} " * 40) for i in range(5)], "page_id long, url string, html string").coalesce(1)
    path = scratch_path(spark, "warc-test")
    warc.write(df, path)
    rows = warc.read(spark, path).collect()
    assert sorted(len(r.payload) for r in rows)[-1] == len(big) and len(rows) == 5
    r = next(r for r in rows if r.page_id == 1)
    with open(r.archive.removeprefix("file:"), "rb") as f:
        data = bytearray(f.read())
    data[r.offset + r.length // 2 : r.offset + r.length // 2 + 6] = b"\0\0\0\0\0\0"
    (tmp_path / "damaged.warc.gz").write_bytes(data)
    again = warc.read(spark, str(tmp_path))
    assert sorted(x.page_id for x in again.collect() if x.page_id is not None) == [0, 2, 3, 4]
    gap = warc.gaps(again).collect()
    assert [(g.offset, g.length) for g in gap] == [(r.offset, r.length)]


def foreign(kind, number, block, *extra, version="WARC/1.0", content="application/http; msgtype=response"):
    """A record as other writers make them."""
    head = [version, f"WARC-Type: {kind}", f"warc-record-id:<urn:uuid:{number:032x}>",
            "WARC-Date: 2020-01-02T03:04:05Z", *extra, f"Content-Type: {content}",
            f"CONTENT-LENGTH:  {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"


def sha1(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def others():
    body, address = b"<p>hello</p>", "WARC-Target-URI: http://a/%41?b=%20"
    return [
        (foreign("warcinfo", 1, b"software: x\r\n", content="application/warc-fields"), b"software: x\r\n"),
        (foreign("request", 2, b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", address, content="application/http;msgtype=request"), b""),
        (foreign("response", 3, HTTP + body, address, f"WARC-Block-Digest: {sha1(HTTP + body)}", f"WARC-Payload-Digest: {sha1(body)}"), body),
        (foreign("response", 4, HTTP + body, "WARC-Concurrent-To: <urn:uuid:1>", "WARC-Concurrent-To: <urn:uuid:2>", "X-Folded: one", "  two"), body),
        (foreign("resource", 5, b"\x00\xff binary", "WARC-Target-URI: <file://f>", "WARC-Block-Digest: blake9:ABC", content="image/gif"), b"\x00\xff binary"),
        (foreign("metadata", 6, b"", version="WARC/1.1", content="application/warc-fields"), b""),
        (foreign("conversion", 7, b"text", f"WARC-Block-Digest: SHA-256:{hashlib.sha256(b'text').hexdigest().upper()}", content="text/plain"), b"text"),
        (foreign("revisit", 8, HTTP, "WARC-Refers-To: <urn:uuid:3>", f"WARC-Payload-Digest: {sha1(body)}"), None),
        (foreign("continuation", 9, b"more", "WARC-Segment-Number: 2", content="text/plain"), b"more"),
    ]


@pytest.mark.parametrize("zipped", [True, False])
def test_records_of_other_writers(zipped):
    parts = [gzip.compress(r) if zipped else r for r, _ in others()]
    data = b"".join(parts)
    found = list(warc.salvage(data))
    whole(data, found)
    assert [f["payload"] for f in found] == [p for _, p in others()]
    assert [f["record_id"] for f in found] == [f"<urn:uuid:{n:032x}>" for n in range(1, 10)]
    assert {f["page_id"] for f in found} == {None} and {f["warc_date"] for f in found} == {"2020-01-02T03:04:05Z"}
    assert found[2]["url"] == "http://a/%41?b=%20" and found[2]["payload_digest"] == sha1(b"<p>hello</p>")
    assert found[4]["url"] == "file://f" and found[7]["refers_to_id"] == "<urn:uuid:3>"
    # A wrong digest is found out in base 32, too; what lies around it is read.
    bad = others()[2][0].replace(b"hello", b"hullo")
    data = parts[0] + (gzip.compress(bad) if zipped else bad) + parts[3]
    found = list(warc.salvage(data))
    whole(data, found)
    assert [f.get("gap_reason") for f in found] == [None, "block digest", None]


def test_member_of_several_records():
    data = gzip.compress(b"".join(r for r, _ in others())) + gzip.compress(others()[0][0])
    found = list(warc.salvage(data))
    whole(data, found)
    assert [f["payload"] for f in found] == [p for _, p in others()] + [others()[0][1]]


def test_plain_archives_cost_in_proportion():
    def seconds(n):
        data = b"".join(warc.record(*p) for p in made(n, 20_000))
        # Damage between records: marks that lead nowhere, and a header without an end.
        data = data + (b"WARC/1.0\r\n" + warc.MAGIC + b"x: y") * n + data
        start = time.process_time()
        found = list(warc.salvage(data))
        took = time.process_time() - start
        whole(data, found)
        assert sum("gap_reason" not in f for f in found) == 2 * n
        return took

    seconds(50)
    assert seconds(2_400) < 12 * seconds(400) + 1


def test_revisits_of_hot_and_other_payloads(spark):
    hot = "one payload of a third of the pages " * 5
    pages = [(i, f"page {i // 2} of two " * 9) for i in range(2_000)]
    pages += [(None, hot)] * 600 + [(5_000 + i, hot) for i in range(400)] + [(None, "")] * 600
    df = spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string").repartition(5)
    got = sorted((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to or 0, r.payload_bytes) for r in warc.roundtrip(df).collect())
    size = len(hot)
    wanted = [(-1, "response", 0, 0)] * 600 + [(-1, "revisit", 5_000, size)] * 600
    wanted += [(i, "revisit" if i % 2 else "response", i - 1 if i % 2 else 0, len(h)) for i, h in pages[:2_000]]
    wanted += [(5_000 + i, "revisit" if i else "response", 5_000 if i else 0, size) for i in range(400)]
    assert got == sorted(wanted)
