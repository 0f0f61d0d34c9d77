import base64
import gzip
import hashlib
import io
import json

from conftest_paths import SF001
from helpers import long_text

from cartwheel.llm.warc import derivatives, op1_warc_derivatives, page_of, responses_of, split_http

PAGE = ("<html><head><title>A &amp; B</title><base href='http://h/x/'><link rel=next href=n><script src='s.js'>no</script></head>"
        "<body><p>One <a href='/a?x=1&amp;y=2' rel=nofollow>two  <b>three</b></a><p>Four<img src=i.png></body>")


def block(payload, kind="text/html; charset=utf-8"):
    return f"HTTP/1.1 200 OK\r\nContent-Type: {kind}\r\nX-Folded: a\r\n b\r\nX-Two: 1\r\nX-Two: 2\r\n\r\n".encode() + payload


def sha1(x):
    return "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()


def test_page_parts():
    title, text, links = page_of(PAGE, "http://h/")
    assert title == "A & B" and text == "One two three\nFour"
    assert [(x["path"], x["url"]) for x in links] == [
        ("LINK@/href", "http://h/x/n"), ("SCRIPT@/src", "http://h/x/s.js"), ("A@/href", "http://h/a?x=1&y=2"), ("IMG@/src", "http://h/x/i.png")]
    assert links[2]["text"] == "two three" and links[2]["rel"] == "nofollow"
    assert page_of("<a href='http://[x'>t", "http://h/")[2][0]["url"] == "http://[x"


def test_http_parts():
    status, headers, payload = split_http(block(b"body"))
    assert status == "HTTP/1.1 200 OK" and payload == b"body"
    assert headers[1:] == [("X-Folded", "a b"), ("X-Two", "1"), ("X-Two", "2")]
    assert split_http(b"") == ("", [], b"")


def responses(spark, rows):
    return spark.createDataFrame(rows, "record_id string, target_uri string, date string, payload_digest string, block binary, record string")


def test_records(spark):
    payload = PAGE.encode()
    rows = [("<urn:uuid:1>", "http://h/", "2024-01-01T00:00:00Z", sha1(payload), block(payload), None),
            ("<urn:uuid:2>", "http://h/2", None, "sha1:WRONG", block("<p>é".encode("latin-1"), "text/html; charset=latin-1"), None),
            ("<urn:uuid:3>", "http://h/3", None, None, block(b"\x89PNG", "image/png"), None),
            ("<urn:uuid:4>", "http://h/4", None, None, block(b"just text", "text/plain; charset=none"), None),
            (None, None, None, None, None, None), ("<urn:uuid:1>", "http://h/", "2024-01-01T00:00:00Z", sha1(payload), block(payload), None)]
    got = derivatives(responses(spark, rows), files=True).collect()
    assert len(got) == 2 * len(rows)
    meta, text = got[0], got[1]
    assert (meta.warc_type, text.warc_type) == ("metadata", "conversion") and meta.refers_to == text.refers_to == "<urn:uuid:1>"
    assert meta.record_id != text.record_id and text.block_digest == sha1(text.block)
    assert bytes(text.block).decode() == "One two three\nFour" and text.source_payload_digest == sha1(payload)
    envelope = json.loads(bytes(meta.block))["Envelope"]
    assert envelope["WARC-Header-Metadata"]["WARC-Record-ID"] == "<urn:uuid:1>"
    own = envelope["Payload-Metadata"]
    assert own["Payload-Digest-Matches"] is True and own["HTTP-Response-Metadata"]["HTML-Metadata"]["Title"] == "A & B"
    assert meta.n_links == 4 and ["X-Two", "2"] in own["HTTP-Response-Metadata"]["Headers"]
    assert bytes(got[3].block).decode() == "é" and got[3].source_payload_digest == "sha1:WRONG"
    assert json.loads(bytes(got[2].block))["Envelope"]["Payload-Metadata"]["Payload-Digest-Matches"] is False
    assert bytes(got[5].block) == b"" and bytes(got[7].block) == b"just text" and bytes(got[9].block) == b""
    assert got[8].refers_to is None
    assert got[10].record_id == got[0].record_id
    # members of one WARC file
    with gzip.open(io.BytesIO(b"".join(bytes(r.record) for r in got))) as f:
        whole = f.read()
    for r in got:
        head = whole[:whole.index(b"\r\n\r\n")].decode().split("\r\n")
        assert head[0] == "WARC/1.1"
        fields = dict(x.split(": ", 1) for x in head[1:])
        assert fields.get("WARC-Refers-To") == r.refers_to and fields["WARC-Type"] == r.warc_type
        n = int(fields["Content-Length"])
        start = whole.index(b"\r\n\r\n") + 4
        assert whole[start:start + n] == bytes(r.block) and whole[start + n:start + n + 4] == b"\r\n\r\n"
        whole = whole[start + n + 4:]
    assert whole == b""


def test_empty_and_long(spark):
    assert derivatives(responses(spark, [])).collect() == []
    pages = spark.createDataFrame([(1, "http://a/", f"<p>{long_text(1)}</p>"), (2, None, None), (2, None, None)], "page_id long, url string, html string")
    got = derivatives(responses_of(pages)).collect()
    assert len(got) == 6 and bytes(got[1].block).decode() == long_text(1)


def test_query(spark):
    rows = op1_warc_derivatives(spark, SF001).collect()
    pages = spark.read.parquet(f"{SF001}/pages.parquet").collect()
    assert len(rows) == 2 * len(pages) and len({r.record_id for r in rows}) == len(rows)
    digests = {p.url: sha1(p.html.encode()) for p in pages}
    for r in rows:
        assert r.source_payload_digest == digests[r.target_uri] or [p.url for p in pages].count(r.target_uri) > 1
    want = {(p.url, hashlib.sha256(page_of(p.html, p.url)[1].encode()).hexdigest()) for p in pages}
    assert {(r.target_uri, r.block_sha256) for r in rows if r.warc_type == "conversion"} == want
