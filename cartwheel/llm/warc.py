"""Derivatives of WARC responses: linked metadata records and plain-text conversion records.

A response record gives one metadata record (a JSON envelope with the source's headers, the HTTP
headers, the page's title and its links) and one conversion record (its text). Both name the response
in WARC-Refers-To, repeat its target and date, and carry digests of their own block; the source's payload
digest is checked and kept in WARC-Source-Payload-Digest.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import sliced, table
from cartwheel.llm.html import BLOCK, attributes, tokens

VERSION = "WARC/1.1"
CAPTURED = "2024-01-01T00:00:00Z"       # the pages table has no time of capture
_URL_ATTRIBUTES = {"a": "href", "area": "href", "link": "href", "img": "src", "script": "src", "iframe": "src", "source": "src",
                   "video": "src", "audio": "src", "embed": "src", "form": "action", "blockquote": "cite"}
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w-]+)", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def derived_id(source: str, kind: str) -> str:
    """An identifier that depends on the source record and the kind alone, so a task that runs again gives the same record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source}#{kind}')}>"


def split_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order (folded lines joined) and payload of an HTTP response. Without an empty line, all is head."""
    head, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        head, _, payload = block.partition(b"\n\n")
    lines = head.decode("latin-1").splitlines()
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in " \t" and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            headers.append((name.strip(), value.strip()))
    return (lines[0] if lines else ""), headers, payload


def page_of(html: str, base: str) -> tuple[str, str, list[dict]]:
    """Title, visible text (a line for each block) and links with absolute addresses."""
    title, lines, text, links = "", [], [], []
    anchor: dict | None = None

    def end():
        joined = " ".join(unescape("".join(text)).split())
        if joined:
            lines.append(joined)
        text.clear()

    for kind, name, source in tokens(html):
        if kind == "text":
            text.append(name)
            if anchor is not None:
                anchor["text"] += name
            continue
        if kind == "raw":
            if name == "title" and not title:
                title = " ".join(unescape(re.sub(r"^<[^>]*>|</[^<]*\Z", "", source)).split())
            if name not in ("script", "iframe"):
                continue
            source = re.match(r"<\w+([^>]*)>", source).group(1)
            kind = "open"
        elif name in BLOCK:
            end()
        if kind == "open" and name == "base":
            base = _joined(base, attributes(source).get("href", ""))
        elif kind == "open" and name in _URL_ATTRIBUTES:
            own = attributes(source)
            if target := own.get(_URL_ATTRIBUTES[name], "").strip():
                link = {"path": f"{name.upper()}@/{_URL_ATTRIBUTES[name]}", "url": _joined(base, target)}
                if rel := own.get("rel"):
                    link["rel"] = rel
                if name == "a":
                    link["text"] = ""
                    anchor = link
                links.append(link)
        elif kind == "close" and name == "a":
            anchor = None
    end()
    for link in links:
        if "text" in link:
            link["text"] = " ".join(unescape(link["text"]).split())
    return title, "\n".join(lines), links


def _joined(base: str, target: str) -> str:
    try:
        return urljoin(base, target)
    except ValueError:      # not an address, for instance half an IPv6 host
        return target


def derive(source: dict) -> list[dict]:
    """The two records of one response (see ``derivatives`` for its columns)."""
    block = source["block"] or b""
    uri = source["target_uri"] or ""
    status, http, payload = split_http(block)
    kind = next((v for n, v in http if n.lower() == "content-type"), "")
    found = digest(payload)
    given = source["payload_digest"]
    title, text, links = "", "", []
    if "html" in kind.lower() or kind.lower().startswith("text/") or not kind:
        charset = _CHARSET.search(kind)
        try:
            content = payload.decode(charset.group(1) if charset else "utf-8", "replace")
        except LookupError:
            content = payload.decode("utf-8", "replace")
        title, text, links = page_of(content, uri) if "html" in kind.lower() or not kind else ("", content, [])
    envelope = {"Envelope": {
        "WARC-Header-Metadata": {"WARC-Type": "response", "WARC-Record-ID": source["record_id"], "WARC-Target-URI": uri, "WARC-Date": source["date"],
                                 "WARC-Payload-Digest": given, "Content-Length": str(len(block))},
        "Payload-Metadata": {
            "Actual-Content-Length": str(len(payload)), "Actual-Payload-Digest": found,
            "Payload-Digest-Matches": None if given is None else given == found,
            "HTTP-Response-Metadata": {"Status-Line": status, "Headers": [list(h) for h in http],
                                       "HTML-Metadata": {"Title": title, "Links": links}}}}}
    out = []
    for warc_type, content_type, body in (("metadata", "application/json", json.dumps(envelope, ensure_ascii=False).encode("utf-8", "replace")),
                                          ("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace"))):
        out.append({"warc_type": warc_type, "record_id": derived_id(source["record_id"] or uri, warc_type), "refers_to": source["record_id"],
                    "target_uri": uri, "date": source["date"], "content_type": content_type, "block_digest": digest(body),
                    "source_payload_digest": given if given is not None else found, "n_links": len(links), "block": body})
    return out


def serialized(record: dict) -> bytes:
    """One record as a gzip member, as WARC files hold them one after the other."""
    head = [("WARC-Type", record["warc_type"]), ("WARC-Record-ID", record["record_id"]), ("WARC-Refers-To", record["refers_to"]),
            ("WARC-Target-URI", record["target_uri"]), ("WARC-Date", record["date"]), ("Content-Type", record["content_type"]),
            ("WARC-Block-Digest", record["block_digest"]), ("WARC-Source-Payload-Digest", record["source_payload_digest"]),
            ("Content-Length", str(len(record["block"])))]
    lines = [VERSION] + [f"{n}: {' '.join(v.split())}" for n, v in head if v]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + record["block"] + b"\r\n\r\n", 6, mtime=0)


_RECORD = pa.schema([("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()),
                     ("date", pa.string()), ("content_type", pa.string()), ("block_digest", pa.string()),
                     ("source_payload_digest", pa.string()), ("n_links", pa.int64()), ("block", pa.binary())])


def derivatives(responses: DataFrame, files: bool = False) -> DataFrame:
    """Metadata and conversion records of responses (record_id, target_uri, date, payload_digest, block).

    Two rows for each response, the block in full; with ``files`` also ``record``, the whole record as
    a gzip member. A null block is an empty response: the metadata has no headers and the text is
    empty. A null payload_digest is computed; one that differs is kept and reported in the metadata. A null record_id
    leaves refers_to null and the new identifiers follow the target. Responses that are not text have an
    empty conversion. Repeated rows give repeated records with equal identifiers; no rows give none.
    Other columns are not carried. Rows are independent: no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "block"):
            rows = [r for x in batch.to_pylist() for r in derive(x)]
            out = pa.RecordBatch.from_pylist(rows, schema=_RECORD)
            if files:
                out = pa.RecordBatch.from_arrays([*out.columns, pa.array([serialized(r) for r in rows], pa.binary())], names=[*_RECORD.names, "record"])
            yield out

    schema = ("warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
              "block_digest string, source_payload_digest string, n_links long, block binary" + ", record binary" * files)
    return responses.select("record_id", "target_uri", "date", "payload_digest", F.col("block").cast("binary").alias("block")).mapInArrow(run, schema)


def responses_of(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) as response records. Identifiers follow page_id and address; payload digests are left to be computed."""
    hexed = F.sha2(F.concat_ws("#", F.col("page_id").cast("string"), "url"), 256)
    record_id = F.concat(F.lit("<urn:uuid:"), *[x for a, n, dash in ((1, 8, "-"), (9, 4, "-"), (13, 4, "-"), (17, 4, "-"), (21, 12, ">"))
                                               for x in (F.substring(hexed, a, n), F.lit(dash))])
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    return pages.select("page_id", record_id.alias("record_id"), F.col("url").alias("target_uri"), F.lit(CAPTURED).alias("date"),
                        F.lit(None).cast("string").alias("payload_digest"), F.concat(head, html).cast("binary").alias("block"))


def op1_warc_derivatives(spark, sf_dir):
    """Metadata and conversion records of all pages."""
    out = derivatives(responses_of(table(spark, sf_dir, "pages")))
    return out.select("warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "source_payload_digest",
                      "n_links", F.octet_length("block").cast("long").alias("content_length"), F.sha2("block", 256).alias("block_sha256"))
