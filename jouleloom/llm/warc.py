"""Derivative records of web archives: metadata and plain-text conversions of response records.

A response record of a WARC file gives one metadata record and one conversion record. Both name the
response they come from and keep its target and date; digests are taken of the blocks as written. All
derived records are text, so Spark's text writer makes WARC files of them.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.llm.common import small_batches
from jouleloom.llm.htmltext import Page, title_of, visible_text

END = "\r\n"
LINK = re.compile(r"""(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
CHUNK = re.compile(rb"[ \t]*([0-9a-fA-F]{1,16})[ \t]*(?:;[^\r\n]*)?")
LANGUAGE = re.compile(r"<html[^>]*\slang\s*=\s*[\"']?([\w-]+)", re.I)

COLUMNS = {
    "record_type": "string", "record_id": "string", "refers_to": "string", "target_uri": "string", "warc_date": "string", "content_type": "string",
    "content_length": "bigint", "block_digest": "string", "payload_digest": "string", "source_headers": "map<string,string>", "record": "string",
}


def digest(block: bytes) -> str:
    """The labelled digest that WARC files use: SHA-1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    """An id that depends on the parts alone, so that a task run again gives the same one."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(parts))}>"


def fields(lines: list[str]) -> dict[str, str]:
    """Named fields of a header; a line that begins with white space goes on with the one before, and of a
    name that comes again the values are joined by a comma."""
    out: dict[str, str] = {}
    last = None
    for line in lines:
        if line[:1] in " \t" and last:
            out[last] = f"{out[last]} {line.strip()}".strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            last = next((n for n in out if n.lower() == name.strip().lower()), name.strip())
            out[last] = f"{out[last]}, {value.strip()}" if last in out else value.strip()
    return out


def get(named: dict[str, str], name: str) -> str | None:
    return next((v for n, v in named.items() if n.lower() == name.lower()), None)


def split_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The WARC fields of a record and its block, which is as long as Content-Length says."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = fields(head.decode("utf-8", "replace").split(END)[1:])
    length = get(named, "Content-Length")
    return named, rest[: int(length)] if length and length.isdigit() else rest.removesuffix(b"\r\n\r\n")


def split_response(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """The status line, the fields and the payload of an HTTP response."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("iso-8859-1").split(END)
    return lines[0], fields(lines[1:]), payload


def unchunked(payload: bytes) -> bytes:
    """A chunked body put together: as far as its chunks go, and as it is if it does not begin with one."""
    out, at = [], 0
    while at < len(payload):
        line = payload.find(b"\r\n", at)
        size = CHUNK.fullmatch(payload, at, line) if line >= 0 else None
        if size is None:
            return b"".join(out) if at else payload
        n, at = int(size[1], 16), line + 2
        if n == 0:
            break
        out.append(payload[at : at + n])
        at += n + 2
    return b"".join(out)


def unpacked(payload: bytes, coding: str) -> bytes | None:
    """A body without its content coding: as far as it can be read, as it is if nothing can (archives keep
    the header of bodies they have decoded), and none if the coding is not known here."""
    if coding in ("", "identity", "none"):
        return payload
    if coding in ("gzip", "x-gzip", "deflate"):
        kinds = (31,) if coding != "deflate" else (15, -15)
        found = (inflated(payload, k) for k in kinds)
        return next((x for x in found if x is not None), payload)
    return None


def inflated(payload: bytes, kind: int) -> bytes | None:
    """All members of a compressed body; what comes before damage; None if it does not begin as one."""
    out, rest = [], payload
    while rest:
        stream = zlib.decompressobj(kind)
        try:
            for i in range(0, len(rest), 1 << 16):
                out.append(stream.decompress(rest[i : i + (1 << 16)]))
                if stream.eof:
                    rest = stream.unused_data + rest[i + (1 << 16) :]
                    break
            else:
                break
        except zlib.error:
            break
    return b"".join(out) if any(out) or not payload else None


def body_of(http: dict[str, str], payload: bytes) -> bytes | None:
    """What a reader of the response gets: transfer and content codings undone, the last one first."""
    if "chunked" in (get(http, "Transfer-Encoding") or "").lower():
        payload = unchunked(payload)
    for coding in reversed((get(http, "Content-Encoding") or "").lower().split(",")):
        if payload is None:
            break
        payload = unpacked(payload, coding.strip())
    return payload


def write_record(kind: str, named: dict[str, str], block: str) -> dict:
    raw = block.encode()
    header = {"WARC-Type": kind, **named, "WARC-Block-Digest": digest(raw), "Content-Length": str(len(raw))}
    text = "WARC/1.1" + END + "".join(f"{n}: {v}{END}" for n, v in header.items() if v is not None) + END + block
    return {"content_length": len(raw), "block_digest": header["WARC-Block-Digest"], "record": text}


def derive(record: bytes | None) -> list[dict]:
    """The metadata and the conversion record of a response record; none of other records and of null.

    Metadata keep the HTTP status and fields of the source and tell charset, language, title, the number of
    links and the links themselves. The conversion is all text a reader would see; of a payload that is not
    HTML or text, or in a coding other than gzip and deflate, it is left out. Chunks and codings are undone first, of a
    damaged body as far as it goes; digests and the payload's length are those of the payload as stored.
    """
    if not record:
        return []
    named, block = split_record(record)
    if (get(named, "WARC-Type") or "").lower() != "response":
        return []
    status, http, payload = split_response(block)
    source = get(named, "WARC-Record-ID") or record_id(get(named, "WARC-Target-URI") or "", digest(record))
    uri, date = get(named, "WARC-Target-URI") or "", get(named, "WARC-Date") or ""
    kind = (get(http, "Content-Type") or "text/html").lower()
    body = body_of(http, payload)
    is_html, is_text = body is not None and "html" in kind, body is not None and kind.startswith("text/")
    body = body or b""
    charset = CHARSET.search(kind) or CHARSET.search(body[:2048].decode("latin-1"))
    charset = charset[1].lower() if charset else "utf-8"
    try:
        page = body.decode(charset, "replace")
    except LookupError:
        page = body.decode("utf-8", "replace")
    links, title, language, parsed = [], "", None, None
    if is_html:
        parsed = Page(page)
        for attributes in parsed.links:
            href = LINK.search(attributes)
            if href:
                links.append(" ".join((href[1] or href[2] or href[3] or "").split()))
        title, language = title_of(parsed), LANGUAGE.search(page)
    own_payload = digest(payload)
    source_headers = {**{n: v for n, v in named.items()}, **{f"HTTP-{n}": v for n, v in http.items()}, "HTTP-Status": status}
    told = [
        ("http-status", status), *((f"http-{n.lower()}", v) for n, v in http.items()), ("charset", charset), ("language", language[1] if language else ""),
        ("title", title), ("source-payload-digest", get(named, "WARC-Payload-Digest") or own_payload), ("source-block-digest", get(named, "WARC-Block-Digest") or digest(block)),
        ("payload-length", str(len(payload))), ("n-outlinks", str(len(links))), *(("outlink", x) for x in links),
    ]
    out = []

    def add(what: str, content_type: str, text: str) -> None:
        own = record_id(source, what)
        head = {
            "WARC-Record-ID": own, "WARC-Date": date, "WARC-Refers-To": source, "WARC-Refers-To-Target-URI": uri, "WARC-Refers-To-Date": date,
            "WARC-Target-URI": uri, "WARC-Payload-Digest": own_payload if what == "metadata" else None, "Content-Type": content_type,
        }
        made = write_record(what, head, text)
        payload_digest = own_payload if what == "metadata" else made["block_digest"]
        out.append(made | {"record_type": what, "record_id": own, "refers_to": source, "target_uri": uri, "warc_date": date, "content_type": content_type, "payload_digest": payload_digest, "source_headers": source_headers})

    add("metadata", "application/warc-fields", "".join(f"{n}: {' '.join(v.split())}{END}" for n, v in told if v))
    if is_html or is_text:
        add("conversion", "text/plain; charset=utf-8", visible_text(parsed) if parsed else page)
    return out


def derivatives(df: DataFrame, record: str = "record", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per derived record of the response records in column `record` (bytes), with the columns `keep`.

    Null and empty records, and records that are no responses, give none; a response with an empty payload
    gives an empty conversion. Rows that repeat derive the same records again, under the same ids.
    """
    small_batches(df.sparkSession, rows=500)

    @F.pandas_udf("array<struct<" + ",".join(f"{n}:{kind}" for n, kind in COLUMNS.items()) + ">>")
    def build(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for records in batches:
            yield pd.Series([[{n: d[n] for n in COLUMNS} for d in derive(r)] for r in records], dtype=object)

    made = df.select(*keep, F.explode(build.asNondeterministic()(F.col(record))).alias("__llm_made"))
    return made.select(*keep, "__llm_made.*")


def response_record(uri: Column, html: Column, date: str, content_type: str = "text/html; charset=utf-8") -> Column:
    """A WARC response record (bytes) around a page: JVM expressions only. A null page is an empty payload.

    Ids follow from the address and the page.
    """
    crlf = F.lit(END)
    payload = F.encode(F.coalesce(html, F.lit("")), "utf-8")
    address = F.coalesce(uri, F.lit(""))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: {content_type}{END}Content-Length: "), F.length(payload).cast("string"), crlf, crlf)
    size = (F.length(http) + F.length(payload)).cast("string")
    mark = F.md5(F.concat(F.encode(address, "utf-8"), payload))
    parts = [F.substring(mark, 1, 8), F.substring(mark, 9, 4), F.substring(mark, 13, 4), F.substring(mark, 17, 4), F.substring(mark, 21, 12)]
    head = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: response{END}WARC-Record-ID: <urn:uuid:"), F.concat_ws("-", *parts), F.lit(f">{END}WARC-Date: {date}{END}WARC-Target-URI: "),
        address, F.lit(f"{END}Content-Type: application/http; msgtype=response{END}Content-Length: "), size, crlf, crlf,
    )
    return F.concat(F.encode(head, "utf-8"), F.encode(http, "utf-8"), payload, F.encode(F.lit(END + END), "utf-8"))


def write_warc(derived: DataFrame, path: str, compression: str = "gzip") -> None:
    """Derived records as WARC files: Spark's text writer puts the two empty lines after each record."""
    derived.select("record").write.option("lineSep", END + END).option("compression", compression).text(path)
