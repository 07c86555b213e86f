"""WARC derivatives: metadata and plain-text conversion records for response records.

Every response yields one metadata record (facts about the response) and one conversion record (its plain text). Both
name the response in WARC-Refers-To, carry over its target URI, date and payload digest, and have identifiers that
depend on the source's alone, so a repeated run gives the same records. Digests are SHA-1 in Base32.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.store import with_text_batches

_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122, names that are URLs
_OPENING = re.compile(r"<!--|<(script|style|template|noscript|head)\b[^>]*>", re.I)
_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "template", "noscript", "head", "title")}
_TITLE = re.compile(r"<title\b[^>]*>", re.I)
_INLINE = re.compile(r"</?(?:a|abbr|b|bdi|bdo|cite|code|em|font|i|kbd|mark|q|s|samp|small|span|strong|sub|sup|u|var)\b[^>]*>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^>]*>")
_ANCHOR = re.compile(r"<a\b([^>]*)>", re.I)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HTML = re.compile(r"<html\b([^>]*)>", re.I)
_LANGUAGE = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
#: Digits of Spark's base 32 and of RFC 4648.
_COUNTING, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

VERSION, END = "WARC/1.0\r\n", "\r\n\r\n"

RESPONSE = "record_id string, target_uri string, date string, headers map<string,string>, http_headers string, payload string"
DERIVED = (
    "source_id string, warc_type string, record_id string, refers_to string, target_uri string, date string, "
    "content_type string, payload_digest string, block_digest string, content_length long, headers map<string,string>, block string"
)


def sha1_base32(content: Column) -> Column:
    """The digest of a text's UTF-8 bytes, as WARC headers write it."""
    digits = F.sha1(content.cast("binary"))
    parts = [
        F.lpad(F.conv(F.substring(digits, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)
    ]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), _COUNTING, _BASE32))


def record_digest(content: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def _split_tail(page: str) -> tuple[str, str]:
    """What stands up to the last ``>``, where every tag that begins also ends, and the rest, which holds no tag.

    So no pattern looks for the end of a tag in vain, and each runs in time linear in the page.
    """
    end = page.rfind(">") + 1
    return page[:end], page[end:]


def _visible(page: str) -> str:
    """The page without comments, scripts and the like, a line break for each; one that never ends hides the rest."""
    tagged = _split_tail(page)[0]
    kept, at, scan, endless_head = [], 0, 0, False
    while found := _OPENING.search(tagged, scan):
        tag, scan = (found[1] or "").lower(), found.end()
        if tag == "head" and endless_head:
            continue
        if tag:
            ended = _ENDS[tag].search(tagged, scan)
            end = ended.end() if ended else -1
        else:
            close = page.find("-->", scan)
            end = close + 3 if close >= 0 else -1
        if end < 0 and tag == "head":  # then no later one ends either
            endless_head = True
            continue
        kept.append(page[at : found.start()])
        if end < 0:
            return "\n".join([*kept, ""])
        at = scan = end
    begin = page.find("<!--", max(at, len(tagged)))
    return "\n".join([*kept, page[at:begin] + "\n" if begin >= 0 else page[at:]])


def plain_text(page: str) -> str:
    """All visible text, one line per block."""
    body, tail = _split_tail(_visible(page))
    body = _INLINE.sub("", body)
    lines = (" ".join(html.unescape(line).split()) for line in (_TAG.sub("\n", body.replace("\n", " ")) + tail.replace("\n", " ")).split("\n"))
    return "\n".join(line for line in lines if line)


def _title(tagged: str) -> str | None:
    begin = _TITLE.search(tagged)
    end = _ENDS["title"].search(tagged, begin.end()) if begin else None
    return " ".join(html.unescape(tagged[begin.end() : end.start()]).split()) if end else None


def _metadata(page: str, text: str, http_headers: str) -> str:
    """The fields of a metadata block."""
    tagged = _split_tail(page)[0]
    root = _HTML.search(tagged)
    language = _LANGUAGE.search(root[1]) if root else None
    targets = (_HREF.search(m[1]) for m in _ANCHOR.finditer(tagged))
    links = [html.unescape(m[1] or m[2] or m[3] or "").strip() for m in targets if m]
    status = re.match(r"HTTP/\S+ (\d{3})", http_headers)
    fields = [
        ("http-status", status[1] if status else None),
        ("title", _title(tagged)),
        ("languages-html", language[1].lower() if language else None),
        ("charCount", str(len(text))),
        *(("outlink", link) for link in links),
    ]
    return "".join(f"{name}: {' '.join(value.split())}\r\n" for name, value in fields if value is not None)


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of crawled pages (page_id, url, html).

    Identifiers come from the page's number, URL and content, so only rows that agree in all three share one.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    name = F.concat_ws(" ", F.col("page_id").cast("string"), F.col("url"), sha1_base32(payload))
    digits = F.sha1(name)
    parts = [F.substring(digits, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        F.create_map(F.lit("WARC-Payload-Digest"), sha1_base32(payload)).alias("headers"),
        http.alias("http_headers"),
        payload.alias("payload"),
    )


def derivatives(records: DataFrame) -> DataFrame:
    """Two records per response of ``records`` (columns of RESPONSE), ``metadata`` and ``conversion``.

    headers: the source's own, all kept, with WARC-Source-Header- before names that the new record sets itself. payload_digest:
    the source's WARC-Payload-Digest, or computed where it has none. A null payload counts as empty and gives an
    empty conversion; a null identifier gives null refers_to and an identifier from the target URI. Repeated
    responses give repeated records. Other columns are ignored.
    """
    names = [field.split()[0] for field in RESPONSE.split(", ")]

    def work(batches):
        for batch in batches:
            rows = [row for source in batch.to_pylist() for row in _derived(source)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_DERIVED_ARROW)

    return with_text_batches(records.select(*names)).mapInArrow(work, DERIVED)


_DERIVED_ARROW = pa.schema(
    [
        *((name, pa.string()) for name in ("source_id", "warc_type", "record_id", "refers_to", "target_uri", "date")),
        *((name, pa.string()) for name in ("content_type", "payload_digest", "block_digest")),
        ("content_length", pa.int64()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("block", pa.string()),
    ]
)
_OWN_HEADERS = frozenset(
    ("warc-type", "warc-record-id", "warc-refers-to", "warc-date", "warc-target-uri", "warc-block-digest", "content-type", "content-length")
)


def _derived(source: dict) -> list[dict]:
    page = source["payload"] or ""
    given = dict(source["headers"] or [])
    text = plain_text(page)
    digest = next((v for k, v in given.items() if k.lower() == "warc-payload-digest"), None) or record_digest(page.encode("utf-8"))
    headers = {f"WARC-Source-Header-{k}" if k.lower() in _OWN_HEADERS else k: v for k, v in given.items()}
    blocks = (
        ("metadata", "application/warc-fields", _metadata(page, text, source["http_headers"] or "")),
        ("conversion", "text/plain", text),
    )
    found = []
    for kind, content_type, block in blocks:
        content = block.encode("utf-8")
        name = uuid.uuid5(_NAMESPACE, f"{kind} {source['record_id'] or source['target_uri'] or ''}")
        found.append(
            {
                "source_id": source["record_id"],
                "warc_type": kind,
                "record_id": f"<urn:uuid:{name}>",
                "refers_to": source["record_id"],
                "target_uri": source["target_uri"],
                "date": source["date"],
                "content_type": content_type,
                "payload_digest": digest,
                "block_digest": record_digest(content),
                "content_length": len(content),
                "headers": list(headers.items()),
                "block": block,
            }
        )
    return found


def serialised(records: DataFrame) -> DataFrame:
    """record_id and the text of each derived record in a WARC/1.0 file: header lines, empty line, block, two line ends."""
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))
    kept = F.filter(F.map_entries("headers"), lambda e: e["value"].isNotNull() & (F.lower(e["key"]) != "warc-payload-digest"))
    others = F.array_join(F.transform(kept, lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit("\r\n"))), "")
    text = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.col("warc_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Target-URI", F.col("target_uri")),
        line("WARC-Date", F.col("date")),
        line("WARC-Payload-Digest", F.col("payload_digest")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("Content-Type", F.col("content_type")),
        F.coalesce(others, F.lit("")),
        line("Content-Length", F.col("content_length").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
        F.lit(END),
    )
    return records.select("record_id", text.alias("content"))


def write_warc(records: DataFrame, path: str) -> None:
    """Derived records as uncompressed WARC files, one per task."""
    text = F.col("content").substr(F.lit(1), F.length("content") - len(END))
    serialised(records).select(text).write.option("lineSep", END).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of uncompressed WARC files of UTF-8 text: headers, block, and whether the block is ``complete``.

    Spark splits the files between records, so a file of any size is read by many tasks. A block that itself holds the end
    of a record and the start of another is cut there, which its Content-Length tells: complete is then false.
    """
    rows = spark.read.option("lineSep", END + VERSION).text(path)
    record = F.regexp_replace(F.regexp_replace("value", f"^{VERSION}", ""), f"{END}$", "")
    head = F.substring_index(record, "\r\n\r\n", 1)
    lines = F.filter(F.split(head, "\r\n"), lambda line: line.contains(": "))
    pairs = F.transform(
        lines, lambda line: F.struct(F.substring_index(line, ": ", 1).alias("k"), F.regexp_replace(line, "^[^:]*: ", "").alias("v"))
    )
    # A header may stand there twice; the first counts.
    names = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    headers = F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(F.filter(pairs, lambda p: p["k"] == n), 1)["v"]))
    parsed = rows.select(record.alias("record"), F.length(head).alias("begin"), headers.alias("headers"))
    block = F.substr("record", F.col("begin") + 5)
    size = F.try_element_at("headers", F.lit("Content-Length")).try_cast("long")
    return parsed.select("headers", block.alias("block")).withColumn("complete", F.coalesce(size == F.octet_length("block"), F.lit(False)))


def responses_of(records: DataFrame) -> DataFrame:
    """The response records (columns of RESPONSE) among records that ``read_warc`` gave; incomplete ones are none."""
    value = lambda name: F.try_element_at("headers", F.lit(name))
    found = records.where("complete").where(value("WARC-Type") == "response")
    end = F.instr("block", "\r\n\r\n")
    return found.select(
        value("WARC-Record-ID").alias("record_id"),
        value("WARC-Target-URI").alias("target_uri"),
        value("WARC-Date").alias("date"),
        "headers",
        F.when(end > 0, F.substr("block", F.lit(1), end + 3)).otherwise(F.col("block")).alias("http_headers"),
        F.when(end > 0, F.substr("block", end + 4)).otherwise(F.lit("")).alias("payload"),
    )
