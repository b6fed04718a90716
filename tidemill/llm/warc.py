"""WARC derivatives: a metadata and a plain-text conversion record for every response.

Both name the response they come from (``WARC-Refers-To``), keep its target, date, digest and
other headers, and have digests of their own blocks. Records are rows; ``write_records`` stores them as WARC
files by Spark's own writer. Each response is handled by itself: no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.words import col, ship

RECORD = ("record_type string, record_id string, refers_to string, target_uri string, source_digest string,"
          " block_digest string, content_type string, content_length long, block string, record string")

#: A fixed name space, so that the same response gets the same identifiers in every run.
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

#: Elements whose content isn't text, and elements that end a line.
_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^<>]*>.*?(?:</\1\s*>|\Z)", re.I | re.S)
_BREAK = re.compile(r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr"
                    r"|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*>")
_TITLE = re.compile(r"<title\b[^<>]*>([^<]*)", re.I)
_LANGUAGE = re.compile(r"<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_LINK = re.compile(r"<a\b[^<>]*?\bhref\s*=", re.I)


#: Headers that describe the source's own block, not the records made from it.
OF_THE_SOURCE = {"warc-payload-digest", "warc-identified-payload-type", "warc-truncated", "warc-segment-number",
                 "warc-segment-origin-id", "warc-segment-total-length"}


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def plain_text(page: str) -> str:
    """The visible text: one line for each block element, white space collapsed, entities decoded."""
    page = _TAG.sub("", _BREAK.sub("\n", _DROPPED.sub(" ", page)))
    lines = (" ".join(line.split()) for line in html.unescape(page).split("\n"))
    return "\n".join(line for line in lines if line)


def _urn(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(10).join(parts))}>"


def response_id(uri: str, own: str, source_digest: str) -> str:
    return _urn("response", uri, own, source_digest)


def _one_line(value: str) -> str:
    return " ".join(value.split())


def derive(own: str | None, uri: str | None, date: str | None, page: str | None, record_id: str | None = None,
           payload_digest: str | None = None, headers: list[tuple[str, str | None]] | None = None) -> list[dict]:
    """The two records of one response; what isn't given is taken from its headers, or else made from the others."""
    given = {_one_line(k).lower(): _one_line(v) for k, v in headers or [] if v}
    uri, page = _one_line(uri or given.get("warc-target-uri", "")), page or ""
    date = _one_line(date or given.get("warc-date", ""))
    source = _one_line(payload_digest or given.get("warc-payload-digest", "")) or digest(page.encode())
    refers = _one_line(record_id or given.get("warc-record-id", "")) or response_id(uri, own or "", source)
    title, language = _TITLE.search(page), _LANGUAGE.search(page)
    text = plain_text(page)
    fields = {"title": _one_line(html.unescape(title[1])) if title else "", "language": language[1] if language else "",
              "outlinks": str(len(_LINK.findall(page))), "source-length": str(len(page.encode())),
              "text-length": str(len(text.encode()))}
    made = [("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields.items())),
            ("conversion", "text/plain; charset=utf-8", text)]
    out = []
    for kind, content_type, block in made:
        data = block.encode()
        record = {"record_type": kind, "record_id": _urn(kind, refers), "refers_to": refers, "target_uri": uri,
                  "source_digest": source, "block_digest": digest(data), "content_type": content_type,
                  "content_length": len(data), "block": block}
        head = {"WARC-Type": kind, "WARC-Record-ID": record["record_id"], "WARC-Date": date, "WARC-Refers-To": refers,
                "WARC-Target-URI": uri, "WARC-Refers-To-Target-URI": uri, "WARC-Source-Payload-Digest": source,
                "WARC-Block-Digest": record["block_digest"], "Content-Type": content_type,
                "Content-Length": str(len(data))}
        set_here = {k.lower() for k in head} | OF_THE_SOURCE
        head |= {_one_line(k): _one_line(v) for k, v in headers or [] if v and _one_line(k).lower() not in set_here}
        record["record"] = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items() if v) + "\r\n" + block
        out.append(record)
    return out


def derivatives(responses: DataFrame, id: str = "page_id", uri: str = "url", body: str = "html",
                date: str | None = None, record_id: str | None = None, payload_digest: str | None = None,
                headers: str | None = None) -> DataFrame:
    """``id`` and the fields of ``RECORD``: two rows for each response, its metadata and its conversion.

    ``date``, ``record_id``, ``payload_digest`` and ``headers`` (a map of names to values) name columns of what the
    response's own record says. Both records keep it, but for headers that describe the response's own block.

    Null ids, targets and bodies count as empty texts, a null date leaves its header out. Where no record id or
    payload digest is given, they are made from the response's id, target and body. Equal
    responses get equal identifiers, as repeated rows do. An empty table gives no rows.
    """
    ship(responses.sparkSession)
    kind = pa.struct([pa.field(n, pa.int64() if n == "content_length" else pa.string())
                      for n in (f.split()[0] for f in RECORD.split(","))])

    @F.arrow_udf(f"array<struct<{RECORD.replace(' string', ': string').replace(' long', ': long')}>>")
    def records(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield pa.array([derive(*row) for row in zip(*(c.to_pylist() for c in columns))], pa.list_(kind))

    fields = [col(c).cast("string") if c else F.lit(None).cast("string")
              for c in (id, uri, date, body, record_id, payload_digest)]
    fields.append((col(headers) if headers else F.lit(None)).cast("map<string,string>"))
    made = responses.select(col(id).alias("id_"), records(*fields).alias("made"))
    return made.select(F.col("id_").alias(id), F.inline("made"))


def write_records(records: DataFrame, path: str) -> None:
    """Store the records as compressed WARC files, about one for each partition."""
    records.select("record").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def op5_warc_derivatives(spark, sf_dir: str) -> DataFrame:
    return derivatives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
