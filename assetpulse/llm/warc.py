"""WARC archives: writer with revisit records, and a splittable reader."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.llm.common import table
from assetpulse.session import materialize, use_checkpoint_dir


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """One gzip member per page row in files under folder. Payload: html in UTF-8, null as empty.

    Of rows with equal payloads (SHA-256 and length) of at least min_bytes, those with the smallest page_id are response
    records and the others revisit it; a group without any id is all responses. Spark's text writer carries the bytes, so
    lost tasks are rerun under its commit rules: a member ends in the zero byte of its length field, which stands as the
    line separator (an empty member follows a record of 16 MiB and more, where that byte is not zero)."""
    rows = pages.selectExpr("page_id", "url", "cast(coalesce(html, '') AS binary) AS payload")
    rows = rows.withColumn("hash", F.sha2("payload", 256)).withColumn("size", F.length("payload"))
    first = materialize(rows.where(F.col("size") >= min_bytes).groupBy("hash", "size").agg(F.min("page_id").alias("first")).where("first IS NOT NULL"))
    decided = rows.join(first, ["hash", "size"], "left").selectExpr(
        "page_id", "url", "payload", "CASE WHEN page_id = first OR first IS NULL THEN NULL ELSE first END AS refers_to"
    )

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64
        import gzip
        import hashlib
        import re

        def one(page: object, url: str | None, payload: bytes, refers: object) -> bytes:
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            revisit = not pd.isna(refers)
            page = "" if pd.isna(page) else int(page)
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
            block += b"" if revisit else payload
            head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page}>",
                    f"WARC-Target-URI: {re.sub(r'\s', '%20', url or 'urn:none')}", "WARC-Date: 2024-01-01T00:00:00Z",
                    f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
                    *([f"WARC-Refers-To: <urn:page:{int(refers)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if revisit else []),
                    "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
            data = gzip.compress("\r\n".join(head).encode() + block + b"\r\n\r\n", 6, mtime=0)
            data += b"" if data[-1] == 0 else gzip.compress(b"", mtime=0)
            return data[:-1]

        for b in batches:
            yield pd.DataFrame({"member": [one(*r) for r in zip(b["page_id"].astype("Int64"), b["url"], b["payload"], b["refers_to"].astype("Int64"), strict=True)]})

    out = decided.mapInPandas(members, "member binary")
    out.select(F.expr("cast(member AS string)").alias("value")).write.option("lineSep", "\0").text(folder)


def read_archives(spark, folder: str, range_bytes: int = 8 << 20) -> DataFrame:
    """One row per record: file, offset, headers, payload, payload_bytes, payload_digest. Tasks own byte ranges: each seeks the
    gzip magic in its range, takes a place as a member only if it decodes to a WARC header, and reads records that start inside
    to their end. Size and SHA-1 of a response are worked out from the payload read, and the job fails where the record's header
    says otherwise; a revisit has no payload and gives its header's. The folder must be one that every executor can open.
    Empty members carry no record."""
    files = spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "length")
    ranges = files.select("path", F.explode(F.expr(f"sequence(0L, length - 1, {range_bytes}L)")).alias("start"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import base64
        import hashlib
        import re
        import zlib

        from pyarrow import fs

        def checked(headers: dict[str, str], payload: bytes, place: str) -> tuple[int, str]:
            told = int(headers.get("X-Payload-Length", -1)), headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
            if headers.get("WARC-Type") == "revisit":
                return told
            own = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if own[1] != (told[1] or own[1]) or told[0] not in (-1, own[0]):
                raise ValueError(f"{place}: the payload is not the one of the header")
            return own

        def records(path: str, start: int) -> Iterator[dict]:
            system, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            with system.open_input_file(name) as source:
                size = source.size()
                data = source.read_at(min(range_bytes + 2, size - start), start)
                at = 0
                while 0 <= (at := data.find(b"\x1f\x8b\x08", at)) < range_bytes:
                    member, text, place = zlib.decompressobj(31), b"", start + at
                    try:
                        chunk = data[at : at + 4096]
                        text = member.decompress(chunk)
                        place += len(chunk)
                        valid = text.startswith(b"WARC/1.") or (len(text) < 7 and not member.eof)
                        parts = [text]
                        while valid and not member.eof and place < size:
                            chunk = source.read_at(min(1 << 20, size - place), place)
                            parts.append(member.decompress(chunk))
                            place += len(chunk)
                        text = b"".join(parts)
                        valid = member.eof and text.startswith(b"WARC/1.")
                    except zlib.error:
                        valid = False
                    if not valid:
                        at += 1
                        continue
                    head, _, rest = text.partition(b"\r\n\r\n")
                    lines = [x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:]]
                    headers = {x[0]: x[1] for x in lines if len(x) == 2}
                    payload = rest[: int(headers.get("Content-Length", 0))].partition(b"\r\n\r\n")[2]
                    length, digest = checked(headers, payload, f"{path} at {start + at}")
                    yield {"file": path, "offset": start + at, "headers": headers, "payload": payload, "payload_bytes": length, "payload_digest": digest}
                    at = place - len(member.unused_data) - start

        for b in batches:
            for path, start in zip(b["path"], b["start"], strict=True):
                out, held = [], 0
                for r in records(path, int(start)):
                    out.append(r)
                    held += len(r["payload"])
                    if len(out) >= 256 or held >= range_bytes:
                        yield pd.DataFrame(out)
                        out, held = [], 0
                if out:
                    yield pd.DataFrame(out)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(parts).mapInPandas(read, "file string, offset long, headers map<string,string>, payload binary, payload_bytes long, payload_digest string")


def op6_warc(spark, sf_dir):
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4()}"
    write_archives(table(spark, sf_dir, "pages"), folder)
    page = "cast(nullif(regexp_extract(headers['{}'], 'page:(\\\\d+)', 1), '') AS long)"
    return read_archives(spark, folder).selectExpr(
        page.format("WARC-Record-ID") + " AS page_id", "payload_bytes", "payload_digest", "headers['WARC-Type'] AS record_type",
        page.format("WARC-Refers-To") + " AS refers_to",
    )
