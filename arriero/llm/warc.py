"""WARC archives of gzip members: a writer that stores equal payloads once, and a splittable reader.

Spark's own text source cuts the byte ranges: with gzip's magic as the line separator every task gets the pieces between magics
that start in its range, whatever the file system. A piece counts as a member only if it inflates to a WARC header; a magic that
occurs by chance inside compressed data splits a member, and the reader puts the pieces together again, within its range at once
and across ranges in a second step over those rare rows. A record belongs to the range in which its member starts.

Archives are named .txt by Spark; Hadoop would take a name that ends in .gz as one unsplittable stream.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arriero.session import scratch_dir
from arriero.sinks.tables import written

# The magic of a deflate gzip member, an empty member, and record headers of the format.
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit has no block."""
    name = lambda i: "<urn:page:%s>" % ("" if i is None else i)
    head = [VERSION.decode(), f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", "WARC-Date: 2024-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest(payload)}", f"Content-Length: {0 if revisit else len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(("\r\n".join(head) + "\r\n\r\n").encode("utf-8", "replace")) + packer.compress(b"" if revisit else payload) + packer.compress(b"\r\n\r\n") + packer.flush()


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, refers, html = (batch.column(c) for c in ("page_id", "url", "refers_to", "html"))
        out, size = [], 0
        for i in range(len(batch)):
            text = html[i].as_py() or b""
            r = refers[i].as_py()
            out.append(member(ids[i].as_py(), urls[i].as_py(), text, r, r is not None))
            size += len(out[-1])
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])


def write_pages(pages: DataFrame, root: str, least_bytes: int = 0) -> None:
    """Archive ``pages`` (page_id, url, html) under ``root``. Among payloads of at least ``least_bytes`` that are equal, the one with
    the largest page_id is stored and the others refer to it. A null html is an empty payload."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html")).withColumn("sha", F.sha1("html"))
    keepers = rows.where(F.octet_length("html") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1 and keep is not null").select("sha", "keep")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keep")), F.col("keep")).alias("refers_to")
    packed = rows.join(keepers, "sha", "left").select("page_id", "url", "html", refers).mapInArrow(_members, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(root)


_RECORD = "kind string, file string, start long, seq long, page_id long, record_type string, url string, payload_bytes long, payload_digest string, refers_to long, valid boolean, payload binary, rest binary"
_NAMES = [c.split(" ")[0] for c in _RECORD.split(", ")]


def _rows(records: list[dict]) -> pd.DataFrame:
    """Records as rows; columns that no record fills stay untyped nulls rather than numbers."""
    whole = ("payload_bytes", "page_id", "refers_to", "start", "seq")
    return pd.DataFrame(records, columns=_NAMES).astype({c: "Int64" if c in whole else object for c in _NAMES})


def _number(text: str | None) -> int | None:
    tail = (text or "").rstrip(">").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def parse(data: bytes, with_payload: bool) -> dict | None:
    """The record in an inflated member, or None for an empty member."""
    if not data:
        return None
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict((k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:]))
    size = int(fields.get("content-length", "0"))
    payload = block[:size]
    told = fields.get("warc-payload-digest", "").rpartition(":")[2]
    whole = fields.get("warc-type") != "revisit"
    return {"kind": "record", "page_id": _number(fields.get("warc-record-id")), "record_type": fields.get("warc-type"), "url": fields.get("warc-target-uri"),
            "payload_bytes": size if whole else None, "payload_digest": told, "refers_to": _number(fields.get("warc-refers-to")),
            "valid": len(payload) == size and (not whole or digest(payload) == told), "payload": payload if whole and with_payload else None}


def _begin(data: bytes):
    """(inflater, output so far) if the bytes begin a member whose content begins as a record or is empty, else None."""
    inflater = zlib.decompressobj(31)
    try:
        out = inflater.decompress(data)
    except zlib.error:
        return None
    if out[:5] != b"WARC/"[: len(out[:5])] or (not out and not inflater.eof and len(data) > 64):
        return None
    return inflater, out


def _pieces(with_payload: bool):
    """Members from the pieces between magics, range by range. What no member of the range claims leaves as a tail (a member begun
    here that goes on behind the range) or an orphan (a piece that may belong to a member begun before it)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, seq, begun, state, raw = None, 0, 0, None, b""

        def left() -> dict:
            return {"kind": "tail" if state[1] else "orphan", "file": where[0], "start": where[1], "seq": begun, "rest": raw}

        for pdf in batches:
            out: list[dict] = []
            for file, start, piece in zip(pdf.file, pdf.start, pdf.piece):
                if (file, start) != where:
                    if state:
                        out.append(left())
                    where, seq, state, raw = (file, start), 0, None, b""
                    if start == 0:  # what stands before a file's first magic
                        continue
                seq += 1
                data = MAGIC + piece
                if state and not state[1]:  # begun without a byte of content yet: a piece that surely begins a record comes first
                    alone = _begin(data)
                    if alone and alone[1]:
                        out.append(left())
                        state, raw, begun = alone, data, seq
                        data = None
                if state and data is not None:
                    try:
                        more = state[0].decompress(data)
                        state, raw = (state[0], state[1] + more), raw + data
                        data = None
                    except zlib.error:  # a member cut short, or no member at all
                        out.append({**left(), "kind": "broken" if state[1] else "orphan"})
                        state = None
                if not state:
                    state, raw, begun = _begin(data), data, seq
                    if not state:
                        out.append({"kind": "orphan", "file": file, "start": start, "seq": seq, "rest": data})
                        continue
                if state[0].eof:
                    record = parse(state[1], with_payload)
                    if record:
                        out.append({**record, "file": file, "start": start, "seq": begun})
                    state = None
            yield _rows(out)
        if state:
            yield _rows([left()])

    return run


def _rejoined(with_payload: bool):
    """Members that a chance magic split at the border of two ranges: a tail goes on in the orphans that open the next ranges."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out, held, first = [], None, None
        for row in pdf.sort_values(["start", "seq"], kind="stable").itertuples():
            if row.kind == "tail" or held is None:
                held, first = bytes(row.rest), row
            else:
                held += bytes(row.rest)
            state = _begin(held)
            if state is None:
                held = None
            elif state[0].eof:
                record, held = parse(state[1], with_payload), None
                if record:
                    out.append({**record, "file": first.file, "start": first.start, "seq": first.seq})
        return _rows(out)

    return run


def read_records(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """file, page_id, record_type, url, payload_bytes, payload_digest, refers_to, valid (length and digest hold) and payload of every
    record below ``root``. Empty members are skipped, a member cut short by damage is left out; an empty folder of archives gives no rows."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(root)
    pieces = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("piece"))
    parsed = written(pieces.mapInPandas(_pieces(with_payload), _RECORD), "records")
    late = parsed.where("kind in ('tail', 'orphan')").groupBy("file").applyInPandas(_rejoined(with_payload), _RECORD)
    return parsed.where("kind = 'record'").union(late).drop("kind", "start", "seq", "rest")


def archived(pages: DataFrame, root: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` to archives, read them back, and return page_id, payload_bytes, payload_digest, record_type and refers_to per page.

    Rows that repeat a page_id stay separate records; of equal payloads all rows with the largest page_id are responses. A null
    page_id is stored without a number and, beside an equal payload, refers to it. A null url is left out of its record. An empty
    table gives an empty result. A revisit's length is that of the response it refers to.
    """
    spark = pages.sparkSession
    root = root or f"{scratch_dir(spark, 'warc')}/archives"
    write_pages(pages, root, least_bytes)
    records = read_records(spark, root, with_payload=False)
    lengths = records.where("record_type = 'response' and valid").groupBy(F.col("page_id").alias("p"), F.col("payload_digest").alias("g")).agg(F.max("payload_bytes").alias("known"))
    return records.join(lengths, (F.col("refers_to") == F.col("p")) & (F.col("payload_digest") == F.col("g")), "left").select(
        "page_id", F.coalesce("payload_bytes", "known").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
