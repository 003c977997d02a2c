"""Web archives: whole-file gzip streams rewritten with one member per record and an offset index.

Archives are files below a folder that all tasks reach (any scheme pyarrow knows, such as file:// or
hdfs://). A file appears under its name only when complete, so a task that runs again replaces it
by the same content.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitloom.llm.store import saved

MIN_REVISIT = 1000
ROLL_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
LEVEL = 1

URN = "urn:fitloom:page:"
ROW = pa.schema([("archive", pa.string()), ("seq", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def record(kind: str, page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers: int | None = None) -> bytes:
    head = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <{URN}{'' if page is None else page}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Bytes: {size}", "Content-Type: text/html; charset=utf-8",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers is not None:
        head.append(f"WARC-Refers-To: <{URN}{refers}>")
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(blob: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and body of one record."""
    head, _, rest = blob.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    fields = {k.lower(): v for k, v in fields.items()}
    return fields, rest[: int(fields["content-length"])]


def page_of(urn: str | None) -> int | None:
    found = re.fullmatch(rf"<{URN}(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def inflated(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Bytes of a gzip file of one or more members, read once from front to end."""
    gz = zlib.decompressobj(31)
    while data := stream.read(chunk):
        while data:
            yield gz.decompress(data)
            data = gz.unused_data
            if gz.eof:
                gz = zlib.decompressobj(31)


def records(stream) -> Iterator[bytes]:
    """Whole records of an inflated archive; holds one record and one piece at a time."""
    held = bytearray()
    for piece in inflated(stream):
        held += piece
        while (end := held.find(b"\r\n\r\n")) >= 0:
            size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", held[:end])[1])
            total = end + 4 + size + 4
            if len(held) < total:
                break
            yield bytes(held[:total])
            del held[:total]
    if held.strip():
        raise ValueError("archive ends inside a record")


class Target:
    """A file that gets its name when it is closed."""

    def __init__(self, path: str):
        self.fs, self.path = pafs.FileSystem.from_uri(path)
        self.part = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out, self.at = self.fs.open_output_stream(self.part, compression=None), 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def write_monolithic(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """All pages as records of archives that are one gzip stream each; one row per record.

    A null html is an empty payload, a null url has no target line, a null id an empty record id.
    An archive ends after ``roll_bytes`` of payload.
    """

    def run(batches):
        task, number, out, held = TaskContext.get().partitionId(), -1, None, roll_bytes
        for batch in batches:
            rows = []
            for page, link, body in zip(*[c.to_pylist() for c in batch.columns]):
                if held >= roll_bytes:
                    if out:
                        out.write(gz.flush())
                        out.close()
                    number, held, seq = number + 1, 0, 0
                    out, gz = Target(f"{folder}/raw-{task:06d}-{number:04d}.warc.gz"), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                body = (body or "").encode()
                digest = hashlib.sha1(body).hexdigest()
                out.write(gz.compress(record("response", page, link, body, digest, len(body))))
                rows.append((out.path.rpartition("/")[2], seq, page, len(body), digest))
                held, seq = held + len(body), seq + 1
            yield pa.RecordBatch.from_pylist([dict(zip(ROW.names, r)) for r in rows], ROW)
        if out:
            out.write(gz.flush())
            out.close()

    kind = "archive string, seq bigint, page_id bigint, payload_bytes bigint, payload_digest string"
    return pages.select(F.col(page_id).cast("bigint"), F.col(url), F.col(html)).mapInArrow(run, kind)


def revisits(rows: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Add refers_to: of equal payloads of ``min_bytes`` or more, the largest page id; null there and for others.

    Only (digest, size, id) moves. The largest ids are stored first, so that a digest that very
    many pages share can be split in the join.
    """
    first = saved(
        rows.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"),
        "warc-first",
    )
    same = F.coalesce(F.col("page_id") == F.col("refers_to"), F.lit(False))
    return rows.join(first, ["payload_digest", "payload_bytes"], "left").withColumn(
        "refers_to", F.when(~same, F.col("refers_to"))
    )


def apart(rows: DataFrame) -> DataFrame:
    """Rows dealt by archive to as many tasks: few bytes here, but each archive is much work."""
    return rows.repartition(max(1, rows.select("archive").distinct().count()), "archive")


def normalise(decided: DataFrame, folder: str) -> DataFrame:
    """Rewrite each archive of ``decided`` (archive, seq, refers_to): every record its own gzip member.

    A record with refers_to becomes a revisit without body. Beside each archive stands an index
    file: one JSON line per record with offset, length, type and page. One row per archive.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        name = frame["archive"].iloc[0]
        refers = dict(zip(frame["seq"], frame["refers_to"]))
        source, path = pafs.FileSystem.from_uri(f"{folder}/{name}")
        out, index = Target(f"{folder}/{name.replace('raw-', 'members-')}"), Target(f"{folder}/{name.replace('raw-', 'members-')}.idx")
        with source.open_input_stream(path, compression=None) as stream:
            for seq, blob in enumerate(records(stream)):
                fields, body = parse(blob)
                page, to = page_of(fields["warc-record-id"]), refers.get(seq)
                kind = "response"
                if to is not None and not pd.isna(to):
                    kind = "revisit"
                    digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-bytes"])
                    blob = record(kind, page, fields.get("warc-target-uri"), b"", digest, size, int(to))
                gz = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                member = gz.compress(blob) + gz.flush()
                index.write(json.dumps({"offset": out.at, "length": len(member), "type": kind, "page": page}).encode() + b"\n")
                out.write(member)
        out.close()
        index.close()
        return pd.DataFrame({"archive": [name.replace("raw-", "members-")], "n": [len(frame)]})

    return apart(decided.select("archive", "seq", "refers_to")).groupBy("archive").applyInPandas(run, "archive string, n bigint")


def read_members(archives: DataFrame, folder: str) -> DataFrame:
    """Records of normalised archives, each fetched by its place in the index and checked.

    The digest and size of a response are computed from the payload that was read; a revisit
    states those of the payload it stands for.
    """

    def run(frames):
        for frame in frames:
            for name in frame["archive"]:
                source, path = pafs.FileSystem.from_uri(f"{folder}/{name}")
                with source.open_input_stream(f"{path}.idx", compression=None) as f:
                    lines = f.read().decode().splitlines()
                rows = []
                with source.open_input_file(path) as f:
                    for line in map(json.loads, lines):
                        f.seek(line["offset"])
                        fields, body = parse(zlib.decompress(f.read(line["length"]), 31))
                        digest, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(fields["x-payload-bytes"])
                        if fields["warc-type"] == "response":
                            if (hashlib.sha1(body).hexdigest(), len(body)) != (digest, size):
                                raise ValueError(f"{name}: damaged record at {line['offset']}")
                        rows.append((page_of(fields["warc-record-id"]), size, digest, fields["warc-type"], page_of(fields.get("warc-refers-to"))))
                out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    kind = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return apart(archives.select("archive")).mapInPandas(run, kind)
