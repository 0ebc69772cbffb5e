"""Operator 2: WARC archives and the assembly of their transactions.

``write_archives`` writes, for each page, a request, a response (or a revisit of an equal payload) and a metadata record
into gzip-per-record WARC 1.1 files; request and metadata name the capture by WARC-Concurrent-To.  ``read_records`` parses
archives, wherever a capture's records lie, and ``assemble`` joins them through the concurrent-to identifiers into one nested
row per capture.

Roles: payload digests are counted in Spark; of equal payloads of at least ``least_bytes`` bytes the largest page id is the
response.  Pages meet their digest's winner in one join whose page side may be hot (a third of all pages equal); both sides are
plain exchanges, so that adaptive execution can split it.  Payloads of revisits are not stored again.

Defined results.  A null html is an empty payload; a null url an empty target.  A null page_id is below every id.  Rows equal
in page_id, url and payload are one capture, whose ``n_copies`` counts them; the query gives it that many times.  Rows that share the largest page_id
are all responses.  Records without a response have a null response; an empty table writes no archive.  Only page_id, url and
html are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, scratch_folder, written
from .shared_files import opened, whole_file

NAME = "op2_warc_transactions"
FILE_BYTES, LEAST_BYTES = 64 << 20, 0
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b812-9dad-11d1-80b4-00c04fd430c8")  # the OID namespace of RFC 4122
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_roles(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Pages with ``response_id`` and ``response_url``: of the page that holds this payload (itself, if it is the response)."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                     F.coalesce("html", F.lit("")).alias("html")).withColumn("sha", F.sha1("html"))
    winners = written(p.where(F.octet_length("html") >= least_bytes).groupBy("sha")
                      .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url")).alias("w")).where("n > 1")
                      .select("sha", F.col("w.page_id").alias("response_id"), F.col("w.url").alias("response_url")), "op2-winners")
    # adaptive execution splits the hot digests of this join
    return p.join(winners, "sha", "left").select("page_id", "url", "html", "response_id", "response_url")


def _record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    coder = zlib.compressobj(3, zlib.DEFLATED, 31)
    return coder.compress(head.encode() + block + b"\r\n\r\n") + coder.flush()


def _capture_id(page_id, url: str, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {sha} {url}')}>"


def _uri(url: str) -> str:
    return "".join(c for c in url if c not in "\r\n")


def page_records(page_id, url: str, html: str, response_id, response_url) -> bytes:
    """The request, response or revisit, and metadata records of one page."""
    payload = html.encode()
    sha = digest(payload)
    me, uri = _capture_id(page_id, url, sha), _uri(url)
    revisit = response_url is not None and page_id != response_id
    host, _, path = uri.partition("://")[2].partition("/")
    target = ("WARC-Target-URI", uri)
    fields = f"pageId: {'' if page_id is None else page_id}\r\npayloadBytes: {len(payload)}\r\n"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    main = [target, ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{sha}")]
    if revisit:
        fields += f"refersToPage: {response_id}\r\n"
        main += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _capture_id(response_id, response_url, sha)), ("WARC-Refers-To-Target-URI", _uri(response_url))]
    beside = [target, ("WARC-Concurrent-To", me)]
    own = lambda kind: f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind} {me}')}>"
    return b"".join([
        _record("request", own("request"), [*beside, ("Content-Type", "application/http; msgtype=request")],
                f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()),
        _record("revisit" if revisit else "response", me, main, http if revisit else http + payload),
        _record("metadata", own("metadata"), [*beside, ("Content-Type", "application/warc-fields")], fields.encode())])


def write_archives(pages: DataFrame, folder: str, least_bytes: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``<folder>/part-<p>-<k>.warc.gz`` and returns the manifest (path, n_pages), a written table."""
    def make(batches):
        part, k, size, rows, manifest, out, stream = TaskContext.get().partitionId(), 0, 0, 0, [], None, None
        for batch in batches:
            for page in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "html", "response_id", "response_url"))):
                if out is None:
                    path = f"{folder}/part-{part:06d}-{k:04d}.warc.gz"
                    out = whole_file(path)
                    stream, size, rows = out.__enter__(), 0, 0
                raw = page_records(*page)
                stream.write(raw)
                size, rows = size + len(raw), rows + 1
                if size >= file_bytes:
                    out.__exit__(None, None, None)
                    manifest.append((path, rows))
                    out, k = None, k + 1
        if out is not None:
            out.__exit__(None, None, None)
            manifest.append((path, rows))
        yield pa.record_batch([pa.array([m[0] for m in manifest], pa.string()), pa.array([m[1] for m in manifest], pa.int64())], names=["path", "n_pages"])

    return written(with_roles(pages, least_bytes).mapInArrow(make, "path string, n_pages long"), "op2-manifest")


_FIELDS = ("record_id", "kind", "capture", "target_uri", "date", "content_type", "refers_to", "payload_digest", "status")


def parse(stream):
    """The records of a WARC stream: (headers with lower-case names, block)."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"not a WARC record: {line[:40]!r}")
            continue
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode()
        yield headers, stream.read(int(headers["content-length"]))


def read_records(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives: identifiers, target, digest, size and bytes of the payload, metadata fields."""
    def make(batches):
        for batch in batches:
            for path in batch["path"].to_pylist():
                rows, held = [], 0
                with opened(path) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for h, block in parse(stream):
                        kind, payload, status, fields = h["warc-type"], None, None, None
                        sha = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        if kind in ("response", "revisit"):
                            head, _, body = block.partition(b"\r\n\r\n")
                            status = head.split(b" ", 2)[1].decode()
                            if kind == "response":
                                payload = body
                                if sha != digest(payload):
                                    raise ValueError(f"the payload of {h['warc-record-id']} does not have its digest")
                        elif kind == "metadata":
                            fields = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode().split("\r\n")) if k]
                        rows.append((h["warc-record-id"], kind, h.get("warc-concurrent-to", h["warc-record-id"]), h.get("warc-target-uri"), h.get("warc-date"),
                                     h.get("content-type"), h.get("warc-refers-to"), sha, status, None if payload is None else len(payload),
                                     payload if with_payload else None, fields))
                        held += len(block)
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows):
        kinds = [*[pa.string()] * len(_FIELDS), pa.int64(), pa.binary(), pa.map_(pa.string(), pa.string())]
        return pa.record_batch([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=[*_FIELDS, "payload_bytes", "payload", "fields"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(n, "path").mapInArrow(
        make, ", ".join(f"{f} string" for f in _FIELDS) + ", payload_bytes long, payload binary, fields map<string,string>")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture, n_copies, request, response (response or revisit) and metadata."""
    def of(*kinds):
        columns = [c for c in records.columns if c not in ("capture", "fields")]
        return F.any_value(F.when(F.col("kind").isin(*kinds), F.struct(*columns)), ignoreNulls=True)

    main = F.col("kind").isin("response", "revisit")
    return records.groupBy("capture").agg(
        F.count(F.when(main, 1)).alias("n_copies"), of("request").alias("request"), of("response", "revisit").alias("response"),
        F.any_value(F.when(F.col("kind") == "metadata", F.col("fields")), ignoreNulls=True).alias("metadata"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "op2")
    manifest = write_archives(documents(spark, sf_dir, "pages"), folder)
    field = lambda name: F.nullif(F.col("metadata")[name], F.lit("")).cast("long")
    return assemble(read_records(manifest, with_payload=False)).select(
        field("pageId").alias("page_id"), field("payloadBytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"), field("refersToPage").alias("refers_to"),
        F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))).alias("copy")).drop("copy")


_BITS = "array_to_string(list_transform(range(1, 41), lambda i: ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'][instr('0123456789abcdef', sha[i])]), '')"
SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
b AS (SELECT *, {_BITS} AS bits, max(page_id) OVER (PARTITION BY html) AS top, count(*) OVER (PARTITION BY html) AS n FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + CAST(
           16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT) + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT) AS INT)]), '') AS payload_digest,
       CASE WHEN page_id = top OR top IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top OR top IS NULL THEN NULL ELSE top END AS refers_to
FROM b"""
