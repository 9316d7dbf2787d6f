"""WARC archives: a deterministic writer in shards, and a reader.

Records go to shards by ranges of their key that hold about as many payload bytes
each; the bounds follow from running totals, not from a sample, so the same pages
give the same files. A shard's task rolls over to a new file when the compressed
one is large enough. Every record is a gzip member of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempolane.llm.files import MOST_TASKS, Committed, slots, store
from tempolane.llm.text import text_of
from tempolane.sources.shared import new_path, settled

SHARD_BYTES = 32 << 20  # payload of a shard
FILE_BYTES = 16 << 20  # a compressed file is closed beyond
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"  # no clock in the files: reruns give the same bytes
SALTS = 16
LOWEST = -(1 << 63)
MANIFEST = "file string, records long, bytes long, sha1 string"
FOUND = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, html binary"


def _record(page_id, url, payload: bytes, refers: int | None, http: bytes) -> bytes:
    """One record with its headers and digests, not compressed."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    revisit = refers is not None
    block = http if revisit else http + payload
    name = "null" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {''.join(c if c.isprintable() else '%%%02X' % ord(c) for c in url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _http(payload: bytes) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()


def _referred(pages: DataFrame) -> DataFrame:
    """(page_id, digest, n, refers): the row of each large enough payload that others
    revisit. Many pages may share one payload: its row is repeated `SALTS` times."""
    large = pages.filter(F.col("n") >= REVISIT_BYTES)
    best = large.groupBy("digest", "n").agg(F.max("page_id").alias("refers"), F.count(F.lit(1)).alias("copies"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return best.filter("copies > 1").select(F.col("digest").alias("d"), F.col("n").alias("m"), "refers", salts.alias("salt"))


def write_warc(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages, in ascending order of `key`, and return the manifest.

    The manifest (file, records, bytes, sha1) is written to `folder`/manifest when
    all files have their names; it lists the files that count. Of records with
    equal payloads of at least `REVISIT_BYTES` bytes the one with the largest key
    is a response, the others revisit it; should that page be there more than
    once, with the same payload, each of its rows is a response. Null html is an
    empty payload, a null url an empty target. Rows without a key come first and
    are responses. An empty table gives an empty manifest and no file.
    """
    spark, body = pages.sparkSession, text_of(html)
    light = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"), F.sha1(F.encode(body, "UTF-8")).alias("digest"),
        F.octet_length(body).cast("long").alias("n"),
    )
    # Running totals: within parts of the sorted keys, then over the parts.
    bounds = _bounds(light.groupBy("page_id").agg(F.sum("n").alias("n")), shard_bytes)
    own = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    refers = (
        light.join(_referred(light), [F.col("digest") == F.col("d"), F.col("n") == F.col("m"), own == F.col("salt")])
        .filter("page_id < refers").select("page_id", "digest", "refers").distinct()
    )
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers"),
        F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"), body.alias("html"),
    )
    # What a page refers to travels as a row of its own and sorts before the page:
    # payloads are shuffled once.
    rows = rows.unionByName(refers, allowMissingColumns=True)
    rows = rows.withColumn("shard", _shard_of(spark, bounds)(F.coalesce("page_id", F.lit(LOWEST))))
    tasks = min(MOST_TASKS, len(bounds) + 1)
    rows = rows.withColumn("slot", _slot_of(spark, slots(spark, tasks))("shard"))
    # A shard for a task: hashes of the numbers of shards would put several into one.
    rows = rows.repartition(tasks, "slot").select("shard", "page_id", "digest", "refers", "url", "html").sortWithinPartitions("shard", "page_id", F.col("digest").asc_nulls_last(), "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard, nth, last, known = None, None, 0, None, {}
        schema = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string())])

        def close():
            nonlocal out, nth
            out.__exit__(None)
            row = {"file": out.path.rsplit("/", 1)[1], "records": out.records, "bytes": out.size, "sha1": out.sha1.hexdigest()}
            out, nth = None, nth + 1
            return pa.RecordBatch.from_pylist([row], schema)

        try:
            for batch in batches:
                for s, page_id, digest, other, target, text in zip(*(c.to_pylist() for c in batch.columns)):
                    if digest is not None:
                        if page_id != last:
                            known.clear()
                        last, known[digest] = page_id, other
                        continue
                    if out is not None and (s != shard or out.size >= file_bytes):
                        yield close()
                    if s != shard:
                        shard, nth = s, 0
                    if out is None:
                        out = Committed(folder, f"pages-{shard:06d}-{nth:05d}.warc.gz").__enter__()
                        out.records, out.sha1 = 0, hashlib.sha1()
                    payload = text.encode("utf-8", "surrogatepass")
                    other = known.get(hashlib.sha1(payload).hexdigest()) if known and page_id == last else None
                    member = gzip.compress(_record(page_id, target, payload, other, _http(payload)), 6, mtime=0)
                    out.write(member)
                    out.records += 1
                    out.sha1.update(member)
            if out is not None:
                yield close()
        except BaseException as e:
            if out is not None:
                out.__exit__(type(e))
            raise

    return settled(rows.mapInArrow(run, MANIFEST), f"{folder}/manifest")


def _bounds(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """First keys of the shards but the first: a number for each `shard_bytes`."""
    spark = sizes.sparkSession
    parts = sizes.filter("page_id IS NOT NULL").repartitionByRange("page_id").withColumn("part", F.spark_partition_id())
    placed = parts.withColumn("before", F.sum("n").over(Window.partitionBy("part").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)))
    placed = settled(placed.select("page_id", "n", "part", F.coalesce("before", F.lit(0)).alias("before")), new_path(spark, "bounds"))
    totals = placed.groupBy("part").agg(F.sum("n").alias("total"))
    offsets = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("offset"))
    at = F.floor((F.col("before") + F.col("offset")) / shard_bytes)
    # A row per shard reaches the driver.
    found = placed.join(F.broadcast(offsets), "part").groupBy(at.alias("shard")).agg(F.min("page_id").alias("first")).orderBy("first").collect()
    return [r["first"] for r in found[1:]]


def _shard_of(spark: SparkSession, bounds: list[int]):
    """Number of bounds not above a key; a bound for each shard is sent to the tasks."""
    sent = spark.sparkContext.broadcast(np.array(bounds, dtype=np.int64))

    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(sent.value, keys.to_numpy(), side="right").astype(np.int32))

    return find


def _slot_of(spark: SparkSession, numbers: list[int]):
    """The number that stands for the task of a shard."""
    sent = spark.sparkContext.broadcast(np.array(numbers, dtype=np.int32))

    @F.pandas_udf("int")
    def find(shards: pd.Series) -> pd.Series:
        return pd.Series(sent.value[shards.to_numpy() % len(sent.value)])

    return find


def parse_record(data: io.BufferedIOBase) -> tuple[dict[str, str], bytes] | None:
    """Next record of an uncompressed stream: headers (lower-cased names) and block."""
    line = data.readline()
    while line in (b"\r\n", b"\n"):
        line = data.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    headers = {}
    while (line := data.readline().rstrip(b"\r\n")):
        name, _, value = line.decode("utf-8", "surrogatepass").partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers, data.read(int(headers["content-length"]))


def read_warc(spark: SparkSession, folder: str, manifest: DataFrame | None = None) -> DataFrame:
    """Records of the archives that the manifest lists: page_id, payload_bytes,
    payload_digest, record_type, refers_to, url, html (null for revisits).

    Files are read as streams, record by record. Digests are computed from what
    was read and compared with the headers; a mismatch stops the job. A revisit's
    payload is not in its record: its digest comes from the header, its length
    from the HTTP headers that the record repeats.
    """
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest") if manifest is None else manifest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        fields = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "html")
        schema = pa.schema(list(zip(fields, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()))))
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    data = io.BufferedReader(stream)
                    while (found := parse_record(data)) is not None:
                        rows.append(_row(*found))
                        held += len(rows[-1]["html"] or b"")
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    tasks = min(MOST_TASKS, max(1, listed.count()))
    return listed.select("file").repartitionByRange(tasks, "file").mapInArrow(run, FOUND)


def _key(text: str) -> int | None:
    name = text.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "null" else int(name)


def _row(headers: dict[str, str], block: bytes) -> dict:
    if base64.b32encode(hashlib.sha1(block).digest()).decode() != headers["warc-block-digest"].removeprefix("sha1:"):
        raise ValueError(f"block digest of {headers['warc-record-id']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
    revisit = headers["warc-type"] == "revisit"
    if revisit:
        size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    else:
        size = len(payload)
        if hashlib.sha1(payload).digest() != digest:
            raise ValueError(f"payload digest of {headers['warc-record-id']}")
    return {
        "page_id": _key(headers["warc-record-id"]), "payload_bytes": size, "payload_digest": digest.hex(),
        "record_type": headers["warc-type"], "refers_to": _key(headers["warc-refers-to"]) if revisit else None,
        "url": headers["warc-target-uri"], "html": None if revisit else payload,
    }
