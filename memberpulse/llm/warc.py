"""WARC archives: a deterministic sharded writer with manifests, and the reader.

Pages are range-sorted by id into shards of about equal payload; shard bounds come from
the exact running sum of payload bytes, not from a sample, so the same pages give the same
files.  Every record is a gzip member of its own; a file is rolled once its compressed size
passes a limit.  Tasks write under temporary names that no other attempt shares; only
files named by a finished task are moved to their final names, and the manifest, written
last, is what the reader trusts.
"""

import base64
import hashlib
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from memberpulse.llm.common import Workspace, remove, slices

#: Payloads from this many bytes on are stored once; equal ones become revisits.
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, shard int, file int, records bigint, bytes bigint, sha256 string"
#: A payload that more than one in so many pages hold, and more than so many, is told by broadcast which record it revisits.
SHARES, HOT_COPIES = 10_000, 1_000_000
#: Stands for the target of a page without a URL, which the format requires.
NO_URL = "urn:x-page:none"


def _open(root: str):
    """The store of a URI or path, as tasks reach it, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if ":" in root else f"file://{root}")


# --- records --------------------------------------------------------------------------------

def record_id(page_id: int | None, url: str, digest: str, nth: int = 0) -> str:
    """An id by content; the ``nth`` repetition of a page has one of its own."""
    name = f"{page_id}|{url}|{digest}" + (f"|{nth}" if nth else "")
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def target_uri(url: str | None) -> str:
    return NO_URL if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~-._")


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    """One WARC/1.1 record as a gzip member; equal input gives equal bytes."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers.items()),
             f"WARC-Block-Digest: {_digest(block)}", f"Content-Length: {len(block)}"]
    plain = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(plain) + pack.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: tuple[int, str | None] | None, date: str,
                nth: int = 0) -> bytes:
    """The response record of a page, or its revisit record (without payload) if it refers to another page ``(id, url)``."""
    target, digest = target_uri(url), _digest(payload)
    headers = {"WARC-Record-ID": record_id(page_id, target, digest, nth), "WARC-Date": date, "WARC-Target-URI": target,
               "WARC-Payload-Digest": digest,
               "Content-Type": "application/http; msgtype=response"}
    if page_id is not None:
        headers["WARC-Page-ID"] = str(page_id)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record("response", headers, http + payload)
    other, there = refers_to[0], target_uri(refers_to[1])
    headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(other, there, digest), "WARC-Refers-To-Target-URI": there,
                "WARC-Refers-To-Date": date, "WARC-Refers-To-Page-ID": str(other)}
    return record("revisit", headers, http)


def parse_records(read) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(headers, block)`` of every gzip member that ``read(n)`` delivers, one record in memory at a time."""
    unpack, parts, rest = zlib.decompressobj(31), [], b""
    while chunk := rest or read(1 << 20):
        parts.append(unpack.decompress(chunk))
        rest = unpack.unused_data
        if unpack.eof:
            head, _, body = b"".join(parts).partition(b"\r\n\r\n")
            first, *lines = head.decode().split("\r\n")
            if first != "WARC/1.1":
                raise ValueError(f"not a WARC record: {first[:40]!r}")
            headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
            block = body[: int(headers["Content-Length"])]
            if _digest(block) != headers["WARC-Block-Digest"] or body[len(block):] != b"\r\n\r\n":
                raise ValueError(f"damaged WARC record {headers.get('WARC-Record-ID')}")
            yield headers, block
            unpack, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("truncated WARC file")


# --- writer ---------------------------------------------------------------------------------

def page_rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``(id, url, payload, size, same)``; ``same`` is the SHA-256 of payloads that are large enough to be revisited."""
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    return rows.select("*", size.alias("size"), F.when(size >= REVISIT_BYTES, F.sha2("payload", 256)).alias("same"))


def revisits(rows: DataFrame, ws: Workspace) -> DataFrame:
    """``(id, same, refers_to, refers_url)`` of the pages whose payload another page with a larger id holds.

    Works on ids, URLs and digests only, which are staged once.  The largest id of a group
    (of its rows the one with the largest URL) is combined map-side.  Payloads with more
    than their share of all pages, of which there are at most ``SHARES``, are joined by
    broadcast; each copy stays in its task.
    """
    light = ws.stage("digests", rows.where("same IS NOT NULL").select("id", "url", "same"))
    groups = light.groupBy("same").agg(F.max(F.struct("id", F.coalesce("url", F.lit("")).alias("text"), "url")).alias("kept"),
                                       F.count("*").alias("n")).where("n > 1 AND kept.id IS NOT NULL")
    groups = ws.stage("groups", groups.select("same", "n", F.col("kept.id").alias("refers_to"), F.col("kept.url").alias("refers_url")))
    pages = light.select("id", "same").distinct()
    share = max(HOT_COPIES, light.count() // SHARES)
    hot, rest = groups.where(F.col("n") > share).drop("n"), groups.where(F.col("n") <= share).drop("n")
    found = pages.join(F.broadcast(hot), "same").unionByName(
        pages.join(F.broadcast(hot.select("same")), "same", "left_anti").join(rest, "same"))
    return found.where(~F.col("id").eqNullSafe(F.col("refers_to"))).select("id", "same", "refers_to", "refers_url")


def shard_bounds(rows: DataFrame, shard_bytes: int, ws: Workspace) -> list[int]:
    """Smallest id of every shard but the first, by the exact running sum of ``size`` in id order.

    Partition sums give each partition's offset; only one number per ``shard_bytes`` of
    payload comes to the driver.
    """
    light = rows.where("id IS NOT NULL").groupBy("id").agg(F.sum("size").alias("size"))
    placed = ws.stage("sizes", light.repartitionByRange("id").select("id", "size", F.spark_partition_id().alias("part")))
    sums = placed.groupBy("part").agg(F.sum("size").alias("total"), F.min("id").alias("least"))
    before = sums.selectExpr("part", "coalesce(sum(total) OVER (ORDER BY least ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before")
    running = placed.join(F.broadcast(before), "part").selectExpr(
        "id", "before + sum(size) OVER (PARTITION BY part ORDER BY id ROWS UNBOUNDED PRECEDING) - size AS at")
    shards = running.groupBy(F.floor(F.col("at") / shard_bytes).alias("shard")).agg(F.min("id").alias("least"))
    return sorted(r["least"] for r in shards.collect())[1:]


def _writer(root: str, roll_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(root)
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        store.create_dir(f"{base}/_temporary", recursive=True)
        done, state, mark, page, written = [], None, None, None, Counter()

        def close() -> None:
            state["out"].close()
            done.append((state["path"], state["shard"], state["file"], state["records"], state["bytes"], state["sha"].hexdigest()))

        def put(data: bytes, records: int) -> None:
            state["out"].write(data)
            state["sha"].update(data)
            state["bytes"] += len(data)
            state["records"] += records

        for row in (row for batch in batches for part in slices(batch, "payload") for row in part.to_pylist()):
            if row["refers_to"] is not None:             # sorted before the page rows that it is about
                mark = row
                continue
            other = (mark["refers_to"], mark["refers_url"]) if mark and (mark["id"], mark["same"]) == (row["id"], row["same"]) else None
            if page != row["id"]:
                page, written = row["id"], Counter()         # what rows of one id have been written
            name = hashlib.sha256(repr((row["url"], row["payload"])).encode()).digest()
            nth, written[name] = written[name], written[name] + 1
            if state is None or row["shard"] != state["shard"] or state["bytes"] >= roll_bytes:
                number = state["file"] + 1 if state and row["shard"] == state["shard"] else 0
                if state:
                    close()
                path = f"{base}/_temporary/{row['shard']:06d}-{number:05d}-{attempt}.warc.gz"
                state = {"out": store.open_output_stream(path, compression=None), "path": path, "shard": row["shard"],
                         "file": number, "records": 0, "bytes": 0, "sha": hashlib.sha256()}
                name = f"{row['shard']:06d}-{number:05d}.warc.gz"
                info = {"WARC-Record-ID": record_id(None, name, ""), "WARC-Date": date, "WARC-Filename": name,
                        "Content-Type": "application/warc-fields"}
                put(record("warcinfo", info, b"format: WARC File Format 1.1\r\n"), 0)
            put(page_record(row["id"], row["url"], row["payload"], other, date, nth), 1)
        if state:
            close()
        yield from _manifest(done)
    return run


def _manifest(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    names = ["path", "shard", "file", "records", "bytes", "sha256"]
    types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _commit(root: str):
    """Move finished files to their final names; a retried task finds them there already."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = _open(root)
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                final = f"{base}/{row['shard']:06d}-{row['file']:05d}.warc.gz"
                if store.get_file_info(row["path"]).type != fs.FileType.NotFound:
                    store.move(row["path"], final)
                if store.get_file_info(final).size != row["bytes"]:
                    raise OSError(f"{final} is not the file that was written")
                rows.append((final, *list(row.values())[1:]))
            yield from _manifest(rows)
    return run


def write_warc(pages: DataFrame, root: str, shard_bytes: int = 1 << 30, roll_bytes: int = 256 << 20,
               date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files under ``root`` (in a store all tasks reach) and return the manifest.

    Payload: the html in UTF-8 (NULL: empty).  Of equal payloads of at least
    ``REVISIT_BYTES`` that with the largest id is a response record, the others are
    revisits of it, which name its record, target and date; repeated rows of the largest id
    are all responses, as are groups without any id.  Every record has an id of its own,
    repeated rows too.  A NULL url is written as ``NO_URL``.  NULL ids go to the first shard.  The same pages, options and date give
    the same files.  No page: an empty manifest.
    """
    spark = pages.sparkSession
    ws = Workspace(spark)
    rows = page_rows(pages, id_col, url_col, html_col)
    bounds = np.array(shard_bounds(rows.select("id", "size"), shard_bytes, ws), dtype=np.int64)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right").astype(np.int32))

    shard = F.when(F.col("id").isNull(), 0).otherwise(shard_of(F.coalesce(F.col("id"), F.lit(0)).cast("bigint")))
    nothing = rows.select("id", "url", "same", "payload").limit(0)
    marks = nothing.unionByName(revisits(rows, ws), allowMissingColumns=True)
    # pages and the marks of revisits meet in their shard: one shuffle of the payloads
    both = rows.select("id", "url", "same", "payload").unionByName(marks, allowMissingColumns=True).withColumn("shard", shard)
    placed = both.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(
        "shard", "id", "same", F.col("refers_to").isNull(), "url", "payload")
    written = ws.stage("written", placed.mapInArrow(_writer(root, roll_bytes, date), MANIFEST))
    written.repartition(len(bounds) + 1).mapInArrow(_commit(root), MANIFEST).write.parquet(f"{root}/manifest")
    remove(spark, f"{root}/_temporary")
    ws.drop("sizes", "written", "digests", "groups")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


# --- reader ---------------------------------------------------------------------------------

def _reader(root: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _open(root)
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as f:
                    for headers, block in parse_records(f.read):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rpartition(b"Content-Length: ")[2])
                        sha1 = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        response = headers["WARC-Type"] == "response"
                        if response and (len(payload) != length or hashlib.sha1(payload).hexdigest() != sha1):
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} doesn't match its digest")
                        page, other = headers.get("WARC-Page-ID"), headers.get("WARC-Refers-To-Page-ID")
                        url = headers["WARC-Target-URI"]
                        rows.append((int(page) if page else None, None if url == NO_URL else url, length, sha1, headers["WARC-Type"],
                                     int(other) if other else None, payload if response and with_payload else None))
                        size += len(payload) if with_payload else 100
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    return run


def read_warc(spark: SparkSession, root: str, with_payload: bool = True) -> DataFrame:
    """Every page record of the files that the manifest of ``root`` names, digests verified.

    ``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)``:
    bytes and digest (hex) are of the full payload, for revisits too; ``url`` is
    percent-encoded, NULL as it was written; a revisit's ``payload`` is NULL.  A damaged or missing file fails.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{root}/manifest").select("path")
    files = files.repartition(max(1, files.count()))
    return files.mapInArrow(_reader(root, with_payload), "page_id bigint, url string, payload_bytes bigint, "
                            "payload_digest string, record_type string, refers_to bigint, payload binary")
