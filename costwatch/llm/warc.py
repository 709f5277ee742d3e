"""WARC archives: a deterministic sharded writer and a reader.

Writing
1. A narrow table of all records (ids, digests, sizes) is sorted over the whole input; running
   sums of bytes deal the order into shards of `SHARD_BYTES`, and the first key of each shard is a
   bound. The order alone decides, not how Spark dealt the rows, so reruns give the same files.
2. Of records with equal payloads of at least `min_bytes` bytes the first in order is a response,
   the others revisit it and lose their payload before the shuffle: a group of copies of any size
   moves its payload once.
3. Rows go to their shard by its bounds and are sorted there. A task writes a shard's records one
   after another, each a gzip member of its own, and begins a new file when the compressed size
   reaches `FILE_BYTES`. Headers and digests are made from the payload that is written.
4. Files get names of their own for each attempt. The list of files of the attempts that Spark
   took is written, the files are renamed, and a manifest, renamed last, commits the archive.
   Files of lost or repeated attempts are in no manifest, and readers open only what it names.
   Counts of the manifest are held against the input before that.

Records are in order of page_id, url (null last), payload digest. Null html is an empty payload;
page_id and url, null or not, come back as they were. Repeated rows are records of their own: the
first is the response, the others revisit its page_id. With an equal smallest page_id, the smaller
url is the response; rows without a page_id come last. An empty table gives a manifest without
files. `pages` must be a written table (it is read twice, in the same order); other columns are
ignored. A page is held whole in a task, a file or a shard never.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from costwatch.staging import fresh_path, stage

SHARD_BYTES = 32 << 20  # payload bytes
FILE_BYTES = 16 << 20  # compressed
RECORD_BYTES = 512  # headers, as they count for a shard
READ_BYTES = 1 << 20
READ_TASKS = 4_096
DATE = "1970-01-01T00:00:00Z"  # of all records, so that reruns give equal bytes
# Fixed values of the format.
VERSION = "WARC/1.1"
END = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "shard bigint, number bigint, name string, records bigint, responses bigint, bytes bigint, sha256 string"
RECORDS = (
    "page_id {id}, url string, record_type string, payload_bytes bigint, payload_digest string,"
    " refers_to {id}, html string"
)


def _absolute(spark: SparkSession, path: str) -> str:
    """The path with scheme and host, as tasks on other machines need it."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = jvm.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(jvm).toString()
    return found.replace("file:/", "file:///", 1) if not found.startswith("file://") else found


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def base32_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Records


def _header(fields: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, *[f"{name}: {value}" for name, value in fields.items()], f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END


def _record_id(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"


def _http(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}".encode() + END


def _target(url: str | None) -> str:
    return quote(url, safe=":/?#[]@!$&'()*+,;=%~") if url else "urn:x-page:none"


def info_record(name: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    fields = {
        "WARC-Type": "warcinfo",
        "WARC-Record-ID": _record_id(f"file {name}"),
        "WARC-Date": DATE,
        "WARC-Filename": name,
        "Content-Type": "application/warc-fields",
        "WARC-Block-Digest": f"sha1:{base32_digest(block)}",
    }
    return _header(fields, block) + block + END


def page_record(row: dict, record_name: str, response_name: str) -> bytes:
    """A response with its payload, or a revisit of the record that `refers_id` and `refers_url` name."""
    revisit = row["revisit"]
    payload = b"" if revisit else (row["html"] or "").encode()
    n_bytes, digest = len(payload), base32_digest(payload)
    if revisit:
        n_bytes, digest = row["n_bytes"], base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    block = _http(n_bytes) + payload
    page = {"page_id": row["page_id"], "url": row["url"]}
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": _record_id(record_name),
        "WARC-Date": DATE,
        "WARC-Target-URI": _target(row["url"]),
        "Content-Type": "application/http;msgtype=response",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_digest(block)}",
    }
    if revisit:
        page["refers_to"] = row["refers_id"]
        fields |= {
            "WARC-Profile": REVISIT_PROFILE,
            "WARC-Refers-To": _record_id(response_name),
            "WARC-Refers-To-Target-URI": _target(row["refers_url"]),
            "WARC-Refers-To-Date": DATE,
        }
    fields["X-Page"] = json.dumps(page)
    return _header(fields, block) + block + END


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of one record; lengths and the block's digest are checked."""
    head, end, rest = data.partition(END)
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != VERSION or not end or rest[len(block) :] != END:
        raise ValueError("not a whole WARC record")
    if fields["WARC-Block-Digest"] != f"sha1:{base32_digest(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} does not match")
    return fields, block


# Order and shards


def _order(page_id: Column, url: Column) -> list[Column]:
    return [page_id.isNull(), page_id, url.isNull(), url]


def record_keys(pages: DataFrame, *more: Column) -> DataFrame:
    """The narrow columns of every record, and more; `at` is its place in the scan."""
    payload = F.coalesce("html", F.lit(""))
    return pages.select(
        "page_id",
        "url",
        F.sha2(payload, 256).alias("key"),
        F.octet_length(payload).cast("bigint").alias("n_bytes"),
        F.monotonically_increasing_id().alias("at"),
        *more,
    )


def first_of_copies(keys: DataFrame, min_bytes: int) -> DataFrame:
    """(key, refers_id, refers_url, refers_at) of payloads that more than one record has."""
    first = F.min(F.struct(*_order(F.col("page_id"), F.col("url")), F.col("at").alias("at")))
    groups = keys.filter(F.col("n_bytes") >= min_bytes).groupBy("key")
    copies = groups.agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return copies.select(
        "key",
        F.col("first.page_id").alias("refers_id"),
        F.col("first.url").alias("refers_url"),
        F.col("first.at").alias("refers_at"),
    )


def shard_bounds(keys: DataFrame) -> list[tuple]:
    """The first record of each shard: (page_id, url, key, at), null ids as pairs that come last.

    Tasks sum the bytes of their part of the sorted keys; sums of whole parts carry over. One row
    for each part and for each shard reaches the driver.
    """
    kind = keys.schema["page_id"].dataType.simpleString()

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sums = []
            for n in batch.column("n_bytes").to_pylist():
                sums.append(total)
                total += n + RECORD_BYTES
            yield pa.record_batch([*batch.columns, pa.array(sums, pa.int64())], [*batch.schema.names, "before"])

    order = [*_order(F.col("page_id"), F.col("url")), F.col("key"), F.col("at")]
    ordered = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = f"page_id {kind}, url string, key string, n_bytes bigint, at bigint, before bigint"
    summed = stage(
        ordered.mapInArrow(running, schema).withColumn("part", F.spark_partition_id()), "ordered_records"
    )
    past, offsets = 0, [(-1, 0)]
    parts = summed.groupBy("part").agg(F.sum(F.col("n_bytes") + RECORD_BYTES).alias("n"))
    for r in parts.orderBy("part").collect():
        offsets.append((r["part"], past))
        past += r["n"]
    carried = keys.sparkSession.createDataFrame(offsets, "part int, past bigint")
    placed = summed.join(F.broadcast(carried), "part").withColumn(
        "shard", F.expr(f"(before + past) div {SHARD_BYTES}")
    )
    first = F.min(F.struct(*_order(F.col("page_id"), F.col("url")), F.col("key").alias("key"), F.col("at").alias("at")))
    rows = placed.groupBy("shard").agg(first.alias("f")).orderBy("shard").collect()
    return [_place(r["f"]["page_id"], r["f"]["url"], r["f"]["key"], r["f"]["at"]) for r in rows]


def _place(page_id, url, key, at) -> tuple:
    """What Python compares as Spark orders records: null last, strings by their bytes."""
    text = (url is None, (url or "").encode())
    return ((page_id is None, page_id if page_id is not None else 0), text, key, at)


# Writing


def _write_shard_files(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Files of the shards in sorted rows; a row of the list of files for each."""
    store, root = _open(folder)
    out = _Files(store, root, uuid.uuid4().hex)
    for batch in batches:
        for row in batch.to_pylist():
            out.add(row)
    out.close()
    if out.done:
        names = ["shard", "number", "name", "records", "responses", "bytes", "sha256", "attempt"]
        yield pa.record_batch([pa.array(c) for c in zip(*out.done)], names)


class _Files:
    """The file that is open; a shard's files follow one another."""

    def __init__(self, store: fs.FileSystem, root: str, attempt: str):
        self.store, self.folder, self.attempt = store, f"{root}/_temporary/{attempt}", attempt
        self.stream, self.shard, self.number, self.ordinal, self.done = None, None, 0, 0, []
        store.create_dir(self.folder, recursive=True)

    def add(self, row: dict) -> None:
        if row["shard"] != self.shard:
            self.close()
            self.shard, self.number, self.ordinal = row["shard"], 0, 0
        if self.stream is None:
            self.name = f"pages-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.stream = self.store.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self.size, self.records, self.responses, self.digest = 0, 0, 0, hashlib.sha256()
            self._member(info_record(self.name))
        own = f"{row['key']}/{self.shard}/{self.ordinal}"
        alone = row["small"] or row["revisit"]
        self._member(page_record(row, own if alone else row["key"], row["key"]))
        self.ordinal += 1
        self.records += 1
        self.responses += not row["revisit"]
        if self.size >= FILE_BYTES:
            self.close()
            self.number += 1

    def _member(self, record: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        data = packer.compress(record) + packer.flush()
        self.stream.write(data)
        self.digest.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None
            sums = (self.records, self.responses, self.size, self.digest.hexdigest())
            self.done.append((self.shard, self.number, self.name, *sums, self.attempt))


def _lean_rows(pages: DataFrame, copies: DataFrame, min_bytes: int) -> DataFrame:
    """Every record with its key and, unless it is a revisit, its payload."""
    payload = F.coalesce("html", F.lit(""))
    revisit = F.col("refers_at").isNotNull() & (F.col("refers_at") != F.col("at"))
    scanned = record_keys(pages, F.sha1(payload).alias("sha1"), F.col("html"))
    joined = scanned.join(copies, "key", "left").withColumn("revisit", revisit)
    return joined.select(
        "page_id", "url", "key", "n_bytes", "at", "revisit", "refers_id", "refers_url",
        (F.col("n_bytes") < min_bytes).alias("small"),
        F.when(F.col("revisit"), F.col("sha1")).alias("sha1"),
        F.when(~F.col("revisit"), F.col("html")).alias("html"),
    )


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write the pages below `folder`, which must be new, and return the manifest."""
    spark = pages.sparkSession
    folder = _absolute(spark, folder)
    store, root = _open(folder)
    if store.get_file_info(f"{root}/manifest").type != fs.FileType.NotFound:
        raise ValueError(f"{folder} holds an archive")
    keys = stage(record_keys(pages), "record_keys")
    copies = stage(first_of_copies(keys, min_bytes), "equal_payloads")
    first = shard_bounds(keys)
    bounds = spark.sparkContext.broadcast(first)

    @F.arrow_udf("bigint")
    def shard(page_id: pa.Array, url: pa.Array, key: pa.Array, at: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (page_id, url, key, at)))
        return pa.array([bisect.bisect_right(bounds.value, _place(*r)) - 1 for r in rows], pa.int64())

    order = [*_order(F.col("page_id"), F.col("url")), F.col("key"), F.col("at")]
    dealt = (
        _lean_rows(pages, copies, min_bytes)
        .withColumn("shard", shard("page_id", "url", "key", "at"))
        .repartition(max(1, len(first)), "shard")
        .sortWithinPartitions("shard", *order)
    )
    files = stage(
        dealt.mapInArrow(lambda batches: _write_shard_files(batches, folder), MANIFEST + ", attempt string"),
        "written_files",
    )
    _check_totals(files, keys, copies)
    return _commit(files, folder)


def _check_totals(files: DataFrame, keys: DataFrame, copies: DataFrame) -> None:
    """All records are written, and one response for each payload that several records share."""
    total = files.agg(F.sum("records").alias("n"), F.sum("responses").alias("r")).first()
    shared = keys.join(copies.select("key"), "key", "left_semi").count()
    n = keys.count()
    if (total["n"] or 0, total["r"] or 0) != (n, n - shared + copies.count()):
        raise ValueError(f"{total} written for {n} records; the pages were not read twice alike")


def _commit(files: DataFrame, folder: str) -> DataFrame:
    """Give the files their names, in tasks, then put the manifest in its place."""
    spark = files.sparkSession

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                start, end = f"{root}/_temporary/{row['attempt']}/{row['name']}", f"{root}/{row['name']}"
                if store.get_file_info(start).type != fs.FileType.NotFound:  # else an earlier attempt did it
                    store.move(start, end)
                if store.get_file_info(end).size != row["bytes"]:
                    raise OSError(f"{end} is not whole")
            yield batch.drop_columns(["attempt"])

    listed = f"{folder}/_temporary/manifest-{uuid.uuid4().hex}"
    files.mapInArrow(rename, MANIFEST).write.json(listed)
    store, root = _open(folder)
    store.move(_open(listed)[1], f"{root}/manifest")
    store.delete_dir(f"{root}/_temporary")  # what other attempts left
    return read_manifest(spark, folder)


# Reading


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(f"{folder}/manifest")


def _members(stream: pa.NativeFile, digest) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    packer, parts = zlib.decompressobj(31), []
    while data := stream.read(READ_BYTES):
        digest.update(data)
        while data:
            parts.append(packer.decompress(data))
            data = packer.unused_data
            if packer.eof:
                yield b"".join(parts)
                packer, parts = zlib.decompressobj(31), []
    if parts:
        raise ValueError("the last record is cut off")


def _page_row(fields: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(END)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and base32_digest(payload) != digest:
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']} does not match")
    return json.loads(fields["X-Page"]) | {
        "record_type": kind,
        "payload_bytes": int(head.rpartition(b": ")[2]),
        "payload_digest": digest,
        "html": payload.decode() if kind == "response" else None,
    }


def read_archive(spark: SparkSession, folder: str, id_kind: str = "bigint") -> DataFrame:
    """The records of a committed archive, with the payloads of responses; digests are checked."""
    folder = _absolute(spark, folder)
    manifest = read_manifest(spark, folder)
    schema = RECORDS.format(id=id_kind)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open(folder)
        for batch in batches:
            for file in batch.to_pylist():
                digest = hashlib.sha256()
                with store.open_input_stream(f"{root}/{file['name']}", compression=None) as stream:
                    yield from _batches(_members(stream, digest), file["records"])
                if digest.hexdigest() != file["sha256"]:
                    raise ValueError(f"{file['name']} is not the file of the manifest")

    def _batches(members: Iterator[bytes], expected: int) -> Iterator[pa.RecordBatch]:
        kept, size, n = [], 0, 0
        for member in members:
            fields, block = parse_record(member)
            if fields["WARC-Type"] != "warcinfo":
                kept.append(_page_row(fields, block))
                n, size = n + 1, size + len(block)
            if size > READ_BYTES:
                yield pa.RecordBatch.from_pylist(kept, arrow)
                kept, size = [], 0
        yield pa.RecordBatch.from_pylist(kept, arrow)
        if n != expected:
            raise ValueError(f"{n} of {expected} records")

    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    tasks = max(1, min(READ_TASKS, manifest.count()))
    return manifest.repartition(tasks, "name").mapInArrow(rows, schema)


def archive_digest(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back, and return a row for each page."""
    spark = pages.sparkSession
    folder = fresh_path(spark, "warc")
    write_archive(pages, folder)
    read = read_archive(spark, folder, pages.schema["page_id"].dataType.simpleString())
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH hashed AS (
  SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST, url NULLS LAST) AS place,
         first_value(page_id) OVER (
           PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST, url NULLS LAST) AS first_id
  FROM pages),
bits AS (
  SELECT *, list_transform(range(8), lambda g: ('0x' || substr(hex, 5 * g + 1, 5))::BIGINT) AS fives
  FROM hashed)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((fives[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), lambda a, b: a || b) AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN first_id END AS refers_to
FROM bits
"""
