"""WARC archives written by sorted shards, and read back.

Records are put in order of page id and dealt to shards by the payload bytes before them, so
the same pages give the same shards however Spark split them. What becomes of a record is
planned on ids and digests alone; the pages themselves cross the network once, to the task
of their shards, which the borders between tasks tell, and meet their plan there in order. A
shard is written by one task: one gzip member per record, without times or names that
change, a new file whenever the compressed size reaches a limit. Files are written under
temporary names and renamed when they are whole; the manifest that lists them is committed
last, by renaming its folder. Only listed files count, so a task that is run again, or two at
once, leave the same archive, and a stopped run leaves none.

Of the records with equal payloads the one with the largest page id has the payload, the
others are revisits that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import shared_dir
from .cut import cut
from .words import slices

SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
RECORD_BYTES = 512  # what the headers of a record are counted as
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 20
TASKS = 1 << 16  # most tasks that write, and so borders between them
READ_BYTES = 64 << 20
MANIFEST = "shard bigint, part bigint, path string, records bigint, bytes bigint, sha256 string"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None, digest: str) -> str:
    """The same for the same page and payload, in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _field(text: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in text)


def record(row: dict) -> bytes:
    """A whole WARC record; the digest of the block and all lengths are made from its content."""
    digest, revisit = row["digest"], row["response"] is not None
    payload = b"" if revisit else (row["html"] or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    block = http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_uri(row["page_id"], digest)), ("WARC-Date", DATE)]
    if row["url"] is not None:
        head.append(("WARC-Target-URI", _field(row["url"])))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_uri(row["response"], digest)),
                 ("Refers-To-Page-ID", str(row["response"]))]
    if row["page_id"] is not None:
        head.append(("Page-ID", str(row["page_id"])))
    head += [("Payload-Length", str(row["bytes"])), ("WARC-Payload-Digest", f"sha1:{digest}"),
             ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


class ShardWriter:
    """The files of one shard, rolled by compressed size."""

    def __init__(self, folder: str, shard: int, attempt: str, file_bytes: int):
        from pyarrow import fs

        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.shard, self.attempt, self.limit, self.part = shard, attempt, file_bytes, -1
        self.out = None
        self.listed: list[tuple] = []

    def add(self, row: dict) -> None:
        if self.out is None:
            self.part += 1
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temporary = f"{self.folder}/_temporary-{self.name}-{self.attempt}"
            self.out, self.hash, self.size, self.count = (
                self.files.open_output_stream(self.temporary, compression=None), hashlib.sha256(), 0, 0)
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member, its time left 0
        data = packer.compress(record(row)) + packer.flush()
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)
        self.count += 1
        if self.size >= self.limit:
            self.close()

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        path = f"{self.folder}/{self.name}"
        from pyarrow import fs

        if self.files.get_file_info(path).type == fs.FileType.NotFound:
            self.files.move(self.temporary, path)
        else:  # of an attempt before this one, with the same content
            self.files.delete_file(self.temporary)
        self.listed.append((self.shard, self.part, self.name, self.count, self.size, self.hash.hexdigest()))
        self.out = None


def _written(folder: str, file_bytes: int):
    """Write the shards of a task, one after the other, and list the files.

    Rows come in order of page id and digest, of equal ones the plan (``shard`` not null) first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = str(TaskContext.get().taskAttemptId())
        writer, listed, plan = None, [], {}
        for batch in batches:
            for part in slices(batch, "html"):
                for row in part.to_pylist():
                    if row["shard"] is not None:
                        plan = row
                        if writer is None or writer.shard != row["shard"]:
                            if writer is not None:
                                writer.close()
                                listed += writer.listed
                            writer = ShardWriter(folder, row["shard"], attempt, file_bytes)
                        continue
                    if (row["page_id"], row["digest"]) != (plan.get("page_id"), plan.get("digest")):
                        raise ValueError(f"page {row['page_id']} is not in the plan")
                    writer.add(row | {"bytes": plan["bytes"], "response": plan["response"]})
        if writer is not None:
            writer.close()
            listed += writer.listed
        columns = list(zip(*listed, strict=True)) if listed else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)],
            [part.split()[0] for part in MANIFEST.split(", ")])
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            payloads = [(x or "").encode() for x in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), pa.array([sha1_base32(x) for x in payloads], pa.string()),
                 pa.array([len(x) for x in payloads], pa.int64())], ["page_id", "digest", "bytes"])


def plan(pages: DataFrame, *, least_bytes: int = 0, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(page_id, digest, bytes, response, shard): what each record becomes and where it goes.

    ``response`` is null for a record that has its payload itself.
    """
    rows = cut(pages.select("page_id", "html").mapInArrow(_digests, "page_id bigint, digest string, bytes bigint"))
    largest = rows.groupBy("digest", "bytes").agg(F.max("page_id").alias("largest"))
    other = (F.col("bytes") >= least_bytes) & F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("page_id"))
    typed = rows.join(largest, ["digest", "bytes"]).select(
        "page_id", "digest", "bytes", F.when(other, F.col("largest")).alias("response"))
    size = F.when(F.col("response").isNull(), F.col("bytes")).otherwise(0) + RECORD_BYTES
    # Sums in page order: within a range of pages, and of the ranges before it (one row each).
    ranged = cut(typed.withColumn("size", size).repartitionByRange("page_id", "digest").withColumn(
        "range", F.spark_partition_id()))
    ranges = ranged.groupBy("range").agg(F.sum("size").alias("total")).select(
        "range", F.sum("total").over(Window.orderBy("range")).alias("upto"), "total")
    inside = Window.partitionBy("range").orderBy("page_id", "digest").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumn("sum", F.sum("size").over(inside)).join(F.broadcast(ranges), "range")
    before = F.col("upto") - F.col("total") + F.col("sum") - F.col("size")
    return placed.select("page_id", "digest", "bytes", "response", F.floor(before / shard_bytes).alias("shard"))


def _place(page_id: int | None, digest: str) -> tuple:
    """The order of records, as Spark sorts them."""
    return (page_id is not None, page_id or 0, digest)


def _dealt(borders: list[tuple], numbers: list[int]):
    """(page_id, url, html, digest, task): each page with the task that its place falls to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                digests = [sha1_base32((x or "").encode()) for x in part.column("html").to_pylist()]
                ids = part.column("page_id").to_pylist()
                tasks = [numbers[max(0, bisect_right(borders, _place(*key)) - 1)] for key in zip(ids, digests, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("page_id", "url", "html")), pa.array(digests, pa.string()),
                     pa.array(tasks, pa.int32())], ["page_id", "url", "html", "digest", "task"])
    return run


def qualified(pages: DataFrame, folder: str) -> str:
    """The folder with its scheme, by Hadoop's default file system."""
    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    full = files.makeQualified(path).toString()
    if full.startswith("file:") and not full.startswith("file://"):
        return f"file://{full.removeprefix('file:')}"
    return re.sub("^s3[an]:", "s3:", full)  # pyarrow's name for it


def write_archives(
    pages: DataFrame, folder: str | None = None, *, least_bytes: int = 0, shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> tuple[str, DataFrame]:
    """Write a record per row and return the folder and the manifest, as it is committed there.

    A null html is an empty payload, a null url is left out of the headers, a null page id
    comes first and is only referred to by no one. Rows that repeat a page id and payload are
    as many records. Other columns are not read. The executors need the package and a
    file system that pyarrow knows (``file``, ``hdfs``, ``s3``, ``gs``); what a store needs
    besides, such as its region, is taken from the environment.
    """
    from pyarrow import fs

    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    uri = qualified(pages, folder)
    files, path = fs.FileSystem.from_uri(uri)
    files.create_dir(path, recursive=True)
    planned = cut(plan(pages, least_bytes=least_bytes, shard_bytes=shard_bytes).dropDuplicates(["page_id", "digest"]))
    shards = (planned.agg(F.max("shard")).first()[0] or 0) + 1
    each = -(-shards // TASKS)  # shards a task writes
    task = F.floor(F.col("shard") / each).cast("int").alias("task")
    firsts = planned.groupBy(task).agg(F.min(F.struct(
        F.col("page_id").isNotNull().alias("known"), "page_id", "digest")).alias("first")).orderBy("task").collect()
    borders = [_place(r["first"]["page_id"], r["first"]["digest"]) for r in firsts]  # TASKS at most
    numbers = [r["task"] for r in firsts]
    rows = pages.select("page_id", "url", "html").mapInArrow(
        _dealt(borders, numbers), "page_id bigint, url string, html string, digest string, task int").select(
        "*", *[F.lit(None).cast("bigint").alias(c) for c in ("shard", "bytes", "response")])
    steps = planned.select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest",
        task, "shard", "bytes", "response")
    dealt = rows.unionByName(steps).repartitionById(max(numbers, default=0) + 1, F.col("task")).sortWithinPartitions(
        "page_id", "digest", F.col("shard").isNull(), "url")
    listed = cut(dealt.drop("task").mapInArrow(_written(uri, file_bytes), MANIFEST))
    return uri, _committed(listed, folder)


def _committed(listed: DataFrame, folder: str) -> DataFrame:
    """The manifest, written beside the files and made visible by one rename; then what dead attempts left goes."""
    spark = listed.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    temporary, final = f"{folder}/_manifest-{uuid.uuid4().hex}", f"{folder}/manifest"
    listed.write.parquet(temporary)
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(hadoop.Path(final)):  # of a run before this one into the same folder
        files.delete(hadoop.Path(final), True)
    if not files.rename(hadoop.Path(temporary), hadoop.Path(final)):
        raise OSError(f"{final} could not be committed")
    for left in files.globStatus(hadoop.Path(f"{folder}/_temporary-*")):
        files.delete(left.getPath(), False)
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of an archive; a folder without a committed manifest is no archive and raises."""
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The records of an archive, a gzip member at a time."""
    unpacker, parts, rest = zlib.decompressobj(31), [], b""
    while True:
        data = rest or stream.read(_CHUNK)
        if not data:
            break
        parts.append(unpacker.decompress(data))
        rest = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(parts)
            unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> dict:
    """Header fields and payload of a record, its lengths and digests checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{sha1_base32(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']}")
    payload = block.partition(b"\r\n\r\n")[2]
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != f"sha1:{sha1_base32(payload)}":
        raise ValueError(f"payload digest of {fields['WARC-Record-ID']}")
    return fields | {"payload": payload}


RECORDS = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
           "url string, html string, path string, position bigint")


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        names = [part.split()[0] for part in RECORDS.split(", ")]
        kinds = [pa.string() if part.endswith("string") else pa.int64() for part in RECORDS.split(", ")]

        def out(rows):
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for name in batch.column("path").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for position, data in enumerate(_members(stream)):
                        found = parse(data)
                        number = {k: int(found[k]) if k in found else None for k in ("Page-ID", "Refers-To-Page-ID")}
                        revisit = found["WARC-Type"] == "revisit"
                        html = found["payload"].decode() if with_payload and not revisit else None
                        rows.append((number["Page-ID"], int(found["Payload-Length"]),
                                     found["WARC-Payload-Digest"].removeprefix("sha1:"), found["WARC-Type"],
                                     number["Refers-To-Page-ID"], found.get("WARC-Target-URI"), html, name, position))
                        held += len(html or "")
                        if len(rows) >= 4096 or held > (8 << 20):
                            yield out(rows)
                            rows, held = [], 0
                yield out(rows)
    return run


def read_archives(folder: str, manifest: DataFrame, *, payloads: bool = False, read_bytes: int = READ_BYTES) -> DataFrame:
    """Every record of the files in the manifest, their order in the file as ``position``.

    About ``read_bytes`` of files go to a task, one file at least.
    """
    size = manifest.agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")).first()
    tasks = max(1, min(size["files"], max(-(-(size["bytes"] or 0) // read_bytes), manifest.sparkSession.sparkContext.defaultParallelism)))
    return manifest.select("path").repartition(tasks).mapInArrow(_read(folder, payloads), RECORDS)
