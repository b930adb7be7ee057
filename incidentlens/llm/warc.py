"""A deterministic sharded WARC writer, and a reader (operator 3).

Records are sorted by key, digest of the payload and URL over the whole table, and cut
into shards where their bytes, added up in that order, reach the next multiple of a
shard's size; so shards are even whatever the keys are, also if a third of the records
has one key or none. Each is written one compressed member per record; a file is closed
when its compressed size reaches the limit. Headers and digests are made anew from
the payload. Tasks write under temporary names and return manifest rows; only what
the committed manifest lists gets its final name, so a lost or repeated attempt
leaves nothing behind. Equal input gives equal files, however it is partitioned.

Of equal payloads of at least ``min_repeat`` bytes the one with the largest key is
a response and the others revisit it.

Defined results: a NULL payload is empty; records of equal key and payload are
written each, as responses if theirs is the largest key; a record without a key
sorts first; a NULL URL has no target header; without rows there are no files;
other columns are not looked at.
"""

import gzip
import hashlib
import zlib
from bisect import bisect_right

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from incidentlens.llm.blocks import rows_of
from incidentlens.sources.files import exists, qualified
from incidentlens.sources.scratch import materialise, remove

BROADCAST_REPEATS = 200_000
DATE = "2000-01-01T00:00:00Z"  # of every record: archives don't depend on when they are made
MANIFEST = "shard int, sequence int, file string, temporary string, records long, bytes long, sha1 string"


def _open(uri: str):
    """The Arrow file system of a path with a scheme, and the path in it."""
    from pyarrow import fs

    if "://" in uri and not uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")


def _headers(version: str, fields: list[tuple[str, object]]) -> bytes:
    lines = [version, *(f"{name}: {value}" for name, value in fields)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _line(text: str) -> str:
    """A header value: line ends would end the header."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\r" in text or "\n" in text else text


def record(key, url: str | None, payload: bytes, refers_to) -> bytes:
    """One uncompressed record; ``refers_to`` is the key of the response, if a revisit."""
    is_revisit = refers_to is not None
    http = _headers(
        "HTTP/1.1 200 OK",
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))],
    )
    block = http if is_revisit else http + payload
    fields: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if is_revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if key is None else key}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"),
        ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _line(url)))
    if is_revisit:
        fields.append(("WARC-Refers-To", f"<urn:page:{refers_to}>"))
        fields.append(
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        )
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    return _headers("WARC/1.1", fields) + block + b"\r\n\r\n"


def _read_headers(stream) -> dict[str, str] | None:
    first = stream.readline()
    if not first:
        return None
    found = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.decode().partition(": ")
        found[name] = value
    return found


def records(stream):
    """(key, payload bytes, payload digest, type, refers to) of an archive's records.

    The payload of a response is checked against its digests.
    """
    number = lambda uri: int(n) if (n := uri.removeprefix("<urn:page:").rstrip(">")) else None
    with gzip.GzipFile(fileobj=stream) as archive:
        while (fields := _read_headers(archive)) is not None:
            block = archive.read(int(fields["Content-Length"]))
            archive.read(4)
            if fields["WARC-Type"] == "warcinfo":
                continue
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if hashlib.sha1(block).hexdigest() != fields["WARC-Block-Digest"].removeprefix("sha1:"):
                raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
            http, _, payload = block.partition(b"\r\n\r\n")
            size = int(http.rpartition(b"Content-Length: ")[2])
            if fields["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"wrong payload digest in {fields['WARC-Record-ID']}")
            refers_to = number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
            yield number(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers_to


class _File:
    def __init__(self, folder: str, shard: int, sequence: int, attempt: int):
        self.system, place = _open(folder)
        self.shard, self.sequence = shard, sequence
        self.file = f"shard-{shard:06d}-{sequence:05d}.warc.gz"
        self.temporary = f"_temporary/{self.file}.{attempt}"
        self.system.create_dir(f"{place}/_temporary", recursive=True)
        self.stream = self.system.open_output_stream(f"{place}/{self.temporary}", compression=None)
        self.count = self.size = 0
        self.digest = hashlib.sha1()
        about = f"software: incidentlens\r\nformat: WARC File Format 1.1\r\nshard: {shard}\r\n".encode()
        fields = [
            ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:file:{self.file}>"), ("WARC-Date", DATE),
            ("WARC-Filename", self.file), ("Content-Type", "application/warc-fields"),
            ("Content-Length", len(about)),
        ]
        self.add(_headers("WARC/1.1", fields) + about + b"\r\n\r\n", 6)
        self.count = 0

    def add(self, data: bytes, level: int) -> None:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.stream.write(member)
        self.digest.update(member)
        self.size += len(member)
        self.count += 1

    def close(self) -> tuple:
        self.stream.close()
        return (
            self.shard, self.sequence, self.file, self.temporary, self.count, self.size,
            self.digest.hexdigest(),
        )


_ROW = pa.schema(
    [
        ("shard", pa.int32()), ("sequence", pa.int32()), ("file", pa.string()), ("temporary", pa.string()),
        ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string()),
    ]
)


def _writer(folder: str, limit: int, level: int):
    def write(batches):
        attempt, out, closed = TaskContext.get().taskAttemptId(), None, []
        for shard, key, url, payload, refers_to in rows_of(batches, 64):
            if out is None or out.shard != shard or out.size >= limit:
                sequence = out.sequence + 1 if out and out.shard == shard else 0
                if out:
                    closed.append(out.close())
                out = _File(folder, shard, sequence, attempt)
            out.add(record(key, url, payload or b"", refers_to), level)
        if out:
            closed.append(out.close())
        if closed:
            columns = zip(*closed, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _ROW, strict=True)], schema=_ROW
            )

    return write


def _namer(folder: str):
    def rename(batches):
        system, place = _open(folder)
        for batch in batches:
            for file, temporary in zip(*(c.to_pylist() for c in batch.select(["file", "temporary"]).columns), strict=True):
                if system.get_file_info(f"{place}/{temporary}").is_file:  # else an earlier attempt did it
                    if system.get_file_info(f"{place}/{file}").is_file:  # left by a run that was lost
                        system.delete_file(f"{place}/{file}")
                    system.move(f"{place}/{temporary}", f"{place}/{file}")
            yield batch

    return rename


_ORDER = ["key", "digest", "link"]


def _cuts(slim: DataFrame, shard_bytes: int) -> list[tuple]:
    """The first record of each shard but the first one: (key, digest, link), rising.

    Bytes are added up within the partitions of a range sort, and after those of the
    partitions before. The list is as long as there are shards.
    """
    by = [F.col("key").asc_nulls_first(), "digest", "link"]
    ranged = slim.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ranged = materialise(ranged, "ranged").withColumn("task", F.shiftright("at", 33))
    sums = ranged.groupBy("task").agg(F.sum("bytes").alias("sum"))  # a row per partition
    before = F.sum("sum").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("task", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum("bytes").over(Window.partitionBy("task").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.join(F.broadcast(offsets), "task").withColumn("start", F.coalesce(within, F.lit(0)) + F.col("before"))
    shard = F.expr(f"start div {shard_bytes}")
    firsts = placed.groupBy(shard.alias("shard")).agg(F.min(F.struct(F.col("key").isNotNull(), *_ORDER)).alias("first"))
    found = sorted((r["shard"], r["first"][1:]) for r in firsts.select("shard", "first").collect())
    return [first for _, first in found][1:]


def _place(key: int | None, digest: str, link: int) -> tuple:
    return key is not None, key or 0, digest, link


def _sharded(cuts: list[tuple]):
    """Adds the shard: the number of cuts at or before a record."""
    places = [_place(*cut) for cut in cuts]

    def add(batches):
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in _ORDER]
            shards = [bisect_right(places, _place(*row)) for row in zip(*columns, strict=True)]
            yield batch.append_column("shard", pa.array(shards, pa.int32()))

    return add


def write(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html",
    min_repeat: int = 1000, shard_bytes: int = 1 << 30, file_bytes: int | None = None, level: int = 6,
) -> DataFrame:
    """Writes the archives below ``folder``; returns the manifest, which is there too.

    ``shard_bytes`` of payload at most are a task's work; ``file_bytes`` of compressed data
    close a file: a sixteenth of a shard's payload by default, 1 MiB at least, so that a
    shard makes some files. A folder that already has a complete manifest is an error; what
    a run that was lost has left without one is written over.
    """
    spark: SparkSession = pages.sparkSession
    folder = qualified(spark, folder)
    content = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), content.alias("payload"))
    if exists(spark, f"{folder}/_manifest/_SUCCESS"):
        raise FileExistsError(f"{folder} has archives already")
    for left in ("_written", "_manifest", "_temporary"):
        remove(spark, f"{folder}/{left}")
    rows = rows.withColumns({"digest": F.sha1("payload"), "link": F.xxhash64("url")})
    size = F.octet_length("payload").cast("long")
    slim = materialise(rows.select(*_ORDER, size.alias("size"), (size + 400).alias("bytes")), "payloads")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = slim.agg(F.sum("bytes")).first()[0] or 0
    target = max(1, min(shard_bytes, -(-total // partitions)))
    cuts = _cuts(slim, target)
    repeats = (
        slim.where(F.col("size") >= min_repeat)
        .groupBy("digest")
        .agg(F.max("key").alias("response"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "response")
    )
    repeats = materialise(repeats, "repeats")
    if repeats.count() <= BROADCAST_REPEATS:
        repeats = F.broadcast(repeats)
    is_revisit = (F.octet_length("payload") >= min_repeat) & ~F.col("key").eqNullSafe(F.col("response"))
    dealt = (
        rows.join(repeats, "digest", "left")
        .select("key", "digest", "link", "url", "payload", F.when(is_revisit, F.col("response")).alias("refers_to"))
        .mapInArrow(_sharded(cuts), "key long, digest string, link long, url string, payload binary, refers_to long, shard int")
        .repartitionById(len(cuts) + 1, "shard")
        .sortWithinPartitions("shard", "key", "digest", "link", "url")
        .select("shard", "key", "url", "payload", "refers_to")
    )
    written = dealt.mapInArrow(_writer(folder, file_bytes or max(1 << 20, target // 16), level), MANIFEST)
    written.write.parquet(f"{folder}/_written")
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_written")
    manifest.repartition(partitions, "file").mapInArrow(_namer(folder), MANIFEST).drop(
        "temporary"
    ).write.parquet(f"{folder}/_manifest")
    remove(spark, f"{folder}/_temporary")
    remove(spark, f"{folder}/_written")
    return spark.read.parquet(f"{folder}/_manifest")


READ = "{key} long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(manifest: DataFrame, folder: str, key: str = "page_id") -> DataFrame:
    """The records of the archives a manifest lists; a file is read as a stream."""
    folder = qualified(manifest.sparkSession, folder)
    schema = pa.schema(
        [
            (key, pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()),
        ]
    )

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
        )

    def parse(batches):
        system, place = _open(folder)
        for names in batches:
            for name in names.column(0).to_pylist():
                rows = []
                with system.open_input_stream(f"{place}/{name}", compression=None) as stream:
                    for row in records(stream):
                        rows.append(row)
                        if len(rows) == 1000:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    partitions = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("file").repartition(partitions, "file").mapInArrow(parse, READ.format(key=key))
