"""WARC archives: a monolithic gzip writer, its normaliser, and reading by index.

1. ``write_archives`` writes one file a task, all records in one gzip stream, and gives
   a row for each record with its file, payload size and SHA-256.
2. ``duplicates`` names, from those rows alone, the records whose payload an earlier
   page has. The payloads themselves are never shuffled.
3. ``normalise`` inflates each file once as a stream, writes every record as a gzip
   member of its own, revisit records in place of repeated payloads, and gives the
   sidecar index: file, offset and length of each member.
4. ``read_records`` reads members by that index.

Tasks read and write the shared folder through ``pyarrow.fs``, which knows local, HDFS
and object-store addresses. File names carry the number of the task attempt and only a
finished task's rows are kept, so a repeated or speculative task harms nothing; a lost
executor costs the files its tasks were writing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored
from millrace.runtime import work_folder

#: Smaller payloads are always written in full.
LEAST_REVISITED = 100
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_WRITTEN = "file string, page_id bigint, payload_bytes bigint, payload_digest string"
_INDEX = "file string, offset bigint, length bigint, page_id bigint, record_type string"
_READ = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string"
)


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _gzip():
    return zlib.compressobj(6, zlib.DEFLATED, 31)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None = None
) -> bytes:
    """One record: a response with the payload, or a revisit of another page without."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if url is not None:
        safe = url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
        payload = b""
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parsed(head: bytes) -> dict[str, str]:
    """The fields of a record's head, names in lower case."""
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:80]!r}")
    fields = (line.split(":", 1) for line in lines[1:] if line)
    return {name.lower(): value.strip() for name, value in fields}


def _page(fields: dict[str, str], name: str) -> int | None:
    value = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _url(fields: dict[str, str]) -> str | None:
    value = fields.get("warc-target-uri")
    return value and value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of inflated data, one held at a time."""
    data = bytearray()

    def fill(n: int) -> bool:
        while len(data) < n:
            more = next(chunks, None)
            if more is None:
                return False
            data.extend(more)
        return True

    while fill(1):
        while (end := data.find(b"\r\n\r\n")) < 0:
            if not fill(len(data) + 1):
                raise ValueError("the file ends inside a record's head")
        fields = parsed(bytes(data[:end]))
        size = int(fields["content-length"])
        if not fill(end + 4 + size + 4):
            raise ValueError("the file ends inside a record")
        payload = bytes(data[end + 4 : end + 4 + size])
        del data[: end + 4 + size + 4]
        yield fields, payload


def inflated(source: pa.NativeFile) -> Iterator[bytes]:
    """The data of a gzip file of one or more members, in chunks of bounded size."""
    inflate = zlib.decompressobj(31)
    while raw := source.read(CHUNK):
        while raw:
            if out := inflate.decompress(raw, CHUNK):
                yield out
            raw = inflate.unconsumed_tail
            if inflate.eof:
                raw, inflate = inflate.unused_data, zlib.decompressobj(31)
    while out := inflate.decompress(inflate.unconsumed_tail, CHUNK):
        yield out


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``page_id, url, html`` as whole-stream gzip files; gives ``_WRITTEN`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        file = f"{folder}/raw-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        system, path = _place(file)
        sink = None
        for batch in batches:
            if sink is None:
                system.create_dir(path.rsplit("/", 1)[0])
                sink, gzip = system.open_output_stream(path, compression=None), _gzip()
            sizes, digests = [], []
            for page_id, url, html in zip(*batch.columns):
                payload = (html.as_py() or "").encode()
                digests.append(hashlib.sha256(payload).hexdigest())
                sizes.append(len(payload))
                sink.write(gzip.compress(record(page_id.as_py(), url.as_py(), payload, digests[-1])))
            yield pa.record_batch(
                [
                    pa.array([file] * len(sizes), pa.string()),
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.string()),
                ],
                ["file", "page_id", "payload_bytes", "payload_digest"],
            )
        if sink is not None:
            sink.write(gzip.flush())
            sink.close()

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return stored(rows.mapInArrow(run, _WRITTEN), "written")


def duplicates(written: DataFrame) -> DataFrame:
    """``(file, page_id, payload_digest, refers_to)`` of the records that become revisits."""
    counted = written.filter((F.col("payload_bytes") >= LEAST_REVISITED) & F.col("page_id").isNotNull())
    first = (
        counted.groupBy("payload_digest")
        .agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    return (
        counted.join(first, "payload_digest")
        .filter("page_id > refers_to")
        .select("file", "page_id", "payload_digest", "refers_to")
        .distinct()
    )


def normalise(written: DataFrame, folder: str) -> DataFrame:
    """Rewrites each file record by record; gives the sidecar index, ``_INDEX`` rows.

    A group holds the revisits of one file, which are fewer than its records.
    """
    files = written.select("file").distinct()
    # Files are few rows but much work: as many tasks as files, which AQE would join to one.
    plan = files.join(duplicates(written), "file", "left").repartition(
        max(1, files.count()), "file"
    )

    def run(key: tuple[pa.Scalar], group: pa.Table) -> pa.Table:
        file = key[0].as_py()
        known = {
            (p, d): r
            for p, d, r in zip(*(group.column(c).to_pylist() for c in ("page_id", "payload_digest", "refers_to")))
            if p is not None
        }
        context = TaskContext.get()
        name = file.rsplit("/", 1)[1].replace("raw-", "members-").removesuffix(".warc.gz")
        new = f"{folder}/{name}-{context.taskAttemptId()}.warc.gz"
        system, path = _place(new)
        system.create_dir(path.rsplit("/", 1)[0])
        rows, at = [], 0
        source_system, source = _place(file)
        with source_system.open_input_stream(source, compression=None) as raw:
            with system.open_output_stream(path, compression=None) as sink:
                for fields, payload in records_of(inflated(raw)):
                    page_id = _page(fields, "warc-record-id")
                    digest = fields["warc-payload-digest"].removeprefix("sha256:")
                    other = known.get((page_id, digest))
                    gzip = _gzip()
                    member = gzip.compress(record(page_id, _url(fields), payload, digest, other))
                    member += gzip.flush()
                    sink.write(member)
                    rows.append((new, at, len(member), page_id, "response" if other is None else "revisit"))
                    at += len(member)
        columns = zip(*rows) if rows else [[]] * 5
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["file", "offset", "length", "page_id", "record_type"]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return stored(plan.groupBy("file").applyInArrow(run, _INDEX), "sidecar")


def read_records(index: DataFrame) -> DataFrame:
    """One row for each member of the index, figures taken from its bytes.

    ``payload_bytes`` and ``payload_digest`` of a response are those of what was read,
    which must agree with its head; a revisit has the digest of its head and no size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if file != name:
                    if source:
                        source.close()
                    system, path = _place(file)
                    name, source = file, system.open_input_file(path)
                source.seek(offset)
                member = zlib.decompress(source.read(length), 31)
                ((fields, payload),) = records_of(iter([member]))
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                kind, size = fields["warc-type"], None
                if kind == "response":
                    size = len(payload)
                    if hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{file}, {offset}: the payload is not what its head says")
                page = _page(fields, "warc-record-id")
                rows.append((page, _url(fields), kind, _page(fields, "warc-refers-to"), size, digest))
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.record_batch(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"],
            )
        if source:
            source.close()

    places = index.select("file", "offset", "length")
    return places.filter("file IS NOT NULL").sortWithinPartitions("file", "offset").mapInArrow(run, _READ)


def archived(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives, normalised and read back; one row for each page.

    Columns: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest``. Of
    records with equal payloads of ``LEAST_REVISITED`` bytes or more, that of the smallest
    page_id is the response and the others revisit it; rows that share that page_id are
    all responses. A revisit's size is that of the response it refers to. A null html is
    an empty payload; a null url leaves the field out. Rows without page_id are written
    as responses. Other columns are not read. An empty table writes nothing.
    """
    folder = work_folder(pages.sparkSession, "warc")
    index = normalise(write_archives(pages, folder), folder)
    found = stored(read_records(index), "read")
    responses = (
        found.filter("record_type = 'response'")
        .select(
            F.col("page_id").alias("_page"),
            F.col("payload_digest").alias("_digest"),
            F.col("payload_bytes").alias("_bytes"),
        )
        .distinct()
    )
    same = (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest"))
    revisits = found.filter("record_type = 'revisit'").join(responses, same)
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    return found.filter("record_type = 'response'").select(*names).union(
        revisits.withColumn("payload_bytes", F.col("_bytes")).select(*names)
    )
