"""WARC archives with a Zstandard dictionary: writer and reader.

A task writes the records of its partition as one ``.warc.zst`` file in the
shared folder. The dictionary is trained on the first ``SAMPLE_BYTES`` of the
partition's own records, long records in slices, and stands in a skippable frame (magic
0x184D2A5D) at the head of the file; every record is a Zstandard frame of its
own, so a reader can seek to any record and needs nothing but the file. Where
there is too little to train on, the dictionary is the records' bytes
themselves, so every file has one. The first record is a warcinfo.

Files are written under a name of the attempt and renamed when complete; the
table of archives that the writer returns names complete files only, so a lost
executor leaves at most a file that no row names. Paths may have any scheme
that pyarrow opens.

Equal payloads of at least ``min_revisit`` bytes are stored once: the record
with the smallest page_id is the response, the others are revisit records that
name its id and digest and have no block. Which is which is found on digests
only: digests are counted, those that repeat (``SMALL`` of them at most) are
broadcast, and payloads are written from where they were read. More of them are
joined with rows without payloads, and the decisions with the payloads by row.

Record ids are unique. That of a response which others revisit follows from its
page_id and digest, and they name it in WARC-Refers-To; where several rows
repeat that page_id and payload, their ids are drawn and revisits name the digest and the page only.

Null payloads are empty ones; a null page_id is written as such and orders
last among equal payloads. Rows that repeat the smallest id are all responses.
Empty tables give empty results, extra columns are kept out of the archives.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from itertools import chain

import pandas as pd
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteledger.llm.common import checkpoint, n_tasks
from noteledger.session import ensure_checkpoint_dir

MAGIC = 0x184D2A5D  # fixed value: skippable frame that holds the dictionary
SAMPLE_BYTES, DICT_BYTES, SLICE = 4 << 20, 64 << 10, 16 << 10
SMALL = 200_000  # repeated digests that are broadcast
NAMES = uuid.UUID("6f1c1c0e-6a55-5b0e-9a43-0d6a0b6d8a11")  # of the ids that others refer to
END = b"\r\n"
ARCHIVES = "path string, n_records long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def record_id(page_id: int, digest: str) -> uuid.UUID:
    """Id of the response that revisits of a digest name."""
    return uuid.uuid5(NAMES, f"{page_id}:{digest}")


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, n_bytes: int, payload: bytes, named: bool = False) -> bytes:
    """One WARC/1.1 record. ``named``: it is, or refers to, the one response of its digest."""
    own = record_id(page_id, digest) if named and kind == "response" else uuid.uuid4()
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + kind.encode(),
        b"WARC-Record-ID: <urn:uuid:" + str(own).encode() + b">",
        b"WARC-Date: " + datetime(2000, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ").encode(),
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        b"WARC-X-Payload-Length: " + str(n_bytes).encode(),
        b"Content-Type: text/html",
        b"Content-Length: " + str(len(payload)).encode(),
    ]
    if page_id is not None:
        head.append(b"WARC-X-Page-ID: " + str(page_id).encode())
    if url is not None:
        # a target with line breaks would end the header: percent-encode these and the percent sign
        head.append(b"WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A").encode("utf-8", "surrogatepass"))
    if refers_to is not None:
        head.append(b"WARC-X-Refers-To-Page-ID: " + str(refers_to).encode())
    if kind == "revisit":
        head.append(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if named and refers_to is not None:
            head.append(b"WARC-Refers-To: <urn:uuid:" + str(record_id(refers_to, digest)).encode() + b">")
    return END.join(head) + END + END + payload + END + END


def file_info(name: str) -> bytes:
    """The warcinfo record of a file."""
    body = b"software: noteledger" + END + b"format: WARC File Format 1.1" + END
    head = [b"WARC/1.1", b"WARC-Type: warcinfo", b"WARC-Record-ID: <urn:uuid:" + str(uuid.uuid4()).encode() + b">",
            b"WARC-Date: 2000-01-01T00:00:00Z", b"WARC-Filename: " + name.encode(), b"Content-Type: application/warc-fields",
            b"Content-Length: " + str(len(body)).encode()]
    return END.join(head) + END + END + body + END + END


def parse(data: bytes) -> dict | None:
    """The fields of one record; the digest of a response is computed from its block. A warcinfo has none."""
    head, _, rest = data.partition(END + END)
    lines = dict(x.split(b": ", 1) for x in head.split(END)[1:])
    if lines[b"WARC-Type"] == b"warcinfo":
        return None
    payload = rest[: int(lines[b"Content-Length"])]
    kind = lines[b"WARC-Type"].decode()
    number = lambda k: int(lines[k]) if k in lines else None
    url = lines.get(b"WARC-Target-URI")
    response = kind == "response"
    return {
        "page_id": number(b"WARC-X-Page-ID"),
        "url": None if url is None else url.decode("utf-8", "surrogatepass").replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
        "record_type": kind,
        "refers_to": number(b"WARC-X-Refers-To-Page-ID"),
        "payload_digest": hashlib.sha256(payload).hexdigest() if response else lines[b"WARC-Payload-Digest"].decode().removeprefix("sha256:"),
        "payload_bytes": len(payload) if response else number(b"WARC-X-Payload-Length"),
        "payload": payload if response else None,
    }


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Dictionary from the slices of some records; their bytes themselves where the trainer has too few, or too few different ones."""
    samples = [r[a:a + SLICE] for r in records for a in range(0, len(r), SLICE)]
    try:
        size = min(DICT_BYTES, max(1024, sum(map(len, samples)) // 10))
        return zstandard.train_dictionary(size, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(records)[:DICT_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(folder: str, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Write one partition; the first ``SAMPLE_BYTES`` of its records train the dictionary."""
    clean = lambda x: None if pd.isna(x) else int(x)

    def records() -> Iterator[bytes]:
        for batch in batches:
            for page_id, url, kind, refers_to, digest, size, payload, named in zip(*(batch[c] for c in [*RECORD_COLUMNS, "named"]), strict=True):
                yield record(clean(page_id), url, kind, clean(refers_to), digest, size, b"" if kind == "revisit" else payload, named)

    made, first, held = records(), [], 0
    for one in made:
        first.append(one)
        held += len(one)
        if held >= SAMPLE_BYTES:
            break
    if not first:
        return
    system, base = pafs.FileSystem.from_uri(folder)
    name = f"{base}/{uuid.uuid4().hex}.warc.zst"
    # what is beyond the sample's bytes is the end of its last record
    sample = [*first[:-1], first[-1][:len(first[-1]) - max(0, held - SAMPLE_BYTES)]]
    trained, n = train(sample), 0
    packer = zstandard.ZstdCompressor(level=3, dict_data=trained, write_checksum=True)
    with system.open_output_stream(name + ".open", compression=None) as out:
        content = trained.as_bytes()
        out.write(struct.pack("<II", MAGIC, len(content)) + content)
        out.write(packer.compress(file_info(name.rpartition("/")[2])))
        for one in chain(first, made):
            out.write(packer.compress(one))
            n += 1
    system.move(name + ".open", name)
    yield pd.DataFrame({"path": [f"{folder.rstrip('/')}/{name.rpartition('/')[2]}"], "n_records": [n]})


RECORD_COLUMNS = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]


def read_archive(path: str) -> Iterator[dict]:
    """Records of one file, one frame in memory at a time."""
    system, name = pafs.FileSystem.from_uri(path)
    with system.open_input_stream(name, compression=None) as src:
        head, held = src.read(8), None
        data = b""
        if len(head) == 8 and struct.unpack("<II", head)[0] == MAGIC:
            held = zstandard.ZstdCompressionDict(src.read(struct.unpack("<II", head)[1]))
        else:
            data = head
        reader = zstandard.ZstdDecompressor(dict_data=held)
        frame, parts = reader.decompressobj(), []
        while True:
            data = data or src.read(1 << 20)
            if not data:
                break
            parts.append(frame.decompress(data))
            data = b""
            if frame.eof:
                found = parse(b"".join(parts))
                if found is not None:
                    yield found
                data, frame, parts = frame.unused_data, reader.decompressobj(), []
        if any(parts):
            raise ValueError(f"{path} ends inside a record")


def read_batches(rows: Iterator[pd.DataFrame], batch: int = 64) -> Iterator[pd.DataFrame]:
    for part in rows:
        for path in part["path"]:
            held = []
            for found in read_archive(path):
                held.append(found)
                if len(held) == batch:
                    yield _records(held)
                    held = []
            if held:
                yield _records(held)


def _records(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=RECORD_COLUMNS)
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def mark_revisits(pages: DataFrame, page_id: str, url: str, payload: str, min_revisit: int) -> DataFrame:
    """``RECORDS`` of the pages and ``named``: digests, and which record holds the payload of each digest."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(bytearray()))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("payload")).select(
        "*", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    large = rows.where(F.col("payload_bytes") >= min_revisit)
    # only digests that repeat go further; the smallest id is counted, as only one row may have the id that others name
    per_id = large.groupBy("payload_digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = checkpoint(
        per_id.groupBy("payload_digest").agg(F.sum("n").alias("n"), F.min("page_id").alias("first_id"), F.min_by("n", "page_id").alias("n_first"))
        .where("n > 1").select(F.col("payload_digest").alias("digest"), "first_id", (F.coalesce("n_first", F.lit(0)) == 1).alias("named"))
    )
    holds = F.col("digest").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    decided = [F.when(holds, "response").otherwise("revisit").alias("record_type"), F.when(~holds, F.col("first_id")).alias("refers_to"), F.coalesce("named", F.lit(False)).alias("named")]
    on = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= min_revisit)
    if repeated.count() <= SMALL:
        return rows.join(F.broadcast(repeated), on, "left").select(*rows.columns, *decided).select(*RECORD_COLUMNS, "named")
    # rows without payloads meet their digest; what is decided goes to the payloads by the page and the digest, which are many keys
    by_row = per_id.join(repeated, F.col("payload_digest") == F.col("digest"))
    by_row = by_row.select("payload_digest", F.col("page_id").alias("_page"), "digest", "first_id", "named")
    joined = rows.join(by_row.withColumnRenamed("payload_digest", "_key"), (F.col("payload_digest") == F.col("_key")) & F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload_bytes") >= min_revisit), "left")
    return joined.select(*rows.columns, *decided).select(*RECORD_COLUMNS, "named")


def write_warc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html", min_revisit: int = 100) -> DataFrame:
    """Write archives below ``folder``; returns path and n_records of each (``ARCHIVES``)."""
    records = mark_revisits(pages, page_id, url, payload, min_revisit)
    return records.mapInPandas(lambda rows: write_archive(folder, rows), ARCHIVES)


def read_warc(archives: DataFrame) -> DataFrame:
    """``RECORDS`` of the archives named in column ``path``, one task per file at most."""
    spark = archives.sparkSession
    return archives.select("path").repartition(max(1, n_tasks(spark)), "path").mapInPandas(read_batches, RECORDS)


def warc_folder(spark) -> str:
    """A new folder below the shared checkpoint folder, with the scheme of the file system that Spark takes it from."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    folder = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString().rstrip("/") + f"/warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder else folder.replace("file:", "file://", 1)
    system, base = pafs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    return folder
