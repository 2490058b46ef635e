"""WARC archives: write with an index, read records back by coalesced byte ranges.

Each record is a gzip member of its own, so it can be read by offset and length.
While a task writes its archives it emits one index row per record: archive,
offset, length, URL and payload digest. A reader picks records from the index
and deals them by archive; in each task they are sorted by offset, ranges that
touch or lie close together are read in one go, and records are cut out of them.

Of equal payloads one record, with the largest page id, is a response; the
others are revisits without payload that refer to it.

Archives are written under names of their own to the folder given, through the
file system of its URI, and moved to their final name when complete. A task
that is run again writes other archives; only those in the stored index count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import small_batches, store
from lectern.session import scratch_dir

# compressed bytes after which a task begins another archive
ARCHIVE_BYTES = 256 << 20
# ranges with no more bytes than this between them are read in one go
GAP_BYTES = 64 << 10
# bytes read at once, unless one record has more
READ_BYTES = 8 << 20
# tasks over which the copies of one payload are dealt
SALTS = 32
DATE = "1970-01-01T00:00:00Z"

INDEX = (
    "page_id {id}, url string, archive string, offset long, length long,"
    " payload_digest string, record_type string, refers_to {id}"
)
RECORD = (
    "page_id {id}, url string, payload binary, payload_bytes long, payload_digest string,"
    " record_type string, refers_to {id}"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line; line ends and percent signs are percent-encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def encode_record(page_id, url: str | None, payload: bytes, kind: str, refers_to) -> bytes:
    """One record, not compressed. A revisit keeps digest and size of the whole payload."""
    block = payload if kind == "response" else b""
    headers = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}",
        "Content-Type: text/html",
        f"Content-Length: {len(block)}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    # null differs from an empty text, so absent values have no header
    if url is not None:
        headers.append(f"WARC-Target-URI: {_line(url)}")
    if page_id is not None:
        headers.append(f"X-Page-ID: {_line(str(page_id))}")
    if kind == "revisit":
        headers.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        if refers_to is not None:
            headers.append(f"X-Refers-To-Page-ID: {_line(str(refers_to))}")
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decode_record(record: bytes) -> dict:
    """The fields of a record; the digest of a response is computed from its payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("no WARC record at this offset")
    field = dict(x.split(": ", 1) for x in lines)
    payload = rest[: int(field["Content-Length"])]
    kind = field["WARC-Type"]
    own = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and digest(payload) != own:
        raise ValueError(f"payload of {field['WARC-Record-ID']} does not have its digest")
    text = {k: _unline(field[k]) if k in field else None for k in ("X-Page-ID", "WARC-Target-URI", "X-Refers-To-Page-ID")}
    return {
        "page_id": text["X-Page-ID"],
        "url": text["WARC-Target-URI"],
        "payload": payload if kind == "response" else None,
        "payload_bytes": int(field["X-Payload-Bytes"]),
        "payload_digest": own,
        "record_type": kind,
        "refers_to": text["X-Refers-To-Page-ID"],
    }


class _Archives:
    """The archives of one task, each moved to its name when it is complete."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.root = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.limit = limit
        self.out = None

    def add(self, record: bytes) -> tuple[str, int, int]:
        if self.out is not None and self.at >= self.limit:
            self.close()
        if self.out is None:
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}.part", compression=None)
            self.at = 0
        member = gzip.compress(record, compresslevel=4, mtime=0)
        self.out.write(member)
        self.at += len(member)
        return self.name, self.at - len(member), len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(f"{self.root}/{self.name}.part", f"{self.root}/{self.name}")
            self.out = None


def _decided(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int):
    """(page_id, url, payload, kind, refers_to): which record of equal payloads is the response."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("sha", F.sha1("payload"))
    # a missing id is smallest; of equal ids the last row wins
    rank = F.struct(F.col("page_id").isNotNull().alias("has"), "page_id", "row")
    repeated = store(
        rows.where(F.octet_length("payload") >= min_bytes)
        .groupBy("sha")
        .agg(F.max(rank).alias("best"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha", F.col("best.page_id").alias("response"), F.col("best.row").alias("best_row"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    joined = salted.join(repeated, ["sha", "salt"], "left")
    revisit = (
        F.col("best_row").isNotNull()
        & (F.col("row") != F.col("best_row"))
        & (F.octet_length("payload") >= min_bytes)
    )
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> tuple[DataFrame, str]:
    """Write one record per row; the stored index, and the folder of the archives.

    folder: a URI all executors can write to; a new one in the shared folder by
    default. Payloads shorter than min_bytes are always responses. A null payload
    is empty; a null URL or id has no header and comes back null. Of rows with
    equal payload and id the last in table order is the response, and repeated rows
    revisit it. pages must be a stored table, whose rows can be numbered alike
    twice. An empty table gives an empty index. Other columns are ignored.
    """
    small_batches(pages.sparkSession)
    uri = _uri(pages.sparkSession, folder or scratch_dir(pages.sparkSession))
    rows = _decided(pages, id_col, url_col, payload_col, min_bytes)
    kind = rows.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        archives = _Archives(uri, archive_bytes)
        for batch in batches:
            ids = batch["page_id"].astype(object).where(batch["page_id"].notna(), None)
            refs = batch["refers_to"].astype(object).where(batch["refers_to"].notna(), None)
            index = []
            for page_id, url, payload, what, ref in zip(
                ids, batch["url"], batch["payload"], batch["kind"], refs, strict=True
            ):
                record = encode_record(page_id, url, bytes(payload), what, ref)
                at = archives.add(record)
                index.append((page_id, url, *at, digest(bytes(payload)), what, ref))
            yield pd.DataFrame(index, columns=[x.split()[0] for x in INDEX.split(", ")])
        archives.close()

    typed = rows.select(
        F.col("page_id").cast("string"), "url", "payload", "kind", F.col("refers_to").cast("string")
    )
    found = typed.mapInPandas(write, INDEX.format(id="string"))
    index = found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})
    return store(index), uri


def _uri(spark, folder: str) -> str:
    """The folder with scheme and host; one without belongs to the session's own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = files.makeQualified(path).toString()
    return re.sub("^file:/+", "file:///", whole)


def _ranges(rows: list[tuple[int, int]], gap: int, most: int) -> Iterator[list[tuple[int, int]]]:
    """Runs of sorted (offset, length) that are read in one go."""
    run: list[tuple[int, int]] = []
    for offset, length in rows:
        if run and (
            offset - run[-1][0] - run[-1][1] > gap or offset + length - run[0][0] > most
        ):
            yield run
            run = []
        run.append((offset, length))
    if run:
        yield run


def read_records(
    selected: DataFrame, folder: str, gap_bytes: int = GAP_BYTES, read_bytes: int = READ_BYTES
) -> DataFrame:
    """The records of the selected index rows, as they stand in the archives.

    (page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to);
    a revisit has a null payload, but size and digest of the whole one. Rows are
    dealt by archive and stretch of it, sorted by offset, and read in coalesced
    ranges. A row selected twice comes twice.
    """
    small_batches(selected.sparkSession)
    stretch = F.floor(F.col("offset") / F.lit(4 * read_bytes))
    kind = selected.schema["page_id"].dataType.simpleString()
    dealt = (
        selected.select("archive", "offset", "length")
        .repartition("archive", stretch)
        .sortWithinPartitions("archive", "offset")
    )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, rows in batch.groupby("archive", sort=False):
                wanted = list(zip(rows["offset"].tolist(), rows["length"].tolist(), strict=True))
                with files.open_input_file(f"{root}/{name}") as file:
                    for run in _ranges(wanted, gap_bytes, read_bytes):
                        start = run[0][0]
                        data = file.read_at(max(o + n for o, n in run) - start, start)
                        yield pd.DataFrame(
                            [
                                decode_record(zlib.decompress(data[o - start : o - start + n], 31))
                                for o, n in run
                            ]
                        )

    found = dealt.mapInPandas(read, RECORD.format(id="string"))
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def op3_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    index, folder = write_archives(pages)
    found = read_records(index, folder)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
