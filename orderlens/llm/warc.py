"""WARC archives with revisit records, and the merged capture index.

Writing: one record per page, as text whose records end by the writer's line
separator, so that any file system Spark knows can hold the archives.
Reading: each archive is parsed by its length fields and gives a capture run,
its index rows sorted by URL key, time and page. Merging: the runs are dealt
by key range, and a loser tree merges the runs' parts within each range, so
the parts in order form the global capture history.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import itertools
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import saved, shared_folder, shuffle_width

MIN_REVISIT_BYTES = 100
RECORDS_A_FILE = 20_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"
RUN = ("url_key string, captured string, page_id long, record_type string, refers_to long, payload_bytes long, "
       "payload_digest string, archive string, offset long, turn long")


def with_record_types(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null:
    a response). Of equal payloads of at least ``MIN_REVISIT_BYTES`` bytes the
    smallest page_id is the response. Null html is an empty payload; rows
    without a page_id are responses; rows that repeat the smallest page_id are
    responses too. The smallest id of each digest comes from a pre-aggregated
    minimum joined back, so a payload that a third of all pages share is a
    skewed join side, not a collected group."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"))
    p = p.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    p = p.withColumn("payload_digest", F.sha2("payload", 256))
    first = (p.where((F.col("payload_bytes") >= MIN_REVISIT_BYTES) & F.col("page_id").isNotNull())
             .groupBy("payload_digest").agg(F.min("page_id").alias("first")))
    return p.join(first, "payload_digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id") > F.col("first"), F.col("first"))).drop("first")


def write_archives(pages: DataFrame, folder: str | None = None) -> str:
    """Write one WARC record per row of ``pages`` (page_id, url, html; other
    columns are ignored) as gzip archives; returns their folder.

    The capture time of a page is its id in seconds after 2024-01-01, as the
    table has none. An empty table writes a folder without archives."""
    folder = folder or f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    p = with_record_types(pages)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    p = p.withColumn("block", F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload"))))
    target = F.coalesce(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), F.lit(""))
    seconds = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**10)) + 1_704_067_200
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: <urn:x-page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f">{CRLF}WARC-Date: "), F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.lit(f"{CRLF}WARC-Target-URI: "), target,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(revisit, F.concat(F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: <urn:x-page:"),
                                 F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http;msgtype=response{CRLF}Content-Length: "),
        F.octet_length("block").cast("string"), F.lit(CRLF * 2), F.col("block"), F.lit(CRLF))
    (p.select(record.alias("value")).write.option("lineSep", CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_A_FILE).text(folder))
    return folder


def url_key(url: str) -> str:
    """Sort key of a URL: reversed host labels, ``)``, then path and query."""
    rest = url.split("://", 1)[-1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def records(stream) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of each record of an archive."""
    at = 0
    while line := stream.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"no record begins at {at}")
        head, size = {}, len(line)
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            head[name], size = value.strip(), size + len(line)
        block = stream.read(int(head["Content-Length"]))
        if len(block) != int(head["Content-Length"]) or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut short")
        yield at, head, block
        at += size + 2 + len(block) + 4


def capture(archive: str, offset: int, head: dict[str, str], block: bytes) -> tuple:
    """Index row of a record. A response's payload must have its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
    if head["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
        raise ValueError(f"{archive}: the payload at {offset} differs from its digest")
    number = lambda field: int(n) if (n := head.get(field, "").removeprefix("<urn:x-page:").rstrip(">")) else None
    return (url_key(head["WARC-Target-URI"]), head["WARC-Date"], number("WARC-Record-ID"), head["WARC-Type"],
            number("WARC-Refers-To"), size, digest, archive, offset)


def order(row: tuple) -> tuple:
    """URL key, time, page (nulls first), offset."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8]


def batches_of(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield from pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                                        schema=schema).to_batches(8192)


def run_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in RUN.split(", "))])


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The capture runs of a folder's archives: index rows of ``RUN``, of
    which those of one archive are sorted (``turn`` is the place in the run).
    Kept in the shared folder: a row is some 200 bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(folder).select("path", "content")

    def parse(batches):
        for b in batches:
            for path, content in zip(b.column(0), b.column(1)):
                name = path.as_py().rpartition("/")[2]
                with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                    run = sorted((capture(name, *r) for r in records(stream)), key=order)
                yield from batches_of([(*row, turn) for turn, row in enumerate(run)], run_schema())

    return saved(files.mapInArrow(parse, RUN))


def loser_tree(runs: list[list[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs: each inner node keeps the loser of its match, so the
    next winner replays only the path from its own leaf to the root."""
    k = len(runs)
    at = [0] * k

    def head(r: int):
        return (0, order(runs[r][at[r]]), r) if at[r] < len(runs[r]) else (1, (), r)

    if not k:
        return
    losers = [-1] * k
    winner = [-1] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], losers[node] = (a, b) if head(a) <= head(b) else (b, a)
    top = winner[1] if k > 1 else 0
    while at[top] < len(runs[top]):
        yield runs[top][at[top]]
        at[top] += 1
        node, now = (top + k) // 2, head(top)
        while node:
            other = head(losers[node])
            if other < now:
                losers[node], top, now = top, losers[node], other
            node //= 2


def merge_runs(runs: DataFrame, parts: int | None = None) -> DataFrame:
    """The global capture history: rows of ``RUN`` in order of URL key, time
    and page, over consecutive partitions.

    Ranges are over key, time and page, so one URL with a third of all
    captures is spread over many. Within a range the rows come as the runs'
    sorted parts, which the loser tree merges."""
    schema = run_schema()
    dealt = runs.repartitionByRange(parts or shuffle_width(runs.sparkSession), "url_key", "captured", "page_id", "offset")

    def merge(batches):
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        own = [list(group) for _, group in itertools.groupby(rows, key=lambda row: row[7])]
        merged = loser_tree(own)
        while part := list(itertools.islice(merged, 8192)):
            yield from batches_of(part, schema)

    return dealt.sortWithinPartitions("archive", "turn").mapInArrow(merge, RUN)
