"""WARC archives: writing pages as records, reading records back, putting segments together.

Writing: one record per page, an HTTP response in chunked transfer framing; a record whose block is longer than
``segment_bytes`` is cut into a first segment and continuation records. Of pages with equal payloads of at least
``REVISIT_BYTES``, the one with the largest page_id carries the payload and the others revisit it.

Reading: archives are read line by line, in file order, so a task holds one record at a time whatever the archive's
size; compressed archives are never split. Continuation records are grouped by the identifier of their origin, put in
order of segment number and checked against the total length, then the chunked framing is decoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from changeflow.llm.common import load, stage
from changeflow.sources import paths

REVISIT_BYTES = 1000
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4096
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CRLF = b"\r\n"
RECORD = (
    "record_id string, type string, uri string, origin_id string, segment int, total_length bigint, "
    "refers_to string, payload_digest string, block binary"
)


# -- writing ---------------------------------------------------------------------------------


def _record(kind: str, record_id: str, block: bytes, **fields: str | int | None) -> bytes:
    head = [f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{record_id}>\r\nWARC-Date: {DATE}"]
    head += [f"{name.replace('_', '-')}: {value}" for name, value in fields.items() if value is not None]
    head.append(f"Content-Length: {len(block)}\r\n\r\n")
    return "\r\n".join(head).encode() + block


def _chunked(payload: bytes, chunk: int) -> bytes:
    parts = []
    for at in range(0, len(payload), chunk):
        piece = payload[at:at + chunk]
        parts += [b"%x\r\n" % len(piece), piece, CRLF]
    return HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + b"".join(parts) + b"0\r\n\r\n"


def _page_records(row, segment_bytes: int, chunk_bytes: int) -> Iterator[bytes]:
    common = {"WARC_Target_URI": row.uri, "WARC_Payload_Digest": f"sha1:{row.digest}"}
    if row.refers_to:
        yield _record("revisit", row.record_id, HTTP + CRLF, WARC_Profile=PROFILE, WARC_Refers_To=f"<{row.refers_to}>", **common)
        return
    block = _chunked(row.payload, chunk_bytes)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _record("response", row.record_id, block, **common)
        return
    yield _record("response", row.record_id, parts[0], WARC_Segment_Number=1, **common)
    for number, part in enumerate(parts[1:], 2):
        yield _record(
            "continuation", f"{row.record_id}:{number}", part, WARC_Segment_Number=number,
            WARC_Segment_Origin_ID=f"<{row.record_id}>",
            WARC_Segment_Total_Length=len(block) if number == len(parts) else None, **common,
        )


def write_warc(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", body: str = "html",
    segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
) -> None:
    """Write each row of ``pages`` as records into gzip archives under ``path``, one archive per task.

    A NULL body is an empty payload, a NULL url gives no target URI (line breaks in it become spaces). Rows without
    page_id revisit like others, but nothing revisits them. Repeated rows with the largest page_id of their payload
    are all responses: a record's name ends with a number that tells repeats apart, and what refers to a response
    leaves that number out.
    """
    payload = F.coalesce(F.col(body).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(page_id).cast("string").alias("page_id"),
        F.col(page_id).cast("bigint").alias("number"),
        F.regexp_replace(F.col(url), "[\r\n]+", " ").alias("uri"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.monotonically_increasing_id().alias("copy"),
    )
    long = F.octet_length("payload") >= REVISIT_BYTES
    kept = stage(rows.where(long).groupBy("digest").agg(F.max("number").alias("kept")))
    rows = rows.join(kept.withColumnRenamed("digest", "_digest"), long & (F.col("digest") == F.col("_digest")), "left")
    name = F.concat(F.lit("urn:page:"), F.coalesce("page_id", F.lit("")), F.lit(":"), "digest")
    kept_name = F.concat(F.lit("urn:page:"), F.col("kept").cast("string"), F.lit(":"), "digest")
    revisits = F.col("kept").isNotNull() & ~F.col("number").eqNullSafe(F.col("kept"))
    rows = rows.select(
        F.concat(name, F.lit(":"), F.col("copy").cast("string")).alias("record_id"),
        F.when(revisits, kept_name).alias("refers_to"),
        "uri",
        "digest",
        F.when(~revisits, F.col("payload")).alias("payload"),
    )

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield pd.DataFrame({"record": list(_page_records(row, segment_bytes, chunk_bytes))})

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in records(batches):
            held.append(frame)
            size += int(frame.record.map(len).sum())
            if size > 4 << 20:
                yield pd.concat(held)
                held, size = [], 0
        if held:
            yield pd.concat(held)

    # The text writer puts the bytes of a value as they are; the separator ends each record.
    lines = rows.mapInPandas(merged, "record binary").select(F.col("record").cast("string").alias("value"))
    lines.write.options(lineSep="\r\n\r\n", compression="gzip", **{"zlib.compress.level": "BEST_SPEED"}).text(path)


# -- reading ---------------------------------------------------------------------------------


class _Parser:
    """Cuts the bytes of one archive into records, as they come."""

    def __init__(self, file: str):
        self.file, self.parts, self.size, self.need = file, [], 0, 1

    def feed(self, data: bytes) -> Iterator[dict]:
        self.parts.append(data)
        self.size += len(data)
        if self.size < self.need:
            return
        data, at = b"".join(self.parts), 0
        while True:
            while data[at:at + 2] == CRLF:  # between records
                at += 2
            end = data.find(b"\r\n\r\n", at)
            if end < 0:
                self.need = len(data) - at + 1
                break
            head = data[at:end].decode("utf-8", "replace").split("\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head[1:])}
            if not head[0].startswith("WARC/") or not fields.get("content-length", "").isdigit():
                raise ValueError(f"{self.file}: not a WARC record: {head[0][:80]!r}")
            stop = end + 4 + int(fields["content-length"])
            if stop > len(data):
                self.need = stop - at
                break
            yield self.row(fields, data[end + 4:stop])
            at = stop
        self.parts = [data[at:]] if at < len(data) else []
        self.size = len(data) - at

    @staticmethod
    def row(fields: dict[str, str], block: bytes) -> dict:
        def name(field: str) -> str | None:
            return fields[field].strip("<>") if field in fields else None

        def number(field: str) -> int | None:
            return int(fields[field]) if fields.get(field, "").isdigit() else None

        return {
            "record_id": name("warc-record-id"), "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri"),
            "origin_id": name("warc-segment-origin-id"), "segment": number("warc-segment-number"),
            "total_length": number("warc-segment-total-length"), "refers_to": name("warc-refers-to"),
            "payload_digest": fields.get("warc-payload-digest"), "block": block,
        }

    def close(self) -> None:
        if b"".join(self.parts).strip(CRLF):
            raise ValueError(f"{self.file}: ends within a record")


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parser, columns = None, [c.split()[0] for c in RECORD.split(", ")]

    def frame(rows: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=columns)
        return out.astype({"segment": "Int32", "total_length": "Int64"})

    for batch in batches:
        same = batch.file.ne(batch.file.shift()).cumsum()
        for _, lines in batch.groupby(same, sort=False):
            file = lines.file.iloc[0]
            if parser is None or parser.file != file:
                if parser:
                    parser.close()
                parser = _Parser(file)
            rows = list(parser.feed(b"\n".join(lines.line) + b"\n"))
            if rows:
                yield frame(rows)
    if parser:
        parser.close()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of the gzip archives under ``path``, segments apart. Damaged archives raise an error."""
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("line"))
    return lines.mapInPandas(_parse, RECORD)


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: ``records`` with segments joined, and ``complete``.

    Segments are grouped by the identifier of their origin (the first segment's own), put in order, and complete
    if they are numbered 1 to n without a gap and their length is the total one that the last of them states.
    Repeated equal segments count once. An incomplete record keeps its fields and has a NULL block. Only segments
    are shuffled, and a group is one record.
    """
    single = records.where("segment IS NULL").withColumn("complete", F.lit(True))
    pieces = records.where("segment IS NOT NULL").withColumn("_key", F.coalesce("origin_id", "record_id"))
    first = ["record_id", "type", "uri", "refers_to", "payload_digest"]
    whole = pieces.groupBy("_key").agg(
        F.array_sort(F.array_distinct(F.collect_list(F.struct("segment", F.col("block").cast("string").alias("part"))))).alias("parts"),
        F.max("total_length").alias("total_length"),
        F.min_by(F.struct(*first), "segment").alias("first"),
    )
    numbers, block = F.col("parts.segment"), F.array_join(F.col("parts.part"), "").cast("binary")
    complete = (
        (numbers == F.sequence(F.lit(1), F.size("parts"))) & F.col("total_length").isNotNull()
        & (F.octet_length(block) == F.col("total_length"))
    )
    whole = whole.select(
        F.col("_key").alias("record_id"),
        *[F.col(f"first.{c}").alias(c) for c in first[1:]],
        F.lit(None).cast("string").alias("origin_id"),
        F.lit(None).cast("int").alias("segment"),
        "total_length",
        F.when(complete, block).alias("block"),
        F.coalesce(complete, F.lit(False)).alias("complete"),
    )
    return single.unionByName(whole)


def _payload(block: bytes | None) -> bytes | None:
    if block is None:
        return None
    head, _, body = block.partition(b"\r\n\r\n")
    if not re.search(rb"\r\ntransfer-encoding:[^\r]*chunked", head.lower()):
        return body
    out, at = [], 0
    while True:
        end = body.find(CRLF, at)
        size = body[at:end].partition(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9a-fA-F]+", size):
            return None
        n = int(size, 16)
        if n == 0:
            return b"".join(out)
        at = end + 2
        if body[at + n:at + n + 2] != CRLF:
            return None
        out.append(body[at:at + n])
        at += n + 2


def payload_of(block) -> F.Column:
    """The payload of an HTTP block, chunked framing decoded; NULL if the framing is broken or the block NULL."""

    @pandas_udf("binary")
    def of(blocks: pd.Series) -> pd.Series:
        return blocks.map(_payload)

    return of(block)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Whole records with their ``payload``, its length and digest, and whether it is ``sound``: complete, readable
    and of the digest that its header states (where it states one). Revisits have no payload of their own."""
    whole = reassemble(read_records(spark, path))
    whole = whole.withColumn("payload", F.when(F.col("type") == "response", payload_of(F.col("block"))))
    whole = whole.withColumns({"payload_bytes": F.octet_length("payload").cast("bigint"), "digest": F.sha1("payload")})
    stated = F.coalesce(F.concat(F.lit("sha1:"), "digest") == F.col("payload_digest"), F.col("payload_digest").isNull())
    sound = F.col("complete") & ((F.col("type") != "response") | (F.col("payload").isNotNull() & stated))
    return whole.withColumn("sound", sound)


def checked(column: F.Column) -> F.Column:
    """A column of :func:`read_warc` that raises an error for a record that isn't sound. (A check in a column that nothing
    reads would be pruned.)"""
    unsound = F.concat(F.lit("unsound record "), F.coalesce("record_id", F.lit("without id")))
    return F.when(F.col("sound"), column).otherwise(F.raise_error(unsound))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{paths.new_scratch(spark)}/archives"
    write_warc(load(spark, sf_dir, "pages"), path)
    found = read_warc(spark, path)
    page = r"^urn:page:([^:]*):([0-9a-f]{40})"
    facts = stage(found.select(
        F.regexp_extract("record_id", page, 1).try_cast("bigint").alias("page_id"),
        F.regexp_extract("record_id", page, 0).alias("name"),
        checked(F.col("type")).alias("record_type"),
        F.col("refers_to").alias("target"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
    ))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = facts.where("record_type = 'response'")
    # A revisit has the payload of the response that it names; repeats of that response are equal.
    targets = responses.groupBy(F.col("name").alias("target")).agg(
        F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("b"), F.first("payload_digest").alias("d")
    )
    revisits = facts.where("record_type = 'revisit'").join(stage(targets), "target", "left").select(
        "page_id", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to"
    )
    return responses.withColumn("refers_to", F.lit(None).cast("bigint")).select(*names).unionByName(revisits)


OP4_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), k AS (
  SELECT digest, max(page_id) AS kept FROM p WHERE n >= 1000 GROUP BY digest
)
SELECT p.page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN kept IS NOT NULL AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM p LEFT JOIN k ON p.digest = k.digest AND p.n >= 1000
"""
