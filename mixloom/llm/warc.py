"""A content-addressed archive of WARC records.

Two tables make up an archive. ``payloads`` holds the bytes of every distinct payload once,
under its SHA-256. ``headers`` holds the exact header block of every record, the digest it
names, and nothing of the payload. A record is its header block, and for a response its
payload, put together again by a join on the digest; a revisit record has no body and names
the record that has.

Digests are verified twice: when payloads are stored, all copies under one digest must agree
in length and in a second, different hash; when they are read, each digest is computed anew
from the stored bytes. A difference stops the job.

Both tables are written before they are joined, so the joins read plain scans, whose hot keys
(one payload under many records) Spark splits at run time. Bytes are grouped once, with
partial aggregation, and no group is gathered.

Defined results: a null payload is empty and a null url has no target header; a null record
id is written empty and read as null; payloads below ``min_revisit_bytes`` are never revisits;
repeated rows are records of their own, under the same id; empty tables give empty archives;
other columns are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format, and the date every record carries.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
ID_PREFIX = "urn:x-page:"


def _digest(payload: Column) -> Column:
    return F.sha2(payload, 256)


def _verified(holds: Column, value: Column, message: str) -> Column:
    """``value`` where ``holds``, else the job ends with ``message``."""
    return F.when(holds, value).otherwise(F.raise_error(F.lit(message)).cast("string"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value. Line ends in a value are percent-encoded."""
    flat = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(F.lit(f"{name}: "), flat, F.lit("\r\n"))


def _id(number: Column) -> Column:
    return F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(number.cast("string"), F.lit("")), F.lit(">"))


def store_payloads(records: DataFrame, path: str) -> None:
    """Write each distinct payload once: (digest, payload_bytes, holder, payload). ``holder``
    is the smallest record id that has it."""
    hashed = records.select("record_id", "payload", _digest(F.col("payload")).alias("digest"))
    size, second = F.octet_length("payload"), F.xxhash64("payload")
    grouped = hashed.groupBy("digest").agg(
        F.min("record_id").alias("holder"),
        F.first("payload").alias("payload"),
        F.min(size).alias("least"),
        F.max(size).alias("most"),
        F.min(second).alias("one"),
        F.max(second).alias("other"),
    )
    same = (F.col("least") == F.col("most")) & (F.col("one") == F.col("other"))
    digest = _verified(same, F.col("digest"), "different payloads under one digest")
    grouped.select(digest.alias("digest"), F.col("most").cast("long").alias("payload_bytes"), "holder", "payload").write.parquet(path)


def store_headers(records: DataFrame, payloads: DataFrame, path: str, min_revisit_bytes: int) -> None:
    """Write (record_id, digest, header): every record's exact header block."""
    known = payloads.select("digest", "payload_bytes", "holder")
    rows = records.select("record_id", "url", _digest(F.col("payload")).alias("digest")).join(known, "digest")
    revisit = (F.col("payload_bytes") >= min_revisit_bytes) & ~F.col("record_id").eqNullSafe(F.col("holder")) & F.col("holder").isNotNull()
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _id(F.col("record_id"))),
        _field("WARC-Date", F.lit(DATE)),
        F.coalesce(_field("WARC-Target-URI", F.col("url")), F.lit("")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, _field("WARC-Refers-To", _id(F.col("holder")))).otherwise(""),
        F.when(revisit, _field("WARC-Profile", F.lit(REVISIT_PROFILE))).otherwise(""),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit("\r\n"),
    )
    rows.select("record_id", "digest", header.alias("header")).write.parquet(path)


def write_archive(records: DataFrame, path: str, min_revisit_bytes: int = 100) -> None:
    """Write an archive of ``records`` (record_id, url, payload binary) below ``path``."""
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"),
    )
    store_payloads(rows, f"{path}/payloads")
    payloads = records.sparkSession.read.parquet(f"{path}/payloads")
    store_headers(rows, payloads, f"{path}/headers", min_revisit_bytes)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, body, payload): every record, reconstructed. ``body`` is what the record holds
    after its header block; ``payload`` is the full payload, for a revisit the one it names."""
    stored = spark.read.parquet(f"{path}/payloads")
    right = _digest(F.col("payload")) == F.col("digest")
    verified = stored.select(_verified(right, F.col("digest"), "a stored payload does not have its digest").alias("digest"), "payload")
    records = spark.read.parquet(f"{path}/headers").join(verified, "digest")
    is_revisit = F.col("header").contains("\r\nWARC-Type: revisit\r\n")
    return records.select("header", F.when(is_revisit, F.lit(b"")).otherwise(F.col("payload")).alias("body"), "payload")


END = "\r\n\r\n"  # of a header block, and of a record


def record_bytes(records: DataFrame) -> DataFrame:
    """(record, payload): the bytes of each record as a WARC file has them."""
    end = F.encode(F.lit(END), "UTF-8")
    return records.select(F.concat(F.encode("header", "UTF-8"), "body", end).alias("record"), "payload")


def split_records(records: DataFrame) -> DataFrame:
    """(header, body, payload) from the bytes of records: the header block up to its empty line,
    then as many bytes as it says. A record that does not end there stops the job."""
    header = F.concat(F.substring_index(F.col("record").cast("string"), END, 1), F.lit(END))
    size = F.regexp_extract("header", "\r\nContent-Length: ([0-9]+)\r\n", 1).cast("int")
    begun = F.octet_length("header")
    known = records.select("record", "payload", header.alias("header")).select("*", size.alias("size"), begun.alias("begun"))
    body, rest = F.expr("substring(record, begun + 1, size)"), F.expr("substring(record, begun + size + 1)")
    ends = rest == F.encode(F.lit(END), "UTF-8")
    return known.select(_verified(ends, F.col("header"), "a record does not end where its header says").alias("header"), body.alias("body"), "payload")


def parsed(records: DataFrame) -> DataFrame:
    """The fields of reconstructed records, read from their header blocks, and their payload.
    A body whose length is not the header's, or a payload that has not its digest, stops the job."""

    def value(name: str, pattern: str = "[^\r]*") -> Column:
        return F.regexp_extract("header", f"\r\n{name}: ({pattern})\r\n", 1)

    def number(name: str) -> Column:
        return F.regexp_extract("header", f"\r\n{name}: <{ID_PREFIX}(-?[0-9]*)>\r\n", 1).try_cast("long")

    fits = value("Content-Length").cast("long") == F.octet_length("body")
    return records.select(
        number("WARC-Record-ID").alias("record_id"),
        _verified(fits, value("WARC-Type"), "a record's length is not its header's").alias("record_type"),
        number("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(value("WARC-Payload-Digest"), "^sha256:", "").alias("named_digest"),
        "payload",
    )
