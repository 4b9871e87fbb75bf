"""Content-addressed web archive.

Every page becomes a WARC record. Payload bytes are stored once, under their SHA-256,
in one table; the exact record headers stand in another, with the digest of the payload
they belong to. Of records with equal payloads the one with the largest id is the
response, the others are revisits that refer to it. Original records come back through
joins, and every payload is hashed again when it is read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.session import materialize, shared_dir

EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the payload's SHA-1: five hexadecimal digits are four of its digits."""
    digits = F.upper(F.sha1(payload))
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))


def _header(date: str) -> Column:
    """Header block of a record, from its columns; ends with the empty line."""
    own = F.col("owner").isNull()
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7F]", "%20")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _line("WARC-Type", F.when(own, "response").otherwise("revisit")),
        _line("WARC-Record-ID", urn(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(own, F.lit("")).otherwise(_line("WARC-Refers-To", urn(F.col("owner")))),
        F.when(own, F.lit("")).otherwise(_line("WARC-Profile", F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(own, F.col("size")).otherwise(0).cast("string")),
        F.lit(EOL),
    )


def write_archive(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "2020-01-01T00:00:00Z"
) -> None:
    """Write tables ``payloads`` (digest, payload) and ``records`` (id, digest, header) below ``folder``.

    A null payload is empty; an empty payload is one like any other. Rows without an id
    are responses of their own kind: nothing refers to them unless nothing else has their
    payload, and then the reference names no id. Rows that share the largest id of a
    payload are all responses. Control characters and blanks of a URL are escaped.
    """
    raw = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    keyed = raw.select("id", "url", F.sha2("payload", 256).alias("digest"), base32_sha1(F.col("payload")).alias("sha1"), F.octet_length("payload").alias("size"))
    owners = keyed.groupBy("digest").agg(F.max("id").alias("owner"))
    owned = keyed.join(owners, "digest").withColumn("owner", F.when(F.col("id").eqNullSafe(F.col("owner")), None).otherwise(F.col("owner")))
    owned.select("id", "digest", _header(date).alias("header")).write.parquet(f"{folder}/records")
    # Only the owner's row brings its bytes along: joined on the id, so that no payload is a hot key.
    stored = raw.join(owners.withColumnsRenamed({"digest": "d"}), F.col("id").eqNullSafe(F.col("owner")))
    stored = stored.filter(F.sha2("payload", 256) == F.col("d")).select(F.col("d").alias("digest"), "payload")
    counts = pages.groupBy(page_id).agg(F.count("*").alias("n")).filter("n > 1")
    if counts.limit(1).count():
        stored = stored.dropDuplicates(["digest"])
    stored.write.parquet(f"{folder}/payloads")


def _field(name: str) -> Column:
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def _fields() -> list[Column]:
    """What a column ``header`` says."""
    return [
        F.regexp_extract("header", r"\r\nWARC-Record-ID: <urn:page:(-?[0-9]+)>", 1).try_cast("long").alias("id"),
        _field("WARC-Type").alias("type"),
        F.regexp_extract("header", r"\r\nWARC-Refers-To: <urn:page:(-?[0-9]+)>", 1).try_cast("long").alias("refers_to"),
        F.substring_index(_field("WARC-Payload-Digest"), ":", -1).alias("sha1"),
    ]


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records with their header fields; ids are read from the header."""
    return spark.read.parquet(f"{folder}/records").select(*_fields(), "digest", "header")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads whose bytes still have the digest they are stored under; others raise an error."""
    stored = spark.read.parquet(f"{folder}/payloads")
    right = F.sha2("payload", 256) == F.col("digest")
    return stored.select("digest", F.when(right, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest")).cast("binary")).alias("payload"))


def rebuild(spark: SparkSession, folder: str) -> DataFrame:
    """(id, digest, record): the bytes of every WARC record; a revisit has an empty block."""
    records, end = read_records(spark, folder), F.lit(EOL * 2).cast("binary")
    full = records.filter("type = 'response'").join(read_payloads(spark, folder), "digest")
    full = full.select("id", "digest", F.concat(F.col("header").cast("binary"), "payload", end).alias("record"))
    return full.unionByName(
        records.filter("type = 'revisit'").select("id", "digest", F.concat(F.col("header").cast("binary"), end).alias("record"))
    )


def parsed(records: DataFrame) -> DataFrame:
    """Header fields of rebuilt records, with ``size`` and ``block_sha1`` of the bytes of their blocks."""
    head = F.substring_index(F.col("record").cast("string"), EOL * 2, 1)
    start = F.octet_length(head) + 4
    block = F.substring(F.col("record"), start + 1, F.octet_length("record") - start - 4)
    cut = records.select("digest", F.concat(head, F.lit(EOL)).alias("header"), block.alias("block"))
    return cut.select(*_fields(), "digest", F.octet_length("block").cast("long").alias("size"), base32_sha1(F.col("block")).alias("block_sha1"))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to a new archive in the shared folder, rebuild every record and describe what its bytes say."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/archive-{uuid.uuid4().hex}"
    write_archive(pages, folder)
    described = materialize(parsed(rebuild(spark, folder)))
    # A revisit's own block is empty: its payload is that of the response with the same digest.
    payloads = described.filter("type = 'response'").groupBy("digest").agg(F.max("size").alias("payload_bytes"), F.max("block_sha1").alias("payload_digest"))
    found = described.drop("size", "block_sha1").join(payloads, "digest")
    intact = F.when(F.col("sha1") == F.col("payload_digest"), F.col("payload_digest"))
    return found.select(
        F.col("id").alias("page_id"), "payload_bytes", intact.alias("payload_digest"), F.col("type").alias("record_type"), "refers_to"
    )
