"""Content-addressed WARC archive.

Two tables make an archive: ``payloads`` holds the bytes of each distinct
payload once, under their SHA-256; ``records`` holds the exact header block of
every record with the digest of its payload. A join of both gives the original
records back. Equal payloads are stored as one only if they agree in length and
in a second, independent hash; every read hashes the stored bytes anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the alphabet of base32 (RFC 4648).
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_EOL = "\r\n"
_CONTROL = r"[\x00-\x1F\x7F]"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1; 160 bits are 32 characters with no padding."""
    return _base32(F.sha1(payload))


def _base32(hex_digest: Column) -> Column:
    out = []
    for i in range(8):
        bits = F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(BASE32), F.shiftright(bits, 15 - 5 * j).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for j in range(4)]
    return F.concat(*out)


def _one_line(url: Column) -> Column:
    """``url`` with its control characters percent-encoded, so that it can't end a header or start one."""
    escaped = lambda c: F.when(c.rlike(_CONTROL), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)
    return F.when(url.rlike(_CONTROL), F.array_join(F.transform(F.split(url, ""), escaped), "")).otherwise(url)


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Write one record for every row of ``pages`` below ``path``.

    The payload is the text in UTF-8 (null: no bytes). Among records with equal
    payloads of ``min_revisit_bytes`` or more the one with the smallest id is a
    response and the others are revisits of it; smaller payloads are responses
    all. Repeated rows with the smallest id are responses all, though their
    payload too is stored once. A row with a null id is a revisit of the
    smallest id, or a response if all ids are null. A null url is left out of
    the headers; control characters in a url are percent-encoded. ``date`` is
    the WARC-Date of all records, as pages carry none. Payloads of any length
    are rows of their own; an empty table makes an empty archive. Other columns
    are not read.
    """
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    proof = F.struct(F.length("payload").alias("n"), F.xxhash64("payload").alias("h"))
    once = rows.groupBy("digest").agg(F.any_value("payload").alias("payload"), F.min("page_id").alias("first"), F.min(proof).alias("low"), F.max(proof).alias("high"))
    verified = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("unequal payloads under digest "), "digest")).cast("binary"))
    once.select("digest", verified.alias("payload"), "first", F.col("low.n").cast("long").alias("n_bytes"), base32_sha1(F.col("payload")).alias("sha1")).write.option("compression", "zstd").parquet(f"{path}/payloads")

    spark = pages.sparkSession
    index = spark.read.parquet(f"{path}/payloads").select(F.col("digest").alias("d"), "first", "n_bytes", "sha1")
    named = rows.select("page_id", "url", "digest")
    joined = named.join(index, named["digest"] == index["d"])
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.col("n_bytes") >= min_revisit_bytes)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_EOL))
    urn = lambda page: F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))
    own = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    headers = F.concat(
        F.lit(f"WARC/1.1{_EOL}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(own)),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", _one_line(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("n_bytes")).cast("string")),
    )
    joined.select("page_id", headers.alias("headers"), "digest").write.option("compression", "zstd").parquet(f"{path}/records")


def _header(name: str) -> Column:
    found = F.regexp_extract("headers", rf"\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, payloads); the payloads' bytes are checked against their digest as they are read."""
    records = spark.read.parquet(f"{path}/records")
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest")).cast("binary"))
    return records, stored.select(F.col("digest").alias("d"), sound.alias("payload"))


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, headers, payload, record): every record as it was, revisits with the payload that they refer to.

    ``record`` is the record's own bytes: headers, blank line, body (empty for a
    revisit) and the two line ends that close a record.
    """
    records, payloads = read_archive(spark, path)
    joined = records.join(payloads, records["digest"] == payloads["d"])
    body = F.when(_header("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    record = F.concat(F.encode(F.concat("headers", F.lit(_EOL)), "UTF-8"), body, F.lit((_EOL * 2).encode()))
    return joined.select("page_id", "headers", "payload", record.alias("record"))


def digest_rows(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), from the archive alone."""
    records, payloads = read_archive(spark, path)
    measured = payloads.select("d", F.length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"))
    joined = records.join(measured, records["digest"] == measured["d"])
    refers = F.regexp_extract(_header("WARC-Refers-To"), r"^<urn:page:(-?\d+)>$", 1).cast("long")
    return joined.select("page_id", "payload_bytes", "payload_digest", _header("WARC-Type").alias("record_type"), refers.alias("refers_to"))
