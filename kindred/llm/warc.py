"""Content-addressed web archive.

Two tables make an archive: `payloads` holds every distinct payload once under its SHA-256, `headers`
holds the exact header block of every WARC record with the digest of its payload. Joining them on the
digest gives the original records back: header block, blank line, payload. What is read is verified on the
rebuilt bytes: their SHA-256 must be the one that they were stored under, their SHA-1 and length those that
the record's header names; anything else raises an error.

Defined results: a null payload is an empty one. Of equal payloads of at least `min_bytes`, the row with
the largest id is the response (null ids are smallest); the others revisit it. Rows repeated with the
same id and payload as the response are responses too, their payload is stored once. Where all ids of a
payload are null, all its rows are responses. Record ids hold the page's id and a number of the row's own, so
they differ even where page ids repeat or are null. A null address has no WARC-Target-URI line; line ends
inside an address become spaces. Payloads of any length are stored whole. Other columns of the input are
ignored.
"""

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, shuffles_dropped, tune

CRLF = "\r\n"


def base32(digits: Column) -> Column:
    """Upper-case base32 of a SHA-1 in hex, without Python: 20 bits (5 hex digits) make 4 characters."""
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def header_block(kind: Column, record_id: Column, date: Column, url: Column, digest: Column, refers_to: Column, length: Column) -> Column:
    """WARC/1.1 header block of a response or an identical-payload revisit."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise("")
    revisit = kind == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", record_id),
        line("WARC-Date", date),
        line("WARC-Target-URI", F.regexp_replace(url, r"[\r\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        line("WARC-Refers-To", F.when(revisit, refers_to)),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        F.lit(f"Content-Type: text/html{CRLF}"),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(length.cast("string"))),
    )


def record_urn(page_id: Column, row: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.concat(page_id.cast("string"), F.lit(":")), F.lit("")), row.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_col="page_id", url_col="url", payload_col="html", min_bytes=0, date_col=None) -> None:
    """Writes `path`/payloads and `path`/headers, in a form that any Spark cluster reads. date_col: a timestamp of each
    record; without one, records bear the time at which the archive is written."""
    spark = pages.sparkSession
    tune(spark)
    told_time = F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ"))
    date = F.coalesce(F.date_format(F.to_utc_timestamp(F.col(date_col), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"), told_time) if date_col else told_time
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), date.alias("date"), payload.alias("payload"))
    rows = rows.withColumns({"sha256": F.sha2("payload", 256), "bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")})
    facts = rows.select("id", "url", "date", "sha256", "bytes", base32(F.col("sha1")).alias("digest"), F.monotonically_increasing_id().alias("row"))
    with shuffles_dropped(spark):  # each write ends what it shuffled, payloads above all
        facts.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/facts")
        facts = spark.read.schema(facts.schema).parquet(f"{path}/facts")
        latest = F.max(F.struct("id", "row"))
        first = facts.where(F.col("bytes") >= min_bytes).groupBy("sha256").agg(latest.alias("response"))
        first.write.mode("overwrite").parquet(f"{path}/first")
        first = spark.read.schema(first.schema).parquet(f"{path}/first")
        # partial aggregation: of a payload that many pages share, a task sends one copy
        store = rows.groupBy("sha256").agg(F.first("payload").alias("payload"))
        store.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/payloads")
        told = facts.join(first, "sha256", "left")
        is_response = F.col("response.id").isNull() | F.col("id").eqNullSafe(F.col("response.id"))
        told = told.withColumn("kind", F.when(is_response, F.lit("response")).otherwise(F.lit("revisit")))
        block = header_block(F.col("kind"), record_urn(F.col("id"), F.col("row")), F.col("date"), F.col("url"), F.col("digest"), record_urn(F.col("response.id"), F.col("response.row")), F.col("bytes"))
        told.select("sha256", block.alias("header")).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/headers")
    for name in ("facts", "first"):  # no part of the archive
        drop_path(spark, f"{path}/{name}")


def _field(header: Column, name: str) -> Column:
    found = F.regexp_extract(header, rf"(?m)^{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def _page(urn: Column) -> Column:
    """The page's id in a record's id; null where the page had none."""
    return F.when(F.regexp_like(urn, F.lit("^<urn:page:.*:[0-9]+>$")), F.regexp_extract(urn, "(?s)^<urn:page:(.*):[0-9]+>$", 1))


def rebuilt(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, record): the original records, each its header block, a blank line and its payload."""
    payloads = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    headers = spark.read.schema("sha256 string, header string").parquet(f"{path}/headers")
    return headers.join(payloads, "sha256").select("sha256", F.concat(F.encode("header", "UTF-8"), F.lit(CRLF.encode()), F.col("payload")).alias("record"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record, told from its rebuilt bytes: the exact header block, the fields parsed from it and the
    verified payload. All columns but the header's need the payload: digest and length are those of the bytes."""
    rows = rebuilt(spark, path)
    end = F.instr(F.decode("record", "ISO-8859-1"), CRLF * 2)  # a character a byte
    rows = rows.select("sha256", F.decode(F.expr("record").substr(F.lit(1), end + 1), "UTF-8").alias("header"), F.expr("record").substr(end + 4, F.octet_length("record")).alias("payload"))
    header, payload = F.col("header"), F.col("payload")
    wrong = lambda text: F.raise_error(F.lit(text)).cast("string")
    sha1 = F.when(F.sha2(payload, 256) == F.col("sha256"), F.sha1(payload)).otherwise(wrong("a stored payload doesn't answer to its digest"))
    rows = rows.select("header", "payload", sha1.alias("sha1"), F.octet_length(payload).cast("long").alias("payload_bytes"), _field(header, "WARC-Type").alias("record_type"))
    rows = rows.withColumn("payload_digest", base32(F.col("sha1")))
    claimed = F.regexp_replace(_field(header, "WARC-Payload-Digest"), "^sha1:", "")
    length = _field(header, "Content-Length").cast("long")
    fits = (claimed == F.col("payload_digest")) & (length == F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0))
    return rows.select(
        "header",
        "record_type",
        _page(_field(header, "WARC-Record-ID")).alias("record_id"),
        _page(_field(header, "WARC-Refers-To")).alias("refers_to"),
        F.when(fits, F.col("payload_digest")).otherwise(wrong("a header doesn't describe its payload")).alias("payload_digest"),
        "payload_bytes",
        "payload",
    )


def original_records(archive: DataFrame) -> DataFrame:
    """The records as WARC text; a revisit has an empty block."""
    block = F.when(F.col("record_type") == "response", F.decode("payload", "UTF-8")).otherwise("")
    return archive.select(F.concat("header", F.lit(CRLF), block).alias("value"))


def export_warc(archive: DataFrame, path: str, compression="gzip") -> None:
    """WARC files through Spark's text writer: what ends a line there, ends a record here."""
    original_records(archive).write.mode("overwrite").option("lineSep", CRLF * 2).option("compression", compression).text(path)
