"""Content-addressed web archive on Spark tables.

Payload bytes are stored once under their SHA-256, dealt into buckets by it; the exact header of every WARC record is
stored apart, with the address of its payload. Reading joins the two, checks length and digests, and gives the original
record back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grovespark.llm.prefilter import likely
from grovespark.llm.scratch import materialize
from grovespark.session import ensure_on_workers

CRLF = "\r\n"
#: Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: One time for all records, as the pages carry none.
WARC_DATE = "1970-01-01T00:00:00Z"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise(F.lit(""))


def write_archive(pages: DataFrame, min_revisit: int = 1000, key: str = "page_id", url: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """One WARC record per row, written as two shared tables: headers(header, address) and payloads(address, payload).

    Of records with equal payloads of at least min_revisit bytes the one with the largest key is the response, the
    others revisit it; smaller ones are all responses. Null html is an empty payload, a null url has no target line.
    A null key can't be referred to and is always a response; rows that repeat a key are told apart by no more than it.
    """
    payload = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("target"), payload.alias("payload"))
    known = materialize(rows.select("id", "target", F.sha2("payload", 256).alias("address"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("bytes")))
    # the one row whose bytes are stored: the largest key of each address (a pre-aggregated maximum)
    keeper = materialize(known.groupBy("address", "bytes").agg(F.max("id").alias("keeper")))
    full = known.join(keeper.select("address", "keeper"), "address")
    revisit = (F.col("bytes") >= min_revisit) & F.col("id").isNotNull() & (F.col("id") < F.col("keeper"))
    kind = F.when(revisit, "revisit").otherwise("response")
    header = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(F.col("id"))),
        F.lit(f"WARC-Date: {WARC_DATE}{CRLF}"),
        _line("WARC-Target-URI", F.regexp_replace("target", r"[\r\n]", "")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}"), _line("WARC-Refers-To", _record_id(F.col("keeper"))))).otherwise(F.lit("")),
        F.lit(f"Content-Type: text/html{CRLF}"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string"), F.lit(CRLF + CRLF)),
    )
    headers = materialize(full.select(header.alias("header"), "address"))
    # bytes go to the store from the row of the keeper, and the bitmap spares most of the copies the shuffle
    known_key = lambda c: F.coalesce(c, F.lit(-(1 << 63))).alias("k")
    place = F.xxhash64("address", "k").alias("__at")
    kept = materialize(keeper.select("address", known_key(F.col("keeper"))).select(place))
    store = likely(rows.select(F.sha2("payload", 256).alias("address"), known_key(F.col("id")), "payload").select("address", "payload", place), kept, "__at")
    payloads = materialize(store.groupBy("address").agg(F.first("payload").alias("payload")), bucket_by="address")
    return headers, payloads


def read_archive(headers: DataFrame, payloads: DataFrame, small: int = 1000) -> DataFrame:
    """(header, record, sha1, bytes, verified): the records rebuilt.

    record: the exact bytes of the WARC record; a revisit has an empty block. sha1 and bytes are those of the payload as
    read, also of a revisit's; verified: the payload has its address as SHA-256 and the header's digest, and the block has
    the header's length. A record whose payload is not in the store is there with null bytes, not verified.

    Payloads are hashed where they are stored, once each. What is known of them goes to the headers by a join whose hot
    addresses Spark can split, with the bytes of those below `small`; larger ones, which hold one response each, stay in
    their buckets, and the responses go there.
    """
    own = F.col("payload")
    facts = payloads.select(F.col("address").alias("__of"), F.sha1(own).alias("sha1"), F.octet_length(own).alias("bytes"), (F.sha2(own, 256) == F.col("address")).alias("sound"), F.when(F.octet_length(own) < small, own).alias("block"))
    revisit = F.col("header").contains(f"{CRLF}WARC-Type: revisit{CRLF}")
    known = headers.join(facts, F.col("address") == F.col("__of"), "left").drop("__of")
    known = materialize(known.withColumn("block", F.when(revisit, F.lit(b"")).otherwise(F.col("block"))))
    large = F.col("block").isNull() & F.col("bytes").isNotNull()
    fetched = known.where(large).drop("block").join(payloads.select("address", F.col("payload").alias("block")), "address").select(known.columns)
    full = known.where(~large).unionByName(fetched)
    said = F.regexp_extract("header", r"\r\nContent-Length: (\d+)\r\n", 1).cast("long")
    fits = F.col("sound") & F.col("header").contains(F.concat(F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), "sha1", F.lit(CRLF))) & (said == F.octet_length("block"))
    record = F.concat(F.encode("header", "UTF-8"), "block", F.lit(b"\r\n\r\n"))
    return full.select("header", record.alias("record"), "sha1", "bytes", F.coalesce(fits, F.lit(False)).alias("verified"))


def export_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """Writes .warc part files: text rows that end with the record separator are records one after another.

    Payloads are text in UTF-8, as page_records makes them; maxRecordsPerFile of the session bounds the files.
    """
    text = records.select(F.decode(F.expr("substring(record, 1, length(record) - 4)"), "UTF-8").alias("value"))
    text.write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of the records in .warc files, cut by their Content-Length. A file is read by one task."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                headers, bodies, at = [], [], 0
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    header = data[at:end]
                    size = int(next(x.split(b":")[1] for x in header.split(b"\r\n") if x.lower().startswith(b"content-length:")))
                    headers.append(header.decode())
                    bodies.append(data[end : end + size])
                    at = end + size + 4
                yield pa.RecordBatch.from_arrays([pa.array(headers, pa.string()), pa.array(bodies, pa.binary())], names=["header", "payload"])

    ensure_on_workers(spark)
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "header string, payload binary")


def page_records(pages: DataFrame, min_revisit: int = 1000, key: str = "page_id") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to, record_sha1, verified), all read back from the archive.

    payload_digest is the SHA-1 of the payload as read back, record_sha1 that of the rebuilt record; verified is false
    where the bytes are not what the record says. Rows that repeat a key have a record each; a row with a null key is read
    back with a null key; an empty table gives an empty one, other columns are left behind.
    """
    records = read_archive(*write_archive(pages, min_revisit, key))
    field = lambda name, pattern: F.nullif(F.regexp_extract("header", rf"\r\n{name}: {pattern}\r\n", 1), F.lit(""))
    return records.select(
        field("WARC-Record-ID", r"<urn:page:(-?\d+)>").cast("long").alias(key),
        F.col("bytes").cast("long").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"),
        field("WARC-Type", r"(\w+)").alias("record_type"),
        field("WARC-Refers-To", r"<urn:page:(-?\d+)>").cast("long").alias("refers_to"),
        F.sha1("record").alias("record_sha1"),
        "verified",
    )
