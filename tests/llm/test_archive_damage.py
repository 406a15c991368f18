import hashlib

from pyspark.sql import functions as F

from grovespark.llm import archive, queries


def test_query_flags_damaged_and_missing_payloads(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "u1", "one"), (2, "u2", "two"), (3, None, None)], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert all(r.verified for r in queries.op8_warc_archive(spark, str(tmp_path)).collect())
    write = archive.write_archive

    def damaged(*args):
        headers, payloads = write(*args)
        return headers, payloads.where(F.octet_length("payload") > 0).withColumn("payload", F.when(F.col("payload") == F.lit(b"two"), F.lit(b"tow")).otherwise(F.col("payload")))

    monkeypatch.setattr(archive, "write_archive", damaged)
    assert {r.page_id: r.verified for r in queries.op8_warc_archive(spark, str(tmp_path)).collect()} == {1: True, 2: False, 3: False}


def test_registered_query_reads_and_hashes_the_stored_bytes(spark, sf, monkeypatch):
    plans, write = [], archive.materialize
    of = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(archive, "materialize", lambda df, **how: plans.append(of(df)) or write(df, **how))
    last = of(queries.op8_warc_archive(spark, sf))
    # the stored table is read by the step that hashes it, and the records are hashed by the last one
    assert any("sha1(payload" in p and "sha2(payload" in p and "Relation" in p for p in plans[-1:]) and "sha1(record" in last


def test_empty_pages(spark):
    assert archive.page_records(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_rough_pages(spark):
    """Null keys and addresses, repeated rows, clashing columns, a very long page, and an address that names a revisit."""
    long, profile = "é" * 900_000, archive.REVISIT_PROFILE
    rows = [(1, profile, "<p>a page"), (2, "x\r\nWARC-Type: revisit\r\n", "sha1:"), (None, "n", long), (None, "n", long), (3, None, long), (3, None, long), (4, "u", long), (-5, "u", None), (6, "u", "z" * 1000), (7, "u", "z" * 1000)]
    out = archive.page_records(spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, url string, html string, address string, bytes int"))
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.payload_digest) for r in out.collect()), key=str)
    body = {k: (h or "").encode() for k, _, h in rows}
    kind = lambda k: ("revisit", 4) if k == 3 else ("revisit", 7) if k == 6 else ("response", None)
    assert got == sorted([(k, len(body[k]), *kind(k), hashlib.sha1(body[k]).hexdigest()) for k, _, _ in rows], key=str)
    assert all(r.verified for r in out.collect())


def test_large_payloads_stay_in_their_buckets(spark, sf):
    """Reading moves headers to the stored payloads, and no payload goes through a second shuffle."""
    headers, payloads = archive.write_archive(spark.read.parquet(f"{sf}/pages.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = archive.read_archive(headers, payloads)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(address") == 1 and "Bucketed: true" in plan
