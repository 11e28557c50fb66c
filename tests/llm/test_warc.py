import hashlib

from pyspark.sql import functions as F

from stopwise.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def forged(i):
    body = "y" * 50
    return f"before{warc.MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\nafter"


def pages():
    rows = [(i, f"http://h/{i}", "p" * i) for i in range(40)]
    rows += [(100 + i, "u\r\nWARC-Type: evil", "same" * 400) for i in range(5)] + [(200, None, None), (201, "u", ""), (None, "u", "n" * 30)]
    rows += [(300, "u", forged(1)), (301, "u", warc.MAGIC * 5), (302, "u", "\r\n\r\n" + warc.MAGIC), (303, "u", forged(2) * 30), (304, "u", "é語" * 700), (305, "u", "é語" * 700)]
    return rows


def test_round_trip_keeps_only_true_records(spark):
    rows = pages()
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(3)
    path = warc.write_archives(warc.records(df))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for split in (old, "1000"):          # records and magics across split borders
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            read = warc.read_archives(spark, path)
            got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.resolved(read).collect()}
            payloads = {r.page_id: bytes(r.payload) for r in read.collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        want = set()
        for i, _, html in rows:
            b = (html or "").encode()
            top = max((j for j, _, h in rows if (h or "").encode() == b and j is not None), default=None)
            later = len(b) >= 1000 and i is not None and i != top
            want.add((i, "revisit" if later else "response", top if later else None, len(b), hashlib.sha1(b).hexdigest()))
        assert got == want
        for i, _, html in rows:
            revisit = (i, "revisit") in {(g[0], g[1]) for g in got}
            assert payloads[i] == (b"" if revisit else (html or "").encode())


def test_cut_file_and_junk_before_the_first_record(spark, tmp_path):
    good = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    cases = {"cut": (good + good[:-5], 1), "junk": ("junk" + good, 0), "two": (good * 2, 2), "empty": ("", 0)}
    for name, (text, n) in cases.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a.warc").write_bytes(text.encode())
        assert warc.read_archives(spark, str(folder)).count() == n, name


def test_pointer_jumping_over_a_long_chain(spark):
    links = spark.range(1, 700).select(F.lit(1).alias("file"), ((F.col("id") - 1) * 10).alias("off"), (F.col("id") * 10).alias("succ"))
    strays = spark.range(0, 300).select(F.lit(1).alias("file"), (F.col("id") * 10 + 3).alias("off"), (F.col("id") * 10 + 10).alias("succ"))
    assert {r.off for r in warc.reachable(links.union(strays)).collect()} == {i * 10 for i in range(699)}


def test_no_pages(spark):
    path = warc.write_archives(warc.records(spark.createDataFrame([], SCHEMA)))
    assert warc.read_archives(spark, path).count() == 0
