"""WARC archives: writing pages as records, and reading them back by boundary chains.

*Writing.* Each page is one record; records of a task form one archive file, written by
Spark's text writer with CR LF as line end (a record's own last CR LF), so commits survive
lost tasks and any file system that Spark writes to will do. Of pages with equal payloads
of at least ``min_revisit`` bytes the one with the largest page_id is a ``response``, the
others are ``revisit`` records that refer to it and carry no payload.

*Reading.* The text reader cuts files at the record magic into pieces, in splits of any
size. A piece's offset is the sum of the lengths before it: within its split from the order
of reading, across splits from the splits' totals. Each piece that parses as a record head
is a candidate with a successor, the offset after its declared length. A payload may hold
the magic, even a whole forged record, so candidates alone prove nothing: pointer jumping
from each file's start (reach doubles every round) keeps the candidates on the chain, and
only those. A record's payload is then put together from the pieces between its offset and
its successor.

Defined results: null html is an empty payload; a null page_id is written and read as none;
rows equal in id and payload that hold the largest id are all responses; line breaks in a
url are percent-encoded; an empty table writes no records; extra columns are ignored. A file
that is cut short ends its chain at the cut: a last record whose end is missing is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import linking
from .shared import scratch, stored

MAGIC = "WARC/1.1\r\n"
MIN_REVISIT = 1000
RECORDS_PER_FILE = 20_000


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, record_type, refers_to) of every page."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"),
                     F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(html.cast("binary")).alias("payload_digest"))
    # Only digests that occur more than once are joined back; a digest's copies are combined map-side.
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.octet_length(html).alias("n"), F.sha1(html.cast("binary")).alias("payload_digest"))
    shared = stored(slim.where(F.col("n") >= min_revisit).groupBy("payload_digest").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("c"))
                    .where("c > 1 and first_id is not null").drop("c"), "warc-shared")
    later = (F.col("page_id").isNull() | (F.col("page_id") < F.col("first_id"))) & F.col("first_id").isNotNull()
    return (p.join(linking.bounded(shared), "payload_digest", "left")
            .withColumn("record_type", F.when(later, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(later, F.col("first_id"))).drop("first_id"))


def _record_text(digest_prefix: str = "sha1:") -> Column:
    """The record after the magic, without its last CR LF."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    maybe = lambda name, value: F.when(value.isNotNull(), line(name, value)).otherwise("")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    body = F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("html"))
    return F.concat(
        F.lit(MAGIC), line("WARC-Type", F.col("record_type")), maybe("WARC-Record-ID", urn("page_id")), maybe("WARC-Refers-To", urn("refers_to")),
        line("WARC-Target-URI", F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        line("WARC-Payload-Digest", F.concat(F.lit(digest_prefix), F.col("payload_digest"))), line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        line("Content-Length", F.octet_length(body).cast("string")), F.lit("\r\n"), body, F.lit("\r\n"))


def write_archives(recs: DataFrame, path: str | None = None) -> str:
    """Write records as archive files below ``path`` (a new shared folder by default) and return it."""
    path = path or scratch(recs.sparkSession, "warc")
    (recs.select(_record_text().alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))
    return path


def _head(name: str) -> Column:
    found = F.regexp_extract(F.col("head"), rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def pieces(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(at, value) and (at, file, file_size, off, head_bytes, length) of what follows each magic, up to the next one.

    ``off`` is the magic's byte offset; ``head_bytes`` and the declared ``length`` are null where
    the piece does not parse as a record head. Bytes before a file's first magic belong to no
    record. The payloads are stored once; everything else works on the narrow columns."""
    # The reader yields, per split and in file order, what lies between two magics.
    head = F.when(F.instr("value", "\r\n\r\n") > 0, F.substring_index("value", "\r\n\r\n", 1))
    size = _head("Content-Length")
    valid = size.rlike("^[0-9]{1,15}$") & _head("WARC-Type").isNotNull()
    raw = (spark.read.option("lineSep", MAGIC).text(path)
           .select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("file_size"),
                   F.monotonically_increasing_id().alias("at"), "value").withColumn("head", head)
           .select("file", "split", "file_size", "at", F.octet_length("value").cast("long").alias("n"),
                   F.when(valid, F.octet_length("head")).cast("int").alias("head_bytes"), F.when(valid, size.cast("long")).alias("length"), "value"))
    raw = stored(raw, "warc-pieces", compression="zstd")
    step = F.lit(len(MAGIC))
    slim = raw.drop("value")
    totals = slim.groupBy("file", "split").agg(F.sum(F.col("n") + step).alias("bytes"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("base", F.coalesce(F.sum("bytes").over(before), F.lit(0))).drop("bytes")
    inside = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # The text of piece i starts after the magic that ends piece i - 1.
    offs = (slim.withColumn("up", F.coalesce(F.sum(F.col("n") + step).over(inside), F.lit(0))).join(bases, ["file", "split"])
            .withColumn("start", F.col("base") + F.col("up")).where("start > 0"))
    return raw.select("at", "value"), stored(offs.select("at", "file", "file_size", (F.col("start") - step).alias("off"), "head_bytes", "length"), "warc-offsets")


def candidates(offsets: DataFrame) -> DataFrame:
    """Pieces that parse as record heads, with the successor offset their length declares."""
    succ = F.col("off") + len(MAGIC) + F.col("head_bytes") + 4 + F.col("length") + 4
    return offsets.where("length is not null").withColumn("succ", succ).where("succ <= file_size")


def reachable(links: DataFrame) -> DataFrame:
    """(file, off) of the candidates on each file's chain from offset 0.

    ``links``: (file, off, succ). Round r knows every candidate reached in fewer than 2^r
    steps and every candidate's 2^r-th successor; both double by one join each, so a file of
    n records takes log2(n) rounds, whatever the number of files."""
    jump = links.select("file", "off", F.col("succ").alias("to"))
    reach = jump.where("off = 0").select("file", "off")
    count = -1
    while True:
        reach = stored(reach.join(jump, ["file", "off"]).select("file", F.col("to").alias("off")).join(links.select("file", "off"), ["file", "off"], "left_semi")
                       .union(reach).distinct(), "warc-reach")
        now = reach.count()
        if now == count:
            return reach
        count = now
        jump = stored(jump.alias("x").join(jump.alias("y"), (F.col("x.file") == F.col("y.file")) & (F.col("x.to") == F.col("y.off")))
                      .select("x.file", "x.off", F.col("y.to").alias("to")), "warc-jump")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, url, payload, declared_digest, declared_bytes) of every record on a chain."""
    raw, offsets = pieces(spark, path)
    found = stored(candidates(offsets), "warc-candidates")
    on = stored(found.join(reachable(found.select("file", "off", "succ")), ["file", "off"], "left_semi").select("at", "head_bytes", "length"), "warc-records")
    # Most records are one piece; a payload that holds the magic has more, which follow in offset order.
    order = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    owner = (offsets.select("at", "file", "off").join(on.select("at", F.col("at").alias("own")), "at", "left")
             .withColumn("own", F.last("own", ignorenulls=True).over(order)).where("own is not null and own <> at"))
    owner = stored(owner.select("at", "off", "own"), "warc-owners")
    rest = (raw.join(linking.bounded(owner), "at").groupBy("own")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("off", "value"))), lambda s: F.concat(F.lit(MAGIC), s["value"])), "").alias("rest")))
    whole = raw.join(linking.bounded(on), "at").join(rest, F.col("at") == F.col("own"), "left") if not owner.isEmpty() else (
        raw.join(linking.bounded(on), "at").withColumn("rest", F.lit("")))
    whole = whole.withColumn("head", F.substring_index("value", "\r\n\r\n", 1))
    tail = F.concat(F.col("value"), F.coalesce("rest", F.lit(""))).cast("binary")
    payload = F.substring(tail, F.col("head_bytes") + 5, F.col("length").cast("int"))
    page = lambda name: F.regexp_extract(_head(name), r"<urn:page:(-?\d+)>", 1).cast("long")
    return whole.select(page("WARC-Record-ID").alias("page_id"), _head("WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
                        _head("WARC-Target-URI").alias("url"), payload.alias("payload"),
                        F.substring_index(_head("WARC-Payload-Digest"), ":", -1).alias("declared_digest"), _head("X-Payload-Length").cast("long").alias("declared_bytes"))


def resolved(read: DataFrame) -> DataFrame:
    """Records with the bytes and digest of their full payload: a response's from its payload, a revisit's as it declares."""
    revisit = F.col("record_type") == "revisit"
    return read.select("page_id", F.when(revisit, F.col("declared_bytes")).otherwise(F.octet_length("payload").cast("long")).alias("payload_bytes"),
                       F.when(revisit, F.col("declared_digest")).otherwise(F.sha1("payload")).alias("payload_digest"), "record_type", "refers_to",
                       (revisit | (F.sha1("payload") == F.col("declared_digest"))).alias("digest_ok"))
