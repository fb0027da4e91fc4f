"""WARC archives: writing page captures with revisits, and reading them back by a verified
chain of record boundaries. DataFrame operations only.

Writing. Records are text lines whose line end is the empty line pair that ends a WARC
record, so Spark's own writer and committer lay them out on any file system.

Reading. Files are read in splits at every occurrence of the magic ``WARC/1.0``. Each
occurrence is a candidate record: its offset follows from the lengths before it (per split,
then per file), its successor from its header and Content-Length. A magic inside a payload,
even one that heads a whole embedded record, is a candidate too. Pointer jumping from offset
0 of each file (pointers double in every round, so a file of n records takes log2 n rounds)
keeps the candidates that the chain reaches; the others lie inside payloads.

Defined cases: a null html is empty; a null url is written as ``urn:none`` and read as null;
white space and control characters in a url are percent-encoded; a null page_id is written
without a number and read as null, and refers to the smallest non-null page_id with its
payload; pages with the same page_id and payload are all responses if theirs is the
smallest; an empty table gives an archive without records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import with_group_total
from tidewater.session import materialize

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
FILE_RECORDS = 2048  # records in a file, at most
DATE = "2020-01-01T00:00:00Z"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(hex40: Column) -> Column:
    """Bare upper-case base32 of 20 bytes given as hexadecimal digits."""
    out = []
    for i in range(4):  # 10 hexadecimal digits are 8 base32 digits
        v = F.conv(F.substring(hex40, 10 * i + 1, 10), 16, 10).cast("long")
        out += [F.substring(F.lit(_BASE32),
                            (F.shiftright(v, 5 * (7 - j)).bitwiseAND(31) + 1).cast("int"), 1)
                for j in range(8)]
    return F.concat(*out)


def _bytes(c: Column) -> Column:
    return c.cast("binary")


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, payload_bytes, payload_digest,
    record_type and refers_to. Of pages with equal payloads of at least ``min_bytes`` bytes
    that with the smallest page_id is the response."""
    d = (pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
         .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
         .withColumn("_key", F.sha2(_bytes(F.col("payload")), 256)))
    small = with_group_total(
        d.where(F.col("payload_bytes") >= min_bytes).select("page_id", "_key"), ["_key"],
        ["page_id"], {"_first": (F.min("page_id"), F.min("_first"))})
    # Only the revisits are joined back: the planner broadcasts their written table by its
    # size, and moves the payloads only where they are many.
    again = materialize(
        small.where(F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")))
        .select(F.col("page_id").alias("_id"), F.col("_key").alias("_k"), "_first").distinct(),
        "revisits")
    d = d.join(again, (d["_key"] == again["_k"]) & d["page_id"].eqNullSafe(again["_id"]), "left")
    return (d.withColumn("payload_digest", base32_of_hex(F.sha1(_bytes(F.col("payload")))))
            .withColumn("record_type", F.when(F.col("_first").isNotNull(), "revisit")
                        .otherwise("response"))
            .withColumnRenamed("_first", "refers_to").drop("_key", "_k", "_id"))


def _uri(url: Column) -> Column:
    out = F.coalesce(url, F.lit("urn:none"))
    for code in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def _page(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))


def write(captures: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Writes the rows of ``with_revisits`` as WARC files under ``path``."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("payload_bytes").cast("string"),
                    F.lit(END))
    again = F.col("record_type") == "revisit"
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), _page(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), _uri(F.col("url")),
        F.when(again, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/"
                  "identical-payload-digest\r\nWARC-Refers-To: "), _page(F.col("refers_to"))))
        .otherwise(F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(END))
    (captures.select(F.concat(head, block).alias("value"))
     .write.option("lineSep", END).option("maxRecordsPerFile", file_records).text(path))


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between consecutive magics of each file."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"))


def _field(head: Column, name: str, pattern: str) -> Column:
    found = F.regexp_extract(head, rf"(?im)^{name}:[ \t]*{pattern}[ \t]*\r?$", 1)
    return F.when(found != "", found)


def _payload_of(block: Column) -> Column:
    """What follows the HTTP header of a record's block (bytes)."""
    head = F.octet_length(F.substring_index(block.cast("string"), END, 1))
    return F.substring(block, head + len(END) + 1, F.octet_length(block))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every occurrence of the magic: file, offset, successor (null without a whole header),
    the header's fields, whether the record ends within its segment (``whole``) and then
    its payload's length and SHA-1; ``mark`` and ``size`` of the segment."""
    head = F.substring_index("value", END, 1)
    size = F.octet_length("value").cast("long")
    length = F.col("content_length")
    raw = (_segments(spark, path)
           .withColumn("seq", F.monotonically_increasing_id())
           .withColumn("head", F.when(F.col("value").contains(END), head))
           .withColumn("size", size)
           .withColumn("head_size", F.octet_length("head").cast("long") + len(END))
           .withColumn("content_length", _field(F.col("head"), "Content-Length",
                                                r"(\d{1,18})").cast("long"))
           .withColumn("whole", F.col("head_size") + length <= F.col("size")))
    block = F.substring(_bytes(F.col("value")), (F.col("head_size") + 1).cast("int"),
                        length.cast("int"))
    payload = F.when(F.col("whole"), _payload_of(block))
    page = r"<urn:page:([^>]*)>"
    narrow = raw.select(
        "file", "split", "seq", "size", "head_size", "content_length", "whole",
        F.xxhash64("value").alias("mark"),
        _field(F.col("head"), "WARC-Type", r"(\S+)").alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID", page).cast("long").alias("page_id"),
        _field(F.col("head"), "WARC-Refers-To", page).cast("long").alias("refers_to"),
        _field(F.col("head"), "WARC-Target-URI", r"(\S+)").alias("url"),
        _field(F.col("head"), "WARC-Payload-Digest", r"sha1:(\S+)").alias("stated_digest"),
        _field(F.col("head"), "X-Payload-Length", r"(\d{1,18})").cast("long")
        .alias("stated_bytes"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("sha1"))
    narrow = materialize(narrow, "warc-segments")
    step = F.col("size") + len(MAGIC)
    inside = Window.partitionBy("file", "split").orderBy("seq")
    splits = narrow.groupBy("file", "split").agg(F.sum(step).alias("t"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("t").over(before), F.lit(0))
                           .alias("base"))
    at = (narrow.withColumn("_in", F.sum(step).over(
        inside.rowsBetween(Window.unboundedPreceding, -1)))
        .join(splits, ["file", "split"])
        .withColumn("offset", F.col("base") + F.coalesce("_in", F.lit(0)) - len(MAGIC)))
    at = at.withColumn("successor", F.col("offset") + len(MAGIC) + F.col("head_size")
                       + length + len(END))
    return at.drop("split", "seq", "_in", "base")


def reachable(nodes: DataFrame) -> DataFrame:
    """``nodes``: file, offset, successor. The (file, offset) that the chain from offset 0
    reaches, by pointer jumping."""
    found = nodes.where("offset = 0").select("file", "offset")
    there = nodes.select("file", F.col("offset").alias("to"))
    jump = materialize(nodes.select("file", "offset", F.col("successor").alias("to"))
                       .where("to is not null").join(there, ["file", "to"]), "warc-jump")
    found = materialize(found, "warc-chain")
    while not jump.isEmpty():
        more = found.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        found = materialize(found.unionByName(more).distinct(), "warc-chain")
        far = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("end"))
        jump = materialize(jump.join(far, ["file", "to"])
                           .select("file", "offset", F.col("end").alias("to")), "warc-jump")
    return found


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``: file, offset, record_type, page_id, url,
    refers_to, payload_bytes and payload_digest (of the full payload: a response's are
    computed from its bytes, a revisit's are those that its header states)."""
    seen = materialize(candidates(spark, path).where("offset >= 0"), "warc-candidates")
    chain = reachable(seen.select("file", "offset", "successor"))
    mine = seen.join(chain, ["file", "offset"])
    parted = mine.where(~F.col("whole")).select("file", "offset")
    if not parted.isEmpty():
        full = _assembled(spark, path, seen, chain)
        mine = (mine.join(full, ["file", "offset"], "left")
                .withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes"))
                .withColumn("sha1", F.coalesce("sha1", "_sha1")))
    again = F.col("record_type") == "revisit"
    return mine.select(
        "file", "offset", "record_type", "page_id",
        F.when(F.col("url") != "urn:none", F.col("url")).alias("url"), "refers_to",
        F.when(again, F.col("stated_bytes")).otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(again, F.col("stated_digest")).otherwise(base32_of_hex(F.col("sha1")))
        .alias("payload_digest"))


def _assembled(spark: SparkSession, path: str, seen: DataFrame, chain: DataFrame) -> DataFrame:
    """Length and SHA-1 of payloads that hold a magic, put together from their segments."""
    mark = chain.withColumn("owner", F.col("offset"))
    last = Window.partitionBy("file").orderBy("offset").rowsBetween(
        Window.unboundedPreceding, 0)
    owned = (seen.join(mark, ["file", "offset"], "left")
             .withColumn("owner", F.last("owner", ignorenulls=True).over(last))
             .select("file", "offset", "owner", "mark", "size"))
    split = (seen.join(chain, ["file", "offset"]).where(~F.col("whole"))
             .select("file", F.col("offset").alias("owner"), "head_size", "content_length"))
    need = materialize(owned.join(split, ["file", "owner"]), "warc-parted")
    keys = need.select("file", "mark", "size").distinct()
    text = (_segments(spark, path).withColumn("mark", F.xxhash64("value"))
            .withColumn("size", F.octet_length("value").cast("long"))
            .join(keys, ["file", "mark", "size"]).dropDuplicates(["file", "mark", "size"]))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "value"))),
                        lambda x: x["value"])
    whole = (need.join(text, ["file", "mark", "size"])
             .groupBy("file", "owner", "head_size", "content_length")
             .agg(F.array_join(parts, MAGIC).alias("value")))
    payload = _payload_of(F.substring(
        _bytes(F.col("value")), (F.col("head_size") + 1).cast("int"),
        F.col("content_length").cast("int")))
    return whole.select("file", F.col("owner").alias("offset"),
                        F.octet_length(payload).cast("long").alias("_bytes"),
                        F.sha1(payload).alias("_sha1"))
