"""WARC archives written and read with Spark's text format; records are found by their boundary chain.

A record starts with the line ``WARC/1.1``. The same bytes may stand inside a payload, so a reader that
starts in the middle of a file cannot trust them. Tasks therefore only emit candidates: the offset of every
such line and the offset where the record would end by its Content-Length. Candidates reachable from the
start of the file over these successors are records; reachability is found by pointer jumping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import staged, table
from tierline.session import scratch_dir

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
BREAK = "\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RADIX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
DATE = "2000-01-01T00:00:00Z"
NO_ID = "none"
# Equal rows are put out in pieces of this many by different tasks.
REPEATS = 10_000


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of binary data: 5 hex digits at a time make 4 base32 digits."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), RADIX32, BASE32)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit(NO_ID)), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value. Breaks in the value would end the line."""
    clean = F.translate(value, "\r\n", "  ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(BREAK)), F.lit(""))


def plan_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with payload, digest, record type and the page they refer to.

    Of equal payloads of ``least_bytes`` or more, the row with the smallest page_id (nulls last) is the
    response and the others revisit it; rows that repeat a page_id are ordered by url, and one of fully equal rows
    is the response. Only digests that occur twice are joined, and only ids are ranked. Rows are told apart by what
    they hold and not by a number, since an input that is read again may come in another order.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long"))
    # The smallest row of each digest and how often it occurs; a task sends each row of a digest once.
    equal = rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "page_id", "url").agg(F.count("*").alias("m"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url", "m"))
    repeated = (
        equal.groupBy("digest")
        .agg(first.alias("first"), F.sum("m").alias("n"))
        .where("n > 1")
        .select("digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), "first.m")
    )
    repeated = staged(repeated, "repeated")
    rows = rows.join(repeated, "digest", "left")
    smallest = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    planned = rows.withColumn("revisit", F.col("m").isNotNull() & ~smallest)
    columns = ["page_id", "url", "payload", "digest", "bytes", "first_id", "revisit"]
    if repeated.where("m > 1").isEmpty():
        return planned.select(*columns)
    # Responses that occur several times: one row with the payload, and the others as revisits.
    several = ~F.col("revisit") & F.coalesce(F.col("m") > 1, F.lit(False))
    keys = ["page_id", "url", "digest", "bytes", "first_id", "m", "revisit"]
    one = planned.where(several).groupBy(*keys).agg(F.first("payload").alias("payload"))
    again = repeated.where("m > 1").withColumn("part", F.explode(F.expr(f"sequence(0L, (m - 2) div {REPEATS})")))
    again = again.repartition("digest", "part").withColumn(
        "i", F.explode(F.expr(f"sequence(part * {REPEATS}, least((part + 1) * {REPEATS}, m - 1) - 1)"))
    )
    sizes = one.select("digest", "bytes")
    again = again.join(sizes, "digest").select(
        F.col("first_id").alias("page_id"),
        F.col("first_url").alias("url"),
        F.lit("").alias("payload"),
        "digest",
        "bytes",
        "first_id",
        F.lit(True).alias("revisit"),
    )
    return planned.where(~several).select(*columns).unionByName(one.select(*columns)).unionByName(again)


def record(planned: DataFrame) -> Column:
    """One whole record but for the blank lines that close it."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + BREAK + "Content-Type: text/html; charset=utf-8" + BREAK),
        _line("Content-Length", F.col("bytes").cast("string")),
        F.lit(BREAK),
    )
    block = F.concat(http, F.when(F.col("revisit"), "").otherwise(F.col("payload")))
    kind = F.when(F.col("revisit"), "revisit").otherwise("response")
    return F.concat(
        F.lit(MAGIC),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _urn(F.col("page_id"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            F.col("revisit"),
            F.concat(
                _line("WARC-Refers-To", _urn(F.col("first_id"))), _line("WARC-Profile", F.lit(PROFILE))
            ),
        ).otherwise(""),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
        block,
    )


def write_warc(pages: DataFrame, path: str, least_bytes: int = 0, file_rows: int = 50_000) -> None:
    """One record per page below ``path``; every task writes its own files of ``file_rows`` records at most."""
    planned = plan_revisits(pages, least_bytes)
    planned.select(record(planned).alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", file_rows
    ).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic line up to the next one, with its file and the block that read it."""
    return (
        spark.read.option("lineSep", MAGIC)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            "value",
            F.col("value").cast("binary").alias("segment"),
        )
    )


def _field(head: Column, name: str) -> Column:
    value = F.regexp_extract(head, rf"(?:^|\n)(?i:{name}):[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def _number(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]{1,18}$"), text.cast("long"))


def _jump(runs: DataFrame) -> DataFrame:
    """Runs reachable from the start of their file; pointers double their reach in each round.

    ``runs``: file, head, next (the head that follows, or null). Returns file, head.
    """
    reached = staged(runs.where("head = 0").select("file", "head"), "reached")
    jumps = staged(runs.where("next IS NOT NULL").select("file", "head", "next"), "jumps")
    count, before = reached.count(), -1
    while count > before:
        step = reached.join(jumps, ["file", "head"]).select("file", F.col("next").alias("head"))
        reached = staged(reached.union(step).distinct(), "reached")
        far = jumps.select("file", F.col("head").alias("next"), F.col("next").alias("after"))
        jumps = staged(jumps.join(far, ["file", "next"]).select("file", "head", F.col("after").alias("next")), "jumps")
        before, count = count, reached.count()
    return reached


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the uncompressed archives below ``path``, without their payloads.

    Returns file, start and stop (byte offsets), header (the WARC header), http (the header of its block),
    payload_bytes and payload_digest of the stored payload. Large files are split over tasks. A candidate
    without a readable Content-Length, or that ends behind the file, ends the chain of its file: what lies
    behind is not returned. A file that does not begin with the magic line has no records. Windows hold
    the candidates of one file, in a few numbers each; ``write_warc`` bounds them.
    """
    magic = len(MAGIC)
    head = F.substring_index("value", END, 1)
    found = _segments(spark, path).select(
        "file",
        "block",
        "seq",
        F.octet_length("segment").cast("long").alias("bytes"),
        (F.octet_length(head) + len(END)).cast("long").alias("head_bytes"),
        _number(_field(head, "Content-Length")).alias("length"),
        F.xxhash64("segment").alias("print"),
        head.alias("header"),
        "segment",
    )
    # What the record holds if no magic line lies inside it; else it is measured again below.
    body = F.expr("substring(segment, CAST(head_bytes AS INT) + 1, CAST(least(length, bytes) AS INT))")
    narrow = staged(_measured(found, body).drop("segment", "value"), "candidates")

    # Offsets: first the sizes of blocks, then the sizes within a block. A piece lies behind its magic
    # line, except for the piece at the start of a file, which must be empty.
    spans = narrow.groupBy("file", "block").agg(F.sum(F.col("bytes") + magic).alias("span"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = spans.select("file", "block", F.coalesce(F.sum("span").over(earlier), F.lit(0)).alias("base"))
    in_block = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(F.col("bytes") + magic).over(in_block), F.lit(0))
    start = F.col("base") + F.col("within") - magic
    by_file = Window.partitionBy("file").orderBy("start")
    nodes = staged(
        narrow.withColumn("within", within)
        .join(bases, ["file", "block"])
        .withColumn("start", start)
        .withColumn("before", F.first("bytes").over(by_file))
        .where("start >= 0 AND before = 0")
        .withColumn("succ", F.col("start") + magic + F.col("head_bytes") + F.col("length") + len(END))
        .withColumn("end", F.col("start") + magic + F.col("bytes"))
        .drop("block", "seq", "within", "base", "before"),
        "nodes",
    )
    out = ["file", "start", "stop", "header", "http", "payload_bytes", "payload_digest"]
    odd = nodes.where("succ IS NULL OR succ <> end")
    if odd.isEmpty():
        return nodes.withColumn("stop", F.col("succ")).select(*out)

    # Candidates that end where the next one starts form runs; only runs need jumping.
    targets = odd.where("succ IS NOT NULL").select("file", F.col("succ").alias("start"), F.lit(True).alias("target"))
    linked = F.lag("succ").over(by_file).eqNullSafe(F.col("start"))
    member = staged(
        nodes.join(targets.distinct(), ["file", "start"], "left")
        .withColumn("head", F.when(~linked | F.col("target").isNotNull(), F.col("start")))
        .withColumn("head", F.last("head", ignorenulls=True).over(by_file))
        .drop("target"),
        "members",
    )
    runs = member.groupBy("file", "head").agg(F.max_by("succ", "start").alias("next"))
    sizes = nodes.groupBy("file").agg(F.max("end").alias("size"))
    kept = (
        member.join(_jump(runs), ["file", "head"])
        .join(sizes, "file")
        .where("succ <= size")
        .select(*[c for c in nodes.columns], F.col("succ").alias("stop"))
    )
    kept = staged(kept, "kept")
    plain = kept.where("stop = end").select(*out)
    split = kept.where("stop <> end")
    if split.isEmpty():
        return plain
    whole = payloads(spark, path, split.select("file", "start", "stop", "head_bytes", "length", "header"), nodes)
    measured = _measured(whole, F.col("block"))
    return plain.unionByName(measured.select(*out))


def _measured(df: DataFrame, block: Column) -> DataFrame:
    """Adds http, payload_bytes and payload_digest of a block with an HTTP header."""
    http = F.substring_index(block.cast("string"), END, 1)
    offset = F.octet_length(http) + len(END) + 1
    df = df.withColumn("http", http)
    payload = F.substring(block, offset, F.lit(2**31 - 1))
    return df.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn(
        "payload_digest", base32_sha1(payload)
    )


def payloads(spark: SparkSession, path: str, records: DataFrame, nodes: DataFrame) -> DataFrame:
    """``records`` (file, start, stop, head_bytes, length) with ``block``, put together from their pieces.

    The archive is read once more; a piece is known by file, size and hash, so nothing depends on the order
    of a reading. A group holds the pieces of one record.
    """
    magic = F.lit(MAGIC.encode())
    owner = Window.partitionBy("file").orderBy("at")
    marks = records.select("file", F.col("start").alias("at"), F.struct("start", "stop").alias("mark"))
    pieces = nodes.select("file", F.col("start").alias("at"), "bytes", "print").join(marks, ["file", "at"], "left")
    pieces = pieces.withColumn("mark", F.last("mark", ignorenulls=True).over(owner)).where("at < mark.stop")
    pieces = staged(pieces.select("file", "at", "bytes", "print", "mark.start"), "pieces")
    keys = ["file", "print", "bytes"]
    text = (
        _segments(spark, path)
        .select("file", "segment", F.xxhash64("segment").alias("print"), F.octet_length("segment").cast("long").alias("bytes"))
        .join(pieces.select(*keys).distinct(), keys, "left_semi")
        .dropDuplicates(keys)
    )
    parts = F.array_sort(F.collect_list(F.struct("at", "segment")))
    joined = pieces.join(text, keys).groupBy("file", "start").agg(parts.alias("parts"))
    rest = F.slice("parts", F.lit(2), F.size("parts"))
    joined = joined.withColumn(
        "segment",
        F.aggregate(rest, F.col("parts")[0]["segment"], lambda a, p: F.concat(a, magic, p["segment"])),
    )
    block = F.expr("substring(segment, CAST(head_bytes AS INT) + 1, CAST(length AS INT))")
    return records.join(joined, ["file", "start"]).withColumn("block", block).drop("segment", "parts")


def _page(urn: Column) -> Column:
    page_id = F.regexp_extract(urn, "<urn:page:(-?[0-9]+)>", 1)
    return F.when(page_id != "", page_id.cast("long"))


def op5_warc_boundary_chain(spark, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back; revisits from 0 bytes on."""
    path = scratch_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    found = read_warc(spark, path)
    header, http = F.col("header"), F.col("http")
    kind = _field(header, "WARC-Type")
    stored = kind == "response"
    return found.select(
        _page(_field(header, "WARC-Record-ID")).alias("page_id"),
        F.when(stored, F.col("payload_bytes"))
        .otherwise(_number(_field(http, "Content-Length")))
        .alias("payload_bytes"),
        F.when(stored, F.col("payload_digest"))
        .otherwise(F.regexp_extract(_field(header, "WARC-Payload-Digest"), "sha1:(.*)", 1))
        .alias("payload_digest"),
        kind.alias("record_type"),
        _page(_field(header, "WARC-Refers-To")).alias("refers_to"),
    )
