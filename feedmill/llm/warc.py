"""WARC archives: writing with revisits, reading by boundary-chain verification.

Writing goes through Spark's text writer: a value is header plus block and the
line separator is the empty lines that end a record, so files are plain WARC and
are committed as any other output.

Reading splits files anywhere.  A task cuts its split at every version magic; the
piece lengths tile the file, so a prefix sum over splits turns them into offsets.
Each piece whose header parses is a candidate record with an offset and the offset
of its successor.  Pointer jumping from offset 0 keeps what the chain reaches; a
magic inside a payload is never reached and its piece rejoins its record.  Pieces are
known by file and offset, which no other planning of a scan changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedmill.runtime import cut, discard, new_path

MAGIC = "WARC/1."
END = "\r\n\r\n"
MIN_REVISIT_BYTES = 100
#: Above so many digests that repeat the join with them is left to a shuffle.
BROADCAST_DIGESTS = 100_000
BROADCAST_FILES = 100_000
#: Bytes of a file within which parts and the records that cover them meet.
STRETCH = 1 << 20


def _digest(payload: Column) -> Column:
    return F.sha2(payload.cast("binary"), 256)


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One record for each row of (page_id, url, html) below ``path``.

    Null html is an empty payload.  Of payloads equal in at least ``min_revisit_bytes``
    bytes that with the smallest page_id is stored (every row that repeats this id is),
    the rest are revisits without payload; a null page_id counts as larger than any and
    is written as an empty id.  CR, LF and the slash of a magic in urls are percent-encoded.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    rows = rows.withColumn("digest", _digest(F.col("html"))).withColumn("bytes", F.octet_length("html").cast("long"))
    firsts = cut(
        rows.filter(F.col("bytes") >= min_revisit_bytes).groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("digest", "first")
    )
    if firsts.count() <= BROADCAST_DIGESTS:
        rows = rows.join(F.broadcast(firsts), "digest", "left")
    else:
        # the page's id spreads the copies of a digest; only ids and digests meet by digest
        told = cut(rows.select("page_id", "digest").distinct().join(firsts, "digest").withColumnRenamed("digest", "_d").withColumnRenamed("page_id", "_p"))
        rows = rows.join(told, (F.col("digest") == F.col("_d")) & F.col("page_id").eqNullSafe(F.col("_p")), "left").drop("_d", "_p")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    uri = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    uri = F.replace(uri, F.lit(MAGIC), F.lit(MAGIC.replace("/", "%2F")))  # reading cuts at every magic, and a header must stay whole
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    header = F.concat(
        F.lit(MAGIC + "0\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), page, F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), uri,
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"), F.lit("\r\nX-Payload-Length: "), F.col("bytes").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END),
    )
    rows.select(F.concat(header, block).alias("value")).write.option("lineSep", END).option("compression", "none").text(path)
    discard(firsts)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The parts between magics: (file, block, seq, value).

    ``seq`` orders the parts of one evaluation only; it and ``block`` depend on how the
    scan was planned.  What is kept is the offset that :func:`_offsets` makes of them.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), F.col("value"),
    )


def _offsets(rows: DataFrame) -> DataFrame:
    """Adds ``at``, the offset of the magic before each part, to a written table of parts with their ``length``.

    A split's parts in order tile it, and splits tile the file, however the scan was cut.
    """
    in_split = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    splits = rows.groupBy("file", "block").agg(F.sum("length").alias("total"))
    before = splits.withColumn(
        "base", F.coalesce(F.sum("total").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).select("file", "block", "base")
    inner = F.coalesce(F.sum("length").over(in_split), F.lit(0))
    return rows.withColumn("inner", inner).join(before, ["file", "block"]).withColumn("at", F.col("base") + F.col("inner") - len(MAGIC)).drop("base", "inner")


def _field(name: str) -> Column:
    """A header field of the candidate, empty if absent."""
    return F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)


def _reachable(candidates: DataFrame) -> DataFrame:
    """(file, at, next) -> (file, at) on the chain from offset 0, by pointer jumping."""
    longest = candidates.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    now = cut(candidates.select("file", "at", "next", (F.col("at") == 0).alias("hit")))
    for _ in range(max(0, longest - 1).bit_length()):
        far = now.select("file", F.col("at").alias("next"), F.col("next").alias("far"))
        step = now.join(far, ["file", "next"], "left")
        told = step.select("file", "at", F.coalesce("far", F.lit(-1)).alias("next"), "hit").unionByName(
            now.filter("hit").select("file", F.col("next").alias("at"), F.lit(None).cast("long").alias("next"), F.lit(True).alias("hit"))
        )
        # a pointer past the last record is no node: it has no next
        after = cut(told.groupBy("file", "at").agg(F.max("next").alias("next"), F.max("hit").alias("hit")).filter("next is not null"))
        discard(now)
        now = after
    return now.filter("hit").select("file", "at")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: file, at, head, record_type, record_id, refers_to, stored digest and length, payload_sha256, payload_length.

    The stored payload is hashed and measured; a revisit has neither.  Files may be cut
    anywhere; a record counts only if the chain of lengths from the file's start reaches it.
    """
    said = F.octet_length("value")
    got = _pieces(spark, path).withColumn("split", F.instr("value", END))
    head = F.when(F.col("split") > 0, F.substring_index("value", END, 1))
    got = got.withColumn("head", head).withColumn("length", said.cast("long") + len(MAGIC))
    clen = F.expr("try_cast(nullif(regexp_extract(head, '(?i)\\r\\nContent-Length:[ \\t]*([0-9]{1,15})', 1), '') as bigint)")
    got = got.withColumn("clen", clen)
    whole = said == F.octet_length("head") + len(END) + F.col("clen") + len(END)
    got = got.withColumn("whole", F.coalesce(whole, F.lit(False)))
    block = F.substring(F.col("value").cast("binary"), F.octet_length("head") + len(END) + 1, F.least("clen", F.lit(2**31 - 1)).cast("int"))
    payload = payload_of(F.when(F.col("whole"), block))
    # a part that is a whole record by itself needs no text any more, unless a longer record holds it
    rows = cut(got.select(
        "file", "block", "seq", "length", "clen", "whole",
        F.when(F.col("clen").isNotNull() & F.col("value").rlike(r"\A[01]\r\n"), F.col("head")).alias("head"),
        F.when(F.col("whole"), F.sha2(payload, 256)).alias("sha"), F.when(F.col("whole"), F.octet_length(payload).cast("long")).alias("size"),
        F.when(~F.col("whole"), F.col("value")).alias("value"),
    ))
    placed = cut(_offsets(rows.drop("value")))
    candidates = placed.filter("head is not null and at >= 0").withColumn(
        "next", F.col("at") + len(MAGIC) + F.octet_length("head") + len(END) + F.col("clen") + len(END)
    )
    chain = cut(_reachable(candidates))
    records = candidates.join(chain.hint("merge"), ["file", "at"])
    whole_ones = records.filter("whole").select("file", "at", "head", "sha", "size")
    broken = cut(records.filter("not whole").select("file", "at", "next", "head", "clen"))
    if broken.count():
        whole_ones = whole_ones.unionByName(_rejoined(spark, path, rows, placed, broken))
    return whole_ones.select(
        "file", "at", "head", _field("WARC-Type").alias("record_type"),
        _field("WARC-Record-ID").alias("record_id"), _field("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha256:", "").alias("stored_digest"),
        F.expr("try_cast(nullif(regexp_extract(head, '(?i)\\r\\nX-Payload-Length:[ \\t]*([0-9]+)', 1), '') as bigint)").alias("stored_length"),
        F.col("sha").alias("payload_sha256"), F.col("size").alias("payload_length"),
    )


def payload_of(block: Column) -> Column:
    """The block's bytes after its HTTP header, of any length, if it has one."""
    text = block.cast("string")  # bytes as they are: only ASCII is looked for
    header = F.octet_length(F.substring_index(text, END, 1)) + len(END)
    return F.when(text.startswith("HTTP/") & (F.instr(text, END) > 0), F.substring(block, header + 1, F.lit(2**31 - 1))).otherwise(block)


def _inside(placed: DataFrame, broken: DataFrame) -> DataFrame:
    """Parts that records of several parts cover: (file, at, length, own), with own the record's offset.

    Reachable records never overlap; parts and records meet by stretches of STRETCH bytes.
    """
    covered = broken.select("file", F.col("at").alias("own"), "next", F.explode(F.sequence((F.col("at") / STRETCH).cast("long"), ((F.col("next") - 1) / STRETCH).cast("long"))).alias("stretch"))
    parts = placed.select("file", "at", "length", "whole", F.floor(F.greatest("at", F.lit(0)) / STRETCH).cast("long").alias("stretch"))
    return parts.join(covered, ["file", "stretch"]).filter((F.col("at") >= F.col("own")) & (F.col("at") < F.col("next"))).drop("stretch", "next")


def _rejoined(spark: SparkSession, path: str, rows: DataFrame, placed: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose payload holds a magic, put together from their parts.

    Texts come from the table of the first scan.  Where a payload holds a whole record, its
    file is scanned again; parts of either scan are known by file and offset alone, so it
    does not matter how the second scan is cut.  A missing part is an error.
    """
    wanted = cut(_inside(placed, broken))
    texts = _texts(rows.filter("value is not null"), placed)
    nested = cut(wanted.filter("whole").select("file").distinct())
    files = nested.count()
    if files:
        again = _pieces(spark, path).join(F.broadcast(nested) if files <= BROADCAST_FILES else nested, "file", "left_semi")
        again = cut(again.withColumn("length", F.octet_length("value").cast("long") + len(MAGIC)))
        texts = texts.join(nested, "file", "left_anti").unionByName(_texts(again, _offsets(again.drop("value"))))
    parts = wanted.select("file", "at", "own").join(texts, ["file", "at"], "left")
    joined = parts.groupBy("file", "own").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
    whole = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    full = joined.select("file", F.col("own").alias("at"), whole.alias("whole")).join(broken, ["file", "at"])
    there = F.octet_length("whole").cast("long") + len(MAGIC)
    checked = F.when(there == F.col("next") - F.col("at"), F.col("whole")).otherwise(F.raise_error(F.concat(F.lit("parts of a record are missing in "), "file", F.lit(" at "), F.col("at").cast("string"))))
    bytes_ = F.substring(checked.cast("binary"), F.octet_length("head") + len(END) + 1, F.least("clen", F.lit(2**31 - 1)).cast("int"))
    full = full.select("file", "at", "head", payload_of(bytes_).alias("payload"))
    return full.select("file", "at", "head", F.sha2("payload", 256).alias("sha"), F.octet_length("payload").cast("long").alias("size"))


def _texts(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """(file, at, value) of parts and their offsets, both of one scan."""
    part = ["file", "block", "seq"]
    return rows.select(*part, "value").join(placed.select(*part, "at"), part).select("file", "at", "value")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Bytes and digest of a response are measured on what was read; a revisit's come from its
    header.  An empty table gives no records.
    """
    spark = pages.sparkSession
    path = new_path(spark)
    write_archives(pages, path)
    got = read_archives(spark, path)
    number = r"^<urn:page:(-?[0-9]+)>$"
    page = lambda c: F.expr(f"try_cast(nullif(regexp_extract({c}, '{number}', 1), '') as bigint)")
    revisit = F.col("record_type") == "revisit"
    return got.select(
        page("record_id").alias("page_id"),
        F.when(revisit, F.col("stored_length")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(revisit, F.col("stored_digest")).otherwise(F.col("payload_sha256")).alias("payload_digest"),
        "record_type", F.when(revisit, page("refers_to")).alias("refers_to"),
    )
