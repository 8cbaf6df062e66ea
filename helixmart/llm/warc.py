"""WARC archives written and read with Spark's text files; records are found by boundary-chain verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixmart.llm.common import drop_settled, settle

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# Bits of the map that tells which pages may have a repeated payload: its bound whatever the number of pages.
MAP_BITS = 1 << 22


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 bits at a time through ``conv``, which counts to base 36."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """One row per page: page_id, url, payload, digest, and refers_to for pages whose payload an earlier page has."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("sha")
    )
    # Digests are counted before they meet: one row for each repeated payload, however many pages share it.
    first = rows.where(F.octet_length("payload") >= least).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    # Only pages whose digest falls on a bit of a repeated one are shuffled; all others stay where they are read.
    first = settle(first.select("sha", "first"), "warc-repeated")
    bit = F.pmod(F.xxhash64("sha"), F.lit(MAP_BITS))
    words = first.select(F.shiftright(bit, 5).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(sha), {MAP_BITS}) % 32 as int))").alias("one"))
    bitmap = settle(words.groupBy("word").agg(F.bit_or("one").alias("bits")), "warc-map")
    marked = rows.withColumn("_bit", bit).join(F.broadcast(bitmap), F.shiftright("_bit", 5) == F.col("word"), "left")
    marked = marked.withColumn("maybe", F.coalesce(F.expr("(bits & shiftleft(1L, cast(_bit % 32 as int))) <> 0"), F.lit(False)))
    known = marked.where("maybe").join(first, "sha", "left")
    alone = marked.where("not maybe").withColumn("first", F.lit(None).cast("long"))
    columns = ["page_id", "url", "payload", "first"]
    return known.select(columns).unionByName(alone.select(columns)).select(
        "page_id", "url", "payload", sha1_base32(F.col("payload").cast("binary")).alias("digest"),
        F.when((F.col("first") != F.col("page_id")) | F.col("page_id").isNull(), F.col("first")).alias("refers_to"),
    )


def write(records: DataFrame, path: str, records_per_file: int = 2048, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write planned records as WARC 1.1 files: Spark's text writer, whose line end is the format's record end."""
    # A header value holds no line break: control characters of a URL are written as percent codes.
    url = F.regexp_replace(F.regexp_replace(F.col("url"), "\r", "%0D"), "\n", "%0A")
    body = F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(""))
    http = F.concat(F.lit(HTTP_HEAD + "\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    block = F.concat(http, body)
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    header = F.concat_ws(
        "\r\n",
        F.concat(F.lit("WARC-Type: "), F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:none>"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to"))),
        F.when(F.col("refers_to").isNotNull(), F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    lines = records.select(F.concat(F.lit(MAGIC), header, F.lit(END), block).alias("value"))
    lines.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


SEGMENT = ["file", "block", "turn"]


def segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, turn, size, value): the stretches that follow each occurrence of the magic, in order of block and turn.

    The files are cut at the magic by Spark's splittable text reader, inside payloads as well. What stands before
    a file's first magic is a stretch, too: an empty one in a sound file.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("turn"), "value"
    )
    return settle(raw.withColumn("size", F.octet_length("value")), "warc-segments", "zstd")


def places(segments: DataFrame) -> DataFrame:
    """(file, block, turn, at): the byte offset of the magic before each stretch, negative for what has none."""
    step = len(MAGIC)
    # Offsets in two steps: sums of whole splits, then within a split.
    splits = segments.groupBy("file", "block").agg(F.sum(F.col("size") + step).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    spans = segments.select(*SEGMENT, F.coalesce(F.sum(F.col("size") + step).over(inside), F.lit(0)).alias("here"))
    return spans.join(splits, ["file", "block"]).select(*SEGMENT, (F.col("base") + F.col("here") - step).alias("at"))


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, at) of records on the chain from the file's start, by pointer jumping over (file, at, next).

    After each round the known part of the chain is twice as long, and so are the jumps.
    """
    jumps = settle(candidates.where("next is not null").select("file", "at", "next"), "warc-jumps")
    known = settle(candidates.where("at = 0").select("file", "at"), "warc-known")
    count = known.count()
    while True:
        # The tables grow with the archives: never broadcast.
        ahead = known.join(jumps.hint("merge"), ["file", "at"]).select("file", F.col("next").alias("at"))
        ahead = ahead.join(candidates.select("file", "at").hint("merge"), ["file", "at"], "left_semi")
        grown = settle(known.union(ahead).distinct(), "warc-known")
        new_count = grown.count()
        drop_settled(known)
        if new_count == count:
            return grown
        known, count = grown, new_count
        onward = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("beyond")).hint("merge")
        further = settle(jumps.join(onward, ["file", "next"]).select("file", "at", F.col("beyond").alias("next")), "warc-jumps")
        drop_settled(jumps)
        jumps = further


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: page_id, url, record_type, refers_to, digest, payload, intact.

    Every occurrence of the magic is a candidate that names its successor's offset; only those that the
    chain from the file's start reaches are records, so a magic inside a payload is payload. ``intact``:
    the payload has the digest that its header gives (NULL for revisits, which carry none).
    """
    parts = segments(spark, path)
    head = F.substring_index("value", END, 1)
    length = F.regexp_extract(head, r"(?:^|\r\n)Content-Length: (\d{1,18})(?:\r\n|$)", 1).try_cast("long")
    heads = parts.select(*SEGMENT, (len(MAGIC) + F.octet_length(head) + len(END) + length + len(END)).alias("reach"))
    candidates = places(parts).join(heads, SEGMENT).where("at >= 0").select(*SEGMENT, "at", (F.col("at") + F.col("reach")).alias("next"))
    candidates = settle(candidates, "warc-candidates")
    records = reachable(candidates).withColumn("record", F.col("at"))
    # A stretch that no chain reaches belongs to the record before it. Only records of several stretches, which are
    # rare, are put together; all others stay where they were read.
    owners = candidates.select(*SEGMENT, "at").join(records.hint("merge"), ["file", "at"], "left")
    upto = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owners = owners.withColumn("record", F.last("record", ignorenulls=True).over(upto))
    in_record = Window.partitionBy("file", F.coalesce("record", F.lit(-1)))
    odd = owners.withColumn("pieces", F.count("*").over(in_record)).where("pieces > 1 or record is null").drop("pieces")
    odd = settle(odd, "warc-odd")
    # The stretch before a file's first magic is empty.
    whole = parts.where("size > 0").join(odd.select(SEGMENT), SEGMENT, "left_anti").select("value")
    mended = parts.join(odd.where("record is not null"), SEGMENT).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("parts"))
    text = whole.union(mended.select(F.array_join(F.col("parts.value"), MAGIC).alias("value")))
    head = F.substring_index("value", END, 1)
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1), F.lit(""))
    number = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1).try_cast("long")
    split = text.select(head.alias("head"), F.expr(f"substring(value, length(substring_index(value, '{END}', 1)) + {len(END) + 1})").alias("rest"))
    split = split.withColumn("size", field("Content-Length").cast("long"))
    # The block ends where the header says; the record end follows it.
    block = F.substring(F.col("rest").cast("binary"), 1, F.col("size").cast("int")).cast("string")
    split = split.withColumn("block", block).drop("rest")
    body = F.expr(f"substring(block, length(substring_index(block, '{END}', 1)) + {len(END) + 1})")
    out = split.select(
        number(field("WARC-Record-ID")).alias("page_id"), field("WARC-Target-URI").alias("url"), field("WARC-Type").alias("record_type"),
        number(field("WARC-Refers-To")).alias("refers_to"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("digest"), body.alias("payload"),
    )
    return out.withColumn("intact", F.when(F.col("record_type") == "response", sha1_base32(F.col("payload").cast("binary")) == F.col("digest")))


def archive(pages: DataFrame, path: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Write ``pages`` as WARC files below ``path``, equal payloads of at least ``least`` bytes once.

    Edge cases: a NULL payload is an empty one; a NULL url leaves the field out, and an empty one comes back as
    NULL; line breaks of a url are written, and come back, as %0D and %0A; a row without page_id is
    written as ``<urn:page:none>`` and revisits the payload's smallest page_id, if there is one. Rows that
    repeat the page_id that was kept for their payload are responses too. An empty table gives no records.
    """
    write(plan_records(pages, id_col, url_col, payload_col, least), path)


def replay(spark: SparkSession, path: str) -> DataFrame:
    """What was read back, one row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, intact.

    Size and digest are those of the full payload; a revisit takes them from the record that it refers to.
    """
    records = settle(
        read(spark, path).select(
            "page_id", "url", "record_type", "refers_to", "intact", F.octet_length("payload").cast("long").alias("bytes"), "digest", sha1_base32(F.col("payload").cast("binary")).alias("own")
        ),
        "warc-read",
    )
    kept = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), F.col("digest")).agg(F.first("bytes").alias("_bytes"), F.first("own").alias("_own"))
    full = records.where("record_type = 'revisit'").join(kept, ["refers_to", "digest"], "left")
    own = records.where("record_type = 'response'")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"]
    return own.withColumns({"payload_bytes": F.col("bytes"), "payload_digest": F.col("own")}).select(columns).union(
        full.withColumns({"payload_bytes": F.col("_bytes"), "payload_digest": F.col("_own")}).select(columns)
    )
