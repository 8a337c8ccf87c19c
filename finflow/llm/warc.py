"""WARC archives: writing with revisits, and reading by boundary-chain verification.

*Writing.* One record per page. Among records of equal payloads of at least
``LEAST_REVISIT`` bytes the one with the largest page id carries the payload;
the others are revisits of it. Records are lines of Spark's text writer with the
record separator as line end, so archives go to any store Spark can write.

*Reading.* Archives are read as lines ended by the separator, so a large file
is split among tasks anywhere. The place of a line is the sum of the sizes
before it: inside its split, and over the splits before. Every header-like text
after a separator is a *candidate*, and its ``Content-Length`` says where the next
record must begin. From offset 0 of each file, pointer jumping over these links (each
round doubles their reach) keeps exactly the candidates on the chain; header-like
text inside a payload is on no chain and is dropped. A record always follows a
separator, so a line holds one candidate at most, however often it repeats the magic.

Only offsets, sizes and digests are shuffled. Payload bytes are looked at where
they are read; a payload that itself holds the separator spans several lines,
which are brought together by record.

Tables of marked rows (revisits; lines of such payloads) are broadcast if
they have few rows and joined by shuffle if not.

Edge cases. A null html is an empty payload, a null url no address. Pages equal
in id and payload are written each and are the same kind of record. A null page
id is never referred to; without any id in a group all its records carry the
payload. White space and control characters of an address are written as %20.
Further columns are ignored. Empty tables give empty archives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finflow.llm.store import dropped, small, stored

LEAST_REVISIT = 1000

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
BREAK = "\r\n\r\n"


def write_archives(
    pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip", file_records: int = 50_000
) -> None:
    """Write a record per page (``page_id``, ``url``, ``html``) into files below ``path``."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", payload.alias("payload"), F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    repeated = (
        rows.where(F.col("bytes") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and first is not null")
    )
    repeated = stored(repeated.select(F.col("digest").alias("_digest"), "first"), "revisits")
    same = (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= LEAST_REVISIT)
    rows = rows.join(small(repeated), same, "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda page: F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(">"))
    address = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit(MAGIC),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", urn(F.col("page_id"))),
        F.coalesce(field("WARC-Target-URI", address), F.lit("")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, field("WARC-Refers-To", urn(F.col("first")))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html\r\nContent-Length: "),
        F.when(revisit, F.lit(0).cast("long")).otherwise(F.col("bytes")).cast("string"),
    )
    record = F.concat(head, F.lit(BREAK), F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    (
        rows.select(record.alias("value")).write.option("lineSep", BREAK).option("compression", compression)
        .option("maxRecordsPerFile", file_records).text(path)
    )
    dropped(repeated)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, seq, value``: lines of all archives, in order inside each block of a file."""
    return spark.read.option("lineSep", BREAK).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def _placed(lines: DataFrame) -> DataFrame:
    """Adds ``place``, the offset in the file, to light rows with ``bytes``, the size of the line."""
    whole = F.col("bytes") + len(BREAK)
    blocks = lines.groupBy("file", "block").agg(F.sum(whole).alias("_size"))
    over = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_size").over(over), none).alias("_before"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (
        lines.withColumn("_own", F.coalesce(F.sum(whole).over(inside), none))
        .join(blocks, ["file", "block"])
        .withColumn("place", F.col("_before") + F.col("_own"))
        .drop("_own", "_before")
    )


def _head(value: Column) -> Column:
    """``skip, head`` if a header begins the line: the bytes before its magic and the text after it.

    Separators are cut from the left. Where a payload ends in a line end of its own,
    the cut comes two bytes early and the rest of the separator begins the line.
    """
    after = lambda skip: F.struct(
        F.lit(skip).cast("long").alias("skip"), F.substring(value, F.lit(skip + len(MAGIC) + 1), F.length(value)).alias("head")
    )
    begins = lambda skip: value.rlike(f"^(?:\r\n){{{skip // 2}}}WARC/1\\.0\r\n[A-Za-z0-9-]+:")
    return F.when(begins(0), after(0)).when(begins(2), after(2))


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1), F.lit(""))


def reachable(links: DataFrame) -> DataFrame:
    """Of ``links`` (``file, place, next``), the ``file, place`` on the chain from place 0 of each file."""
    jump = stored(links.select("file", "place", "next"), "links")
    reached = jump.where("place = 0").select("file", "place").distinct()
    reached = stored(reached, "reached")
    count = reached.count()
    while True:
        ahead = reached.join(jump, ["file", "place"]).select("file", F.col("next").alias("place"))
        known = links.select("file", "place")
        grown = stored(reached.unionByName(ahead.join(known, ["file", "place"], "left_semi")).distinct(), "reached")
        total = grown.count()
        if total == count:
            dropped(jump)
            dropped(reached)
            return grown
        then = jump.select("file", F.col("place").alias("next"), F.col("next").alias("_then"))
        further = stored(jump.join(then, ["file", "next"]).select("file", "place", F.col("_then").alias("next")), "links")
        dropped(jump)
        dropped(reached)
        jump, reached, count = further, grown, total


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of the archives below ``path``.

    ``file, place, type, id, uri, digest, refers_to`` from the header, and
    ``payload_bytes, payload_digest`` (SHA-1, hex) of the payload as read; with
    ``with_payload`` also its text.
    """
    lines = _lines(spark, path)
    light = lines.select(
        "file", "block", "seq",
        F.octet_length("value").cast("long").alias("bytes"),
        F.sha1(F.col("value").cast("binary")).alias("sha1"),
        _head(F.col("value")).alias("_h"),
    )
    light = stored(_placed(light), "lines")
    headers = (
        light.where("_h is not null")
        .select("file", (F.col("place") + F.col("_h.skip")).alias("place"), (F.col("place") + F.col("bytes") + len(BREAK)).alias("begin"), F.col("_h.head").alias("head"))
        .withColumn("length", _field("Content-Length").try_cast("bigint"))
        .where("length >= 0")
        .withColumn("next", F.col("begin") + F.col("length") + len(BREAK))
    )
    chain = reachable(headers.select("file", "place", "next"))
    records = headers.join(chain, ["file", "place"])
    records = stored(
        records.select(
            "file", "place", "begin", "length", _field("WARC-Type").alias("type"), _field("WARC-Record-ID").alias("id"),
            _field("WARC-Target-URI").alias("uri"), _field("WARC-Payload-Digest").alias("digest"),
            _field("WARC-Refers-To").alias("refers_to"),
        ),
        "records",
    )

    # A payload of one line is settled by that line's digest.
    one = light.select("file", F.col("place").alias("begin"), F.col("bytes").alias("length"), F.col("sha1").alias("payload_digest"))
    settled = records.join(one, ["file", "begin", "length"], "left")
    open_ = settled.where("payload_digest is null").select("file", "begin", "length")
    wanted = _lines_of(light, open_) if not with_payload else _lines_of(light, records.select("file", "begin", "length"))
    wanted = stored(wanted, "payloads")
    pieces = lines.join(small(wanted), ["file", "block", "seq"])
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda p: p["value"]), BREAK)
    # A payload may end inside the separator that ended its last line.
    whole = F.concat(joined, F.lit(BREAK)).cast("binary")
    texts = pieces.groupBy("file", "begin").agg(F.substring(whole, F.lit(1), F.first("length").cast("int")).alias("_raw"))
    texts = texts.withColumn("_sha1", F.sha1("_raw")).withColumn("payload", F.decode("_raw", "UTF-8"))
    out = settled.join(texts, ["file", "begin"], "left")
    columns = ["file", "place", "type", "id", "uri", "digest", "refers_to", F.col("length").alias("payload_bytes")]
    columns.append(F.coalesce("payload_digest", "_sha1").alias("payload_digest"))
    return out.select(*columns, *(["payload"] if with_payload else []))


def _lines_of(light: DataFrame, payloads: DataFrame) -> DataFrame:
    """``file, block, seq, place, begin, length``: the lines between ``begin`` and the end of each payload.

    Both sides are put in order of place, so a line finds the payload that began last before it.
    """
    marks = payloads.select("file", F.col("begin").alias("place"), "begin", "length")
    both = light.select("file", "place", "block", "seq").unionByName(
        marks.select("file", "place", F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("seq"), "begin", "length"),
        allowMissingColumns=True,
    )
    before = Window.partitionBy("file").orderBy("place", F.col("seq").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return (
        both.withColumn("begin", F.last("begin", ignorenulls=True).over(before))
        .withColumn("length", F.last("length", ignorenulls=True).over(before))
        .where("seq is not null and begin is not null and place <= begin + length")
        .select("file", "block", "seq", "place", "begin", "length")
    )


def page_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` with revisits resolved to their response."""
    page = lambda urn: F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
    rows = records.select(
        page("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )
    # Page ids may repeat; a revisit's own header has the digest that says which page it means.
    responses = rows.where("record_type = 'response' and page_id is not null").select(
        F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), "payload_digest"
    ).dropDuplicates(["refers_to", "payload_digest"])
    own = F.regexp_extract("digest", "^sha1:([0-9a-f]{40})$", 1)
    visits = records.where("type = 'revisit'").select(
        page("id").alias("page_id"), own.alias("payload_digest"), F.col("type").alias("record_type"), page("refers_to").alias("refers_to")
    )
    visits = visits.join(responses, ["refers_to", "payload_digest"], "left")
    return rows.where("record_type = 'response'").unionByName(visits.withColumnRenamed("_bytes", "payload_bytes"))
