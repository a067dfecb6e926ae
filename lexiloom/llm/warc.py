"""WARC archives: written as plain record files, read back along verified record chains."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lexiloom.llm.common import shared_dir, stage

VERSION = "WARC/1.1"
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records in an archive file at most.
FILE_RECORDS = 10_000
#: Header fields that are read.
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "url": "WARC-Target-URI",
    "digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "content_length": "Content-Length",
}
#: Those that come with a block.
BLOCK_FIELDS = ("record_type", "record_id", "url", "digest", "refers_to")


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight base-32 digits for each 40 bits, in the RFC 4648 alphabet."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def mark_revisits(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", payload_column: str = "html") -> DataFrame:
    """(id, url, payload, payload_bytes, payload_digest, record_type, refers_to) per row of ``pages``.

    Of records with equal payloads of at least ``least_bytes`` the one with the smallest id is the
    response and the others revisit it; smaller ones are all responses. A null payload is empty; of
    repeated rows with the smallest id each is a response; a row without an id is a revisit only if
    another has one. Digests that occur more than once are a stored table with one row each, so payloads are
    only shuffled if that table is too large to be broadcast by its size; adaptive execution then splits a
    payload with many copies.
    """
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(
        F.col(id_column).alias("id"), F.regexp_replace(url, r"[\x00-\x20\x7f]", "").alias("url"), payload.alias("payload")
    ).select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), payload_digest("payload").alias("payload_digest"))
    first = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes").agg(
        F.min("id").alias("first"), F.count("*").alias("n")
    )
    first = stage(first.where("n > 1").drop("n"), "copies")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return rows.join(first, ["payload_digest", "payload_bytes"], "left").select(
        "id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _record_id(column: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def write_warc(records: DataFrame, path: str, compression: str = "gzip", file_records: int = FILE_RECORDS, date: datetime | None = None) -> None:
    """Write the rows of :func:`mark_revisits` as WARC files; the text sink's line end closes a record.

    A response has the payload as its block; a revisit has an empty block and names its response. Every
    task writes its own rows, ``file_records`` per file, so nothing is shuffled. All records have the same
    ``date``, by default that of the call.
    """
    written = (date or datetime.now(UTC)).astimezone(UTC)
    revisit = F.col("record_type") == "revisit"
    length = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    lines = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: "), _record_id("id")),
        F.lit(f"WARC-Date: {written:%Y-%m-%dT%H:%M:%SZ}"),
        F.concat(F.lit("WARC-Target-URI: "), "url"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id("refers_to"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    head = F.concat_ws(END, *lines)  # absent fields are null and leave no line
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    value = F.concat(head, F.lit(END + END), block)
    writer = records.select(value.alias("value")).write.option("lineSep", END + END)
    writer.option("compression", compression).option("maxRecordsPerFile", file_records).text(path)


def _header(name: str, line: str = "line") -> Column:
    """Value of a header line, null for any other line."""
    found = F.regexp_extract(F.col(line), rf"^(?i:{name}):[ \t]*(.*?)[ \t]*\r?$", 1)
    return F.when(F.lower(F.substring(line, 1, len(name) + 1)) == f"{name.lower()}:", found)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, nr, size, line) of every line in the files below ``path``.

    Files are read in splits where their compression allows it. The line end is one byte, so cuts at any
    byte give the same lines; ``split`` and ``nr`` put the lines of a file in order.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("nr"),
        (F.octet_length("value") + 1).cast("long").alias("size"),
        F.col("value").alias("line"),
    )


def _offset() -> Column:
    """Byte offset of a line: the bytes of all lines before it in its file."""
    order = Window.partitionBy("file").orderBy("split", "nr").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("size").over(order), F.lit(0))


def chain_records(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of ``candidates`` (file, start, next, ...) that a chain from offset 0 of their file reaches.

    Pointer jumping: each round joins the jumps with themselves twice and the reached offsets with
    jumps of one, two and three times their length, so a file of n records takes about log4(n) rounds.
    What looks like a record inside a payload is reached by no chain. A chain that doesn't end at the
    end of its file (``files``: file, length) is an error.
    """
    jumps = candidates.select("file", F.col("start").alias("a"), F.col("next").alias("b"))
    ends = stage(files.where("length > 0"), "files")
    reached = ends.select("file", F.lit(0).cast("long").alias("start"))
    while not jumps.isEmpty():
        one = jumps.select("file", F.col("a").alias("b"), F.col("b").alias("b2"))
        two = jumps.join(one, ["file", "b"], "left").select("file", "a", "b", "b2")
        more = two.select("file", F.col("a").alias("b2"), F.col("b").alias("b3"), F.col("b2").alias("b4"))
        hops = stage(two.join(more, ["file", "b2"], "left").select("file", F.col("a").alias("start"), "b", "b2", "b3", "b4"), "hops")
        found = reached.join(hops, ["file", "start"]).select("file", F.explode(F.array("b", "b2", "b3")).alias("start"))
        reached = stage(reached.union(found.where("start is not null")).distinct(), "reached")
        jumps = hops.where("b4 is not null").select("file", F.col("start").alias("a"), F.col("b4").alias("b"))
    bad = ends.join(reached.withColumnRenamed("start", "length"), ["file", "length"], "left_anti").first()
    if bad:
        raise ValueError(f"records of {bad.file} don't lead to its end")
    return candidates.join(reached, ["file", "start"], "left_semi")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, record_type, record_id, url, digest, refers_to, block) of the records below ``path``.

    See :func:`find_records` and :func:`read_blocks`.
    """
    return read_blocks(spark, path, find_records(spark, path)).select("file", "start", *BLOCK_FIELDS, "block")


def find_records(spark: SparkSession, path: str) -> DataFrame:
    """Offsets and header fields of the records below ``path``, as a stored table.

    Every line that reads like a record's first line is a candidate; its header, up to the first
    empty line, gives the offset where its successor must begin. Only candidates on the chain from the
    start of the file are records. Blocks are then cut out by offset.

    Only lines that may belong to a header are moved.
    """
    lines = read_lines(spark, path)
    is_first = F.regexp_like("line", F.lit(r"^WARC/[0-9]+\.[0-9]+\r?$"))
    is_empty = F.col("line").isin("\r", "")
    named = F.regexp_like("line", F.lit("^(?i:" + "|".join(FIELDS.values()) + "):"))
    short = lines.select(
        "file", "split", "nr", "size", is_first.alias("first"), is_empty.alias("empty"), F.when(named, F.col("line")).alias("line")
    ).withColumn("at", _offset())
    order = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    owned = short.select("*", F.last(F.when(F.col("first"), F.col("at")), ignorenulls=True).over(order).alias("start"))

    def first_of(name: str) -> Column:
        value = _header(name)
        return F.min(F.when(value.isNotNull(), F.struct("at", value.alias("value"))))

    head = owned.groupBy("file", "start").agg(
        F.min(F.when(F.col("empty"), F.col("at") + F.col("size"))).alias("body"),
        F.max(F.col("at") + F.col("size")).alias("end"),
        *[first_of(v).alias(k) for k, v in FIELDS.items()],
    )
    head = stage(head, "heads")
    ends = head.groupBy("file").agg(F.max("end").alias("length"))
    in_head = [F.when(F.col(k)["at"] < F.col("body"), F.col(k)["value"]).alias(k) for k in FIELDS]
    length = F.col("content_length").try_cast("long")
    candidates = head.where("start is not null").select("file", "start", "body", *in_head)
    candidates = candidates.select("*", length.alias("length")).where("length >= 0")
    candidates = stage(candidates.withColumn("next", F.col("body") + F.col("length") + 4), "candidates")
    return stage(chain_records(candidates, ends), "records")


def read_blocks(spark: SparkSession, path: str, records: DataFrame, fields: tuple[str, ...] = BLOCK_FIELDS) -> DataFrame:
    """(file, start, ``fields``, block) of ``records``: all lines are moved once, together with the records' offsets.

    A line takes its record's fields along, so blocks are not moved again to find them. A file's lines are
    put in order by a sort that spills; no more than a record is held at once.
    """
    lines = read_lines(spark, path)
    starts = records.where("length > 0").select("file", F.struct("start", "body", "length", *fields).alias("own"))
    both = lines.unionByName(starts, allowMissingColumns=True)
    both = both.withColumn("at", F.coalesce(F.col("own.start"), _offset()))
    order = Window.partitionBy("file").orderBy("at", F.col("own").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.select("file", "at", "line", F.last("own", ignorenulls=True).over(order).alias("own"))
    inside = inside.where((F.col("at") >= F.col("own.body")) & (F.col("at") < F.col("own.body") + F.col("own.length")) & F.col("line").isNotNull())
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
    blocks = inside.groupBy("file", F.col("own.start").alias("start")).agg(F.first("own").alias("own"), whole.alias("text"))
    cut = F.substring(F.concat(F.col("text").cast("binary"), F.lit(b"\n")), F.lit(1), F.col("own.length").cast("int"))
    found = blocks.select("file", "start", *[F.col(f"own.{name}").alias(name) for name in fields], cut.cast("string").alias("block"))
    empty = records.where("length = 0").withColumn("block", F.lit(""))
    return found.unionByName(empty.select(*found.columns))


def round_trip(pages: DataFrame, least_bytes: int = 0, id_column: str = "page_id", payload_column: str = "html", **options) -> DataFrame:
    """Write ``pages`` as WARC files and read them back: id, payload, its size and digest, record_type, refers_to.

    A revisit gets its payload from the response it names. An empty table writes and gives no records.
    ``options`` go to :func:`write_warc`.
    """
    spark = pages.sparkSession
    path = shared_dir(spark, "warc")
    write_warc(mark_revisits(pages, least_bytes, id_column, payload_column), path, **options)
    records = find_records(spark, path)
    blocks = read_blocks(spark, path, records.where("record_type = 'response'"), ())
    return pages_of(records, blocks, pages.schema[id_column].dataType, id_column)


def pages_of(records: DataFrame, blocks: DataFrame, id_type: DataType, id_column: str = "page_id") -> DataFrame:
    """Pages of the ``records``, with the payload in ``blocks`` (file, start, block) that each has or revisits.

    A revisit takes the first response that has the id and the digest it names; without one it is an error.
    Sizes and digests are worked out before the join, so payloads are only moved where they are used.
    """

    def page(column: str) -> Column:
        return F.nullif(F.regexp_extract(column, "^<urn:page:(.*)>$", 1), F.lit("")).cast(id_type)

    place = F.struct("file", "start").alias("place")
    responses = records.where("record_type = 'response'").select("record_id", "record_type", "refers_to", "digest", place)
    first = responses.groupBy(F.col("record_id").alias("refers_to"), "digest").agg(F.min("place").alias("place"))
    revisits = records.where("record_type = 'revisit'").select("record_id", "record_type", "refers_to", "digest")
    members = responses.unionByName(revisits.join(first, ["refers_to", "digest"], "left"))
    members = members.select("*", "place.file", "place.start").drop("place")
    payloads = blocks.select(
        "file", "start", F.col("block").alias("payload"), F.octet_length("block").cast("long").alias("payload_bytes"), payload_digest("block").alias("found")
    )
    same = F.col("found") == F.regexp_replace("digest", "^sha1:", "")
    checked = F.when(same, F.col("found")).otherwise(F.raise_error(F.lit("a payload differs from its digest")))
    return members.join(payloads, ["file", "start"], "left").select(
        page("record_id").alias(id_column), "payload", "payload_bytes", checked.alias("payload_digest"), "record_type", page("refers_to").alias("refers_to")
    )
