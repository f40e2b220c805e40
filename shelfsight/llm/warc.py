"""Pages written as WARC archives, and archives read by verifying the chain of their records.

The version line that opens a record may also stand in a payload, so a place that has it is only a candidate. Files
are cut at every such line, whatever it is part of, by as many tasks as they have splits; each piece knows its length,
and if it starts like a record, the length that the record claims. Prefix sums over pieces and splits turn lengths
into offsets, and each candidate into a pair of its own offset and its successor's. Pointer jumping from offset 0 of each
file then keeps the candidates that a reader who follows the lengths would meet, and no others.

Archives are plain text files to Spark, whose line separator is what ends a record on writing and what opens one on
reading, so any file system that Spark reaches will do. They are not compressed: a compressed file is one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.common import join_counted
from shelfsight.staging import stage

# Fixed values of the format.
VERSION = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Payloads below so many bytes are stored each time.
REVISIT_BYTES = 1000
#: Records of one written file at most; a file's offsets are added up in one task.
FILE_RECORDS = 1_000_000
#: Bytes of a range by which pieces find the record around them.
_RANGE_BITS = 20


def _bytes(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def _winners(pages: DataFrame) -> DataFrame:
    """``_same``, the digest of payloads that several pages have, and ``_holder``, the largest of their ids."""
    sized = pages.where(F.octet_length("_payload") >= REVISIT_BYTES)
    groups = sized.groupBy("_same").agg(F.max("page_id").alias("_holder"), F.count("*").alias("_copies"))
    return stage(groups.where("_copies > 1 AND _holder IS NOT NULL").drop("_copies"), "warc-holders")


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for each row of ``pages`` (``page_id``, ``url``, ``html``) below ``path``.

    Of pages of one payload of ``REVISIT_BYTES`` bytes or more, the one with the largest id gets a response record and
    the others a revisit record, which names it and has no payload. Rows that share this largest id are all
    responses. A null ``html`` is an empty payload, a null ``url`` is left out, a row without an id is named ``none`` and is
    never the one that others name. An empty table writes no record. Other columns are not read.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("_payload"))
    rows = rows.withColumn("_same", F.sha2("_payload", 256))
    # Only what several pages have is joined, and the payloads move only if those are too many for a broadcast.
    rows = join_counted(rows, _winners(rows), "_same", F.col("page_id"))
    again = F.col("_holder").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("_holder")))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", _bytes(F.col("_payload")).cast("string")), F.lit("\r\n"),
    )
    named = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    kept = F.when(again, F.lit(b"")).otherwise(F.col("_payload"))
    header = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), named, F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("_payload"))),
        F.when(again, F.concat(
            line("WARC-Profile", F.lit(PROFILE)),
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("_holder").cast("string"), F.lit(">"))),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (_bytes(http) + _bytes(kept)).cast("string")),
        F.lit("\r\n"),
    )
    record = F.concat(header.cast("binary"), http.cast("binary"), kept).cast("string")
    writer = rows.select(record.alias("value")).write.option("lineSep", END)
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)


def _field(header: Column, name: str) -> Column:
    """The value of a header field, in whatever case its name is, or null."""
    found = F.regexp_extract(header, rf"(?i)(?:^|\n){name}:[ \t]*([^\r\n]*?)[ \t]*(?:\r\n|$)", 1)
    return F.when(found != "", found)


def _number(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]{1,18}$"), text).cast("long")


def _payload(block: Column) -> Column:
    """What follows the HTTP header of a block; the block itself if it has none."""
    at = F.locate(END, block.cast("string"))
    return F.when(at > 0, F.substring(block, at + 4, F.octet_length(block))).otherwise(block)


def _pieces(
    spark: SparkSession, path: str, keep: Callable[[Column, Column], Column], files: DataFrame | None = None
) -> DataFrame:
    """The stored pieces between version lines: where they are, and what the record claims that would start there.

    ``size`` is the piece's length, ``claimed`` the length of its record after the version line. ``body`` is kept only
    where ``keep(size, claimed)`` holds.
    """
    text = F.col("value")
    end = F.locate(END, text)
    raw = spark.read.option("lineSep", VERSION).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"), "value", _bytes(text).alias("size"),
        F.when(end > 0, F.substring(text, F.lit(1), end - 1)).alias("header"),
    )
    if files is not None:
        raw = raw.join(files, "file", "left_semi")
    length = _number(_field(F.col("header"), "Content-Length"))
    head = _bytes(F.col("header")) + len(END)
    raw = raw.withColumn("length", length).withColumn("claimed", head + F.col("length") + len(END))
    whole = F.col("claimed") == F.col("size")
    body = F.col("value").cast("binary")
    block = F.when(whole, F.substring(body, (head + 1).cast("int"), F.col("length").cast("int")))
    record = raw.withColumn("block", block).select(
        "file", "split", "place", "size", "length", "claimed", head.alias("head"),
        F.lower(_field(F.col("header"), "WARC-Type")).alias("kind"),
        _field(F.col("header"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("header"), "WARC-Refers-To").alias("refers_to_id"),
        F.lower(F.regexp_replace(_field(F.col("header"), "WARC-Payload-Digest"), "^[^:]*:", "")).alias("declared"),
        _number(_field(F.col("block").cast("string"), "Content-Length")).alias("http_length"),
        _bytes(_payload(F.col("block"))).alias("payload_bytes"), F.sha1(_payload(F.col("block"))).alias("sha1"),
        F.when(keep(F.col("size"), F.col("claimed")), body).alias("body"),
    )
    return stage(record, "warc-pieces")


def _candidates(pieces: DataFrame) -> DataFrame:
    """Pieces with the offset ``at`` of the version line before them and that of their record's successor, ``next``.

    Splits are summed up on their own first; the piece before a file's first version line has no ``at``.
    """
    step = F.col("size") + len(VERSION)
    narrow = pieces.select("file", "split", "place", step.alias("step"), "claimed")
    within = F.expr("sum(step) OVER (PARTITION BY file, split ORDER BY place) - step")
    splits = narrow.groupBy("file", "split").agg(F.sum("step").alias("bytes"))
    base = splits.select("file", "split", F.expr("sum(bytes) OVER (PARTITION BY file ORDER BY split) - bytes").alias("base"))
    placed = narrow.withColumn("within", within).join(base, ["file", "split"])
    at = F.col("base") + F.col("within") - len(VERSION)
    return stage(placed.select(
        "file", "split", "place", at.alias("at"), (at + len(VERSION) + F.col("claimed")).alias("next"),
    ).where("at >= 0"), "warc-candidates")


def reachable(candidates: DataFrame) -> DataFrame:
    """The ``(file, at)`` of the candidates that the chain from offset 0 of their file meets.

    Each round doubles the length of all jumps and follows them once from what is reached so far, so a file of n
    records takes about log2(n) rounds. A jump to a place without a candidate ends there: at the end of the file, or in
    a damaged record, which is itself still met.
    """
    links = candidates.select("file", "at", "next")
    jumps = links.where(F.col("next") > F.col("at"))
    reached = [stage(links.where("at = 0").select("file", "at"), "warc-reached")]
    while True:
        known = reached[0]
        for more in reached[1:]:
            known = known.union(more)
        targets = known.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
        fresh = stage(targets.join(links, ["file", "at"], "left_semi"), "warc-reached")
        if fresh.isEmpty():
            return known
        reached.append(fresh)
        further = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        jumps = stage(
            jumps.join(further, ["file", "next"]).select("file", "at", F.col("after").alias("next")), "warc-jumps"
        )


def _between(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """For each record the candidates from its start to before its end, as ``(file, at, inner, split, place)``."""
    def ranges(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.shiftright(low, _RANGE_BITS), F.shiftright(high, _RANGE_BITS)))
    spans = records.select("file", "at", "next", ranges(F.col("at"), F.col("next") - 1).alias("range"))
    inner = candidates.select(
        "file", F.col("at").alias("inner"), "split", "place", F.shiftright("at", _RANGE_BITS).alias("range")
    )
    joined = spans.join(inner, ["file", "range"])
    return joined.where((F.col("inner") >= F.col("at")) & (F.col("inner") < F.col("next"))).drop("range", "next")


def _cut_payloads(spark: SparkSession, path: str, records: DataFrame, pieces: DataFrame, candidates: DataFrame) -> DataFrame:
    """Length and digest of the payloads that contain version lines, put together from their pieces."""
    inside = stage(_between(records, candidates), "warc-inside")
    bodies = inside.join(pieces.select("file", "split", "place", "body"), ["file", "split", "place"])
    if not bodies.where("body IS NULL").isEmpty():
        # Some piece is a whole record of its own, whose bytes were not kept: read these files once more with all of them.
        again = _pieces(spark, path, lambda size, claimed: F.lit(True), inside.select("file").distinct())
        bodies = _between(records, _candidates(again)).join(
            again.select("file", "split", "place", "body"), ["file", "split", "place"]
        )
    parts = bodies.groupBy("file", "at").agg(F.array_sort(F.collect_list(F.struct("inner", "body"))).alias("parts"))
    # The version lines between the pieces belong to the payload; the first one opens the record.
    text = F.aggregate(
        F.slice("parts", 2, F.size("parts")), F.element_at("parts", 1)["body"],
        lambda done, part: F.concat(done, F.lit(VERSION.encode()), part["body"]),
    )
    whole = records.select("file", "at", "head", "length").join(parts, ["file", "at"])
    block = F.substring(text, (F.col("head") + 1).cast("int"), F.col("length").cast("int"))
    return whole.select("file", "at", block.alias("block")).select(
        "file", "at", _bytes(_payload(F.col("block"))).alias("cut_bytes"), F.sha1(_payload(F.col("block"))).alias("cut_sha1"),
        _number(_field(F.col("block").cast("string"), "Content-Length")).alias("cut_http_length"),
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``: ``file``, ``at`` (offset), ``kind``, ``record_id``, ``refers_to_id``, ``payload_bytes``,
    ``payload_digest`` (SHA-1, hex), ``declared`` (the digest in the header) and ``complete``.

    A revisit has the length and digest of the payload it stands for, as its headers give them. A record that its
    file ends within is there with ``complete`` false and no digest of its own; nothing after it is. A folder
    without records gives no rows.
    """
    pieces = _pieces(spark, path, lambda size, claimed: claimed > size)
    candidates = _candidates(pieces)
    met = candidates.join(reachable(candidates), ["file", "at"], "left_semi")
    records = stage(met.join(pieces.drop("body"), ["file", "split", "place"]).drop("split", "place"), "warc-records")
    ends = pieces.groupBy("file").agg((F.sum(F.col("size") + len(VERSION)) - len(VERSION)).alias("file_bytes"))
    cut = records.where(F.col("claimed") > F.col("size")).join(ends, "file").where("next <= file_bytes")
    cut = stage(_cut_payloads(spark, path, cut, pieces, candidates), "warc-cut")
    joined = records.join(cut, ["file", "at"], "left")
    revisit = F.col("kind") == "revisit"
    read_bytes, read_sha1 = F.coalesce("payload_bytes", "cut_bytes"), F.coalesce("sha1", "cut_sha1")
    told = F.coalesce("http_length", "cut_http_length")
    return joined.select(
        "file", "at", "kind", "record_id", "refers_to_id",
        F.when(revisit, told).otherwise(read_bytes).alias("payload_bytes"),
        F.when(revisit, F.col("declared")).otherwise(read_sha1).alias("payload_digest"),
        "declared", read_sha1.isNotNull().alias("complete"),
    )


def page_records(records: DataFrame) -> DataFrame:
    """Records of ``write_warc`` with the ids of their pages: ``page_id``, ``record_type`` and ``refers_to`` beside the rest."""
    def page(name: str) -> Column:
        return F.regexp_extract(name, r"^<urn:page:(-?[0-9]+)>$", 1)
    def known(text: Column) -> Column:
        return F.when(text != "", text).cast("long")
    return records.select(
        known(page("record_id")).alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        known(page("refers_to_id")).alias("refers_to"), F.coalesce(F.col("payload_digest") == F.col("declared"), F.lit(False)).alias("intact"),
    )
