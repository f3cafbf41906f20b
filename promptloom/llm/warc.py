"""WARC archives: writing with revisit records, and reading by boundary-chain verification."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, run_path

MAGIC = "WARC/1.0\r\n"
#: What records of versions 1.0 and 1.1 begin with; archives are cut there when read.
SEPARATOR = "WARC/1."
BREAK = "\r\n\r\n"
#: Payloads below this size are stored whole each time.
MIN_REVISIT_BYTES = 100


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
    min_revisit: int = MIN_REVISIT_BYTES,
) -> None:
    """One WARC record per row, in splittable files under ``path``, written by Spark's text sink.

    Of rows with equal payloads of at least ``min_revisit`` bytes, those of the smallest id are
    responses; the others become revisit records, which carry the digest and the id they refer to
    but no payload. Digests are grouped before anything is shuffled; payloads are shuffled only
    where the repeated digests don't fit a broadcast. Null payloads are empty; null ids are empty
    ids and never the smallest; white space in a URI is written as ``%20``.
    """
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("order"), F.col(uri_col).alias("uri"),
        payload.alias("payload"), F.octet_length(payload).alias("bytes"), F.sha2(payload, 256).alias("digest"),
    )
    repeated = materialize(
        rows.where(F.col("bytes") >= min_revisit)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("order").alias("first"))
        .where("n > 1 and first is not null")
        .select("digest", "first"),
        "repeated",
    )
    marked = rows.join(repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("order").eqNullSafe(F.col("first"))
    lines = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce("id", F.lit("")), F.lit(">\r\nWARC-Date: 1970-01-01T00:00:00Z"),
        F.lit("\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce("uri", F.lit("")), r"[\x00-\x20]", "%20"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.when(revisit, 0).otherwise(F.col("bytes")).cast("string"),
        F.lit(BREAK), F.when(revisit, "").otherwise(F.col("payload")),
    )
    marked.select(lines.alias("value")).write.option("lineSep", BREAK).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, seq, value``: the bytes between magics, in file order by (block, seq)."""
    return spark.read.option("lineSep", SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*$", 1), F.lit(""))


def _with_offsets(rows: DataFrame) -> DataFrame:
    """Adds ``at``, the offset of the magic before each piece, and ``size`` of the file.

    Pieces and magics tile a file, so offsets are running sums: inside each input split, plus the
    sums of the splits before. No window is larger than a split.
    """
    length = F.col("piece_bytes") + F.lit(len(SEPARATOR))
    blocks = rows.groupBy("file", "block").agg(F.sum(length).alias("block_bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    blocks = blocks.select(
        "file", "block", F.coalesce(F.sum("block_bytes").over(before), F.lit(0)).alias("base"),
        (F.sum("block_bytes").over(whole) - len(SEPARATOR)).alias("size"),
    )
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("inside", F.coalesce(F.sum(length).over(inside), F.lit(0)))
    return within.join(blocks, ["file", "block"]).withColumn(
        "at", F.col("base") + F.col("inside") - len(SEPARATOR)
    ).drop("base", "inside")


def reachable(candidates: DataFrame) -> DataFrame:
    """The rows of ``file, at, next`` that a chain of successors reaches from offset 0 of their file.

    Pointer jumping: every round doubles the length of all jumps and adds to the reached rows what
    they jump to, so a file of n candidates takes log2(n) rounds, each of two equi-joins on offsets.
    Every round is written as a table.
    """
    most = candidates.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    state = materialize(
        candidates.select("file", "at", F.col("next").alias("jump"), (F.col("at") == 0).alias("reached")), "chain"
    )
    for _ in range(math.ceil(math.log2(most)) if most > 1 else 0):
        further = state.select("file", F.col("at").alias("jump"), F.col("jump").alias("jump2"))
        marks = state.where("reached and jump is not null").select("file", F.col("jump").alias("at"), F.lit(True).alias("mark"))
        state = materialize(
            state.join(further, ["file", "jump"], "left")
            .join(marks, ["file", "at"], "left")
            .select("file", "at", F.col("jump2").alias("jump"), (F.col("reached") | F.coalesce("mark", F.lit(False))).alias("reached")),
            "chain",
        )
    return state.where("reached").select("file", "at")


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """``file, at, record_type, record_id, uri, refers_to, stated_digest, payload_bytes, payload_digest``.

    One row per record of the archives under ``path``. Every magic in any input split is a candidate with
    the successor that its Content-Length gives; only candidates on the chain from the start of
    their file are records, so magics and whole records inside payloads are rejected. ``payload``
    adds the bytes. A record cut off by the end of its file is left out; a damaged chain ends there.
    Digests are computed while the archive is scanned; payloads are shuffled only for records that
    hold a magic themselves, which are put together from their pieces in a second scan. Versions 1.0 and 1.1 are
    read, and lengths of any number of digits; a folder of empty files gives no rows.
    """
    raw = F.col("value").cast("binary")
    head = F.substring_index("value", BREAK, 1)
    body_at = F.octet_length("head") + len(BREAK)
    body = F.substring(raw, body_at + 1, F.least("length", F.lit((1 << 31) - 1)).cast("int"))
    first = (
        _pieces(spark, path)
        .withColumn("head", F.when((F.instr("value", BREAK) > 0) & head.rlike(r"^[01]\r\n"), head))
        .withColumn("length", F.regexp_extract("head", r"(?im)^Content-Length:[ \t]*(\d+)[ \t]*$", 1).try_cast("long"))
        .withColumn("piece_bytes", F.octet_length("value").cast("long"))
        .withColumn("whole", F.col("piece_bytes") >= body_at + F.col("length"))
        .select(
            "file", "block", "seq", "piece_bytes", "whole",
            body_at.cast("long").alias("body_at"),
            F.col("length").cast("long").alias("payload_bytes"),
            _field("WARC-Type").alias("record_type"),
            _field("WARC-Record-ID").alias("record_id"),
            _field("WARC-Target-URI").alias("uri"),
            _field("WARC-Refers-To").alias("refers_to"),
            _field("WARC-Payload-Digest").alias("stated_digest"),
            F.when(F.col("whole"), F.sha2(body, 256)).alias("payload_digest"),
            *([F.when(F.col("whole"), body).alias("payload")] if payload else []),
        )
    )
    placed = materialize(_with_offsets(materialize(first, "pieces")), "placed")
    after = F.col("at") + len(SEPARATOR) + F.col("body_at") + F.col("payload_bytes")
    candidates = placed.where("at >= 0 and payload_bytes is not null").withColumn("end", after).where("end <= size")
    chain = reachable(candidates.select("file", "at", (F.col("end") + len(BREAK)).alias("next")))
    records = candidates.join(chain, ["file", "at"])
    out = ["file", "at", "record_type", "record_id", "uri", "refers_to", "stated_digest", "payload_bytes", "payload_digest"]
    out += ["payload"] * payload

    split = materialize(records.where("not whole"), "split-records")
    if split.isEmpty():
        return records.select(*out)
    files = split.select("file").distinct()
    again = materialize(_pieces(spark, path).join(files, "file", "left_semi"), "again")
    where = materialize(
        _with_offsets(again.select("file", "block", "seq", F.octet_length("value").cast("long").alias("piece_bytes"))),
        "where",
    )
    order = Window.partitionBy("file").orderBy("at")
    owners = (
        where.join(split.select("file", "at", F.col("at").alias("start"), "end"), ["file", "at"], "left")
        .withColumn("start", F.last("start", True).over(order))
        .withColumn("end", F.last("end", True).over(order))
        .where("at < end")
        .select("file", "block", "seq", "at", "start")
    )
    whole = (
        again.join(owners, ["file", "block", "seq"])
        .groupBy("file", F.col("start").alias("at"))
        .agg(F.array_sort(F.collect_list(F.struct(F.col("at").alias("o"), "value"))).alias("parts"))
        .select("file", "at", F.concat_ws(SEPARATOR, "parts.value").cast("binary").alias("raw"))
    )
    joined = split.drop("payload_digest", "payload").join(whole, ["file", "at"]).withColumn(
        "payload", F.substring("raw", (F.col("body_at") + 1).cast("int"), F.col("payload_bytes").cast("int"))
    )
    joined = joined.withColumn("payload_digest", F.sha2("payload", 256))
    return records.where("whole").select(*out).unionByName(joined.select(*out))


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``id, payload_bytes, payload_digest, record_type, refers_to`` of every page, read back from archives.

    Archives go to the shared folder. A revisit's size and digest are those of the response it
    refers to, if that response has the digest the revisit states (else null). An empty table gives an
    empty result; repeated rows are records of their own.
    """
    spark = pages.sparkSession
    path = run_path(spark, "warc")
    write_archives(pages, path, id_col, uri_col, payload_col)
    id_type = pages.schema[id_col].dataType
    records = materialize(
        read_archives(spark, path).select(
            F.regexp_extract("record_id", r"^<urn:page:(.*)>$", 1).try_cast(id_type).alias(id_col),
            "payload_bytes", "payload_digest", "record_type",
            F.regexp_extract(F.coalesce("refers_to", F.lit("")), r"^<urn:page:(.*)>$", 1).try_cast(id_type).alias("refers_to"),
            F.substring_index("stated_digest", ":", -1).alias("stated_digest"),
        ),
        "records",
    )
    stored = records.where("record_type = 'response'")
    targets = stored.groupBy(F.col(id_col).alias("refers_to"), F.col("payload_digest").alias("stated_digest")).agg(
        F.max("payload_bytes").alias("target_bytes")
    )
    revisits = records.where("record_type = 'revisit'").join(targets, ["refers_to", "stated_digest"], "left")
    columns = [id_col, "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return stored.select(*columns).unionByName(
        revisits.select(
            id_col, F.col("target_bytes").alias("payload_bytes"),
            F.when(F.col("target_bytes").isNotNull(), F.col("stated_digest")).alias("payload_digest"), "record_type", "refers_to",
        )
    )
