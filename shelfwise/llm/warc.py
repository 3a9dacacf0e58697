"""WARC archives: written record by record, read back by byte offsets.

Writing.  A page is a response record; a page with the payload of another is a
revisit record that names it.  A record ends with two line breaks, which is the
line separator of Spark's text writer, so an archive is a text file.

Reading.  Archives are cut into splits like any text file, at two line breaks:
every record header is then one row, whole, wherever the splits fall, and a
payload is the rows after it.  Sums of row sizes give each row its offset in
the file.

Boundary chains.  A payload may hold what looks like a header.  Each task
follows the Content-Length of every candidate of its split to the candidate's
successor, and on to the first offset beyond the split; it reports candidate
and exit.  Pointer jumping from the start of each file, doubling the jumps,
marks the candidates where the chain enters a split.  From there on the records
of a split follow one another; all other candidates are payload.  The chain
must end where the file ends, or the archive is reported as broken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Scratch, read
from shelfwise.llm.registry import query

#: Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
END = "\r\n\r\n"
# Formats of WARC 1.1 and HTTP, fixed values.
MAGIC = r"^(?:\r\n)?WARC/1\.[01]\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:x-page:"
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*([0-9]+)[ \t]*(?:\r\n|$)", re.IGNORECASE)


# --- writing


def revisits(df: DataFrame, scratch: Scratch, id_col: str, url_col: str, payload_col: str, least: int = REVISIT_BYTES) -> DataFrame:
    """(id, url, payload, revisit, refers_to) of every row of ``df``; a null payload is empty.

    Of rows with equal payloads of ``least`` bytes or more, those with the
    largest id are responses, the others revisit it (rows that repeat that id
    are all responses).  A null id is the largest only among nulls.  Payloads
    are told apart by sha256; those that occur twice are written, so that Spark
    knows how many there are before it joins them back.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    # Small payloads get keys that no sha256 equals, and that do not gather in one task.
    alone = F.hex(F.xxhash64("id", "url", "payload"))
    key = F.when(F.octet_length("payload") >= least, F.sha2(F.col("payload").cast("binary"), 256)).otherwise(alone)
    heads = rows.where(F.octet_length("payload") >= least).groupBy(key.alias("same")).agg(F.max("id").alias("head"), F.count(F.lit(1)).alias("n"))
    heads = scratch.table(heads.where("n > 1").select("same", "head"), "heads")
    joined = rows.withColumn("key", key).join(heads, F.col("key") == F.col("same"), "left")
    revisit = F.col("same").isNotNull() & ~F.col("head").eqNullSafe(F.col("id"))
    return joined.select("id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("head")).alias("refers_to"))


def _lines(*parts: tuple[str, Column | str]) -> Column:
    """Header lines ``name: value``; a null value has no line."""
    lines = [F.concat(F.lit(f"\r\n{name}: "), v if isinstance(v, Column) else F.lit(v)) for name, v in parts]
    return F.concat(*[F.coalesce(line, F.lit("")) for line in lines])


def record_text(revisit: Column, date: str = DATE) -> Column:
    """The WARC 1.1 record of a row of :func:`revisits`, without the two line breaks after it."""
    name = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(F.url_encode(c.cast("string")), F.lit("")), F.lit(">"))
    payload = F.col("payload")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK"),
        _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.octet_length(payload).cast("string"))),
        F.lit(END),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(payload))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = _lines(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", name(F.col("id"))),
        ("WARC-Target-URI", url),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(payload.cast("binary")))),
        ("WARC-Profile", F.when(revisit, PROFILE)),
        ("WARC-Refers-To", F.when(revisit, name(F.col("refers_to")))),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(F.lit("WARC/1.1"), head, F.lit(END), block)


def write_archives(
    df: DataFrame,
    path: str,
    scratch: Scratch,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = REVISIT_BYTES,
    date: str = DATE,
) -> None:
    """One record per row of ``df``, one archive per partition, below ``path``.

    The block of a response is an HTTP header and the payload in UTF-8 (null:
    empty); that of a revisit is the HTTP header alone, whose Content-Length
    and digest are still those of the whole payload.  Records are named by id,
    a null id by nothing; a null url has no Target-URI, line breaks in urls are
    percent-encoded.  An empty table has no archive with a record.
    """
    rows = revisits(df, scratch, id_col, url_col, payload_col, least)
    text = record_text(F.col("revisit"), date)
    rows.select(text.alias("value")).write.mode("overwrite").option("lineSep", END).text(path)


# --- reading


def _cut(batches: Iterator[pa.RecordBatch], extra: int) -> Iterator[tuple]:
    """(split, rows) with the rows of one split in a batch; a split's key is file and block, its rows the other columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column("file").dictionary_encode()
        file = names.indices.to_numpy(zero_copy_only=False)
        block = batch.column("block").to_numpy(zero_copy_only=False)
        new = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        for lo, hi in zip([0, *new], [*new, len(file)], strict=True):
            yield (names.dictionary[int(file[lo])].as_py(), int(block[lo])), [c.slice(lo, hi - lo) for c in batch.columns[extra:]]


def _content_length(head: bytes) -> int | None:
    found = _LENGTH.search(head)
    return int(found[1]) if found and len(found[1]) < 19 else None


def exits(candidates: list[tuple[int, int, int | None]], size: int) -> list[tuple]:
    """(at, exit, last_at, last_start, last_stop) of each candidate (at, start, length) of a split of ``size`` bytes.

    The exit is the first offset at or beyond the split's end that the chain
    from the candidate leads to, ``last`` the record it leaves the split with;
    all null where the chain meets no candidate.  Offsets count from the split.
    No record begins in the last four bytes; the last row of a file may count
    four bytes too many.
    """
    known: dict[int, tuple] = {}
    for at, start, length in sorted(candidates, reverse=True):
        if length is None:
            known[at] = (None,) * 4
        elif (following := start + length + len(END)) >= size - len(END):
            known[at] = (following, at, start, start + length)
        else:
            known[at] = known.get(following, (None,) * 4)
    return [(at, *known[at]) for at in sorted(known)]


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, file_size, size, head) in the scan's order to a row per candidate and one (bytes) per split."""
    names = ["file", "block", "file_size", "bytes", "at", "exit", "last_at", "last_start", "last_stop"]
    split, file_size, offset, found = None, 0, 0, []

    def done() -> pa.RecordBatch:
        rows = [(*split, file_size, offset, *[None] * 5), *[(*split, file_size, None, *row) for row in exits(found, offset)]]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *[pa.array(c, pa.int64()) for c in columns[1:]]], names)

    for key, (total, size, head) in _cut(batches, 2):
        if key != split:
            if split is not None:
                yield done()
            split, file_size, offset, found = key, total[0].as_py(), 0, []
        for n, text in zip(size.to_pylist(), head.to_pylist(), strict=True):
            if text is not None:
                skip = 2 if text.startswith(b"\r\n") else 0
                length = _content_length(text)
                found.append((offset + skip, offset + len(text) + len(END), length))
            offset += n
    if split is not None:
        yield done()


def _walk(partial: bool):
    """mapInArrow function: rows of splits, in order, to the records in them.

    Reads (file, block, part, base, due, open_at, open_stop): the split's first
    offset, the record that begins first in it, and the one that goes on in it.
    Gives (file, at, head, offset, bytes): whole records, or, if ``partial``,
    the pieces of those that lie in several splits, of which only the first has
    the header.
    """
    names = ["file", "at", "head", "offset", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        split = due = record = None
        at = 0

        def put(whole: bool) -> None:
            nonlocal held
            if whole != partial:
                data = b"".join(record["pieces"])
                out.append((split[0], record["at"], record["head"], record["from"], data))
                held += len(data)

        def batch_of(rows: list) -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for key, (parts, base, first, open_at, open_stop) in _cut(batches, 2):
            if key != split:
                if record is not None:
                    put(False)
                split, at, due, record = key, base[0].as_py(), first[0].as_py(), None
                if open_at[0].as_py() is not None and open_stop[0].as_py() > at:
                    record = {"at": open_at[0].as_py(), "stop": open_stop[0].as_py(), "head": None, "from": at, "pieces": []}
            for part in parts.to_pylist():
                size = len(part) + len(END)
                if record is not None:
                    record["pieces"].append((part + END.encode())[: record["stop"] - at])
                elif due is not None and at <= due < at + size:
                    head = part[due - at :]
                    start = due + len(head) + len(END)
                    record = {"at": due, "stop": start + _content_length(head), "head": head, "from": start, "pieces": []}
                at += size
                if record is not None and at >= record["stop"]:
                    put(record["head"] is not None)
                    due, record = record["stop"] + len(END), None
                if len(out) >= 512 or held > 1 << 22:
                    yield batch_of(out)
                    out, held = [], 0
        if record is not None:
            put(False)
        if out:
            yield batch_of(out)

    return run


def _lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, file_size, value): the archives cut at two line breaks, with the split that each row was read in."""
    lines = spark.read.option("lineSep", END).text(path)
    meta = {"file": "file_path", "block": "file_block_start", "file_size": "file_size"}
    return lines.select(*[F.col(f"_metadata.{name}").alias(alias) for alias, name in meta.items()], "value")


def reached(links: DataFrame, scratch: Scratch, rounds: int = 64) -> DataFrame:
    """(file, at) of the rows of ``links`` (file, at, next) on the chain from each file's start.

    Pointer jumping: after round k the first 2 ** k records of every chain are
    known and every jump is 2 ** k records long, so rounds grow with the
    logarithm of an archive's records.  Offsets only grow along a chain.
    """
    to = links.select("file", F.col("at").alias("next"))
    jumps = scratch.table(links.where("next > at").join(to, ["file", "next"]).select("file", "at", F.col("next").alias("to")), "jumps0")
    known = scratch.table(links.where("at = 0").select("file", "at"), "reached0")
    for n in range(1, rounds):
        new = known.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        new = scratch.table(new, f"reached{n}")
        if new.isEmpty():
            return known
        known = known.union(new)
        onward = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jumps = scratch.table(jumps.join(onward, ["file", "to"]).select("file", "at", F.col("far").alias("to")), f"jumps{n}")
        scratch.drop(f"jumps{n - 1}")
    raise RuntimeError(f"chains did not end in {rounds} rounds")


def splits_of(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """(file, block, base, due, open_at, open_stop) of every split of the archives below ``path``.

    ``due`` is where the first record of the split begins, ``open`` the record
    that an earlier split leaves with.  Fails if the records of an archive do
    not end at its last byte.
    """
    lines = _lines_of(spark, path)
    head = F.when(F.col("value").rlike(MAGIC), F.col("value").cast("binary"))
    size = (F.octet_length("value") + len(END)).cast("long")
    long = [T.StructField(n, T.LongType()) for n in ("block", "file_size", "bytes", "at", "exit", "last_at", "last_start", "last_stop")]
    marks = lines.select("file", "block", "file_size", size.alias("size"), head.alias("head"))
    marks = scratch.table(marks.mapInArrow(_mark, T.StructType([T.StructField("file", T.StringType()), *long])), "marks")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = marks.where("bytes IS NOT NULL").select(
        "file", "block", "file_size", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")
    )
    splits = scratch.table(splits, "bases")
    found = marks.where("bytes IS NULL").drop("file_size", "bytes", "last_start").join(splits, ["file", "block"])
    found = found.select("file", "block", *[(F.col("base") + F.col(c)).alias(c) for c in ("at", "exit", "last_at", "last_stop")])
    found = scratch.table(found, "candidates")
    entered = reached(found.select("file", "at", F.col("exit").alias("next")), scratch)
    entered = scratch.table(found.join(entered, ["file", "at"]), "entered")
    ends = entered.groupBy("file").agg(F.max("exit").alias("end"), F.count(F.when(F.col("exit").isNull(), 1)).alias("lost"))
    files = splits.groupBy("file").agg(F.max("file_size").alias("file_size")).join(ends, "file", "left")
    broken = files.where(~F.col("end").eqNullSafe(F.col("file_size")) | (F.col("lost") > 0)).limit(3).collect()
    if broken:
        raise ValueError(f"archives whose records do not end at their last byte: {[tuple(r) for r in broken]}")
    last = lambda c: F.last(c, ignorenulls=True).over(before)
    joined = splits.join(entered.select("file", "block", F.col("at").alias("due"), "last_at", "last_stop"), ["file", "block"], "left")
    joined = joined.select("file", "block", "base", "due", last("last_at").alias("open_at"), last("last_stop").alias("open_stop"))
    return scratch.table(joined, "splits")


#: Splits whose few numbers are broadcast (about 15 MB); with more of them the rows are shuffled by split.
BROADCAST_SPLITS = 100_000


def read_archives(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """(file, at, record_type, record_id, refers_to, url, digest, http, payload) of every record below ``path``.

    ``digest`` is the header's, ``payload`` the block, for HTTP messages
    without their header, which is ``http``.  Records are put together in the
    task that reads them; only those across the border of two splits are
    shuffled.  Archives are uncompressed.
    """
    splits = splits_of(spark, path, scratch)
    few = splits.count() <= BROADCAST_SPLITS
    kind = "file string, at long, head binary, offset long, bytes binary"

    def walked(partial: bool) -> DataFrame:
        lines = _lines_of(spark, path).select("file", "block", F.col("value").cast("binary").alias("part"), F.monotonically_increasing_id().alias("_row"))
        if few:  # a broadcast join keeps the order of the scan
            rows = lines.join(F.broadcast(splits), ["file", "block"])
        else:
            rows = lines.join(splits, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "_row")
        return rows.select("file", "block", "part", "base", "due", "open_at", "open_stop").mapInArrow(_walk(partial), kind)

    pieces = walked(True).groupBy("file", "at").agg(
        F.max("head").alias("head"), F.array_sort(F.collect_list(F.struct("offset", "bytes"))).alias("pieces")
    )
    joined = F.array_join(F.transform("pieces", lambda p: p["bytes"].cast("string")), "").cast("binary")
    blocks = walked(False).select("file", "at", "head", F.col("bytes").alias("block"))
    blocks = blocks.union(pieces.select("file", "at", "head", joined)).withColumn("head", F.col("head").cast("string"))
    is_http = F.coalesce(_field(F.col("head"), "Content-Type"), F.lit("")).startswith("application/http")
    blocks = blocks.withColumn("http", F.when(is_http, F.substring_index(F.col("block").cast("string"), END, 1)))
    skip = F.coalesce(F.octet_length("http") + len(END), F.lit(0))
    return blocks.select(
        "file",
        "at",
        _field(F.col("head"), "WARC-Type").alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        _field(F.col("head"), "WARC-Target-URI").alias("url"),
        _field(F.col("head"), "WARC-Payload-Digest").alias("digest"),
        "http",
        F.substring(F.col("block"), skip + 1, F.greatest(F.octet_length("block") - skip, F.lit(0))).alias("payload"),
    )


def _field(head: Column, name: str) -> Column:
    """Value of a header line, null if there is none."""
    return F.nullif(F.regexp_extract(head, rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def id_of(name: Column, kind: str) -> Column:
    """The id in a record's name."""
    return F.nullif(F.url_decode(F.regexp_extract(name, rf"^<{_ID}(.*)>$", 1)), F.lit("")).cast(kind)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS head FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND head IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND head IS DISTINCT FROM page_id THEN head END AS refers_to
FROM k
"""


@query("op13_warc_boundary_chains", SQL)
def op13_warc_boundary_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back; what a revisit stands for is in its headers."""
    scratch = Scratch(spark, "warc")
    pages = read(spark, sf_dir, "pages")
    write_archives(pages, f"{scratch.root}/archives", scratch)
    back = read_archives(spark, f"{scratch.root}/archives", scratch)
    kind = pages.schema["page_id"].dataType.simpleString()
    stored = F.col("record_type") == "response"
    full = _field(F.col("http"), "Content-Length").cast("long")
    return back.select(
        id_of(F.col("record_id"), kind).alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long")).otherwise(full).alias("payload_bytes"),
        F.when(stored, F.sha1("payload")).otherwise(F.replace("digest", F.lit("sha1:"), F.lit(""))).alias("payload_digest"),
        "record_type",
        id_of(F.col("refers_to"), kind).alias("refers_to"),
    )
