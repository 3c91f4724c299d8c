"""WARC archives: writing, and reading by boundary-chain verification.

A reader that looks for record starts finds the magic ``WARC/1.0`` inside payloads too. So
tasks emit every magic they meet as a candidate with the offset at which its record would
end and the next begin. Only candidates on the chain from the file's start are
records: each block of a file first follows its own candidates to where they leave the
block, then pointer jumping over blocks finds where the true chain enters each, and the
blocks keep what lies on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import map_arrow, stored

MAGIC = "WARC/1.0\r\n"
#: Bytes of a file whose candidates are followed together.
BLOCK = 32 << 20
_PREFIX = "https://records.invalid/page/"


def revisits(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = 1000) -> DataFrame:
    """(page_id, payload, digest, bytes, refers_to): which records repeat which.

    Of the payloads of at least ``least`` bytes that are equal, that with the largest id
    is written in full; the others (null ids, and repeated rows of that id but one,
    included) refer to it. Copies add up before they are shuffled.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), payload.alias("payload")).withColumn(
        "digest", F.sha1("payload")).withColumn("bytes", F.octet_length("payload").cast("long"))
    large = F.col("bytes") >= least
    last = stored(rows.where(large).groupBy("digest").agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("times")).where("times > 1 and last is not null"),
        "payload-copies")
    met = rows.join(last.select("digest", "last"), "digest", "left")
    return met.select("page_id", "payload", "digest", "bytes", F.when(
        large & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def record_text(page_id, payload, digest, n_bytes, refers_to):
    """One record without its closing blank lines, as the text source writes it."""
    line = F.lit("\r\n")
    revisit = refers_to.isNotNull()
    body_bytes = F.when(revisit, F.lit(0)).otherwise(n_bytes)
    name = F.coalesce(page_id.cast("string"), F.lit("none"))
    return F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), line,
        F.lit(f"WARC-Target-URI: {_PREFIX}"), name, line,
        F.lit("WARC-Date: 2024-01-01T00:00:00Z"), line,
        F.lit("WARC-Record-ID: <urn:page:"), name, F.lit(">"), line,
        F.lit("WARC-Payload-Digest: sha1:"), digest, line,
        F.lit("X-Payload-Length: "), n_bytes.cast("string"), line,
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), line,
            F.lit("WARC-Refers-To: <urn:page:"), refers_to.cast("string"), F.lit(">"), line)).otherwise(F.lit("")),
        F.lit("Content-Type: text/html"), line,
        F.lit("Content-Length: "), body_bytes.cast("string"), line, line,
        F.when(revisit, F.lit("")).otherwise(payload.cast("string")))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", html: str = "html",
                   least: int = 1000) -> None:
    """A folder of .txt-named WARC files, one record per row; null payloads are empty.

    Spark's text source writes the bytes, so any file system Spark reaches will do, and a
    lost task's file is written again. Records end with two blank lines, its line end.
    """
    rows = revisits(pages, page_id, html, least)
    rows.select(record_text(*(F.col(c) for c in ("page_id", "payload", "digest", "bytes", "refers_to"))).alias(
        "value")).write.option("lineSep", "\r\n\r\n").text(path)


# ---------------------------------------------------------------- reading

def parse_header(head: bytes) -> tuple[int, dict[str, str]] | None:
    """Header length with its blank line, and its fields; None where it is no header.

    However long it is. A line that starts with a space or tab continues the field before it.
    """
    end = head.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields, last = {}, None
    for line in head[:end].split(b"\r\n"):
        if line[:1] in (b" ", b"\t"):
            if last is None:
                return None
            fields[last] = f"{fields[last]} {line.decode('latin-1').strip()}".strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        last = name.decode("latin-1").strip().lower()
        fields[last] = value.decode("latin-1").strip()
    if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
        return None
    return end + 4, fields


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, data): what stands between one magic and the next, in file order within a split.

    The magic serves as the line end of Spark's text source, so even one huge file
    is read by many tasks. A file's first row is what precedes its first magic.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("value").cast("binary").alias("data"))


def _places(batches: Iterator[pa.RecordBatch]):
    """(file, split, offset in the split, data as buffer) of every chunk of a task."""
    now, at = None, 0
    for batch in batches:
        for file, split, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            if (file, split) != now:
                now, at = (file, split), 0
            value = data.as_py()
            yield file, split, at, value
            at += len(value) + len(MAGIC)


def _rows(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def candidates(raw: DataFrame) -> DataFrame:
    """(file, split, at, size, reach): every chunk, its bytes, and how far beyond its start its record would end.

    ``reach`` is null where no header stands.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        rows = []
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["file", "split", "at", "size", "reach"]
        for file, split, at, data in _places(batches):
            got = parse_header(data)
            reach = got[0] + int(got[1]["content-length"]) + 4 if got else None
            rows.append((file, split, at, len(data) + len(MAGIC), reach))
            if len(rows) == 20_000:
                yield _rows(rows, kinds, names)
                rows = []
        yield _rows(rows, kinds, names)

    return map_arrow(raw, run, "file string, split long, at long, size long, reach long")


def _followed(offsets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each candidate of a block: the offset at which its chain leaves the block, and the last record before.

    Pointer jumping: every round doubles the stretch that is followed.
    """
    at = np.searchsorted(offsets, ends)
    inside = (at < len(offsets)) & (ends >= 0)
    inside &= offsets[np.minimum(at, len(offsets) - 1)] == ends
    jump = np.where(inside, at, np.arange(len(offsets)))
    while True:
        further = jump[jump]
        if (further == jump).all():
            return ends[jump], offsets[jump]
        jump = further


def _on_chain(offsets: np.ndarray, ends: np.ndarray, entry: int) -> np.ndarray:
    """Which candidates the chain from ``entry`` meets, by doubling the set that is known."""
    on = np.zeros(len(offsets) + 1, bool)
    on[:-1] = offsets == entry
    at = np.searchsorted(offsets, ends)
    inside = (at < len(offsets)) & (ends >= 0)
    inside &= offsets[np.minimum(at, len(offsets) - 1)] == ends
    jump = np.append(np.where(inside, at, len(offsets)), len(offsets))
    while True:
        new = on.copy()
        new[jump[on]] = True
        new[-1] = False
        if (new == on).all():
            return on[:-1]
        on, jump = new, jump[jump]


def chain(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """(file, split, at, offset, owner, end): for each chunk the record it belongs to, by its offset.

    ``end`` is where the chunk's own record would end, -1 where it has no header. A chunk whose owner is itself starts a record. Chunks that the chain from the file's
    start does not reach have no owner and are left out. Candidates of a block are
    gathered, at most one per ten bytes of it; everything between blocks is joins.
    """
    totals = found.groupBy("file", "split").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = found.join(bases, ["file", "split"]).withColumn(
        "offset", F.col("base") + F.col("at") - len(MAGIC)).where("offset >= 0")
    placed = stored(placed.select(
        "file", "split", "at", "offset", F.coalesce(F.col("offset") + len(MAGIC) + F.col("reach"), F.lit(-1)).alias("end"),
        F.floor(F.col("offset") / block).alias("block")), "warc-candidates")
    grouped = placed.select("file", "block", "offset", "end").repartition("file", "block").sortWithinPartitions(
        "file", "block", "offset")
    exits = stored(map_arrow(grouped, _by_block(_exits), "file string, offset long, exit long, last long"), "warc-exits")

    firsts = placed.select("file").distinct().select(
        "file", F.lit(0).cast("long").alias("offset"), F.lit(-1).cast("long").alias("owner"))
    reached = stored(firsts, "warc-reached")
    jump, count = exits.where("exit >= 0"), reached.count()
    while True:
        new = reached.join(jump, ["file", "offset"]).select("file", F.col("exit").alias("offset"), F.col("last").alias("owner"))
        reached = stored(reached.unionByName(new).groupBy("file", "offset").agg(F.max("owner").alias("owner")), "warc-reached")
        size = reached.count()
        if size == count:
            break
        count = size
        after = jump.select("file", F.col("offset").alias("exit"), F.col("exit").alias("exit2"), F.col("last").alias("last2"))
        jump = stored(jump.join(after, ["file", "exit"]).select(
            "file", "offset", F.col("exit2").alias("exit"), F.col("last2").alias("last")), "warc-jump")
    # the blocks a record reaches into or over, up to the one where the next record starts
    span = F.sequence(F.floor(F.greatest("owner", F.lit(0)) / block) + F.when(F.col("owner") < 0, 0).otherwise(1),
                      F.floor(F.col("offset") / block))
    leaves = (F.col("owner") < 0) | (F.floor(F.col("offset") / block) > F.floor(F.col("owner") / block))
    entries = reached.where(leaves).select("file", "offset", "owner", F.explode(span).alias("block")).groupBy("file", "block").agg(
        F.min(F.struct("offset", "owner")).alias("entry")).select("file", "block", "entry.*")
    entries = entries.select("file", "block", F.col("offset").alias("entry"), F.col("owner").alias("over"))
    ready = placed.join(entries, ["file", "block"]).select(
        "file", "block", "offset", "end", "split", "at", "entry", "over").repartition("file", "block").sortWithinPartitions(
        "file", "block", "offset")
    return map_arrow(ready, _by_block(_owners), "file string, split long, at long, offset long, owner long, end long")


def _exits(file: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    offsets, ends = columns[0], columns[1]
    leave, last = _followed(offsets, ends)
    return pa.RecordBatch.from_arrays([pa.array([file] * len(offsets)), pa.array(offsets), pa.array(leave), pa.array(last)],
                                      names=["file", "offset", "exit", "last"])


def _owners(file: str, columns: list[np.ndarray]) -> pa.RecordBatch:
    offsets, ends, split, at, entry, over = columns
    on = _on_chain(offsets, ends, int(entry[0]))
    latest = np.maximum.accumulate(np.where(on, offsets, -1))
    owner = np.where(latest >= 0, latest, over)
    stop = ends[np.searchsorted(offsets, np.maximum(latest, offsets[0]))]
    keep = (owner >= 0) & ((latest < 0) | (offsets < stop))
    return pa.RecordBatch.from_arrays(
        [pa.array([file] * int(keep.sum()), pa.string()), *(pa.array(c[keep]) for c in (split, at, offsets, owner, ends))],
        names=["file", "split", "at", "offset", "owner", "end"])


def _by_block(work):
    """Runs ``work`` on each (file, block) of sorted rows; one that goes over batches is put together."""

    def run(batches: Iterator[pa.RecordBatch]):
        now, held = None, []
        for batch in batches:
            files, blocks = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            if not len(files):
                continue
            columns = [c.to_numpy() for c in batch.columns[2:]]
            cuts = np.flatnonzero((files[1:] != files[:-1]) | (blocks[1:] != blocks[:-1])) + 1
            edges = [0, *cuts.tolist(), len(files)]
            for a, b in zip(edges, edges[1:]):
                key = files[a], int(blocks[a])
                if held and key != now:
                    yield work(now[0], [np.concatenate(x) for x in zip(*held)])
                    held = []
                now = key
                held.append([c[a:b] for c in columns])
        if held:
            yield work(now[0], [np.concatenate(x) for x in zip(*held)])

    return run


RECORD = ("file string, offset long, warc_type string, target_uri string, record_id string, refers_to string, "
          "payload_digest string, header_digest string, payload_bytes long, declared_bytes long, payload binary")


def _record(file: str, offset: int, data: bytes, with_payload: bool) -> tuple | None:
    got = parse_header(data)
    if got is None:
        return None
    at, fields = got
    body = data[at:at + int(fields["content-length"])]
    declared = fields.get("x-payload-length", "")
    return (file, offset, fields["warc-type"], fields.get("warc-target-uri"), fields.get("warc-record-id"),
            fields.get("warc-refers-to"), hashlib.sha1(body).hexdigest(),
            fields.get("warc-payload-digest", "").removeprefix("sha1:"), len(body),
            int(declared) if declared.isdigit() else None, body if with_payload else None)


_RECORD_KINDS = [pa.string(), pa.int64()] + [pa.string()] * 6 + [pa.int64()] * 2 + [pa.binary()]
_RECORD_NAMES = [x.split()[0] for x in RECORD.split(", ")]


def read_archives(spark: SparkSession, path: str, payload: bool = True, block: int = BLOCK) -> DataFrame:
    """One row per record on the chain of its file, with the fields of its header and its payload.

    ``payload=False`` leaves the bytes out and gives their digest and length only. A folder
    without files gives no rows; a last record that is cut short is left out. Records whose
    payload holds the magic are put together from their chunks, each in one row. A file whose
    chain ends before it does (no record at its start, another version line than that of
    ``MAGIC``, a header or length that does not hold) raises, so no record is lost unseen.
    """
    raw = chunks(spark, path)
    found = candidates(raw)
    owners = stored(chain(found, block), "warc-owners")
    _all_read(raw, owners)

    def run(batches: Iterator[pa.RecordBatch]):
        rows, held = [], 0
        kinds, names = [pa.string(), pa.int64(), pa.int64(), *_RECORD_KINDS[2:]], ["file", "split", "at", *_RECORD_NAMES[2:]]
        for file, split, at, data in _places(batches):
            got = parse_header(data)
            if got and got[0] + int(got[1]["content-length"]) + 4 == len(data):
                rows.append((file, split, at, *_record(file, 0, data, payload)[2:]))
                held += len(data) if payload else 500
            if held > 8_000_000:
                yield _rows(rows, kinds, names)
                rows, held = [], 0
        yield _rows(rows, kinds, names)

    parsed = map_arrow(raw, run, "file string, split long, at long, " + RECORD.split(", ", 2)[2])
    alone = parsed.join(owners.where("owner = offset"), ["file", "split", "at"]).select(*_RECORD_NAMES)
    several = stored(owners.groupBy("file", "owner").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "warc-several")
    if several.isEmpty():
        return alone
    return alone.unionByName(_joined(raw, owners.join(several.select("file", "owner"), ["file", "owner"]), payload))


def _all_read(raw: DataFrame, owners: DataFrame) -> None:
    """Raises where the chain of a file ends before the file."""
    sizes = raw.groupBy("file").agg((F.sum(F.octet_length("data") + len(MAGIC)) - len(MAGIC)).alias("bytes"))
    ends = owners.where("owner = offset").groupBy("file").agg(F.max("end").alias("end"))
    short = sizes.join(ends, "file", "left").select("file", "bytes", F.coalesce("end", F.lit(0)).alias("end")).where(
        "end < bytes").orderBy("file").limit(5).collect()
    if short:
        raise ValueError("no record follows in " + "; ".join(
            f"{r['file']} at byte {r['end']} of {r['bytes']}" for r in short))


def _joined(raw: DataFrame, wanted: DataFrame, payload: bool) -> DataFrame:
    """Records that lie in several chunks."""

    def place(batches: Iterator[pa.RecordBatch]):
        kinds, names = [pa.string(), pa.int64(), pa.int64(), pa.binary()], ["file", "split", "at", "part"]
        rows = []
        for row in _places(batches):
            rows.append(row)
            if len(rows) == 500:
                yield _rows(rows, kinds, names)
                rows = []
        yield _rows(rows, kinds, names)

    def join(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            rows = []
            for file, owner, parts in zip(*(c.to_pylist() for c in batch.columns)):
                data = MAGIC.encode().join(p["part"] for p in parts)
                got = _record(file, owner, data, payload)
                if got and parse_header(data)[0] + got[8] + 4 <= len(data):
                    rows.append(got)
            yield _rows(rows, _RECORD_KINDS, _RECORD_NAMES)

    parts = map_arrow(raw, place, "file string, split long, at long, part binary").join(
        wanted.select("file", "split", "at", "offset", "owner"), ["file", "split", "at"])
    grouped = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("offset", "part"))).alias("parts"))
    return map_arrow(grouped.select("file", "owner", "parts"), join, RECORD)


def pages_of(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, intact) of records written here.

    A revisit states its payload's digest and length in its header; of a response both are
    those of the bytes read, and ``intact`` says whether they are what its header states.
    """
    revisit = F.col("warc_type") == "revisit"
    number = lambda c: F.expr(f"try_cast(regexp_extract({c}, '([0-9-]+)>?$', 1) as bigint)")
    return records.select(
        number("target_uri").alias("page_id"),
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("header_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(revisit, number("refers_to")).alias("refers_to"),
        (revisit | ((F.col("payload_digest") == F.col("header_digest"))
                    & (F.col("declared_bytes") == F.col("payload_bytes")))).alias("intact"))
