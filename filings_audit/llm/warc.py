"""WARC archives: write pages as records, and read archives of any size back by verified chains of records.

Writing is a Spark text write: a record is one string, and the line separator ends it. Equal payloads are kept once,
by the page with the largest id; the others are revisits that refer to it.

Reading splits archives at the magic line, which may also stand inside a payload. Each task emits for every magic of
its split that is followed by a well-formed header a candidate: its offset, and the successor's offset by the length
that the header claims. Inside a split the task follows these links to the first offset outside. Between splits
pointers jump: from the start of each file, in rounds that double the number of splits passed, until all
reachable entries are known. Only candidates on the chain from the file's start are records.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filings_audit.llm.common import use_small_batches
from filings_audit.session import materialize

# Fixed values of the format.
MAGIC = b"WARC/1.1\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32_FROM, BASE32_TO = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

FIELDS = {
    "type": pa.string(), "record_id": pa.string(), "refers_to": pa.string(), "target_uri": pa.string(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
}
KINDS = {pa.string(): "string", pa.int64(): "long", pa.binary(): "binary", pa.bool_(): "boolean"}


def base32_sha1(content: Column) -> Column:
    """SHA-1 of bytes in upper-case base 32: each ten hex digits are eight digits of base 32."""
    digits = F.sha1(content)
    parts = [F.lpad(F.conv(F.substring(digits, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), BASE32_FROM, BASE32_TO)


def write(
    pages: DataFrame, path: str, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """Write a record per row of ``pages`` into archives below ``path``.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest page id is a response,
    the others are revisits of it; all other records are responses. A null html is an empty payload, a null
    url is left out. Rows repeated with the largest id are responses each. Null ids are written as ``null``
    and count as the smallest.
    """
    payload = F.coalesce(pages[html], F.lit(""))
    records = pages.select(
        F.coalesce(pages[page_id].cast("string"), F.lit("null")).alias("name"),
        pages[page_id].alias("id"),
        F.regexp_replace(pages[url], r"[\r\n]", "").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        base32_sha1(payload.cast("binary")).alias("digest"),
    )
    repeated = (
        records.where(F.col("size") >= min_bytes).groupBy("digest")
        .agg(F.max("id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    )
    # Written first, so that Spark knows its size: the pages are shuffled only if there are many repeated payloads.
    repeated = materialize(repeated, "repeated")
    joined = records.join(repeated, "digest", "left")
    first = F.col("first").cast("string")
    revisit = first.isNotNull() & (F.col("size") >= min_bytes) & (first != F.col("name"))

    def line(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    shared = F.concat(
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), "name", F.lit(">"))),
        line("WARC-Date", "1970-01-01T00:00:00Z"),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
    )
    response = F.concat(
        line("WARC-Type", "response"), shared, line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", (F.col("size") + len(HTTP)).cast("string")), F.lit("\r\n" + HTTP), "payload",
    )
    again = F.concat(
        line("WARC-Type", "revisit"), shared, line("WARC-Profile", REVISIT),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), first, F.lit(">"))),
        line("WARC-Payload-Length", F.col("size").cast("string")), line("Content-Length", "0"), F.lit("\r\n"),
    )
    record = F.concat(F.lit(MAGIC.decode()), F.when(revisit, again).otherwise(response), F.lit("\r\n"))
    joined.select(record.alias("value")).write.option("lineSep", "\r\n").text(path)


def _header(segment: bytes) -> tuple[dict[str, str], int] | None:
    """The named fields after a magic and where the block begins, or None if this is no header."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for line in segment[:end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not fields.get("content-length", "").isdecimal() or "warc-type" not in fields:
        return None
    return fields, end + 4


def _record(fields: dict[str, str], block: bytes, payload: bool) -> dict:
    """What a whole record says; payload length and digest are measured where there is a payload."""
    kind = fields["warc-type"]
    out = {"type": kind, "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to")}
    out["target_uri"] = fields.get("warc-target-uri")
    if kind == "revisit":
        length = fields.get("warc-payload-length", "")
        out["payload_bytes"] = int(length) if length.isdecimal() else None
        out["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        return out
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    out["payload_bytes"] = len(block)
    out["payload_digest"] = base64.b32encode(hashlib.sha1(block).digest()).decode()
    out["payload"] = block if payload else None
    return out


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, Iterator[bytes]]]:
    """The task's splits one after the other: file, start, file size, and the segments of the split in order."""

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(i) for i in range(4)))

    source = rows()
    row = next(source, None)
    while row is not None:
        key = row[0].as_py(), row[1].as_py()

        def segments():
            nonlocal row
            while row is not None and (row[0].as_py(), row[1].as_py()) == key:
                yield row[3].as_py()
                row = next(source, None)

        one = segments()
        yield key[0], key[1], row[2].as_py(), one
        for _ in one:  # what the caller has not taken
            pass


def _candidates(payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, _, segments in _splits(batches):
            # Offsets count from the first magic of the split, in the first split of a file from its start.
            at, found, growing = (0 if block == 0 else len(MAGIC)), [], []
            first = block == 0
            for segment in segments:
                still = []
                for row, fields, parts, missing in growing:
                    parts += [MAGIC, segment]
                    missing -= len(MAGIC) + len(segment)
                    if missing <= 0:
                        row |= {"whole": True, **_record(fields, b"".join(parts)[: int(fields["content-length"])], payload)}
                    else:
                        still.append((row, fields, parts, missing))
                growing = still
                parsed = None if first else _header(segment)
                first = False
                if parsed:
                    fields, start = parsed
                    length = int(fields["content-length"])
                    row = {"offset": at - len(MAGIC), "succ": at + start + length + 4, "whole": False}
                    found.append(row)
                    if length <= len(segment) - start:
                        row |= {"whole": True, **_record(fields, segment[start : start + length], payload)}
                    else:
                        growing.append((row, fields, [segment[start:]], length - len(segment) + start))
                at += len(segment) + len(MAGIC)
            leaves: dict[int, int] = {}
            for row in reversed(found):
                leaves[row["offset"]] = row["leaves"] = leaves.get(row["succ"], row["succ"])
            found.append({"offset": None, "succ": at - len(MAGIC)})  # where the next split's first magic stands
            for some in range(0, len(found), 1000):
                part = found[some : some + 1000]
                columns = [pa.array([file] * len(part)), pa.array([block] * len(part), pa.int64())]
                columns += [pa.array([row.get(name) for row in part], kind) for name, kind in CANDIDATE.items()]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "block", *CANDIDATE])

    return run


CANDIDATE = {"offset": pa.int64(), "succ": pa.int64(), "leaves": pa.int64(), "whole": pa.bool_(), **FIELDS}


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of all archives below ``path``.

    Columns: file, offset, type, record_id, refers_to, target_uri, payload_bytes, payload_digest (both measured from the
    payload; a revisit's from its header) and, if asked for, payload. What follows a broken record in a file is
    not reachable and so not returned; a record cut off by the end of its file is left out. No archive: no rows.
    """
    use_small_batches(spark)
    segments = (
        spark.read.option("lineSep", MAGIC.decode()).text(path)
        .select("_metadata.file_path", "_metadata.file_block_start", "_metadata.file_size", F.col("value").cast("binary").alias("value"))
    )
    schema = ", ".join(["file string", "block long", *(f"{name} {KINDS[kind]}" for name, kind in CANDIDATE.items())])
    local = materialize(segments.mapInArrow(_candidates(payload), schema), "warc-candidates")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(
        local.where("offset IS NULL").select("file", "block", F.coalesce(F.sum("succ").over(before), F.lit(0)).alias("base")),
        "warc-splits",
    )
    most = bases.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    found = local.where("offset IS NOT NULL").join(bases, ["file", "block"]).select(
        "file", "block", *[(F.col(c) + F.col("base")).alias(c) for c in ("offset", "succ", "leaves")], "whole", *FIELDS
    )
    # Pointer jumping over splits: ``jump`` leads over 1, 2, 4 ... splits.
    jump = found.select("file", "offset", "leaves")
    reached = bases.select("file", F.lit(0).cast("long").alias("offset")).distinct()
    for step in range(math.ceil(math.log2(most)) if most > 1 else 0):
        reached = materialize(
            reached.unionByName(reached.join(jump, ["file", "offset"]).select("file", F.col("leaves").alias("offset"))).distinct(),
            f"warc-reached-{step}",
        )
        further = jump.select("file", F.col("offset").alias("leaves"), F.col("leaves").alias("later"))
        jump = materialize(
            jump.join(further, ["file", "leaves"], "left").select("file", "offset", F.coalesce("later", "leaves").alias("leaves")),
            f"warc-jump-{step}",
        )
    marked = found.join(reached.withColumn("entry", F.lit(True)), ["file", "offset"], "left")

    def walk(table: pa.Table) -> pa.Table:
        """Follow the chain of one split from its entry."""
        place = {offset: i for i, offset in enumerate(table["offset"].to_pylist())}
        succ, kept = table["succ"].to_pylist(), [False] * table.num_rows
        for i, entry in enumerate(table["entry"].to_pylist()):
            while entry and i is not None and not kept[i]:
                kept[i] = True
                i = place.get(succ[i])
        return table.select(names).filter(pa.array(kept, pa.bool_()))

    names = ["file", "block", "offset", "succ", "whole", *FIELDS]
    kinds = {"file": "string", "block": "long", "offset": "long", "succ": "long", "whole": "boolean"}
    kinds |= {name: KINDS[kind] for name, kind in FIELDS.items()}
    chain = materialize(
        marked.groupBy("file", "block").applyInArrow(walk, ", ".join(f"{n} {kinds[n]}" for n in names)), "warc-chain"
    )
    records = chain.where("whole").unionByName(_assembled(spark, segments, chain, bases, payload, names, kinds))
    return records.select("file", "offset", *[f for f in FIELDS if payload or f != "payload"])


def _assembled(
    spark: SparkSession, segments: DataFrame, chain: DataFrame, bases: DataFrame, payload: bool, names: list[str], kinds: dict
) -> DataFrame:
    """Records that leave their split with a magic inside: at most one per split, so their list is as short as the
    list of splits. Their parts are read again, with offsets known, and put together record by record."""
    broken = [(r["file"], r["offset"], r["succ"]) for r in chain.where("NOT whole").select("file", "offset", "succ").collect()]
    schema = ", ".join(f"{n} {kinds[n]}" for n in names)
    if not broken:
        return spark.createDataFrame([], schema)
    spans: dict[str, list[tuple[int, int]]] = {}
    for file, offset, succ in broken:
        spans.setdefault(file, []).append((offset, succ))
    starts = {(r["file"], r["block"]): r["base"] for r in bases.where(F.col("file").isin(list(spans))).collect()}
    shared = spark.sparkContext.broadcast((spans, starts))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, starts = shared.value
        for file, block, _, found in _splits(batches):
            if file not in spans:
                continue
            at = starts[file, block] + (0 if block == 0 else len(MAGIC))
            for segment in found:
                for offset, succ in spans[file]:
                    if offset < at < succ:
                        row = [file, block, offset, succ, at, segment]
                        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                        arrays = [pa.array([value], kind) for value, kind in zip(row, types)]
                        yield pa.RecordBatch.from_arrays(arrays, names=["file", "block", "offset", "succ", "at", "segment"])
                at += len(segment) + len(MAGIC)

    def assemble(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("at")
        content = MAGIC.join(ordered["segment"].to_pylist())
        first = {name: ordered[name][0].as_py() for name in ("file", "block", "offset", "succ")}
        fields, start = _header(content)
        length = int(fields["content-length"])
        rows = [first | {"whole": True} | _record(fields, content[start : start + length], payload)]
        if len(content) < start + length:  # the file ends inside the record
            rows = []
        types = {"file": pa.string(), "block": pa.int64(), "offset": pa.int64(), "succ": pa.int64(), "whole": pa.bool_(), **FIELDS}
        return pa.table({n: pa.array([row.get(n) for row in rows], types[n]) for n in names})

    pieces = segments.mapInArrow(parts, "file string, block long, offset long, succ long, at long, segment binary")
    return pieces.groupBy("file", "offset").applyInArrow(assemble, schema)
