"""What the operators share: table reads, Arrow batches of bounded size, whitespace classes."""

from __future__ import annotations

import ctypes
import re
import sys
import types
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A batch handed to Python is bounded by rows and by bytes, so long texts don't add up.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

# The characters with the Unicode property White_Space, as a regex class body.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def use_small_batches(spark: SparkSession) -> None:
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_things() -> dict:
    """What this Python worker keeps from task to task."""
    return sys.modules.setdefault("_filings_audit_llm_kept", types.ModuleType("_filings_audit_llm_kept")).__dict__.setdefault("things", {})


def once(key: Hashable, build: Callable):
    """Build a thing once per Python worker; later tasks of the worker find it again."""
    kept = kept_things()
    if key not in kept:
        kept[key] = build()
    return kept[key]


def lean(run: Callable[[Iterator], Iterator], uses: Hashable = None) -> Callable[[Iterator], Iterator]:
    """``run``, a function for ``mapInArrow``, in a Python worker that may have served other operators and may serve more.

    A task first drops what others have kept there, all but what ``once`` keeps under ``uses``. At its end it returns
    freed memory to the system, as Spark keeps idle workers alive.
    """

    def task(batches: Iterator) -> Iterator:
        kept = kept_things()
        for key in [key for key in kept if key != uses]:
            del kept[key]
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
            if trim:
                trim(0)

    return task


SPACE = re.compile(r"\s")


def pieces(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The whole text in pieces of about ``size`` characters that end before white space, so no word is cut."""
    at = 0
    while at < len(text):
        found = SPACE.search(text, at + size) if at + size < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def map_texts(
    frame: DataFrame, keep: list[str], source: str, schema: str, make: Callable[[], Callable[[list], list]], uses: Hashable = None
) -> DataFrame:
    """Run Python over one column, without a shuffle.

    ``make()`` is called once a task and returns a function from the list of a batch's values to one list per
    column of ``schema``. The columns of ``keep`` pass unchanged; others are not sent to Python. No column of ``keep`` may have the
    name of a made one. ``uses`` is the key under which ``make`` keeps a thing by ``once``.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    clashing = {c.lower() for c in keep} & {n.lower() for n in names}
    if clashing:
        raise ValueError(f"columns to keep are named like results: {sorted(clashing)}")
    at = keep.index(source) if source in keep else len(keep)
    chosen = frame.select(*[frame[c] for c in keep], *([frame[source]] if at == len(keep) else []))
    kept = ", ".join(f"`{c}` {frame.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            if not batch.num_rows:
                continue
            made = function(batch.column(at).to_pylist())
            arrays = [m if isinstance(m, pa.Array) else pa.array(m) for m in made]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *arrays], names=keep + names)

    return chosen.mapInArrow(lean(run, uses), f"{kept}, {schema}")


def held_out(doc_id: Column) -> Column:
    """Rows that no label or language may be learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def sample_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """All rows if there are at most ``most``, else about so many, chosen by a hash of ``key``."""
    n = rows.count()
    if n <= most:
        return rows
    wide = 1 << 62  # so fine that no size of table makes the share 0
    return rows.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(wide)) < F.lit(int(wide * most / n)))
