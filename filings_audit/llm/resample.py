"""Importance resampling: draw documents as a target corpus would, by hashed n-gram counts.

Every feature (a run of one or more words) falls into a bucket by the CRC-32 of its bytes. A bucket's gain is the
logarithm of how much likelier the target uses it than the source does; a document's weight is the sum over its
features; Gumbel noise from a hash of its id turns the highest scores into a draw without replacement.

CRCs are computed many at a time: distinct features of equal length form a matrix of bytes, and all its rows take
one step per column. A long feature is cut into a matrix of its own, whose rows are joined by the linearity of the
CRC, so no feature costs a step per byte.

Both corpora are counted whole. A task adds up one array of buckets; what leaves it has a row per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filings_audit.session import materialize

# The reflected polynomial of CRC-32, and the start of its register.
POLYNOMIAL, ONES = 0xEDB88320, 0xFFFFFFFF
SLICE = 1 << 20  # bytes of text whose words are held at a time
LONG = 256  # bytes; longer features are cut into rows
ROW = 64
CACHE = 300_000


@dataclass(frozen=True)
class Settings:
    """Runs of 1 to ``longest`` words; of documents with ``least_words`` at least, ``percent`` are drawn."""

    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


def _table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(POLYNOMIAL), c >> 1).astype(np.uint32)
    return c


TABLE = _table()


def _by_column(rows: np.ndarray, start: int) -> np.ndarray:
    """The registers of all rows of a matrix of bytes, one column at a time."""
    register = np.full(len(rows), start, np.uint32)
    for column in rows.T:
        register = TABLE[(register ^ column) & 0xFF] ^ (register >> 8)
    return register


def _past_a_row() -> np.ndarray:
    """What ROW zero bytes make of each single bit of a register; other registers are sums of these."""
    register = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(ROW):
        register = TABLE[register & 0xFF] ^ (register >> 8)
    return register


PAST_A_ROW = [int(x) for x in _past_a_row()]


def _long_crc(feature: bytes) -> int:
    """Rows of one feature side by side, then joined: a register passes over a row as over zeros, plus the row's own."""
    data = np.frombuffer(feature, np.uint8).copy()
    data[:4] ^= 0xFF  # the same as starting from all ones
    padded = np.zeros(-(-len(data) // ROW) * ROW, np.uint8)
    padded[-len(data) :] = data  # zeros in front leave an empty register empty
    register = 0
    for own in _by_column(padded.reshape(-1, ROW), 0).tolist():
        moved, bit = 0, 0
        while register:
            if register & 1:
                moved ^= PAST_A_ROW[bit]
            register, bit = register >> 1, bit + 1
        register = moved ^ own
    return register ^ ONES


def crc32s(features: list[bytes]) -> np.ndarray:
    """The CRC-32 of every feature, in their order."""
    out = np.zeros(len(features), np.int64)
    sizes = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(sizes, kind="stable")
    lengths, firsts = np.unique(sizes[order], return_index=True)
    for length, places in zip(lengths.tolist(), np.split(order, firsts[1:])):
        if length > LONG:
            out[places] = [_long_crc(features[i]) for i in places]
            continue
        data = np.frombuffer(b"".join([features[i] for i in places]), np.uint8).reshape(len(places), length)
        out[places] = _by_column(data, ONES) ^ np.uint32(ONES)
    return out


def _alphabet() -> bytes:
    """Lower case for A-Z; a space for every other ASCII character that is no letter or digit; bytes of others stay."""
    keep = lambda b: b >= 128 or chr(b).isalnum()
    return bytes(ord(chr(b).lower()) if b < 128 and keep(b) else b if keep(b) else 32 for b in range(256))


ALPHABET = _alphabet()


def _slices(texts: list[bytes | None], longest: int) -> Iterator[tuple[int, list[bytes], int]]:
    """(row, words, how many of these stood in the row's slice before): whole texts, a bounded piece at a time."""
    for row, text in enumerate(texts):
        data = (text or b"").translate(ALPHABET)
        at, before = 0, []
        while at < len(data):
            end = data.find(b" ", at + SLICE)
            end = len(data) if end < 0 else end
            words = before + data[at:end].split()
            yield row, words, len(before)
            before = words[-(longest - 1) :] if longest > 1 else []
            at = end


def _features(words: list[bytes], carried: int, longest: int) -> list[bytes]:
    """All runs of up to ``longest`` words that end after the carried ones."""
    out = words[carried:]
    for n in range(2, longest + 1):
        out += [b" ".join(words[end - n : end]) for end in range(max(carried + 1, n), len(words) + 1)]
    return out


class Hasher:
    """Features of texts as bucket numbers; each distinct feature is hashed once as long as the memory of them lasts."""

    def __init__(self, buckets: int, longest: int):
        self.buckets, self.longest, self.known = buckets, longest, {}

    def __call__(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For groups of slices: row, words and features of each slice, then the buckets of all features in order."""
        group, size = [], 0
        for row, words, carried in _slices(texts, self.longest):
            group.append((row, len(words) - carried, _features(words, carried, self.longest)))
            size += len(words)
            if size > SLICE // 4:
                yield self._group(group)
                group, size = [], 0
        if group:
            yield self._group(group)

    def _group(self, group: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if len(self.known) > CACHE:
            self.known.clear()
        new = list(set().union(*[features for _, _, features in group]).difference(self.known))
        self.known.update(zip(new, (crc32s(new) % self.buckets).tolist()))
        rows, words, features = zip(*group)
        sizes = np.array([len(f) for f in features], np.int64)
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(features)), np.int64, int(sizes.sum()))
        return np.array(rows), np.array(words), sizes, flat


def bucket_counts(frame: DataFrame, settings: Settings = Settings(), text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. The driver receives one sum per bucket."""
    number, longest = settings.buckets, settings.longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(number, longest), np.zeros(number, np.int64)
        for batch in batches:
            for *_, flat in hasher(batch.column(0).to_pylist()):
                total += np.bincount(flat, minlength=number)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    rows = frame.select(frame[text].cast("binary")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    out = np.zeros(number, np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the target's smoothed share of each bucket over the source's."""
    s, t, extra = source.astype(float), target.astype(float), float(len(source))
    ratio = (t + 1) * (s.sum() + extra) / ((s + 1) * (t.sum() + extra))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, keep: list[str], settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``keep``, n_words, n_features and weight of every row; a null or wordless text has 0 of each. Map only."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    number, longest = settings.buckets, settings.longest
    chosen = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text].cast("binary").alias("text"))
    names = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, gain = Hasher(number, longest), shared.value
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for rows, n_words, sizes, flat in hasher(batch.column(len(names)).to_pylist()):
                ends = np.cumsum(np.concatenate([[0], gain[flat]]))
                last = np.cumsum(sizes)
                np.add.at(words, rows, n_words)
                np.add.at(features, rows, sizes)
                np.add.at(weight, rows, ends[last] - ends[last - sizes])
            made = [pa.array(x) for x in (words, features, weight)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *made], names=[*names, "n_words", "n_features", "weight"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[: len(names)])
    found = chosen.mapInArrow(run, f"{kept}n_words long, n_features long, weight long")
    return found.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_words", "n_features", "weight")


def gumbel(doc_id: Column, seed: str) -> Column:
    """floor(1000 * noise) from the first 32 bits of a hash of the id; a null id counts as an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(
    docs: DataFrame, target: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row; rank is null for rows that are not drawn.

    Repeated rows are rows of their own, equal scores go by the smaller id (null ids last). Null texts have no words.
    Without target texts all target counts are 0; an empty table gives no rows. Of other columns none is read.

    Rows are written once, then sorted into ranges of (score, id, place in that table), so that equal rows split too;
    a range counts its own rows, and the counts of ranges before it (one number each) make its ranks global.
    """
    source = bucket_counts(docs, settings, text)
    gain = gains(source, bucket_counts(target, settings, text))
    weighed = weigh(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), gain, ["doc_id"], settings)
    weighed = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), settings.seed))
    weighed = materialize(weighed, "weights").withColumn("__place", F.monotonically_increasing_id())
    names = ["doc_id", "n_words", "n_features", "weight", "score"]
    # Rows that can't be drawn sort behind all others.
    able = weighed.withColumn("__able", F.col("n_words") >= settings.least_words)
    drawn = able.where("__able").count() * settings.percent // 100
    order = [F.desc("__able"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("__place")]
    ranges = able.repartitionByRange(*order).sortWithinPartitions(*order).select(*names, "__able")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranges.schema.fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            extra = [pa.array(np.full(n, part, np.int64)), pa.array(np.arange(seen + 1, seen + n + 1))]
            seen += n
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "__part", "__local"])

    ranked = materialize(ranges.mapInArrow(number, f"{kept}, __part long, __local long"), "ranges")
    sizes = ranked.groupBy("__part").agg(F.count("*").alias("__n"))  # a row per range
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    rank = F.col("__base") + F.col("__local")
    found = ranked.join(F.broadcast(base), "__part").withColumn("rank", F.when(F.col("__able") & (rank <= drawn), rank))
    return found.select(*names, "rank")


# Values of SQL below: lists and texts that DuckDB has no function for.
_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(list_concat([n], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: xor(c >> 1, 3988292384 * (c & 1))))"
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
  dw AS (SELECT r, unnest(words) AS w FROM d),
  bw AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
  w AS (SELECT w, sum(s) AS s, sum(t) AS t FROM (SELECT w, 1 AS s, 0 AS t FROM dw UNION ALL SELECT w, 0, 1 FROM bw) GROUP BY w),
  crc AS (
    SELECT w, s, t, xor(4294967295, list_reduce(
      list_concat([4294967295], [CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT) FOR i IN range(strlen(w))]),
      lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
    FROM w, (SELECT {_CRC_TABLE} AS crc_table)
  ),
  gain AS (
    SELECT bucket, floor(1000 * ln((sum(t)::DOUBLE + 1) * ((SELECT sum(s) FROM w)::DOUBLE + 10000)
      / ((sum(s)::DOUBLE + 1) * ((SELECT sum(t) FROM w)::DOUBLE + 10000))))::BIGINT AS gain
    FROM crc GROUP BY bucket
  ),
  weights AS (
    SELECT r, sum(gain)::BIGINT AS weight FROM dw JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY r
  ),
  scored AS (
    SELECT d.doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
      (coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8) AS BIGINT)
        + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score, len(words) >= 20 AS able
    FROM d LEFT JOIN weights USING (r)
  ),
  ranked AS (
    SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST) AS place,
      count(*) FILTER (able) OVER () * 10 // 100 AS drawn FROM scored
  )
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= drawn THEN place END AS rank FROM ranked
"""
