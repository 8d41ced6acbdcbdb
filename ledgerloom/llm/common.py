"""What several operators of this subpackage share."""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import scratch_folder

# A word is a run of other code points than these six (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Text bytes that a Python worker holds as arrays at a time (one longer text goes alone).
PIECE_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with batches for Python workers kept to a few megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` below the shared folder and read it back.

    This cuts lineage (a lost executor costs its tasks only) and fixes values
    that a second evaluation could give anew, such as row numbers.
    """
    path = f"{scratch_folder(frame.sparkSession)}/{name}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """All columns in one struct ``row``, beside the needed ones.

    Operators add columns of their own next to ``row`` and unpack it at the
    end, so no name of an input column can clash with theirs.
    """
    return docs.select(
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), *needed
    )


def row_key(*names: str | Column) -> Column:
    """A non-null key that only rows with equal values share (by default of doc_id and text)."""
    columns = [n if isinstance(n, Column) else F.col(f"`{n}`") for n in names or ("doc_id", "text")]
    values = [c.cast("string") for c in columns]
    return F.md5(F.concat_ws("\x01", *[F.coalesce(v, F.lit("\x02")) for v in values]))


def running_total(frame, group, bucket, order, value, offsets=None):
    """Add ``running``: the sum of ``value`` up to and with each row of its group.

    ``bucket`` must rise with ``order`` and spread the rows of a group, however
    many: sums per bucket give each bucket's start, and only the rows of one
    bucket are sorted together. ``offsets`` carries such starts made before
    (from :func:`bucket_offsets`). ``group`` and ``bucket`` must not be null.
    """
    offsets = bucket_offsets(frame, group, bucket, value) if offsets is None else offsets
    inside = Window.partitionBy(*group, bucket).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        frame.join(offsets, [*group, bucket])
        .withColumn("running", F.col("start") + F.sum(value).over(inside))
        .drop("start")
    )


def bucket_offsets(frame, group, bucket, value):
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = frame.groupBy(*group, bucket).agg(F.sum(value).alias("in_bucket"))
    start = F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("start")
    return sums.select(*group, bucket, start)


def hex_digits(rows: int, per_bucket: int = 2048) -> int:
    """Leading hex digits of a uniform digest that leave about ``per_bucket`` rows alike."""
    return max(1, math.ceil(math.log(max(rows, 1) / per_bucket + 1, 16)))


def pieces(batches, column="text", limit=PIECE_BYTES):
    """Cut Arrow batches so that ``column`` holds at most ``limit`` bytes (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def utf8(array):
    """Bytes of a string array as one uint8 array, and where each text starts (n + 1)."""
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(array.type)
    _, places, data = array.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)
    offsets = offsets[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts_of(array):
    """The texts as bytes, null as empty."""
    return [b"" if x is None else x for x in array.cast(pa.binary()).to_pylist()]


def word_spans(data, offsets):
    """Start and end (exclusive) of each word, and the number of words before each text."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = solid[heads]
    tails = heads[heads > 0] - 1
    last[tails] = solid[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def _byte_codes():
    with np.errstate(over="ignore"):
        x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = _byte_codes()
BASE = np.uint64(0x9E3779B97F4A7C55)


def mixed(x):
    """Spread the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(data, starts, ends):
    """A 64-bit hash of each word: a polynomial in coded bytes, then mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    powers = np.full(int(lengths.max()), BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    where = np.cumsum(lengths)
    inside = np.arange(where[-1]) - np.repeat(where - lengths, lengths)
    codes = BYTE_CODES[data[inside + np.repeat(starts, lengths)]] * powers[inside]
    return mixed(np.add.reduceat(codes, where - lengths) + lengths.astype(np.uint64))


def window_hashes(hashes, width):
    """Hash of each run of ``width`` word hashes, also across texts (callers mask those)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = total * BASE + hashes[i : i + n]
    return mixed(total)
