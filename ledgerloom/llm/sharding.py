"""Shards by vector bin packing: bytes, tokens and rows balanced together.

Equal texts form a group. Light groups are poured into a fixed number of
bundles by a hash of their text; a group heavier than a bundle stands alone,
and one heavier than a quarter of a shard is split by document id. What is
packed is therefore a bounded number of vectors (``BUNDLES`` per shard, plus at
most three times as many heavy parts), whatever the input: the heaviest first,
each into the shard where the dot product of its vector with the residual
capacity is highest, among shards where it fits.

Defined cases: a null text has no bytes and no words and groups with empty
texts; a row costs 8 bytes besides its text; equal rows get slots of their own;
an empty table gives an empty result; further input columns are not read.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import hex_digits, read_table, running_total, staged, word_count

BUNDLES = 64
ROW_BYTES = 8
WEIGHTS = ("size", "tokens", "one")


def pack(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector (rows of ``vectors``: bytes, tokens, rows)."""
    total = vectors.sum(axis=0)
    parts = vectors / np.where(total > 0, total, 1) * shards  # a shard holds 1 of each
    room = np.ones((shards, vectors.shape[1]))
    order = np.lexsort((np.arange(len(parts)), -parts.max(axis=1)))
    chosen = np.zeros(len(parts), dtype=np.int64)
    for i in order:
        part = parts[i]
        over = np.maximum(part - room, 0).max(axis=1)
        fits = over <= 0
        score = np.where(fits, room @ part, -np.inf) if fits.any() else -over
        chosen[i] = int(score.argmax())
        room[chosen[i]] -= part
    return chosen


def units(rows: DataFrame, shards: int, bundles: int) -> DataFrame:
    """Add ``unit``, what is packed as one, to rows with grp, size, tokens, one."""
    total = [max(v or 0, 1) for v in rows.agg(*[F.sum(c) for c in WEIGHTS]).first()]
    groups = rows.groupBy("grp").agg(*[F.sum(c).alias(c) for c in WEIGHTS])
    share = F.greatest(*[F.col(c) / F.lit(float(t)) for c, t in zip(WEIGHTS, total)])
    heavy = groups.where(share * (shards * bundles) > 1)  # so at most 3 * shards * bundles
    heavy = heavy.select("grp", F.ceil(share * (shards * 4)).alias("parts"))
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    alone = F.concat_ws("/", F.lit("group"), F.hex("grp"), part.cast("string"))
    bundle = F.concat_ws("/", F.lit("bundle"), F.pmod("grp", F.lit(shards * bundles)).cast("string"))
    return (
        rows.join(F.broadcast(heavy), "grp", "left")
        .withColumn("unit", F.when(F.col("parts").isNull(), bundle).otherwise(alone))
        .drop("parts")
    )


def assign(rows: DataFrame, shards: int, bundles: int = BUNDLES) -> DataFrame:
    """Add ``shard`` to rows with doc_id, grp, size, tokens, one."""
    spark = rows.sparkSession
    cut = units(rows, shards, bundles)
    sums = cut.groupBy("unit").agg(*[F.sum(c).alias(c) for c in WEIGHTS]).orderBy("unit")
    loads = sums.collect()  # bounded by shards and bundles
    if not loads:
        return rows.withColumn("shard", F.lit(0))
    chosen = pack(np.array([[r[c] for c in WEIGHTS] for r in loads], dtype=float), shards)
    plan = [(r.unit, int(s)) for r, s in zip(loads, chosen)]
    plan = spark.createDataFrame(plan, "unit string, shard int")
    return cut.join(F.broadcast(plan), "unit").drop("unit")


def with_slots(rows: DataFrame, count: int) -> DataFrame:
    """Add ``slot``: the place of a row in its shard, without gaps, in order of a digest of its id."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    rows = rows.withColumn("digest", digest)
    rows = rows.withColumn("bucket", F.substring("digest", 1, hex_digits(count)))
    order = ("digest", "doc_id", "grp", "size")
    rows = running_total(rows, ["shard"], "bucket", order, "one")
    return rows.withColumn("slot", F.col("running") - 1).drop("digest", "bucket", "running")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, tokens, shard and slot of every row of doc_id, text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        word_count(F.col("text")).alias("tokens"),
        F.lit(1).cast("long").alias("one"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("grp"),
    )
    rows = staged(rows, "sizes")
    placed = staged(assign(rows, shards), "placed")
    return with_slots(placed, placed.count()).drop("grp", "one")


def op9_pack_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    docs = read_table(spark, sf_dir, "documents")
    return shard_documents(docs, 24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )
