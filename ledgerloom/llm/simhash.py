"""SimHash near-duplicates, linked through pivot distance tables.

Fingerprints: each bit is the majority of the 64-bit hashes of a text's word
shingles. Equal fingerprints become one row before anything is compared.

Candidates: with ``64 / blocks`` bits a block and at most ``distance`` differing
bits, any pair within the distance agrees in at least ``blocks - distance``
blocks; every choice of so many blocks is a bucket key, with as many blocks as
give about one stranger per bucket. (Distances to pivots alone cannot deal
pairs out: for fingerprints of different texts they all lie near 32, and each
coordinate keeps over half of all pairs.) Inside a bucket, a table of Hamming
distances to many reference fingerprints is made once per fingerprint; a pair
whose tables differ by more than the distance in any coordinate is discarded
(triangle inequality), and survivors are verified.

Only links between different components leave a bucket, so a group of n
near-copies gives fewer than n links. A bucket of more than ``BUCKET`` members
is first linked to its lowest member; members that this unites are compared
with the others only, in chunks over many tasks.

Components: alternating large and small star contractions until stable, each
round written to the shared folder.

Defined cases: a text with fewer words than a shingle is one shingle; an empty
or null text has fingerprint zero and links like any other; repeated rows share
a component; a null doc_id never names a component unless all of its members'
are null (component_id is then null); an empty table gives an empty result;
further columns are not read by the query, and carried along by
:func:`drop_near_duplicates`.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import packed, pieces, read_table, row_key, staged, texts_of

SHINGLE = 4
DISTANCE = 4
SEED = 42
BUCKET = 2048
# Ids of rows that have copies are marked in this many words of 64 bits: the most that is broadcast.
MARK_WORDS = 1 << 18
# Reference fingerprints: digests of their numbers, so spread over all bits.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(16)], np.uint64)


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """SimHash of a text's UTF-8 bytes."""
    words = text.lower().split()  # bytes: A-Z only, and white space is the six ASCII ones
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - width] + 1).tolist()]
    ends = [*gaps[width - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    total, ones = len(hashes), np.zeros(64, np.int64)
    for at in range(0, total, 1 << 14):
        block = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(block, axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Rows of docs (which has a column text) with their fingerprint ``fp`` (a signed long) for it."""
    others = [c for c in docs.columns if c != "text"]

    def work(batches):
        for piece in pieces(batches):
            values = [fingerprint(x, width) for x in texts_of(piece.column("text"))]
            values = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in others), pa.array(values)], [*others, "fp"]
            )

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.mapInArrow(work, f"{kinds}, fp long")


def block_masks(distance: int, blocks: int):
    """Masks of every choice of ``blocks - distance`` blocks of the 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in itertools.combinations(each, blocks - distance)]


def choose_blocks(count: int, distance: int) -> int:
    """As few blocks as leave about one stranger a bucket; any number is exact."""
    blocks = distance + 1
    while blocks < distance + 6 and 2 ** (64 * (blocks - distance) // blocks) < count:
        blocks += 1
    return blocks


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bucket_rows(fps: DataFrame, masks) -> DataFrame:
    """Each fingerprint under each of its bucket keys, in buckets of two or more.

    Adds the bucket's number of members and its lowest member.
    """
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("bits")) for i, m in enumerate(masks)])
    rows = fps.select("fp", F.inline(keys))
    buckets = rows.groupBy("mask", "bits").agg(
        F.count("*").alias("members"), F.min("fp").alias("lowest")
    )
    return rows.join(buckets.where("members > 1"), ["mask", "bits"])


def near(one, other, distance):
    return F.bit_count(one.bitwiseXOR(other)) <= distance


def similar_pairs(fps: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fps`` within the distance.

    ``fps`` holds distinct fingerprints in a column fp. No link joins
    fingerprints that are further apart.
    """
    blocks = choose_blocks(fps.count(), distance)
    rows = staged(bucket_rows(fps, block_masks(distance, blocks)), "buckets")
    small = rows.where(F.col("members") <= bucket).select(
        "mask", "bits", F.lit(0).alias("chunk"), "fp", F.col("fp").alias("comp"), F.lit(0).alias("side")
    )
    large = rows.where(F.col("members") > bucket)
    links = inside_buckets(small, distance)
    if large.isEmpty():
        return links
    stars = large.where(near(F.col("fp"), F.col("lowest"), distance)).where("fp <> lowest")
    stars = staged(stars.select(F.col("fp").alias("a"), F.col("lowest").alias("b")).distinct(), "stars")
    comps = components(stars)
    with_comp = large.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "comp", F.coalesce("root", "fp")
    )
    lowest = comps.select(F.col("node").alias("lowest"), F.col("root").alias("bulk"))
    with_comp = with_comp.join(lowest, "lowest", "left").withColumn(
        "bulk", F.coalesce("bulk", "lowest")
    )
    with_comp = staged(with_comp.select("mask", "bits", "fp", "comp", "bulk"), "large")
    sizes = with_comp.groupBy("mask", "bits").agg(
        F.ceil(F.count("*") / bucket).alias("columns"),
        F.ceil(F.count_if(F.col("comp") != F.col("bulk")) / bucket).alias("rows"),
    )
    sized = with_comp.join(sizes.where("rows > 0"), ["mask", "bits"])
    salt = F.xxhash64("fp", F.lit(1))
    # Chunk (i, j): strays of chunk i (side 1) against all of chunk j (side 2).
    i, j = F.pmod(salt, "rows"), F.pmod(salt, "columns")
    strays = sized.where("comp <> bulk").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("columns") - 1)).alias("j"), i.alias("i"), F.lit(1).alias("side")
    )
    everyone = sized.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("i"), j.alias("j"), F.lit(2).alias("side")
    )
    chunk = (F.col("i") * F.col("columns") + F.col("j")).cast("int").alias("chunk")
    both = [x.select("mask", "bits", chunk, "fp", "comp", "side") for x in (strays, everyone)]
    return links.unionByName(stars).unionByName(inside_buckets(both[0].unionByName(both[1]), distance))


def inside_buckets(rows: DataFrame, distance: int) -> DataFrame:
    """Links between components within each bucket (mask, bits, chunk)."""

    def work(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, table]) if rest is not None else table
            cut = last_bucket(rest)
            if cut:
                yield from linked(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None:
            yield from linked(rest)

    def last_bucket(table):
        same = np.ones(table.num_rows, bool)
        for name in ("mask", "bits", "chunk"):
            values = table.column(name).to_numpy()
            same &= values == values[-1]
        return int(np.argmax(same)) if len(same) else 0

    def linked(table):
        a, b = bucket_links(*(table.column(c).to_numpy() for c in table.column_names), distance)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    keys = ("mask", "bits", "chunk")
    dealt = rows.select(*keys, "fp", "comp", "side").repartition(*keys)
    return dealt.sortWithinPartitions(*keys, "side", "fp").mapInArrow(work, "a long, b long")


def bucket_links(mask, bits, chunk, fp, comp, side, distance):
    """Links over whole buckets in sorted rows, one less than what they unite at most."""
    n = len(fp)
    prints = fp.view(np.uint64)
    table = np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)
    changes = (np.diff(mask) != 0) | (np.diff(bits) != 0) | (np.diff(chunk) != 0)
    ends = np.append(np.flatnonzero(changes) + 1, n)
    end = np.repeat(ends, np.diff(ends, prepend=0))
    parents, out_a, out_b = {}, [], []

    def root(x):
        while parents.get(x, x) != x:
            parents[x] = parents.get(parents[x], parents[x])
            x = parents[x]
        return x

    def close(i, j):
        """Which pairs are within the distance: pivot tables first, then the bits."""
        kept = np.flatnonzero(np.abs(table[i] - table[j]).max(axis=1) <= distance)
        kept = kept[np.bitwise_count(prints[i[kept]] ^ prints[j[kept]]) <= distance]
        return i[kept], j[kept]

    def link(i, j):
        for p, q in zip(i.tolist(), j.tolist()):
            x, y = root(comp[p]), root(comp[q])
            if x != y:
                parents[max(x, y)] = min(x, y)
                out_a.append(fp[p])
                out_b.append(fp[q])

    # Plain buckets: each row against the one `step` places on.
    i = np.flatnonzero(side == 0)
    step = 1
    while len(i):
        i = i[i + step < end[i]]
        for at in range(0, len(i), 1 << 16):
            link(*close(i[at : at + (1 << 16)], i[at : at + (1 << 16)] + step))
        step += 1
    # Chunks of large buckets: strays (side 1) against all rows behind them (side 2).
    for p in np.flatnonzero(side == 1).tolist():
        others = np.arange(p + 1, end[p])
        others = others[(side[others] == 2) & (comp[others] != comp[p])]
        link(*close(np.full(len(others), p), others))
    return np.array(out_a, np.int64), np.array(out_b, np.int64)


def components(links: DataFrame) -> DataFrame:
    """node and root (its component's lowest node) for every node of ``links`` (a, b)."""
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    edges = staged(edges.distinct(), "edges")
    while True:
        edges = staged(small_star(large_star(edges)), "edges")
        # Stable when every node hangs on one node that hangs on none.
        loose = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1)
        chained = edges.select(F.col("v").alias("u")).distinct().join(edges, "u", "left_semi").limit(1)
        if loose.isEmpty() and chained.isEmpty():
            break
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.unionByName(roots)


def large_star(edges):
    """Hang every larger neighbour of a node on the node's lowest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = both.where("v > u").join(lowest, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges):
    """Hang a node's smaller neighbours, and itself, on the lowest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = lowest.select("u", F.col("m").alias("v"))
    return smaller.unionByName(own).where("u <> v").distinct()


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """fp, root and component_id for rows of doc_id, fp (a staged table: it is read more than once)."""
    fps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fps")
    comps = components(staged(similar_pairs(fps.select("fp"), distance), "links"))
    rooted = fps.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    rooted = staged(rooted, "rooted")
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(firsts, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, width=SHINGLE, distance=DISTANCE) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row of doc_id, text."""
    prints = staged(fingerprints(docs.select("doc_id", "text"), width), "prints")
    return prints.join(classes(prints, distance), "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, width=SHINGLE, distance=DISTANCE) -> DataFrame:
    """One row of each component: the one that names it (of equal ids the first by text digest).

    Rows whose id is not marked are kept where they are; only the others are
    dealt by key to meet the keys that stay. Marks are a fixed number of bits,
    so with very many copies more rows are dealt, never fewer judged.
    """
    keyed = docs.select("doc_id", "text", row_key().alias("key"))
    prints = staged(fingerprints(keyed, width), "prints")
    marked = prints.join(classes(prints, distance), "fp")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key"))
    first = marked.groupBy("root").agg(best.alias("best")).select("best.key").distinct()
    first = staged(first, "first")
    marks = staged(doubtful_ids(prints, first), "marks")
    rows = packed(docs, id_place(F.col("doc_id")).alias("place"))
    rows = rows.withColumn("word", word_of("place")).join(F.broadcast(marks), "word", "left")
    doubtful = F.coalesce(F.getbit("bits", bit_of("place")), F.lit(0)) == 1
    sure = rows.where(~doubtful).select("row.*")
    same = Window.partitionBy("key").orderBy("key")
    key = row_key(F.col("row.doc_id"), F.col("row.text")).alias("key")
    judged = rows.where(doubtful).select("row", key).join(first, "key")
    judged = judged.withColumn("copy", F.row_number().over(same)).where("copy = 1")
    return sure.unionByName(judged.select("row.*"))


def id_place(doc_id):
    return F.pmod(F.xxhash64(doc_id), F.lit(64 * MARK_WORDS))


def word_of(place):
    return F.shiftright(place, 6)


def bit_of(place):
    return F.col(place).bitwiseAND(F.lit(63)).cast("int")


def doubtful_ids(prints: DataFrame, first: DataFrame) -> DataFrame:
    """Marks (word, bits) of the ids of rows that do not stay or that are repeated."""
    keys = prints.groupBy("key").agg(F.min(id_place(F.col("doc_id"))).alias("place"), F.count("*").alias("n"))
    stays = first.withColumn("stays", F.lit(True))
    places = keys.join(stays, "key", "left").where("stays IS NULL OR n > 1")
    bits = F.bit_or(F.expr("shiftleft(1L, cast(place & 63 AS int))")).alias("bits")
    return places.groupBy(word_of("place").alias("word")).agg(bits)


def op4_simhash_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = read_table(spark, sf_dir, "documents")
    found = near_duplicates(docs)
    text = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", text, "component_id")
