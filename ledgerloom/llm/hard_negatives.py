"""Hard negatives by inner product, searched in STR-packed R-trees.

Rows are dealt by label and first coordinate into tiles of at most ``TILE``
rows. Each tile is packed into one R-tree (sort-tile-recursive: sort by one
coordinate, cut into slabs, go on inside with the next) and stored as one row:
vectors in leaf order and the bounding boxes of all levels. A box [low, high]
bounds the inner product with an anchor a coordinate by coordinate: between
min(a*low, a*high) and max(a*low, a*high), summed.

Anchors are taken in waves of at most ``WAVE`` (the number that is collected
and broadcast at once, however many there are); every task searches its tiles
for one wave, in blocks of ``BLOCK`` similar anchors that share a best-first
queue, so that a leaf is scored with one matrix product. A box is pruned for an
anchor if its interval lies outside the anchor's score window, if it holds only
labels the anchor does not look for, or if its upper end is strictly below the
anchor's k-th best so far (equal ends are kept: ties go to the smaller id). The
queue ends when that holds for the whole block. First the positives are found,
their scores give the windows, then the negatives. All bounds and scores are
exact integers, so the result does not depend on how rows were dealt.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; shorter vectors count as padded with zeros; a null id
is never an anchor and loses all ties (the largest long stands for it inside
and is refused as an id); repeated rows are rows of their own, and a repeated
anchor is answered once for each; an anchor without positives, or a positive
without negatives in its window, gives no row, and neither does an empty table.
Products that do not fit a long stop the job. Other columns are not read.
"""

import heapq
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import read_table, running_total, staged

TILE = 8192
LEAF = 128
FAN = 8
SLAB_COORDINATES = 3
WAVE = 8192
BLOCK = 128
NO_ID = np.iinfo(np.int64).max
FOUND = "anchor long, low long, high long, score long, id long"


# The tree of one tile --------------------------------------------------------


def tiled(x, rows, coordinates, leaf=LEAF):
    """``rows`` in sort-tile-recursive order, as a list of leaves."""
    if len(rows) <= leaf:
        return [rows]
    if not len(coordinates):
        return [rows[i : i + leaf] for i in range(0, len(rows), leaf)]
    slabs = round(np.ceil(np.ceil(len(rows) / leaf) ** (1 / len(coordinates))))
    size = -(-len(rows) // slabs)
    rows = rows[np.argsort(x[rows, coordinates[0]], kind="stable")]
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    return [found for part in parts for found in tiled(x, part, coordinates[1:], leaf)]


def grown(x, labels, ids, numbers):
    """An R-tree over the rows of ``x``; leaves hold one label each.

    Nodes lie in one list, leaves first. ``first`` and ``last`` say which rows
    (of a leaf) or nodes (of any other) belong to a node.
    """
    leaves = []
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        widest = np.argsort(-x[rows].var(axis=0), kind="stable")[:SLAB_COORDINATES]
        leaves += tiled(x, rows, widest)
    order = np.concatenate(leaves)
    x, labels = x[order], labels[order]
    ends = np.cumsum([len(leaf) for leaf in leaves])
    first, last = [ends - [len(leaf) for leaf in leaves]], [ends]
    low = [np.minimum.reduceat(x, first[0])]
    high = [np.maximum.reduceat(x, first[0])]
    least, most = [labels[first[0]]], [labels[first[0]]]
    base = 0
    while len(low[-1]) > 1:
        cuts = np.arange(0, len(low[-1]), FAN)
        first.append(base + cuts)
        last.append(base + np.minimum(cuts + FAN, len(low[-1])))
        base += len(low[-1])
        for levels, fold in ((low, np.minimum), (high, np.maximum), (least, np.minimum), (most, np.maximum)):
            levels.append(fold.reduceat(levels[-1], cuts))
    names = ("first", "last", "low", "high", "least", "most")
    tree = {k: np.concatenate(v) for k, v in zip(names, (first, last, low, high, least, most))}
    return tree | {"leaves": len(leaves), "x": x, "ids": ids[order], "numbers": numbers[order]}


def vectors_of(column, width):
    """A list column as a matrix of doubles, shorter lists padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = values
    return out


def packed_tiles(rows: DataFrame, width: int, tiles: int) -> DataFrame:
    """One row per tile, holding its tree; ``rows`` has number, id, label, x."""

    def tree(batches):
        parts = [np.concatenate(column) for column in zip(*batches)]
        x, labels, ids, numbers = parts
        least = np.min_scalar_type(-int(np.abs(x).max(initial=0)) - 1)
        found = grown(x, labels, ids, numbers)
        for name in ("x", "low", "high"):
            found[name] = found[name].astype(least)
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], ["tree"])

    def work(batches):
        held, n = [], 0
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "id", "number")]
            columns = [vectors_of(batch.column("x"), width), *columns]
            for start in range(0, batch.num_rows, TILE):
                part = [c[start : start + TILE] for c in columns]
                if n + len(part[0]) > TILE:
                    yield tree(held)
                    held, n = [], 0
                held.append(part)
                n += len(part[0])
        if n:
            yield tree(held)

    dealt = rows.repartitionByRange(tiles, "label", F.get("x", F.lit(0)), "number")
    return dealt.mapInArrow(work, "tree binary")


# Search ----------------------------------------------------------------------


class Best:
    """The k best (highest score, then smallest id) of each query."""

    def __init__(self, queries, k):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), NO_ID)
        self.n = np.zeros(queries, np.int64)

    @property
    def floor(self):
        """The k-th best score: lower ones cannot matter."""
        return self.score[:, -1]

    def add(self, query, score, ids):
        touched = np.unique(query)
        have = np.arange(self.k)[None, :] < self.n[touched, None]
        query = np.concatenate([query, np.repeat(touched, self.n[touched])])
        score = np.concatenate([score, self.score[touched][have]])
        ids = np.concatenate([ids, self.id[touched][have]])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        heads = np.flatnonzero(np.diff(query, prepend=-1))
        rank = np.arange(len(query)) - np.repeat(heads, np.diff(heads, append=len(query)))
        kept = rank < self.k
        query, rank = query[kept], rank[kept]
        self.score[query, rank], self.id[query, rank] = score[kept], ids[kept]
        np.maximum.at(self.n, query, rank + 1)


def searched(tree, x, label, number, low, high, best, same):
    """Add a tile's rows to ``best`` for a block of anchors, best box first.

    Anchor i has the windows ``low[i]`` to ``high[i]`` (one or several); window
    w of anchor i is query i * windows + w. ``same`` tells whether rows of the
    anchor's label are wanted (but never the anchor itself) or all others.
    """
    windows = low.shape[1]
    up, down = np.maximum(x, 0), np.minimum(x, 0)
    boxes_low, boxes_high = tree["low"].astype(np.float64).T, tree["high"].astype(np.float64).T
    most = up @ boxes_high + down @ boxes_low
    least = up @ boxes_low + down @ boxes_high
    if same:
        fits = (tree["least"] <= label[:, None]) & (label[:, None] <= tree["most"])
    else:
        fits = (tree["least"] != label[:, None]) | (label[:, None] != tree["most"])
    fits &= (least <= high.max(axis=1)[:, None]) & (most >= low.min(axis=1)[:, None])
    most = np.where(fits, most, -np.inf)
    promise = most.max(axis=0)
    root = len(promise) - 1
    queue = [(-promise[root], root)]
    # An anchor needs a box as long as one of its windows does.
    need = np.maximum(low, best.floor.reshape(low.shape)).min(axis=1)
    while queue:
        ahead, node = heapq.heappop(queue)
        if -ahead < need.min():
            break
        active = np.flatnonzero(fits[:, node] & (most[:, node] >= need))
        if not len(active):
            continue
        first, last = tree["first"][node], tree["last"][node]
        if node >= tree["leaves"]:
            for child in range(first, last):
                if promise[child] > -np.inf:
                    heapq.heappush(queue, (-promise[child], child))
            continue
        score = x[active] @ tree["x"][first:last].T.astype(np.float64)
        if same:
            score[number[active, None] == tree["numbers"][None, first:last]] = np.nan  # in no window
        floors = np.maximum(low, best.floor.reshape(low.shape))
        for w in range(windows):
            anchor, row = np.nonzero((score >= floors[active, w, None]) & (score <= high[active, w, None]))
            if len(anchor):
                query = active[anchor] * windows + w
                best.add(query, score[anchor, row], tree["ids"][first:last][row])
        need = np.maximum(low, best.floor.reshape(low.shape)).min(axis=1)


def search(tiles: DataFrame, anchors, low, high, k, same) -> DataFrame:
    """The best ``k`` rows for each window of each anchor, as each task found them.

    ``anchors`` is (number, label, x) of one wave, as arrays.
    """
    number, label, x = anchors
    shared = tiles.sparkSession.sparkContext.broadcast((number, label, x, low, high))

    def work(batches):
        number, label, x, low, high = shared.value
        windows = low.shape[1]
        blocks = [slice(i, i + BLOCK) for i in range(0, len(x), BLOCK)]
        best = [Best(low[block].size, k) for block in blocks]
        largest = np.abs(x).max(initial=0)
        for batch in batches:
            for stored in batch.column("tree").to_pylist():
                tree = pickle.loads(stored)
                # Doubles hold all products and sums exactly below this bound.
                if x.shape[1] * largest * np.abs(tree["x"].astype(np.float64)).max() >= 2.0**53:
                    raise ValueError("components too large for exact inner products")
                for block, found in zip(blocks, best):
                    searched(tree, x[block], label[block], number[block], low[block], high[block], found, same)
        for block, found in zip(blocks, best):
            query, rank = np.nonzero(np.arange(k)[None, :] < found.n[:, None])
            anchor, w = block.start + query // windows, query % windows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number[anchor]),
                    pa.array(low[anchor, w].clip(-(2.0**62), 2.0**62).astype(np.int64)),
                    pa.array(high[anchor, w].clip(-(2.0**62), 2.0**62).astype(np.int64)),
                    pa.array(found.score[query, rank].astype(np.int64)),
                    pa.array(found.id[query, rank]),
                ],
                ["anchor", "low", "high", "score", "id"],
            )

    return tiles.mapInArrow(work, FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` over all tasks."""
    order = Window.partitionBy("anchor", "low", "high").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# The operator ----------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return vector.isNotNull() & finite


def hard_negatives(
    rows: DataFrame, positives=5, negatives=3, low_percent=50, high_percent=95
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores.

    ``rows`` has id (long), label (long), x (array of whole doubles) and
    is_anchor. The window of a positive is from ``low_percent`` to
    ``high_percent`` of its score.
    """
    spark = rows.sparkSession
    refused = F.raise_error(F.lit("the largest long is not an id")).cast("long")
    known = F.when(F.col("id") == F.lit(int(NO_ID)), refused).otherwise(F.coalesce("id", F.lit(int(NO_ID))))
    rows = rows.select(
        F.monotonically_increasing_id().alias("number"), known.alias("id"), "label", "x", "is_anchor"
    )
    rows = staged(rows, "vectors")
    size = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    width = max(size[1] or 0, 1)
    tiles = staged(packed_tiles(rows.drop("is_anchor"), width, max(1, -(-size[0] // TILE))), "tiles")
    anchors = rows.where("is_anchor").select("number", "id", "label", "x", F.lit(1).alias("one"))
    anchors = anchors.withColumn("part", F.shiftright("number", 33))
    anchors = running_total(anchors, [], "part", ["number"], "one").withColumn(
        "wave", F.floor((F.col("running") - 1) / WAVE)
    )
    anchors = staged(anchors.select("number", "id", "label", "x", "wave"), "anchors")
    waves = [row.wave for row in anchors.groupBy("wave").count().orderBy("wave").collect()]
    done = [
        wave_of_negatives(tiles, anchors.where(F.col("wave") == wave), width, positives, negatives, low_percent, high_percent)
        for wave in waves
    ]
    if not done:
        return spark.createDataFrame([], RESULT)
    result = done[0]
    for more in done[1:]:
        result = result.unionAll(more)
    return result


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def wave_of_negatives(tiles, anchors, width, positives, negatives, low_percent, high_percent):
    """The result rows of one wave of anchors, written and read back."""
    held = anchors.select("number", "label", "x").toArrow().combine_chunks()
    held = held.to_batches()[0]
    x = vectors_of(held.column("x"), width)
    label, number = held.column("label").to_numpy(), held.column("number").to_numpy()
    order = np.lexsort((x[:, 0], label))  # similar anchors share a block
    x, label, number = x[order], label[order], number[order]
    everything = np.full((len(x), 1), np.inf)
    found = search(tiles, (number, label, x), -everything, everything, positives, True)
    best = ranked(found, positives).select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    low = F.ceil(F.lit(low_percent) * F.col("positive_score") / F.lit(100).cast("decimal(20,0)"))
    high = F.floor(F.lit(high_percent) * F.col("positive_score") / F.lit(100).cast("decimal(20,0)"))
    best = staged(best.withColumns({"low": low.cast("long"), "high": high.cast("long")}), "positives")

    # At most ``positives`` windows for each of the wave's anchors; no window is -inf to -inf.
    ends = best.where("low <= high").select("anchor", "low", "high").distinct().toPandas()
    ends["place"] = ends.groupby("anchor").cumcount()
    place = ends.anchor.map(dict(zip(number.tolist(), range(len(number))))).to_numpy(np.int64)
    windows = (np.full((len(x), positives), np.inf), np.full((len(x), positives), -np.inf))
    for window, name in zip(windows, ("low", "high")):
        window[place, ends.place] = ends[name]
    found = search(tiles, (number, label, x), *windows, negatives, False)
    real = lambda name: F.nullif(F.col(name), F.lit(int(NO_ID)))
    rows = (
        ranked(found, negatives)
        .join(best, ["anchor", "low", "high"])
        .join(anchors.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    )
    rows = rows.select(
        "anchor_id",
        real("positive").alias("positive_id"),
        "rank",
        real("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
    return staged(rows, "negatives")


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector; each 7th label is moved to the next first."""
    rows = read_table(spark, sf_dir, "embeddings").where(F.col("label").isNotNull() & usable(F.col("embedding")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select(
        F.col("vec_id").cast("long").alias("id"),
        moved.cast("long").alias("label"),
        F.transform("embedding", lambda c: F.floor(256 * c.cast("double")).cast("double")).alias("x"),
        F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)).alias("is_anchor"),
    )
    return hard_negatives(rows)


OP11_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS number, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len(list_filter(embedding, lambda c: isfinite(c)))
), anchors AS (
  SELECT * FROM usable WHERE vec_id % 50 = 0
), scores AS (
  SELECT a.number, a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
         list_inner_product(a.x, r.x)::BIGINT AS score
  FROM anchors a JOIN usable r ON a.number <> r.number
), positives AS (
  SELECT number, anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY number ORDER BY score DESC, id) <= 5
), negatives AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.number, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank
  FROM positives p JOIN scores s ON p.number = s.number AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""
