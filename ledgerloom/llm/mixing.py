"""Mix sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a seeded digest and lined up, up to
``max_repeats`` times over. A copy's virtual finish time is its source's
cumulative words divided by the source's target, so at virtual time 1 every
source has given its target. All copies are ordered by finish time and cut
where their words reach the total budget.

Only sums travel: the finish range is narrowed, a thousand parts at a time, to
the part where the budget is reached, and only that part is sorted. Finish
times rise along a source's line, so the documents taken a k-th time are the
start of that line: :func:`mix_documents` keeps the last place of each start
and judges every document where it is, without moving texts.

Defined cases: a null text has no words; a null source is a source of its own,
after the others; documents without words, and sources without words or with
no positive weight, are taken 0 times; equal ids are ordered by size, then by
text; equal rows are taken one by one like others; an empty table gives an
empty result. Input columns are carried in one struct, so their names do not
matter.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    bucket_offsets,
    hex_digits,
    packed,
    read_table,
    running_total,
    staged,
    word_count,
)

SEED = "mix-1"
MAX_REPEATS = 3
PARTS = 1000
SORTED_AT_ONCE = 10_000
# Weights of the sources in their order, repeating (fixed by the contract).
WEIGHTS = (5, 2, 1)


def ranked_weights(sources: DataFrame, weights=WEIGHTS) -> DataFrame:
    """Weights by a source's place: by code point, null last. One row per source."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    values = F.array(*[F.lit(w) for w in weights])
    return sources.withColumn("weight", F.get(values, place % len(weights)).cast("long"))


def fill_targets(sources: DataFrame, max_repeats=MAX_REPEATS) -> DataFrame:
    """Add ``target``: shares of all words by weight, none above ``max_repeats`` times its source.

    Needs ``source_size`` and ``weight``. The level (words per unit of weight)
    rises until no further source is full; each round collects one row.
    """
    weight = F.greatest(F.coalesce("weight", F.lit(0)), F.lit(0))
    most = F.col("source_size") * max_repeats
    level = 0.0
    while True:
        full = most <= F.lit(level) * weight
        row = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("words"),
            F.coalesce(F.sum(F.when(full & (weight > 0), most)), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~full, weight)), F.lit(0)).alias("open"),
        ).first()
        now = float(row.words - row.fixed) / float(row.open) if row.open else level
        if now <= level:
            break
        level = now
    target = F.least(most.cast("double"), F.lit(level) * weight)
    return sources.withColumn("target", target)


def _lined(docs, digits):
    """Add the source key, the shuffle digest and its bucket to rows with doc_id, source, size."""
    source = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    digest = F.md5(F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return docs.withColumn("skey", source).withColumn("digest", digest).withColumn(
        "bucket", F.substring("digest", 1, digits)
    )


ORDER = ("digest", "doc_id", "size", "tie")


@dataclass
class Mix:
    """The plan of a mix: starts of the buckets with their source's target, and the cut."""

    starts: DataFrame
    digits: int
    cut: tuple[float, str] | None
    max_repeats: int

    def attach(self, docs: DataFrame) -> DataFrame:
        """Add source_size, target, finish times and times taken to rows with doc_id, source, size, tie."""
        return self.taken(docs).drop("skey", "digest", "bucket", "running")

    def taken(self, docs: DataFrame) -> DataFrame:
        """As :meth:`attach`, with the place in the source's line."""
        lined = running_total(
            _lined(docs, self.digits), ["skey"], "bucket", ORDER, "size", self.starts
        )
        return with_taken(lined, self.cut, self.max_repeats)

    def ends(self, docs: DataFrame) -> DataFrame:
        """Per source key, where the documents taken once, twice, ... end in its line.

        ``ends`` holds a struct for each: the last place ``at``, and how many of
        the rows that share that place are taken (``among``).
        """
        alike = Window.partitionBy("skey", "bucket").orderBy(*ORDER)
        among = F.row_number().over(alike) - F.rank().over(alike) + 1
        taken = self.taken(docs).withColumn("among", among).where("times > 0")
        taken = staged(taken.select("skey", *ORDER, "running", "times", "among"), "taken")
        copies = range(self.max_repeats)
        last = taken.groupBy("skey").agg(
            *[F.max(F.when(F.col("times") > k, F.col("running"))).alias(f"last_{k}") for k in copies]
        )
        ends = F.filter(F.array(*[f"last_{k}" for k in copies]), lambda x: x == F.col("running"))
        end = F.struct(F.struct(*ORDER).alias("at"), "among")
        found = taken.join(last, "skey").select("skey", end.alias("end"), F.explode(ends))
        return found.groupBy("skey").agg(F.collect_list("end").alias("ends"))


def finish_times(max_repeats):
    """Virtual finish times of a row's copies."""
    copies = F.array(*[F.lit(k) for k in range(max_repeats)])
    return F.transform(
        copies, lambda k: (k * F.col("source_size") + F.col("running")).cast("double") / F.col("target")
    )


def with_taken(lined, cut, max_repeats):
    if cut is None:
        return lined.withColumn("times", F.lit(0))
    last, source = cut
    inside = lambda v: (v < last) | ((v == last) & (F.col("skey") <= source))
    kept = F.size(F.filter(finish_times(max_repeats), inside))
    takes = (F.col("size") > 0) & (F.col("target") > 0)
    return lined.withColumn("times", F.when(takes, kept).otherwise(0))


def plan_mix(docs: DataFrame, weights=ranked_weights, max_repeats=MAX_REPEATS) -> Mix:
    """Find targets and the cut from rows with doc_id, source, size, tie.

    ``weights`` takes one row per source (source, source_size) and adds weight.
    """
    rows = docs.count()
    digits = hex_digits(rows)
    lined = _lined(docs, digits)
    totals = lined.groupBy("source", "skey").agg(F.sum("size").alias("source_size"))
    targets = fill_targets(staged(weights(totals), "weights"), max_repeats)
    starts = bucket_offsets(lined, ["skey"], "bucket", "size")
    starts = starts.join(targets.select("skey", "source_size", "target"), "skey")
    starts = staged(starts, "starts")
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    takes = lined.where("size > 0")
    queue = running_total(takes, ["skey"], "bucket", ORDER, "size", starts).where("target > 0")
    queue = staged(queue.select("skey", "size", "source_size", "target", "running"), "queue")
    items = queue.select("skey", "size", F.explode(finish_times(max_repeats)).alias("finish"))
    return Mix(starts, digits, find_cut(items, budget), max_repeats)


def find_cut(items, budget):
    """The last copy, by (finish, skey), up to which all words fit the budget; null if none."""
    low, high, rows, seen = 0.0, None, None, 0
    first = items.agg(F.max("finish"), F.count("*")).first()
    if not first[1]:
        return None
    high, rows = first
    part = items
    while rows > SORTED_AT_ONCE and high > low:
        step = (high - low) / PARTS
        place = F.least(F.floor((F.col("finish") - low) / step), F.lit(PARTS - 1))
        sums = part.groupBy(place.alias("place")).agg(
            F.sum("size"), F.count("*"), F.min("finish"), F.max("finish")
        )
        chosen = None
        for _, size, count, least, most in sorted(sums.collect()):
            chosen = (least, most, count)
            if seen + size > budget:
                break
            seen += size
        else:
            return (high, "t")
        if chosen[:2] == (low, high):
            break
        low, high, rows = chosen
        part = items.where((F.col("finish") >= low) & (F.col("finish") <= high))
    cut = (low, "") if low else None
    for finish, skey, size in (
        part.select("finish", "skey", "size").orderBy("finish", "skey").toLocalIterator()
    ):
        if seen + size > budget:
            break
        seen += size
        cut = (finish, skey)
    return cut


def sized(docs: DataFrame) -> DataFrame:
    """Documents as one struct each, with what mixing needs."""
    tie = F.xxhash64("text")
    return packed(docs, "doc_id", "source", word_count(F.col("text")).alias("size"), tie.alias("tie"))


def mix_documents(docs: DataFrame, weights=ranked_weights, max_repeats=MAX_REPEATS) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, in the columns of ``docs``."""
    rows = sized(docs)
    sizes = staged(rows.drop("row"), "sizes")
    plan = plan_mix(sizes, weights, max_repeats)
    ends = staged(plan.ends(sizes), "ends")
    # One row per source: broadcast while Spark measures it as small, else dealt by source.
    placed = _lined(rows.where("size > 0"), plan.digits).join(ends, "skey")
    placed = placed.select("row", "skey", F.struct(*ORDER).alias("place"), "ends")
    times = F.size(F.filter("ends", lambda end: end["at"] > F.col("place")))
    before = placed.withColumn("times", times).where("times > 0")
    before = before.withColumn("copy", F.explode(F.expr("array_repeat(1, times)")))
    return before.select("row.*").unionByName(at_ends(placed).select("row.*"))


def at_ends(placed: DataFrame) -> DataFrame:
    """Rows that stand at an end of their source's line, as often as they are taken there.

    Only rows equal in id, size and text share a place. Equal ones become one row
    with their number before they are dealt.
    """
    here = F.filter("ends", lambda end: end["at"] == F.col("place"))
    here = placed.withColumn("here", F.transform(here, lambda end: end["among"])).where(F.size("here") > 0)
    micros = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    alike = here.groupBy("skey", "place", F.md5(F.to_json("row", micros)).alias("kind")).agg(
        F.first("row").alias("row"), F.first("here").alias("here"), F.count("*").alias("n")
    )
    line = Window.partitionBy("skey", "place").orderBy("kind")
    earlier = F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    # Of each end's rows those go first that come first by kind.
    share = lambda among: F.greatest(F.least(among - F.col("earlier"), F.col("n")), F.lit(0))
    times = F.aggregate(F.transform("here", share), F.lit(0).cast("long"), lambda x, y: x + y)
    taken = alike.withColumn("earlier", earlier).withColumn("times", times.cast("int")).where("times > 0")
    return taken.withColumn("copy", F.explode(F.expr("array_repeat(1, times)")))


def mix_sequence(docs: DataFrame, weights=ranked_weights, max_repeats=MAX_REPEATS) -> DataFrame:
    """The taken copies of all documents in the order of the mix (doc_id, source, copy, finish)."""
    sizes = staged(sized(docs).drop("row"), "sizes")
    plan = plan_mix(sizes, weights, max_repeats)
    lined = running_total(
        _lined(sizes, plan.digits), ["skey"], "bucket", ORDER, "size", plan.starts
    )
    taken = with_taken(lined, plan.cut, max_repeats).where("times > 0")
    finish = F.slice(finish_times(max_repeats), F.lit(1), F.col("times"))
    return taken.select("doc_id", "source", "skey", F.posexplode(finish).alias("copy", "finish")).orderBy(
        "finish", "skey", "copy"
    )


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    """How often each document enters a mix of all sources."""
    docs = read_table(spark, sf_dir, "documents")
    sizes = staged(
        docs.select(
            "doc_id", "source", word_count(F.col("text")).alias("size"), F.lit(0).alias("tie")
        ),
        "sizes",
    )
    taken = (F.col("size") * F.col("times")).cast("long").alias("taken")
    return plan_mix(sizes).attach(sizes).select("doc_id", "size", "source_size", "target", taken)


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS skey,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, '-')) AS digest
  FROM documents
), sources AS (
  SELECT skey, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM docs GROUP BY source, skey
), steps AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
            / (sum(weight) OVER rest)::DOUBLE AS level
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY 3.0 * source_size / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), filled AS (
  SELECT arg_min(level, (3.0 * source_size / weight, skey)) AS level FROM steps WHERE level * weight < 3 * source_size
), targets AS (
  SELECT skey, source_size, least((3 * source_size)::DOUBLE, coalesce(level, 0) * weight) AS target
  FROM sources, filled
), queue AS (
  SELECT d.doc_id, d.skey, d.size, t.source_size, t.target, row_number() OVER () AS rid,
         sum(d.size) OVER (PARTITION BY d.skey ORDER BY d.digest, d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING) AS running
  FROM docs d JOIN targets t USING (skey)
), items AS (
  SELECT q.*, (k * source_size + running)::DOUBLE / target AS finish
  FROM queue q, (VALUES (0), (1), (2)) c(k) WHERE size > 0 AND target > 0
), summed AS (
  SELECT rid, size, sum(size) OVER (ORDER BY finish, skey ROWS UNBOUNDED PRECEDING) AS upto,
         (SELECT sum(source_size) FROM sources) AS budget
  FROM items
), taken AS (
  SELECT rid, sum(size) AS taken FROM summed WHERE upto <= budget GROUP BY rid
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM queue LEFT JOIN taken USING (rid)
"""
