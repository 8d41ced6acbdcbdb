"""Row counts per stage of a run."""

from pyspark.sql import functions as F


def routing_counts(routed):
    """Rows per source and reject reason (null reason: accepted)."""
    return routed.groupBy("_source", "_reject_reason").agg(F.count("*").alias("n"))


def run_metrics(routed, kept):
    """(stage, source, n): rows read, rejected by rule, dropped, sold, returned.

    ``kept`` are the deduplicated rows. Both inputs shrink to a handful of
    rows before anything is shuffled. Duplicates are accepted minus kept.
    """

    def tally(counts, stages):
        entry = F.explode(F.filter(stages, lambda s: s["stage"].isNotNull())).alias("entry")
        return counts.select(F.col("_source").alias("source"), entry).select(
            "entry.stage", "source", "entry.n"
        )

    def entry(stage, n):
        return F.struct(stage.alias("stage"), n.alias("n"))

    n, reason = F.col("n"), F.col("_reject_reason")
    ended = kept.groupBy("_source", "transaction_type").agg(F.count("*").alias("n"))
    routing = tally(
        routing_counts(routed),
        F.array(
            entry(F.lit("read"), n),
            entry(F.coalesce(F.concat(F.lit("rejected: "), reason), F.lit("accepted")), n),
            entry(F.when(reason.isNull(), F.lit("duplicate")), n),
        ),
    )
    outcome = tally(
        ended,
        F.array(entry(F.lower("transaction_type"), n), entry(F.lit("duplicate"), -n)),
    )
    return routing.unionByName(outcome).groupBy("stage", "source").agg(F.sum("n").alias("n"))


def sheet_counts(routed):
    """(sheet, n): rows read from each sheet of the history; none where sheets are not named."""
    if "_sheet" not in routed.columns:
        return routed.limit(0).select(F.lit("").alias("sheet"), F.lit(0).cast("long").alias("n"))
    named = routed.filter(F.col("_sheet").isNotNull())
    return named.groupBy(F.col("_sheet").alias("sheet")).agg(F.count("*").alias("n")).orderBy("sheet")
