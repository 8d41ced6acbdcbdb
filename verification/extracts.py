"""Delimited extracts with the faults that readers must meet, made from the given tables."""

from pyspark.sql import functions as F

from ledgerloom.constants import HISTORY_HEADERS, SALES_HEADERS
from ledgerloom.session import scratch_folder


def _lines(spark, folder):
    return spark.read.parquet(f"{folder}/lineitem.parquet")


def broken_extract(spark, folder, overlong):
    """A sales extract of all order lines; returns its path.

    Every fifth row is short (three fields), every seventh has separators and
    quotes inside a quoted field, and, if ``overlong``, every eleventh has a
    ninth field.
    """
    key = F.col("l_orderkey") + F.col("l_linenumber")
    name = F.when(key % 7 == 0, F.concat(F.lit('"a, ""b"", '), "l_partkey", F.lit('"'))).otherwise(
        F.concat(F.lit("item "), "l_partkey")
    )
    short = F.concat_ws(",", "l_orderkey", F.concat(F.lit("P"), "l_partkey"), name)
    whole = F.concat_ws(",", short, F.lit("1,12/1/2010 8:26,1.5,7"), "l_returnflag")
    line = F.when(key % 5 == 0, short).when(F.lit(overlong) & (key % 11 == 0), F.concat(whole, F.lit(","))).otherwise(whole)
    path = scratch_folder(spark) + "/sales"
    # Whole lines as one field: the writer puts the header, that field's name, on top of each file.
    form = {"sep": "\u0001", "quote": "", "header": True, "escapeQuotes": False}
    rows = _lines(spark, folder).select(line.alias(",".join(SALES_HEADERS)))
    # Several files even of a small table, and as many as its scan has tasks of a large one.
    rows.repartition(max(3, rows.rdd.getNumPartitions())).write.options(**form).csv(path)
    return path


def many_sheets(spark, folder):
    """One sheet per month of shipping, every third without a country; returns their folder."""
    root = scratch_folder(spark)
    month = F.date_format("l_shipdate", "yyyy-MM").alias("sheet")
    values = ["l_orderkey", "l_partkey", F.lit("x"), F.lit("1"), F.lit("2009-12-01 07:45:00"), F.lit("1.5"), F.lit("7")]
    texts = [value.cast("string") if not isinstance(value, str) else F.col(value).cast("string") for value in values]
    headers = list(HISTORY_HEADERS)
    rows = _lines(spark, folder).select(*[t.alias(h) for t, h in zip(texts, headers)], F.col("l_returnflag").alias(headers[-1]), month)
    bare = F.month(F.to_date("sheet", "yyyy-MM")) % 3 == 0
    rows = rows.repartition("sheet")
    rows.filter(~bare).write.partitionBy("sheet").csv(f"{root}/sheets", header=True)
    rows.filter(bare).drop(headers[-1]).write.mode("append").partitionBy("sheet").csv(f"{root}/sheets", header=True)
    return f"{root}/sheets"
