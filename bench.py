"""Time the daily load and the business questions.

Prints one JSON line. The extracts are written first, untimed: a sales file
set and two history sheets, as delimited text, from the given tables. Then a
warm-up load, a timed load into an empty store, a timed rerun, and each
question on the loaded tables (best of three, as they are warm).
"""

import json
import os
import time

from pyspark.sql import SparkSession

from ledgerloom.plans.business import QUESTIONS, q6b_variants
from ledgerloom.plans.daily import LoadConfig, run_daily_load
from ledgerloom.operators.catalogue import description_variants
from ledgerloom.session import configure, scratch_folder
from ledgerloom.sinks import Mart
from verification.feed import raw_frames

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUN_DATE = "2024-01-01"


def session():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgerloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        # Files and partitions of a few megabytes, as the data has tens of them.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def write_extracts(spark, root):
    sales, sheets = raw_frames(spark, FOLDER)
    extracts = {"sales.csv": sales, "history/sheet1": sheets[0], "history/sheet2": sheets[1]}
    for name, rows in extracts.items():
        rows.write.option("encoding", "ISO-8859-1").csv(f"{root}/{name}", header=True)


def seconds(work):
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main():
    spark = session()
    extracts = scratch_folder(spark)
    write_extracts(spark, extracts)

    def config():
        # The staged rows stay: the question about spellings reads them.
        return LoadConfig(data_root=extracts, mart_root=scratch_folder(spark), keep_staging=True)

    timings = {}
    run_daily_load(spark, config(), RUN_DATE)
    timed = config()
    timings["daily_load"] = seconds(lambda: run_daily_load(spark, timed, RUN_DATE))
    timings["daily_load_rerun"] = seconds(lambda: run_daily_load(spark, timed, RUN_DATE))

    tables = Mart(spark, timed.mart_root).tables()
    routed = spark.read.parquet(timed.staging("routed", RUN_DATE))
    asks = {name: (lambda ask=ask: ask(tables)) for name, ask in QUESTIONS.items()}
    asks["q6b_variants"] = lambda: q6b_variants(
        description_variants(routed, tables["dim_products"])
    )
    for name, ask in asks.items():
        timings[name] = min(seconds(lambda: ask().collect()) for _ in range(3))

    total = round(sum(timings.values()), 3)
    report = {
        "metric": "daily_load_and_questions",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
