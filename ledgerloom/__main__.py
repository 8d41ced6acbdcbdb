"""Load a day or ask a question from the command line.

spark-submit or python -m ledgerloom load --data DIR --mart DIR --date 2024-01-31
python -m ledgerloom ask --mart DIR q1_monthly_net
"""

import argparse
import logging

from pyspark.sql import SparkSession

from .plans.business import QUESTIONS
from .plans.daily import LoadConfig, run_daily_load
from .session import configure
from .sinks import Mart


def arguments(given=None):
    parser = argparse.ArgumentParser(prog="ledgerloom")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="load the extracts of one day")
    load.add_argument("--data", required=True, help="folder with the extracts")
    load.add_argument("--mart", required=True, help="folder of the star schema")
    load.add_argument("--date", required=True, help="run date, YYYY-MM-DD")
    load.add_argument("--sales", default=LoadConfig.sales_name)
    load.add_argument("--history", default=LoadConfig.history_name)
    load.add_argument("--rejects", choices=["append", "replace"], default=LoadConfig.rejects)
    load.add_argument("--encoding", help="of delimited extracts; ISO-8859-1 if not given")
    load.add_argument("--multiline", action="store_true", help="quoted texts hold line breaks")
    ask = commands.add_parser("ask", help="answer a business question")
    ask.add_argument("--mart", required=True, help="folder of the star schema")
    ask.add_argument("question", choices=sorted(QUESTIONS))
    return parser.parse_args(given)


def main(given=None):
    logging.basicConfig(level=logging.INFO)
    options = arguments(given)
    spark = configure(SparkSession.builder.appName("ledgerloom").getOrCreate())
    if options.command == "load":
        reader = {"multiline": options.multiline}
        if options.encoding:
            reader["encoding"] = options.encoding
        config = LoadConfig(
            data_root=options.data,
            mart_root=options.mart,
            sales_name=options.sales,
            history_name=options.history,
            rejects=options.rejects,
            reader=reader,
        )
        return run_daily_load(spark, config, options.date)
    answer = QUESTIONS[options.question](Mart(spark, options.mart).tables())
    # All rows, a partition at a time: a report may be as long as its groups are many.
    print("\t".join(answer.columns))
    for row in answer.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))
    return answer


if __name__ == "__main__":
    main()
