"""A dirty two-source feed made from the given tables.

Mapping: FIXTURES.md, section 3. ``raw_frames`` yields the frames the sources
would deliver, with their own headers; ``feed`` yields the unified feed from a
single scan of the lines.
"""

from pyspark.sql import functions as F

from ledgerloom.constants import FEED_COLUMNS, HISTORY_SOURCE, SALES_SOURCE
from ledgerloom.session import configure
from ledgerloom.sources import tag_history_sheet, tag_sales, unify

SALES_FROM = "1998-01-01"
HISTORY_BEFORE = "1999-01-01"
SHEET_BREAK = "1997-01-01"
SUFFIXES = [" card holder", " led lamp", " scarf", " puzzle", " vase", ""]


def _lines(spark, folder):
    """Order lines joined with all the tables the feed is made from."""
    configure(spark)

    def table(name):
        return spark.read.parquet(f"{folder}/{name}.parquet")

    homes = table("customer").join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    # Orders meet their customers first, so that lines are moved for orders and parts only,
    # and texts are made where there are fewest rows.
    bills = table("orders").join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return (
        table("lineitem")
        .join(bills.select("*", *_bill_texts()), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table("part").select("*", *_part_texts()), F.col("l_partkey") == F.col("p_partkey"))
    )


def _choose(number, options):
    """options[number] as a chain of conditions."""
    chain = F.when(number == 0, options[0])
    for position, option in list(enumerate(options))[1:]:
        chain = chain.when(number == position, option)
    return chain


def _bill_texts():
    """What the feed says of an order's customer."""
    customer = F.col("o_custkey")
    key = customer.cast("string")
    buyer = _choose(
        F.pmod(customer, F.lit(6)),
        [
            F.lit(None).cast("string"),
            F.lit(""),
            F.concat(key, F.lit(".0")),
            F.concat(F.lit(" "), key, F.lit(" ")),
            F.lit("nan"),
            key,
        ],
    )
    country = F.when(F.pmod(customer, F.lit(50)) != 7, F.col("n_name"))
    return [buyer.alias("_buyer"), country.alias("_country")]


def _part_texts():
    """The ways in which the feed writes a part's name."""
    suffix = _choose(F.pmod(F.col("p_size"), F.lit(6)), [F.lit(s) for s in SUFFIXES])
    name = F.col("p_name")
    return [
        F.upper(F.concat(name, F.lit(" t-light"), suffix)).alias("_upper"),
        F.lower(F.concat(name, suffix)).alias("_lower"),
        F.concat(name, suffix).alias("_plain"),
    ]


def _texts(is_sale):
    """Feed columns of one line as text; ``is_sale`` tells the source."""
    h = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(97))
    n = F.pmod(F.col("l_linenumber"), F.lit(3))
    part = F.col("l_partkey").cast("string")
    shipped = F.col("l_shipdate")
    units = (F.col("l_quantity").cast("int") + F.when(is_sale, 0).otherwise(1)).cast("string")
    return {
        "invoice_no": F.col("l_orderkey").cast("string"),
        "stock_code": F.when(h == 3, "  ").otherwise(
            _choose(
                n,
                [
                    F.concat(F.lit("p"), part, F.lit("a")),
                    F.concat(F.lit(" P"), part, F.lit("A ")),
                    F.concat(F.lit("P"), part, F.lit("A")),
                ],
            )
        ),
        "description": F.when(
            F.col("l_linenumber") != 7,
            _choose(n, [F.col("_upper"), F.col("_lower"), F.col("_plain")]),
        ),
        "quantity": F.when(h == 1, "abc").otherwise(
            F.concat(F.when(F.col("l_returnflag") == "R", "-").otherwise(""), units)
        ),
        "invoice_date": F.when(h == 0, "not a date")
        .when(is_sale, F.date_format(shipped, "M/d/yyyy H:mm"))
        .otherwise(F.date_format(shipped, "yyyy-MM-dd HH:mm:ss")),
        "unit_price": F.when(h == 2, "-1").otherwise(
            F.col("p_retailprice").cast("decimal(10,2)").cast("string")
        ),
        "customer_id": F.col("_buyer"),
        "country": F.col("_country"),
    }


def feed(spark, folder, columns=FEED_COLUMNS):
    """The unified feed with the wanted columns, lines read once.

    Lines of the overlapping year occur in both sources.
    """
    shipped = F.col("l_shipdate")
    sold = shipped >= F.lit(SALES_FROM).cast("timestamp_ntz")
    old = shipped < F.lit(HISTORY_BEFORE).cast("timestamp_ntz")
    # Plain branches become compiled code, unlike functions over the items of an array.
    tags = F.when(sold & old, F.array(F.lit(SALES_SOURCE), F.lit(HISTORY_SOURCE)))
    tags = tags.when(sold, F.array(F.lit(SALES_SOURCE))).when(old, F.array(F.lit(HISTORY_SOURCE)))
    texts = _texts(F.col("_source") == SALES_SOURCE)
    tagged = _lines(spark, folder).withColumn("_source", F.explode(tags))
    return tagged.select(*[texts[c].alias(c) for c in FEED_COLUMNS if c in columns], "_source")


def raw_frames(spark, folder):
    """(sales, [history sheet, history sheet]) with the headers of the extracts."""
    lines = _lines(spark, folder)
    shipped = F.col("l_shipdate")
    start, end, middle = [
        F.lit(day).cast("timestamp_ntz") for day in (SALES_FROM, HISTORY_BEFORE, SHEET_BREAK)
    ]

    def extract(rows, is_sale, headers):
        texts = _texts(F.lit(is_sale))
        return rows.select(*[texts[c].alias(h) for c, h in zip(FEED_COLUMNS, headers)])

    sales_headers = [
        "InvoiceNo", "StockCode", "Description", "Quantity",
        "InvoiceDate", "UnitPrice", "CustomerID", "Country",
    ]
    sheet_headers = [
        "Invoice", "StockCode", "Description", "Quantity",
        "InvoiceDate", "Price", "Customer ID", "Country",
    ]
    sales = extract(lines.filter(shipped >= start), True, sales_headers)
    sheets = [
        extract(lines.filter(shipped < middle), False, sheet_headers),
        extract(lines.filter((shipped >= middle) & (shipped < end)), False, sheet_headers),
    ]
    return sales, sheets


def united_frames(spark, folder):
    """The feed through the source operators: rename, narrow, tag, stack."""
    sales, sheets = raw_frames(spark, folder)
    return unify([tag_sales(sales), *[tag_history_sheet(sheet) for sheet in sheets]])
