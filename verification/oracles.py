"""The same questions in SQL, straight from the given tables.

Statements are put together from named steps; each lists the steps it needs.
"""

from ledgerloom.constants import CATEGORY_KEYWORDS, NULL_TOKENS

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _quoted(words):
    return ", ".join(f"'{w}'" for w in words)


def _number(col):
    return f"CASE WHEN regexp_matches({col}, '{NUMBER}') THEN try_cast({col} AS double) END"


def _title(col):
    words = rf"regexp_extract_all({col}, '(\p{{L}}+|\P{{L}}+)', 1)"
    return (
        f"array_to_string(list_transform({words}, "
        "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), '')"
    )


def _money(value):
    return f"cast(round(cast({value} AS decimal(28, 10)), 2) AS double)"


def _percent(part, whole):
    quotient = f"cast({part} AS double) / nullif(cast({whole} AS double), 0) * 100"
    return _money(f"CASE WHEN {whole} > 0 THEN {quotient} ELSE 0 END")


def _category(col):
    cases = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({col}), '{w}')" for w in words) + f" THEN '{name}'"
        for name, words in CATEGORY_KEYWORDS.items()
    )
    return f"CASE WHEN upper({col}) IN ('', 'UNKNOWN') THEN 'UNCATEGORIZED' {cases} ELSE 'UNCATEGORIZED' END"


def _feed_half(source, is_sale, condition):
    date_format = "%-m/%-d/%Y %-H:%M" if is_sale else "%Y-%m-%d %H:%M:%S"
    return f"""
    SELECT
      cast(l_orderkey AS varchar) AS invoice_no,
      CASE WHEN (l_orderkey + l_linenumber) % 97 = 3 THEN '  '
           WHEN l_linenumber % 3 = 0 THEN 'p' || l_partkey || 'a'
           WHEN l_linenumber % 3 = 1 THEN ' P' || l_partkey || 'A '
           ELSE 'P' || l_partkey || 'A' END AS stock_code,
      CASE WHEN l_linenumber = 7 THEN NULL
           WHEN l_linenumber % 3 = 0 THEN upper(p_name || ' t-light' || suffix)
           WHEN l_linenumber % 3 = 1 THEN lower(p_name || suffix)
           ELSE p_name || suffix END AS description,
      CASE WHEN (l_orderkey + l_linenumber) % 97 = 1 THEN 'abc'
           ELSE (CASE WHEN l_returnflag = 'R' THEN '-' ELSE '' END)
                || (cast(l_quantity AS integer) + {0 if is_sale else 1}) END AS quantity,
      CASE WHEN (l_orderkey + l_linenumber) % 97 = 0 THEN 'not a date'
           ELSE strftime(l_shipdate, '{date_format}') END AS invoice_date,
      CASE WHEN (l_orderkey + l_linenumber) % 97 = 2 THEN '-1'
           ELSE cast(cast(p_retailprice AS decimal(10, 2)) AS varchar) END AS unit_price,
      CASE o_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ''
           WHEN 2 THEN o_custkey || '.0' WHEN 3 THEN ' ' || o_custkey || ' '
           WHEN 4 THEN 'nan' ELSE cast(o_custkey AS varchar) END AS customer_id,
      CASE WHEN o_custkey % 50 <> 7 THEN n_name END AS country,
      '{source}' AS _source
    FROM lines WHERE {condition}"""


STEPS = {}

STEPS["lines"] = """
    SELECT *, CASE p_size % 6 WHEN 0 THEN ' card holder' WHEN 1 THEN ' led lamp'
                  WHEN 2 THEN ' scarf' WHEN 3 THEN ' puzzle' WHEN 4 THEN ' vase'
                  ELSE '' END AS suffix
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey"""

STEPS["feed"] = (
    _feed_half("sales_csv", True, "l_shipdate >= DATE '1998-01-01'")
    + "\n    UNION ALL"
    + _feed_half("history_csv", False, "l_shipdate < DATE '1999-01-01'")
)

STEPS["typed"] = f"""
    SELECT invoice_no, upper(trim(coalesce(stock_code, ''))) AS stock_code,
      nullif(trim(description), '') AS spelling,
      {_number("quantity")} AS quantity,
      coalesce(try_strptime(invoice_date, '%m/%d/%Y %H:%M'),
               try_strptime(invoice_date, '%Y-%m-%d %H:%M:%S')) AS invoice_date,
      {_number("unit_price")} AS unit_price,
      customer_id, country, _source,
      CASE _source WHEN 'sales_csv' THEN 0 WHEN 'history_csv' THEN 1 END AS source_rank
    FROM feed"""

STEPS["routed"] = """
    SELECT *, CASE
        WHEN invoice_date IS NULL THEN 'fecha inválida o no parseable'
        WHEN quantity IS NULL OR unit_price IS NULL THEN 'quantity o unit_price no numérico'
        WHEN quantity > 0 AND unit_price <= 0 THEN 'venta con unit_price <= 0'
        WHEN length(stock_code) = 0 THEN 'stock_code vacío' END AS reason
    FROM typed"""

STEPS["named"] = f"""
    SELECT stock_code, name, n FROM (
      SELECT stock_code, name, count(*) AS n,
        row_number() OVER (PARTITION BY stock_code ORDER BY count(*) DESC, name) AS position
      FROM (SELECT stock_code, {_title("spelling")} AS name FROM routed WHERE spelling IS NOT NULL)
      GROUP BY stock_code, name)
    WHERE position = 1"""

STEPS["clean_customers"] = r"""
    SELECT * EXCLUDE (customer_id), regexp_replace(
        CASE WHEN customer_id IS NULL OR trim(customer_id) IN ('', 'nan') THEN 'ANONYMOUS'
             ELSE trim(customer_id) END, '\.0$', '') AS customer_id
    FROM routed WHERE reason IS NULL"""


def _kept(condition="true"):
    return f"""
    SELECT * EXCLUDE (position), cast(invoice_date AS date) AS date_id,
      CASE WHEN quantity > 0 THEN 'SALE' ELSE 'RETURN' END AS transaction_type,
      CASE WHEN quantity > 0 THEN quantity * unit_price END AS gross_revenue,
      CASE WHEN quantity <= 0 THEN abs(quantity) * unit_price END AS return_amount
    FROM (
      SELECT *, row_number() OVER (PARTITION BY invoice_no, stock_code
        ORDER BY source_rank NULLS LAST, invoice_date NULLS LAST, quantity NULLS LAST,
                 unit_price NULLS LAST, customer_id NULLS LAST, country NULLS LAST) AS position
      FROM clean_customers WHERE {condition})
    WHERE position = 1"""


def _products(named, kept):
    return f"""
    SELECT product_code, canonical_name, {_category("canonical_name")} AS category
    FROM (
      SELECT k.stock_code AS product_code, coalesce(n.name, 'UNKNOWN') AS canonical_name
      FROM (SELECT DISTINCT stock_code FROM {kept}) k
      LEFT JOIN {named} n ON k.stock_code = n.stock_code)"""


def _customers(kept):
    return f"""
    SELECT 'ANONYMOUS' AS customer_id, cast(NULL AS varchar) AS country, true AS is_anonymous
    UNION ALL
    SELECT customer_id, country, false FROM (
      SELECT customer_id, country, row_number() OVER (PARTITION BY customer_id
        ORDER BY transaction_type = 'RETURN', source_rank NULLS LAST, invoice_date NULLS LAST,
                 invoice_no NULLS LAST, stock_code NULLS LAST, country NULLS LAST) AS position
      FROM {kept} WHERE customer_id <> 'ANONYMOUS')
    WHERE position = 1"""


def _dates(kept):
    return f"""
    SELECT date_id, cast(year(date_id) AS integer) AS year,
      cast(quarter(date_id) AS integer) AS quarter, cast(month(date_id) AS integer) AS month,
      monthname(date_id) AS month_name, cast(strftime(date_id, '%W') AS integer) AS week,
      cast(day(date_id) AS integer) AS day,
      cast(isodow(date_id) - 1 AS integer) AS day_of_week, isodow(date_id) >= 6 AS is_weekend
    FROM (SELECT DISTINCT date_id FROM {kept} WHERE date_id IS NOT NULL)"""


def _fact(kept):
    return f"""
    SELECT invoice_no, stock_code AS product_code, customer_id, date_id, invoice_date,
      cast(trunc(quantity) AS integer) AS quantity,
      cast(unit_price AS decimal(10, 4)) AS unit_price,
      cast(coalesce(gross_revenue, -return_amount) AS decimal(14, 4)) AS gross_revenue,
      transaction_type, country, _source AS source
    FROM {kept}"""


def _daily(fact):
    return f"""
    SELECT date_id, product_code,
      sum(CASE WHEN transaction_type = 'SALE' THEN gross_revenue ELSE 0 END) AS gross_revenue,
      sum(CASE WHEN transaction_type = 'RETURN' THEN abs(gross_revenue) ELSE 0 END)
        AS return_amount,
      sum(gross_revenue) AS net_revenue,
      sum(CASE WHEN transaction_type = 'SALE' THEN quantity ELSE 0 END) AS total_sales_qty,
      sum(CASE WHEN transaction_type = 'RETURN' THEN abs(quantity) ELSE 0 END)
        AS total_return_qty
    FROM {fact} GROUP BY date_id, product_code"""


STEPS["kept"] = _kept()
STEPS["dim_products"] = _products("named", "kept")
STEPS["dim_customers"] = _customers("kept")
STEPS["dim_date"] = _dates("kept")
STEPS["fact"] = _fact("kept")
STEPS["daily"] = _daily("fact")

STEPS["totals"] = """
    SELECT p.product_code, p.canonical_name, p.category,
      sum(a.gross_revenue) AS gross, sum(a.return_amount) AS back, sum(a.net_revenue) AS net,
      sum(a.total_sales_qty) AS sold, sum(a.total_return_qty) AS returned
    FROM daily a JOIN dim_products p ON a.product_code = p.product_code
    GROUP BY ALL"""

# Four times the 75th percentiles: with n rows the rank is 3 * (n - 1) / 4, so the limit
# is a whole number of quarters between two neighbours, and no digit is lost.
REVIEW_LIMITS = """
ranked AS (
  SELECT *, 3 * (count(*) OVER () - 1) AS quarters,
    row_number() OVER (ORDER BY gross, product_code) - 1 AS gross_rank,
    row_number() OVER (ORDER BY rate, product_code) - 1 AS rate_rank FROM rated),
limits AS (
  SELECT sum(CASE WHEN gross_rank = quarters // 4 THEN 4 - quarters % 4
                  WHEN gross_rank = quarters // 4 + 1 THEN quarters % 4 ELSE 0 END
             * cast(gross AS decimal(28, 2))) AS gross_quarters,
         sum(CASE WHEN rate_rank = quarters // 4 THEN 4 - quarters % 4
                  WHEN rate_rank = quarters // 4 + 1 THEN quarters % 4 ELSE 0 END
             * cast(rate AS decimal(28, 2))) AS rate_quarters FROM ranked)"""

# A store loaded earlier with the history feed only.
STEPS["old_kept"] = _kept("_source = 'history_csv'")
STEPS["old_named"] = STEPS["named"].replace(
    "spelling IS NOT NULL", "spelling IS NOT NULL AND _source = 'history_csv'"
)
STEPS["old_products"] = _products("old_named", "old_kept")
STEPS["old_customers"] = _customers("old_kept")
STEPS["old_dates"] = _dates("old_kept")
STEPS["old_fact"] = _fact("old_kept")
STEPS["merged_fact"] = """
    SELECT *, 1 AS load_no FROM old_fact
    UNION ALL
    SELECT *, 2 AS load_no FROM fact f WHERE NOT EXISTS (
      SELECT 1 FROM old_fact o WHERE o.invoice_no = f.invoice_no
        AND o.product_code = f.product_code AND o.source = f.source)"""

NEEDS = {
    "feed": ["lines"],
    "typed": ["feed"],
    "routed": ["typed"],
    "named": ["routed"],
    "clean_customers": ["routed"],
    "kept": ["clean_customers"],
    "dim_products": ["named", "kept"],
    "dim_customers": ["kept"],
    "dim_date": ["kept"],
    "fact": ["kept"],
    "daily": ["fact"],
    "totals": ["daily", "dim_products"],
    "old_kept": ["clean_customers"],
    "old_named": ["routed"],
    "old_products": ["old_named", "old_kept"],
    "old_customers": ["old_kept"],
    "old_dates": ["old_kept"],
    "old_fact": ["old_kept"],
    "merged_fact": ["old_fact", "fact"],
}


def _with(steps, select):
    """``select`` preceded by the steps it needs, each after its own needs."""
    wanted = set()

    def add(step):
        if step not in wanted:
            wanted.add(step)
            for need in NEEDS.get(step, []):
                add(need)

    for step in steps.split():
        add(step)
    parts = [f"{name} AS ({STEPS[name]})" for name in STEPS if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n" + select.strip()


TEXT_TIME = "strftime({}, '%Y-%m-%d %H:%M:%S')"
DAILY_COLUMNS = """date_id, product_code, cast(gross_revenue AS double) AS gross_revenue,
  cast(return_amount AS double) AS return_amount, cast(net_revenue AS double) AS net_revenue,
  cast(total_sales_qty AS bigint) AS total_sales_qty,
  cast(total_return_qty AS bigint) AS total_return_qty"""
FACT_COLUMNS = f"""invoice_no, product_code, customer_id, date_id,
  {TEXT_TIME.format("invoice_date")} AS invoice_date, quantity,
  cast(unit_price AS double) AS unit_price, cast(gross_revenue AS double) AS gross_revenue,
  transaction_type, country, source"""

# Odd number texts; the same list is used by the query.
NUMBER_TEXTS = ["1d", "1_0", "0x1", "inf", "nan", "1,000", " 2 ", "1e3", ".5", "7.", "-", "+4.25"]

# Odd null markers and near misses; the same list is used by the query.
TOKEN_TEXTS = [*NULL_TOKENS, " NA", "Na", "none", "N/A ", "0", "-"]


def _pick(key, texts):
    cases = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(texts))
    return f"CASE ({key}) % {len(texts)} {cases} END"


EXTRACT_LINES = """
SELECT CASE WHEN k % 5 = 0 THEN short WHEN true AND k % 11 = 0 THEN short || rest || ',' ELSE short || rest END AS line,
  k, l_orderkey, l_partkey, l_returnflag
FROM (SELECT *, l_orderkey + l_linenumber AS k, ',1,12/1/2010 8:26,1.5,7,' || l_returnflag AS rest,
  l_orderkey || ',P' || l_partkey || ',' ||
  CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN '"a, ""b"", ' || l_partkey || '"' ELSE 'item ' || l_partkey END AS short
  FROM lineitem)"""

ORACLES = {
    "overlong_rows": f"""
SELECT line, 9 AS fields, 8 AS expected FROM ({EXTRACT_LINES}) WHERE k % 5 <> 0 AND k % 11 = 0""",
    "extract_read": """
SELECT cast(l_orderkey AS varchar) AS invoice_no,
  CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN 'a, "b", ' || l_partkey ELSE 'item ' || l_partkey END AS description,
  CASE WHEN (l_orderkey + l_linenumber) % 5 <> 0 THEN l_returnflag END AS country
FROM lineitem""",
    "sheet_counts": """
SELECT 'sheet=' || strftime(l_shipdate, '%Y-%m') AS sheet, count(*) AS n,
  count(*) FILTER (WHERE month(l_shipdate) % 3 <> 0) AS with_country
FROM lineitem GROUP BY ALL""",
    "feed_union": _with("feed", "SELECT * FROM feed"),
    "null_tokens": _with(
        "lines",
        f"""
SELECT text, value, coalesce(value, 'missing') AS filled, count(*) AS n
FROM (SELECT text, CASE WHEN text NOT IN ({_quoted(NULL_TOKENS)}) THEN text END AS value
      FROM (SELECT {_pick("l_orderkey + l_linenumber", TOKEN_TEXTS)} AS text FROM lineitem))
GROUP BY ALL""",
    ),
    "norm_code_title": _with(
        "feed",
        f"""
SELECT invoice_no, upper(trim(coalesce(stock_code, ''))) AS stock_code,
  {_title("trim(coalesce(description, ''))")} AS description FROM feed""",
    ),
    "parse_numbers": _with(
        "feed",
        f"""
SELECT text, {_number("text")} AS value, count(*) AS n
FROM (SELECT quantity AS text FROM feed UNION ALL SELECT unit_price FROM feed
      UNION ALL
      SELECT {_pick("l_orderkey + l_linenumber", NUMBER_TEXTS)} FROM lineitem)
GROUP BY ALL""",
    ),
    "parse_dates": _with(
        "typed",
        f"""
SELECT invoice_no, {TEXT_TIME.format("invoice_date")} AS invoice_date,
  cast(invoice_date AS date) AS date_id FROM typed""",
    ),
    "canonical_description": _with(
        "routed named",
        """
SELECT invoice_no, r.stock_code, coalesce(name, 'UNKNOWN') AS description
FROM routed r LEFT JOIN named n ON r.stock_code = n.stock_code""",
    ),
    "customer_norm": _with(
        "feed",
        r"""
SELECT invoice_no, customer_id, customer_id = 'ANONYMOUS' AS is_anonymous
FROM (SELECT invoice_no, regexp_replace(
        CASE WHEN customer_id IS NULL OR trim(customer_id) IN ('', 'nan') THEN 'ANONYMOUS'
             ELSE trim(customer_id) END, '\.0$', '') AS customer_id FROM feed)""",
    ),
    "route_reasons": _with(
        "routed", "SELECT invoice_no, stock_code, _source, reason AS reject_reason FROM routed"
    ),
    "reject_rows": _with(
        "routed named",
        f"""
SELECT _source AS source, nullif(invoice_no, '') AS raw_invoice_no,
  nullif(r.stock_code, '') AS raw_product_code, reason AS reject_reason,
  DATE '2024-01-01' AS run_date, coalesce(name, 'UNKNOWN') AS description,
  quantity, {TEXT_TIME.format("invoice_date")} AS invoice_date, unit_price, customer_id, country
FROM routed r LEFT JOIN named n ON r.stock_code = n.stock_code WHERE reason IS NOT NULL""",
    ),
    "run_metrics": _with(
        "routed kept",
        """
SELECT stage, source, cast(sum(n) AS bigint) AS n FROM (
  SELECT 'read' AS stage, _source AS source, count(*) AS n FROM routed GROUP BY ALL
  UNION ALL
  SELECT coalesce('rejected: ' || reason, 'accepted'), _source, count(*) FROM routed GROUP BY ALL
  UNION ALL
  SELECT lower(transaction_type), _source, count(*) FROM kept GROUP BY ALL
  UNION ALL
  SELECT 'duplicate', _source, count(*) FROM routed WHERE reason IS NULL GROUP BY ALL
  UNION ALL
  SELECT 'duplicate', _source, -count(*) FROM kept GROUP BY ALL)
GROUP BY stage, source""",
    ),
    "dedup_priority": _with(
        "kept",
        f"""
SELECT invoice_no, stock_code, _source, quantity, unit_price, customer_id, country,
  {TEXT_TIME.format("invoice_date")} AS invoice_date FROM kept""",
    ),
    "split_revenue": _with(
        "kept named",
        """
SELECT invoice_no, k.stock_code, transaction_type, coalesce(name, 'UNKNOWN') AS description,
  date_id, gross_revenue, return_amount
FROM kept k LEFT JOIN named n ON k.stock_code = n.stock_code""",
    ),
    "category_assign": _with("dim_products", "SELECT canonical_name, category FROM dim_products"),
    "category_histogram": _with(
        "kept dim_products",
        """
SELECT transaction_type, category, count(*) AS n
FROM kept JOIN dim_products ON stock_code = product_code GROUP BY ALL""",
    ),
    "dim_products": _with("dim_products", "SELECT * FROM dim_products"),
    "dim_customers": _with("dim_customers", "SELECT * FROM dim_customers"),
    "dim_date": _with("dim_date", "SELECT * FROM dim_date"),
    "fact_transactions": _with("fact", f"SELECT {FACT_COLUMNS} FROM fact"),
    "daily_revenue": _with("daily", f"SELECT {DAILY_COLUMNS} FROM daily"),
    "merge_upsert_products": _with(
        "dim_products old_products",
        """
SELECT coalesce(n.product_code, o.product_code) AS product_code,
  coalesce(n.canonical_name, o.canonical_name) AS canonical_name,
  coalesce(n.category, o.category) AS category,
  CASE WHEN o.product_code IS NULL THEN 2 ELSE 1 END AS created_by_load,
  CASE WHEN n.product_code IS NULL THEN 1 ELSE 2 END AS updated_by_load
FROM dim_products n FULL JOIN old_products o ON n.product_code = o.product_code""",
    ),
    "store_upsert_products": _with(
        "dim_products old_products",
        """
SELECT coalesce(n.product_code, o.product_code) AS product_code,
  coalesce(n.canonical_name, o.canonical_name) AS canonical_name,
  coalesce(n.category, o.category) AS category,
  o.product_code IS NOT NULL AND n.product_code IS NOT NULL AS updated_later
FROM dim_products n FULL JOIN old_products o ON n.product_code = o.product_code""",
    ),
    "merge_insert_customers": _with(
        "dim_customers old_customers",
        """
SELECT *, 1 AS load_no FROM old_customers
UNION ALL
SELECT *, 2 AS load_no FROM dim_customers
WHERE customer_id NOT IN (SELECT customer_id FROM old_customers)""",
    ),
    "merge_insert_dates": _with(
        "dim_date old_dates",
        """
SELECT *, 1 AS load_no FROM old_dates
UNION ALL
SELECT *, 2 AS load_no FROM dim_date WHERE date_id NOT IN (SELECT date_id FROM old_dates)""",
    ),
    "merge_insert_facts": _with("merged_fact", f"SELECT {FACT_COLUMNS}, load_no FROM merged_fact"),
    "store_insert_facts": _with("merged_fact", f"SELECT {FACT_COLUMNS}, load_no FROM merged_fact"),
    "store_agg_refresh": _with(
        "merged_fact",
        f"SELECT {DAILY_COLUMNS} FROM ({_daily('merged_fact')})",
    ),
    "agg_refresh": _with(
        "merged_fact",
        f"SELECT {DAILY_COLUMNS} FROM ({_daily('merged_fact')})",
    ),
    "reject_append": _with(
        "routed",
        """
SELECT run_date, _source AS source, reason AS reject_reason, count(*) AS n
FROM (SELECT DATE '2024-01-01' AS run_date, * FROM routed WHERE _source = 'history_csv'
      UNION ALL SELECT DATE '2024-01-02', * FROM routed)
WHERE reason IS NOT NULL GROUP BY ALL""",
    ),
    "check_keys": _with(
        "clean_customers",
        """
SELECT invoice_no, stock_code, count(*) AS n FROM clean_customers
GROUP BY invoice_no, stock_code HAVING count(*) > 1""",
    ),
    "check_fk": _with(
        "fact old_products old_customers old_dates",
        """
SELECT 'product_code' AS rule, product_code AS value, count(*) AS n FROM fact
WHERE product_code NOT IN (SELECT product_code FROM old_products) GROUP BY ALL
UNION ALL
SELECT 'customer_id', customer_id, count(*) FROM fact
WHERE customer_id NOT IN (SELECT customer_id FROM old_customers) GROUP BY ALL
UNION ALL
SELECT 'date_id', cast(date_id AS varchar), count(*) FROM fact
WHERE date_id NOT IN (SELECT date_id FROM old_dates) GROUP BY ALL""",
    ),
    "gate_violations": _with(
        "fact old_products old_customers old_dates",
        """
SELECT 'orphan:product_code' AS rule, count(DISTINCT product_code) AS keys, count(*) AS rows FROM fact
WHERE product_code NOT IN (SELECT product_code FROM old_products) HAVING count(*) > 0
UNION ALL
SELECT 'orphan:customer_id', count(DISTINCT customer_id), count(*) FROM fact
WHERE customer_id NOT IN (SELECT customer_id FROM old_customers) HAVING count(*) > 0
UNION ALL
SELECT 'orphan:date_id', count(DISTINCT date_id), count(*) FROM fact
WHERE date_id NOT IN (SELECT date_id FROM old_dates) HAVING count(*) > 0
UNION ALL
SELECT 'duplicate:invoice_no,customer_id', count(*), cast(sum(n) AS bigint) FROM
  (SELECT count(*) AS n FROM fact WHERE invoice_no IS NOT NULL AND customer_id IS NOT NULL
   GROUP BY invoice_no, customer_id HAVING count(*) > 1) HAVING count(*) > 0""",
    ),
    "check_nulls": _with(
        "routed",
        """
UNPIVOT (SELECT count(*) - count(invoice_no) AS invoice_no,
    count(*) - count(spelling) AS spelling, count(*) - count(quantity) AS quantity,
    count(*) - count(invoice_date) AS invoice_date, count(*) - count(unit_price) AS unit_price,
    count(*) - count(customer_id) AS customer_id, count(*) - count(country) AS country
  FROM routed)
ON COLUMNS(*) INTO NAME rule VALUE violations""",
    ),
    "check_range_length": _with(
        "routed",
        """
SELECT 'unit_price' AS rule, count(*) FILTER (WHERE unit_price IS NOT NULL
    AND try_cast(unit_price AS decimal(5, 2)) IS NULL) AS violations FROM routed
UNION ALL
SELECT 'quantity', count(*) FILTER (WHERE quantity IS NOT NULL
    AND try_cast(quantity AS decimal(3, 2)) IS NULL) FROM routed
UNION ALL
SELECT 'invoice_no', count(*) FILTER (WHERE length(invoice_no) > 4) FROM routed
UNION ALL
SELECT 'stock_code', count(*) FILTER (WHERE length(stock_code) > 5) FROM routed
UNION ALL
SELECT 'country', count(*) FILTER (WHERE length(country) > 8) FROM routed""",
    ),
    "q1_monthly_net": _with(
        "daily dim_date",
        f"""
SELECT d.year, d.month, d.month_name, {_money("sum(gross_revenue)")} AS ventas_brutas,
  {_money("sum(return_amount)")} AS devoluciones, {_money("sum(net_revenue)")} AS ventas_netas,
  cast(sum(total_sales_qty) AS bigint) AS unidades_vendidas
FROM daily a JOIN dim_date d ON a.date_id = d.date_id
GROUP BY d.year, d.month, d.month_name ORDER BY d.year, d.month""",
    ),
    "q2_category_returns": _with(
        "daily dim_products",
        f"""
SELECT p.category, {_money("sum(gross_revenue)")} AS revenue_bruto,
  {_money("sum(return_amount)")} AS total_devoluciones,
  {_percent("sum(return_amount)", "sum(gross_revenue)")} AS tasa_devolucion_pct
FROM daily a JOIN dim_products p ON a.product_code = p.product_code
GROUP BY p.category ORDER BY revenue_bruto DESC, p.category""",
    ),
    "q3a_top_net_revenue": _with(
        "totals",
        f"""
SELECT product_code, canonical_name, category, {_money("gross")} AS revenue_bruto,
  {_money("back")} AS devoluciones, {_money("net")} AS revenue_neto
FROM totals ORDER BY revenue_neto DESC, product_code LIMIT 10""",
    ),
    "q3b_top_return_rate": _with(
        "totals",
        f"""
SELECT product_code, canonical_name, category, cast(sold AS bigint) AS unidades_vendidas,
  cast(returned AS bigint) AS unidades_devueltas,
  {_percent("returned", "sold")} AS tasa_devolucion_pct
FROM totals WHERE sold >= 10 ORDER BY tasa_devolucion_pct DESC, product_code LIMIT 10""",
    ),
    "q4_countries": _with(
        "fact",
        f"""
SELECT country, count(DISTINCT invoice_no) AS num_facturas, count(*) AS num_lineas,
  {_money("sum(gross_revenue)")} AS revenue_total,
  {_money("cast(sum(gross_revenue) AS double) / count(*)")} AS ticket_promedio_por_linea,
  {_money("cast(sum(gross_revenue) AS double) / count(DISTINCT invoice_no)")}
    AS ticket_promedio_por_factura
FROM fact WHERE transaction_type = 'SALE' AND country IS NOT NULL
GROUP BY country ORDER BY revenue_total DESC, country""",
    ),
    "q5_customer_segments": _with(
        "fact dim_customers",
        f"""
SELECT is_anonymous, CASE WHEN is_anonymous THEN 'Sin customer_id (ANONYMOUS)'
    ELSE 'Cliente identificado' END AS tipo_cliente,
  count(DISTINCT invoice_no) AS num_facturas, count(*) AS num_lineas,
  {_money("sum(gross_revenue)")} AS revenue_total,
  {_money("cast(sum(gross_revenue) AS double) / count(*)")} AS ticket_promedio_linea,
  {_money("cast(sum(gross_revenue) AS double) / count(DISTINCT invoice_no)")}
    AS ticket_promedio_factura,
  {_money("cast(sum(quantity) AS double) / count(*)")} AS cantidad_promedio
FROM fact f JOIN dim_customers c ON f.customer_id = c.customer_id
WHERE transaction_type = 'SALE' GROUP BY is_anonymous ORDER BY is_anonymous""",
    ),
    "q4_countries_sketch": _with(
        "merged_fact",
        f"""
SELECT country, count(*) AS num_lineas, {_money("sum(gross_revenue)")} AS revenue_total,
  {_money("cast(sum(gross_revenue) AS double) / count(*)")} AS ticket_promedio_por_linea,
  true AS facturas_cerca
FROM merged_fact WHERE transaction_type = 'SALE' AND country IS NOT NULL GROUP BY country""",
    ),
    "q5_customer_segments_sketch": _with(
        "merged_fact dim_customers",
        f"""
SELECT is_anonymous, CASE WHEN is_anonymous THEN 'Sin customer_id (ANONYMOUS)'
    ELSE 'Cliente identificado' END AS tipo_cliente,
  count(*) AS num_lineas, {_money("sum(gross_revenue)")} AS revenue_total,
  {_money("cast(sum(gross_revenue) AS double) / count(*)")} AS ticket_promedio_linea,
  {_money("cast(sum(quantity) AS double) / count(*)")} AS cantidad_promedio,
  true AS facturas_cerca
FROM merged_fact f JOIN dim_customers c ON f.customer_id = c.customer_id
WHERE transaction_type = 'SALE' GROUP BY is_anonymous""",
    ),
    "q7_limits_sketch": _with(
        "totals",
        """
SELECT unnest(['gross_revenue', 'tasa_devolucion_pct']) AS limite, n AS rows, true AS near
FROM (SELECT count(*) AS n FROM totals WHERE sold >= 10)""",
    ),
    "q6a_product_count": _with(
        "dim_products",
        "SELECT count(DISTINCT product_code) AS total_productos_unicos FROM dim_products",
    ),
    "q6b_literal": _with(
        "fact dim_products",
        """
SELECT f.product_code, canonical_name, count(DISTINCT f.product_code) AS apariciones, category
FROM fact f JOIN dim_products p ON f.product_code = p.product_code
GROUP BY f.product_code, canonical_name, category HAVING count(*) > 0
ORDER BY apariciones DESC, f.product_code LIMIT 20""",
    ),
    "q6b_variants": _with(
        "routed dim_products",
        """
SELECT product_code, canonical_name, count(DISTINCT spelling) AS variantes, category
FROM routed JOIN dim_products ON stock_code = product_code
GROUP BY product_code, canonical_name, category HAVING count(DISTINCT spelling) > 1
ORDER BY variantes DESC, product_code LIMIT 20""",
    ),
    "q7_limits": _with(
        "totals",
        f"""
, rated AS (SELECT *, {_percent("returned", "sold")} AS rate FROM totals WHERE sold >= 10),
{REVIEW_LIMITS}
SELECT cast(gross_quarters AS double) / 4 AS gross_revenue,
  cast(rate_quarters AS double) / 4 AS tasa_devolucion_pct FROM limits""",
    ),
    "q7_review_candidates": _with(
        "totals",
        f"""
, rated AS (SELECT *, {_percent("returned", "sold")} AS rate FROM totals WHERE sold >= 10),
{REVIEW_LIMITS}
SELECT product_code, canonical_name, category, {_money("gross")} AS revenue_bruto,
  {_money("back")} AS devoluciones, {_money("net")} AS revenue_neto,
  rate AS tasa_devolucion_pct, cast(sold AS bigint) AS unidades_vendidas,
  cast(returned AS bigint) AS unidades_devueltas
FROM rated WHERE 4 * cast(gross AS decimal(28, 2)) >= (SELECT gross_quarters FROM limits)
  AND 4 * cast(rate AS decimal(28, 2)) >= (SELECT rate_quarters FROM limits)
ORDER BY back DESC, product_code LIMIT 15""",
    ),
}
