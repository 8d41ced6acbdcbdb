"""Names, word lists and texts the results depend on.

Everything in this file is a fixed value: it must stay exactly as written for
the results to be right.
"""

# Columns of the unified feed, all text on arrival.
FEED_COLUMNS = [
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
]

# Headers of the sales file and of the history sheets.
SALES_HEADERS = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}
HISTORY_HEADERS = {
    "Invoice": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "Price": "unit_price",
    "Customer ID": "customer_id",
    "Country": "country",
}

# Source tags, best first, and transaction types.
SALES_SOURCE = "sales_csv"
HISTORY_SOURCE = "history_csv"
SOURCE_PRIORITY = [SALES_SOURCE, HISTORY_SOURCE]
SALE = "SALE"
RETURN = "RETURN"

# Texts that mean "no value" in a delimited file.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Date layouts accepted in the feed, tried in this order.
DATE_FORMATS = [
    "M/d/yyyy H:mm", "yyyy-MM-dd HH:mm[:ss[.SSSSSSSSS]]",
    "yyyy-MM-dd'T'HH:mm[:ss[.SSSSSSSSS]]", "yyyy-MM-dd",
]

# Stand-ins for missing keys and names.
ANONYMOUS = "ANONYMOUS"
UNKNOWN = "UNKNOWN"
UNCATEGORIZED = "UNCATEGORIZED"
UNKNOWN_SOURCE = "unknown"

# Reject reasons, in the order in which the rules are tried.
BAD_DATE = "fecha inválida o no parseable"
BAD_NUMBER = "quantity o unit_price no numérico"
BAD_PRICE = "venta con unit_price <= 0"
BAD_CODE = "stock_code vacío"
UNKNOWN_REASON = "unknown"

# Labels of the customer segments.
ANONYMOUS_LABEL = "Sin customer_id (ANONYMOUS)"
IDENTIFIED_LABEL = "Cliente identificado"

# Category keywords; the first category with a hit wins.
CATEGORY_KEYWORDS = {
    "PAPELERIA": [
        "card", "notebook", "book", "pen", "pencil", "sticker", "tape",
        "paper", "envelope", "postcard", "sign", "letter", "tag", "label",
        "note", "diary", "calendar", "wrapping",
    ],
    "ELECTRONICA": [
        "led", "battery", "batteries", "cable", "charger", "plug", "usb",
        "solar", "electric", "light string", "fairy light", "string light",
    ],
    "ROPA": [
        "shirt", "dress", "coat", "hanger", "scarf", "hat", "sock", "glove",
        "shoe", "belt", "jacket", "blouse", "skirt", "trouser", "pant",
        "apron", "bib", "babygrow",
    ],
    "DEPORTES": [
        "ball", "sport", "gym", "fitness", "yoga", "run", "bike", "swim",
        "game", "play", "toy", "puzzle", "dart", "skipping", "kite",
    ],
    "HOGAR": [
        "candle", "holder", "lantern", "heart", "cushion", "tin", "box",
        "jar", "frame", "clock", "mirror", "lamp", "kitchen", "garden",
        "storage", "basket", "bowl", "plate", "mug", "cup", "glass", "vase",
        "bottle", "tray", "rack", "shelf", "drawer", "light", "bag",
        "bunting", "wreath", "garland", "decoration", "decor", "hanging",
        "metal", "wooden", "ceramic", "vintage", "retro", "floral", "rose",
        "polka", "spotty", "stripe", "wrap",
    ],
}
