"""The two transaction feeds, as frames of text columns."""

import csv
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    FEED_COLUMNS,
    HISTORY_HEADERS,
    HISTORY_SOURCE,
    NULL_TOKENS,
    SALES_HEADERS,
    SALES_SOURCE,
)
from ..functions import null_tokens

# The sheet a row is from, where it is from one.
SHEET = "_sheet"


def tag_sales(raw):
    """Sales file headers to feed columns; a missing column is an error."""
    return (
        raw.withColumnsRenamed(SALES_HEADERS)
        .select(*FEED_COLUMNS)
        .withColumn("_source", F.lit(SALES_SOURCE))
    )


def tag_history_sheet(raw):
    """History sheet headers to feed columns; a sheet may lack some. A sheet's name is kept."""
    named = raw.withColumnsRenamed(HISTORY_HEADERS)
    present = [name for name in [*FEED_COLUMNS, SHEET] if name in named.columns]
    return named.select(*present).withColumn("_source", F.lit(HISTORY_SOURCE))


def unify(frames):
    """Stack frames by column name, nulls where one lacks a column."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    gaps = [F.lit(None).cast("string").alias(c) for c in FEED_COLUMNS if c not in stacked.columns]
    sheet = [SHEET] if SHEET in stacked.columns else []
    return stacked.select("*", *gaps).select(*FEED_COLUMNS, "_source", *sheet)


# Delimited text --------------------------------------------------------------

# What no line of text contains: with it as separator, a line is read as one field.
NO_SEPARATOR = "\u0000"
FORM = {"sep": ",", "quote": '"', "escape": '"'}
BROKEN = "_broken_row"


def count_fields(line):
    """Fields of a delimited line; separators inside quotes do not count.

    Doubled quotes are dropped first, so a quoted part is one without quotes in
    it, and the pattern needs no nested repetition. Each match starts with a
    separator, as one is put in front.
    """
    bare = F.concat(F.lit(","), F.replace(line, F.lit('""'), F.lit("")))
    quoted = F.regexp_count(bare, F.lit(r',(?:"[^"]*+(?:"|$))?[^,]*+'))
    plain = F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) + 1
    return F.when(line.contains('"'), quoted).otherwise(plain)


def _lines(spark, files, header, encoding):
    """The lines below the headers of ``files`` as they are, and the file of each.

    The header is the name of the only column, so Spark itself skips it at the
    start of each file and stops at a file that has another one.
    """
    kind = T.StructType([T.StructField(header, T.StringType())])
    form = dict(header=True, enforceSchema=False, encoding=encoding, mode="FAILFAST")
    lines = spark.read.csv(files, schema=kind, sep=NO_SEPARATOR, quote="", **form)
    column = "`" + header.replace("`", "``") + "`"
    return lines.select(F.col(column).alias("line"), _file().alias("file"))


def _file():
    return F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")


def _parsed(lines, names):
    """Fields of each line; stops at a line with more of them than ``names``, fills up a shorter one.

    The fields are counted on the whole line, whatever columns a plan needs.
    They leave through a one-row generator, so that a line is parsed once and
    not again for every column of it.
    """
    message = F.concat(F.lit("more fields than the header has: "), F.col("line"))
    surplus = count_fields(F.col("line")) > len(names)
    whole = lines.where(F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(True))
    kind = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = whole.select("file", F.inline(F.array(F.from_csv("line", kind, FORM))))
    return rows.select(*[F.col(f"c{i}").alias(name) for i, name in enumerate(names)], "file")


def _multiline(spark, files, names, encoding):
    """As ``_parsed``, where quoted texts hold line breaks (a file is then not split between tasks)."""
    kind = T.StructType([T.StructField(n, T.StringType()) for n in names]).add(BROKEN, "string")
    form = dict(header=True, enforceSchema=False, encoding=encoding, multiLine=True)
    reader = spark.read.option("columnPruning", False)
    rows = reader.csv(files, schema=kind, columnNameOfCorruptRecord=BROKEN, **FORM, **form)
    message = F.concat(F.lit("more fields than the header has: "), F.col(BROKEN))
    first = F.col("`" + names[0].replace("`", "``") + "`")
    # The second part holds for every row, but makes each plan read a field beside the broken row.
    surplus = (count_fields(F.col(BROKEN)) > len(names)) & (F.length(F.concat_ws("", first)) >= 0)
    whole = rows.where(F.when(surplus, F.raise_error(message).cast("boolean")).otherwise(True))
    return whole.select("*", _file().alias("file")).drop(BROKEN)


def _names(header):
    """Column names of a header line; empty and repeated ones get their place added."""
    found = next(csv.reader([header]))
    counts = Counter(name.lower() for name in found)
    return [
        f"_c{i}" if not name else f"{name}{i}" if counts[name.lower()] > 1 else name
        for i, name in enumerate(found)
    ]


def _files(spark, path):
    """Names of all data files at or below ``path``, sorted."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    base, found = system.makeQualified(where).toString(), []
    listed = system.listFiles(where, True)
    while listed.hasNext():
        name = listed.next().getPath().toString()
        below = name[len(base) :].strip("/").split("/")
        if not any(part[:1] in ("_", ".") for part in below):
            found.append(name)
    return sorted(found)


def _header(spark, file, encoding):
    """The first line of a file (None if it is empty), read by the driver without a job."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(file)
    conf = spark._jsc.hadoopConfiguration()
    stream = where.getFileSystem(conf).open(where)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
        bytes_ = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(bytes_, encoding)).readLine()
    finally:
        stream.close()


def _delimited(spark, files, encoding, multiline, one_header=False):
    """The rows of many files, one scan per distinct header; ``file`` tells where each is from."""
    with ThreadPoolExecutor(8) as pool:
        headers = dict(zip(files, pool.map(lambda f: _header(spark, f, encoding), files)))
    groups = {}
    for file, header in headers.items():
        if header is not None:
            groups.setdefault(next(iter(groups), header) if one_header else header, []).append(file)
    if not groups:
        raise ValueError(f"no header in {files}")
    scans = []
    for header, group in groups.items():
        names = _names(header)
        if multiline:
            scans.append(_multiline(spark, group, names, encoding))
        else:
            scans.append(_parsed(_lines(spark, group, header, encoding), names))
    return scans


def _cleaned(raw):
    """Every column as text, null tokens nulled."""
    # Literals made once for all columns: each costs a round trip to the JVM.
    tokens = [F.lit(token) for token in NULL_TOKENS]
    texts = {c: F.col("`" + c.replace("`", "``") + "`").cast("string") for c in raw.columns if c != SHEET}
    sheet = [SHEET] if SHEET in raw.columns else []
    return raw.select(*[null_tokens(text, tokens).alias(c) for c, text in texts.items()], *sheet)


def read_extract(spark, path, encoding="ISO-8859-1", multiline=False):
    """One extract with every column as text and null tokens nulled.

    The files of a folder have one header; one that differs stops the read, and
    so does a row with more fields than the header, in every plan that reads
    the row, whatever columns it needs. A shorter row ends in nulls.
    ``multiline`` allows line breaks inside quotes, but then a file cannot be
    split between tasks.
    """
    if path.rstrip("/").endswith(".parquet"):
        return _cleaned(spark.read.parquet(path))
    (rows,) = _delimited(spark, _files(spark, path), encoding, multiline, one_header=True)
    return _cleaned(rows.drop("file"))


def overlong_rows(spark, path, encoding="ISO-8859-1"):
    """(file, line, fields, expected) of the lines that would stop ``read_extract``."""
    files = _files(spark, path)
    header = next(h for h in (_header(spark, f, encoding) for f in files) if h is not None)
    fields, expected = count_fields(F.col("line")), len(_names(header))
    lines = _lines(spark, files, header, encoding)
    found = lines.select("file", "line", fields.alias("fields"), F.lit(expected).alias("expected"))
    return found.where(F.col("fields") > expected)


def read_sales(spark, path, **options):
    return tag_sales(read_extract(spark, path, **options))


def read_history(spark, path, encoding="ISO-8859-1", multiline=False, name_sheets=False):
    """All sheets below ``path``: each file or folder in it is one sheet.

    ``path`` may also be a list of sheet paths. Sheets with equal headers are
    read in one scan, however many they are; only their first lines are read
    one by one, by the driver. ``name_sheets`` adds the sheet of each row.
    """
    sheets = _children(spark, path) if isinstance(path, str) else [_qualified(spark, p) for p in path]
    if not sheets:
        raise FileNotFoundError(f"no history sheets in {path}")
    columnar = [sheet for sheet in sheets if sheet.endswith(".parquet")]
    frames = [
        spark.read.parquet(sheet).withColumn(SHEET, F.lit(_last(sheet))) for sheet in columnar
    ]
    delimited = [sheet for sheet in sheets if sheet not in columnar]
    if delimited:
        if isinstance(path, str):
            below = F.substring_index(F.substr("file", F.lit(len(_uri(spark, path)) + 2)), "/", 1)
            name = F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B")))
            files = [f for f in _files(spark, path) if not any(f.startswith(c + "/") or f == c for c in columnar)]
        else:
            name = F.lit(None).cast("string")
            for sheet in delimited:
                name = F.when(F.startswith("file", F.lit(_uri(spark, sheet))), F.lit(_last(sheet))).otherwise(name)
            files = [f for sheet in delimited for f in _files(spark, sheet)]
        scans = _delimited(spark, files, encoding, multiline)
        frames += [rows.withColumn(SHEET, name).drop("file") for rows in scans]
    rows = unify([tag_history_sheet(_cleaned(frame)) for frame in frames])
    return rows if name_sheets else rows.drop(SHEET)


def _last(path):
    return path.rstrip("/").rsplit("/", 1)[-1]


def _uri(spark, path):
    """A path as ``file`` has it: a URI, with special characters encoded."""
    where = spark._jvm.org.apache.hadoop.fs.Path(_qualified(spark, path))
    return re.sub("^file:/+", "file:/", where.toUri().toString())


def _qualified(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def _children(spark, folder):
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath() for status in files.listStatus(where)]
    return sorted(p.toString() for p in found if p.getName()[0] not in "._")
