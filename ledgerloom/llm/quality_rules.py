"""Quality rules: measures of a text, and lines that many documents of a host share.

Lines are normalised (A-Z lower-cased, white space collapsed) and hashed. A
line's frequency in a host is the number of distinct documents with it, where
documents with equal texts count as one, so that exact copies do not make each
other's lines frequent (near copies count one by one). Lines above the limits
(more than ``MIN_DOCS`` documents and more than ``SHARE`` of the host's distinct
texts) are removed, and a document that keeps less than ``LEAST_LEFT`` of its
words is rejected as depleted.

Defined cases: a null text has no words and no lines and fails the base rules;
a null host is a host of its own; a document whose only line is frequent in
other documents is depleted; repeated rows get the same measures and verdict;
an empty table gives an empty result. Input columns are carried in one struct
by :func:`drop_rejected`, so their names do not matter.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    packed,
    pieces,
    read_table,
    row_key,
    staged,
    texts_of,
    utf8,
    window_hashes,
    word_hashes,
    word_spans,
)

# Fixed by the contract.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
WINDOW = 5
MOST_REPEATED = 20  # per cent of the words
# Own limits.
MIN_DOCS = 20
SHARE = 200  # one document in so many
LEAST_LEFT = 5  # one word in so many

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
LINES = pa.list_(pa.struct([(n, pa.int64()) for n in ("line", "words")]))


def per_text(values, places):
    """Sums of ``values`` between consecutive ``places``."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[places]
    return np.diff(sums)


def repeated_words(hashes, before):
    """Words of each text in windows that its text has twice or more."""
    n = len(hashes)
    windows = window_hashes(hashes, WINDOW)
    if not len(windows):
        return np.zeros(len(before) - 1, np.int64)
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    inside = np.flatnonzero(text[: len(windows)] == text[WINDOW - 1 :])
    keys, owner = windows[inside], text[inside]
    order = np.lexsort((keys, owner))
    same = (np.diff(keys[order]) == 0) & (np.diff(owner[order]) == 0)
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    starts = inside[order[twice]]
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + WINDOW, -1)
    return per_text(np.cumsum(cover[:-1]) > 0, before)


def lines_of(text: bytes):
    """The number of repeated lines, and each distinct normalised line's hash with its words."""
    found = [x for x in text.split(b"\n") if x.strip()]
    sizes = {}
    for line in found:
        words = line.lower().split()
        key = b" ".join(words)
        sizes[key] = sizes.get(key, 0) + len(words)
    rows = [
        {"line": int.from_bytes(hashlib.md5(key, usedforsecurity=False).digest()[:8], "big", signed=True), "words": n}
        for key, n in sizes.items()
    ]
    return len(found) - len(set(found)), rows


def measures(column):
    """The measures of a string array's texts, and their lines."""
    data, offsets = utf8(column)
    starts, ends, before = word_spans(data, offsets)
    head = (data & 0xC0) != 0x80  # first byte of a code point
    solid = np.zeros(len(data) + 1, np.int64)
    np.add.at(solid, starts, 1)
    np.add.at(solid, ends, -1)
    inside = np.cumsum(solid[:-1]) > 0
    lines = [lines_of(x) for x in texts_of(column)]
    return {
        "n_words": np.diff(before),
        "word_chars": per_text(head & inside, offsets),
        "n_symbols": per_text(IS_SYMBOL[data], offsets),
        "n_dup_lines": np.array([n for n, _ in lines], np.int64),
        "n_repeat_words": repeated_words(word_hashes(data, starts, ends), before),
    }, [rows for _, rows in lines]


def measured(docs: DataFrame) -> DataFrame:
    """Add the measures and ``lines`` to docs, whose column text they replace."""
    others = [c for c in docs.columns if c != "text"]

    def work(batches):
        for piece in pieces(batches):
            values, lines = measures(piece.column("text"))
            arrays = [pa.array(values[m], pa.int64()) for m in MEASURES]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in others), *arrays, pa.array(lines, LINES)],
                [*others, *MEASURES, "lines"],
            )

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in others]
    kinds += [f"{m} long" for m in MEASURES]
    lines = "lines array<struct<line: long, words: long>>"
    return docs.mapInArrow(work, ", ".join([*kinds, lines]))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, key, measures, words_removed, base_failed and kept of every row of doc_id, text, source."""
    host = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
    rows = docs.select(
        "doc_id",
        "text",
        host.alias("host"),
        row_key("doc_id", "text", "source").alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"),
    )
    rows = measured(rows).withColumn("row_id", F.monotonically_increasing_id())
    rows = staged(rows, "measured")
    lines = rows.select("row_id", "host", "digest", F.inline("lines"))
    texts = rows.groupBy("host").agg(F.count_distinct("digest").alias("texts"))
    counts = lines.groupBy("host", "line").agg(F.count_distinct("digest").alias("n"))
    frequent = counts.where(F.col("n") > MIN_DOCS).join(texts, "host")
    frequent = frequent.where(F.col("n") * SHARE > F.col("texts")).select("host", "line")
    removed = lines.join(frequent, ["host", "line"]).groupBy("row_id").agg(
        F.sum("words").alias("words_removed")
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    left = F.col("n_words") - F.col("words_removed")
    return (
        rows.drop("lines")
        .join(removed, "row_id", "left")
        .withColumn("words_removed", F.coalesce("words_removed", F.lit(0)).cast("long"))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (LEAST_LEFT * left >= F.col("n_words")))
    )


def passes_base(column):
    """Whether each text of a string array passes the base rules."""
    data, offsets = utf8(column)
    starts, ends, before = word_spans(data, offsets)
    words = np.diff(before)
    repeated = repeated_words(word_hashes(data, starts, ends), before)
    return (words >= LEAST_WORDS) & (100 * repeated <= MOST_REPEATED * words)


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep.

    The base rules are looked at again where a row is, so that only the few
    depleted documents have to be found by a join.
    """
    depleted = judged(docs).where("NOT kept AND NOT base_failed").select("key").distinct()

    @F.arrow_udf("boolean")
    def passes(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text], ["text"])
        parts = [passes_base(piece.column(0)) for piece in pieces([batch])]
        return pa.array(np.concatenate([np.zeros(0, bool), *parts]), pa.bool_())

    rows = packed(docs.where(passes(F.col("text"))), row_key("doc_id", "text", "source").alias("key"))
    return rows.join(staged(depleted, "depleted"), "key", "left_anti").select("row.*")


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    found = judged(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", *MEASURES, "base_failed", "kept", "words_removed")


OP5_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS host
  FROM documents
), split AS (
  SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM docs
), windows AS (
  SELECT rid, i, array_to_string(words[i:i + 4], ' ') AS gram
  FROM split, unnest(range(1, len(words) - 3)) AS u(i)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY rid
), raw_lines AS (
  SELECT rid, host, line,
         trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+', ' ', 'g')) AS norm
  FROM docs, unnest(string_split(text, chr(10))) AS u(line)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), repeats AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n FROM raw_lines GROUP BY rid
), lines AS (
  SELECT rid, host, norm, sum(len(regexp_extract_all(norm, '[^ ]+'))) AS words FROM raw_lines GROUP BY ALL
), counts AS (
  SELECT host, norm, count(DISTINCT text) AS n FROM lines JOIN docs USING (rid, host) GROUP BY host, norm
), frequent AS (
  SELECT host, norm FROM counts JOIN (SELECT host, count(DISTINCT text) AS texts FROM docs GROUP BY host) USING (host)
  WHERE n > 20 AND n * 200 > texts
), removed AS (
  SELECT rid, sum(words) AS n FROM lines JOIN frequent USING (host, norm) GROUP BY rid
), measured AS (
  SELECT d.doc_id, len(s.words)::BIGINT AS n_words,
         length(array_to_string(s.words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(p.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(r.n, 0)::BIGINT AS words_removed
  FROM docs d JOIN split s USING (rid) LEFT JOIN covered c USING (rid)
  LEFT JOIN repeats p USING (rid) LEFT JOIN removed r USING (rid)
), based AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 5 * (n_words - words_removed) >= n_words AS kept, words_removed
FROM based
"""
