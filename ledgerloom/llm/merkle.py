"""Fingerprint documents with Merkle trees over sections and paragraphs.

A line is a paragraph; a section is a run of paragraphs that ends at a blank
line or after a paragraph whose digest says so, so that an inserted paragraph
moves no later boundary. A paragraph is cut into pieces, short ones into words
and others after closing punctuation, which keeps a change inside one piece. A node's digest covers its
children's digests; the root covers the whole text, white space included.

As a string a tree reads ``root/section;section``, a section
``digest:paragraph,paragraph`` and a paragraph is its pieces' digests in hex.
Two trees are compared from the root down: equal digests end the descent, so
differing branches locate the edits (:func:`differences`). Their likeness is
the Dice coefficient of their pieces, counted with repeats.

Defined cases: a null text is an empty one; the tree of an empty text has no
sections and is fully like another empty one only; equal texts, and so repeated
rows, have equal strings; further columns are not read.
"""

import hashlib
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import pieces, read_table

# A piece: up to 60 characters, then closing marks and white space.
PIECE = re.compile(r"[^.!?;|*%\n]{1,60}[.!?;|*%]*[^\S\n]*|[.!?;|*%]+[^\S\n]*")
WORD_PIECE = re.compile(r"\S+")
SHORT = 120
SECTION_ENDS = 8
LEAF = 8
LAST_ID = 2**63 - 1  # stands for a null id


def tree(text: str) -> str:
    """The fingerprint of a text."""
    top = hashlib.blake2b(digest_size=16)
    sections, section, marks = [], [], []
    sentences, words, digest = PIECE.findall, WORD_PIECE.findall, xxhash.xxh32_intdigest

    def close():
        node = hashlib.blake2b(b"".join(marks), digest_size=16)
        top.update(node.digest())
        sections.append(f"{node.hexdigest()[:16]}:{','.join(section)}")
        section.clear()
        marks.clear()

    for line in text.split("\n") if text else ():
        marks.append(xxhash.xxh3_128_digest(line.encode()))
        cut = words(line) if len(line) <= SHORT else sentences(line)
        leaves = [digest(x.encode()) for x in cut]
        section.append(np.array(leaves, ">u4").tobytes().hex())
        if not line or sum(leaves) % SECTION_ENDS == 0:
            close()
    if section:
        close()
    return f"{top.hexdigest()}/{';'.join(sections)}"


def branches(fingerprint: str):
    """Root, and for each section its digest and paragraphs."""
    root, _, rest = fingerprint.partition("/")
    parts = [s.partition(":") for s in rest.split(";")] if rest else []
    return root, [(name, body.split(",")) for name, _, body in parts]


def leaves(fingerprint: str) -> list[str]:
    """Digests of all pieces, in order."""
    _, parts = branches(fingerprint)
    whole = "".join(p for _, paragraphs in parts for p in paragraphs)
    return [whole[i : i + LEAF] for i in range(0, len(whole), LEAF)]


def likeness(one: str, other: str) -> float:
    """0 to 1; 1 for equal roots."""
    if one[:32] == other[:32]:
        return 1.0
    return _dice(Counter(leaves(one)), Counter(leaves(other)))


def _dice(a: Counter, b: Counter) -> float:
    total = a.total() + b.total()
    if len(a) > len(b):
        a, b = b, a
    return 2.0 * sum(min(n, b[x]) for x, n in a.items() if x in b) / total if total else 0.0


def differences(one: str, other: str) -> list[tuple[int, int]]:
    """(section, paragraph) places of ``one`` whose content ``other`` lacks."""
    root, mine = branches(one)
    other_root, theirs = branches(other)
    if root == other_root:
        return []
    known = {name for name, _ in theirs}
    paragraphs = Counter(p for name, body in theirs for p in body)
    out = []
    for i, (name, body) in enumerate(mine):
        if name in known:
            continue
        for j, paragraph in enumerate(body):
            if paragraphs[paragraph]:
                paragraphs[paragraph] -= 1
            else:
                out.append((i, j))
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row of doc_id, text."""

    def work(batches):
        for piece in pieces(batches):
            trees = [tree(x or "") for x in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(trees, pa.string())], ["doc_id", "fingerprint"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, fingerprint string")


def with_next(docs: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work`` over all rows with each row's next one, by rising doc_id (null last, then text).

    Rows are dealt to ranges of ids. A row with the lowest id of a range also
    goes to the range before it, as that range's closing neighbour (``closing``
    true), and from the first range to the last one. So ``work`` sees sorted
    batches, in which the row behind a row is its next one.
    """
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).where("id IS NOT NULL")
    lows = ids.repartitionByRange(n, "id").groupBy(F.spark_partition_id()).agg(F.min("id"))
    lows = np.array(sorted(r[1] for r in lows.collect()) or [LAST_ID], np.int64)  # n numbers at most

    @F.pandas_udf("int")
    def place(i: pd.Series) -> pd.Series:
        """Twice the range, and 1 more for its lowest id."""
        found = np.maximum(np.searchsorted(lows, i, side="right") - 1, 0)
        return pd.Series(2 * found + (lows[found] == i.to_numpy())).astype("int32")

    rows = docs.select("doc_id", "text").withColumn(
        "place", place(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)))
    )
    part = F.shiftright("place", 1)
    before = F.when(part == 0, len(lows) - 1).otherwise(part - 1)
    own = F.struct(part.alias("part"), F.lit(False).alias("closing"))
    closing = F.struct(before.alias("part"), F.lit(True).alias("closing"))
    lowest = F.col("place") % 2 == 1
    parts = F.when(lowest, F.array(own, closing)).otherwise(F.array(own))
    dealt = rows.select("doc_id", "text", F.inline(parts)).repartition(n // 4, "part")
    return dealt.sortWithinPartitions(
        "part", "closing", F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    ).mapInArrow(work, schema)


def edited_with(text: str, following: str) -> str:
    """``text`` with its second half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def edit_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with likenesses (see op2)."""

    def work(batches):
        held = None
        for piece in pieces(batches):
            out = []
            rows = zip(
                piece.column("doc_id").to_pylist(),
                piece.column("text").to_pylist(),
                piece.column("part").to_pylist(),
                piece.column("closing").to_pylist(),
            )
            for doc_id, text, part, closing in rows:
                text = text or ""
                print_ = tree(text)
                now = (doc_id, text, part, closing, print_, Counter(leaves(print_)))
                if held is not None and not held[3]:
                    out.append(compared(held, now))
                held = now
            yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    def compared(row, following):
        doc_id, text, _, _, own, own_leaves = row
        edited = edited_with(text, following[1])
        changed = tree(edited)
        same = own[:32] == changed[:32]
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": own,
            "edited_fingerprint": changed,
            "near_edited": 1.0 if same else _dice(own_leaves, Counter(leaves(changed))),
            "near_next": 1.0 if own[:32] == following[4][:32] else _dice(own_leaves, following[5]),
        }

    names = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    kind = docs.schema["doc_id"].dataType.simpleString()
    SCHEMA = pa.schema(
        [
            ("doc_id", pa.int32() if kind == "int" else pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )
    return with_next(docs, work, f"doc_id {kind}, {names}, near_edited double, near_next double")


def op2_fingerprint_documents(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return edit_fingerprints(read_table(spark, sf_dir, "documents"))
