"""License notices by winnowed fingerprints and banded alignment.

Texts are read as runs of letters and digits, A-Z lower-cased. Of each window
of ``WINDOW`` neighbouring word ``GRAM``-grams the lowest hash is kept, in
texts and templates alike, so any common run of WINDOW + GRAM - 1 words shares
a kept hash. An inverted index (hash -> template, place) turns shared hashes
into candidates: a template and a diagonal. Around each, template and text are
aligned word by word within a band; the matched words give coverage and span.

Defined cases: null and empty texts have no matches and no rows; several
notices in a text give several rows, overlapping spans of one template one (the
best covered, then the earliest); repeated rows report alike; an empty table
gives an empty result; further columns are not read.
"""

import bisect
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import pieces, read_table, utf8, window_hashes, word_hashes

GRAM = 3
WINDOW = 3
COVERAGE = 0.8
# The usual notices, by SPDX name.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT/permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:"
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0/header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0/header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."
    ),
    "BSD/redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def read_words(data, offsets):
    """Hash, start, end of each word of letters and digits, and the number of words before each text."""
    solid = LETTER[data]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    first[heads] = solid[heads]
    tails = heads[heads > 0] - 1
    last[tails] = solid[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return word_hashes(LOWER[data], starts, ends), starts, ends, np.searchsorted(starts, offsets)


def winnowed(hashes, before):
    """Places and hashes of the grams that winnowing keeps, each inside one text."""
    grams = window_hashes(hashes, GRAM)
    if not len(grams):
        return np.zeros(0, np.int64), grams
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    whole = text[: len(grams)] == text[GRAM - 1 :]
    value = np.where(whole, grams, np.iinfo(np.uint64).max)
    kept = np.zeros(len(grams), bool)
    spans = max(len(grams) - WINDOW + 1, 1)
    width = min(WINDOW, len(grams))
    view = np.stack([value[i : i + spans] for i in range(width)])
    best = width - 1 - np.argmin(view[::-1], axis=0)  # the rightmost lowest
    kept[np.arange(spans) + best] = True
    # Windows over a text's border also keep its own lowest gram, at worst one more.
    places = np.flatnonzero(kept & whole)
    return places, grams[places]


@functools.lru_cache(maxsize=1)
def index():
    """Sorted kept hashes with their template and place, and the templates' word hashes."""
    names, texts = list(TEMPLATES), [t.encode() for t in TEMPLATES.values()]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    hashes, _, _, before = read_words(data, offsets)
    places, kept = winnowed(hashes, before)
    template = np.searchsorted(before, places, side="right") - 1
    order = np.argsort(kept, kind="stable")
    words = [hashes[a:b].tolist() for a, b in zip(before, before[1:])]
    return names, kept[order], template[order], (places - before[template])[order], words


def align(template, text, width):
    """Best alignment of the whole template with a part of text: matches, start, end (words).

    Text word j may meet template word i only for 0 <= j - i < width.
    """
    lowest = -(10**9)
    # Row: score, matches, start for each offset d = j - i, 0 <= d < width; starting is free.
    row = [(0, 0, d) for d in range(width + 1)]
    for i, word in enumerate(template):
        now = []
        for d in range(width):
            j = i + d
            best = (lowest, 0, 0)
            if j < len(text):
                score, hits, start = row[d]
                same = text[j] == word
                best = (score + (2 if same else -1), hits + same, start)
            if d + 1 < width:  # template word without partner
                score, hits, start = row[d + 1]
                best = max(best, (score - 1, hits, start), key=lambda x: x[0])
            if d and now:  # text word without partner
                score, hits, start = now[d - 1]
                best = max(best, (score - 1, hits, start), key=lambda x: x[0])
            now.append(best)
        now.append((lowest, 0, 0))
        row = now
    score, hits, start, d = max(((s, h, a, -d) for d, (s, h, a) in enumerate(row)), key=lambda x: (x[0], x[3]))
    return hits, start, min(len(template) - d, len(text))


def matches(column):
    """Rows (text, template, matched words, start and end byte) of a string array."""
    names, keys, templates, at, words = index()
    data, offsets = utf8(column)
    hashes, starts, ends, before = read_words(data, offsets)
    places, kept = winnowed(hashes, before)
    low, high = np.searchsorted(keys, kept, "left"), np.searchsorted(keys, kept, "right")
    hit = np.flatnonzero(high > low)
    counts = (high - low)[hit]
    entry = np.repeat(low[hit], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = np.repeat(places[hit], counts)
    text = np.searchsorted(before, place, side="right") - 1
    candidates = sorted(set(zip(text.tolist(), templates[entry].tolist(), (place - at[entry]).tolist())))
    out, group = [], None
    for t, k, diagonal in candidates:
        band = max(4, len(words[k]) // 8)
        # Neighbouring diagonals share one alignment, whose band holds the whole band of each of
        # them: nothing that an alignment of its own would find is lost, and what starts so close
        # together overlaps, so that only the best of it is reported anyway.
        if group is not None and group[:2] == (t, k) and diagonal - group[2] <= band // 2:
            continue
        group = (t, k, diagonal)
        width = 2 * band + band // 2 + 1
        a = max(int(before[t]), diagonal - band)
        b = min(int(before[t + 1]), diagonal - band + len(words[k]) + width)
        # Where the text begins inside the band, words that match nothing fill it up.
        missing = a - (diagonal - band)
        hits, start, end = align(words[k], [-1] * missing + hashes[a:b].tolist(), width)
        if hits >= COVERAGE * len(words[k]):
            out.append((t, k, hits, a + max(start - missing, 0), a + end - missing))
    best, spans = [], {}
    for row in sorted(out, key=lambda r: (r[0], r[1], -r[2], r[3])):
        # Spans of one text and template, sorted and apart: only the neighbours can overlap.
        taken = spans.setdefault(row[:2], [])
        at_ = bisect.bisect(taken, (row[3], row[4]))
        if (at_ == 0 or taken[at_ - 1][1] <= row[3]) and (at_ == len(taken) or row[4] <= taken[at_][0]):
            taken.insert(at_, (row[3], row[4]))
            best.append(row)
    return [(t, names[k], hits, len(words[k]), int(starts[a]), int(ends[b - 1])) for t, k, hits, a, b in best], data, offsets


SCHEMA = (
    "license string, matched_words long, template_words long, coverage double, "
    "start_char long, end_char long"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per notice found: doc_id, license, matched words, coverage and span in code points."""

    def work(batches):
        for piece in pieces(batches):
            found, data, offsets = matches(piece.column("text"))
            head = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            ids = piece.column("doc_id").take(pa.array([t for t, *_ in found], pa.int64()))
            first = [int(head[offsets[t]]) for t, *_ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([f[1] for f in found], pa.string()),
                    pa.array([f[2] for f in found], pa.int64()),
                    pa.array([f[3] for f in found], pa.int64()),
                    pa.array([f[2] / f[3] for f in found], pa.float64()),
                    pa.array([int(head[f[4]]) - z for f, z in zip(found, first)], pa.int64()),
                    pa.array([int(head[f[5]]) - z for f, z in zip(found, first)], pa.int64()),
                ],
                ["doc_id", *[x.split()[0] for x in SCHEMA.split(", ")]],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, {SCHEMA}")


def op10_license_notices(spark, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return scan(read_table(spark, sf_dir, "documents"))
