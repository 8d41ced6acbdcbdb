"""Byte-pair encoding in batched numpy merge rounds, and decoding.

A vocabulary file of the tokenizers library (byte-level BPE) is read on the
driver and sent to the executors, about two megabytes. A text is cut into
chunks at single spaces between other characters, where no token can cross;
each chunk that a worker has not seen lately is split by the tokenizer's own
pattern, and the new words of a batch are merged together: their symbols lie in
one flat array, every round finds the rank of each neighbouring pair by binary
search over the sorted pair keys, and each word merges its lowest-ranked pair
wherever it stands. Words without a known pair leave the array. A word of more
than ``LONG_WORD`` characters would need a round for each of its merges; it is
merged by a queue of its pairs instead, with the same result.

Decoding gathers the tokens' bytes and reads them as UTF-8 (invalid parts
become replacement characters, as in the library).

Defined cases: a null text is an empty one, with no tokens; a special token's
string in a text becomes that token; repeated rows get equal ids; words of any
length are merged whole; an empty table gives an empty result; further
columns are not read by the query. :func:`encode_documents` names its columns
after those given to it and refuses clashes.
"""

import functools
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import pieces, read_table

# The byte-level tokenizer's split pattern (fixed value), white space spelled as a property.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
SPLIT = regex.compile(PATTERN)
# Where a single space does not stand between two other characters.
LOOSE = regex.compile(r" \p{White_Space}|\p{White_Space} |\A | \Z")
CACHED_CHARS = 1 << 23
WORDS_AT_ONCE = 1 << 15
NONE = np.iinfo(np.int64).max
# Characters above which a word is merged by a queue instead of rounds.
LONG_WORD = 256


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte: itself where printable, else from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def is_word(chunk: str) -> bool:
    """Whether the split pattern surely leaves a chunk whole: ASCII letters, after a space or not."""
    return chunk.isascii() and chunk[1:].isalpha() and (chunk[0] == " " or chunk[0].isalpha())


class Bpe:
    """Tables of one vocabulary, and a cache of encoded chunks."""

    def __init__(self, file: bytes):
        given = json.loads(file)
        model, pre = given["model"], given["pre_tokenizer"]
        plain = given["normalizer"] is None and pre == pre | {
            "type": "ByteLevel", "add_prefix_space": False, "use_regex": True
        }
        if model["type"] != "BPE" or not plain or model["dropout"] or model.get("ignore_merges"):
            raise ValueError("only byte-level BPE without normaliser or prefix space is supported")
        letters = byte_letters()
        vocab = model["vocab"]
        added = given["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("special tokens must match as they are")
        size = max([*vocab.values(), *(t["id"] for t in added)]) + 1
        texts = [b""] * size
        for token, i in vocab.items():
            texts[i] = bytes(letters[c] for c in token)
        for t in added:
            texts[t["id"]] = t["content"].encode()
        self.specials = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        names = sorted(self.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        by_byte = {letters[c]: i for c, i in vocab.items() if len(c) == 1}
        self.first = np.array([by_byte[b] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        self.cache, self.cached = {}, 0

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, as little-endian 32-bit integers."""
        flat = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.first[flat]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        places = np.full(len(symbols), -1)
        changed = np.arange(len(symbols))
        done = []
        while len(symbols):
            # Only pairs beside the last round's merges are searched anew.
            places[changed] = self.pair_places(symbols, owner, changed)
            rank = np.where(places < 0, NONE, self.ranks[places])
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            best = np.minimum.reduceat(rank, heads)
            best = np.repeat(best, np.diff(heads, append=len(symbols)))
            open_ = best < NONE
            if not open_.all():
                done.append((owner[~open_], symbols[~open_]))
            chosen = np.flatnonzero(open_ & (rank == best))
            # Of overlapping places (a pair of equal symbols in a row) take every other one.
            run = np.flatnonzero(np.diff(chosen, prepend=-2) > 1)
            inside = np.arange(len(chosen)) - np.repeat(run, np.diff(run, append=len(chosen)))
            chosen = chosen[inside % 2 == 0]
            symbols[chosen] = self.merged[places[chosen]]
            open_[chosen + 1] = False
            chosen = np.cumsum(open_)[chosen] - 1
            changed = np.concatenate([chosen, chosen[chosen > 0] - 1])
            symbols, owner, places = symbols[open_], owner[open_], places[open_]
        owner = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        ids = ids[order].astype("<u4").tobytes()
        ends = 4 * np.searchsorted(owner[order], np.arange(len(words) + 1))
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def pair_places(self, symbols, owner, at):
        """Row in the sorted pair keys of the pair that starts at each of the places ``at``, or -1."""
        after = np.minimum(at + 1, len(symbols) - 1)
        pair = symbols[at] << 32 | symbols[after]
        found = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        known = (self.keys[found] == pair) & (owner[at] == owner[after]) & (after > at)
        return np.where(known, found, -1)

    @functools.cached_property
    def pairs(self):
        """Rank and merged symbol of each pair that merges."""
        return dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))

    def merge_long(self, word: bytes) -> bytes:
        """Token ids of one long word, by a queue of its pairs.

        A round over all symbols per merge would take the square of the word's
        length; this takes the lowest rank, and of equal ones the leftmost,
        from a heap, which gives the same merges in the same order.
        """
        symbols = self.first[np.frombuffer(word, np.uint8)]
        pair = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        known = np.flatnonzero(self.keys[at] == pair)
        # A heap entry is rank and place in one number.
        queue = (self.ranks[at[known]] << 40 | known).tolist()
        heapq.heapify(queue)
        symbols = symbols.tolist()
        n, place = len(symbols), (1 << 40) - 1
        after, ahead = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self.pairs
        while queue:
            entry = heapq.heappop(queue)
            i = entry & place
            j = after[i]
            # Entries of pairs that have changed since are stale.
            if symbols[i] < 0 or j >= n:
                continue
            found = pairs.get(symbols[i] << 32 | symbols[j])
            if found is None or found[0] != entry >> 40:
                continue
            symbols[i], symbols[j] = found[1], -1
            k = after[i] = after[j]
            if k < n:
                ahead[k] = i
                new = pairs.get(symbols[i] << 32 | symbols[k])
                if new is not None:
                    heapq.heappush(queue, new[0] << 40 | i)
            h = ahead[i]
            if h >= 0:
                new = pairs.get(symbols[h] << 32 | symbols[i])
                if new is not None:
                    heapq.heappush(queue, new[0] << 40 | h)
        return np.array([s for s in symbols if s >= 0], "<u4").tobytes()

    def learn(self, chunks: set[str]):
        """Encode chunks that the cache lacks."""
        if self.cached > CACHED_CHARS:
            self.cache, self.cached = {}, 0
        new = [c for c in chunks if c not in self.cache]
        split = [[c] if is_word(c) else SPLIT.findall(c) for c in new]
        words = list(dict.fromkeys(w for part in split for w in part))
        ids = {w: self.merge_long(w.encode()) for w in words if len(w) > LONG_WORD}
        if ids:
            words = [w for w in words if w not in ids]
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            ids.update(zip(some, self.merge([w.encode() for w in some])))
        for chunk, part in zip(new, split):
            self.cache[chunk] = ids[part[0]] if len(part) == 1 else b"".join([ids[w] for w in part])
            self.cached += len(chunk) + 50

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian 32-bit integers."""
        cut = [self.chunks(x) for x in texts]
        self.learn(set().union(*cut) - self.specials.keys())
        self.cache.update(self.specials)
        return [b"".join(map(self.cache.__getitem__, parts)) for parts in cut]

    def chunks(self, text: str) -> list[str]:
        """Parts that encode on their own, special tokens among them."""
        if self.special is None or not any(s in text for s in self.specials):
            return self.plain_chunks(text)
        parts = self.special.split(text)
        out = []
        for i, part in enumerate(parts):
            out += [part] if i % 2 else self.plain_chunks(part)
        return out

    @staticmethod
    def plain_chunks(text: str) -> list[str]:
        if not text:
            return []
        if LOOSE.search(text):
            return SPLIT.findall(text)
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]

    def decode(self, ids: bytes) -> str:
        """The text of token ids given as little-endian 32-bit integers."""
        tokens = np.frombuffer(ids, "<u4")
        out = []
        for at in range(0, len(tokens), 1 << 18):
            some = tokens[at : at + (1 << 18)]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            inside = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
            out.append(self.bytes[inside + np.repeat(self.starts[some], lengths)].tobytes())
        return b"".join(out).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def loaded(file: bytes) -> Bpe:
    """The tables of a vocabulary file, made once per worker."""
    name = hashlib.sha256(file).hexdigest()
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Bpe(file)
    return _LOADED[name]


def tokenized(docs: DataFrame, vocabulary: str, columns, row) -> DataFrame:
    """Rows of docs with ``columns`` (name: Spark type) in place of text, made by row(bpe, ids)."""
    with open(vocabulary, "rb") as f:  # a vocabulary of the installation, on the driver
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    others = [c for c in docs.columns if c != "text"]
    if clash := set(others) & set(columns):
        raise ValueError(f"columns already taken: {sorted(clash)}")

    def work(batches):
        bpe = loaded(sent.value)
        for piece in pieces(batches):
            ids = bpe.encode([x or "" for x in piece.column("text").to_pylist()])
            made = row(bpe, ids)
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in others), *made], [*others, *columns]
            )

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in others]
    kinds += [f"{c} {kind}" for c, kind in columns.items()]
    return docs.mapInArrow(work, ", ".join(kinds))


def id_lists(ids: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(x) // 4 for x in ids]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Rows of docs with n_tokens and token ids (array of int) in place of their text."""

    def row(bpe, ids):
        return [pa.array([len(x) // 4 for x in ids], pa.int64()), id_lists(ids)]

    return tokenized(docs, vocabulary, {"n_tokens": "long", "ids": "array<int>"}, row)


def decode_documents(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """Rows of tokens (which has a column ids) with ``text`` in place of the ids."""
    with open(vocabulary, "rb") as f:
        sent = tokens.sparkSession.sparkContext.broadcast(f.read())
    others = [c for c in tokens.columns if c != "ids"]

    def work(batches):
        bpe = loaded(sent.value)
        for batch in batches:
            ids = [np.array(x or [], "<u4").tobytes() for x in batch.column("ids").to_pylist()]
            texts = pa.array([bpe.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), texts], [*others, "text"]
            )

    kinds = [f"{c} {tokens.schema[c].dataType.simpleString()}" for c in others]
    return tokens.mapInArrow(work, ", ".join([*kinds, "text string"]))


def token_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id with n_tokens and digests of the ids and of the text decoded from them."""

    def row(bpe, ids):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        return [
            pa.array([len(x) // 4 for x in ids], pa.int64()),
            pa.array([sha(x) for x in ids], pa.string()),
            pa.array([sha(bpe.decode(x).encode()) for x in ids], pa.string()),
        ]

    columns = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    return tokenized(docs.select("doc_id", "text"), vocabulary, columns, row)


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op6_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Digests of every document's tokens and of the text decoded from them."""
    return token_digests(read_table(spark, sf_dir, "documents"), default_vocabulary())
