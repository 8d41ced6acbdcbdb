"""One long word, host or line must neither stall nor kill a task."""

import random
import time

import pyarrow as pa
import pytest

from ledgerloom.llm import bpe, licences, urls


@pytest.fixture(scope="module")
def tables():
    with open(bpe.default_vocabulary(), "rb") as f:
        return bpe.Bpe(f.read())


def test_long_words_as_the_library_merges_them(tables):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(bpe.default_vocabulary())
    draw = random.Random(0)
    words = ["a" * n for n in (256, 257, 1000, 4097)] + ["ab" * 700, "é" * 999, "the" * 3000]
    words += ["".join(draw.choices("etaoinshrdlu", k=n)) for n in (257, 300, 5000, 20_000)]
    words += ["".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(3000))]
    for word, ids in zip(words, tables.encode(words)):
        assert memoryview(ids).cast("I").tolist() == library.encode(word, add_special_tokens=False).ids
        assert tables.decode(ids) == word


def test_rounds_and_queue_agree(tables):
    draw = random.Random(1)
    words = ["".join(draw.choices("abcdeéß ", k=draw.randint(1, 60))).encode() for _ in range(500)]
    assert tables.merge(words) == [tables.merge_long(w) for w in words]


def test_a_word_of_a_megabyte(tables):
    word = "".join(random.Random(2).choices("etaoinshrdlucmfwypvbg", k=1_000_000))
    began = time.perf_counter()
    (ids,) = tables.encode([word])
    assert time.perf_counter() - began < 40  # about 5 s on an idle core
    assert tables.decode(ids) == word


def test_a_url_of_a_megabyte(tmp_path):
    (tmp_path / "rules").write_bytes(urls.rule_file(urls.RULES))
    rules = urls.RuleArray(tmp_path / "rules")
    hosts = ["a." * 500_000 + "example.com", "." * 1_000_000 + "net", "x" * 1_000_000, "com", "example.com"]
    paths = ["/en/" + "y" * 1_000_000, "/fr/", "/en/", "/", "/en/x"]
    began = time.perf_counter()
    names, verdicts = urls.judge(rules, hosts, paths, "allow")
    assert time.perf_counter() - began < 1
    assert verdicts == ["block", "block", "allow", "allow", "block"]
    assert names == ["example.com/en/", "net/fr/", None, "com/", "example.com/en/"]


def test_many_notices_of_one_text_stay_apart():
    notice = licences.TEMPLATES["GPL-3.0"]
    text = " and some other words stand here between them ".join([notice] * 300)
    found, _, _ = licences.matches(pa.array([text]))
    spans = sorted((a, b) for _, name, _, _, a, b in found if name == "GPL-3.0")
    assert len(spans) == 300 and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_one_word_repeated():
    began = time.perf_counter()
    for word in ("license", "the", "a"):
        found, _, _ = licences.matches(pa.array([f"{word} " * 50_000]))
        assert found == []
    assert time.perf_counter() - began < 30
