"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names, hot groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    html_crf,
    licences,
    merkle,
    mixing,
    quality_model,
    quality_rules,
    sharding,
    simhash,
    urls,
)
from ledgerloom.llm.html_blocks import blocks

LONG = "alpha beta gamma delta epsilon. " * 20_000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Own columns of the operators, as names of input columns.
CLASHES = ("row", "key", "size", "tie", "skey", "times", "score", "fp", "kept", "digest", "bucket", "copy")


def sentence(i):
    words = [f"w{(i * 7919 + k * k * 31) % 1009}" for k in range(40)]
    return " ".join(words) + "."


ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, LONG, "en", "a", 1),
    (4, sentence(4), "en", "b", 1),
    (4, sentence(4), "en", "b", 1),
    (5, sentence(4), "en", None, 1),
    (None, sentence(6), "en", "a", 1),
    (7, "Überß ñandú\n\n\tñandú \x0b word", "en", "b", 1),
    (8, " \t\n", "en", "b", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 0) for i in range(8)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")


def jobs(labels):
    return {
        "mix": lambda d: mixing.mix_documents(d),
        "rules": lambda d: quality_rules.drop_rejected(d),
        "model": lambda d: quality_model.drop_low_quality(d, labels),
        "dedup": lambda d: simhash.drop_near_duplicates(d),
    }


@pytest.mark.parametrize("name", ["mix", "rules", "model", "dedup"])
def test_stages_on_odd_rows_and_clashing_names(docs, empty, labels, name):
    job = jobs(labels)[name]
    plain = sorted(map(str, job(docs).collect()))
    clashing = docs.withColumns({c: F.lit("x") for c in CLASHES})
    out = job(clashing)
    assert out.columns == clashing.columns
    assert sorted(map(str, out.select(docs.columns).collect())) == plain
    none = job(empty)
    assert none.columns == empty.columns and none.count() == 0


def test_every_row_gets_a_result(docs, empty, labels):
    model = quality_model.train(docs, labels)
    for make in (
        lambda d: merkle.edit_fingerprints(d),
        lambda d: quality_model.scored(d.select("doc_id", "text"), model),
        lambda d: simhash.near_duplicates(d),
        lambda d: quality_rules.judged(d),
        lambda d: bpe.token_digests(d, bpe.default_vocabulary()),
        lambda d: sharding.shard_documents(d, 3),
    ):
        assert make(docs).count() == len(ROWS)
        assert make(empty).count() == 0


def test_mix_of_odd_sources(spark, docs, empty):
    rows = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), F.lit(0).alias("tie"))
    found = mixing.plan_mix(rows).attach(rows).collect()
    assert len(found) == len(ROWS)
    assert all(r.times == 0 for r in found if r["size"] == 0)
    assert sum(r["size"] * r.times for r in found) <= sum(r["size"] for r in found)
    only = rows.where("size = 0")
    assert [r.times for r in mixing.plan_mix(only).attach(only).collect()] == [0, 0, 0]
    assert mixing.mix_sequence(empty).count() == 0
    order = [r.finish for r in mixing.mix_sequence(docs).collect()]
    assert order == sorted(order)


def test_targets_share_the_excess(spark):
    sources = spark.createDataFrame(
        [("a", 10, 5), ("b", 100, 2), ("c", 100, 1), ("d", 50, None)],
        "source string, source_size long, weight long",
    )
    targets = {r.source: r.target for r in mixing.fill_targets(sources, 3).collect()}
    assert targets["a"] == 30 and targets["d"] == 0
    assert targets["b"] == pytest.approx(230 * 2 / 3) and targets["c"] == pytest.approx(230 / 3)


def test_cut_narrows_to_the_right_copy(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SORTED_AT_ONCE", 5)
    monkeypatch.setattr(mixing, "PARTS", 7)
    rows = [(f"s{i % 3}", 1 + i % 5, ((i * 37) % 101) / 10) for i in range(300)]
    items = spark.createDataFrame(rows, "skey string, size long, finish double")
    for budget in (0, 1, 100, 450, 10_000):
        last, total = None, 0
        for finish, skey in sorted({(f, s) for s, _, f in rows}):
            block = sum(z for s, z, f in rows if (f, s) == (finish, skey))
            if total + block > budget:
                break
            last, total = (finish, skey), total + block
        cut = mixing.find_cut(items, budget)
        reached = [r for r in rows if cut and (r[2], r[0]) <= cut]
        assert sum(z for _, z, _ in reached) >= total
        assert last is None or cut >= last


def test_edits_are_located():
    lines = [sentence(i) for i in range(60)]
    one = merkle.tree("\n".join(lines))
    changed = [*lines[:30], "another line here.", *lines[31:]]
    other = merkle.tree("\n".join(changed))
    assert len(merkle.differences(one, other)) == 1
    assert merkle.differences(one, one) == [] and merkle.likeness(one, one) == 1
    assert 0.9 < merkle.likeness(one, other) < 1
    assert merkle.likeness(merkle.tree(""), one) == 0 and merkle.likeness(merkle.tree(""), merkle.tree("")) == 1
    assert len({merkle.tree(t) for t in ("", "\n", "\n\n", " ", "a", "a\n", "a ", "a\n\nb", "a\nb")}) == 9


def test_next_document_without_ids(spark):
    rows = spark.createDataFrame([(None, "b b"), (None, "a a"), (None, None)], "doc_id long, text string")
    assert merkle.edit_fingerprints(rows).count() == 3
    single = spark.createDataFrame([(9, "one two")], "doc_id long, text string")
    assert [r.near_next for r in merkle.edit_fingerprints(single).collect()] == [1.0]


def brute_links(prints, distance):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


@pytest.mark.parametrize("bucket", [2048, 6])
def test_components_of_dense_groups(spark, bucket):
    """Balls of near fingerprints, chains and strangers; small buckets force the chunked way."""
    r = np.random.default_rng(5)
    prints = set()
    for center in r.integers(0, 2**63, 6).tolist():
        for _ in range(60):
            x = center
            for bit in r.integers(0, 63, r.integers(0, 6)).tolist():
                x ^= 1 << bit
            prints.add(x)
    chain = 0
    for bit in range(0, 60, 4):
        chain ^= 0b1111 << bit
        prints.add(chain)
    prints |= set(r.integers(0, 2**63, 100).tolist())
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.similar_pairs(frame, 4, bucket)
    comps = {x.node: x.root for x in simhash.components(links).collect()}
    assert {p: comps.get(p, p) for p in prints} == brute_links(prints, 4)


def test_zero_fingerprint_links_like_any_other(docs):
    found = {r.doc_id: (r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found[1] == found[2] == found[8] == (0, 1)
    assert found[4] == found[5] and found[4][1] == 4


def test_frequent_lines_deplete_but_copies_do_not(spark):
    notice = "please read our terms and accept all of them today now"
    rows = [(i, f"{notice}\n{sentence(i)}", "en", "h", 1) for i in range(60)]
    rows += [(100 + i, f"{sentence(999)}\n{sentence(998)}", "en", "h", 1) for i in range(60)]
    rows += [(300, "\n".join([notice] * 1 + ["just two"]), "en", "h", 1)]
    found = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[5].kept and found[5].words_removed == 11
    assert found[105].kept and found[105].words_removed == 0
    assert not found[300].kept and not found[300].base_failed


def test_notices_that_stand_together_are_all_frequent(spark):
    notices = "our terms hold for all who read this page\na cookie is set by us\nall rights are kept by its owner"
    own = lambda i: "\n".join(sentence(10 * i + k)[:60] for k in range(8))
    rows = [(i, f"{notices}\n{own(i)}", "en", "h", 1) for i in range(100)]
    rows += [(200, f"{notices}\njust two", "en", "h", 1)]
    found = {r.doc_id: r for r in quality_rules.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {found[i].words_removed for i in (*range(100), 200)} == {22}
    assert found[7].kept and not found[200].kept


def test_specials_and_odd_texts_encode_as_in_the_library():
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(bpe.default_vocabulary())
    with open(bpe.default_vocabulary(), "rb") as f:
        own = bpe.Bpe(f.read())
    texts = [
        "", " ", "  a  b ", "a\n\n b\t c", "<|endoftext|>", "x<|endoftext|> y <|endoftext|><|endoftext|>",
        "don't we'll I'M", "aaaaaaaaaaaaaaaaaaaaaaa", "a" * 5001, " nbsp  em", "日本語 テキスト 123456",
        "🙂🙂 é é", "\x1c\x1d \x85x", "tab\tend ", " lead", "1234 5678,9", LONG[:5000],
    ]
    for text, ids in zip(texts, own.encode(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text[:40]
        assert own.decode(ids) == library.decode(expected, skip_special_tokens=False) == text
    assert own.decode(np.array([250, 97], "<u4").tobytes()) == library.decode([250, 97], skip_special_tokens=False)


def test_tokens_round_trip_as_frames(docs):
    frame = bpe.encode_documents(docs, bpe.default_vocabulary())
    back = bpe.decode_documents(frame, bpe.default_vocabulary())
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == sorted((str(r[0]), r[1] or "") for r in ROWS)
    with pytest.raises(ValueError):
        bpe.encode_documents(docs.withColumn("ids", F.lit(1)), bpe.default_vocabulary())


def test_lenient_pages(spark):
    assert [b.text for b in blocks("<p>a&amp;b<b>c</b> d<br>e<p>f<script>x</p></script>g<!-- h --><ul><li>i<li>j")] == [
        "a&bc d e", "fg", "i", "j"
    ]
    assert [b.text for b in blocks("<p title='a>b'>c</p><p title=\"x>d</p>")] == ["c", "d"]
    assert blocks("<script>never ends") == [] and blocks("<!-- never ends") == []
    assert len(blocks("<div>" * 3000 + "x" + "</div>" * 3000)) == 1
    rows = [(1, None, None), (2, "u", ""), (2, "u", "<article><p>One two, three.</p></article>" * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(r.text for r in html_crf.extract_texts(pages).collect()) == ["", "", "One two, three. One two, three."]
    assert html_crf.extract_texts(pages.where("page_id > 5")).count() == 0


def test_url_rules(spark):
    rules = [*urls.RULES, ("a.b", "/x", "block"), ("a.b", "/x", "block")]
    cases = {
        "http://WWW.Example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://m.example.com/en/1": ("m.example.com", "/en/1", "example.com/en/", "block"),
        "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "http://x.net?u=/es/": ("x.net", "", None, "allow"),
        "http://x.net/es/#a?b": ("x.net", "/es/", "net/es/", "block"),
        "nothing": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "://com/": ("com", "/", "com/", "allow"),
        "http://c.a.b/xyz": ("c.a.b", "/xyz", "a.b/x", "block"),
        "http://a.b:80/x": ("a.b:80", "/x", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(cases)], "page_id long, url string, rule string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()}
    assert list(cases.values()) == [found[i] for i in range(len(cases))]
    assert {r.verdict for r in urls.judge_urls(pages, [], "block").collect()} == {"block"}


def test_colliding_digests_are_confirmed(monkeypatch, tmp_path):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda k: len(k))
    path = tmp_path / "rules"
    path.write_bytes(urls.rule_file([("aa", "/x", "block"), ("bb", "/y", "allow"), ("cc", "/z", "block")]))
    rules = urls.RuleArray(path)
    assert [rules.rule(j) if j >= 0 else None for j in rules.find([b"bb\0/y", b"cc\0/z", b"dd\0/z"])] == ["bb\0/y", "cc\0/z", None]


def test_hot_group_is_split_and_small_groups_stay_whole(spark):
    rows = [(i, "same text in a third of all rows") for i in range(400)]
    rows += [(1000 + i, sentence(i % 390)) for i in range(800)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 6).toPandas()
    loads = found.groupby("shard")[["size", "tokens", "slot"]].agg({"size": "sum", "tokens": "sum", "slot": "count"})
    assert (loads.max() / loads.mean() < 1.1).all()
    small = found[found.doc_id >= 1000]
    assert (small.groupby("text_crc32").shard.nunique() == 1).all()


def brute_coverage(template, text):
    """Most template words matched in order by text words (longest common subsequence)."""
    row = [0] * (len(text) + 1)
    for a in template:
        last = 0
        for j, b in enumerate(text):
            last, row[j + 1] = row[j + 1], last + 1 if a == b else max(row[j + 1], row[j])
    return row[-1]


def test_licenses_with_changes(spark):
    notice = licences.TEMPLATES["MIT/permission"]
    words = notice.split()
    cut = " ".join(words[:20] + words[23:50] + ["really"] + words[50:])
    rows = [
        (1, f"Intro ñ.\n{cut}\nafter"),
        (2, " ".join(words[: len(words) // 2])),
        (3, f"{notice} middle {notice.upper()}"),
        (4, None), (5, ""), (6, "Released under the"),
        (7, "Released under the MIT License."), (7, "Released under the MIT License."),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = licences.scan(frame).where("license IN ('MIT', 'MIT/permission')").collect()
    assert sorted(r.doc_id for r in found) == [1, 3, 3, 7, 7]
    one = next(r for r in found if r.doc_id == 1)
    read = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    assert one.matched_words == brute_coverage(read(notice), read(rows[0][1]))
    assert rows[0][1][one.start_char : one.end_char].startswith("Permission is hereby")
    assert licences.scan(frame.where("doc_id > 50")).count() == 0
