"""Results of the registered queries against brute force, other libraries and SQL."""

import hashlib
import html
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from ledgerloom.llm import html_crf, registry
from ledgerloom.llm.html_pages import labelled_page

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(folder_):
    return pd.read_parquet(f"{folder_}/documents.parquet").set_index("doc_id").sort_index()


@pytest.fixture(scope="module")
def folder_():
    return "/root/testdata/sf0.001"


def result(spark, folder_, name, index="doc_id"):
    frame = registry.QUERIES[name](spark, folder_).toPandas()
    return frame.set_index(index).sort_index()


@pytest.mark.parametrize("name", sorted(set(registry.ORACLES) - {"pipeline"}))
def test_sql_counterparts(spark, folder_, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder_}/{table}.parquet'")
    ours = registry.QUERIES[name](spark, folder_).toPandas()
    theirs = db.sql(registry.ORACLES[name]).df()[list(ours.columns)]
    order = list(ours.columns)
    pd.testing.assert_frame_equal(
        ours.sort_values(order).reset_index(drop=True),
        theirs.sort_values(order).reset_index(drop=True),
        check_dtype=False,
    )


def test_mix_keeps_to_its_bounds(spark, folder_, documents):
    mix = result(spark, folder_, "op1_mix_sources").join(documents.source)
    assert (mix.taken <= 3 * mix["size"]).all()
    assert mix.taken.sum() <= mix["size"].sum()
    by = mix.groupby("source").agg(
        taken=("taken", "sum"), target=("target", "first"), most=("size", "max")
    )
    assert ((by.taken - by.target).abs() <= by.most).all()
    again = result(spark, folder_, "op1_mix_sources")
    assert again.taken.equals(mix.taken)


def test_fingerprints_and_edited_texts(spark, folder_, documents):
    found = result(spark, folder_, "op2_fingerprint_documents")
    texts = documents.text.tolist()
    for i, doc_id in enumerate(documents.index):
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + texts[(i + 1) % len(texts)][:half]
        assert found.edited_sha256[doc_id] == hashlib.sha256(edited.encode()).hexdigest()
        assert found.n_chars[doc_id] == len(texts[i])
    assert found.fingerprint.groupby(documents.text).nunique().max() == 1
    assert found.fingerprint.nunique() == documents.text.nunique()
    assert (found.near_edited > found.near_next).mean() > 0.95
    assert found.near_edited.between(0, 1).all() and found.near_next.between(0, 1).all()


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = result(spark, folder, "op3_quality_scores")
    labels = pd.read_parquet(f"{folder}/labels.parquet").set_index("doc_id")
    fold = [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.index]
    assert (found.held_out == fold).all()
    held = found[found.held_out].join(labels, how="inner")
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good.values[:, None] > bad.values[None, :]).mean() > 0.97
    assert (held.predicted == held.quality).mean() > 0.97


def brute_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Lowest id reachable over links of at most 4 bits."""
    ids, values = list(prints), np.array(list(prints.values()), np.uint64)
    lowest = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for i, one in enumerate(ids):
            near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4)
            least = min(lowest[ids[j]] for j in near)
            for j in near:
                if lowest[ids[j]] > least:
                    lowest[ids[j]], changed = least, True
    return lowest


def test_simhash_components(spark, folder_, documents):
    found = result(spark, folder_, "op4_simhash_near_duplicates")
    prints = {i: brute_fingerprint(t) for i, t in documents.text.items()}
    assert found.fingerprint.to_dict() == {i: f"{p:016x}" for i, p in prints.items()}
    assert found.component_id.to_dict() == brute_components(prints)


def test_tokens_as_the_library_gives_them(spark, folder_, documents):
    tokenizers = pytest.importorskip("tokenizers")
    from ledgerloom.llm.bpe import default_vocabulary

    library = tokenizers.Tokenizer.from_file(default_vocabulary())
    found = result(spark, folder_, "op6_bpe_round_trip")
    for doc_id, text in documents.text.items():
        ids = library.encode(text, add_special_tokens=False).ids
        row = found.loc[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_main_text_of_the_given_pages(spark, folder_):
    found = result(spark, folder_, "op7_main_text", "page_id")
    pages = pd.read_parquet(f"{folder_}/pages.parquet").set_index("page_id")
    right = 0
    for page_id, page in pages.html.items():
        article = re.search(r"<article>(.*)</article>", page, re.S).group(1)
        plain = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", article)).split())
        right += found.text[page_id] == plain
        assert found.n_chars[page_id] == len(found.text[page_id])
    assert right >= 0.99 * len(pages)


def test_main_text_of_held_out_layouts():
    model, right, total = html_crf.trained(), 0, 0
    for seed in range(10_000, 10_200):
        found, labels = html_crf.labelled(seed)
        page, _ = labelled_page(seed)
        guessed = model.decode(model.scores(html_crf.blocks(page)))
        right += sum(a == b for a, b in zip(guessed, labels))
        total += len(labels)
    assert right / total > 0.97


def test_shards_are_even_and_slots_gapless(spark, folder_, documents):
    found = result(spark, folder_, "op9_pack_shards")
    sizes = documents.text.map(lambda t: len(t.encode()) + 8)
    assert found["size"].to_dict() == sizes.to_dict()
    assert found.text_crc32.to_dict() == documents.text.map(lambda t: zlib.crc32(t.encode())).to_dict()
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    loads = found.groupby("shard")["size"].sum()
    assert len(loads) == 24 and loads.max() - loads.min() <= 2 * sizes.max()


def test_license_spans(spark, folder_, documents):
    from ledgerloom.llm.licences import TEMPLATES

    found = registry.QUERIES["op10_license_notices"](spark, folder_).toPandas()
    expected = {
        (i, name)
        for i, text in documents.text.items()
        for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0")
        if TEMPLATES[name] in text
    }
    exact = found[found.coverage == 1]
    assert expected and set(zip(exact.doc_id, exact.license)) == expected
    for row in exact.itertuples():
        span = documents.text[row.doc_id][row.start_char : row.end_char]
        assert span == TEMPLATES[row.license].rstrip(".")


def test_pipeline_against_its_operators(spark, folder_):
    """Each stage's decisions, made again from the operators' own results, give the same rows."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{folder_}/documents.parquet")
    columns = docs.columns
    kept = result(spark, folder_, "op5_quality_rules").kept
    for name, stage in pipeline.STAGES[:-1]:
        before = docs.toPandas()
        docs = spark.createDataFrame(stage(spark, docs, folder_).toPandas(), docs.schema)
        assert docs.columns == columns
        after = docs.toPandas()
        if name == "quality_rules":
            assert set(after.doc_id) == set(kept[kept].index)
        elif name == "quality_classifier":
            assert set(after.doc_id) < set(before.doc_id)
        elif name == "simhash_near_dedup":
            prints = {r.doc_id: brute_fingerprint(r.text) for r in before.itertuples()}
            assert sorted(after.doc_id) == sorted(set(brute_components(prints).values()))
        else:
            words = lambda frame: frame.text.map(lambda t: len(WORD.findall(t))).sum()
            assert 0.9 * words(before) <= words(after) <= words(before)
            assert after.doc_id.value_counts().max() <= 3
    last = pipeline.STAGES[-1][1](spark, docs, folder_).toPandas()
    whole = pipeline.run(spark, folder_).toPandas()
    assert sorted(zip(last.doc_id, last.n_tokens)) == sorted(zip(whole.doc_id, whole.n_tokens))
    assert (whole.ids.map(len) == whole.n_tokens).all()
