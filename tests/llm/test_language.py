"""Language identification: held-out accuracy, odd rows, the machines themselves."""

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa

from ledgerloom.llm import language, registry

SCHEMA = "doc_id long, text string, lang string, score string, digest string"
WORDS = {
    "en": "the and of with this there thing that which would",
    "de": "der und die mit nicht schön über gehen auch werden",
    "fr": "le et avec cette être où nous vous était dans",
    "es": "el y con esta ser donde nosotros señor estaba niño",
    "tlh": "qapla jatlh tlhingan batlh maj nuqneh hoch ghoj yaj qay",
}


def sentence(lang, seed, n=12):
    words = WORDS[lang].split()
    return " ".join(np.random.default_rng(seed).choice(words, n)) + "."


def written(spark, tmp_path, rows):
    rows = [(*row, "x", "y") for row in rows]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def answers(spark, folder):
    return registry.QUERIES["op12_languages"](spark, folder)


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = answers(spark, folder).toPandas().set_index("doc_id")
    fold = [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.index]
    assert (found.held_out == fold).all()
    truth = pd.read_parquet(f"{folder}/documents.parquet").set_index("doc_id").lang
    held = found[found.held_out].join(truth)
    assert (held.lang == held.lang_pred).mean() > 0.99
    assert found.score.between(0, 1).all()
    again = answers(spark, folder).toPandas().set_index("doc_id")
    assert again.lang_pred.equals(found.lang_pred.reindex(again.index))


def test_odd_rows(spark, tmp_path):
    rows = [(i, sentence(lang, i), lang) for i, lang in enumerate(list(WORDS) * 60)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(5)]
    rows += [(2000, None, "en"), (2001, "", "de"), (2002, "123 --- \n\t!", None), (None, sentence("fr", 9), None)]
    rows += [(2003, sentence("es", 5, 50_000), None), (2004, sentence("tlh", 5), None), (2005, "ü" * 500_000, None)]
    rows += [(2006, "a", None), (2004, sentence("tlh", 5), None)]
    found = answers(spark, written(spark, tmp_path, rows))
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    found = found.collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i in (2000, 2001, 2002):
        assert by_id[i].lang_pred == "und" and by_id[i].score == 0
    assert by_id[None].lang_pred == "fr" and by_id[2003].lang_pred == "es" and by_id[2004].lang_pred == "tlh"
    assert by_id[2005].lang_pred == "de" and by_id[2006].lang_pred in WORDS
    right = [r.lang_pred == WORDS_OF[r.doc_id] for r in found if r.doc_id in WORDS_OF]
    assert np.mean(right) == 1


WORDS_OF = {i: lang for i, lang in enumerate(list(WORDS) * 60)}


def test_nothing_or_one_language_to_learn(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    rows = [(i, sentence("en", i), None) for i in range(20)]
    found = answers(spark, written(spark, tmp_path / "a", rows)).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0)}
    rows = [(i, sentence("en", i), "en") for i in range(20)]
    assert {r.lang_pred for r in answers(spark, written(spark, tmp_path / "b", rows)).collect()} == {"en"}


def test_an_empty_table(spark, tmp_path):
    assert answers(spark, written(spark, tmp_path, [])).count() == 0


def test_copies_do_not_crowd_the_sample(spark):
    rows = [(sentence("en", 1), "en")] * 3000 + [(sentence("en", i), "en") for i in range(100)] + [(sentence("de", 1), "de")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    picked = language.sample(frame, 60).toPandas()
    assert (picked.lang == "en").sum() == 60 and (picked.lang == "de").sum() == 1
    assert picked.text.is_unique


def test_features_do_not_cross_texts():
    texts = ["Ab cd", "", None, "éÉ--x", "1 2"]
    together, known = language.features(pa.array(texts))
    for i, text in enumerate(texts):
        alone, _ = language.features(pa.array([text], pa.string()))
        assert (alone[0] == together[i]).all()
    assert known.tolist() == [True, False, False, True, False]
    assert np.allclose((together[known] ** 2).sum(axis=1), 1)


def test_a_machine_is_at_its_optimum():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((80, 4))
    y = np.where(x[:, 0] + 0.3 * rng.standard_normal(80) > 0.5, 1.0, -1.0)
    weights = language.fitted(x, y, cost=2.0, rounds=2000, tolerance=1e-9)
    z = np.hstack([x, np.ones((80, 1))])
    cost = 2.0 * 80 / np.where(y > 0, (y > 0).sum(), (y < 0).sum())

    def loss(w):
        return w @ w / 2 + (cost * np.maximum(1 - y * (z @ w), 0) ** 2).sum() / 2

    best = loss(weights)
    assert all(loss(weights + 1e-3 * rng.standard_normal(5)) >= best for _ in range(200))
