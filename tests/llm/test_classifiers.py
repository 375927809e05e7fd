import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from filings_audit.llm import langid, quality
from filings_audit.llm.common import held_out, pieces
from filings_audit.llm.queries import op4_quality, op9_langid
from tests.test_forest import run_alone

SCHEMA = "doc_id long, text string, lang string, source string, score double, lang_pred string, id string, y string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0.5, "x", "i", "y") for i, t, lang in rows], SCHEMA)


def test_held_out(spark):
    rows = spark.range(-5, 200).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


# Languages ------------------------------------------------------------------------------------------

TEXTS = {"en": "the cat and the dog are with the house of stone", "de": "der hund und die katze sind mit dem haus aus stein"}


def trained(spark, **limits):
    rows = [(i, TEXTS[lang], lang) for i, lang in enumerate(["en", "de"] * 20)]
    return langid.train(frame(spark, rows), langid.Limits(**limits))


def test_words_first_then_shorter_and_shorter_ngrams(spark):
    model = trained(spark)
    assert model.languages == ["de", "en"]
    seen = model_total(model, "en") / len(TEXTS["en"].split()) * TEXTS["en"].split().count("the")
    the = langid.word_scores(model, "the")
    assert the[1] - the[0] == pytest.approx(
        np.log(seen / 0.5) - np.log((model_total(model, "en") + 1) / (model_total(model, "de") + 1)), abs=1e-9)
    for word, language in (("hunde", "de"), ("stones", "en"), ("katzen", "de")):
        assert word not in model.words and model.languages[int(np.argmax(langid.word_scores(model, word)))] == language
    assert not langid.word_scores(model, "жж").any()
    # The longest order of which any gram is known decides alone.
    grams = [g for g in ("_dog", "dogx", "ogx_") if g in model.grams]
    five = [g for g in ("_dogx", "dogx_") if g in model.grams]
    assert not five and grams == ["_dog"]
    assert np.allclose(langid.word_scores(model, "dogx"), langid._row(model.gram_table, model.grams["_dog"]))


def model_total(model, language):
    """Words learnt in a language: rows not held out, ten words each."""
    learnt = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    return sum(len(TEXTS[language].split()) for i in learnt if (i % 2 == 0) == (language == "en"))


def test_predictions_of_odd_texts(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !! --", "en"), (4, "THE DOG", "de"), (5, "und " * 100_000, None), (5, "und", None),
            (None, "the house", "en"), (6, "жжж", None)]
    found = langid.predict(frame(spark, rows), trained(spark), ["doc_id", "text"]).collect()
    got = {(r.doc_id, (r.text or "")[:9]): (r.lang_pred, r.score) for r in found}
    assert got[1, ""] == got[2, ""] == got[3, "123 !! --"] == ("und", 0.0)
    assert got[4, "THE DOG"][0] == got[None, "the house"][0] == "en" and got[5, "und"][0] == "de"
    assert got[6, "жжж"] == ("de", 0.5)  # a tie goes to the first language
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)


def test_limits_and_empty_tables(spark):
    small = trained(spark, words=3, grams=4)
    assert len(small.words) <= 6 and len(small.grams) <= 2 * 4 * len(langid.ORDERS)
    few = trained(spark, entries=32)
    assert len(few.words) <= 2 * 6 and len(few.grams) <= 2 * 2 * len(langid.ORDERS)
    model = langid.train(frame(spark, []))
    assert model.languages == [] and langid.predict(frame(spark, []), model, ["doc_id"]).collect() == []
    assert langid.predict(frame(spark, [(1, "a", None)]), model, ["doc_id"]).first().lang_pred == "und"


def test_rare_languages_are_learnt_however_many_rows_others_have(spark):
    learnt = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "the dogs", "en") for i in learnt[30:]] + [(i, f"rare{i % 10} word", f"r{i % 10}") for i in learnt[:30]]
    model = langid.train(frame(spark, rows), langid.Limits(documents=200))
    rare = {lang for _, _, lang in rows} - {"en"}
    assert model.languages == ["en", *sorted(rare)]
    assert langid._quota([(3, 10), (1000, 1)], 200) == 170 and langid._quota([(3, 10), (170, 1)], 200) is None
    assert langid._quota([(1, 50)], 10) == 0.2 and langid._quota([], 10) is None


def test_held_out_languages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = op9_langid(spark, sf_dir).join(docs, "doc_id").where("held_out").collect()
    assert len(found) > 10 and np.mean([r.lang == r.lang_pred for r in found]) > 0.97


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows = [(i, TEXTS["en"] if zlib.crc32(str(i).encode()) % 5 else "quark " * 9, "en" if zlib.crc32(str(i).encode()) % 5 else "zz") for i in range(60)]
    assert langid.train(frame(spark, rows)).languages == ["en"]


def by_hand(rows, evidence=20):
    """Language and score of every row, from the counts of the rows that are not held out."""

    def cut(text):
        low = text.lower() if text else ""
        return "".join(c if unicodedata.category(c).startswith("L") else " " for c in low).split()

    words, grams = {}, {}
    for i, text, lang in rows:
        if lang is None or text is None or i is None or zlib.crc32(str(i).encode()) % 5 == 0:
            continue
        for word in cut(text):
            words.setdefault(lang, Counter())[word] += 1
    languages = sorted(words)
    for lang, counts in words.items():
        grams[lang] = Counter()
        for word, n in counts.items():
            padded = f"_{word}_"
            for order in langid.ORDERS:
                for at in range(len(padded) - order + 1):
                    grams[lang][padded[at : at + order]] += n
    n_words = {lang: sum(c.values()) + 1 for lang, c in words.items()}
    n_letters = {lang: sum(n * (len(w) + 2) for w, n in c.items()) + 1 for lang, c in words.items()}
    known = {w for c in words.values() for w, n in c.items() if n > 1}
    all_grams = {g for c in grams.values() for g in c}

    def one(word):
        if word in known:
            return [np.log((words[lang][word] if words[lang][word] > 1 else 0.5) / n_words[lang]) for lang in languages]
        padded = f"_{word}_"
        for order in langid.ORDERS:
            some = [padded[i : i + order] for i in range(len(padded) - order + 1)] if order > 1 else list(word)
            some = [g for g in some if g in all_grams]
            if some:
                return np.mean([[np.log((grams[lang][g] or 0.5) / n_letters[lang]) for lang in languages] for g in some], axis=0)
        return np.zeros(len(languages))

    out = []
    for i, text, _ in rows:
        found = cut(text)
        if not found or not languages:
            out.append((i, "und", 0.0))
            continue
        mean = np.mean([one(w) for w in found], axis=0)
        weight = np.exp((mean - mean.max()) * min(len(found), evidence))
        out.append((i, languages[int(np.argmax(weight))], float(weight.max() / weight.sum())))
    return out


def test_whole_texts_against_plain_counts(spark):
    """300 languages, numerals that are no letters, combining marks, letters of other scripts."""
    r = np.random.default_rng(9)
    odd = ["½ ² Ⅷ", "e\u0301te\u0301 x²y", "日本 語", "٣ ४", "ªº ʰ", "Straße ǅ", "don't", "a_b c1d", "", "𝔄𝔟 𝟙"]
    rows = []
    for i in range(900):
        lang = f"l{i % 300:03d}"
        own = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i % 6]}{'aeiou'[k]}" for k in range(5)]
        rows.append((i, " ".join([*r.choice(own, 6), odd[i % 10]]), lang))
    rows += [(900 + i, text, None) for i, text in enumerate([*odd, None, "unknown zzz", "akua akua"])] + [(None, "akua", "l000")]
    got = langid.identify(frame(spark, rows), ["doc_id"], langid.Limits(entries=10**9)).collect()
    wanted = by_hand(rows)
    assert [(g.doc_id, g.lang_pred) for g in got] == [(i, lang) for i, lang, _ in wanted]
    assert np.allclose([g.score for g in got], [score for *_, score in wanted])
    assert {g.doc_id: g.lang_pred for g in got}[900] == "und"


def test_results_must_not_clash_with_kept_columns(spark):
    with pytest.raises(ValueError, match="lang_pred"):
        langid.predict(frame(spark, []), trained(spark), ["lang_pred"])


# Quality --------------------------------------------------------------------------------------------

def corpus(n=400):
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(200)]
    good = [" ".join(r.choice(words, 40)) for _ in range(n)]
    bad = [" ".join(w.upper() + "!!" for w in r.choice(words, 40)) for _ in range(n // 4)]
    return [(i, t, "en") for i, t in enumerate(good + bad)], [(i, int(i < n)) for i in range(n + n // 4)]


def test_quality_is_learnt_from_labels(spark):
    rows, labels = corpus()
    docs = frame(spark, rows)
    marks = spark.createDataFrame([*labels, (None, 1), (3, None), (3, 1), (10**6, 0)], "doc_id long, quality int")
    model = quality.train(docs, marks)
    out = {r.doc_id: r.score for r in quality.score(docs, model, ["doc_id"]).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(out[i] >= 0.3) == (dict(labels)[i] == 1) for i in held]) > 0.97
    again = quality.train(docs.repartition(5), marks)
    assert all(np.allclose(a, b) for a, b in zip(model.layers, again.layers)) and model.temperature == again.temperature
    odd = frame(spark, [(1, None, "a"), (2, "", "b"), (3, " ", "c"), (4, "w1 " * 200_000, "d"), (4, "w1", "d"), (None, "w2", "e")])
    scores = [r.score for r in quality.score(odd, model, ["doc_id"]).collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1] == scores[2]


def test_without_labels_or_rows(spark):
    rows, _ = corpus(20)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(frame(spark, rows), none) is None
    assert {r.score for r in quality.score(frame(spark, rows), None, ["doc_id"]).collect()} == {0.5}
    assert quality.train(frame(spark, []), none) is None
    assert quality.score(frame(spark, []), None, ["doc_id"]).collect() == []


def test_word_vectors_against_plain_sums(spark):
    settings = quality.Settings(buckets=64, width=8, nonzero=2)
    texts = ["a b a c", "b", None, "c a!"]
    places, signs = quality.index_vectors(settings)
    total = np.zeros((64, 8))
    for text in texts:
        found = [zlib.crc32(w.encode()) % 64 for w in quality._tokens(text or "")]
        for x, y in [*zip(found, found[1:]), *zip(found[1:], found)]:
            np.add.at(total[x], places[y], signs[y])
    wanted = total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    got = quality.word_vectors(frame(spark, [(i, t, "x") for i, t in enumerate(texts)]).repartition(2), settings)
    assert np.allclose(got, wanted, atol=1e-6)


def test_quality_of_whole_texts_against_plain_loops(spark):
    """Scores of every row from the model, token by token."""
    rows, labels = corpus(60)
    rows += [(10**6, "w1 w2!!w3\tÉté ½ x_y\n" * 30, "en"), (10**6 + 1, None, "en"), (10**6 + 2, "", "en"), (10**6 + 3, "w7" * 5000, "en")]
    docs = frame(spark, rows)
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r.doc_id: r.score for r in quality.score(docs, model, ["doc_id"]).collect()}
    for i, text, _ in rows:
        found = [zlib.crc32(w.encode()) % quality.Settings().buckets for w in quality._tokens(text or "")]
        x = np.zeros(2 * 32)
        if found:
            vectors = model.vectors[found].astype(float)
            x[:32] = vectors.mean(axis=0)
            x[32:] = np.abs(np.diff(vectors, axis=0)).sum(axis=0) / len(found)
        x = np.clip((x - model.mean) / model.scale, -8, 8)
        w1, b1, w2, b2 = model.layers
        logit = (np.maximum(x @ w1 + b1, 0) @ w2 + b2[0]) / model.temperature
        assert got[i] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4)


def test_pieces_end_before_white_space():
    text = "ab cd\u00a0efgh  i" * 50
    for size in (1, 7, 100, 10**6):
        some = list(pieces(text, size))
        assert "".join(some) == text and sum((p.split() for p in some), []) == text.split()


def test_pool_and_temperature():
    vectors = np.array([[1.0, 0.0], [0.0, 2.0]], np.float32)
    pooled = quality.pool(np.array([0, 1, 1, 0]), np.array([2, 0, 1, 1]), vectors)
    assert np.allclose(pooled, [[0.5, 1, 0.5, 1], [0, 0, 0, 0], [0, 2, 0, 0], [1, 0, 0, 0]])
    y = (np.arange(2000) % 10 < 8).astype(float)
    assert quality.fit_temperature(np.where(y == 1, 6.0, 6.0), y) > 3  # overconfident scores are cooled


def test_held_out_quality(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = op4_quality(spark, sf_dir)
    assert found.where("predicted != int(score >= 0.3)").count() == 0
    rows = found.join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9


def test_executors_need_not_have_the_package(tmp_path):
    run_alone(tmp_path, """
from filings_audit.llm import langid, quality
texts = spark.range(200).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'the cat sat' ELSE 'der hund lief' END AS text", "CASE WHEN id % 2 = 0 THEN 'en' ELSE 'de' END AS lang")
assert langid.identify(texts, ["doc_id"]).where("lang_pred IN ('en', 'de')").count() == 200
labels = texts.selectExpr("doc_id", "int(doc_id % 2) AS quality")
assert quality.score(texts, quality.train(texts, labels), ["doc_id"]).where("score BETWEEN 0 AND 1").count() == 200
""")
