import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from filings_audit.llm import langid, quality
from tests.llm.test_linededup import both
from tests.llm.test_neardup import by_hand

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, 0.0, "x") for i, t, s in rows], SCHEMA)


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def test_stages_keep_the_columns_and_drop_what_they_reject(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = {r.doc_id for r in quality.score(docs, model, ["doc_id"]).where("score >= 0.3").collect()}
    kept = pipeline.drop_low_quality(spark, docs, sf_dir)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good
    languages = langid.predict(docs, langid.train(docs), ["doc_id"]).where("lang_pred != 'und' AND score >= 0.4")
    kept = pipeline.drop_unknown_language(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in languages.collect()}


def test_lines_stage_against_sql(spark):
    rows = [(i, f"menu\nown {i}", "a") for i in range(20)] + [(100, None, "a"), (101, "", None)]
    found = pipeline.drop_boilerplate_lines(spark, frame(spark, rows), "")
    got, wanted = both(spark, rows, pipeline.LINE_SHARE, pipeline.LINE_PAGES)
    assert sorted([(r.doc_id, r.text) for r in found.collect()], key=str) == got == wanted
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in found.collect())


def test_one_full_text_of_many_copies_survives_lines_and_near_duplicates(spark):
    lines = [" ".join(f"w{20 * i + j}" for j in range(20)) for i in range(30)]
    rows = [(i, "menu\n" + " ".join(f"own{i}x{j}" for j in range(30)), "a") for i in range(100)]
    rows += [(1000 + i, "menu\n" + "\n".join(lines), "a") for i in range(20)]
    near = {2000 + i: "\n".join(["menu", *lines[:i], lines[i] + f" edit{i}", *lines[i + 1 :]]) for i in range(20)}
    rows += [(i, t, "a") for i, t in near.items()]
    rows += [(3000 + i, "\n".join(f"b{x}" for x in range(300)), "b") for i in range(20)] + [(4000, "menu", "b")]
    cleaned = pipeline.drop_boilerplate_lines(spark, frame(spark, rows), "")
    found = {r.doc_id: r.text for r in pipeline.keep_one_of_each_group(spark, cleaned, "").collect()}
    texts = {i: t for i, t, _ in rows}
    whole = [i for i, t in found.items() if "w500 " in t]  # no copy has another line there
    assert len(whole) == 1 and found[whole[0]] == texts[whole[0]]
    assert all(any(line in t for t in found.values()) for line in lines)
    assert [i for i in found if i >= 3000] == [3000, 4000] and found[3000] == texts[3000]
    assert all(found[i] == texts[i].removeprefix("menu\n") for i in range(100))


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(9, text, "a"), (4, text + " x", "b"), (7, "other words here", "a"), (7, "other words here", "a")]
    rows += [(1, "", "a"), (2, None, "a"), (None, text, "a"), (3, "", "a")]
    found = pipeline.keep_one_of_each_group(spark, frame(spark, rows), "")
    assert found.columns == frame(spark, []).columns
    assert sorted([r.doc_id for r in found.collect()], key=str) == [1, 2, 3, 4, 7, None]


def test_near_duplicate_stage_tells_rows_of_one_id_apart(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(5, c, "a"), (3, a, "a"), (5, a + " x", "a"), (5, b, "a"), (5, b, "a"), (5, "", "a"), (6, b + " x", "a"), (7, "", "a")]
    found = pipeline.keep_one_of_each_group(spark, frame(spark, rows), "")
    assert sorted((r.doc_id, r.text) for r in found.collect()) == sorted([(3, a), (5, b), (5, c), (5, ""), (7, "")])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = frame(spark, [])
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == frame(spark, []).columns and docs.count() == 0
    assert pipeline.pack_sequences(spark, docs, str(tmp_path)).collect() == []


def test_run(spark, sf_dir):
    found = pipeline.run(spark, sf_dir).collect()
    docs = documents(spark, sf_dir)
    for _, stage in pipeline.STAGES[:3]:  # the first two are held against plain versions in test_classifiers
        docs = stage(spark, docs, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    left = {i: t for i, t in rows if i in {i for i, _, component in by_hand(rows, 5, 80) if i == component or component is None}}
    empty = {i for i, t in rows if not (t or "").split()}
    assert {r.doc_id for r in found} == set(left) | empty
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n_ids = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in left.items()}
    for i, n in n_ids.items():
        assert sum(r.length for r in found if r.doc_id == i) == n
    fill = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 4096
