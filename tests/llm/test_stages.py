"""The stages of the pipeline on planted rows."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from debutline.llm import language
from pyspark.sql import functions as F
from test_methods import groups_by_hand, windows_by_hand

ROWS = [(1, "one text"), (2, None), (3, ""), (4, "12 - 34 !"), (5, "ß"), (6, "one text"), (None, "x 1")]


@pytest.mark.parametrize("labelled", [False, True])
def test_language_stage_keeps_what_has_a_letter(spark, labelled):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("lang", F.lit("en" if labelled else None).cast("string"))
    got = corpus_pipeline.in_known_languages(spark, docs.repartition(3), "")
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted([ROWS[k] for k in (0, 4, 5, 6)], key=str)


def test_language_stage_goes_by_the_kernel(spark, monkeypatch):
    words = {"en": "the cat and the dog are here with them", "fr": "le chat et le chien sont ici avec eux", "de": "die Katze und der Hund sind hier mit ihnen", "es": "el gato y el perro estan aqui con ellos"}
    rows = [(k, f"{words[lang]} {words[lang]} {k}", lang) for k, lang in enumerate(list(words) * 30)] + [(500, "zq xj qqx jzx wqz xxj zqj", None), (501, "le chat et le chien", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    scores = {r["doc_id"]: r["_score"] for r in language.predict(docs, language.fit(docs.where(language.learnable("doc_id")))).collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.in_known_languages(spark, docs, "").collect()}
    assert kept == {name for name, score in scores.items() if score >= language.LEAST_SCORE} and {*range(120), 501} <= kept
    monkeypatch.setattr(language.determined, "__defaults__", ("_lang", "_score", 0.999))
    strict = {r["doc_id"] for r in corpus_pipeline.in_known_languages(spark, docs, "").collect()}
    assert strict == {name for name, score in scores.items() if score >= 0.999} and strict < kept


def counts(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_later_stages_keep_the_rows_that_brute_force_keeps(spark, tmp_path):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    texts = [" ".join(word() for _ in range(40)) for _ in range(12)]
    passage = " ".join(word() for _ in range(20))
    rows = [(k, text) for k, text in enumerate(texts)] + [(20, texts[3]), (21, texts[3].upper()), (22, texts[5]), (30, f"{texts[0]} {passage}"), (31, passage + f" {word()}" * 600), (40, "12 34")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.createDataFrame([(1, passage), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = counts(corpus_pipeline.distinct(spark, docs, str(tmp_path)))
    assert kept == Counter({component for _, _, component in groups_by_hand(rows)}) and not {20, 21, 22} & set(kept)
    kept = counts(corpus_pipeline.decontaminated(spark, docs, str(tmp_path)))
    assert kept == Counter(row[0] for row in windows_by_hand(rows, [(1, passage), (2, "")], 13) if not row[-1]) and 30 not in kept and 31 in kept
    # one source is its own target: every document once
    assert counts(corpus_pipeline.mixture(spark, docs.withColumn("source", F.lit("a")), str(tmp_path))) == Counter(row[0] for row in rows)
