import random

import numpy as np
from pyspark.sql import functions as F

from sessionrank.llm import langid

from .texts import documents

WORDS = {"xx": "kra tok mip lun gref".split(), "yy": "éla oisé enou quai ielle".split(), "zz": "дом река лес гора небо".split()}


def sample(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", ",", "."]) for _ in range(n))


def training(spark, n=90):
    rng = random.Random(3)
    langs = [["xx", "yy", "zz"][i % 3] for i in range(n)]
    return documents(spark, [sample(rng, k, 30) for k in langs], lang=langs)


def best_path(scores, switch):
    value, back = np.zeros(scores.shape[1]), []
    for row in scores:
        best = value.max() - switch
        back.append(np.where(value >= best, np.arange(len(value)), value.argmax()))
        value = np.maximum(value, best) + row
    state, out = int(value.argmax()), []
    for b in reversed(back):
        out.append(state)
        state = int(b[state])
    return out[::-1]


def test_labels_equal_the_plain_viterbi():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 63, 64, 65, 200, 1, 130])
    for scale in (0.1, 1.0, 4.0):
        scores = rng.normal(size=(lengths.sum(), 4)) * scale
        cuts = np.cumsum(lengths)[:-1]
        want = np.concatenate([best_path(x, 5.0) for x in np.split(scores, cuts)])
        assert (langid.viterbi(scores, lengths, 5.0) == want).all()
        assert (langid.label(scores, lengths, 5.0) == want).all()


def test_predictions_spans_and_awkward_texts(spark):
    rng = random.Random(5)
    model = langid.fit(training(spark))
    first, second = sample(rng, "xx", 30), sample(rng, "zz", 50)
    texts = [sample(rng, "xx", 8), sample(rng, "yy", 8), sample(rng, "zz", 8), f"{first}\n{second}", None, "", "123 !?", "…“”", "漢字", sample(rng, "yy", 3000)]
    got = {r["doc_id"]: r for r in langid.identify(documents(spark, texts), model).collect()}
    assert [got[i]["lang_pred"] for i in range(10)] == ["xx", "yy", "zz", "zz", "und", "und", "und", "und", got[8]["lang_pred"], "yy"]
    assert got[8]["lang_pred"] in model.languages and got[4]["score"] == 0.0
    assert [tuple(s) for s in got[3]["spans"]] == [("xx", 0, len(first) + 1), ("zz", len(first) + 1, len(first) + 1 + len(second))]
    letters = sum(c.isalpha() for c in second)
    assert abs(got[3]["score"] - letters / (letters + sum(c.isalpha() for c in first))) < 1e-9


def test_sample_is_bounded_and_nothing_learned(spark):
    docs = training(spark)
    small = langid.fit(docs, sample_rows=10)
    assert small.languages == ["xx", "yy", "zz"]
    none = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.identify(docs, none).collect()} == {"und"}
    assert langid.identify(docs.limit(0), small).collect() == []


def test_rows_without_ids_and_a_hot_id_are_sampled_by_their_texts(spark):
    docs = training(spark)
    for ids in (F.lit(None).cast("bigint"), F.when(F.col("doc_id") % 3 > 0, F.col("doc_id")).otherwise(7)):
        model = langid.fit(docs.withColumn("doc_id", ids), sample_rows=30)
        assert model.languages == ["xx", "yy", "zz"]
        got = langid.identify(documents(spark, [sample(random.Random(9), k, 30) for k in ("xx", "yy", "zz")]), model).collect()
        assert [r["lang_pred"] for r in got] == ["xx", "yy", "zz"]


def test_more_labels_than_are_learned(spark):
    docs = training(spark).select("doc_id", "text", "lang")
    stray = spark.createDataFrame([(-i, "stray words", f"stray{i}") for i in range(600)], "doc_id bigint, text string, lang string")
    assert langid.fit(docs.union(stray), max_languages=3).languages == ["xx", "yy", "zz"]
    assert len(langid.fit(docs.union(stray)).languages) == langid.MAX_LANGUAGES


def test_numerals_are_no_letters_and_marks_belong_to_words(spark):
    model = langid.fit(training(spark))
    got = langid.identify(documents(spark, ["² ½", "Ⅷ ①", "2²x"]), model).collect()
    assert [r["lang_pred"] == "und" for r in got] == [True, True, False]
    assert langid.words_of("हिन्दी".encode()) == ["हिन्दी".encode()]


def test_accept_keeps_rows_with_letters(spark):
    model = langid.fit(training(spark))
    docs = documents(spark, ["kra tok mip", "123", None, "kra tok mip"], ids=[1, 2, 3, 1])
    kept = langid.accept(docs, model)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1, 1]


def test_held_out_accuracy(spark):
    from sessionrank.llm.queries import op10_language_id

    folder = "/root/testdata/sf0.001"
    held = op10_language_id(spark, folder).filter("held_out").join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = held.collect()
    assert rows and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.9 * len(rows)
