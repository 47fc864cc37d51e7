import itertools
import random

import numpy as np

from sessionrank.llm import toxicity
from sessionrank.llm.queries import remainder
from tests.llm.texts import awkward, documents

LABELS = "doc_id bigint, toxic int, quality int, score string"


def test_marginals_equal_sums_over_all_taggings():
    rng = np.random.default_rng(1)
    change = rng.normal(size=(2, 2))
    lengths = np.array([3, 1, 9])
    scores = rng.normal(size=13) * 3
    expected = []
    for first, n in zip((0, 3, 4), lengths):
        weight = np.zeros((n, 2))
        for tags in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(change[a, b] for a, b in zip((0, *tags), tags)) + scores[first:first + n] @ np.array(tags))
            for i, t in enumerate(tags):
                weight[i, t] += w
        expected += (weight[:, 1] / weight.sum(1)).tolist()
    assert np.allclose(toxicity.marginals(scores, lengths, change), expected)


def test_runs_are_joined_exactly():
    """A text of many runs has the probabilities of a plain pass from end to end."""
    rng = np.random.default_rng(2)
    change, n = rng.normal(size=(2, 2)), 500
    scores = rng.normal(size=n) * 4
    step, alpha, state = np.exp(change), [], np.array([1.0, 0.0])
    for s in scores:
        state = state @ step * [1, np.exp(s)]
        state /= state.sum()
        alpha.append(state)
    beta, out = np.ones(2), np.zeros(n)
    for i in reversed(range(n)):
        both = alpha[i] * beta
        out[i] = both[1] / both.sum()
        beta = step @ (beta * [1, np.exp(scores[i])])
        beta /= beta.sum()
    parts = toxicity.marginals(np.concatenate([scores[:7], scores, scores[:64]]), np.array([7, n, 64]), change)
    assert np.allclose(parts[7:7 + n], out)


def test_training_follows_the_likelihood():
    """At the fitted weights the tags and the expected tags agree, but for the ridge."""
    words = ["you", "bad", "man", "so", "bad", "bad", "day"]
    theta, change = toxicity.train(words, [3, 4], [0, 1, 0, 0, 1, 0, 0], rounds=400)
    tagger = toxicity.Tagger(theta, change)
    p = np.concatenate(tagger.probabilities(["you bad man", "so bad bad day"]))
    assert p[[1, 4]].min() > 0.5 > p[[0, 2, 3, 6]].max()
    assert abs(p.sum() - 2) < 0.3


def made(spark, n=900, seed=5):
    rng = random.Random(seed)
    plain = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    texts, toxic = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 120))]
        toxic.append(int(i % 6 == 0))
        if toxic[-1]:
            for _ in range(rng.randrange(2, 5)):
                words[rng.randrange(len(words))] = rng.choice(("Zorkish", "zorkly,", "GRUBB", "grubb", "wuxing!"))
        texts.append(" ".join(words))
    return documents(spark, texts), spark.createDataFrame([(i, k, 1, "x") for i, k in enumerate(toxic)], LABELS), texts, toxic


def test_held_out_documents_and_spans(spark):
    docs, labels, texts, toxic = made(spark)
    held_out = remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, labels.filter(~held_out))
    found = {r["doc_id"]: r for r in toxicity.tag(docs, model).collect()}
    held = [r["doc_id"] for r in docs.filter(held_out).select("doc_id").collect()]
    assert np.mean([(found[i]["score"] >= 0.7) == toxic[i] for i in held]) > 0.97
    spans = [texts[i][s["start"]:s["end"]].lower() for i in held for s in found[i]["spans"]]
    assert len(spans) > 50 and np.mean([s.startswith(("zork", "grubb", "wuxing")) for s in spans]) > 0.95
    again = {r["doc_id"]: r for r in toxicity.tag(docs.repartition(7), toxicity.fit(docs.repartition(5), labels.filter(~held_out))).collect()}
    assert max(abs(again[i]["score"] - found[i]["score"]) for i in found) < 1e-6


def test_awkward_rows(spark):
    texts = awkward()
    docs = documents(spark, texts, ids=[None if i % 5 == 0 else i % 20 for i in range(len(texts))])
    labels = spark.createDataFrame([(i % 20, i % 2, None, None) for i in range(30)] + [(None, 1, 1, ""), (3, None, 0, "")], LABELS)
    found = toxicity.tag(docs, toxicity.fit(docs, labels), keep=("doc_id", "text")).collect()
    assert len(found) == len(texts) and all(0 <= r["score"] <= 1 for r in found)
    empty = {r["score"] for r in found if not (r["text"] or "").strip("! \n\t")}
    assert len(empty) == 1 and all(r["n_words"] == 0 for r in found if r["text"] is None)


def test_without_labels_of_both_kinds(spark):
    docs = documents(spark, ["some text", None, "more"])
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in toxicity.tag(docs, toxicity.fit(docs, none)).collect()} == {0.5}
    clean = spark.createDataFrame([(0, 0, 1, ""), (2, 0, 1, ""), (9, 1, 1, "")], LABELS)  # the toxic one has no document
    scores = {r["score"] for r in toxicity.tag(docs, toxicity.fit(docs, clean)).collect()}
    assert len(scores) == 1 and scores.pop() < 0.3
    assert toxicity.tag(docs.limit(0), toxicity.fit(docs.limit(0), clean)).count() == 0


def test_a_hot_id_does_not_fill_the_sample(spark):
    docs = documents(spark, [f"text number {i}" for i in range(3000)], ids=[7] * 1000 + list(range(1000, 3000)))
    labels = spark.createDataFrame([(7, 1, 1, "")] + [(i, i % 2, 1, "") for i in range(1000, 3000)], LABELS)
    sample = toxicity.labelled_sample(docs, labels, rows=50)
    assert 20 < sample.count() < 450
