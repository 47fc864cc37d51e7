"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, hit string, items string, shard string, size string, words string, found string"


def documents(spark, texts, **columns):
    """A documents table with further columns whose names clash with those that operators make."""
    n = len(texts)
    ids = columns.get("ids", list(range(n)))
    lang = columns.get("lang", ["en"] * n)
    source = columns.get("source", [f"s{i % 3}" for i in range(n)])
    rows = [
        (i, t, k, s, None if t is None else len(t), "h", "i", "x", "y", "w", "f") for i, t, k, s in zip(ids, texts, lang, source)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(seed=7, n=60, words="ab Abc d éa x9 y-z it, THE o.".split()):
    """Random texts over few words, copies among them, and null, empty, blank and long ones."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 40))) for _ in range(n)]
    texts += texts[:5] + [None, "", "   \n\t", "!!!", None, "a " * 5000, "z" * 3000]
    return texts
