import math

import numpy as np
import pytest

from sessionrank.llm import shard

from .texts import awkward, documents


@pytest.mark.parametrize("part_rows", [2000, 5])
def test_sizes_slots_and_rows(spark, part_rows):
    texts = awkward(1, 120)
    docs = documents(spark, texts, ids=[i % 100 if i % 7 else None for i in range(len(texts))])
    out = shard.shuffle(docs, part_rows=part_rows)
    rows = out.collect()
    assert out.columns == [*(c for c in docs.columns if c != "shard"), "shard", "slot"]
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    plain = lambda some: sorted((str(r["doc_id"]), str(r["text"]), r["source"]) for r in some)
    assert plain(rows) == plain(docs.collect())
    place = lambda some: sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in some)
    assert place(shard.shuffle(docs.repartition(5), part_rows=part_rows).collect()) == place(rows)


def test_few_rows_and_none(spark):
    docs = documents(spark, ["a", None, "c"])
    assert sorted(r["shard"] for r in shard.shuffle(docs).collect()) == [0, 1, 2]
    assert shard.shuffle(docs.limit(0)).collect() == []


def test_matrix_margins_are_exact():
    parts = [5, 0, 17, 400, 3, 1]
    rows = shard.matrix(parts, 4)
    assert [sum(r) for r in rows] == parts and sorted(map(sum, zip(*rows))) == [106, 106, 107, 107]


def test_draws_follow_the_hypergeometric_law():
    random = np.random.default_rng(5)
    good, bad, drawn, n = 9, 14, 8, 20000
    counts = np.bincount([shard.hypergeometric(good, bad, drawn, random) for _ in range(n)], minlength=9)
    law = np.array([math.comb(good, k) * math.comb(bad, drawn - k) / math.comb(good + bad, drawn) for k in range(9)])
    assert ((counts - n * law) ** 2 / (n * law)).sum() < 30
    big = [shard.hypergeometric(4 * 10**9, 28 * 10**9, 10**7, random) for _ in range(300)]
    assert abs(np.mean(big) - 1.25e6) < 4 * 1046 / 300 ** 0.5 and 900 < np.std(big) < 1200


def test_every_arrangement_is_equally_likely(spark):
    docs = documents(spark, ["x"] * 6).cache()
    first = [[r["doc_id"] for r in shard.shuffle(docs, shards=2, seed=s, part_rows=2).orderBy("shard", "slot").collect()] for s in range(60)]
    means = np.mean([[row.index(i) for i in range(6)] for row in first], axis=0)
    assert np.abs(means - 2.5).max() < 1.0


def test_copies_of_a_row_are_dealt_independently(spark):
    n = 600
    docs = documents(spark, [f"t{i}" for i in range(n)] * 3, ids=list(range(n)) * 3, source=["s"] * (3 * n))
    places = {}
    for r in shard.shuffle(docs, part_rows=50).collect():
        places.setdefault((r["doc_id"], r["text"]), []).append((r["shard"], r["slot"]))
    assert len(places) == n and all(len(set(p)) == 3 for p in places.values())
    pairs = [(a, b) for p in places.values() for a, b in ((p[0], p[1]), (p[0], p[2]), (p[1], p[2]))]
    together = sum(a[0] == b[0] for a, b in pairs) / len(pairs)
    assert abs(together - 1 / 8) < 0.05
    assert sum(a[0] == b[0] and abs(a[1] - b[1]) == 1 for a, b in pairs) < 0.02 * len(pairs)


def test_rows_of_one_id_and_of_none_are_spread(spark):
    docs = documents(spark, [f"t{i % 400}" for i in range(1600)], ids=[None] * 800 + [7] * 800, source=["s"] * 1600)
    slots = {}
    for r in shard.shuffle(docs, part_rows=50).collect():
        slots.setdefault(r["shard"], []).append((r["slot"], r["doc_id"]))
    for rows in slots.values():  # neighbours have the same id by chance only
        ids = [i for _, i in sorted(rows, key=lambda x: x[0])]
        assert sum(a == b for a, b in zip(ids, ids[1:])) < 0.65 * len(ids)
