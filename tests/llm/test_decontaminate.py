import random
import re

import pytest

from sessionrank.llm import decontaminate as d

from .texts import awkward, documents


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(texts, items, size):
    out = []
    runs = {}
    for name, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            runs.setdefault(tuple(w[i:i + size]), set()).add("null" if name is None else str(name))
    for text in texts:
        w, hit, found = words_of(text), set(), set()
        for run, names in runs.items():
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i:i + len(run)]) == run:
                    hit |= set(range(i, i + len(run)))
                    found |= names
        out.append((len(w), len(hit), tuple(sorted(found)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def test_wu_manber_finds_every_occurrence():
    rng = random.Random(1)
    for _ in range(60):
        words = ["a", "bb", "ccc", "dddddddd", "é"][:rng.randrange(1, 6)]
        text = f" {' '.join(rng.choice(words) for _ in range(rng.randrange(0, 200)))} ".encode()
        strings = list({f" {' '.join(rng.choice(words) for _ in range(rng.randrange(1, 6)))} ".encode() for _ in range(8)})
        raw, flat, _, _ = d.single_spaced([text])
        found = sorted((strings[k], s) for ks, t in d.searchers(strings) for k, s in zip(ks[t.find(raw, flat, 3)[0]], t.find(raw, flat, 3)[1]))
        naive = sorted((p, i) for p in strings for i in range(len(raw)) if raw.startswith(p, i))
        assert found == naive


@pytest.mark.parametrize("block_windows", [1000, 40])
def test_hits_items_and_blocks(spark, block_windows):
    texts = awkward()
    bench = [(i, t) for i, t in enumerate(awkward(8, 20))] + [(3, "ab abc"), (None, "the o x9 d"), (77, "it")]
    items = spark.createDataFrame([(i, t, "x") for i, t in bench], "item_id bigint, text string, hit string")
    found = d.judged(d.find_items(documents(spark, texts), items, words=4, block_windows=block_windows)).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in found}
    assert [got[i] for i in range(len(texts))] == brute(texts, bench, 4)


def test_windows_do_not_cross_documents(spark):
    items = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    found = d.find_items(documents(spark, ["zero one two", "three four", "one, two; THREE"]), items)
    assert sorted((r["doc_id"], len(r["items"])) for r in found.collect()) == [(0, 0), (1, 0), (2, 1)]


def test_empty_tables_and_clean(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = documents(spark, ["a b", None, "the whole test item", "the whole test item"], ids=[1, 1, 2, 2])
    assert d.clean(docs, none).count() == 4
    assert d.find_items(docs.limit(0), none).collect() == []
    items = spark.createDataFrame([(1, "The whole TEST item")], "item_id bigint, text string")
    kept = d.clean(docs, items)
    assert kept.columns == docs.columns and sorted(r["text"] or "" for r in kept.collect()) == ["", "a b"]
