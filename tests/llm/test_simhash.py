import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sessionrank.llm import simhash
from sessionrank.llm.components import components

from .texts import awkward, documents


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def roots(nodes, linked):
    """The smallest node reachable, by flooding."""
    out = {}
    for n in sorted(nodes):
        if n not in out:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in out:
                    out[x] = n
                    todo += [y for y in nodes if y not in out and linked(x, y)]
    return out


def test_fingerprint_equals_the_plain_sum(spark):
    texts = awkward()
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash.fingerprints(documents(spark, texts)).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}
    spark_hash = spark.createDataFrame([("a b é",)], "s string").select(F.xxhash64("s")).first()[0]
    assert spark_hash % (1 << 64) == xxhash.xxh64_intdigest("a b é".encode(), seed=42)


@pytest.mark.parametrize("block_rows", [64, 1])
@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_have_the_components_of_all_close_pairs(spark, distance, block_rows):
    rng = random.Random(distance)
    values = set()
    for _ in range(12):
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            values.add(v)
            for _ in range(rng.randrange(0, distance + 2)):
                v ^= 1 << rng.randrange(64)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    nodes = sorted(map(signed, values))
    table = spark.createDataFrame([(v,) for v in nodes], "fp bigint")
    links = simhash.links(table, distance, block_rows=block_rows)
    close = lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= distance
    assert all(close(a, b) for a, b in links.collect())
    want = roots(nodes, close)
    got = {n: n for n in nodes} | {r["node"]: r["root"] for r in components(links).collect()}
    assert got == want


def test_groups_of_copies_nulls_and_empty_texts(spark):
    texts = ["one two three four", "ONE  two\nthree four", None, "", "  ", "something else entirely here", "one two three four"]
    found = simhash.groups(documents(spark, texts, ids=[5, 3, 9, 8, None, 1, 5])).collect()
    got = sorted(((r["doc_id"] or -1), r["component_id"]) for r in found)
    assert got == [(-1, 8), (1, 1), (3, 3), (5, 3), (5, 3), (8, 8), (9, 8)]


def test_dedupe_keeps_one_row_of_each_group(spark):
    texts = ["one two three four", "ONE two three four", None, "", "x y z", "one two three four", "x y z"]
    docs = documents(spark, texts, ids=[5, 3, 9, 8, None, 5, None])
    kept = simhash.dedupe(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "x y z"), (3, "ONE two three four"), (8, "")]
    assert simhash.dedupe(docs.limit(0)).collect() == []


def test_components_of_long_chains_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(5000, 5000), (7, None)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + k: 1000 for k in range(50)}
