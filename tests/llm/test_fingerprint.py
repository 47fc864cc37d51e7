import hashlib
import re

import xxhash
from pyspark.sql import functions as F

from sessionrank.llm import fingerprint as f

from .texts import awkward, documents


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def spark_hash(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed=seed)


def long_hash(value, lane):
    """Spark's xxhash64 of a bigint and an int: the hash of the first seeds the second."""
    first = spark_hash((value % (1 << 64)).to_bytes(8, "little"))
    return spark_hash(lane.to_bytes(4, "little"), first)


def brute(text):
    exact, count, bits = [0] * f.EXACT, 0, [0] * 64
    for line in (text or "").split("\n"):
        h = spark_hash(line.encode())
        exact = [(e + (long_hash(h, j) & 0xFFFFFFFF)) % (1 << 32) for j, e in enumerate(exact)]
        words = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", line)
        for i in range(0, len(words), f.PIECE):
            p = spark_hash("".join(words[i:i + f.PIECE]).encode())
            count += 1
            bits = [b + (p >> k & 1) for k, b in enumerate(bits)]
    return [*exact, count, *((count - 2 * b) % (1 << 16) for b in bits)]


def test_vectors_equal_the_plain_sum(spark):
    texts = [t for t in awkward(2, 20)] + ["a b\nc d e f g\n\nh", "  lead\ttab", "é😀 x\n"]
    got = {r["doc_id"]: r["vector"] for r in f.vectors(documents(spark, texts).select("doc_id", "text"), ["doc_id"], "text").collect()}
    assert [got[i] for i in range(len(texts))] == [brute(t) for t in texts]


def test_paragraph_order_does_not_matter_and_paragraphs_come_and_go(spark):
    texts = ["one two three\nfour\nfive six", "five six\none two three\nfour", "one two three\nfour", "five six", "one two\nthree four\nfive six"]
    rows = f.vectors(documents(spark, texts).select("doc_id", "text"), ["doc_id"], "text")
    v = {r["doc_id"]: r["vector"] for r in rows.collect()}
    assert v[0] == v[1] != v[4]
    pair = spark.createDataFrame([(v[2], v[3], v[0])], "a array<bigint>, b array<bigint>, c array<bigint>")
    r = pair.select(f.plus(F.col("a"), F.col("b")).alias("p"), f.minus(F.col("c"), F.col("b")).alias("m")).first()
    assert r["p"] == v[0] and r["m"] == v[2]


def test_edits_and_the_next_document(spark):
    texts = awkward(4, 25)
    ids = [3 * i % 97 for i in range(len(texts))]
    got = {r["doc_id"]: r for r in f.compare_edits(documents(spark, texts, ids=ids)).collect()}
    order = sorted(ids)
    by_id = {i: t or "" for i, t in zip(ids, texts)}
    for at, i in enumerate(order):
        t, after = by_id[i], by_id[order[(at + 1) % len(order)]]
        k = len(t) // 4
        edited = t[:len(t) - k] + after[:k]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[i]["vector"], got[i]["edited_vector"], got[i]["next_vector"]) == (brute(t), brute(edited), brute(after))


def test_likeness(spark):
    words = [f"w{i}" for i in range(800)]
    texts = [" ".join(words), " ".join(words[:600] + ["x%d" % i for i in range(200)]), " ".join(f"z{i}" for i in range(800)), "", None]
    v = {r["doc_id"]: r["vector"] for r in f.vectors(documents(spark, texts).select("doc_id", "text"), ["doc_id"], "text").collect()}
    pairs = spark.createDataFrame([(i, v[0], v[i]) for i in range(4)] + [(9, v[3], v[4])], "i int, a array<bigint>, b array<bigint>")
    got = {r["i"]: r["x"] for r in pairs.select("i", f.likeness(F.col("a"), F.col("b")).alias("x")).collect()}
    assert got[0] == 1.0 and 0.5 < got[1] < 1 and got[2] < 0.4 and got[3] == 0.0 and got[9] == 1.0


def test_repeated_rows_null_ids_one_row_and_none(spark):
    docs = documents(spark, ["a b c d e f g h", "a b c d e f g h", "q r s t", None], ids=[1, 1, None, 2])
    rows = f.compare_edits(docs).collect()
    assert len(rows) == 4 and len({r["edited_sha256"] for r in rows if r["doc_id"] == 1}) == 1
    alone = f.compare_edits(documents(spark, ["only one of them"])).collect()
    assert alone[0]["vector"] == alone[0]["next_vector"]
    assert f.compare_edits(docs.limit(0)).collect() == []
