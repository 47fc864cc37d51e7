import hashlib

from pyspark.sql import functions as F

from sessionrank.llm import merkle
from sessionrank.llm.common import LOWER, UPPER
from tests.llm.texts import awkward, documents

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    def part(name):
        x = row[name]
        if x is None:
            return "-"
        x = str(x)
        if lower and name == "text":
            x = x.translate(str.maketrans(UPPER, LOWER))
        return f"{len(x.encode())}:{x}"

    return h("".join(map(part, FIELDS)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def path(tree, k):
    for nodes in tree[:-1]:
        a = k // 16 * 16
        yield "".join(nodes[a:k]), "".join(nodes[k + 1:a + 16])
        k //= 16


def by_hand(rows, hit):
    """Sorted (doc_id, leaf, subroot, root, siblings, folded) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rows in groups.values():
        rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = [levels([leaf(r) for r in groups[s]]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for j, s in enumerate(names):
        for k, r in enumerate(groups[s]):
            p = [*path(trees[j], k), *path(top, j)]
            folded = leaf(r, hit(r))
            for left, right in p:
                folded = h(left + folded + right)
            out.append((r["doc_id"], trees[j][0][k], trees[j][-1][0], top[-1][0], "".join(a + b for a, b in p), folded))
    return sorted(out, key=str)


def audited(docs):
    found = merkle.audit(docs, {"text": F.translate("text", UPPER, LOWER)}, F.col("doc_id") % 3 == 0)
    return found.select("doc_id", "leaf", "subroot", "root", merkle.siblings(F.col("path")).alias("s"), "folded_root", "verified")


def check(docs):
    got = sorted(map(tuple, audited(docs).collect()), key=str)
    expected = by_hand([r.asDict() for r in docs.collect()], lambda r: r["doc_id"] is not None and r["doc_id"] % 3 == 0)
    assert sorted((g[:-1] for g in got), key=str) == expected
    assert all(g[-1] == (g[-2] == g[3]) for g in got)
    return got


def test_awkward_rows(spark):
    texts = awkward()
    n = len(texts)
    ids = [None if i % 7 == 0 else i // 2 for i in range(n)]  # null and repeated ids
    source = [None, "", "b", "é", "Z", "a", "a", "a"]
    docs = documents(spark, texts, ids=ids, source=[source[i % 8] for i in range(n)], lang=["x" if i % 3 else None for i in range(n)])
    got = check(docs.union(docs.limit(9)))
    assert any(not g[-1] for g in got) and any(g[-1] for g in got)


def test_one_source_with_most_rows_many_sources_and_equal_rows(spark):
    n = 700
    texts = [f"Text {i % 300 if i < 400 else i}" for i in range(n)]
    source = ["hot" if i < 400 else f"s{i % 40}" for i in range(n)]
    docs = documents(spark, texts, source=source)
    check(docs)
    same = documents(spark, ["Same"] * 300, ids=[3] * 300, source=["one"] * 300)
    assert all(not g[-1] for g in check(same))


def test_small_tables(spark):
    assert check(documents(spark, ["Only one"], ids=[1])) == check(documents(spark, ["Only one"], ids=[1]))
    assert audited(documents(spark, [None]).limit(0)).count() == 0
    check(documents(spark, ["a", "B"], ids=[0, 1], source=["x", "y"]))


def test_requests_of_some_leaves(spark):
    docs = documents(spark, [f"t{i}" for i in range(300)], source=["a" if i < 280 else f"z{i}" for i in range(300)])
    digest = merkle.digest_of(F.col("text")).alias("digest")
    leaves = docs.select(merkle.group_key(F.col("source")).alias("g"), F.col("doc_id").alias("id"), digest)
    manifest = merkle.build(leaves, ["id"])
    every = {tuple(r) for r in merkle.prove(manifest).select("g", "rank", merkle.siblings(F.col("path"))).collect()}
    asked = spark.createDataFrame([("1a", 0), ("1a", 279), ("1z290", 0), ("1a", 280), ("1z290", 1), ("1none", 0)], "g string, rank bigint")
    some = {tuple(r) for r in merkle.prove(manifest, asked).select("g", "rank", merkle.siblings(F.col("path"))).collect()}
    assert some == {r for r in every if r[:2] in (("1a", 0), ("1a", 279), ("1z290", 0))} and len(some) == 3
    children = {r["digest"]: r["children"] for r in manifest.records.collect()}
    assert all(h("".join(c)) == d for d, c in children.items()) and manifest.root in children


def test_ranks_are_numbered_in_several_tasks(spark):
    rows = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") * 7919 % 5000).alias("id"))
    ranked = merkle.numbered(rows, ["id"])
    assert sorted(map(tuple, ranked.select("id", "rank").collect())) == [(i, i) for i in range(5000)]
    assert {r["total"] for r in ranked.select("total").collect()} == {5000}


def test_copies_are_listed_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 7)
    rows = spark.range(50).select(F.lit("g").alias("g"), (F.col("id") / 40).cast("int").alias("id"))
    ranked = merkle.numbered(rows, ["id"]).select("id", "rank").collect()
    assert sorted((r["rank"], r["id"]) for r in ranked) == [(i, i // 40) for i in range(50)]
