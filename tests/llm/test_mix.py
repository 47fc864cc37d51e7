import hashlib
import re

import pytest

from sessionrank.llm import mix

from .texts import awkward, documents


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_of(sizes):
    """Shares by weight; what exceeds three times a source goes to the others, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    fixed, left = {}, dict(sizes)
    while left:
        share = (sum(sizes.values()) - sum(fixed.values())) / sum(weight[s] for s in left)
        over = [s for s in left if share * weight[s] > 3 * sizes[s]]
        if not over:
            return fixed | {s: share * weight[s] for s in left}
        for s in over:
            fixed[s] = 3 * left.pop(s)
    return fixed


def draw(i, text):
    own = hashlib.md5((text or "").encode()).hexdigest()
    return (int(hashlib.md5(f"mix:{'null' if i is None else i}:{own}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52


def brute(rows):
    """Copies by (source, id): whole ones, then the sampling order as far as it fits, then later ones that fit."""
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size_of(t)
    target = targets_of(sizes)
    copies = {}
    for s in sizes:
        mine = [(draw(i, t), i, size_of(t)) for i, t, x in rows if x == s]
        whole = int(target[s] // sizes[s]) if sizes[s] else 0
        left, taken = target[s] - whole * sizes[s], set()
        for fill in range(3 if left > 0 else 0):
            free = {}
            for u, _, n in mine:
                if u not in taken and (not fill or n <= left):
                    free[u] = free.get(u, 0) + n
            sums, total = [], 0
            for u in sorted(free):
                total += free[u]
                sums.append((u, total))
            fits = [(u, x) for u, x in sums if x <= left]
            end = max(fits, default=(-1.0, 0))
            if fill == 2:
                end = min([(abs(left), -1.0, 0), *((abs(x - left), u, x) for u, x in sums)])[1:]
            taken |= {u for u in free if u <= end[0]}
            left -= end[1]
        copies |= {(s, i): whole + (u in taken) for u, i, _ in mine}
    return sizes, target, copies


@pytest.mark.parametrize("bins", [1 << 16, 4])
def test_mix_equals_the_plain_procedure(spark, monkeypatch, bins):
    monkeypatch.setattr(mix, "BINS", bins)
    texts = awkward(9, 80)
    source = [["a", "b", "B", "é", None, "tiny", "void"][min(i * i % 11, 4)] for i in range(len(texts))]
    texts, source = [*texts, "one", None], [*source, "tiny", "void"]
    docs = documents(spark, texts, source=source)
    sizes, target, copies = brute(list(zip(range(len(texts)), texts, source)))
    for r in mix.rated(docs).collect():
        s = r["source"]
        assert (r["source_size"], r["copies"]) == (sizes[s], copies[s, r["doc_id"]]), (s, r["doc_id"])
        assert abs(r["target"] - target[s]) < 1e-6 and r["copies"] <= 3


def test_takes_come_near_their_targets_and_reruns_agree(spark):
    docs = documents(spark, [("w " * (1 + i * 7 % 40)) for i in range(600)], source=["a" if i % 3 else f"s{i % 4}" for i in range(600)])
    one = sorted((r["doc_id"], r["copies"]) for r in mix.rated(docs).collect())
    assert one == sorted((r["doc_id"], r["copies"]) for r in mix.rated(docs.repartition(7)).collect())
    sums = {r[0]: r[1:] for r in mix.rated(docs).groupBy("source").agg({"target": "max"}).collect()}
    for r in mix.rated(docs).selectExpr("source", "copies * cast(trim(size) as int) t").groupBy("source").sum("t").collect():
        assert abs(r[1] - sums[r[0]][0]) <= 2


@pytest.mark.parametrize("ids", [[None] * 200, [7] * 150 + list(range(50))])
def test_rows_without_ids_or_of_one_id_are_drawn_apart(spark, ids):
    """A source's words come within one document of its target."""
    docs = documents(spark, [f"{i} " + "w " * 9 for i in range(200)], ids=ids, source=["a"] * 60 + ["b"] * 140)
    for r in mix.rated(docs).selectExpr("source", "target", "copies * 10 t").groupBy("source").agg({"target": "max", "t": "sum"}).collect():
        assert abs(r["max(target)"] - r["sum(t)"]) <= 10


def test_propensities_raise_the_chance(spark):
    docs = documents(spark, [f"w {i}" for i in range(400)], source=["a"] * 200 + ["b"] * 200).selectExpr("*", "if(doc_id % 2 = 0, 1.8D, 0.2D) as odds")
    picked = mix.rated(docs, propensity="odds").filter("source = 'a'").selectExpr("doc_id % 2 = 0 as even", "copies").groupBy("even").sum("copies").collect()
    got = {r[0]: r[1] for r in picked}
    assert got[True] > 3 * got[False]


def test_rows_are_repeated_and_empty_tables(spark):
    docs = documents(spark, ["a b c", None, "d e"], ids=[1, None, 1])
    out = mix.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r["copies"] for r in mix.rated(docs).collect())
    assert mix.mix(docs.limit(0)).collect() == []
