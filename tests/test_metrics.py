"""Ranking metrics against the formulas over plain lists."""

import math
import random

import pytest
from conftest import rows

from sessionrank.operators import metrics as M

FAMILIES = ("recall", "precision", "map", "ndcg")


def _recs(table, lists):
    return table(
        [(s, i, r) for s, items in lists.items() for r, i in enumerate(items, 1)],
        "session_id bigint, item_id bigint, rank int",
    )


def _targets(table, sets):
    return table([(s, i) for s, items in sets.items() for i in items],
                 "session_id bigint, target_item_id bigint")


def _formulas(items, relevant, k):
    flags = [i in relevant for i in items[:k]]
    hits = sum(flags)
    dcg = sum(1 / math.log2(r + 1) for r, f in enumerate(flags, 1) if f)
    ideal = sum(1 / math.log2(r + 1) for r in range(1, hits + 1))
    ap = sum(sum(flags[:r]) / r for r, f in enumerate(flags, 1) if f)
    return hits / len(relevant), hits / k, ap / min(len(relevant), k), dcg / ideal if hits else 0.0


def _reciprocal(items, relevant):
    return next((1 / r for r, i in enumerate(items, 1) if i in relevant), 0.0)


@pytest.fixture(scope="module")
def lists():
    rng = random.Random(0)
    return {s: rng.sample(range(15), rng.randint(0, 12)) for s in range(60)}


@pytest.fixture(scope="module")
def sets():
    rng = random.Random(1)
    return {s: set(rng.sample(range(15), rng.choice([1, 3, 6]))) for s in range(60)}


def test_every_session(table, lists, sets):
    got = M.session_metrics(_recs(table, lists), _targets(table, sets), [2, 5, 10]).collect()
    assert len(got) == 60
    for row in got:
        s = row["session_id"]
        assert row["mrr"] == pytest.approx(_reciprocal(lists[s], sets[s]))
        for k in (2, 5, 10):
            assert [row[f"{f}@{k}"] for f in FAMILIES] == pytest.approx(_formulas(lists[s], sets[s], k))


def test_ranks_beyond_the_cuts_count_for_the_reciprocal_rank_only(table):
    row = M.session_metrics(_recs(table, {4: list(range(30, 42))}), _targets(table, {4: [39]}), [3]).first()
    assert (row["mrr"], row["recall@3"], row["ndcg@3"]) == (0.1, 0.0, 0.0)


def test_repeated_items_each_count(table):
    row = M.session_metrics(_recs(table, {6: [8, 5, 8, 8]}), _targets(table, {6: [8, 1]}), [4]).first()
    assert (row["recall@4"], row["precision@4"]) == (1.5, 0.75)


def test_means_run_over_the_target_sessions(table, lists, sets):
    some = {s: lists[s] for s in lists if s % 3}
    got = dict(rows(M.evaluate(_recs(table, {**some, 900: [1]}), _targets(table, sets), [5])))
    assert set(got) == {"recall@5", "precision@5", "map@5", "ndcg@5", "mrr"}
    for n, family in enumerate(FAMILIES):
        mean = sum(_formulas(some.get(s, []), sets[s], 5)[n] for s in sets) / 60
        assert got[f"{family}@5"] == pytest.approx(mean, abs=1e-5)


def test_a_list_for_all_sessions_equals_the_same_list_in_every_session(table, sets):
    shared = table([(9, 1), (2, 2), (11, 3)], "item_id bigint, rank int")
    each = _recs(table, {s: [9, 2, 11] for s in sets})
    results = M.compare_systems({"each": each, "shared": shared}, _targets(table, sets), [2, 3])
    values = {}
    for r in results.collect():
        values.setdefault(r["system"], {})[r["metric"]] = r["value"]
    assert values["each"] == values["shared"] and values["each"]["recall@3"] > 0


def test_systems_without_a_hit_keep_their_rows(table):
    targets = _targets(table, {3: [20], 8: [21]})
    systems = {"right": _recs(table, {3: [20], 8: [21]}), "empty": _recs(table, {3: []}), "off": _recs(table, {8: [20]})}
    pivot = M.pivot_metrics(M.compare_systems(systems, targets, [1]), [1])
    assert pivot.columns == ["system", "map@1", "mrr", "ndcg@1", "precision@1", "recall@1"]
    assert rows(pivot) == [("empty", *[0.0] * 5), ("off", *[0.0] * 5), ("right", *[1.0] * 5)]


def test_no_targets_give_null_means(table):
    got = rows(M.evaluate(_recs(table, {5: [6]}), _targets(table, {}), [1]))
    assert {value for _, value in got} == {None}


def test_order_of_metrics():
    assert M.ordered_metrics([4, 12])[:3] == ["map@4", "map@12", "mrr"]
