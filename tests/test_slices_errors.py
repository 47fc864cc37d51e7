"""Slices, errors and reports of random lists against plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sessionrank.operators import errors as E
from sessionrank.operators import reports as R
from sessionrank.operators import slices as L

ROWS = "session_id bigint, user_id bigint, item_id bigint, position int"
TARGETS = "session_id bigint, user_id bigint, target_item_id bigint"
RECS = "session_id bigint, item_id bigint, rank int"
N = 40
# Lengths on both sides of the limits of the buckets.
LENGTHS = [3, 4, 9, 10, 1]


def _lists(seed):
    rng = random.Random(seed)
    return {s: rng.sample(range(25), rng.randrange(0, 9)) for s in range(N) if s % 7}


def _wanted():
    rng = random.Random(77)
    # Target 31 never occurs in train, users from 20 on neither.
    return {s: (s % 23, rng.choice([*range(12), 31])) for s in range(N)}


def _train():
    rng = random.Random(78)
    return [(1000 + k, int(20 * rng.random() ** 2), int(20 * rng.random() ** 3), k) for k in range(150)]


@pytest.fixture(scope="module")
def context(table):
    return table([(s, 0, 50 + p, p) for s in range(N) if s != 4 for p in range(LENGTHS[s % 5])], ROWS)


@pytest.fixture(scope="module")
def targets(table):
    return table([(s, u, i) for s, (u, i) in _wanted().items()], TARGETS)


@pytest.fixture(scope="module")
def train(table):
    return table(_train(), ROWS)


def _recs(table, lists):
    return table([(s, i, r) for s, items in lists.items() for r, i in enumerate(items, 1)], RECS)


def _slices_of(s):
    """The slices that a session belongs to."""
    user, item = _wanted()[s]
    items, users = (Counter(r[k] for r in _train()) for k in (2, 1))
    head = np.quantile(list(items.values()), 0.8)
    low, high = np.quantile(list(users.values()), [0.4, 0.6])
    length = 0 if s == 4 else LENGTHS[s % 5]
    out = [("item_popularity", "head" if items.get(item, 0) >= head else "tail")]
    if length:
        out.append(("session_length", "short" if length <= 3 else "medium" if length <= 9 else "long"))
    if user in users:
        if users[user] <= low:
            out.append(("user_density", "sparse"))
        elif users[user] >= high:
            out.append(("user_density", "dense"))
    return out


def _recall_by_slice(lists, k):
    found = defaultdict(list)
    for s in range(N):
        for name in _slices_of(s):
            found[name].append(_wanted()[s][1] in lists.get(s, [])[:k])
    return {name: (len(hits), round(sum(hits) / len(hits), 5)) for name, hits in found.items()}


def test_slices_of_systems(table, context, targets, train):
    one, two = _lists(1), _lists(2)
    systems = {"one": _recs(table, one), "two+": _recs(table, two)}
    results = L.compare_slices(context, targets, train, systems, [2, 5])
    for name, lists in (("one", one), ("two+", two)):
        for k in (2, 5):
            mine = results.filter((F.col("system") == name) & (F.col("metric") == f"recall@{k}"))
            got = {(r["slice_type"], r["slice_value"]): (r["n_sessions"], r["value"]) for r in mine.collect()}
            assert got == _recall_by_slice(lists, k)
    pivot = {r[0]: tuple(r)[1:] for r in L.slice_pivot(results, "session_length", "recall@5", ["one", "two+"]).collect()}
    for value in ("short", "medium", "long"):
        assert pivot[value] == tuple(_recall_by_slice(x, 5)["session_length", value][1] for x in (one, two))
    summary = L.slice_summary(results, ["one", "two+"], [2, 5])
    assert "two+_recall@5" in summary.columns and summary.count() == len(_recall_by_slice(one, 5))


def test_single_slices_are_parts_of_all(table, context, targets, train):
    recs = _recs(table, _lists(3))
    every = L.all_slices(context, targets, train, recs, [4])
    parts = {
        "session_length": L.slice_by_session_length(context, targets, recs, [4]),
        "item_popularity": L.slice_by_item_popularity(train, targets, recs, [4]),
        "user_density": L.slice_by_user_density(train, targets, recs, [4]),
    }
    for name, part in parts.items():
        assert rows(part) == rows(every.filter(F.col("slice_type") == name))


def test_equal_limits_make_all_users_sparse(table):
    same = table([(i, i, 1, 0) for i in range(5)], ROWS)
    one = table([(50, 2, 1)], TARGETS)
    got = L.slice_by_user_density(same, one, _recs(table, {50: [1]}), [1])
    assert {r["slice_value"] for r in got.collect()} == {"sparse"}


def _rank(lists, s):
    items = lists.get(s, [])
    target = _wanted()[s][1]
    return items.index(target) + 1 if target in items else -1


def test_ranks_misses_and_rates(table, targets):
    lists = _lists(5)
    recs = _recs(table, lists)
    ranks = {s: _rank(lists, s) for s in range(N)}
    assert rows(E.target_ranks(recs, targets)) == sorted(((s, _wanted()[s][1], r) for s, r in ranks.items()), key=str)
    missed = [(s, _wanted()[s][1], r, r > 0) for s, r in ranks.items() if r < 0 or r > 3]
    assert rows(E.missed_targets(recs, targets, 3)) == sorted(missed, key=str)
    named = recs.withColumn("system", F.lit("x"))
    rate = round(100 * len(missed) / N, 6)
    assert rows(E.missed_rate(named, targets, 3, ["x", "silent"])) == [
        ("silent", N, N, 100.0), ("x", len(missed), N, rate)
    ]


def test_repeated_items_count_at_their_first_rank(table):
    one = table([(1, 1, 6)], TARGETS)
    assert rows(E.target_ranks(_recs(table, {1: [2, 6, 6]}), one)) == [(1, 6, 2)]


def test_coverage(table):
    lists = _lists(6)
    recs = _recs(table, lists)
    catalogue = table([(i % 30,) for i in range(60)], "item_id bigint")
    seen = len({i for items in lists.values() for i in items[:2]})
    assert rows(E.coverage(recs, catalogue, 2)) == [(30, seen, round(seen / 30, 5))]
    assert rows(E.coverage(recs, catalogue.limit(0), 2)) == [(0, seen, 0.0)]
    both = recs.withColumn("system", F.lit("x"))
    assert rows(E.coverage(both, catalogue, 2, ["x", "silent"])) == [
        (30, 0, 0.0, "silent"), (30, seen, round(seen / 30, 5), "x")
    ]


@pytest.mark.parametrize("hot_rows", [2, 10**6])
def test_error_report(table, context, targets, train, hot_rows):
    lists = _lists(8)
    items = Counter(r[2] for r in _train())
    head = np.quantile(list(items.values()), 0.8)
    expected = []
    for s in range(N):
        target, rank = _wanted()[s][1], _rank(lists, s)
        expected.append((s, target, rank, None if s == 4 else LENGTHS[s % 5], items.get(target),
                         int(items.get(target, 0) >= head), 0 < rank <= 4))
    got = E.error_report(_recs(table, lists), targets, train, context, 4, hot_rows=hot_rows)
    assert rows(got) == sorted(expected, key=str)


REPORT = ("session_id bigint, target_item_id bigint, target_rank int, session_length bigint, "
          "item_train_count bigint, item_is_head int, hit_at_k boolean")


def _report(table, ranks, lengths=None):
    lengths = lengths or [6] * len(ranks)
    return table([(10 + i, 7 * i, r, n, None if i == 2 else i * i, i % 2, 0 < r <= 4)
                  for i, (r, n) in enumerate(zip(ranks, lengths))], REPORT)


def test_summary_equals_pandas(table):
    rng = random.Random(3)
    report = _report(table, [rng.choice([-1, *range(1, 40)]) for _ in range(27)])
    got = {r["column_name"]: r for r in E.error_summary(report).collect()}
    expected = report.toPandas().describe()
    names = {"count": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%",
             "q50": "50%", "q75": "75%", "max": "max"}
    for column in E.SUMMARY_COLUMNS:
        for ours, theirs in names.items():
            assert got[column][ours] == pytest.approx(expected[column][theirs])


def test_kpis_and_histogram(table):
    ranks = [2, 17, -1, 9, -1, 3, 40]
    found = sorted(r for r in ranks if r > 0)
    report = _report(table, ranks)
    assert rows(R.hit_kpis(report)) == [(pytest.approx(2 / 7), pytest.approx(200 / 7), float(np.median(found)))]
    counts = [r["n"] for r in R.rank_histogram(report, 5).orderBy("bin").collect()]
    assert counts == np.histogram(found, 5)[0].tolist()
    single = [r["n"] for r in R.rank_histogram(_report(table, [8, 8, 8]), 3).orderBy("bin").collect()]
    assert single == np.histogram([8, 8, 8], 3)[0].tolist()
    assert rows(R.rank_histogram(_report(table, [-1, -1]), 2)) == []


def test_hit_rate_by_length(table):
    report = _report(table, [1, -1, 2, 30, 4, 2], [2, 3, 4, 9, 10, 60])
    assert rows(R.hit_rate_by_length(report)) == [("long", 1, 1.0), ("medium", 2, 0.5), ("short", 2, 0.5)]
    assert ("long", 2, 1.0) in rows(R.hit_rate_by_length(report, None))


def test_best_and_key_metrics(table):
    results = table([("p", "ndcg@10", 0.7), ("q", "ndcg@10", 0.6), ("q", "recall@5", 0.4), ("p", "recall@5", 0.4)],
                    "system string, metric string, value double")
    assert rows(R.best_system(results)) == [("ndcg@10", "p", 0.7), ("recall@5", "p", 0.4)]
    assert [tuple(r) for r in R.key_metrics(results).collect()] == [("q", "ndcg@10", 0.6), ("p", "ndcg@10", 0.7)]
